"""The SQL of Spark's 64-bit hash and of the keyed permutation against both."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import hashsql
from gridloom.llm.sharding import permute


def test_hashes_equal_sparks(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab é漢😀\n"), n)) for n in range(140)] + [None, "x" * 5000]
    rows = [(int(i), t) for i, t in zip(rng.integers(-(2**63), 2**63 - 1, len(texts)), texts, strict=True)]
    want = {r.i: r.h for r in spark.createDataFrame(rows, "i long, t string").select("i", F.xxhash64("i", "t", F.lit(17)).alias("h")).collect()}
    con = duckdb.connect()
    con.execute("create table d (i bigint, t varchar)")
    con.executemany("insert into d values (?, ?)", rows)
    first = hashsql.chain("(SELECT i, t, 42::UHUGEINT AS h FROM d)", hashsql.of_long("i"))
    got = con.execute(f"SELECT i, {hashsql.signed('h')} FROM {hashsql.chain(hashsql.of_text(first, 't'), hashsql.of_int(17))}").fetchall()
    assert dict(got) == want


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_equals_the_operators(n):
    got = duckdb.connect().execute(f"WITH RECURSIVE {hashsql.permutation(f'SELECT {n} AS n')} SELECT x, p FROM placed ORDER BY x").fetchall()
    assert [p for _, p in got] == permute(np.arange(n), n).tolist()
