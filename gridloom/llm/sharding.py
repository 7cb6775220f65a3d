"""Sharding by a Feistel permutation of global row numbers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import buckets_for, running_start


def _round(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mix of the half block and the round's key."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def permute(x: np.ndarray, n: int, seed: int = 1, rounds: int = 6) -> np.ndarray:
    """A permutation of 0..n-1, computable for any number alone.

    Numbers are split into halves by sqrt(n); alternate rounds add a keyed mix of one half to the other.  The
    domain is at most sqrt(n) + 1 larger than n; a number that lands beyond n walks on along its cycle.
    """
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))

    def once(v: np.ndarray) -> np.ndarray:
        lo, hi = v % np.uint64(a), v // np.uint64(a)
        for r in range(rounds):
            if r % 2:
                lo = (lo + _round(hi, seed * 64 + r) % np.uint64(a)) % np.uint64(a)
            else:
                hi = (hi + _round(lo, seed * 64 + r) % np.uint64(b)) % np.uint64(b)
        return hi * np.uint64(a) + lo

    out = once(np.asarray(x).astype(np.uint64))
    while (beyond := out >= np.uint64(n)).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 1) -> DataFrame:
    """Add row_number (global, from 0), shard and slot to every row of ``docs``.

    Row numbers follow a hash of doc_id and of the text's crc32, so they don't depend on files or tasks.  The
    permuted number p puts the row into shard p mod ``shards`` at slot p div ``shards``: shards differ by one
    row at most, slots have no gaps, and both can be computed from the row number alone.  Equal rows are
    interchangeable.  A null doc_id or text is hashed as null.  Columns named row_number, shard or slot are
    replaced; all others stay.  Texts of any length count whole.  An empty table gives an empty one.
    """
    n = docs.count()
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("row_number", "shard", "slot")]
    rows = docs.select(F.struct(*kept).alias("_row"), "doc_id", F.crc32(F.col("text").cast("binary")).alias("_crc"))
    rows = running_start(rows, [], ["doc_id", "_crc"], F.lit(1).cast("long"), "row_number", buckets_for(n))

    @F.pandas_udf("long")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for number in parts:
            yield pd.Series(permute(number.to_numpy(), n, seed), dtype="int64")

    rows = rows.withColumn("_p", place("row_number"))
    return rows.select("_row.*", "row_number", (F.col("_p") % shards).cast("int").alias("shard"), F.floor(F.col("_p") / shards).cast("long").alias("slot"))
