"""Text grids at any size: no hash table has a group for each word, as it wouldn't give its memory back to the sorts of its task."""

import re

import pytest

from gridloom.operators import layout
from gridloom.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def hashed(df):
    """Keys of the hash aggregates of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?", "", m) for m in re.findall(r"(?<!Object)HashAggregate\(keys=\[([^\]]*)\]", plan)}


def test_segments_hash_nothing(spark):
    assert hashed(catalogue.tg_segments(spark, FOLDER)) == set()


def test_words_of_no_width_lie_across_nothing(spark):
    """A word that ends before it begins, and one under another; the rows around have the gap 106 to 294."""
    rows = [[(0, 100), (300, 400)]] * 6 + [[(0, 100), (10, 20), (250, 150), (300, 400)]]
    tokens = spark.createDataFrame([(1, r, i, x, e) for r, row in enumerate(rows) for i, (x, e) in enumerate(row)], "k int, row int, seq int, x int, r int")
    got = {(r.lo, r.hi, r.crossing) for r in layout.gutter_segments(tokens, ["k"]).collect()}
    assert {c for *_, c in got} == {0} and min(lo for lo, *_ in got) >= 106.4 and max(hi for _, hi, _ in got) <= 293.6


@pytest.mark.parametrize("name", ["tg_wide", "tg_cells", "tg_assign", "tg_crossing", "block_flags", "review", "tg_cuts"])
def test_no_hash_table_has_words(spark, name):
    assert hashed(catalogue.QUERIES[name](spark, FOLDER)) <= {"doc_id", "doc_id, _run", "doc_id, row"}
