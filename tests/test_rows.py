"""Row clustering by islands against the page taken whole."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import layout

SCHEMA = "k int, seq int, x int, cy double, h int, noise boolean"


def whole(page, factor):
    """seq to (row, centre), the words taken one after the other over the whole page."""
    words = sorted((w for w in page if not w[5] and w[4] > 0), key=lambda w: (w[3], w[2], w[1]))
    heights = sorted(w[4] for w in words if 6 <= w[4] <= 120)
    typical = layout._middle(heights) if heights else 32.0
    rows = layout.cluster_rows([w[3] for w in words], [w[4] for w in words], max(3.0, typical * factor))
    centres = {r: layout._middle(sorted(w[3] for w, own in zip(words, rows) if own == r)) for r in set(rows)}
    order = {r: i for i, r in enumerate(sorted(centres, key=lambda r: (centres[r], r)))}
    return {w[1]: (order[r], centres[r], typical) for w, r in zip(words, rows)}


@pytest.mark.parametrize("spread", [60, 400, 3000])
def test_islands_equal_the_whole_page(spark, spread):
    rng = random.Random(spread)
    rows = [(k, i, rng.randrange(900), rng.randrange(2 * spread) / 2, rng.choice([0, 4, 8, 20, 32, 32, 32, 130]), rng.random() < 0.1) for k in range(6) for i in range(rng.choice([1, 40, 150]))]
    rows += [(None, i, 0, float(i % 7 * 9), 32, False) for i in range(60)]
    found = layout.find_rows(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"], 0.45).collect()
    want = {}
    for k in {r[0] for r in rows}:
        want |= {(k, seq): v for seq, v in whole([r for r in rows if r[0] == k], 0.45).items()}
    assert {(r.k, r.seq): (r.row, r.row_cy, r.typical) for r in found} == want and all(r.problem is None for r in found)


def test_small_batches_hold_islands_together(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        test_islands_equal_the_whole_page(spark, 60)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_a_page_of_one_island(spark):
    """A page whose centres leave no gap: one island of 20,000 words."""
    rows = [(1, i, i % 50, i / 4, 32, False) for i in range(20_000)]
    found = layout.find_rows(spark.createDataFrame(rows, SCHEMA), ["k"])
    want = whole(rows, 0.45)
    assert {r.seq: (r.row, r.row_cy, r.typical) for r in found.collect()} == want


def test_failures_are_data(spark, monkeypatch):
    def failing(cy, h, tolerance):
        if max(cy) > 900:
            raise ValueError("no rows here")
        return [0] * len(cy)

    monkeypatch.setattr(layout, "cluster_rows", failing)
    rows = [(k, i, 0, float(base + 10 * i), 32, False) for k, base in ((1, 0), (2, 900)) for i in range(5)]
    found = layout.find_rows(spark.createDataFrame(rows, SCHEMA), ["k"]).collect()
    assert {r.k for r in found if r.problem} == {2} and all("no rows here" in r.problem for r in found if r.problem)


def test_empty_pages(spark):
    assert layout.find_rows(spark.createDataFrame([], SCHEMA), ["k"]).count() == 0
    none = spark.createDataFrame([(1, 0, 0, None, 32, False)], SCHEMA).withColumn("typical_", F.lit(1))
    assert layout.find_rows(none, ["k"]).count() == 0
