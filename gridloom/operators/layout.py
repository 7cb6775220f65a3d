"""Geometry of word boxes: rows, blocks, gutters, columns.  ``keys`` name the page or block that rows belong to."""

from __future__ import annotations

import math
import traceback
from bisect import insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A new word looks at so many of the latest rows.
LOOKBACK = 12


def _middle(values: list[float]) -> float:
    n = len(values)
    return (values[(n - 1) // 2] + values[n // 2]) / 2


def cluster_rows(cy: Sequence[float], height: Sequence[float], tolerance: float) -> list[int]:
    """Row of each word, numbered as rows were begun; words come sorted by centre.

    A word joins the nearest of the latest rows whose centre, the median of its words', lies within the
    tolerance and 0.65 of the word's height (3 at least); of equally near ones, the one begun first.
    """
    members: list[list[float]] = []
    out = []
    for centre, h in zip(cy, height, strict=True):
        reach = min(tolerance, max(3.0, h * 0.65))
        near = [(abs(centre - _middle(members[i])), i) for i in range(max(0, len(members) - LOOKBACK), len(members))]
        distance, row = min(near, default=(reach + 1, -1))
        if distance > reach:
            row = len(members)
            members.append([])
        insort(members[row], centre)
        out.append(row)
    return out


def _rows_of(words: pa.Table) -> pa.Table:
    """Add sub (row inside its island), row_cy and problem to whole islands, whose words follow each other by centre."""
    first, loose = (words.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("_first", "_loose"))
    cy, h, limit, middle = (words.column(c).to_numpy(zero_copy_only=False) for c in ("cy", "h", "_limit", "_middle"))
    sub, centre = np.zeros(len(words), np.int32), middle.astype(np.float64).copy()
    problem: list[str | None] = [None] * len(words)
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], len(words))
    for begin, end in zip(begins, ends, strict=True):
        if not loose[begin]:
            continue
        try:
            own = np.array(cluster_rows(cy[begin:end].tolist(), h[begin:end].tolist(), float(limit[begin])))
            sub[begin:end] = own
            for row in range(int(own.max()) + 1):
                members = own == row
                centre[begin:end][members] = _middle(cy[begin:end][members].tolist())
        except Exception:
            problem[begin:end] = [traceback.format_exc()] * (end - begin)
    return words.append_column("sub", pa.array(sub)).append_column("row_cy", pa.array(centre)).append_column("problem", pa.array(problem, pa.string()))


def _cluster(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of islands; what a batch leaves of its last island waits for the next ones."""
    held: list[pa.RecordBatch] = []
    for batch in parts:
        begins = np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))
        if len(begins) and begins[-1]:
            held.append(batch.slice(0, int(begins[-1])))
            batch = batch.slice(int(begins[-1]))
        if len(begins) and held:
            yield from _rows_of(pa.Table.from_batches(held)).combine_chunks().to_batches()
            held = []
        held.append(batch)
    if held:
        yield from _rows_of(pa.Table.from_batches(held)).combine_chunks().to_batches()


def find_rows(tokens: DataFrame, keys: Sequence[str], row_tolerance: float = 0.45) -> DataFrame:
    """Tokens that aren't noise, with typical (height), row (from 0 by centre), row_cy and problem.

    Clustering looks at one word after the other, but never across a gap between sorted centres that is wider than the tolerance: such gaps
    part a page into islands.  An island all of whose words reach across it is one row, which windows tell; only the others are
    gone through word by word, as a stream, so that no page is gathered.  What fails there is the ``problem`` of
    its words, which have one row then; else it is null.  Words without a centre have no row and are left out.
    """
    keys = list(keys)
    page, order = Window.partitionBy(*keys), ["cy", "x", "seq"]
    along = page.orderBy(*order)
    found = tokens.filter(~F.col("noise") & (F.col("h") > 0) & F.col("cy").isNotNull()).withColumn("cy", F.col("cy").cast("double"))
    found = found.withColumn("typical", F.coalesce(F.median(F.when(F.col("h").between(6, 120), F.col("h"))).over(page), F.lit(32.0)))
    found = found.withColumn("_limit", F.greatest(F.lit(3.0), F.col("typical") * F.lit(float(row_tolerance))))
    gap = F.col("cy") - F.lag("cy").over(along)
    found = found.withColumn("_first", F.coalesce(gap > F.col("_limit"), F.lit(True)))
    found = found.withColumn("_island", F.sum(F.col("_first").cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    island = Window.partitionBy(*keys, "_island")
    reach = F.least(F.col("_limit"), F.greatest(F.lit(3.0), F.col("h") * F.lit(0.65)))
    found = found.withColumns({"_loose": (F.max("cy").over(island) - F.min("cy").over(island)) > F.min(reach).over(island), "_middle": F.median("cy").over(island)})
    schema = StructType([*found.schema.fields]).add("sub", "integer").add("row_cy", "double").add("problem", "string")
    placed = found.sortWithinPartitions(*keys, *order).mapInArrow(_cluster, schema)
    number = F.dense_rank().over(page.orderBy("row_cy", "_island", "sub")) - 1
    return placed.withColumn("row", number.cast("int")).select(*tokens.columns, "typical", "row", "row_cy", "problem")


def block_threshold(gaps: DataFrame, keys: Sequence[str], factor: float, typical: Column | None = None) -> DataFrame:
    """step and threshold by ``keys`` from the column gap: the median of large enough gaps, times ``factor``.

    With ``typical``, gaps below 0.7 of it don't count, the step without any is 1.7 of it, and the threshold is
    2.5 of it at least.
    """
    if typical is None:
        return gaps.groupBy(*keys).agg(F.median(F.when(F.col("gap") > 0, F.col("gap"))).alias("step")).withColumn("threshold", F.col("step") * factor)
    large = F.when((F.col("gap") > 0) & (F.col("gap") >= typical * 0.7), F.col("gap"))
    found = gaps.groupBy(*keys).agg(F.median(large).alias("_step"), F.max(typical).alias("_t"))
    step = F.coalesce("_step", F.col("_t") * 1.7)
    return found.select(*keys, step.alias("step"), F.greatest(F.col("_t") * 2.5, step * factor).alias("threshold"))


def split_blocks(rows: DataFrame, keys: Sequence[str], order: str, factor: float, typical: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Add block_no (from 1): a new block begins where the gap to the row before is above the threshold.  ``ties`` order equal rows."""
    along = Window.partitionBy(*keys).orderBy(order, *ties)
    gapped = rows.withColumn("gap", F.col(order) - F.lag(order).over(along))
    limits = block_threshold(gapped, keys, factor, F.col(typical) if typical else None)
    placed = gapped.join(limits, list(keys))
    return placed.withColumn("block_no", (F.sum((F.coalesce("gap", F.lit(0)) > F.col("threshold")).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)) + 1).cast("int")).drop("gap", "step", "threshold")


def find_blocks(tokens: DataFrame, keys: Sequence[str], factor: float = 3.0) -> DataFrame:
    """Tokens of ``find_rows`` with block_no and row_no, both from 1."""
    rows = tokens.groupBy(*keys, "row").agg(F.first("row_cy").alias("row_cy"), F.first("typical").alias("typical"))
    rows = split_blocks(rows, keys, "row_cy", factor, "typical", ["row"])
    numbered = rows.withColumn("row_no", F.row_number().over(Window.partitionBy(*keys, "block_no").orderBy("row")))
    return tokens.join(numbered.select(*keys, "row", "block_no", "row_no"), [*keys, "row"])


def along_row(tokens: DataFrame) -> list[str]:
    """The order of a row's words: by left edge, equal ones by centre, then as they were read."""
    return ["x", *(["cy"] if "cy" in tokens.columns else []), "seq"]


def row_gaps(tokens: DataFrame, keys: Sequence[str], row: str = "row", typical: Column | None = None) -> DataFrame:
    """Gaps of at least the typical height between neighbours of a row, narrowed by a fifth of it on either side: keys, row, lo, hi."""
    t = F.lit(32.0) if typical is None else typical
    next_x = F.lead("x").over(Window.partitionBy(*keys, row).orderBy(*along_row(tokens)))
    gaps = tokens.withColumn("_next", next_x).filter(F.col("_next") - F.col("r") >= t)
    return gaps.select(*keys, row, (F.col("r") + t * F.lit(0.2)).alias("lo"), (F.col("_next") - t * F.lit(0.2)).alias("hi"))


def free_stretches(row: np.ndarray, x: np.ndarray, r: np.ndarray, typical: np.ndarray, n_rows: int, support: float) -> tuple[np.ndarray, ...]:
    """lo, hi, support and crossing of one block's stretches; its words come row by row, in the order of ``along_row``."""
    same = row[1:] == row[:-1]
    gap = np.flatnonzero(same & (x[1:] - r[:-1] >= typical[:-1]))
    ends, at = np.unique(np.concatenate([r[gap] + typical[gap] * 0.2, x[gap + 1] - typical[gap] * 0.2]), return_inverse=True)
    # gaps of one row never overlap, so the rows around a stretch are a running sum over gap ends
    around = np.cumsum(np.bincount(at, np.repeat([1, -1], len(gap)), len(ends)).astype(np.int64))[:-1]
    free = np.flatnonzero(around >= max(2, math.ceil(n_rows * support)))
    middle = (ends[free] + ends[free + 1]) / 2
    wide = r > x
    row, x, r = row[wide], x[wide], r[wide]
    begins = np.ones(len(x), bool)
    if len(free) and np.any((row[1:] == row[:-1]) & (x[1:] < r[:-1])):  # words that overlap are one
        for own in np.split(np.arange(len(row)), np.flatnonzero(row[1:] != row[:-1]) + 1):
            begins[own[1:]] = x[own[1:]] >= np.maximum.accumulate(r[own])[:-1]
    begins = np.flatnonzero(begins)
    left, right = x[begins].astype(float), (np.maximum.reduceat(r, begins) if len(begins) else r).astype(float)
    crossing = np.searchsorted(np.sort(left), middle, "left") - np.searchsorted(np.sort(right), middle, "right")
    few = crossing <= max(1, int(n_rows * 0.15))
    return ends[free][few], ends[free + 1][few], around[free][few], crossing[few]


def gutter_segments(tokens: DataFrame, keys: Sequence[str], row: str = "row", support: float = 0.30, typical: Column | None = None) -> DataFrame:
    """Stretches between neighbouring gap ends that enough rows leave free: keys, lo, hi, support, crossing.

    Numbers alone of one block's words are gathered in a task and sorted there.  Aggregates and windows over words would each hold on to memory
    that the others of their task need.
    """
    keys, order = list(keys), along_row(tokens)
    n = len(keys)
    words = tokens.filter(" and ".join(f"`{k}` is not null" for k in keys)).select(*keys, F.col(row).alias("_row"), *order, "r", (F.lit(32.0) if typical is None else typical).cast("double").alias("_t"))
    schema = StructType([f for f in tokens.select(*keys).schema.fields]).add("lo", "double").add("hi", "double").add("support", "long").add("crossing", "long")

    def stretches(block: pa.Table) -> pa.Table:
        names = block.column(n).combine_chunks().dictionary_encode()
        words = {c: block.column(c).to_numpy() for c in (*order, "r", "_t")}
        line = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        by = np.lexsort((*(words[c] for c in reversed(order)), line))
        found = free_stretches(line[by], words["x"][by], words["r"][by], words["_t"][by], len(names.dictionary), support)
        key = [pa.repeat(block.column(i)[0], len(found[0])) for i in range(n)]
        return pa.Table.from_arrays([*key, *[pa.array(c) for c in found]], [*keys, "lo", "hi", "support", "crossing"])

    return words.groupBy(*keys).applyInArrow(stretches, schema)


def merge_segments(segments: DataFrame, keys: Sequence[str], max_cols: int = 20, typical: Column | None = None) -> DataFrame:
    """Cuts in the middle of runs of segments at most 1 apart: keys, cut_no (from 1), x.

    Runs narrower than 0.3 of the typical height fall out; the best supported, then widest, then leftmost stay.
    """
    t = F.lit(32.0) if typical is None else typical
    along = Window.partitionBy(*keys).orderBy("lo")
    apart = F.coalesce(F.col("lo") > F.lag("hi").over(along) + 1, F.lit(True)).cast("int")
    runs = segments.withColumn("_a", apart).withColumn("_run", F.sum("_a").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*keys, "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("support").alias("support"))
    runs = runs.filter(F.col("hi") - F.col("lo") >= t * F.lit(0.3))
    best = Window.partitionBy(*keys).orderBy(F.desc("support"), F.desc(F.col("hi") - F.col("lo")), "lo")
    kept = runs.withColumn("_k", F.row_number().over(best)).filter(F.col("_k") < max_cols)
    return kept.select(*keys, F.row_number().over(along).alias("cut_no"), ((F.col("lo") + F.col("hi")) / 2).alias("x"))


def cut_arrays(cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cuts.groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("cuts"))  # max_cols bounds it


def manual_cuts(width: Column, shares: Sequence[float]) -> Column:
    """The same boundaries for every block: shares of the page width."""
    return F.array(*[F.lit(float(s)) * width for s in sorted(set(shares))]).cast("array<double>")


def to_columns(tokens: DataFrame) -> DataFrame:
    """Add column (1 and the cuts at or left of the word's middle) and crosses (a cut lies inside the word)."""
    middle = (F.col("x") + F.col("r")) / F.lit(2.0)
    return tokens.withColumns(
        {
            "column": F.size(F.filter("cuts", lambda c: middle >= c)) + 1,
            "crosses": F.exists("cuts", lambda c: (F.col("x") < c) & (c < F.col("r"))),
        }
    )
