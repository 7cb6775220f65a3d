"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.sources.store import fresh_path, removed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    Results read such tables, so they stay; ``with Scratch(spark):`` around an operator and the writing of its result removes them.
    """
    path = fresh_path(df.sparkSession, "gridloom")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove tables of ``stored`` that nothing reads any more."""
    removed(spark, *paths)


def bit_table(df: DataFrame, column: str, bits: int):
    """Broadcast a table of 2 ** ``bits`` bits, set at the hashes of a column's values; its size never grows."""
    slot = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    words = df.select(slot.alias("s")).groupBy(F.floor(F.col("s") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("v")).toArrow()
    table = np.zeros((1 << bits) // 64, dtype=np.int64)
    table[words["w"].to_numpy()] = words["v"].to_numpy()
    return df.sparkSession.sparkContext.broadcast(table)


def bits_at(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 6].view(np.uint64) >> (slots & 63).astype(np.uint64)) & np.uint64(1) == 1


def maybe_in(column: str, table, bits: int) -> Column:
    """False for values that aren't in a ``bit_table``; true for all that are and for a few others."""

    @F.pandas_udf("boolean")
    def look(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for slots in parts:
            yield pd.Series(bits_at(table.value, slots.to_numpy(dtype=np.int64)))

    return look(F.pmod(F.xxhash64(column), F.lit(1 << bits)))


def buckets_for(rows: int) -> int:
    """Into how many buckets ``running_start`` should deal a group of so many rows: 32,768 rows make one."""
    return max(1024, rows >> 15)


def bucket_of(order: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*order, F.lit(17)), F.lit(buckets)).cast("int")


def running_start(df: DataFrame, group: list[str], order: list[str], value: str | Column, out: str, buckets: int, totals: DataFrame | None = None, plan: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that come before this one.

    Rows are ordered by (hash bucket of ``order``, ``order``), a reproducible shuffle.  A group, even one that
    holds most rows, is spread over ``buckets`` tasks; only the bucket totals (``buckets`` a group) meet.
    Adds ``bucket`` as well.  ``totals`` has the bucket totals (``_sum``) if they are known; ``plan`` has more
    columns for each group, which come along with them.
    """
    value = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("bucket", bucket_of(order, buckets))
    key = [*group, "bucket"]
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    total = df.groupBy(*key).agg(F.sum(value).alias("_sum")) if totals is None else totals
    first = Window.partitionBy(*(group or [F.lit(0)])).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = total.select(*key, F.coalesce(F.sum("_sum").over(first), F.lit(0)).alias("_offset"))
    if plan is not None:
        offset = offset.join(plan, group)
    inside = df.withColumn("_inside", F.coalesce(F.sum(value).over(before(*key).orderBy(*order)), F.lit(0)))
    return inside.join(offset, key).withColumn(out, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside")
