"""Routing to success, skipped and errors; what is left of a work-list; reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.sources.store import fresh_path

#: A sheet holds so many rows besides its header.
SHEET_ROWS = 999_999


def remaining(worklist: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Rows of the work-list whose key isn't done; repeated ones stay."""
    return worklist.join(done.select(key).distinct(), key, "left_anti")


def done_paths(*parts: DataFrame) -> DataFrame:
    """Distinct keys over several results."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


#: Fixed value: the reason of a document that isn't there.
NOT_FOUND = "файл не найден по пути из CSV"


def routed(records: DataFrame, error: str = "error", found: str = "found") -> DataFrame:
    """status errors where there is an error, such rows have no reason; skipped where nothing was found."""
    bad, gone = F.col(error).isNotNull(), ~F.coalesce(F.col(found), F.lit(True)) if found in records.columns else F.lit(False)
    status = F.when(bad, "errors").when(gone, "skipped").otherwise(F.col("status"))
    return records.withColumns({"status": status, "reason": F.when(bad, "").when(gone, NOT_FOUND).otherwise(F.col("reason"))}).drop(found)


def three_ways(records: DataFrame) -> dict[str, DataFrame]:
    return {s: records.filter(F.col("status") == s) for s in ("success", "skipped", "errors")}


def run_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def sheet_number(row: Column, rows: int = SHEET_ROWS) -> Column:
    """Sheet (from 1) of a row number (from 1)."""
    return (F.floor((row - 1) / F.lit(rows)) + 1).cast("long")


def numbered(rows: DataFrame, order: str, out: str = "no", pieces: int = 64) -> DataFrame:
    """Add row numbers from 1 over the whole table in the order of a unique column.

    Rows are dealt by ranges of the order; numbers inside a range and the counts of earlier ranges make them,
    so no task sees the whole table.  The dealt rows are written to the shared folder once: the bounds of ranges are
    sampled, so dealing again for the counts could give other ranges.
    """
    path = fresh_path(rows.sparkSession, "numbered")
    dealt = rows.repartitionByRange(pieces, order).withColumn("_p", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = rows.sparkSession.read.schema(dealt.schema).parquet(path)
    inside = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    counts = inside.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    before = counts.withColumn("_b", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(F.broadcast(before.select("_p", "_b")), "_p").withColumn(out, F.col("_b") + F.col("_i")).drop("_p", "_i", "_b")


def final_report(success: DataFrame, errors: DataFrame, order: str) -> DataFrame:
    """Numbered successes, then errors without a number; columns that one side lacks are null."""
    return numbered(success, order).unionByName(errors, allowMissingColumns=True)
