"""Cells of a grid, their flags, the wide form, and the tables around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import number_candidates, numbers

WIDE_COLUMNS = 64


def slot_name(column: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(column.cast("string"), 2, "0"))


def joined_flags(*flags: tuple[str, Column]) -> Column:
    """Names of the flags that hold, in this order, with semicolons."""
    return F.array_join(F.filter(F.array(*[F.when(on, F.lit(name)) for name, on in flags]), lambda x: x.isNotNull()), ";")


def hypotheses(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A review row for each block: its columns are a guess from geometry; the detail is its flags."""
    return blocks.select(*columns, F.lit("geometry_hypothesis").alias("code"), F.col("flags").alias("detail"))


def cells(tokens: DataFrame, keys: Sequence[str], row: str = "row", review_conf: float = 40.0, candidates: bool = True) -> DataFrame:
    """One row a cell that has words: text and token ids from left to right, box, mean confidence, flags.

    ``tokens`` has column and crosses.  numeric_candidates are the numbers of all words; without ``candidates``
    only their count goes into the flags.
    """
    keys = [*keys, row, "column"]
    if candidates:
        tokens = tokens.withColumn("_n", number_candidates(F.col("text")))
        found = F.transform("_n", lambda n: F.struct(n["raw"].alias("raw"), n["value"].alias("value"), F.col("token_id").alias("token"), n["offset"].alias("offset"), F.col("conf").alias("conf")))
    else:
        found = F.transform(numbers(F.col("text")), lambda n: F.struct(n.alias("raw")))
    word = F.struct("x", "cy", "seq", "text", "token_id", found.alias("found"))
    grouped = tokens.groupBy(*keys).agg(
        F.sort_array(F.collect_list(word)).alias("words"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("r").alias("x1"), F.max("b").alias("y1"),
        F.avg("conf").alias("_mean"), F.min("conf").alias("_min"), F.max("crosses").alias("_crosses"),
    )
    grouped = grouped.withColumn("numeric_candidates", F.flatten(F.transform("words", lambda w: w["found"])))
    flags = joined_flags(("low_conf", F.col("_min") < review_conf), ("multiple_numbers", F.size("numeric_candidates") > 1), ("crosses_column_boundary", F.col("_crosses")))
    kept = ["numeric_candidates"] if candidates else []
    return grouped.select(
        *keys, F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("cell_raw"), *kept,
        F.array_join(F.transform("words", lambda w: w["token_id"]), " ").alias("token_ids"),
        "x0", "y0", "x1", "y1", F.bround("_mean", 2).alias("mean_conf"), flags.alias("flags"),
    )


def wide_grid(long: DataFrame, keys: Sequence[str], width: int = WIDE_COLUMNS) -> DataFrame:
    """One row a grid row, C01 to C64, empty where there is no cell.  The columns are stated, so none are searched for."""
    names = [f"C{i:02d}" for i in range(1, width + 1)]
    return long.groupBy(*keys).pivot("column", list(range(1, width + 1))).agg(F.first("cell_raw")).toDF(*keys, *names).fillna("", names)


def row_flags(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct flags of each row's words, sorted, with semicolons."""
    flag = F.when(F.col("crosses"), "crosses_column_boundary")
    return tokens.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(flag)), ";").alias("flags"))


def block_boxes(tokens: DataFrame, keys: Sequence[str], row: str = "row") -> DataFrame:
    """Box and number of rows of each block."""
    return tokens.groupBy(*keys).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("r").alias("x1"), F.max("b").alias("y1"), F.count_distinct(row).alias("rows"))


def block_flags(n_rows: Column, n_cuts: Column) -> Column:
    return joined_flags(("unverified_geometry", F.lit(True)), ("no_stable_columns", n_cuts == 0), ("short_block", n_rows < 3))


def assign_tokens(tokens: DataFrame, placed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every token, those without a place as well, with the place's columns."""
    return tokens.join(placed.select(*keys, *columns), list(keys), "left")
