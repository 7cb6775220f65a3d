"""Folders of word tables to blocks, cells, tokens and a review list."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import cells as C
from gridloom.operators import layout as L
from gridloom.params import GridParams
from gridloom.sources import sinks
from gridloom.sources.overlay import write_overlays
from gridloom.sources.registry import page_images
from gridloom.sources.store import Scratch, kept, versions
from gridloom.sources.tsv import PAGE, Words, page_folders, read_words

#: The tables of a run.
TABLES = ("blocks", "tokens", "review", "grid_wide", "grid_long")
#: What the rows of their workbooks are ordered by.
ORDER = {
    "blocks": [*PAGE, "block"], "tokens": [*PAGE, "token_id"], "review": [*PAGE, "block", "code", "detail"],
    "grid_wide": [*PAGE, "block", "row_no"], "grid_long": [*PAGE, "block", "row_no", "column"],
}


def grid_tables(spark: SparkSession, root: str, params: GridParams = GridParams(), folders: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = kept) -> dict[str, DataFrame]:
    """The tables of all pages below a folder, or of those in ``folders`` (folder_uid), failures (folder_uid, error) and rows (their centres and blocks' edges).

    Files are opened and rows found once; all tables come from what ``keep`` has stored then.  A folder with a page that fails has
    no rows but the one in failures.
    """
    words = read_words(spark, root, folders, keep)
    return tables_of(words, params, keep)


def tables_of(words: Words, params: GridParams = GridParams(), keep: Callable[[DataFrame], DataFrame] = kept) -> dict[str, DataFrame]:
    """The tables of words, pages and review; see ``grid_tables``."""
    block = [*PAGE, "block"]
    found = keep(L.find_rows(words.tokens, PAGE, params.row_tolerance))
    failures = keep(found.filter("problem is not null").groupBy("folder_uid").agg(F.min("problem").alias("error")))
    fine = lambda df: df.join(failures, "folder_uid", "left_anti")
    placed = keep(L.find_blocks(fine(found.drop("problem")), PAGE, params.block_gap))
    name = F.format_string("P%04dB%03d", "page", "block_no")
    placed = placed.withColumn("block", name)
    boxes = C.block_boxes(placed, block, "row_no")
    if params.column_cuts:
        cuts = boxes.join(words.pages, PAGE).select(*block, L.manual_cuts(F.col("width"), params.column_cuts).alias("cuts"))
    else:
        segments = L.gutter_segments(placed, block, "row_no", params.support, F.col("typical"))
        typical = placed.groupBy(*block).agg(F.max("typical").alias("typical"))
        runs = L.merge_segments(segments.join(typical, block), [*block, "typical"], params.max_cols, F.col("typical"))
        cuts = L.cut_arrays(runs, block)
    none = F.coalesce("cuts", F.expr("cast(array() as array<double>)"))
    boxes = boxes.join(cuts, block, "left").withColumn("cuts", none)
    blocks = boxes.withColumns({"columns": F.size("cuts") + 1, "mode": F.lit("manual" if params.column_cuts else "auto_gutters"), "flags": C.block_flags(F.col("rows"), F.size("cuts"))})
    slotted = L.to_columns(placed.join(boxes.select(*block, "cuts"), block))
    long = C.cells(slotted, block, "row_no", params.review_conf)
    centres = placed.groupBy(*block, "row_no").agg(F.bround(F.first("row_cy"), 1).alias("y"))
    wide = C.wide_grid(long, [*block, "row_no"]).join(centres, [*block, "row_no"]).join(C.row_flags(slotted, [*block, "row_no"]), [*block, "row_no"])
    lines = placed.groupBy(*block, "row_no").agg(F.first("row_cy").alias("cy")).join(boxes.select(*block, "x0", "x1"), block)
    tokens = C.assign_tokens(fine(words.tokens), slotted, [*PAGE, "token_id"], ["block", "row_no", "column"])
    return {
        "blocks": blocks, "grid_long": long.withColumn("column", C.slot_name(F.col("column"))), "grid_wide": wide,
        "tokens": tokens, "failures": failures, "rows": lines, "review": fine(words.review).unionByName(C.hypotheses(blocks, block)),
    }


def page_counts(tables: dict[str, DataFrame], keys: Sequence[str] = PAGE) -> DataFrame:
    """Tokens, rows and blocks of each page."""
    return tables["tokens"].groupBy(*keys).agg(F.count(F.lit(1)).alias("tokens"), F.count_distinct("block", "row_no").alias("rows"), F.count_distinct("block").alias("blocks"))


SUMMARY = "folder string, folder_uid string, status string, output string, error string, run string"


def last_summary(spark: SparkSession, out: str) -> tuple[DataFrame, int]:
    """The latest finished summary below ``out`` and its version; an empty one and 0 before the first."""
    known = versions(spark, f"{out}/summary")
    if not known:
        return spark.createDataFrame([], SUMMARY), 0
    return spark.read.schema(SUMMARY).parquet(f"{out}/summary/v={known[-1]:08d}"), known[-1]


def read_grid(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables below ``out`` and run_summary, as the latest finished run left them: of each folder the rows of the run that the summary names."""
    summary, _ = last_summary(spark, out)
    chosen = summary.filter("run is not null").select("run", "folder_uid")
    return {n: sinks.read_parts(spark, f"{out}/{n}", ("run", "folder_uid")).join(chosen, ["run", "folder_uid"], "left_semi") for n in TABLES} | {"run_summary": summary}


def run_grid(spark: SparkSession, root: str, out: str, params: GridParams = GridParams()) -> DataFrame:
    """Write the tables of all folders below ``root`` and return run_summary: folder, folder_uid, status, output, error, run.

    A folder that an earlier run has finished is cached, unless ``overwrite`` is set.  All others are handled in one pass: a folder that
    fails says so in its own task and has the status error, with the whole traceback, the others are ok.  Rows go to
    ``<table>/run=<run>/folder_uid=<uid>`` and stay unseen until the last step, one new version of the summary, which is also the manifest that
    ``read_grid`` follows.  A run that ends before leaves the result as it was.  ``params`` may ask for workbooks
    and overlays of the run as well; an image that can't be drawn on is a row of review.  Fails if there is no page below ``root``.
    """
    with Scratch(spark) as scratch:
        found = scratch.keep(page_folders(spark, root))
        if found.isEmpty():
            raise ValueError(f"no page<digits>_result.tsv below {root}")
        last, version = last_summary(spark, out)
        done = last.filter(F.col("status").isin("ok", "cached") & F.lit(not params.overwrite)).select("folder_uid", "output", "run")
        todo = scratch.keep(found.join(done, "folder_uid", "left_anti"))
        run = f"{version + 1:08d}-{uuid.uuid4().hex[:8]}"
        tables = grid_tables(spark, root, params, todo.select("folder_uid"), scratch.keep)
        if params.overlays:
            shapes = sinks.overlay_shapes(tables["blocks"], tables["rows"], tables["tokens"], PAGE)
            drawn = scratch.keep(write_overlays(shapes, page_images(spark, root), PAGE, f"{out}/overlays/run={run}"))
            issues = drawn.filter("error is not null").select(*PAGE, F.lit("").alias("block"), F.lit("overlay_error").alias("code"), F.col("error").alias("detail"))
            tables["review"] = tables["review"].unionByName(issues)
        if params.workbooks:
            for name in TABLES:
                sinks.write_workbooks(tables[name], f"{out}/workbooks/run={run}", name, F.struct(*ORDER[name]))
        for name in TABLES:
            sinks.write_parts(tables[name], f"{out}/{name}/run={run}", "folder_uid")
        columns = [c.split()[0] for c in SUMMARY.split(", ")]
        cached = found.join(done, "folder_uid").withColumns({"status": F.lit("cached"), "error": F.lit("")})
        place = F.concat(F.lit(f"{out}/*/run={run}/folder_uid="), "folder_uid")
        judged = todo.join(tables["failures"], "folder_uid", "left")
        bad = F.col("error").isNotNull()
        new = judged.select("folder", "folder_uid", F.when(bad, "error").otherwise("ok").alias("status"), place.alias("output"), F.coalesce("error", F.lit("")).alias("error"), F.when(~bad, F.lit(run)).alias("run"))
        # folders of other roots stay as they are
        others = last.join(found, "folder_uid", "left_anti")
        sinks.write_settings(spark, f"{out}/settings", root, params.__dict__)
        path = f"{out}/summary/v={version + 1:08d}"
        cached.select(*columns).unionByName(new).unionByName(others).write.mode("overwrite").parquet(path)
    return spark.read.schema(SUMMARY).parquet(path)
