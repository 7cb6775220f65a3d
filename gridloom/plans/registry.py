"""A work-list of documents to routed records and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.fields import extract_fields
from gridloom.operators.routing import final_report, numbered, remaining, routed, run_counts
from gridloom.params import RegistryParams
from gridloom.sources.registry import cached_records, read_texts, read_worklist
from gridloom.sources.sinks import append_results, write_csv
from gridloom.sources.store import Scratch

# Headings of the final report, by field.
REPORT = {
    "no": "№ п/п", "loaded_on": "дата загрузки", "cadastral_no": "кадастровый номер", "address": "Адрес помещения (ул, б-р, дом)", "object_no": "номер объекта",
    "area": "площадь", "floor": "этаж", "ownership_date": "дата собственности", "registration_no": "номер регистрации права", "right_type": "вид права",
    "kind": "вид объекта", "purpose": "назначение", "name": "наименование", "extract_date": "дата получения ЕГРН", "house_cadastral_no": "кадастровый номер дома",
    "path": "файл", "error": "ошибка",
}


def extract_records(texts: DataFrame, params: RegistryParams = RegistryParams()) -> DataFrame:
    """path, seq, error and full_text to fields, status and reason, with the day of loading."""
    today = F.date_format(F.current_date(), "dd.MM.yyyy") if params.loaded_on is None else F.lit(params.loaded_on)
    return routed(extract_fields(texts, strict_units=params.strict_units)).drop("full_text").withColumn("loaded_on", today)


#: Heading of a field in the result caches, where it isn't that of the report.
CACHE_HEADINGS = {f: h for f, h in REPORT.items() if f not in ("no", "path", "error", "address")} | {"address": "адрес"}


def stored_results(spark: SparkSession, results: str) -> DataFrame | None:
    """All records stored so far; none before the first."""
    try:
        return spark.read.parquet(results)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def import_caches(spark: SparkSession, caches: Sequence[str], results: str) -> None:
    """Store the records of result caches that ``results`` doesn't have, before those of all runs, in the order of their files."""
    found = cached_records(spark, caches, CACHE_HEADINGS).withColumns({"seq": F.monotonically_increasing_id(), "run": F.lit(0), "portion": F.lit(0)})
    known = stored_results(spark, results)
    fresh = found if known is None else remaining(found, known)
    if not fresh.isEmpty():
        append_results(fresh, results)


def run_registry(spark: SparkSession, worklist: str, root: str, results: str, params: RegistryParams = RegistryParams(), caches: Sequence[str] = ()) -> DataFrame:
    """Handle what the results and ``caches`` don't have yet, append it, and count all results by status.

    Skipped and failed documents are done as well.  The work is done in portions of ``params.portion`` documents; each is stored when it
    is whole, so a run that is stopped loses the portion it was in and the next one goes on there.  Records have the number of their run.
    """
    import_caches(spark, caches, results)
    with Scratch(spark) as scratch:
        work = scratch.keep(read_worklist(spark, worklist, params.sep))
        known = stored_results(spark, results)
        left = work if known is None else remaining(work, known)
        run = 1 if known is None else (known.agg(F.max("run")).first()[0] or 0) + 1
        # numbers of portions follow the order of the list; one of so many rows, whatever its length
        left = scratch.keep(numbered(left, "seq", "_no").withColumn("portion", F.floor((F.col("_no") - 1) / params.portion).cast("int")).drop("_no"))
        portions = left.agg(F.coalesce(F.max("portion") + 1, F.lit(0))).first()[0]
        for portion in range(portions):
            records = extract_records(read_texts(spark, left.filter(F.col("portion") == portion), root), params)
            append_results(records.withColumns({"run": F.lit(run), "portion": F.lit(portion)}), results)
    stored = stored_results(spark, results)
    return run_counts(stored) if stored is not None else spark.createDataFrame([], "status string, n long")


def run_and_report(spark: SparkSession, worklist: str, root: str, results: str, out: str, skipped_out: str, params: RegistryParams = RegistryParams(), caches: Sequence[str] = ()) -> DataFrame:
    """``run_registry``, and reports of what is stored, however the run ends: they are also rebuilt when it is stopped or fails."""
    try:
        counts = run_registry(spark, worklist, root, results, params, caches)
    finally:
        stored = stored_results(spark, results)
        if stored is not None:
            with Scratch(spark):
                report, skipped = reports(stored)
                write_csv(report, out)
                write_csv(skipped, skipped_out)
    return counts


def reports(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The final report (numbered successes in the order of runs and of their work-lists, then errors) and the skipped documents with their reasons."""
    fields = [c for c in REPORT if c not in ("no", "error")]
    order = F.struct("run", "portion", "seq", "path")
    success = results.filter("status = 'success'").withColumn("_order", order).select("_order", *fields, F.lit("").alias("error"))
    errors = results.filter("status = 'errors'").select(*[(F.col(c) if c == "path" else F.lit("")).alias(c) for c in fields], "error")
    report = final_report(success, errors, "_order")
    return report.select(*[F.col(k).alias(v) for k, v in REPORT.items()]), results.filter("status = 'skipped'").select(F.col("path").alias("файл"), F.col("reason").alias("причина"))
