"""Work-lists, result caches and document texts of the registry pipeline."""

from __future__ import annotations

import io
import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import strip
from gridloom.sources.files import decoded, listed, local, opened

# Column names of the work-list and the caches; what stands before the cause of an error.
PATH, FILE, REASON, ERROR = "путь", "файл", "причина", "ошибка"
READ_ERROR = "ошибка чтения: "
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def normal_path(c):
    """``./a//b/`` as ``a/b``."""
    c = F.regexp_replace(F.regexp_replace(c, r"/+", "/"), r"(?<=/)(\./)+|\A(\./)+(?=.)", "")
    return F.regexp_replace(c, r"(?<=.)/\z|(?<=/)\.\z", "")


def read_worklist(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """path and seq of a CSV file's column of paths; blank ones are dropped, repeated ones kept."""
    rows = spark.read.csv(path, sep=sep, **_CSV)
    names = {c.lstrip("\ufeff"): c for c in rows.columns}
    if PATH not in names:
        raise ValueError(f"the CSV has no column {PATH}; found: {rows.columns}")
    return rows.select(strip(F.col(f"`{names[PATH]}`")).alias("path")).filter("path <> ''").select(normal_path(F.col("path")).alias("path"), F.monotonically_increasing_id().alias("seq"))


def read_caches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Distinct paths of all result caches that exist, under either column name."""
    return cached_records(spark, paths).select("path").distinct()


#: The columns of records that caches have, besides the fields of ``headings``.
CACHED = ("path", "status", "reason", "error")


def cached_records(spark: SparkSession, paths: Sequence[str], headings: dict[str, str] | None = None) -> DataFrame:
    """The records in result caches (CSV files): path, status, reason, error and the fields that ``headings`` names in the files.

    A cache with reasons has skipped documents, one with errors has failed ones, any other has successes.  Files that aren't there are passed over,
    as are rows without a path.
    """
    headings = headings or {}
    out = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*CACHED, *headings)))
    for path in paths:
        try:
            rows = spark.read.csv(path, **_CSV)
        except AnalysisException as e:  # a cache that isn't there yet is empty
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            continue
        names = {c.lstrip("\ufeff"): F.col(f"`{c}`") for c in rows.columns}
        if not {PATH, FILE} & set(names):
            continue
        status = "skipped" if REASON in names else "errors" if ERROR in names else "success"
        key = F.coalesce(*[F.when(names[c] != "", names[c]) for c in (PATH, FILE) if c in names])
        none = F.lit("")
        fields = [F.coalesce(names.get(h, none), none).alias(f) for f, h in headings.items()]
        bad = names.get(ERROR, F.lit(None)) if status == "errors" else F.lit(None)
        out = out.unionByName(rows.select(key.alias("path"), F.lit(status).alias("status"), F.coalesce(names.get(REASON, none), none).alias("reason"), bad.cast("string").alias("error"), *fields))
    return out.filter("path <> ''")


def text_of(data: bytes) -> str:
    """A text file as it is; a PDF page by page, joined by line feeds, which needs the optional pdfplumber."""
    if data[:5] != b"%PDF-":
        return decoded(data)
    import pdfplumber

    with pdfplumber.open(io.BytesIO(data)) as pdf:
        return "\n".join(p.extract_text() or "" for p in pdf.pages)


def read_texts(spark: SparkSession, worklist: DataFrame, root: str = ".") -> DataFrame:
    """path, seq, found, full_text and error of each listed file, opened by its path; relative ones lie below ``root``.

    Paths may lead anywhere, have ``..`` or names that begin with _ or .; nothing that isn't listed is opened.  A file that isn't
    there isn't found and has neither text nor error.
    """
    top = os.path.abspath(local(root)) if local(root) is not None else root
    whole = F.col("path").rlike(r"\A(/|[A-Za-z][A-Za-z0-9+.-]+:/)")
    wanted = worklist.select("path", "seq", F.when(whole, F.col("path")).otherwise(F.concat(F.lit(top.rstrip("/") + "/"), "path")).alias("_full"))
    out = opened(wanted, "_full", text_of, "full_text")
    return out.select("path", "seq", "found", "full_text", F.concat(F.lit(READ_ERROR), "error").alias("error"))


def page_images(spark: SparkSession, root: str) -> DataFrame:
    """folder, document (its name), page and path of prepared page images (``control/page<4 digits>_prepared.png``), found by name."""
    form = r"page(\d{4,})_prepared\.png"
    files = listed(spark, root, form).filter(F.col("folder").rlike(r"/control\z"))
    folder = F.regexp_replace("folder", r"/control\z", "")
    return files.select(folder.alias("folder"), F.element_at(F.split(folder, "/"), -1).alias("document"), F.regexp_extract("name", form, 1).cast("long").alias("page"), F.concat_ws("/", "folder", "name").alias("image"))
