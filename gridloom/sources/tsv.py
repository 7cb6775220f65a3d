"""OCR word tables: one tab-separated file a page, quotes literal, bad lines kept aside.

Folders are found from names alone; the files of pages are opened by path, once for all that is made of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import folder_uid, is_noise, strip
from gridloom.sources.files import ARCHIVE, decoded, listed, opened
from gridloom.sources.store import kept

# The header that every file must have.
HEADER = "level page_num block_num par_num line_num word_num left top width height conf text".split()


@dataclass(frozen=True)
class Words:
    """tokens: a word a row.  pages: a page a row, with its width.  review: rejected pages and lines."""

    tokens: DataFrame
    pages: DataFrame
    review: DataFrame


NAME = r"page.*_result\.tsv"
ARCHIVED = r".*" + ARCHIVE.replace(".", r"\.")
PAGE = ["document", "folder_uid", "page"]


def _files(spark: SparkSession, root: str) -> DataFrame:
    """folder, folder_uid, name and path of all files below a folder that are named like pages or archives of them; none is opened."""
    return with_uid(listed(spark, root, rf"{NAME}|{ARCHIVED}"))


def with_uid(files: DataFrame) -> DataFrame:
    return files.withColumns({"folder_uid": folder_uid(F.col("folder")), "path": F.concat_ws("/", "folder", "name")})


def page_folders(spark: SparkSession, root: str) -> DataFrame:
    """folder and folder_uid of all folders with files named ``page*_result.tsv``, or archives of such, below a folder, each once; no file is opened."""
    return _files(spark, root).select("folder", "folder_uid").distinct()


def read_words(spark: SparkSession, root: str, folders: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = kept) -> Words:
    """All ``page<digits>_result.tsv`` files below a folder, or of those in ``folders`` (folder_uid); archives (``*.pages.tar.gz``) hold files of their folder.

    A page is named by document (its folder's name), folder_uid and page number.  A file that can't be read, or has another header, is
    one ``tsv_error`` in review; a line that can't be parsed is one ``bad_tsv_line`` there ("line: why").  Lines
    of other levels and words without text are passed over.  token_id is T and the physical line.  ``keep`` stores the
    parsed lines, so each file is opened once.
    """
    files = _files(spark, root)
    if folders is not None:
        files = files.join(folders, "folder_uid", "left_semi")
    wanted = r"\Apage\d+_result\.tsv\z"
    read = opened(files.filter(F.col("name").rlike(rf"{wanted}|\A{ARCHIVED}\z")), "path", decoded, inside="name")
    return parsed_words(read.filter(F.col("name").rlike(wanted) | (F.col("name") == "")), keep)


def parsed_words(files: DataFrame, keep: Callable[[DataFrame], DataFrame] = kept) -> Words:
    """Words, pages and review of files: folder, folder_uid, name, value (the whole text) and error."""
    files = keep(files.select(
        F.element_at(F.split("folder", "/"), -1).alias("document"), "folder_uid", F.regexp_extract("name", r"\d+", 0).try_cast("long").alias("page"), "error",
        F.split(F.regexp_replace(F.coalesce("value", F.lit("")), r"\A\x{FEFF}|(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n").alias("lines"),
    ))
    page = PAGE
    right = F.col("error").isNull() & (F.slice(F.split(F.element_at("lines", 1), "\t"), 1, 12) == F.array(*[F.lit(x) for x in HEADER]))
    broken = files.filter(~right).select(*page, F.lit("").alias("block"), F.lit("tsv_error").alias("code"), F.coalesce("error", F.lit("unknown TSV header")).alias("detail"))

    lines = files.filter(right).select(*page, F.posexplode("lines").alias("at", "line")).filter("at > 0")
    parts = lines.select(*page, (F.col("at") + 1).alias("line_no"), F.split("line", "\t", 12).alias("p"))
    field = lambda i: strip(F.get("p", F.lit(i)))
    parsed = parts.select(
        *page, "line_no", F.size("p").alias("fields"),
        *[F.when(field(i).rlike(r"\A[+-]?\d+\z"), field(i).try_cast("long")).alias(n) for i, n in ((0, "level"), (6, "x"), (7, "y"), (8, "w"), (9, "h"))],
        F.when(~field(10).rlike(r"(?i)[df]\z"), field(10).try_cast("double")).alias("conf"),
        strip(F.get("p", F.lit(11))).alias("text"),
    )
    missing = F.array_join(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("level", "x", "y", "w", "h", "conf")]), lambda c: c.isNotNull()), ", ")
    why = F.when(F.col("fields") < 12, "fewer than 12 fields").when(missing != "", F.concat(F.lit("not a number: "), missing))
    parsed = parsed.withColumn("why", why)
    bad = parsed.filter("why is not null").select(*page, F.lit("").alias("block"), F.lit("bad_tsv_line").alias("code"), F.concat_ws(": ", F.col("line_no").cast("string"), "why").alias("detail"))
    good = parsed.filter("why is null")
    tokens = good.filter((F.col("level") == 5) & (F.col("text") != "")).select(*page, F.col("line_no").alias("seq"), F.concat(F.lit("T"), "line_no").alias("token_id"), *box_columns(), "conf", "text")
    tokens = tokens.withColumn("noise", is_noise(F.col("text")))
    extent = page_extent(good.filter((F.col("level") == 1) | (F.col("text") != "")).select(*page, "level", *box_columns()), page)
    pages = files.filter(right).select(*page).join(extent, page, "left").fillna(1, ["width", "height"])
    return Words(tokens, pages, broken.unionByName(bad))


def page_extent(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """width and height of each page: as far as its own line (level 1) or its words (level 5) reach; without words 1 at least."""
    reach = lambda level, c: F.max(F.when(F.col("level") == level, F.col(c)))
    far = lambda c: F.greatest(F.coalesce(reach(1, c), F.lit(0)), F.coalesce(reach(5, c), F.lit(1)))
    return lines.filter(F.col("level").isin(1, 5)).groupBy(*keys).agg(far("r").alias("width"), far("b").alias("height"))


def box_columns() -> list:
    """x, y, w, h with the right and lower edges and the vertical centre."""
    return ["x", "y", "w", "h", (F.col("x") + F.col("w")).alias("r"), (F.col("y") + F.col("h")).alias("b"), (F.col("y") + F.col("h") / F.lit(2.0)).alias("cy")]
