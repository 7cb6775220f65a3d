"""Page files that Spark makes of the events, in archives, and what the library reads from them again."""

from __future__ import annotations

import tarfile
import uuid
from collections.abc import Iterator
from io import BytesIO
from itertools import chain, count, groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.files import ARCHIVE, joined, whole_file
from gridloom.sources.pages import PageSource
from gridloom.sources.store import shared_dir
from gridloom.sources.tsv import HEADER, Words, parsed_words, read_words, with_uid


def event_pages(spark: SparkSession, d: str) -> DataFrame:
    """folder, name and text of a page file for each user and 5,000 event numbers.

    Folders begin with an underscore.  A line is an event; some lack fields, some have no number for a width, some are of another
    level or have no text; the pages of some users have another header.  Pages of one number, one with the other header, are two
    files: that one's name has a zero before the number.
    """
    e = spark.read.parquet(f"{d}/events.parquet").filter("user_id is not null and event_id is not null")
    n = F.col("event_id")
    box = [40 * (n % 20), F.coalesce(F.floor("value"), F.lit(0)).cast("long"), F.when(n % 37 == 0, "x").otherwise((30 + n % 50).cast("string")), F.lit(32)]
    text = F.when(n % 47 == 0, " ").when(n % 53 == 0, "--").otherwise(F.coalesce("event_type", F.lit("")))
    whole = F.concat_ws("\t", F.when(n % 43 == 0, 3).otherwise(5), *[F.lit(1)] * 5, *box, (n % 100).cast("double"), text)
    lines = e.select("user_id", n.alias("n"), F.when(n % 41 == 0, F.lit("5\t1")).otherwise(whole).alias("line"))
    page = F.floor(F.col("user_id") / 16) * 1_000 + F.floor(F.col("n") / 5_000) + 1
    pages = lines.groupBy((F.col("user_id") % 16).alias("g"), page.alias("page"), (F.col("user_id") % 29 == 0).alias("odd")).agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("l"))
    head = F.when(F.col("odd"), "level\ttext").otherwise("\t".join(HEADER))
    extent = "1\t1\t0\t0\t0\t0\t0\t0\t1000\t1400\t-1\t"
    body = F.concat_ws("\n", head, F.lit(extent), F.array_join(F.transform("l", lambda x: x["line"]), "\n"))
    return pages.select(F.concat(F.lit("_f"), "g").alias("folder"), F.concat(F.lit("page"), F.when(F.col("odd"), "0").otherwise(""), "page", F.lit("_result.tsv")).alias("name"), body.alias("text"))


#: Pages of an archive at most.
ARCHIVE_PAGES = 10_000


def written(pages: DataFrame) -> str:
    """The folder that the pages are written to, in archives, by the tasks that have them.

    A file for each page would take a block of the disk and an entry of its file system, of which there are millions, not tens of millions.  A task
    that runs again writes the same archives, as its pages are in order.
    """
    root = f"{shared_dir(pages.sparkSession)}/pages-{uuid.uuid4().hex}"

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in parts for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        task, n = TaskContext.get().partitionId(), 0
        for folder, own in groupby(rows, lambda row: row[0]):
            for k in count():
                some = islice(own, ARCHIVE_PAGES)
                one = next(some, None)
                if one is None:
                    break
                with whole_file(joined(joined(root, folder), f"{task:05d}-{k:05d}{ARCHIVE}")) as f, tarfile.open(fileobj=f, mode="w|gz", compresslevel=3) as archive:
                    for _, name, text in chain([one], some):
                        data = text.encode()
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        archive.addfile(info, BytesIO(data))
                        archive.members.clear()
                        n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    pages.select("folder", "name", "text").sortWithinPartitions("folder", "name").mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return root


def _read(spark: SparkSession, d: str) -> Words:
    return read_words(spark, written(event_pages(spark, d)))


def tsv_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of the written pages, through the data source."""
    spark.dataSource.register(PageSource)
    files = spark.read.format("gridloom_pages").load(written(event_pages(spark, d)))
    return parsed_words(with_uid(files)).tokens.select("document", "page", "token_id", "text", "x", "y", "r", "b", "conf", "noise")


def tsv_pages(spark: SparkSession, d: str) -> DataFrame:
    """Extents of the written pages."""
    return _read(spark, d).pages.select("document", "page", "width", "height")


def tsv_review(spark: SparkSession, d: str) -> DataFrame:
    """Rejected files and lines of the written pages."""
    return _read(spark, d).review.select("document", "page", "code", "detail")


_SQL = r"""
WITH e AS (
  SELECT event_id AS n, '_f' || (user_id % 16) AS document, (user_id // 16) * 1000 + event_id // 5000 + 1 AS page, user_id % 29 = 0 AS odd, coalesce(floor(value), 0)::BIGINT AS y,
    CASE WHEN n % 47 = 0 THEN '' WHEN n % 53 = 0 THEN '--' ELSE trim(coalesce(event_type, '')) END AS text
  FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL),
l AS (SELECT *, row_number() OVER (PARTITION BY document, page, odd ORDER BY n) + 2 AS line, n % 41 = 0 AS few, n % 37 = 0 AS wrong, n % 43 = 0 AS other FROM e),
w AS (SELECT *, 40 * (n % 20) AS x, 40 * (n % 20) + 30 + n % 50 AS r, y + 32 AS b FROM l WHERE NOT (odd OR few OR wrong OR other OR text = ''))"""
QUERIES = {f.__name__: f for f in (tsv_words, tsv_pages, tsv_review)}
ORACLE_SQL = {
    "tsv_words": _SQL + " SELECT document, page, 'T' || line AS token_id, text, x, y, r, b, (n % 100)::DOUBLE AS conf, text = '--' AS noise FROM w",
    "tsv_pages": _SQL + " SELECT l.document, l.page, greatest(1000, coalesce(max(w.r), 1)) AS width, greatest(1400, coalesce(max(w.b), 1)) AS height FROM (SELECT DISTINCT document, page FROM l WHERE NOT odd) l LEFT JOIN w USING (document, page) GROUP BY ALL",
    "tsv_review": _SQL
    + """ SELECT DISTINCT document, page, 'tsv_error' AS code, 'unknown TSV header' AS detail FROM l WHERE odd
UNION ALL SELECT document, page, 'bad_tsv_line', line || ': ' || CASE WHEN few THEN 'fewer than 12 fields' ELSE 'not a number: w' END FROM l WHERE NOT odd AND (few OR wrong)""",
}
