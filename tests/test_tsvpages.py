"""Page files made of events: what happens with many of them."""

import os

import pytest
from compare import both
from pyspark.sql import functions as F

from gridloom.plans import tsvpages
from gridloom.sources import tsv
from gridloom.sources.files import local

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shared_numbers(spark, tmp_path_factory):
    """Events whose numbers go beyond 5,000,000, so users 16 apart have pages of one number, also with different headers."""
    out = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    near = events.withColumn("user_id", F.col("event_id") % 480)
    far = near.withColumn("event_id", F.col("event_id") + 5_000_000)
    near.unionByName(far).toPandas().to_parquet(f"{out}/events.parquet", coerce_timestamps="us")
    return out


def test_pages_of_one_number_with_different_headers(spark, shared_numbers):
    a, b = both(spark, tsvpages.tsv_pages, tsvpages.ORACLE_SQL["tsv_pages"], shared_numbers)
    assert a == b


def test_review_of_pages_of_one_number(spark, shared_numbers):
    a, b = both(spark, tsvpages.tsv_review, tsvpages.ORACLE_SQL["tsv_review"], shared_numbers)
    assert a == b


def test_words_of_pages_of_one_number(spark, shared_numbers):
    a, b = both(spark, tsvpages.tsv_words, tsvpages.ORACLE_SQL["tsv_words"], shared_numbers)
    assert a == b


def test_pages_are_held_in_archives(spark, shared_numbers, monkeypatch):
    """As many files as folders and tasks give, not one for each page; archives of two pages give the same."""
    pages = tsvpages.event_pages(spark, shared_numbers)
    count = lambda root: sum(len(names) for _, _, names in os.walk(local(root)))
    assert count(tsvpages.written(pages)) < pages.count() / 2
    monkeypatch.setattr(tsvpages, "ARCHIVE_PAGES", 2)
    a, b = both(spark, tsvpages.tsv_words, tsvpages.ORACLE_SQL["tsv_words"], shared_numbers)
    assert a == b


def test_an_archive_that_breaks_off_is_a_review_row(spark, tmp_path):
    pages = spark.createDataFrame([("_f1", f"page{i}_result.tsv", "\t".join(tsv.HEADER) + f"\n5\t1\t1\t1\t1\t1\t0\t0\t9\t9\t90\tw{i}") for i in range(2000)], "folder string, name string, text string")
    root = local(tsvpages.written(pages.coalesce(1)))
    (name,) = os.listdir(f"{root}/_f1")
    whole = open(f"{root}/_f1/{name}", "rb").read()
    os.makedirs(tmp_path / "_f1")
    (tmp_path / "_f1" / name).write_bytes(whole[: len(whole) // 2])
    (tmp_path / "_f1" / "page5000_result.tsv").write_text("\t".join(tsv.HEADER))
    words = tsv.read_words(spark, str(tmp_path))
    read = {r.page for r in words.pages.collect()}
    assert 5000 in read and 1 < len(read) < 2001
    assert [(r.document, r.page, r.code) for r in words.review.collect()] == [("_f1", None, "tsv_error")]
    assert {r.document for r in words.tokens.collect()} == {"_f1"}


def test_extents_from_small_archives(spark, shared_numbers, monkeypatch):
    monkeypatch.setattr(tsvpages, "ARCHIVE_PAGES", 3)
    a, b = both(spark, tsvpages.tsv_pages, tsvpages.ORACLE_SQL["tsv_pages"], shared_numbers)
    assert a == b
