"""Files by path and by name: nothing that exists is lost, nothing unlisted is opened."""

import os

import pytest
from pyspark.sql import functions as F
from test_operators import HEADER, TEXT, page, word

from gridloom.plans import grid
from gridloom.sources import files, pages, tsv
from gridloom.sources import registry as sources
from gridloom.streaming.pages import word_stream


def test_listed_paths_lead_anywhere(spark, tmp_path):
    root, far = tmp_path / "root", tmp_path / "far"
    for folder in (root / "in", far):
        folder.mkdir(parents=True)
    for path in (root / "a.txt", root / "_b.txt", root / ".c.txt", root / "in" / "d.txt", far / "e.txt", far / "f g+%.txt"):
        path.write_text("﻿" + path.name, encoding="utf-8")
    (root / "folder.txt").mkdir()
    (far / "bad.txt").write_bytes(b"a\xff")
    names = ["a.txt", "./_b.txt", ".c.txt", "in/../in/d.txt", "../far/e.txt", str(far / "f g+%.txt"), f"file://{far}/e.txt", "folder.txt", "none.txt", "a.txt", str(far / "bad.txt")]
    work = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "path string, seq long").withColumn("path", sources.normal_path(F.col("path")))
    got = {r.seq: (r.found, r.full_text, r.error) for r in sources.read_texts(spark, work, str(root)).collect()}
    assert got == {i: (True, t, None) for i, t in enumerate(["a.txt", "_b.txt", ".c.txt", "d.txt", "e.txt", "f g+%.txt", "e.txt"])} | {7: (False, None, None), 8: (False, None, None), 9: (True, "a.txt", None), 10: (True, "a�", None)}


def test_only_listed_files_are_opened(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("a")
    (tmp_path / "other.txt").write_text("b")
    opened, plain = tmp_path / "opened", files.content

    def noted(path):
        with open(opened, "a") as f:
            f.write(path + "\n")
        if path.endswith("a.txt"):
            return plain(path)
        raise PermissionError("no right to read")

    monkeypatch.setattr(files, "content", noted)
    work = spark.createDataFrame([("a.txt", 0), ("b.txt", 1)], "path string, seq long")
    got = {r.path: (r.found, r.full_text, r.error) for r in sources.read_texts(spark, work, str(tmp_path)).collect()}
    assert got == {"a.txt": (True, "a", None), "b.txt": (True, None, "ошибка чтения: no right to read")}
    assert {os.path.basename(p) for p in opened.read_text().split()} == {"a.txt", "b.txt"}


def test_folders_are_found_by_name(spark, tmp_path, monkeypatch):
    for folder in ("_doc", ".doc", "doc", "a/b/c d"):
        page(tmp_path / folder, "page0001_result.tsv", [word(1, 1, "w")])
        page(tmp_path / folder, "page1_result.txt", [])
    os.symlink(tmp_path, tmp_path / "doc" / "again")
    (tmp_path / "control").mkdir()
    (tmp_path / "_doc" / "control").mkdir()
    (tmp_path / "_doc" / "control" / "page0007_prepared.png").write_bytes(b"no image")

    def refused(path):
        raise AssertionError("a file was opened")

    monkeypatch.setattr(files, "content", refused)
    assert sorted(os.path.relpath(r.folder, tmp_path) for r in tsv.page_folders(spark, str(tmp_path)).collect()) == [".doc", "_doc", "a/b/c d", "doc"]
    assert [(r.document, r.page, r.image) for r in sources.page_images(spark, str(tmp_path)).collect()] == [("_doc", 7, str(tmp_path / "_doc/control/page0007_prepared.png"))]
    assert tsv.page_folders(spark, str(tmp_path / "none")).count() == 0
    monkeypatch.undo()
    assert sorted(r.document for r in grid.grid_tables(spark, str(tmp_path))["tokens"].collect()) == [".doc", "_doc", "c d", "doc"]


def test_a_file_that_cannot_be_read_is_a_review_row(spark, tmp_path, monkeypatch):
    plain = files.content

    def failing(path):
        if "page0002" in path:
            raise OSError("broken disk")
        return plain(path)

    for n in (1, 2):
        page(tmp_path / "doc", f"page000{n}_result.tsv", [word(1, 1, "w")])
    monkeypatch.setattr(files, "content", failing)
    words = tsv.read_words(spark, str(tmp_path))
    assert [(r.page, r.code, r.detail) for r in words.review.collect()] == [(2, "tsv_error", "broken disk")]
    assert [r.page for r in words.tokens.collect()] == [1] and [r.page for r in words.pages.collect()] == [1]


def test_page_source(spark, tmp_path):
    for i in range(7):
        page(tmp_path / f"_d{i % 3}", f"page{i}_result.tsv", [word(1, 1, f"w{i}")])
    spark.dataSource.register(pages.PageSource)
    df = spark.read.format("gridloom_pages").option("group", 1).load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 7 and sorted(r.name for r in df.collect()) == [f"page{i}_result.tsv" for i in range(7)]
    assert sorted(r.text for r in tsv.parsed_words(tsv.with_uid(df)).tokens.collect()) == [f"w{i}" for i in range(7)]
    assert spark.read.format("gridloom_pages").load(str(tmp_path / "none")).count() == 0


def test_page_stream_reads_each_file_once(spark, tmp_path):
    go = lambda: word_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    texts = lambda: sorted(r.text for r in spark.read.parquet(str(tmp_path / "out" / "tokens")).collect())
    page(tmp_path / "in" / "d", "page1_result.tsv", [word(1, 1, "a")])
    page(tmp_path / "in" / "d", "page2_result.tsv", [word(1, 1, "b")], header=["other"])
    go()
    assert texts() == ["a"]
    go()
    page(tmp_path / "in" / "d", "page3_result.tsv", [word(1, 1, "c")])
    os.utime(tmp_path / "in" / "d" / "page3_result.tsv", (1, 1))
    go()
    assert texts() == ["a", "c"] and spark.read.parquet(str(tmp_path / "out" / "review")).count() == 1
