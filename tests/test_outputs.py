"""Overlays and workbooks, read back."""

import os
import random
import struct
import zipfile
import zlib
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import page, word

from gridloom import cli
from gridloom.operators.routing import numbered
from gridloom.plans import grid
from gridloom.sources import overlay, sinks
from gridloom.sources.store import Scratch, kept, shared_dir

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def png(pixels, colour, depth, kinds=(0,), palette=None):
    """A PNG file of samples (height, width, channels), each row filtered as the next of ``kinds`` says."""
    h, w, n = pixels.shape
    bits = np.unpackbits(pixels.astype(">u2").view(np.uint8).reshape(h, w, n, 2), axis=3)[..., 16 - depth :].reshape(h, -1)
    rows = np.packbits(bits, axis=1).astype(int)
    step, above, out = max(1, depth * n // 8), np.zeros(rows.shape[1], int), b""
    for y, row in enumerate(rows):
        kind, left, corner = kinds[y % len(kinds)], np.zeros_like(row), np.zeros_like(row)
        left[step:], corner[step:] = row[:-step], above[:-step]
        p = left + above - corner
        near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        out += bytes([kind]) + ((row - [0 * row, left, above, (left + above) // 2, near][kind]) % 256).astype(np.uint8).tobytes()
        above = row
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    data = zlib.compress(out)
    plte = chunk(b"PLTE", palette.tobytes()) if palette is not None else b""
    return overlay.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)) + plte + chunk(b"IDAT", data[:9]) + chunk(b"IDAT", data[9:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize(("colour", "depth"), [(0, 1), (0, 2), (0, 4), (0, 8), (0, 16), (2, 8), (2, 16), (3, 1), (3, 4), (3, 8), (4, 8), (6, 8), (6, 16)])
def test_png_of_all_kinds(colour, depth):
    rng = np.random.default_rng(depth)
    n = overlay.CHANNELS[colour]
    pixels = rng.integers(0, 1 << depth, (9, 13, n))
    palette = rng.integers(0, 256, (1 << depth, 3), dtype=np.uint8) if colour == 3 else None
    got = overlay.read_png(png(pixels, colour, depth, (0, 1, 2, 3, 4), palette))
    eight = pixels >> 8 if depth == 16 else pixels * 255 // ((1 << depth) - 1)
    want = palette[pixels[..., 0]] if colour == 3 else np.repeat(eight[..., :1], 3, axis=2) if n < 3 else eight[..., :3]
    assert (got == want).all()
    assert (overlay.read_png(overlay.write_png(got)) == got).all()


def test_bad_png():
    good = png(np.zeros((4, 4, 1), int), 0, 8)
    rng = random.Random(1)
    for _ in range(500):
        bad = bytearray(good)
        bad[rng.randrange(len(bad))] ^= 1 << rng.randrange(8)
        try:
            overlay.read_png(bytes(bad[: rng.randint(0, len(bad))]))
        except (ValueError, zlib.error, struct.error):
            pass


def test_shapes_are_drawn():
    pixels = np.full((20, 30, 3), 255, np.uint8)
    overlay.draw(pixels, [("blue", 2, 2, 3, 12, 10), ("red", 3, 20, -5, 20, 50), ("green", 2, 25, 15, 99, 15), ("orange", 1, -9, -9, -1, -1)])
    want = np.full((20, 30, 3), 255, np.uint8)
    want[3:11, 2:13] = (0, 0, 255)
    want[5:9, 4:11] = 255
    want[:, 19:22] = (255, 0, 0)
    want[15:17, 25:] = (0, 128, 0)
    assert (pixels == want).all()
    assert overlay.shrunk(np.zeros((3001, 10, 3), np.uint8)).shape == (3000, 10, 3) and (overlay.shrunk(np.full((40, 4400, 3), 7, np.uint8)) == 7).all()


def test_a_run_with_overlays_and_workbooks(spark, tmp_path):
    lines = [word(10 + 200 * (i % 2), 20 + 50 * (i // 2), f"w{i}", w=60) for i in range(6)]
    for name in ("page0001_result.tsv", "page0002_result.tsv", "page0003_result.tsv"):
        page(tmp_path / "_doc", name, lines)
    control = tmp_path / "_doc" / "control"
    control.mkdir()
    (control / "page0001_prepared.png").write_bytes(png(np.full((300, 400, 1), 255), 0, 8))
    (control / "page0002_prepared.png").write_bytes(b"no image")
    out = str(tmp_path / "out")
    assert cli.main(["grid", str(tmp_path / "_doc"), "--outdir", out, "--overlays", "--workbooks"]) == 0
    got = grid.read_grid(spark, out)
    summary = got["run_summary"].first()
    assert [(r.page, r.detail) for r in got["review"].filter("code = 'overlay_error'").collect()] == [("2", "not a PNG file")]
    drawn = overlay.read_png((tmp_path / "out" / "overlays" / f"run={summary.run}" / summary.folder_uid / "page0001_overlay.png").read_bytes())
    # a block from (10, 20) to (270, 152), a cut at 140, a row at 36, words with an edge
    assert drawn.shape == (300, 400, 3) and tuple(drawn[22, 30]) == (0, 0, 255) and tuple(drawn[60, 140]) == (255, 0, 0)
    assert tuple(drawn[36, 120]) == (0, 128, 0) and tuple(drawn[102, 60]) == (255, 165, 0) and tuple(drawn[290, 390]) == (255, 255, 255)
    assert not list((tmp_path / "out" / "overlays").rglob("page0003*"))
    books = sorted(p.name for p in (tmp_path / "out" / "workbooks").rglob("*.xlsx"))
    assert books == [f"{n}_0001.xlsx" for n in sorted(grid.TABLES)]


def rows_of(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None
        for part in z.namelist():
            if not part.startswith("xl/worksheets"):
                ElementTree.fromstring(z.read(part))
        name = ElementTree.fromstring(z.read("xl/workbook.xml")).find(f".//{NS}sheet").get("name")
        root = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
    assert root.find(f".//{NS}pane").get("topLeftCell") == "F2"
    value = lambda c: None if not len(c) else c.find(f".//{NS}t").text or "" if c.get("t") == "inlineStr" else float(c.find(f"{NS}v").text)
    return name, [[value(c) for c in row] for row in root.iter(f"{NS}row")]


def test_sheets_roll_over(spark, tmp_path):
    text = F.when(F.col("id") == 3, F.lit("=1+1 <&> \x01￾ \r\nя")).when(F.col("id") == 4, F.lit(None)).otherwise(F.lit(" s "))
    df = spark.range(25).select((24 - F.col("id")).alias("id"), text.alias("a&b"), (F.col("id") / 2).alias("x"), (F.col("id") == 1).alias("flag"), F.array("id").alias("many"))
    files = {r.sheet_no: (r.file, r.rows) for r in sinks.write_workbooks(df, str(tmp_path), "t", "id", 10).collect()}
    assert {k: v[1] for k, v in files.items()} == {1: 10, 2: 10, 3: 5}
    found = [rows_of(files[i][0]) for i in (1, 2, 3)]
    assert [n for n, _ in found] == ["t", "t_2", "t_3"] and all(r[0] == ["id", "a&b", "x", "flag", "many"] for _, r in found)
    rows = [row for _, own in found for row in own[1:]]
    assert [row[0] for row in rows] == list(range(25)) and rows[21] == [21.0, "=1+1 <&> � \r\nя", 1.5, 0.0, "[3]"] and rows[20][1] is None and rows[23][1:4] == [" s ", 0.5, 1.0]
    assert [r.rows for r in sinks.write_workbooks(df.limit(0), str(tmp_path / "none"), "t", "id").collect()] == [0]
    assert rows_of(tmp_path / "none" / "t_0001.xlsx")[1] == [["id", "a&b", "x", "flag", "many"]]


def test_two_million_rows_give_three_sheets(spark, tmp_path):
    files = sinks.write_workbooks(spark.range(2_000_000).select("id"), str(tmp_path), "big", "id").collect()
    assert {r.sheet_no: r.rows for r in files} == {1: 999_999, 2: 999_999, 3: 2}
    for r in files:
        with zipfile.ZipFile(r.file) as z, z.open("xl/worksheets/sheet1.xml") as f:
            assert sum(1 for _, e in ElementTree.iterparse(f) if e.tag == f"{NS}row" and not e.clear()) == r.rows + 1


def test_each_csv_file_begins_with_a_mark(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 2).alias("by"), F.concat(F.lit('п "'), F.col("id").cast("string"), F.lit("\n;")).alias("имя"), "id").repartition(3)
    sinks.write_csv(rows, str(tmp_path / "whole"))
    sinks.write_parts(rows, str(tmp_path / "parts"), "by")
    files = [*(tmp_path / "whole").glob("part-*.csv"), *(tmp_path / "parts").glob("by=*/part-*.csv")]
    assert len(files) >= 4 and all(f.read_bytes().startswith(b"\xef\xbb\xbf") for f in files)
    back = sinks.read_parts(spark, str(tmp_path / "parts"), ("by",))
    assert set(back.columns) == {"имя", "id", "by"}
    assert {(r["by"], r["имя"], r["id"]) for r in back.collect()} == {(str(i % 2), f'п "{i}\n;', str(i)) for i in range(40)}
    sinks.write_csv(rows.limit(0), str(tmp_path / "none"))


def test_a_scratch_removes_what_operators_store(spark, tmp_path):
    def names():
        return {x for x in os.listdir(shared_dir(spark).removeprefix("file://")) if x.startswith(("kept-", "numbered-"))}

    before = names()
    with Scratch(spark) as outer:
        with Scratch(spark):
            numbered(outer.keep(spark.range(10)), "id").write.parquet(str(tmp_path / "out"))
            assert len(names() - before) == 2
        table = kept(spark.range(3))
        assert table.count() == 3
    assert names() == before
    assert [r.no for r in spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()] == list(range(1, 11))
