"""Writers: tables as CSV or Parquet, sheets of bounded size, append-only results, settings, workbooks, shapes of overlays."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator, Sequence
from itertools import groupby
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import safe_cell
from gridloom.operators.routing import SHEET_ROWS, numbered, sheet_number
from gridloom.sources.files import joined, whole_file
from gridloom.sources.store import kept


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON, nulls as empty text: what CSV can hold."""
    kinds = dict(df.dtypes)
    return df.select(*[(F.to_json(c) if kinds[c][:5] in ("array", "struc", "map<s") else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns])


def marked(df: DataFrame, *apart: str) -> DataFrame:
    """``flat``, with a byte order mark before the first column's name (but those ``apart``), so that each file begins with it."""
    first = next((c for c in df.columns if c not in apart), None)
    return flat(df).withColumnsRenamed({first: "\ufeff" + first} if first else {})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 with a byte order mark and a header; the committer publishes a file set at once and marks it with _SUCCESS."""
    marked(df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_parts(df: DataFrame, path: str, by: str) -> None:
    """CSV as in ``write_csv``, split by a column; only the parts that ``df`` has are replaced."""
    marked(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_parts(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """CSV below a path with the columns ``by`` as its folders ``<column>=<value>`` say, as text; of a table without files these alone."""
    try:
        rows = spark.read.option("recursiveFileLookup", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path, header=True)
    except AnalysisException as e:
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in by))
    rows = rows.withColumnsRenamed({c: c.lstrip("\ufeff") for c in rows.columns})
    return rows.withColumns({c: F.regexp_extract(F.col("_metadata.file_path"), f"/{c}=([^/]+)/", 1) for c in by})


def append_results(records: DataFrame, path: str) -> None:
    """Append rows to a table that is split by status; a run that ends early leaves no part of its rows."""
    records.write.mode("append").partitionBy("status").parquet(path)


def sheets(df: DataFrame, order: str) -> DataFrame:
    """All columns as safe cells, with the number of the sheet that each row goes to."""
    rows = numbered(df, order, "_no").withColumn("sheet_no", sheet_number(F.col("_no")))
    kinds = dict(df.dtypes)
    return rows.select("sheet_no", *[safe_cell(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns])


def write_sheets(df: DataFrame, path: str, order: str) -> None:
    """One folder for each sheet."""
    flat(sheets(df, order)).write.mode("overwrite").partitionBy("sheet_no").option("header", True).csv(path)


def write_settings(spark: SparkSession, path: str, source: str, args: dict) -> None:
    """Source and parameters of a run as one small JSON text file."""
    text = json.dumps({"source": source, "args": {k: str(v) for k, v in args.items()}, "note": "Columns are positional hypotheses."}, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


# The parts of a workbook with one sheet.
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
_RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{kind}" Target="{target}"/></Relationships>'
_BOOK = '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>'
_SHEET = '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane xSplit="5" ySplit="1" topLeftCell="F2" activePane="bottomRight" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>'
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def cell_xml(c: Column, kind: str) -> Column:
    """A spreadsheet cell: numbers as numbers, flags as flags, all else as text that no program takes for a formula; nulls are empty."""
    if kind in _NUMBERS or kind[:7] == "decimal":
        held = c.isNotNull() if kind not in ("float", "double") else c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
        return F.when(held, F.concat(F.lit("<c><v>"), c.cast("string"), F.lit("</v></c>"))).otherwise("<c/>")
    if kind == "boolean":
        return F.when(c.isNotNull(), F.concat(F.lit('<c t="b"><v>'), c.cast("int").cast("string"), F.lit("</v></c>"))).otherwise("<c/>")
    text = safe_cell(c if kind == "string" else F.to_json(c) if kind[:5] in ("array", "struc", "map<s") else c.cast("string"))
    # characters that XML doesn't have become U+FFFD
    text = F.regexp_replace(text, r"[\uFFFE\uFFFF]", "\uFFFD")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return F.when(c.isNotNull(), F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), text, F.lit("</t></is></c>"))).otherwise("<c/>")


def write_workbooks(df: DataFrame, path: str, name: str, order: str | Column, rows: int = SHEET_ROWS) -> DataFrame:
    """A workbook for each sheet of ``rows`` rows and a header, ``<path>/<name>_<number>.xlsx``; returns (sheet_no, file, rows).

    Rows are in the order of a column, unique but for rows whose order doesn't matter.  Cells are made in the JVM; a task streams the rows of its sheets into their files, which are
    moved to their names when they are whole.  A table without rows gives one sheet.
    """
    kinds = dict(df.dtypes)
    dealt = numbered(df.withColumn("_order", F.col(order) if isinstance(order, str) else order), "_order", "_no").withColumn("sheet_no", sheet_number(F.col("_no"), rows))
    body = F.concat(F.lit("<row>"), *[cell_xml(F.col(f"`{c}`"), kinds[c]) for c in df.columns], F.lit("</row>"))
    lines = dealt.select("sheet_no", F.col("_no").cast("long").alias("_no"), body.alias("line"))
    # the first sheet is there even without rows
    lines = lines.unionByName(df.sparkSession.range(1).select(F.lit(1).cast("long").alias("sheet_no"), F.lit(0).cast("long").alias("_no"), F.lit(None).cast("string").alias("line")))
    header = "<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for c in df.columns) + "</row>"
    cols = "".join(f'<col min="{i}" max="{i}" width="{20 if i < 6 else 18}" customWidth="1"/>' for i in range(1, len(df.columns) + 1))

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sheet(number: int, lines: Iterator[str | None]) -> pa.RecordBatch:
            place, count = joined(path, f"{name}_{number:04d}.xlsx"), 0
            with whole_file(place) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("[Content_Types].xml", _TYPES)
                z.writestr("_rels/.rels", _RELS.format(kind="officeDocument", target="xl/workbook.xml"))
                z.writestr("xl/_rels/workbook.xml.rels", _RELS.format(kind="worksheet", target="worksheets/sheet1.xml"))
                z.writestr("xl/workbook.xml", _BOOK.format(name=escape((name if number == 1 else f"{name}_{number}")[:31])))
                with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
                    part.write((_SHEET.format(cols=cols) + header).encode())
                    for line in lines:
                        if line is not None:
                            part.write(line.encode())
                            count += 1
                    part.write(b"</sheetData></worksheet>")
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([place]), pa.array([count], pa.int64())], ["sheet_no", "file", "rows"])

        rows = ((n, line) for batch in parts for n, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for number, own in groupby(rows, key=lambda r: r[0]):
            yield sheet(number, (line for _, line in own))

    spread = lines.repartition("sheet_no").sortWithinPartitions("sheet_no", "_no").select("sheet_no", "line")
    return kept(spread.mapInArrow(write, "sheet_no long, file string, rows long"))


def overlay_shapes(blocks: DataFrame, rows: DataFrame, tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shapes to draw on a page: block boxes (blue), cuts (red), row lines (green), assigned words (orange).

    One row a shape: keys, colour, width, x0, y0, x1, y1.  A renderer joins them with the page's image.
    """
    d = lambda c: F.col(c).cast("double")
    shape = lambda colour, width, *xy: [F.lit(colour).alias("colour"), F.lit(width).alias("width"), *[c.cast("double").alias(n) for c, n in zip(xy, ("x0", "y0", "x1", "y1"), strict=True)]]
    boxes = blocks.select(*keys, *shape("blue", 4, d("x0"), d("y0"), d("x1"), d("y1")))
    cuts = blocks.select(*keys, "y0", "y1", F.explode("cuts").alias("x")).select(*keys, *shape("red", 3, d("x"), d("y0"), d("x"), d("y1")))
    lines = rows.select(*keys, *shape("green", 2, d("x0"), d("cy"), d("x1"), d("cy")))
    words = tokens.filter("block is not null").select(*keys, *shape("orange", 1, d("x"), d("y"), d("r"), d("b")))
    return boxes.unionByName(cuts).unionByName(lines).unionByName(words)
