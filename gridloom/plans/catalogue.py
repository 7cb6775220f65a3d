"""One query for each operator over the standard tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text as T
from gridloom.operators import cells as C
from gridloom.operators import layout as L
from gridloom.operators import routing as R
from gridloom.operators.fields import extract_fields, first
from gridloom.plans import grid, tsvpages
from gridloom.plans.textgrid import KEYS, text_tokens
from gridloom.sources.tsv import page_extent

ROW = ["doc_id", "row"]
#: Manual boundaries that the queries use, as shares of the page width.
SHARES = (0.25, 0.5, 0.75)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return text_tokens(table(spark, d, "documents").select("doc_id", "text"))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return L.gutter_segments(_tokens(spark, d), KEYS)


def _cuts(spark: SparkSession, d: str) -> DataFrame:
    return L.merge_segments(_segments(spark, d), KEYS)


def _slotted(spark: SparkSession, d: str) -> DataFrame:
    """Words with the columns that the found cuts give; texts without cuts have one column."""
    cuts = L.cut_arrays(_cuts(spark, d), KEYS)
    tokens = _tokens(spark, d).join(cuts, "doc_id", "left").withColumn("cuts", F.coalesce("cuts", F.expr("cast(array() as array<double>)")))
    return L.to_columns(tokens)


def tg_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).select("doc_id", "row", "seq", "text", "x", "y", "r", "b", "cy")


def tg_extent(spark: SparkSession, d: str) -> DataFrame:
    return page_extent(_tokens(spark, d).withColumn("level", F.lit(5)), KEYS)


def tg_gaps(spark: SparkSession, d: str) -> DataFrame:
    return L.row_gaps(_tokens(spark, d), KEYS)


def tg_segments(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d)


def tg_cuts(spark: SparkSession, d: str) -> DataFrame:
    return _cuts(spark, d)


def tg_manual_cuts(spark: SparkSession, d: str) -> DataFrame:
    tokens = _tokens(spark, d)
    width = tokens.groupBy("doc_id").agg(F.max("r").alias("width"))
    placed = L.to_columns(tokens.join(width, "doc_id").withColumn("cuts", L.manual_cuts(F.col("width"), SHARES)))
    return placed.select("doc_id", "row", "seq", "column", "crosses")


def tg_cells(spark: SparkSession, d: str) -> DataFrame:
    long = C.cells(_slotted(spark, d), KEYS, candidates=False)
    return long.select("doc_id", "row", "column", "cell_raw", "token_ids", "x0", "y0", "x1", "y1", "flags")


def tg_wide(spark: SparkSession, d: str) -> DataFrame:
    return C.wide_grid(C.cells(_slotted(spark, d), KEYS, candidates=False), ROW)


def tg_crossing(spark: SparkSession, d: str) -> DataFrame:
    return C.row_flags(_slotted(spark, d), ROW)


def tg_assign(spark: SparkSession, d: str) -> DataFrame:
    slotted = _slotted(spark, d).filter(~F.col("noise"))
    return C.assign_tokens(_tokens(spark, d), slotted, [*ROW, "seq"], ["column"]).select("doc_id", "row", "seq", "noise", "column")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / 1e6)
    return L.split_blocks(events, ["user_id"], "at", 3.0)


def ev_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("event_id", "user_id", "block_no")


def ev_block_box(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).groupBy("user_id", "block_no").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min("value").alias("v0"), F.max("value").alias("v1"))


def ev_row_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Order-dependent clustering of each user's events by value, as words are clustered to rows."""
    boxes = table(spark, d, "events").select("user_id", F.col("event_id").alias("seq"), F.lit(0).alias("x"), F.col("value").alias("cy"), F.lit(32).alias("h"), F.lit(False).alias("noise"))
    return L.find_rows(boxes, ["user_id"]).select(F.col("seq").alias("event_id"), "user_id", "row", "row_cy")


def doc_numbers(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select("doc_id", F.posexplode(T.numbers(F.col("text"))).alias("no", "raw"))
    return found.select("doc_id", "no", "raw", F.replace("raw", F.lit(","), F.lit(".")).alias("value"))


def doc_number_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with their places in code points."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.number_candidates(F.col("text"))).alias("no", "n")).select("doc_id", "no", "n.*")


def doc_noise(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), r"[ \n]")).alias("w")).filter("w <> ''")
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.sum(T.is_noise(F.col("w")).cast("long")).alias("n_noise"))


def median_default(spark: SparkSession, d: str) -> DataFrame:
    plausible = F.when(F.col("l_quantity").between(6, 30), F.col("l_quantity"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(T.median_or(plausible, 32.0).alias("typical"))


def page_fields(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return pages.select("page_id", first(F.col("html"), r"<title>([^<]*)</title>").alias("title"), first(F.col("html"), r'<a href="([^"]*)"', flags="u").alias("first_link"))


def url_tail(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", first(F.col("url"), r"([0-9A-Za-z_-]+)[^0-9A-Za-z_-]*\z", flags="u").alias("tail"))


def ru_date(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written out in words and read back."""
    names = F.array(*[F.lit(m) for m in T.MONTHS])
    written = F.concat_ws(" ", F.dayofmonth("o_orderdate").cast("string"), F.element_at(names, F.month("o_orderdate")), F.year("o_orderdate").cast("string"), F.lit("г."))
    return table(spark, d, "orders").select("o_orderkey", T.ru_date(written).alias("day"))


def ws_collapse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.collapse(F.col("html")).alias("collapsed"))


def route(spark: SparkSession, d: str) -> DataFrame:
    """First reason that holds, as registry texts are routed."""
    docs = table(spark, d, "documents")
    reason = F.when(F.trim("text") == "", "no text").when(~F.col("lang").isin("en", "de"), "language").when(~F.col("text").contains("\n"), "one line").when(F.col("n_chars") < 500, F.concat(F.lit("short: "), F.col("n_chars").cast("string"))).otherwise("")
    judged = docs.select("doc_id", reason.alias("reason"), F.when(F.col("n_chars") % 17 == 0, F.concat(F.lit("ошибка чтения: "), F.col("doc_id").cast("string"))).alias("error"), (F.col("n_chars") % 13 != 0).alias("found"))
    return R.routed(judged.withColumn("status", F.when(F.col("reason") == "", "success").otherwise("skipped"))).select("doc_id", "status", "reason", "error")


def registry_texts(spark: SparkSession, d: str) -> DataFrame:
    """A registry text for each order: kinds, purposes, units, dates and rights vary, and parts are missing, by the order's number."""
    o = table(spark, d, "orders").filter("o_orderkey is not null")
    k, n = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    kind = F.when(k % 5 == 0, "Машино-место").when(k % 7 == 0, "Здание").otherwise("Помещение")
    months = F.array(*[F.lit(m) for m in T.MONTHS])
    day = F.concat_ws(" ", (k % 28 + 1).cast("string"), F.element_at(months, (k % 12 + 1).cast("int")), (2000 + k % 25).cast("string"), F.lit("г."))
    purpose = F.when(k % 3 == 0, "Нежилое").when(k % 11 == 0, "Иное").otherwise("Жилое")
    address = F.when(k % 19 == 0, F.concat(F.lit("кв "), n)).otherwise(F.concat(F.lit("г. Пример,  ул. Новая,\nд. 1, "), F.when(k % 5 == 0, "м/м ").otherwise("кв. "), n))
    text = F.concat(
        F.lit("Выписка\n"), kind, F.lit("\nвид объекта недвижимости\n"), day, F.when(k % 17 == 0, "").otherwise(F.concat(F.lit("\nКадастровый номер: 77:01:0001001:"), n)),
        F.lit("\nАдрес: "), address, F.lit("\nПлощадь, м2: "), F.coalesce("o_custkey", F.lit(0)).cast("string"), F.lit(".5\nНазначение: "), purpose,
        F.when(k % 13 == 0, "\nПрочее").otherwise(""), F.lit("\nНаименование: Квартира\nЭтаж № "), F.when(k % 6 == 0, "-1").otherwise("3"),
        F.when(k % 2 == 0, F.concat(F.lit("\nрегистрации 2.1 Собственность\nправа: 77-"), n, F.lit("\n01.02.2020\n")))
        .otherwise(F.concat(F.lit("\nКадастровые номера иных объектов недвижимости, в пределах: 77:01:0001001:"), n, F.lit("2\n"))),
    )
    return o.select("o_orderkey", F.when(k % 29 == 0, " \n").otherwise(text).alias("full_text"))


def registry_fields(spark: SparkSession, d: str) -> DataFrame:
    """The registry rules over the texts of all orders."""
    out = extract_fields(registry_texts(spark, d))
    return out.select(
        "o_orderkey", "status", "reason", "kind", "purpose", "name", "cadastral_no", "extract_date", "address", "object_no", "area", "floor",
        "right_type", "registration_no", "ownership_date", "house_cadastral_no",
    )


def resume(spark: SparkSession, d: str) -> DataFrame:
    return R.remaining(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


def done_union(spark: SparkSession, d: str) -> DataFrame:
    return R.done_paths(table(spark, d, "labels").select(F.col("doc_id").alias("id")), table(spark, d, "documents").select(F.col("doc_id").alias("id")), table(spark, d, "benchmark").select(F.col("item_id").cast("long").alias("id")))


def final_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id")
    good = docs.filter("quality = 1").select("doc_id", "source", F.lit("").alias("error"))
    bad = docs.filter("quality = 0").select("doc_id", F.lit("").alias("source"), F.lit("low quality").alias("error"))
    return R.final_report(good, bad, "doc_id").select("no", "doc_id", "source", "error")


def sheet_no(spark: SparkSession, d: str) -> DataFrame:
    rows = R.numbered(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return rows.select("o_orderkey", "no", R.sheet_number(F.col("no"), 999).alias("sheet_no"))


def safe_cell(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.safe_cell(F.col("html")).alias("cell"))


def folder_uid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.folder_uid(F.col("url")).alias("uid"))


def run_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.run_counts(route(spark, d))


def block_flags(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of texts as blocks, with their columns and flags."""
    tokens = _tokens(spark, d)
    boxes = C.block_boxes(tokens, KEYS).join(_cuts(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cuts")), "doc_id", "left").fillna(0, ["n_cuts"])
    return boxes.select("doc_id", "x0", "y0", "x1", "y1", "rows", (F.col("n_cuts") + 1).alias("columns"), C.block_flags(F.col("rows"), F.col("n_cuts")).alias("flags"))


def review(spark: SparkSession, d: str) -> DataFrame:
    """Union of the review codes of texts: a hypothesis for each, an issue for each line of one word."""
    flags = C.hypotheses(block_flags(spark, d), KEYS)
    lines = _tokens(spark, d).groupBy("doc_id", "row").count().filter("count = 1").select("doc_id", F.lit("bad_tsv_line").alias("code"), F.concat(F.lit("line "), F.col("row").cast("string")).alias("detail"))
    return flags.unionByName(lines)


def page_counts(spark: SparkSession, d: str) -> DataFrame:
    tokens = _tokens(spark, d).withColumns({"row_no": F.col("row"), "block": F.lit("B001")})
    return grid.page_counts({"tokens": tokens}, KEYS)


_ALL = (
    tg_tokens, tg_extent, tg_gaps, tg_segments, tg_cuts, tg_manual_cuts, tg_cells, tg_wide, tg_crossing, tg_assign, ev_blocks, ev_block_box, ev_row_cluster, doc_numbers,
    doc_number_offsets, doc_noise, median_default, page_fields, url_tail, ru_date, ws_collapse, route, registry_fields, resume, done_union, final_report, sheet_no, safe_cell,
    folder_uid, run_counts, block_flags, review, page_counts,
)
QUERIES = {f.__name__: f for f in _ALL} | tsvpages.QUERIES

_TK = r"""
WITH ln AS (SELECT doc_id, i - 1 AS row, lines[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(range(1, (len(lines) + 1)::BIGINT)) AS t(i)),
wd AS (SELECT doc_id, row, j - 1 AS seq, ws[j] AS text FROM (SELECT *, string_split(line, ' ') AS ws FROM ln), unnest(range(1, (len(ws) + 1)::BIGINT)) AS t(j)),
of AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, row ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM wd),
tk AS (
  SELECT doc_id, row, seq, 'T' || row || '.' || seq AS token_id, text, 40 * o AS x, 54 * row AS y, 40 * (o + length(text)) AS r, 54 * row + 32 AS b, (54 * row + 16)::DOUBLE AS cy,
    (30 + (5 * length(text) + 7 * seq) % 70)::DOUBLE AS conf,
    regexp_full_match(text, '[''"`‘’“”|¦!¡=+_~—–\-.,:;\\/()\[\]{}<>*#\s]+') AS noise
  FROM of WHERE trim(text) <> '')"""
_GAPS = r"""
, gp AS (
  SELECT doc_id, row, r + 32::DOUBLE * 0.2::DOUBLE AS lo, nx - 32::DOUBLE * 0.2::DOUBLE AS hi
  FROM (SELECT *, lead(x) OVER (PARTITION BY doc_id, row ORDER BY x, seq) AS nx FROM tk) WHERE nx - r >= 32)"""
_SEGMENTS = r"""
, nr AS (SELECT doc_id, count(DISTINCT row) AS n FROM tk GROUP BY doc_id),
pts AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, lo AS p FROM gp UNION ALL SELECT doc_id, hi FROM gp)),
el AS (SELECT doc_id, lo, hi, (lo + hi) / 2 AS m FROM (SELECT doc_id, p AS lo, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS hi FROM pts) WHERE hi IS NOT NULL),
su AS (SELECT e.doc_id, e.lo, e.hi, e.m, count(DISTINCT g.row) AS support FROM el e JOIN gp g ON g.doc_id = e.doc_id AND g.lo <= e.m AND e.m <= g.hi GROUP BY ALL),
en AS (SELECT su.*, n FROM su JOIN nr USING (doc_id) WHERE support >= greatest(2, ceil(n * 0.3::DOUBLE))),
cr AS (SELECT e.doc_id, e.lo, count(DISTINCT k.row) AS crossing FROM en e JOIN tk k ON k.doc_id = e.doc_id AND k.x < e.m AND e.m < k.r GROUP BY ALL),
sg AS (SELECT en.doc_id, en.lo, en.hi, support, coalesce(crossing, 0) AS crossing FROM en LEFT JOIN cr USING (doc_id, lo) WHERE coalesce(crossing, 0) <= greatest(1, trunc(n * 0.15::DOUBLE)))"""
_CUTS = r"""
, mg AS (SELECT *, sum(CASE WHEN lo <= prev + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY lo) AS run FROM (SELECT *, lag(hi) OVER (PARTITION BY doc_id ORDER BY lo) AS prev FROM sg)),
rn AS (SELECT doc_id, min(lo) AS lo, max(hi) AS hi, max(support) AS support FROM mg GROUP BY doc_id, run HAVING max(hi) - min(lo) >= 32 * 0.3::DOUBLE),
tp AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY support DESC, hi - lo DESC, lo) AS k FROM rn),
ct AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY lo) AS cut_no, (lo + hi) / 2 AS x FROM tp WHERE k < 20)"""
_SLOTS = r"""
, ca AS (SELECT doc_id, list(x) AS cuts FROM ct GROUP BY doc_id),
sl AS (
  SELECT tk.*, len(list_filter(coalesce(cuts, []), lambda c: (tk.x + tk.r) / 2 >= c)) + 1 AS "column", len(list_filter(coalesce(cuts, []), lambda c: tk.x < c AND c < tk.r)) > 0 AS crosses
  FROM tk LEFT JOIN ca USING (doc_id))"""
_CELLS = r"""
, ce AS (
  SELECT doc_id, row, "column", string_agg(text, ' ' ORDER BY x, seq) AS cell_raw, string_agg(token_id, ' ' ORDER BY x, seq) AS token_ids, min(x) AS x0, min(y) AS y0, max(r) AS x1, max(b) AS y1,
    concat_ws(';', CASE WHEN min(conf) < 40 THEN 'low_conf' END, CASE WHEN sum(len(regexp_extract_all(text, '\d+(?:[,.]\d+)?'))) > 1 THEN 'multiple_numbers' END, CASE WHEN bool_or(crosses) THEN 'crosses_column_boundary' END) AS flags
  FROM sl GROUP BY doc_id, row, "column")"""
_EV = r"""
WITH e AS (SELECT *, epoch_us(ts)::DOUBLE / 1e6 AS sec FROM events),
g AS (SELECT *, sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) AS gap FROM e),
t AS (SELECT user_id, median(CASE WHEN gap > 0 THEN gap END) * 3.0::DOUBLE AS threshold FROM g GROUP BY user_id),
k AS (SELECT g.*, 1 + sum(CASE WHEN gap > threshold THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_no FROM g JOIN t USING (user_id))"""
_MONTHS = "[" + ", ".join(f"'{m}'" for m in T.MONTHS) + "]"
_ROUTE = r"""
SELECT doc_id, CASE WHEN n_chars % 17 = 0 THEN 'errors' WHEN n_chars % 13 = 0 OR r <> '' THEN 'skipped' ELSE 'success' END AS status,
  CASE WHEN n_chars % 17 = 0 THEN '' WHEN n_chars % 13 = 0 THEN 'файл не найден по пути из CSV' ELSE r END AS reason, CASE WHEN n_chars % 17 = 0 THEN 'ошибка чтения: ' || doc_id END AS error
FROM (SELECT *, CASE WHEN trim(text) = '' THEN 'no text' WHEN lang NOT IN ('en', 'de') THEN 'language' WHEN strpos(text, chr(10)) = 0 THEN 'one line' WHEN n_chars < 500 THEN 'short: ' || n_chars ELSE '' END AS r FROM documents)"""
_REGISTRY = rf"""
WITH o AS (
  SELECT o_orderkey AS n, coalesce(o_custkey, 0) AS c, n % 29 = 0 AS blank, n % 5 = 0 AS parking, CASE WHEN n % 5 = 0 THEN 'Машино-место' WHEN n % 7 = 0 THEN 'Здание' ELSE 'Помещение' END AS k,
    CASE WHEN n % 3 = 0 THEN 'Нежилое' WHEN n % 11 = 0 THEN 'Иное' ELSE 'Жилое' END AS p FROM orders WHERE o_orderkey IS NOT NULL),
r AS (
  SELECT *, CASE WHEN blank THEN 'PDF без извлекаемого текста (вероятно скан)'
    WHEN k = 'Здание' THEN 'вид объекта недвижимости не «Помещение» и не «Машино-место»'
    WHEN n % 13 = 0 AND NOT parking THEN 'не найден блок «Назначение / Наименование»'
    WHEN p = 'Иное' AND NOT parking THEN 'назначение не «Жилое» и не «Нежилое»: «Иное»'
    WHEN n % 17 = 0 AND n % 19 = 0 THEN 'не найдены ключевые поля: кадастровый номер, адрес'
    WHEN n % 17 = 0 THEN 'не найдены ключевые поля: кадастровый номер'
    WHEN n % 19 = 0 THEN 'не найдены ключевые поля: адрес' ELSE '' END AS reason FROM o)
SELECT n AS o_orderkey, CASE WHEN reason = '' THEN 'success' ELSE 'skipped' END AS status, reason, CASE WHEN blank THEN '' ELSE k END AS kind, CASE WHEN blank THEN '' ELSE p END AS purpose,
  CASE WHEN blank THEN '' ELSE 'Квартира' END AS name, CASE WHEN blank OR n % 17 = 0 THEN '' ELSE '77:01:0001001:' || n END AS cadastral_no,
  CASE WHEN blank THEN '' ELSE lpad((n % 28 + 1)::VARCHAR, 2, '0') || '.' || lpad((n % 12 + 1)::VARCHAR, 2, '0') || '.' || (2000 + n % 25) END AS extract_date,
  CASE WHEN blank OR n % 19 = 0 THEN '' ELSE 'г. Пример, ул. Новая, д. 1' END AS address, CASE WHEN blank THEN '' ELSE n::VARCHAR END AS object_no,
  CASE WHEN blank THEN '' ELSE c || '.5' END AS area, CASE WHEN blank THEN '' WHEN n % 6 = 0 THEN '-1' ELSE '3' END AS floor,
  CASE WHEN blank OR n % 2 = 1 THEN '' ELSE 'Собственность' END AS right_type, CASE WHEN blank OR n % 2 = 1 THEN '' ELSE '77-' || n END AS registration_no,
  CASE WHEN blank OR n % 2 = 1 THEN '' ELSE '01.02.2020' END AS ownership_date, CASE WHEN blank OR n % 2 = 0 THEN '' ELSE '77:01:0001001:' || n || '2' END AS house_cadastral_no FROM r"""
_FLAGS = r"""
, bf AS (
  SELECT doc_id, min(x) AS x0, min(y) AS y0, max(r) AS x1, max(b) AS y1, count(DISTINCT row) AS rows, coalesce(any_value(k), 0) + 1 AS columns,
    concat_ws(';', 'unverified_geometry', CASE WHEN coalesce(any_value(k), 0) = 0 THEN 'no_stable_columns' END, CASE WHEN count(DISTINCT row) < 3 THEN 'short_block' END) AS flags
  FROM tk LEFT JOIN (SELECT doc_id, count(*) AS k FROM ct GROUP BY doc_id) USING (doc_id) GROUP BY doc_id)"""
_TO_CUTS = _TK + _GAPS + _SEGMENTS + _CUTS
_TO_SLOTS = _TO_CUTS + _SLOTS

ORACLE_SQL = {
    "tg_tokens": _TK + " SELECT doc_id, row, seq, text, x, y, r, b, cy FROM tk",
    "tg_extent": _TK + " SELECT doc_id, max(r) AS width, max(b) AS height FROM tk GROUP BY doc_id",
    "tg_gaps": _TK + _GAPS + " SELECT * FROM gp",
    "tg_segments": _TK + _GAPS + _SEGMENTS + " SELECT * FROM sg",
    "tg_cuts": _TO_CUTS + " SELECT * FROM ct",
    "tg_manual_cuts": _TK
    + r""", w AS (SELECT doc_id, max(r) AS width FROM tk GROUP BY doc_id), c AS (SELECT doc_id, [0.25::DOUBLE * width, 0.5::DOUBLE * width, 0.75::DOUBLE * width] AS cuts FROM w)
SELECT doc_id, row, seq, len(list_filter(cuts, lambda c: (tk.x + tk.r) / 2 >= c)) + 1 AS "column", len(list_filter(cuts, lambda c: tk.x < c AND c < tk.r)) > 0 AS crosses FROM tk JOIN c USING (doc_id)""",
    "tg_cells": _TO_SLOTS + _CELLS + " SELECT * FROM ce",
    "tg_wide": _TO_SLOTS + _CELLS + " SELECT doc_id, row, " + ", ".join(f"coalesce(max(CASE WHEN \"column\" = {i} THEN cell_raw END), '') AS C{i:02d}" for i in range(1, C.WIDE_COLUMNS + 1)) + " FROM ce GROUP BY doc_id, row",
    "tg_crossing": _TO_SLOTS + " SELECT doc_id, row, CASE WHEN bool_or(crosses) THEN 'crosses_column_boundary' ELSE '' END AS flags FROM sl GROUP BY doc_id, row",
    "tg_assign": _TO_SLOTS + ' SELECT doc_id, row, seq, noise, CASE WHEN NOT noise THEN "column" END AS "column" FROM sl',
    "ev_blocks": _EV + " SELECT event_id, user_id, block_no::INT AS block_no FROM k",
    "ev_block_box": _EV + " SELECT user_id, block_no::INT AS block_no, count(*) AS n_rows, min(ts) AS t0, max(ts) AS t1, min(value) AS v0, max(value) AS v1 FROM k GROUP BY ALL",
    "ev_row_cluster": r"""
WITH RECURSIVE w AS (SELECT event_id, user_id, value::DOUBLE AS cy, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS i FROM events WHERE value IS NOT NULL),
s AS (
  SELECT DISTINCT user_id, 0::BIGINT AS i, []::DOUBLE[][] AS rows, 0::BIGINT AS pick FROM w
  UNION ALL
  SELECT user_id, i, CASE WHEN pick > len(rows) THEN list_append(rows, [cy]) ELSE list_concat(list_append(rows[1:pick - 1], list_append(rows[pick], cy)), rows[pick + 1:]) END, pick
  FROM (
    SELECT s.user_id, w.i, w.cy, s.rows, coalesce(list_sort(list_filter(list_transform(range(greatest(1, len(s.rows) - 11), len(s.rows) + 1),
      lambda k: {'d': abs(w.cy - (s.rows[k][(len(s.rows[k]) + 1) // 2] + s.rows[k][len(s.rows[k]) // 2 + 1]) / 2), 'k': k}), lambda c: c.d <= 32 * 0.45::DOUBLE))[1].k, len(s.rows) + 1)::BIGINT AS pick
    FROM s JOIN w ON w.user_id IS NOT DISTINCT FROM s.user_id AND w.i = s.i + 1)),
z AS (SELECT user_id, arg_max(rows, i) AS rows FROM s GROUP BY user_id),
c AS (SELECT user_id, k, (rows[k][(len(rows[k]) + 1) // 2] + rows[k][len(rows[k]) // 2 + 1]) / 2 AS row_cy FROM z, unnest(range(1, (len(rows) + 1)::BIGINT)) AS r(k)),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY row_cy, k) - 1 AS row FROM c)
SELECT w.event_id, w.user_id, n.row::INT AS row, n.row_cy FROM w JOIN s ON s.user_id IS NOT DISTINCT FROM w.user_id AND s.i = w.i JOIN n ON n.user_id IS NOT DISTINCT FROM w.user_id AND n.k = s.pick""",
    "doc_numbers": r"SELECT doc_id, i - 1 AS no, m[i] AS raw, replace(m[i], ',', '.') AS value FROM (SELECT doc_id, regexp_extract_all(text, '\d+(?:[,.]\d+)?') AS m FROM documents), unnest(range(1, (len(m) + 1)::BIGINT)) AS t(i)",
    "doc_number_offsets": r"""WITH m AS (SELECT doc_id, text, regexp_extract_all(text, '\d+(?:[,.]\d+)?') AS m, string_split_regex(text, '\d+(?:[,.]\d+)?') AS s FROM documents)
SELECT doc_id, i - 1 AS no, m[i] AS raw, replace(m[i], ',', '.') AS value, (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::INT AS "offset" FROM m, unnest(range(1, (len(m) + 1)::BIGINT)) AS t(i)""",
    "doc_noise": r"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[ \n]')) AS w FROM documents)
SELECT doc_id, count(*) AS n_words, sum(CASE WHEN regexp_full_match(w, '[''"`‘’“”|¦!¡=+_~—–\-.,:;\\/()\[\]{}<>*#\s]+') THEN 1 ELSE 0 END)::BIGINT AS n_noise FROM w WHERE w <> '' GROUP BY doc_id""",
    "median_default": "SELECT l_orderkey, coalesce(median(CASE WHEN l_quantity BETWEEN 6 AND 30 THEN l_quantity END), 32.0)::DOUBLE AS typical FROM lineitem GROUP BY l_orderkey",
    "page_fields": r"""SELECT page_id, regexp_extract(html, '(?i)<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<a href="([^"]*)"', 1) AS first_link FROM pages""",
    "url_tail": r"SELECT page_id, regexp_extract(url, '([0-9A-Za-z_-]+)[^0-9A-Za-z_-]*$', 1) AS tail FROM pages",
    "ru_date": f"""WITH w AS (SELECT o_orderkey, day(o_orderdate) || ' ' || ({_MONTHS})[month(o_orderdate)] || ' ' || year(o_orderdate) AS w FROM orders),
p AS (SELECT o_orderkey, string_split(w, ' ') AS p FROM w)
SELECT o_orderkey, lpad(p[1], 2, '0') || '.' || lpad(list_position({_MONTHS}, p[2])::VARCHAR, 2, '0') || '.' || p[3] AS day FROM p""",
    "ws_collapse": r"SELECT page_id, trim(regexp_replace(html, '[\s\x1C-\x1F\x{85}\p{Z}]+', ' ', 'g')) AS collapsed FROM pages",
    "route": _ROUTE,
    "registry_fields": _REGISTRY,
    "resume": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "done_union": "SELECT doc_id AS id FROM labels UNION SELECT doc_id FROM documents UNION SELECT item_id::BIGINT FROM benchmark",
    "final_report": """WITH d AS (SELECT doc_id, source, quality FROM documents JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id))
SELECT row_number() OVER (ORDER BY doc_id) AS no, doc_id, source, '' AS error FROM d WHERE quality = 1 UNION ALL SELECT NULL, doc_id, '', 'low quality' FROM d WHERE quality = 0""",
    "sheet_no": "SELECT o_orderkey, no, (no - 1) // 999 + 1 AS sheet_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS no FROM orders)",
    "safe_cell": r"SELECT page_id, left(regexp_replace(html, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), 32700) AS cell FROM pages",
    "folder_uid": "SELECT page_id, left(sha1(url), 8) AS uid FROM pages",
    "run_counts": f"SELECT status, count(*) AS n FROM ({_ROUTE}) GROUP BY ALL",
    "block_flags": _TO_CUTS + _FLAGS + " SELECT * FROM bf",
    "review": _TO_CUTS + _FLAGS + " SELECT doc_id, 'geometry_hypothesis' AS code, flags AS detail FROM bf UNION ALL SELECT doc_id, 'bad_tsv_line', 'line ' || row FROM tk GROUP BY doc_id, row HAVING count(*) = 1",
    "page_counts": _TK + " SELECT doc_id, count(*) AS tokens, count(DISTINCT row) AS rows, 1 AS blocks FROM tk GROUP BY doc_id",
} | tsvpages.ORACLE_SQL
