"""The thin queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import chat, decontam, hashsql, htmltext, jaccard, mixing, packing, quality, repair, sharding, spelling, tokens, urls, webp
from gridloom.llm.common import table

#: The conversation whose texts hold the template's own marks.
HOSTILE = r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text"))
    out = chat.format_chats(rows.unionByName(extra)).withColumn("turns", chat.read_turns(F.col("formatted")))
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])))
    out = out.withColumn("loss_text", loss)
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("bad_turn").cast("long").alias("bad_turn"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), 5, 0.75)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = webp.to_media(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return webp.read_media(media).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("_bytes"), "text")
    # the text itself isn't needed after its size and crc32, so it isn't shuffled
    slim = docs.select("doc_id", (F.col("_bytes") + 16).cast("long").alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = sharding.shard_rows(slim.withColumn("text", F.col("text_crc32").cast("string")), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document's source, language and lines: a boundary token counts for the one it begins in."""
    out = tokens.token_counts(table(spark, sf_dir, "documents"), ("source", "lang", "text"), "first")
    return out.select(
        "doc_id", "n_tokens", "n_chars", F.size("sections").cast("long").alias("n_sections"), "n_crossing",
        F.transform("sections", lambda s: s["tokens"]).alias("section_tokens"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("slots")).cast("long").alias("taken"), "slots")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = htmltext.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.scan_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return out.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, a letter left out of one of 199 by a hash, with their forms."""
    # shorter runs can't give words of six letters
    run = F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z\u00C0-\u00FF]{6,})"), 1))
    runs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_d"), run.alias("_r"))
    plain = F.octet_length("_r") == F.char_length("_r")
    low = F.when(plain, F.lower("_r")).otherwise(F.translate("_r", string.ascii_uppercase, string.ascii_lowercase))
    hashed = runs.select("_d", low.alias("_r")).withColumn("_h", F.crc32(F.concat_ws(":", "_d", "_r").cast("binary")))
    at = (F.col("_h") % F.char_length("_r")).cast("int")
    short = F.concat(F.substring("_r", F.lit(1), at), F.substring("_r", at + 2, F.char_length("_r")))
    return spelling.spelling_forms(hashed.select(F.when(F.col("_h") % 199 == 0, short).otherwise(F.col("_r")).alias("word")), 6, 5, 5)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations, damaged by a hash of each row's place, then repaired."""
    null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", null("role").alias("role"), null("text").alias("text"), (F.crc32(F.concat_ws(":", null("conv_id"), null("turn")).cast("binary")) % 20).alias("_h"))
    h = F.col("_h")
    hurt = rows.withColumns({"role": F.when(h == 4, "user").otherwise(F.col("role")), "text": F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))})
    hurt = hurt.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.when(h == 0, 0).when(h == 3, 2).otherwise(1)))).drop("_h", "_again")
    found, turns = repair.repair_conversations(hurt)
    shown = found.join(repair.digests(turns).toDF("_id", "digest"), F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    every = rows.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    out = every.join(shown, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_id").alias("conv_id"), *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of 4096 tokens or a smaller power of two."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_ngram_jaccard_join, op3_quality_classifier, op4_media_columns, op5_url_filter,
    op6_sharding, op7_token_counts, op8_mixing, op9_html_extraction, op10_decontamination,
    op11_spelling_variants, op12_conversation_repair, op13_packing,
)}

#: Read together: these fixed strings are the template of op1 in SQL.
_SQL_OP1 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS esc,
    CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
      ELSE '=' || replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ': ', ':\ ') END AS shown,
    row_number() OVER o AS place, lag(role) OVER o AS before
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
b AS (
  SELECT conv_id, min(CASE WHEN (coalesce(before, ''), role) NOT IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) THEN place END) AS bad_turn,
    arg_max(role, place) AS last_role FROM e GROUP BY conv_id)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length('### ') + length(shown) + length(': ') + length(esc) + length(' </turn>' || chr(10)))::BIGINT AS formatted_chars,
  any_value(bad_turn) IS NULL AND any_value(last_role) = 'assistant' AS valid, any_value(bad_turn)::BIGINT AS bad_turn
FROM e JOIN b USING (conv_id) GROUP BY conv_id
"""

_SQL_OP5 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM u),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM s),
rules(rule, rhost, rpath, verdict, rank) AS (
  VALUES ('com/en/', 'com', '/en/', 'block', 1), ('example.com/en/7', 'example.com', '/en/7', 'allow', 2),
    ('net/de/', 'net', '/de/', 'allow', 1), ('example.net/de/8', 'example.net', '/de/8', 'block', 2), ('org/es/', 'org', '/es/', 'block', 1)),
m AS (
  SELECT page_id, arg_max(rule, rank) AS rule, arg_max(verdict, rank) AS verdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

#: DuckDB's regular expressions know no bytes; the classes are given as code points.
_SQL_OP10 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT *, least(len(w), 13) AS k FROM bw WHERE len(w) > 0), unnest(range(1, (len(w) - k + 2)::BIGINT)) AS t(i)),
ks AS (SELECT DISTINCT k FROM win),
dg AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM dw, ks, unnest(range(1, greatest(len(w) - k + 2, 1)::BIGINT)) AS t(i)),
hit AS (SELECT doc_id, dg.k, i, item_id FROM dg JOIN win ON dg.g = win.g AND dg.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, k, i FROM hit), unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

#: The table of CRC-32, and the checksum of a column k of ASCII.
_SQL_CRC = "tb AS (SELECT list(list_reduce(range(8), lambda c, j: xor(c >> 1, 3988292384 * (c & 1)), i) ORDER BY i) AS t FROM range(256) r(i))"
_CRC = "xor(list_reduce(list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"

_SQL_OP11 = rf"""
WITH RECURSIVE {_SQL_CRC},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
many AS (SELECT d, r, count(*) AS c FROM runs GROUP BY d, r),
bytes AS (SELECT *, flatten(list_transform(string_split(d || ':' || r, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6)::BIGINT, 128 + (ord(x) & 63)::BIGINT] END)) AS b FROM many),
h AS (SELECT r, c, xor(list_reduce(b, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, tb),
hurt AS (SELECT CASE WHEN h % 199 = 0 THEN left(r, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM hurt WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
p AS (SELECT word, i, left(word, i::INT) || '_' || substr(word, i::INT + 2) AS hole, left(word, i::INT) || substr(word, i::INT + 2) AS gone FROM v, unnest(range(length(word))) AS r(i)),
pairs AS (
  SELECT a.word, b.word AS near FROM p a JOIN p b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT p.word, v.word FROM p JOIN v ON p.gone = v.word
  UNION SELECT v.word, p.word FROM p JOIN v ON p.gone = v.word),
best AS (SELECT pairs.word, count(*) AS n_near, min({{'m': -v.n, 'near': near}}) AS b FROM pairs JOIN v ON v.word = near GROUP BY pairs.word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * v.n THEN b.near END AS form, CASE WHEN -b.m >= 5 * v.n THEN -b.m END AS form_n FROM v LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root, form FROM f UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.form)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.form IS NULL
"""

_SQL_OP12 = rf"""
WITH RECURSIVE {_SQL_CRC},
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT raw.*, {_CRC} % 20 AS h FROM raw, tb),
d AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS n(again)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS short, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
mv(ini, a, b, role) AS (VALUES ('s', 0, 1, 'system'), ('u', 0, 2, 'user'), ('u', 1, 2, 'user'), ('u', 3, 2, 'user'), ('a', 2, 3, 'assistant')),
pre AS (
  SELECT p, p AS m, 0 AS cost, '' AS audit, '' AS lines FROM range(4) r(p)
  UNION ALL SELECT a, b, 5, 'I', chr(10) || role || ':' FROM mv WHERE ini <> 's'),
x AS (
  SELECT p, m AS q, NULL::VARCHAR AS ini, 'D' AS act, cost + 2 AS cost, audit || 'D' AS audit, lines, NULL::VARCHAR AS role FROM pre
  UNION ALL SELECT p, b, ini, 'K', cost, audit || 'K', lines, NULL::VARCHAR FROM pre JOIN mv ON a = m
  UNION ALL SELECT p, b, NULL::VARCHAR, 'R', cost + 1, audit || 'R', lines, role FROM pre JOIN mv ON a = m WHERE ini <> 's'),
s AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0::BIGINT AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS w FROM f
  UNION ALL
  SELECT s.conv_id, f.i, x.q::BIGINT, min({{'cost': s.w.cost + x.cost + CASE WHEN x.act <> 'D' AND f.short THEN 5 ELSE 0 END, 'audit': s.w.audit || x.audit,
    'lines': s.w.lines || x.lines || CASE x.act WHEN 'K' THEN chr(10) || f.role || ':' || f.text WHEN 'R' THEN chr(10) || x.role || ':' || f.text ELSE '' END}})
  FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
    JOIN x ON x.p = s.state AND (x.act = 'D' OR NOT (f.blank OR f.again) AND (x.act = 'R' OR x.ini = f.ini))
  GROUP BY s.conv_id, f.i, x.q),
z(state, cost, audit, lines) AS (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 5, 'I', chr(10) || 'assistant:'), (1, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
g AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (short AND NOT again AND NOT blank) AS truncated, count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
best AS (
  SELECT g.*, w FROM g JOIN (
    SELECT s.conv_id, s.i, min({{'cost': s.w.cost + z.cost, 'audit': s.w.audit || z.audit, 'lines': s.w.lines || z.lines}}) AS w FROM s JOIN z USING (state) GROUP BY ALL) y
  ON y.conv_id IS NOT DISTINCT FROM g.conv_id AND y.i = g.n),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(substr(w.lines, 2), '')) AS repaired_sha256
FROM every LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
"""

_SQL_OP2 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, (len(w) - 3)::BIGINT), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w),
k AS MATERIALIZED (SELECT s, min(r) AS c, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT c, n, unnest(s) AS g FROM k),
pairs AS (SELECT x.c AS a, y.c AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS shared FROM e x JOIN e y ON x.g = y.g AND x.c < y.c GROUP BY x.c, y.c),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * shared >= 75 * (na + nb - shared)),
ends AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT c, c AS d FROM k UNION SELECT reach.c, b FROM reach JOIN ends ON a = d),
docs AS (SELECT r, doc_id, len(s) AS n, c FROM s LEFT JOIN k USING (s)),
least AS (SELECT c, min(doc_id) AS doc_id FROM docs WHERE c IS NOT NULL GROUP BY c),
low AS (SELECT reach.c, min(doc_id) AS component_id FROM reach JOIN least ON d = least.c GROUP BY reach.c),
counted AS (SELECT a AS c, count(*) AS n_links FROM ends GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN c IS NULL THEN doc_id ELSE component_id END AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM docs LEFT JOIN low USING (c) LEFT JOIN counted USING (c)
"""

#: Bytes of a column ``text``, in hexadecimal, as numbers.
_BYTES = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)"
_BUCKET = hashsql.pmod("h", "greatest(1024, n // 32768)")
_KEYED = hashsql.chain("(SELECT *, 42::UHUGEINT AS h FROM crc)", hashsql.of_long("doc_id") + hashsql.of_long("c2") + hashsql.of_int(17))
_SQL_OP6 = rf"""
WITH RECURSIVE {_SQL_CRC},
{hashsql.permutation("SELECT count(*) AS n FROM documents")},
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {_BYTES.replace("text", "coalesce(text, '')")} AS b FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(b, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM d, tb),
k AS (SELECT *, text_crc32::VARCHAR AS k FROM c),
crc AS (SELECT doc_id, size, text_crc32, {_CRC} AS c2, (SELECT count(*) FROM documents) AS n FROM k, tb),
dealt AS (SELECT *, {_BUCKET} AS bucket FROM {_KEYED}),
numbered AS (SELECT *, row_number() OVER (ORDER BY bucket, doc_id NULLS FIRST, c2) - 1 AS x FROM dealt)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (p % 40)::INT AS shard, p // 40 AS slot, NULL::INT AS grown_shard FROM numbered JOIN placed USING (x)
"""

_SHUFFLED = hashsql.chain(hashsql.of_text(hashsql.chain("(SELECT *, 42::UHUGEINT AS h FROM d)", hashsql.of_long("doc_id")), "text"), hashsql.of_int(1))
_DEALT = hashsql.chain("(SELECT *, 42::UHUGEINT AS h FROM shuffled)", hashsql.of_long("shuffle") + hashsql.of_long("doc_id") + hashsql.of_int(17))
#: Slots are listed one by one here: each slot's van der Corput point is its number's bits in reverse.
_SQL_OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
shuffled AS MATERIALIZED (SELECT doc_id, source, size, {hashsql.signed("h")} AS shuffle, (SELECT count(*) FROM documents) AS n FROM {_SHUFFLED}),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER () AS row_number, coalesce(sum(size) OVER (PARTITION BY source ORDER BY bucket, shuffle, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT *, {_BUCKET} AS bucket FROM {_DEALT})),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS weight, source_size * 2.0::DOUBLE AS cap FROM totals),
room AS (SELECT *, least(sum(source_size) OVER () * 1.5::DOUBLE, sum(cap) OVER ()) AS everything FROM w),
-- shares are dealt again, without those at their caps, until none is above
deal AS (
  SELECT 0 AS step, source, source_size, weight, cap, everything, false AS full_up FROM room
  UNION ALL
  SELECT * FROM (
    WITH now AS (SELECT *, (everything - coalesce(sum(CASE WHEN full_up THEN cap END) OVER (), 0)) / sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER () AS line FROM deal)
    SELECT step + 1, source, source_size, weight, cap, everything, full_up OR cap < line * weight FROM now
    WHERE (SELECT count(*) FROM now WHERE NOT full_up AND cap < line * weight) > 0)),
last AS (SELECT * FROM deal WHERE step = (SELECT max(step) FROM deal)),
target AS (
  SELECT source, source_size, weight, CASE WHEN full_up OR least(cap, line * weight) IS NULL THEN cap ELSE least(cap, line * weight) END AS target
  FROM (SELECT *, (everything - coalesce(sum(CASE WHEN full_up THEN cap END) OVER (), 0)) / nullif(sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER (), 0) AS line FROM last)),
grid AS (SELECT greatest(4, ceil(log2(greatest(1.0::DOUBLE, sum(source_size) * 1.5::DOUBLE) / 64)))::INT AS bits FROM totals),
reach AS (
  SELECT *, sum(target) OVER () AS whole, least(ceil(coalesce(sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / nullif(sum(target) OVER (), 0), 0) * (1 << bits)), 1 << bits)::BIGINT AS stop
  FROM target, grid),
lagged AS (SELECT *, coalesce(lag(stop) OVER (ORDER BY source NULLS LAST), 0) AS start FROM reach),
cells AS (
  SELECT source, source_size, target, bits, CASE WHEN few THEN least(start, (1 << bits) - 1) ELSE start END AS begin_cell, CASE WHEN few THEN least(start, (1 << bits) - 1) + 1 ELSE stop END AS end_cell,
    CASE WHEN few THEN target ELSE whole / (1 << bits) END AS block
  FROM (SELECT *, stop <= start AND target > 0 AS few FROM lagged)),
points AS (SELECT slot, list_reduce(range(bits), lambda c, j: c * 2 + ((slot >> j) & 1), 0) AS point FROM (SELECT bits, unnest(range(1 << bits)) AS slot FROM grid)),
slots AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS k FROM points JOIN cells ON point >= begin_cell AND point < end_cell),
copies AS (
  SELECT p.doc_id, p.source, p.shuffle, row_number, i, floor((i * source_size + start + size / 2.0::DOUBLE) / block)::BIGINT AS k
  FROM placed p JOIN cells c ON p.source IS NOT DISTINCT FROM c.source, range(2) r(i) WHERE size > 0),
taken AS (SELECT row_number, list(slot ORDER BY i) AS slots FROM copies c JOIN slots s ON c.source IS NOT DISTINCT FROM s.source AND c.k = s.k GROUP BY row_number)
SELECT doc_id, size, source_size, target, (size * coalesce(len(slots), 0))::BIGINT AS taken, coalesce(slots, []::BIGINT[]) AS slots
FROM placed p JOIN cells c ON p.source IS NOT DISTINCT FROM c.source LEFT JOIN taken USING (row_number)
"""

ORACLE_SQL = {"op1_chat_format": _SQL_OP1, "op2_ngram_jaccard_join": _SQL_OP2, "op5_url_filter": _SQL_OP5, "op6_sharding": _SQL_OP6, "op8_mixing": _SQL_OP8, "op10_decontamination": _SQL_OP10, "op11_spelling_variants": _SQL_OP11, "op12_conversation_repair": _SQL_OP12}
