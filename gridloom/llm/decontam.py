"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, verified word by word.

Each window of the benchmark has an anchor, the hash of its first words.  The scan of the documents hashes the words
from every position, looks each hash up in the set and gives on only what is found there, with the words that a
window could have; these meet the windows by hash and are compared.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored

#: The hash set of anchors is a table of two bits an anchor among 64 places for each, up to 2 ** this places (16 MB); with
#: more than two million anchors it lets more candidates through, which are verified like all others.
SET_BITS = 27
#: Up to so many windows (about 300 bytes each) the join with candidates broadcasts them; beyond it, both sides are shuffled.
BROADCAST_WINDOWS = 500_000
#: Up to so many contaminated documents (16 bytes each) are broadcast to the rows that are to be cleaned.
BROADCAST_HITS = 1_000_000
#: Of either, in bytes: ids and words have no largest size.
BROADCAST_BYTES = 1 << 26
#: Both cases of A-Z belong to words here; a word of a text is lower-cased where it is compared.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RUN = r"[0-9A-Za-z[^\x00-\x7F]]+"


def low(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def raw_words(text: Column) -> Column:
    """The runs of digits, letters and non-ASCII characters, in the text's own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), "")


def anchor_of(k: Column) -> Column:
    """How many of a window's first words are hashed: the largest of 1, 2, 4 and 8 that it has."""
    return F.when(k >= 8, 8).when(k >= 4, 4).when(k >= 2, 2).otherwise(1)


def with_anchor_hashes(df: DataFrame, words: str, largest: int) -> DataFrame:
    """Add ``_g1``, ``_g2``, ... up to ``largest``: at each position the hash of so many words from there.

    Each is joined from two hashes of half the length.  Words are hashed in full lower case, which never
    separates words that are equal in A-Z lower case; what differs otherwise falls at the verification.
    """
    df = df.withColumn("_g1", F.transform(words, lambda w: F.xxhash64(F.lower(w))))
    k = 1
    while 2 * k <= largest:
        n = F.greatest(F.size(f"_g{k}") - k, F.lit(0))
        df = df.withColumn(f"_g{2 * k}", F.zip_with(F.slice(f"_g{k}", F.lit(1), n), F.slice(f"_g{k}", F.lit(k + 1), n), lambda a, b: F.xxhash64(a, b)))
        k *= 2
    return df


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """One row a distinct window: k (its words), window (array), items (sorted distinct item_ids).

    Items of fewer than ``n`` words, but not none, are one window.  Null texts have none.
    """
    items = benchmark.select("item_id", raw_words(low(F.col("text"))).alias("w")).filter(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(n)))
    each = items.select("item_id", "k", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1), lambda i: F.slice("w", i, F.col("k")))).alias("window"))
    return each.groupBy("k", "window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def anchor_set(known: DataFrame, bits: int) -> DataFrame:
    """One row: the set of the hashes ``_h`` as an array of 64-bit words, with 2 ** ``bits`` places."""
    words = known.select(F.explode(F.array(*_places(F.col("_h"), bits))).alias("s"))
    words = words.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("s") % 64).cast("int"))).alias("v"))
    whole = known.sparkSession.range(0, 1 << (bits - 6), 1, 4).select(F.col("id").alias("w")).join(words, "w", "left").select("w", F.coalesce("v", F.lit(0)).alias("v"))
    # its size is fixed by ``bits``
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("set"))


def _places(h: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1).cast("long")
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def _maybe(h: Column, table: DataFrame, bits: int) -> Column:
    """False for hashes that aren't in the set; true for all that are and for a few others."""
    words, out = table.scalar(), None
    for s in _places(h, bits):
        bit = F.call_function("shiftright", F.element_at(words, (F.shiftright(s, 6) + 1).cast("int")), (s % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        out = bit if out is None else out & bit
    return out


def found_windows(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """One row a distinct (doc_id, text) with a hit: doc_id, text_hash, n_words, spans, n_hit, items."""
    anchors = with_anchor_hashes(benchmark_windows(benchmark, n), "window", 8).withColumn("_a", anchor_of(F.col("k")))
    h = F.when(F.col("_a") == 8, F.element_at("_g8", 1)).when(F.col("_a") == 4, F.element_at("_g4", 1)).when(F.col("_a") == 2, F.element_at("_g2", 1)).otherwise(F.element_at("_g1", 1))
    known, _ = stored(anchors.select("_a", h.alias("_h"), "k", "window", "items"))
    # four rows at most
    counts = known.groupBy("_a").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("window", "items"))).cast("long")).alias("bytes")).collect()
    windows, held, kinds = sum(r["n"] for r in counts), sum(r["bytes"] for r in counts), sorted(r["_a"] for r in counts) or [1]
    bits = min(SET_BITS, max(12, (64 * windows).bit_length()))
    table, _ = stored(anchor_set(known, bits))

    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), raw_words(F.col("text")).alias("w"))
    grams = with_anchor_hashes(base, "w", kinds[-1])
    # the hashes of all anchor lengths in one array; a place in it says the length and the position
    each = grams.select("doc_id", "text_hash", "w", *[F.size(f"_g{a}").alias(f"_n{a}") for a in kinds], F.posexplode(F.concat(*[F.col(f"_g{a}") for a in kinds])).alias("_no", "_h"))
    at, before = F.col("_no"), F.lit(0)
    for a in kinds[:-1]:
        before = before + F.col(f"_n{a}")
        at = F.when(F.col("_no") >= before, F.col("_no") - before).otherwise(at)
    near = each.filter(_maybe(F.col("_h"), table, bits)).select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), at.alias("_at"), "_h", F.slice("w", at + 1, F.lit(n)).alias("_s"))
    known = known.drop("_a")
    met = near.join(F.broadcast(known) if windows <= BROADCAST_WINDOWS and held <= BROADCAST_BYTES else known, "_h")
    hit = met.filter(F.transform(F.slice("_s", F.lit(1), F.col("k")), low) == F.col("window")).select(
        "doc_id", "text_hash", "n_words", F.struct(F.col("_at").alias("start"), (F.col("_at") + F.col("k")).alias("end")).alias("span"), "items"
    )
    found = hit.groupBy("doc_id", "text_hash").agg(F.max("n_words").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("reach"))
    covered = F.aggregate(
        "spans", none,
        lambda a, s: F.struct((a["covered"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["reach"]))).alias("covered"), F.greatest(a["reach"], s["end"]).alias("reach")),
    )["covered"].cast("long")
    return found.select("doc_id", "text_hash", "n_words", "spans", covered.alias("n_hit"), "items")


def scan_hits(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """One row a row of ``docs``: doc_id, text_hash, n_words, spans, n_hit, items.

    ``spans`` are the word spans (from 0, end excluded) of the windows found, sorted; ``n_hit`` counts the words
    inside any; ``items`` are the benchmark items with a window in the document, sorted.

    Null and empty texts have no words and no hits.  Repeated rows are judged once and given each; rows with the
    same doc_id, null or not, and different texts are judged apart.  Texts are scanned whole, however long.  An
    empty benchmark, or one of null texts, hits nothing; an empty table gives an empty one.  Other columns are ignored.
    """
    hits, _ = stored(found_windows(docs, benchmark, n))
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "spans", "n_hit", "items")
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(_RUN)), F.lit(0)).cast("long").alias("n_words"))
    out = base.join(hits, base["doc_id"].eqNullSafe(hits["_id"]) & (base["text_hash"] == hits["_th"]), "left")
    kinds = dict(hits.dtypes)
    none = lambda c: F.coalesce(c, F.expr(f"cast(array() as {kinds[c]})")).alias(c)
    return out.select("doc_id", "text_hash", "n_words", none("spans"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), none("items"))


def contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """At least one hit, and hits in at least one of ``share`` words."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without what repeats the benchmark.

    mode "documents": contaminated documents go, all other rows stay as they are.  mode "spans": every document
    stays; from contaminated ones the hit words are cut, along with the separators between two of them.  Rows
    keep all their columns, whatever they are called; a null text stays null.  Repeated rows share one fate; rows of
    one doc_id with different texts are judged apart.  Texts are scanned whole, however long; an empty table gives an empty one, an
    empty benchmark takes nothing away.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode is documents or spans, not {mode!r}")
    hits = found_windows(docs, benchmark, n).filter(contaminated(F.col("n_hit"), F.col("n_words"), share))
    hits, _ = stored(hits.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), F.col("spans").alias("_spans")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64("text").alias("_th"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h"))
    if mode == "documents":
        keys = hits.select("_id", "_h")
        size = keys.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col("_id").cast("string")).cast("long")), F.lit(0)).alias("bytes")).first()
        return rows.join(F.broadcast(keys) if size["n"] <= BROADCAST_HITS and size["bytes"] <= BROADCAST_BYTES else keys, same, "left_anti").select("_row.*")
    # words and separators alternate; a word goes if a span covers it, a separator if spans cover both neighbours
    words = F.regexp_extract_all("_row.text", F.lit(f"({_RUN})"), 1)
    gaps = F.split("_row.text", _RUN)
    gone = lambda i: F.exists("_spans", lambda s: (s["start"] <= i) & (i < s["end"]))
    kept = F.concat_ws("", F.transform(gaps, lambda g, i: F.concat(F.when((i > 0) & gone(i - 1) & gone(i), "").otherwise(g), F.when(gone(i), "").otherwise(F.coalesce(F.get(words, i), F.lit(""))))))
    cut = rows.join(hits, same, "left").withColumn("_cut", F.when(F.col("_spans").isNotNull(), kept).otherwise(F.col("_row.text")))
    return cut.select(*[F.col("_cut").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
