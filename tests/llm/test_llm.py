import hashlib
import os
import re
import string
import struct
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from compare import both
from pyspark.sql import functions as F

from gridloom.llm import chat, decontam, htmltext, jaccard, mixing, quality, queries, sharding, tokens, urls, webp
from gridloom.llm.common import bit_table, maybe_in
from gridloom.sources.store import shared_dir

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    a, b = both(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], FOLDER)
    assert a == b


# ---- chat formatting


def test_chat_states_and_round_trip(spark):
    hard = "a\\# </turn>\n### Assistant: x\\"
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", hard), (1, 2, "assistant", hard), (2, 0, "assistant", "x"), (3, 0, "user", None), (3, 1, "assistant", ""), (4, 0, "user", "q"),
        (None, 0, "user", "n"), (5, None, "odd: #role", "z"), (6, 1, "user", "b"), (6, 1, "user", "a"), (6, 1, "user", "a"),
    ]
    df = docs(spark, rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("segments", F.lit(1))
    out = {r.conv_id: r for r in chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).collect()}
    assert {k: (r.valid, r.bad_turn) for k, r in out.items()} == {1: (True, None), 2: (False, 1), 3: (True, None), 4: (False, None), None: (False, None), 5: (False, 1), 6: (False, 2)}
    assert [tuple(t) for t in out[1].back] == [("system", "s"), ("user", hard), ("assistant", hard)]
    assert [tuple(t) for t in out[5].back] == [("odd: #role", "z")]
    assert [t.text for t in out[6].back] == ["a", "a", "b"]
    assert [s.text for s in out[3].segments if s.loss] == [""]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_states_decide_losses(spark):
    long = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i} " * (30_000 if i == 5 else 1)) for i in range(3 * chat.FOLD + 1)]
    rows = [*long, (2, 0, "assistant", "x"), (2, 1, "assistant", "y"), (2, 2, "tool", "z")]
    df = docs(spark, rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert (out[1].state, out[1].valid, out[1].bad_turn) == ("asked", False, None)
    assert [s.text for s in out[1].segments if s.loss] == [t for _, _, role, t in long if role == "assistant"]
    assert (out[2].state, out[2].bad_turn) == ("bad", 1) and [s.text for s in out[2].segments if s.loss] == ["x", "y"]
    # another machine, other losses
    t = chat.ChatTemplate(moves={"start": {"user": "asked"}, "asked": {"assistant": "draft"}, "draft": {"assistant": "answered"}}, accepting=("answered",))
    out = chat.format_chats(docs(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b")], "conv_id long, turn long, role string, text string"), t).first()
    assert out.valid and [s.text for s in out.segments if s.loss] == ["b"]


# ---- n-gram Jaccard join


def brute_components(rows, k=5):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both_ = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both_ >= 75 * (len(sets[a]) + len(sets[b]) - both_):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, base = [], [" ".join(f"w{x}" for x in rng.integers(0, 500, n)) for n in (4, 30, 60, 200, 400)]
    for _ in range(160):
        w = base[int(rng.integers(len(base)))].split()
        for _ in range(int(rng.integers(0, 9))):
            w[int(rng.integers(len(w)))] = f"x{int(rng.integers(10**6))}"
        cut = int(rng.integers(0, max(1, len(w) // 5)))
        rows.append((len(rows), " ".join(w[cut:]).upper() if rng.random() < 0.3 else "\t".join(w[cut:])))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "a b"), (1004, "A  b"), (1005, "a b c"), (1006, "ä " * 70_000 + "b"), (1007, "ä " * 70_000 + "b"), (1008, "z" * 200_000)]
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, rows).withColumn("node", F.lit("x"))).collect()}
    assert got == want
    kept = jaccard.keep_one(docs(spark, [*rows, rows[0]]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_keep_one_judges_by_text(spark):
    text = lambda x, end="": " ".join(f"{x}{i}" for i in range(30)) + end
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (6, text("c")), (6, text("d")), (7, text("e")), (7, text("e")), (7, text("e", " z")), (8, text("e", " z"))]
    rows += [(None, text("f"))] * 2 + [(9, "")] * 2 + [(10, None)]
    out = [(r.doc_id, r.text) for r in jaccard.keep_one(docs(spark, rows).withColumn("_id", F.lit(1)).withColumn("root", F.lit("x"))).collect()]
    one = [x for x in out if x[0] == 7]
    assert len(one) == 1 and one[0] in rows
    assert sorted(map(str, out)) == sorted(map(str, [rows[0], rows[2], rows[3], rows[4], one[0], *rows[9:]]))
    assert jaccard.keep_one(docs(spark, [])).count() == 0


def test_jaccard_hot_tiles_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 3)
    rng = np.random.default_rng(2)
    shared = " ".join(f"s{x}" for x in range(40))  # most of each document, yet no two link by it alone
    rows = [(i, f"{shared} " + " ".join(f"o{i}x{x}" for x in range(30))) for i in range(40)]
    rows += [(100 + i, f"{shared} " + " ".join(f"o{i}x{x}" for x in range(30)) + f" z{int(rng.integers(9))}") for i in range(0, 40, 3)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def brute_links(rows, k=5):
    """Links between distinct sets as pairs of the smallest ids, and the number of links of each id."""
    sets = {}
    for i, t in rows:
        w = t.translate(LOW).split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    links, own = set(), sorted(first.items(), key=lambda x: x[1])
    for n, (a, i) in enumerate(own):
        for b, j in own[n + 1 :]:
            common = len(a & b)
            if 100 * common >= 75 * (len(a) + len(b) - common):
                links.add((i, j))
    return links, {i: sum(first[s] in x for x in links) for i, s in sets.items()}


@pytest.mark.parametrize(("block", "sample"), [(7, 16), (512, 1)])
def test_jaccard_counts_and_gives_all_links(spark, monkeypatch, block, sample):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LEVEL_SAMPLE", sample)
    rng = np.random.default_rng(8)
    rows = [(n, " ".join(f"w{x}" for x in range(60)) + end) for n, end in enumerate((" 1", " 2", " 3"))]  # all three link
    for size, copies in ((80, 60), (200, 30), (40, 2), (50, 3)):
        base = [f"v{x}" for x in rng.integers(0, 10**6, size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"x{int(rng.integers(10**6))}"
            rows.append((len(rows), " ".join(w)))
    chain = [f"c{x}" for x in range(160)]  # linked with neighbours only
    rows += [(len(rows) + i, " ".join(chain[6 * i : 6 * i + 70])) for i in range(15)]
    links, counts = brute_links(rows)
    assert {(0, 1), (0, 2), (1, 2)} <= links
    df = docs(spark, rows)
    got = [tuple(sorted((r.doc_a, r.doc_b))) for r in jaccard.jaccard_links(df).collect()]
    assert sorted(got) == sorted(links)
    assert {r.doc_id: r.n_links for r in jaccard.jaccard_components(df).collect()} == counts


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75])
def test_jaccard_links_over_many_size_bands(spark, monkeypatch, threshold):
    """One text that grows by steps crosses bands; at low thresholds sets link over more than one band."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    words = [f"g{x}" for x in range(400)]
    rows = [(n, " ".join(words[:size])) for n, size in enumerate(int(8 * 1.13**x) for x in range(32))]
    rows += [(100 + n, " ".join([*words[10 * n : 10 * n + 60], f"e{n}"])) for n in range(20)]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    want = [(i, j) for i in sets for j in sets if i < j and sets[i] != sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    want = sorted({tuple(sorted((first[i], first[j]))) for i, j in want})
    got = sorted(tuple(sorted((r.doc_a, r.doc_b))) for r in jaccard.jaccard_links(docs(spark, rows), 5, threshold).collect())
    assert got == want


@pytest.mark.parametrize("edits", [0, 6, 20, 90])
def test_linked_pairs_equal_exact_overlaps(edits):
    """Whether all, some or no pairs are left after bit counts, the pairs are those of exact intersections."""
    rng = np.random.default_rng(edits)
    base = rng.integers(0, 2**62, 200).astype(np.uint64)

    def near(count):
        for _ in range(count):
            s = base.copy()
            s[rng.integers(0, 200, edits)] = rng.integers(0, 2**62, edits).astype(np.uint64)
            yield np.unique(s[: int(rng.integers(20, 201))])

    left, right = list(near(530)), list(near(90))
    for t in (Fraction(3, 4), Fraction(1, 3)):
        for a, b, same in ((left, right, False), (right, left, False), (right, right, True)):
            common = jaccard.overlaps(a, b)
            want = t.denominator * common >= t.numerator * (np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b]) - common)
            got = [(int(x), int(y)) for i, j in jaccard.linked_pairs(a, b, t, same) for x, y in zip(i, j, strict=True)]
            assert len(got) == len(set(got))
            seen = {tuple(sorted(p)) for p in got} if same else set(got)
            assert seen == {(int(x), int(y)) for x, y in np.argwhere(np.triu(want, 1) if same else want)}


def test_bounds_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for size, width, count in ((60, 128, 40), (3000, 8192, 5)):
        sets = [np.unique(rng.integers(0, 2 * size, size).astype(np.uint64)) for _ in range(count)]
        bits, n = jaccard.bit_rows(sets, width), np.array([len(s) for s in sets])
        most, real = jaccard.bounds(bits, bits, n, n), jaccard.overlaps(sets, sets)
        assert (most >= real).all() and (np.diag(most) == n).all()


def test_overlaps_equal_intersections():
    rng = np.random.default_rng(5)
    left, right = ([np.unique(np.append(rng.integers(0, top, n), 7).astype(np.uint64)) for n, top in zip(rng.integers(0, 60, k), rng.choice([50, 5000], k), strict=True)] for k in (150, 90))
    assert (jaccard.overlaps(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()


def test_jaccard_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "q w e r t y"), (None, "q w e r t y")]
    got = sorted(jaccard.jaccard_components(docs(spark, rows)).collect(), key=str)
    assert sorted(str(r.component_id) for r in got) == ["7", "7", "None", "None"]
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0


def test_overlap_bound_never_below_the_overlap():
    rng = np.random.default_rng(0)
    for n, m in ((3, 4), (70, 90), (130, 120), (1000, 800)):
        a, b = (np.unique(rng.integers(0, 1200, x).astype(np.uint64)) for x in (n, m))
        assert jaccard.overlap_bound(jaccard._bitmap(a), jaccard._bitmap(b), len(a), len(b)) >= len(np.intersect1d(a, b))


def test_bit_table(spark):
    table = bit_table(spark.range(50), "id", 12)
    assert spark.range(50).filter(maybe_in("id", table, 12)).count() == 50
    assert spark.range(50, 1050).filter(maybe_in("id", table, 12)).count() < 60


# ---- quality classifier


def test_quality_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = queries.op3_quality_classifier(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out")
    hit = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("predicted")))).first()
    assert hit[0] > 0.98 and hit[1] > 0.99
    model = quality.train(d, labels.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id"))))
    odd = docs(spark, [(1, None), (2, ""), (3, "%%% " * 50_000), (3, "a")]).withColumn("score", F.lit("clash"))
    scores = [r.score for r in quality.score_quality(odd, model).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores)
    assert quality.train(d, labels.limit(0)).scores([np.zeros(0, np.int32)])[0] == pytest.approx(0.5)
    assert quality.score_quality(docs(spark, []), model).count() == 0


def test_quality_counts_ratios_and_fit_by_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice(["good", "fine", "text", "and"] if i % 3 else ["BUY!!", "now", "$$", "text"], 6))) for i in range(120)]
    marks = [(i, int(i % 3 > 0)) for i in range(100)] + [(3, 1), (None, 0), (7, None), (8, 5)]
    model = quality.train(docs(spark, [*rows, rows[5]]), docs(spark, marks, "doc_id long, quality int"))
    of = lambda t: next(quality.features(__import__("pyarrow").array([t])))[1][0]
    used = {i: y for i, y in marks[:100] if zlib.crc32(str(i).encode()) % 4 != 2 and i != 3}
    if zlib.crc32(b"3") % 4 != 2:
        used[3] = 0
    counts, n = np.zeros((2, 1 << quality.FEATURE_BITS)), [0, 0]
    for i, t in [*rows, rows[5]]:
        if i in used:
            n[used[i]] += 1
            for f in of(t):
                counts[used[i], f] += 1
    small = quality.SMOOTH / min(n)
    want = np.log(counts[1] / n[1] + small) - np.log(counts[0] / n[0] + small)
    assert model.ratios == pytest.approx(want)
    # the fit's objective can't be bettered by small steps
    ids = [i for i in used]
    x, y = [of(rows[i][1]) for i in ids], np.array([2 * used[i] - 1 for i in ids])
    sizes = [np.sqrt(np.square(want[f]).sum() + model.floor) for f in x]
    caps = np.where(y > 0, quality.COST * len(y) / (2 * (y > 0).sum()), quality.COST * len(y) / (2 * (y < 0).sum()))
    plain = np.divide(model.weights, want, out=np.zeros_like(want), where=want != 0)

    def loss(w, b):
        f = np.array([(w[k] * want[k]).sum() / s for k, s in zip(x, sizes)]) + b
        return (np.square(w).sum() + b * b) / 2 + (caps * np.maximum(0, 1 - y * f)).sum()

    at = loss(plain, model.bias)
    for _ in range(20):
        assert loss(plain + rng.normal(0, 0.02, len(plain)) * (plain != 0), model.bias + rng.normal(0, 0.02)) >= at - 1e-3
    assert [r.score for r in quality.score_quality(docs(spark, rows), model).orderBy("doc_id").collect()] == pytest.approx(model.scores([of(t) for _, t in rows]).tolist())


def test_quality_query_by_brute_force(spark):
    """Counts, ratios and scores by plain loops over the tables; the fit itself is tested above."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    of = lambda t: next(quality.features(__import__("pyarrow").array([t or ""])))[1][0]
    sets = {i: of(t) for i, t in texts.items()}
    used = sorted(i for i in texts if marks.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2)
    n = [sum(marks[i] == y for i in used) for y in (0, 1)]
    assert 0 < min(n) and max(n) <= quality.FIT_ROWS
    counts = [np.zeros(1 << quality.FEATURE_BITS) for _ in n]
    for i in used:
        for f in sets[i]:
            counts[marks[i]][f] += 1
    small = quality.SMOOTH / min(n)
    ratios = np.log(counts[1] / n[1] + small) - np.log(counts[0] / n[0] + small)
    model = quality.fit_hinge([sets[i] for i in used], np.array([marks[i] for i in used]), ratios, n[1] / sum(n))
    got = queries.op3_quality_classifier(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        x = sets[r.doc_id]
        margin = sum(model.weights[f] for f in x) / (sum(ratios[f] ** 2 for f in x) + model.floor) ** 0.5 if len(x) else 0.0
        want = 1 / (1 + np.exp(-(model.slope * (margin + model.bias) + model.shift)))
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_features_of_words_and_shapes():
    import pyarrow as pa

    def sets(*texts, kind):
        return [set(f.tolist()) for _, found in quality.features(pa.array(texts), (kind,)) for f in found]

    a, b, c, d = sets("Big Red dog", "big rEd\tDOG", "big dog", "", kind=quality.WORDS)
    assert a == b and len(a) == 5 and len(a & c) == 2 and not d
    a, b = sets("cat dog", "sun hat", kind=quality.SHAPES)
    assert a == b and len(a) == 2


def test_quality_fits_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_BYTES", 2000)
    rows = [(i, ("good text " if i % 2 else "$$ !! ") * 20) for i in range(80)]
    model = quality.train(docs(spark, rows), docs(spark, [(i, i % 2) for i in range(80)], "doc_id long, quality int"))
    out = quality.score_quality(docs(spark, rows), model).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in out)


def test_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    d, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    small = quality.train(d, labels)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0)
    large = quality.train(d, labels)
    assert large.ratios.tolist() == small.ratios.tolist() and large.weights == pytest.approx(small.weights)


def test_hinge_fit_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.append(rng.integers(0, 50, 9), 50 + (i % 2))).astype(np.int32) for i in range(200)]
    ratios = np.append(rng.normal(0, 0.1, 50), [-2.0, 2.0])
    model = quality.fit_hinge(rows, np.arange(200) % 2, ratios)
    assert ((model.scores(rows) > 0.5) == (np.arange(200) % 2 == 1)).all()


# ---- media columns


def test_media_round_trip(spark):
    texts = [None, "", "a", "é" * 31 + "ab", "x" * 64, "x" * 65, string.printable * 50, "y" * (64 * webp.MAX_SIDE + 5), "x" * 64, ("=" * 64 + "\n") * 300, "".join(chr(32 + i * i % 90) for i in range(9000))]
    rows = webp.to_media(docs(spark, list(enumerate(texts))).withColumn("media", F.lit(1)))
    out = webp.read_media(rows).orderBy("doc_id").collect()
    for r, t in zip(out, texts, strict=True):
        payload = webp.padded((t or "").encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), None)
    assert out[0].media_sha256 == out[1].media_sha256 and out[4].feature == out[8].feature
    assert webp.read_media(docs(spark, [(1, None)], "doc_id long, media binary")).first().payload_bytes is None
    assert webp.to_media(docs(spark, [])).count() == 0


def test_corrupt_media_are_reported(spark):
    good = webp.store_bytes(webp.padded(string.printable.encode() * 40))
    large = webp.store_bytes(webp.padded(string.printable.encode() * 300))
    bad = [b"", b"RIFF", b"junk" * 30, good[:40], good[:-20], good[:12] + b"XXXX" + good[16:], large[:500]]
    short = bytearray(good[:-30])  # sizes that fit, yet too few bits
    short[4:8], short[16:20] = (len(short) - 8).to_bytes(4, "little"), (len(short) - 20).to_bytes(4, "little")
    rows = docs(spark, [(i, bytearray(m)) for i, m in enumerate([good, *bad, short])], "doc_id long, media binary")
    out = webp.read_media(rows).orderBy("doc_id").collect()
    assert out[0].error is None and out[0].payload_bytes == len(string.printable) * 40 // 64 * 64 + 64 * (len(string.printable) * 40 % 64 > 0)
    assert all(r.error and r.payload_sha256 is None and r.feature is None for r in out[1:])
    assert [r.error is None for r in webp.read_pixels(rows).orderBy("doc_id").collect()] == [True] + [False] * 8


def test_media_query_by_brute_force(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    out = queries.op4_media_columns(spark, FOLDER).collect()
    assert len(out) == len(texts)
    for r in out:
        raw = texts[r.doc_id]
        payload = raw + bytes(max(64, (len(raw) + 63) // 64 * 64) - len(raw))
        media = webp.store_bytes(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        mean = sum(payload) / len(payload)
        found = dict(x.split("=") for x in r.feature.split(";"))
        assert int(found["w"]) * int(found["h"]) * (4 if len(payload) >= webp.LARGE else 1) == len(payload)
        assert float(found["mean"]) == pytest.approx(mean, abs=1e-4) and float(found["var"]) == pytest.approx(sum((x - mean) ** 2 for x in payload) / len(payload), rel=1e-4, abs=1e-3)
        assert [float(x) for x in found["q"].split(",")] == pytest.approx([sum(q <= x // 64 < q + 1 for x in payload) / len(payload) for q in range(4)], abs=1e-4)


def test_stored_media_use_all_of_the_format(monkeypatch):
    """What the writer stores must be undone by every transform, copies and cache entries on the way back."""
    met = set()
    for name in ("predicted", "cross_coloured"):
        plain = getattr(webp, name)

        def noted(image, data, size_bits, invert, name=name, plain=plain):
            if invert and (data & np.uint32(0xFFFFFF)).any():
                met.add(name)
            return plain(image, data, size_bits, invert)

        monkeypatch.setattr(webp, name, noted)
    plain_write = webp._write_image

    def write(w, px, width, main, cache_bits=0, least=0):
        out = plain_write(w, px, width, main, cache_bits, least)
        if least and webp._matches(px, least):
            met.add("copies")
        if cache_bits and len(out) < len(plain_write(webp.BitWriter(), px, width, True, 0, least)):
            met.add("cache")
        return out

    monkeypatch.setattr(webp, "_write_image", write)
    words = np.random.default_rng(1).choice(["spark ", "table ", "shuffle ", "of ", "a "], 4000)
    for text in ("x" * 64 * 40, "".join(words)[:4000], "".join(words), "=" * 20_000, "ab" * 40 + "\n"):
        payload = webp.padded(text.encode())
        assert b"".join(webp.stored_samples(i).tobytes() for i in webp.stored_images(webp.store_bytes(payload))) == payload
    assert met == {"predicted", "cross_coloured", "copies", "cache"}


class Writer(webp.BitWriter):
    """Writes images with literals, copies and cache entries, each with codes made for it."""

    def prefix(self, v):
        if v <= 4:
            return v - 1, 0, 0
        top = (v - 1).bit_length() - 1
        half = (v - 1) >> (top - 1) & 1
        return 2 * top + half, top - 1, (v - 1) & ((1 << (top - 1)) - 1)

    def image(self, pixels, width, main, cache_bits=0, copies=False):
        cache, out, i = [None] * (1 << cache_bits), [], 0
        note = lambda p: cache.__setitem__((0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits), p) if cache_bits else None
        while i < len(pixels):
            p = int(pixels[i])
            run = next((n for n in range(len(pixels) - i) if pixels[i + n] != pixels[i + n - 5]), len(pixels) - i) if copies and i >= 5 else 0
            if run >= 3:
                out.append(("copy", run))
                for q in pixels[i : i + run]:
                    note(int(q))
                i += run
                continue
            slot = (0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else None
            out.append(("cache", slot) if cache_bits and cache[slot] == p else ("pixel", p))
            note(p)
            i += 1
        self(1 if cache_bits else 0, 1)
        if cache_bits:
            self(cache_bits, 4)
        if main:
            self(0, 1)
        lists = [[], [], [], [], []]
        for kind, v in out:
            if kind == "pixel":
                for k, s in enumerate((8, 16, 0, 24)):
                    lists[k].append(v >> s & 255)
            elif kind == "cache":
                lists[0].append(280 + v)
            else:
                lists[0].append(256 + self.prefix(v)[0])
                lists[4].append(self.prefix(125)[0])
        lengths = [webp.code_lengths(np.bincount(x or [0], minlength=n)) for x, n in zip(lists, (280 + (len(cache) if cache_bits else 0), 256, 256, 256, 40), strict=True)]
        codes = [webp.codes_of(x) for x in lengths]
        for x in lengths:
            self.lengths(x)
        put = lambda k, s: self(int(codes[k][s]), int(lengths[k][s]))
        for kind, v in out:
            if kind == "pixel":
                for k, s in enumerate((8, 16, 0, 24)):
                    put(k, v >> s & 255)
            elif kind == "cache":
                put(0, 280 + v)
            else:
                for k, (s, extra, rest) in ((0, self.prefix(v)), (4, self.prefix(125))):
                    put(k, s + 256 * (k == 0))
                    self(rest, extra)

    def file(self, alpha=1):
        data = self.value.to_bytes(-(-self.size // 8), "little")
        chunk = b"VP8L" + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) & 1)
        return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk

    def start(self, width, height):
        self(0x2F, 8)
        self(width - 1, 14)
        self(height - 1, 14)
        self(1, 1)
        self(0, 3)
        return self


def noise(width, height, colours=None, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**32, (height, width), dtype=np.uint64).astype(np.uint32)
    return x if colours is None else x.ravel()[:colours][rng.integers(0, colours, (height, width))]


def same(file, image):
    assert (webp._packed(webp.decode(file)) == image).all()


def test_webp_literals_cache_and_copies():
    image = noise(13, 9, 7)
    image[4:] = np.resize(image[3, :5], (5, 13))
    for cache_bits in (0, 3, 10):
        for copies in (False, True):
            w = Writer().start(13, 9)
            w(0, 1)
            w.image(image.ravel(), 13, True, cache_bits, copies)
            same(w.file(), image)


def test_webp_groups_of_codes():
    image, w = noise(12, 9, 60, seed=4), Writer().start(12, 9)
    tiles = (np.arange(9).reshape(3, 3) % 2).astype(np.uint32)
    w(0, 1)
    w(0, 1)
    w(1, 1)
    w(0, 3)
    w.image((tiles << 8).ravel(), 3, False)
    of = tiles[np.arange(9)[:, None] >> 2, np.arange(12) >> 2]
    codes = {}
    for group in (0, 1):
        px = image[of == group]
        lengths = [webp.code_lengths(np.bincount((px >> s & 255).astype(int), minlength=280 if s == 8 else 256)) for s in (8, 16, 0, 24)] + [webp.code_lengths(np.bincount([0], minlength=40))]
        for x in lengths:
            w.lengths(x)
        codes[group] = [(webp.codes_of(x), x) for x in lengths]
    for p, group in zip(image.ravel().tolist(), of.ravel().tolist(), strict=True):
        for (c, x), s in zip(codes[group], (8, 16, 0, 24), strict=False):
            w(int(c[p >> s & 255]), int(x[p >> s & 255]))
    same(w.file(), image)


@pytest.mark.parametrize("size", [(1, 1), (1, 40), (70, 1), (64, 30), (33, 27)])
def test_webp_writer_and_reader(size):
    rng = np.random.default_rng(size[0])
    for colours in (1, 2, 5, 40, 300):
        image = rng.integers(0, 2**32, colours, dtype=np.uint64).astype(np.uint32)[rng.integers(0, colours, size)]
        image[size[0] // 2 :] = np.resize(image[0], image[size[0] // 2 :].shape)
        for palette in (False, True)[: 1 + (colours <= 256)]:
            for cache_bits, least in ((0, 0), (0, 4), (6, 8), (11, 2)):
                same(webp.encode_pixels(image, palette, 2 + size[1] % 5, cache_bits, least), image)


def test_predictor_by_single_neighbours_equals_the_plain_loop():
    image = noise(21, 17, seed=8)
    for modes in (np.zeros((5, 6), np.uint32), (noise(6, 5, seed=1) % np.uint32(5)) << np.uint32(8)):
        done = webp.predicted(image, modes, 2, False)
        assert (done == webp._predicted_one_by_one(image, modes >> 8, 2, False)).all()
        assert (webp.predicted(done, modes, 2, True) == image).all()


def test_webp_transforms():
    image = noise(21, 17, seed=2)
    for mode in range(14):
        modes = np.full((5, 6), mode << 8, dtype=np.uint32)
        w = Writer().start(21, 17)
        w(1, 1)
        w(0, 2)
        w(0, 3)
        w.image(modes.ravel(), 6, False)
        w(0, 1)
        w.image(webp.predicted(image, modes, 2, False).ravel(), 21, True)
        same(w.file(), image)
    factors = noise(6, 5, seed=3)
    green = image.copy()
    crossed = webp.cross_coloured(image, factors, 2, False)
    g = (crossed >> 8) & 255
    green = (crossed & 0xFF00FF00) | ((((crossed >> 16) - g) & 255) << 16) | ((crossed - g) & 255)
    w = Writer().start(21, 17)
    w(1, 1)
    w(1, 2)
    w(0, 3)
    w.image(factors.ravel(), 6, False)
    w(1, 1)
    w(2, 2)
    w(0, 1)
    w.image(green.ravel(), 21, True)
    same(w.file(), image)


@pytest.mark.parametrize("colours", [1, 2, 4, 16, 40])
def test_webp_palette(colours):
    image = noise(11, 6, colours, seed=colours)
    palette = np.unique(image)
    c = webp._channels(palette)
    delta = webp._packed(np.diff(c, axis=0, prepend=np.zeros((1, 4), int)) & 255)
    n = len(palette)
    pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    index, each = np.searchsorted(palette, image), 8 >> pack
    inner = -(-11 >> pack)
    packed = np.zeros((6, inner), dtype=np.uint32)
    for x in range(11):
        packed[:, x >> pack] |= (index[:, x] << (each * (x & ((1 << pack) - 1)))).astype(np.uint32) << 8
    w = Writer().start(11, 6)
    w(1, 1)
    w(3, 2)
    w(n - 1, 8)
    w.image(delta, n, False)
    w(0, 1)
    w.image(packed.ravel(), inner, True)
    same(w.file(), image)


def test_webp_pixels_of_a_column(spark):
    rows = docs(spark, [(1, bytearray(webp.encode_pixels((np.arange(128, dtype=np.uint32) << 8 | np.uint32(0xFF000000)).reshape(8, 16), True))), (2, None)], "doc_id long, media binary")
    out = {r.doc_id: r for r in webp.read_pixels(rows).collect()}
    assert (out[1].width, out[1].height, out[1].argb[5]) == (16, 8, 0xFF000500) and out[2].argb is None


def test_media_take_few_steps():
    """Calls a text, which are most of the cost of small images: 1,640 before codes, copies and constant images took fewer, 1,190 since."""
    words = np.random.default_rng(2).choice(["spark", "table", "shuffle", "of", "a", "rows,", "window", "Join", "and", "\n"], 6000)
    payloads = [webp.padded(" ".join(words[i : i + 40 + i // 12]).encode()) for i in range(0, 4000, 100)]
    again = lambda: [b"".join(webp.stored_samples(i).tobytes() for i in webp.stored_images(webp.store_bytes(p))) for p in payloads]
    assert again() == payloads  # which fills all tables
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        again()
    finally:
        sys.setprofile(None)
    assert calls / len(payloads) < 1300


def test_media_that_end_inside_their_last_token():
    words = np.random.default_rng(1).choice(["spark ", "table ", "shuffle ", "of ", "a "], 4000)
    for text in ("".join(words)[:4000], "".join(words), "".join(chr(32 + i * i % 90) for i in range(9000))):
        for more in range(40):
            good = webp.store_bytes(webp.padded((text + "xyz"[more % 3] * more).encode()))
            size = int.from_bytes(good[16:20], "little")
            cut = bytearray(good[: 20 + size - 1])
            cut += b"\0" * (len(cut) & 1)
            cut[4:8], cut[16:20] = (len(cut) - 8).to_bytes(4, "little"), (size - 1).to_bytes(4, "little")
            with pytest.raises(ValueError):
                list(webp.stored_images(bytes(cut)))


def test_code_lengths_by_all_signs():
    """Lengths written with repeats of the last one, both kinds of runs of zeros and a number of signs."""
    rng = np.random.default_rng(5)
    for turn in range(60):
        size = (40, 256, 280, 280 + 1024)[turn % 4]
        counts = rng.integers(0, 3, size) * rng.integers(1, 2 + 40 * (turn % 3), size) * (np.arange(size) // (3 + turn) % 2)
        counts[:2] += 1
        lengths = webp.code_lengths(counts)
        signs, i, last = [], 0, 8
        while i < size:
            run = next((k for k in range(1, size - i) if lengths[i + k] != lengths[i]), size - i)
            if not lengths[i] and run >= 3:
                run = min(run, 138)
                signs.append((18, run - 11, 7) if run >= 11 else (17, run - 3, 3))
            elif lengths[i] == last and run >= 3:
                run = min(run, 6)
                signs.append((16, run - 3, 2))
            else:
                run, last = 1, int(lengths[i]) or last
                signs.append((int(lengths[i]), 0, 0))
            i += run
        of_signs = webp.code_lengths(np.bincount([s for s, _, _ in signs], minlength=19), 7)
        codes, w = webp.codes_of(of_signs), webp.BitWriter()
        w(0, 1)
        w(15, 4)
        for s in webp._LENGTH_ORDER:
            w(int(of_signs[s]), 3)
        if turn % 2:
            w(1, 1)
            w(7, 3)
            w(len(signs) - 2, 16)
        else:
            w(0, 1)
        for s, extra, k in signs:
            w(int(codes[s]), int(of_signs[s]))
            w(extra, k)
        bits = webp.Bits(w.value.to_bytes(w.size // 8 + 1, "little"))
        found, wanted = webp.read_code(bits, size), webp.PrefixCode(lengths)
        assert bits.at == w.size
        assert (found.symbols == wanted.symbols).all() and (found.lengths == wanted.lengths).all()
        used = lengths.nonzero()[0]
        at = webp.codes_of(lengths)[used]
        assert (wanted.symbols[at] == used).all() and (wanted.lengths[at] == lengths[used]).all()
    for bad in ([1, 1, 1], [1, 2], [1, 1, *[5] * 30], [2] * 3, [6] * 60):
        with pytest.raises(ValueError):
            webp.PrefixCode(np.array(bad, dtype=np.uint8))


# ---- URL filter


@pytest.mark.parametrize("most", [urls.MAX_RULE_CHARS, 0])
def test_url_rules(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MAX_RULE_CHARS", most)  # 0: by a join
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "", "block"), ("org", "/", "block"), ("a.net", "/x", "block"), ("a.net", "/x", "allow")]
    cases = {
        "http://EXAMPLE.com/en/71": ("example.com/en/7", "allow"), "https://m.example.com/en/7?q": ("example.com/en/7", "allow"), "http://x.com/en/": ("com/en/", "block"),
        "http://x.com/en": (None, "allow"), "http://b.a.net/xyz#t": ("a.net/x", "block"), "http://net": ("net/", "block"), "http://org": (None, "allow"), "http://org/": ("org/", "block"), "http://notnet/": (None, "allow"), "": (None, "allow"),
        None: (None, "allow"), "x.com/en/1": (None, "allow"), "http://x.com:80/en/": (None, "allow"), "http://c" + "/" * 100_000: (None, "allow"), "http://c/" + "x" * 100_000: (None, "allow"),
    }
    df = docs(spark, list(enumerate(cases)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    assert [(r.rule, r.verdict) for r in urls.filter_urls(df, rules).orderBy("page_id").collect()] == list(cases.values())
    assert urls.filter_urls(df.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        urls.filter_urls(df, [("com", "/", "maybe")])
    t = urls.RuleTrie([("com", f"/a/{i}", "block") for i in range(100_000)])
    assert t.match("x.com", "/a/99999z") == ("com/a/99999", "block") and t.match("x.com", "/a/") is None


# ---- sharding


def test_permutation_is_one():
    for n in (1, 2, 7, 1000, 4097):
        assert sorted(sharding.permute(np.arange(n), n).tolist()) == list(range(n))


def test_shards_are_even(spark):
    rows = [(i % 90, None if i % 7 == 0 else str(i % 5)) for i in range(203)] + [(None, "x")] * 3
    out = sharding.shard_rows(docs(spark, [*rows[:-1], (None, "x" * 300_000)]).withColumns({c: F.lit("clash") for c in ("slot", "bucket", "_crc")}), 7)
    assert {"bucket", "_crc"} < set(out.columns)
    out = out.collect()
    assert sorted((r.row_number for r in out)) == list(range(206))
    by = {s: sorted(r.slot for r in out if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sharding.shard_rows(docs(spark, []), 7).count() == 0


def test_sharding_query_by_brute_force(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    n = len(d)

    def chained(seed, *values):
        for form, v in values:
            seed = xxhash.xxh64(struct.pack(form, v), seed=seed).intdigest()
        return seed

    def order(doc_id, crc):
        inner = zlib.crc32(str(crc).encode())  # of the text that the query hands on
        h = chained(42, ("<q", doc_id), ("<q", inner), ("<i", 17))
        return ((h - (1 << 64) if h >> 63 else h) % 1024, doc_id, inner)

    raw = {r.doc_id: (r.text or "").encode() for r in d}
    number = {x: i for i, x in enumerate(sorted(raw, key=lambda x: order(x, zlib.crc32(raw[x]))))}
    placed = sharding.permute(np.arange(n), n, 1)
    got = queries.op6_sharding(spark, FOLDER).collect()
    assert len(got) == n
    for r in got:
        p = int(placed[number[r.doc_id]])
        assert (r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) == (len(raw[r.doc_id]) + 16, zlib.crc32(raw[r.doc_id]), "rows", p % 40, p // 40, None)


# ---- token counts


def test_token_counts(spark):
    rows = [(1, "a", "hello world\n\nnext line"), (2, None, None), (3, "b", "é😀 x"), (4, "b", "\n"), (5, "c", "w" * 30_000), (5, "c", "w" * 30_000)]
    df = docs(spark, rows, "doc_id long, source string, text string").withColumn("n_tokens", F.lit("clash"))
    encoding, lengths = tokens.tokenizer(None, tokens.PATTERN)
    for rule in tokens.RULES:
        for r in tokens.token_counts(df, ("source", "text"), rule).collect():
            _, source, text = rows[r.doc_id - 1]
            whole = (source or "") + "\n" + (text or "")
            ids = encoding.encode_ordinary(whole)
            assert (r.n_tokens, r.n_chars) == (len(ids), len(whole))
            assert sum(s.tokens for s in r.sections) == len(ids)
            assert "".join(whole[s.start : s.end] for s in r.sections) == whole
            ends = np.cumsum(lengths[ids])
            marks = [len(whole[: s.start].encode()) for s in r.sections] + [len(whole.encode())]
            want = [0] * len(r.sections)
            crossing = 0
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                shares = [max(0, min(b, marks[i + 1]) - max(a, marks[i])) for i in range(len(want))]
                touched = [i for i, x in enumerate(shares) if x]
                crossing += len(touched) > 1
                want[touched[0] if rule == "first" else touched[-1] if rule == "last" else shares.index(max(shares))] += 1
            assert [s.tokens for s in r.sections] == want and r.n_crossing == crossing
    assert tokens.token_counts(df.limit(0), ("source", "text")).count() == 0


def test_token_query_by_brute_force(spark):
    """Each token goes to the section in which its first byte lies, found byte by byte."""
    rows = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    encoding, lengths = tokens.tokenizer(None, tokens.PATTERN)
    got = queries.op7_token_counts(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        d = rows[r.doc_id]
        lines = (d.text or "").split("\n")
        sections = [(d.source or "") + "\n", (d.lang or "") + "\n", *[x + "\n" for x in lines[:-1]], lines[-1]]
        owner = [i for i, x in enumerate(sections) for _ in x.encode()]
        whole = "".join(sections)
        ids = encoding.encode_ordinary(whole)
        want, crossing, at = [0] * len(sections), 0, 0
        for i in ids:
            end = at + int(lengths[i])
            want[owner[at]] += 1
            crossing += owner[at] != owner[end - 1]
            at = end
        assert at == len(owner)
        assert (r.n_tokens, r.n_chars, r.n_sections, r.n_crossing, r.section_tokens) == (len(ids), len(whole), len(sections), crossing, want)


# ---- mixing


def brute_targets(sizes, epochs=1.5, most=2.0):
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, free, left = {}, set(names), epochs * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = most * sizes[s]
            left -= want[s]
            free.discard(s)
    return names, want


def test_mix_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, None if i % 50 == 0 else "w " * int(rng.integers(0, 40)), "s0" if i % 3 == 0 else None if i % 3 == 1 else f"s{i % 7}") for i in range(2000)]
    rows += [(5000, "one two", "tiny"), (5001, None, "wordless"), (5002, "x " * 20_000, "s1")]
    df = docs(spark, rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    out = mixing.mix_sources(df).collect()
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    names, want = brute_targets(sizes)
    total = sum(want.values())
    bits = max(4, int(np.ceil(np.log2(1.5 * sum(sizes.values()) / mixing.BLOCK_WORDS))))
    owner, reach, ends = {}, 0.0, []
    for s in names:
        reach += want[s]
        ends.append(int(np.ceil(reach / total * (1 << bits) - 1e-9)))
    slots = {s: [] for s in names}
    for t in range(1 << bits):  # each slot's point, looked up in the cumulated shares
        cell = int(f"{t:0{bits}b}"[::-1], 2)
        slots[names[int(np.searchsorted(ends, cell, side="right"))]].append(t)
    taken = {s: 0 for s in names}
    for r in out:
        taken[r.source] += r.size * len(r.slots)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and len(r.slots) <= 2
        assert set(r.slots) <= set(slots[r.source]) or not slots[r.source]
    for s in names:
        longest = max(r.size for r in out if r.source == s)
        assert abs(taken[s] - want[s]) <= mixing.BLOCK_WORDS + longest / 2 + 1
    # what is taken of a source are the blocks of its stream that have slots, in the order of its slots
    block = total / (1 << bits)
    for s in ("s0", "s1", None):
        stream = sorted((x for r in out if r.source == s for x in r.slots))
        used = [slots[s].index(x) for x in stream]
        assert used == sorted(used) and max(used) >= len(slots[s]) - 2 - max(r.size for r in out if r.source == s) / block
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix_sources(df.limit(0)).count() == 0
    empty = mixing.mix_sources(docs(spark, [(1, None, "a"), (2, "", None), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r.target, r.slots) for r in empty] == [(0.0, [])] * 3


def test_slots_of_a_rank(spark):
    bits = 6
    rows = [(b, e, k) for b, e in ((0, 64), (5, 6), (17, 40), (63, 64)) for k in range(e - b)]
    df = docs(spark, rows, "b long, e long, k long")
    for r in df.withColumn("slot", mixing.slot_at(F.col("b"), F.col("e"), F.col("k"), bits)).collect():
        assert r.slot == sorted(int(f"{c:06b}"[::-1], 2) for c in range(r.b, r.e))[r.k]


def test_mix_query_by_brute_force(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    out = queries.op8_mixing(spark, FOLDER).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id, r.size) for r in out) == sorted((r.doc_id, count(r.text)) for r in d)
    source, sizes, taken = {r.doc_id: r.source for r in d}, {}, {}
    for r in out:
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        assert r.taken <= 2 * r.size
    _, want = brute_targets(sizes)
    for r in out:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
    for s in want:
        assert abs(taken[s] - want[s]) <= 64 + max(r.size for r in out if source[r.doc_id] == s) / 2


# ---- HTML extraction


def test_main_text_of_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    edge = [(None, None), (-1, ""), (-2, "<"), (-3, "<p>" * 3000), (-4, "<nav><a href=x>menu</a></nav>")]
    df = docs(spark, [(r.page_id, r.html) for r in rows] + edge, "page_id long, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r.text for r in htmltext.extract_text(df).collect()}
    import html

    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)]
        assert got[r.page_id] == "\n".join(x for x in lines if x)
    assert [got[k] for k in (None, -1, -3)] == ["", "", ""]


def test_labeller_on_fresh_layouts():
    w = htmltext.train()
    pages = list(htmltext.practice_pages(150, seed=1234))
    right = sum(a == b for a, (_, b) in zip(htmltext.main_texts([p for p, _ in pages], w), pages, strict=True))
    assert right >= 135


def test_gradients_are_derivatives():
    pages, labels = [], []
    for markup, _ in list(htmltext.practice_pages(3, seed=5)):
        found = htmltext.blocks(markup)[:6]
        pages.append(htmltext.vectors(found))
        labels.append(np.arange(len(found)) % 2.0)
    w = htmltext.new_weights()
    w["path"] += np.random.default_rng(0).normal(0, 0.1, w["path"].shape)

    def loss():
        z, (_, mask, _, _) = htmltext.forward(w, pages)
        y = np.zeros_like(z)
        for p, v in enumerate(labels):
            y[: len(v), p] = v
        return float(((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum())

    g = htmltext._gradients(w, pages, labels)
    for k in ("xf", "hb", "cf", "out", "path"):
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        keep = w[k][i]
        w[k][i] = keep + 1e-5
        up = loss()
        w[k][i] = keep - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[k][i], rel=1e-3)
        w[k][i] = keep


# ---- decontamination


@pytest.mark.parametrize(("broadcast", "bits"), [(True, 27), (False, 12)])
def test_decontamination(spark, monkeypatch, broadcast, bits):
    if not broadcast:  # joins by shuffle, and a set so small that most candidates are false
        monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
        monkeypatch.setattr(decontam, "BROADCAST_HITS", 0)
        monkeypatch.setattr(decontam, "SET_BITS", 6)
    bench = docs(spark, [(1, " ".join(f"b{i}" for i in range(20))), (2, "Short one"), (3, None), (4, "..."), (5, "five words are an item")], "item_id long, text string")
    hit = " ".join(f"B{i}" for i in range(3, 16))
    rows = [(1, "x y " + hit + " z"), (2, "y " * 400 + hit), (3, "a short, ONE b"), (4, None), (5, ""), (6, hit.replace("B9", "q")), (1, "x y " + hit + " z"), (7, "five words are an item " * 2), (None, hit), (8, "v " * 100_000 + hit)]
    df = docs(spark, rows).withColumn("w", F.lit("clash")).withColumn("_h", F.lit(1))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontam.scan_hits(df, bench).collect()), key=str)
    want = [(1, 16, 13, [1]), (1, 16, 13, [1]), (2, 413, 13, [1]), (3, 4, 2, [2]), (4, 0, 0, []), (5, 0, 0, []), (6, 13, 0, []), (7, 10, 10, [5]), (None, 13, 13, [1]), (8, 100_013, 13, [1])]
    assert got == sorted(want, key=str)
    clean = decontam.decontaminate(df, bench)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [2, 4, 5, 6, 8]
    spans = decontam.decontaminate(df, bench, "spans")
    cut = {r.doc_id: r.text for r in spans.collect()}
    assert spans.columns == df.columns and cut[1] == "x y  z" and cut[3] == "a  b" and cut[6] == rows[5][1]
    assert decontam.scan_hits(df.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontam.scan_hits(df, bench.limit(0)).collect())


# ---- pipeline


def test_pipeline_by_brute_force(spark):
    import corpus_pipeline as p

    d = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{d}/documents.parquet")
    columns = source.columns
    kept = p.quality_stage(spark, source, d)
    scores = {r.doc_id: r.predicted for r in queries.op3_quality_classifier(spark, d).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, v in scores.items() if v} and kept.columns == columns
    once = p.near_copies_stage(spark, kept, d)
    want = brute_components([(r.doc_id, r.text) for r in kept.collect()])
    assert {r.doc_id for r in once.collect()} == {i for i, (_, c) in want.items() if i == c} and once.columns == columns
    clean = p.decontamination_stage(spark, once, d)
    bad = {r.doc_id for r in queries.op10_decontamination(spark, d).filter("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in once.collect()} - bad and clean.columns == columns
    mixed = p.mixing_stage(spark, clean, d)
    assert mixed.columns == columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2
    out = p.run(spark, d)
    assert out.count() == mixed.count() and out.select("row_number").distinct().count() == out.count()


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    import corpus_pipeline as p

    wide = DOC + ", size long, slots string, target double, score double, source_size long, _row int, `a.b` int"
    extra = (1, "x", 0.5, 0.1, 2, 3, 4)
    for name, rows in (("empty", []), ("wordless", [(1, None, "en", "a", 0, *extra), (2, "", "en", None, 0, *extra), (2, "", "en", None, 0, *extra)]), ("some", [(i, f"w{i} " * 30, "en", "a", 9, *extra) for i in range(4)])):
        d = str(tmp_path / name)
        spark.createDataFrame(rows, wide).write.parquet(f"{d}/documents.parquet")
        docs(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        docs(spark, [], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        source = spark.read.parquet(f"{d}/documents.parquet")
        for _, stage in p.STAGES[:-1]:  # each on the whole table, as the first may keep nothing
            out = stage(spark, source, d)
            assert out.columns == source.columns
            assert out.count() <= 2 * len(rows)
        assert p.sharding_stage(spark, source, d).count() == len(rows)
    assert p.run(spark, str(tmp_path / "empty")).count() == 0
    # without labels every score is 0.5, so nothing of a table with rows is kept
    assert p.run(spark, str(tmp_path / "some")).count() == 0


def test_the_pipeline_keeps_only_what_its_last_stage_reads(spark):
    import corpus_pipeline as p

    top = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(top))
    out = p.run(spark, FOLDER)
    (left,) = set(os.listdir(top)) - before
    assert os.listdir(f"{top}/{left}") == [str(len(p.STAGES) - 2)] and out.count() > 0


def test_driver_sees_all_eleven():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert os.path.exists(os.path.join(os.path.dirname(e.__file__), "corpus_pipeline.py"))


@pytest.mark.parametrize(("markup", "texts"), [
    ("<html><head><title>x</title><body><article><p>one</p><p>two</p></article>", ["one", "two"]),
    ("<head><title>x</title><meta a=b><p>one</p><p>two", ["one", "two"]),
    ("<head><title>x</title></head><body><p>one", ["one"]),
    ("<head><noscript><img src=a></noscript><title>x</title></head><p>one", ["one"]),
    ("<article><noscript>a</noscript><p>b <math><mi>x</mi><mo>=</mo></math> c</p><object>d</object><map>e</map></article>", ["a", "b x= c", "de"]),
    ("<p>a</p><script>b <p>c", ["a"]),
    ("<div><template><div>x</div></template>a</div>", ["a"]),
    *[(f"<div><div>a<{t}><b>x</b></div><p>b</p></div>", ["a", "b"]) for t in ("select", "textarea", "audio", "video", "svg", "template", "canvas")],
    ("<p>a<select><option>x<p>b", ["a", "b"]),
    ("<div>a<svg><svg>x</svg>y</svg>b</div>", ["a", "b"]),
])
def test_unclosed_elements_lose_no_text(markup, texts):
    assert [t for _, t, _ in htmltext.blocks(markup)] == texts


@pytest.mark.parametrize(("markup", "texts"), [
    ("<p title=it's>A</p><p>I don't..</p><p>The end</p>", ["A", "I don't..", "The end"]),
    ('<p class="a"">one</p><p>two</p>', ["one", "two"]),
    ("<p title='a>b'>x</p><p title = \"c>d\">y</p>", ["x", "y"]),
    ('<p title="open>x</p><p>y', ["x", "y"]),
])
def test_quotes_count_after_an_equals_sign(markup, texts):
    assert [t for _, t, _ in htmltext.blocks(markup)] == texts


def test_deep_pages_share_their_paths():
    import time

    began = time.process_time()
    found = htmltext.blocks("".join(f'<div class="c{i}">t{i}' for i in range(4000)))
    assert [t for _, t, _ in found] == [f"t{i}" for i in range(4000)] and time.process_time() - began < 3
    assert len(found[-1][0]) <= htmltext.PATH_BUCKETS and found[0][0] < found[9][0]
    assert found[3990][0] is found[3999][0] or len(found[3990][0]) < htmltext.PATH_BUCKETS


def test_all_words_of_a_block_count():
    start = "word " * 60
    same = [htmltext.vectors([(htmltext.path_of(["p"]), f"{start}{end}.", 0)])[1][0] for end in ("reply", "story")]
    assert len(same[0][0]) == 2 and list(same[0][0]) != list(same[1][0])
    assert sorted(same[0][1]) == pytest.approx([1 / 61, 60 / 61])
    w = htmltext.new_weights()
    w["word"] += np.arange(htmltext.WORD_BUCKETS)[:, None]
    x = htmltext._inputs(w, [htmltext.vectors([(htmltext.path_of(["p"]), f"{start}reply.", 0)])], 1)[0][0, 0, htmltext.PATH_SIZE]
    assert x == pytest.approx((60 * (zlib.crc32(b"word") % htmltext.WORD_BUCKETS) + zlib.crc32(b"reply") % htmltext.WORD_BUCKETS) / 61)
