"""No legal text, page or id ends a task or makes a product."""

import random
import re
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import decontam, htmltext, jaccard, quality, tokens


def test_long_white_space_is_encoded(spark, monkeypatch):
    rows = [(1, "a" + " " * 1_000_000 + "b"), (2, "\n" * 1_000_000), (3, " \t" * 600_000 + " x")]
    got = {r.doc_id: (r.n_tokens, sum(s.tokens for s in r.sections)) for r in tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), split_last=False).collect()}
    assert all(a == b > 0 for a, b in got.values()) and set(got) == {1, 2, 3}


def test_runs_cut_out_change_no_token(monkeypatch):
    monkeypatch.setattr(tokens, "_WHITE", re.compile(tokens._WHITE.pattern.replace(str(tokens.RUN), "2")))
    encoding, _ = tokens.tokenizer(None, tokens.PATTERN)
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "'s", "1", "!", "é", " ", "  ", "\n", "    ", "\t", "　", "\xa0", "\r\n"]) for _ in range(rng.randint(0, 40)))
        assert tokens.encoded(encoding, text) == encoding.encode_ordinary(text)


def test_a_wide_page_is_read_within_a_bound():
    w = htmltext.train()
    short = "<html><body>" + "".join(f"<p>Word {i} of a page, written out.</p>" for i in range(5)) + "</body></html>"
    wide = "<html><body><table>" + "".join(f"<tr><td>c{i}</td><td>Some words, {i}.</td></tr>" for i in range(50_000)) + "</table></body></html>"
    alone = htmltext.main_texts([short], w)
    tracemalloc.start()
    out = htmltext.main_texts([wide, *[short] * 63], w)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30 and out[1:] == alone * 63
    assert len(htmltext.blocks(wide)) == 100_000


def test_scores_are_the_logits_of_training():
    rng, w = np.random.default_rng(1), htmltext.new_weights()
    w = {k: rng.normal(0, 0.3, v.shape) for k, v in w.items()}
    pages = [htmltext.vectors(htmltext.blocks("<body>" + "".join(f"<p>text {i} of {n}</p>" for i in range(n)) + "</body>")) for n in (1, 7, 30)]
    logits, _ = htmltext.forward(w, pages)
    got = htmltext.scores(w, pages)
    for p, (paths, _, _) in enumerate(pages):
        assert np.allclose(got[: len(paths), p], logits[: len(paths), p], atol=1e-12)


def test_nothing_short_enough_to_fit(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_TEXT", 20)
    docs = spark.createDataFrame([(i, f"text {i} " * 20) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scores = {r.score for r in quality.score_quality(docs, quality.train(docs, labels)).collect()}
    assert len(scores) == 1 and all(0 < s < 1 for s in scores)


def test_null_ids_are_no_product(spark):
    """Near copies without ids cost what near copies with ids do, and join the same."""
    base = [f"w{i}" for i in range(60)]
    rows = [" ".join([*base[: i % 50], f"new{i}", *base[i % 50 :]]) for i in range(1500)]
    took, found = {}, {}
    for name, ids in (("ids", range(1500)), ("null", [None] * 1500)):
        df = spark.createDataFrame(list(zip(ids, rows)), "doc_id long, text string")
        began = time.time()
        out = jaccard.jaccard_components(df, 5, 0.75).groupBy("n_shingles", "n_links").agg(F.count_distinct("component_id").alias("c"), F.count("*").alias("n")).collect()
        took[name], found[name] = time.time() - began, sorted((r.n_shingles, r.n_links, r.n) for r in out)
    assert found["ids"] == found["null"] and took["null"] < 3 * took["ids"] + 5


def test_one_id_with_many_texts(spark):
    rows = [(7, " ".join(f"d{d}w{i}" for i in range(40)) + (" end" if c else "")) for d in range(150) for c in range(2)]
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 0.75).collect()
    assert len(out) == 300 and {(r.component_id, r.n_links) for r in out} == {(7, 1)}


def test_large_windows_are_joined_by_shuffles(spark, monkeypatch):
    """Words have no largest size, so windows are broadcast by their bytes; beyond them the result is the same."""
    words = [f"word{i}" for i in range(40)]
    bench = spark.createDataFrame([("i1", " ".join(words[:20])), ("i2", "漢" * 5000)], "item_id string, text string")
    df = spark.createDataFrame([(i, " ".join(words[i % 30 :]) + (" " + "漢" * 5000 if i % 7 == 0 else "")) for i in range(60)], "doc_id long, text string")
    rows = lambda: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontam.scan_hits(df, bench).collect())
    kept = lambda: sorted(r.doc_id for r in decontam.decontaminate(df, bench).collect())
    before = rows(), kept()
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert (rows(), kept()) == before and any(r[2] for r in before[0]) and 0 < len(before[1]) < 60
