import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(texts):
    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_ids_are_the_tokenizers():
    rng = random.Random(1)
    letters = ["a", "B", "à", "Ö", "ÿ", "×", "÷", "µ", ",", "!", "Straße.", "Noël,", "é", "É", "́", "Σ", "ς", "İ", "ß", "漢", "字", "กำ", "1", "٣", "²", "Ⅷ", "'s", "'LL", "'", "_", "-", ".", "…", "😀", "👩‍💻", "​", "ﬁ", "가", "ΑΣ"]
    spaces = [" ", "\n", "\t", "\r\n", " ", " ", "　", "\u0085", " ", "\x0b", "\x1c", "\x1f", "᠎", "﻿", " ́", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choice(letters if rng.random() < 0.75 else spaces) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [None, "", " ", "<|endoftext|> a <|startoftext|>", "don't stop", " " * 100_000, "z" * 50_000]
    encoder = packing.Encoder(PATH)
    assert [x.tolist() for x in encoder.documents(pa.array(texts))] == plain(texts)


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    monkeypatch.setattr(packing, "REMEMBERED", 300)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdeé'.") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 80))) + rng.choice(["", "  ", "\n"]) for _ in range(60)]
    assert [x.tolist() for x in packing.Encoder(PATH).documents(pa.array(texts))] == plain(texts)


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_full(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, rng.randint(1, 300), rng.randint(1, 5000), 4096, 20_000]) for _ in range(rng.choice([1, 3, 400]))]
    pieces, windows = packing.pack(lengths)
    filled, seen = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        filled[sequence].append((offset, length))
        seen[doc].append((start, length))
    for parts in (*filled.values(), *seen.values()):
        at = 0
        for begin, length in sorted(parts):
            assert begin == at and length > 0
            at += length
    assert {s: sum(n for _, n in parts) for s, parts in filled.items()} == dict(enumerate(windows))
    assert {d: sum(n for _, n in parts) for d, parts in seen.items()} == dict(enumerate(lengths))
    assert all(w & (w - 1) == 0 and w <= 4096 for w in windows)
    # short windows only at the end, one of each size
    assert len([w for w in windows if w < 256]) == len({w for w in windows if w < 256})
    # a long window is opened by a rest of its tier
    opened = {s: max(n for _, n in parts) for s, parts in filled.items()}
    assert all(2 * opened[s] > w for s, w in enumerate(windows) if w > 256)


def test_rests_of_short_documents_fill_long_windows():
    pieces, windows = packing.pack([3000, 700, 300, 90, 6])
    assert windows == [4096] and [(d, n, o) for d, _, n, _, o in pieces] == [(0, 3000, 0), (1, 700, 3000), (2, 300, 3700), (3, 90, 4000), (4, 6, 4090)]


def test_steps_are_even():
    rng = random.Random(4)
    lengths = [int(rng.paretovariate(1.1) * 50) % 9000 + 1 for _ in range(3000)]
    pieces, windows = packing.pack(lengths)
    steps = packing.steps_of(pieces, windows)
    tokens = defaultdict(int)
    for s, w in zip(steps, windows):
        tokens[s] += w
    assert len(tokens) == -(-sum(lengths) // packing.STEP) and max(tokens.values()) - min(tokens.values()) <= 256


def check(rows, texts):
    """Every id of every document lies in one piece, every sequence is filled from 0 and full at a power of two."""
    want = defaultdict(list)
    for doc, ids in texts:
        want[doc].append(ids)
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length, r["size"]))
    for parts in at.values():
        end = 0
        for offset, length, _ in sorted(parts):
            assert offset == end
            end += length
        assert end == parts[0][2] <= 4096 and end & (end - 1) == 0
    got = defaultdict(int)
    for r in rows:
        assert any(len(ids) == r.doc_tokens and zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])) == r.ids_crc32 for ids in want[r.doc_id])
        got[r.doc_id] += r.length
    assert got == {d: sum(map(len, many)) for d, many in want.items()}


def test_odd_tables(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x"), (4, "word " * 30_000), (5, " " * 1_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("clash"))
    check(packing.pack_documents(df.repartition(2)).collect(), [(d, ids) for (d, _), ids in zip(rows, plain([t for _, t in rows]))])
    assert packing.pack_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(df, sizes=(4096, 100))


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.QUERIES["op13_packing"](spark, folder).collect()
    check(rows, [(r.doc_id, ids) for r, ids in zip(docs, plain([r.text for r in docs]))])
    assert len({r.sequence_id for r in rows if r["size"] == 4096}) > 0
