import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import spelling


def apart(a, b):
    """Whether one inserted, deleted or replaced character makes one of the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(words, length=6, count=5, ratio=5):
    n = {w: c for w, c in Counter(w for w in words if w is not None).items() if len(w) >= length and c >= count}
    near = {w: [v for v in n if v != w and apart(w, v)] for w in n}
    form = {w: next((v for v in sorted(near[w], key=lambda v: (-n[v], v))[:1] if n[v] >= ratio * n[w]), None) for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("seed", range(4))
def test_range_reporting(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 200))
    values = rng.permutation(n)
    q = 50
    begin, end = np.sort(rng.integers(0, n + 1, (2, q)), axis=0)
    low, high = np.sort(rng.integers(0, n + 1, (2, q)), axis=0)
    query, value = spelling.Wavelet(values).report(begin, end, low, high)
    want = sorted((i, int(v)) for i in range(q) for v in values[begin[i] : end[i]] if low[i] <= v < high[i])
    assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == want


def word(rng, letters="abé"):
    return "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))


@pytest.mark.parametrize(("tile", "block", "cells"), [(1 << 15, 1 << 16, 1 << 25), (6, 40, 300), (1, 1, 1)])
def test_forms_by_brute_force(spark, monkeypatch, tile, block, cells):
    """Tiles of many words are split down to single positions, blocks of any size give the same."""
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "CELLS", cells)
    rng = random.Random(tile)
    words = [w for _ in range(250) for w in [word(rng)] * rng.choice([5, 5, 6, 30, 160, 800])] + [None] * 10 + ["aaaaaa"] * 7 + ["aaaaaaa"] * 50 + ["aaaaaaaa"] * 300
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n int").repartition(7)
    got = [tuple(r) for r in spelling.spelling_forms(df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(words)


def test_odd_words(spark):
    long = "x" * 20_000
    words = [long] * 5 + [long[:9_000] + "y" + long[9_000:]] * 25 + ["naïveté", "naivete"] * 5 + ["𝒳abcdef"] * 5 + ["abcdef"] * 30 + ["a" * 6] * 4
    df = spark.createDataFrame([(w,) for w in words], "word string").withColumn("key", F.lit("clash"))
    assert {tuple(r) for r in spelling.spelling_forms(df).collect()} == expected(words)
    assert spelling.spelling_forms(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_forms(df, ratio=1)
