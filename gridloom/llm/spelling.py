"""Spelling variants: pairs of words one edit apart, by two-dimensional range reporting, and the form each one goes to.

A pair of words of length l, or of l and l + 1, that differ at position i share the first i characters and all behind it.  In a
sorted list the words that share a prefix are an interval; in a list sorted from the ends so are those that share a suffix.  A word is
a point (place in the one list, place in the other), and the answer to (word, i) are the points in a rectangle.

Words meet in tiles: a range [lo, hi) of edit positions of words of one length l leaves the first lo and the last l - hi
characters alone, so these are the tile's key.  Every length begins with two ranges, one of each half; the range of a tile with too many
words is halved until it has few enough or a single position, which leaves one letter free.  Blocks of whole tiles have one wavelet tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.llm.common import dropped, stored

#: A tile with more words is split, and a block holds about so many.
TILE = 1 << 15
BLOCK = 1 << 16
#: Characters of a block's table at most, but for a single tile.
CELLS = 1 << 25
KEY = ["base", "lo", "hi", "key"]


class Wavelet:
    """A permutation, bit by bit from the highest: each level has its bits' running counts and parts what it holds by them."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in reversed(range(self.bits)):
            bit = (values >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def report(self, begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, value) with the value's place in [begin, end) and the value in [low, high)."""
        query, value = np.arange(len(begin)), np.zeros(len(begin), np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            a, e = ones[begin], ones[end]
            query, value = np.concatenate([query, query]), np.concatenate([2 * value, 2 * value + 1])
            begin, end = np.concatenate([begin - a, zeros + a]), np.concatenate([end - e, zeros + e])
            some = (begin < end) & (value << b < high[query]) & ((value + 1) << b > low[query])
            query, value, begin, end = query[some], value[some], begin[some], end[some]
        return query, value


class Shared:
    """How much neighbours in a sorted list share, and the interval around a place that shares at least so much."""

    def __init__(self, letters: np.ndarray, tile: np.ndarray) -> None:
        differ = letters[1:] != letters[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), letters.shape[1])
        # before the first of a tile nothing is shared, not even an empty beginning
        self.least = [np.concatenate([[-1], np.where(tile[1:] == tile[:-1], same, -1), [-1]]).astype(np.int64)]
        while 2 << (len(self.least) - 1) <= len(self.least[0]):
            wide, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(wide[:-half], wide[half:]))
        self.most = np.maximum(self.least[0][:-1], self.least[0][1:])

    def around(self, place: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = place.copy(), place + 1
        for k in reversed(range(len(self.least))):
            row, step = self.least[k], 1 << k
            at = end
            fits = (at < len(row)) & (row[np.minimum(at, len(row) - 1)] >= share)
            end = end + step * fits
            at = begin - step + 1
            fits = (at >= 0) & (row[np.maximum(at, 0)] >= share)
            begin = begin - step * fits
        return begin, end


def one_edit(words: list[str], tile: np.ndarray, base: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of all pairs in one tile that differ by an edit at a position of the tile's range; each in both directions.

    ``words`` are distinct and sorted inside their tiles, which follow each other; their length is base or base + 1.
    """
    size = np.array([len(w) for w in words])
    width = max(1, int(size.max()))
    table = lambda own: np.array(own, dtype=f"U{width}").view(np.uint32).reshape(len(own), width)
    back = [w[::-1] for w in words]
    order = np.lexsort((np.array(back, dtype=f"U{width}"), tile))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    letters = table(words)
    ahead, behind = Shared(letters, tile), Shared(table(back)[order], tile[order])
    before, after = ahead.most, behind.most[rank]
    short = size == base
    out_a, out_b = [], []
    tree = None
    for grown in (0, 1):  # the other word has as many characters, or one more
        first = np.maximum(lo, size - 1 + grown - after)
        last = np.minimum(np.minimum(hi - 1, size - 1 + grown), before)
        count = np.where(short, np.maximum(0, last - first + 1), 0)
        a = np.repeat(np.arange(len(words)), count)
        if not len(a):
            continue
        i = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + first[a]
        begin, end = ahead.around(a, i)
        low, high = behind.around(rank[a], size[a] - 1 + grown - i)
        tree = tree or Wavelet(rank)
        query, value = tree.report(begin, end, low, high)
        b, a, i = order[value], a[query], i[query]
        # of the places where a letter may be put in for one result, the first
        fits = (size[b] == base[b] + grown) & (a != b)
        if grown:
            fits &= (i == 0) | (letters[a, np.maximum(i - 1, 0)] != letters[b, np.minimum(i, width - 1)])
        out_a += [a[fits], *([b[fits]] if grown else [])]
        out_b += [b[fits], *([a[fits]] if grown else [])]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _key(lo: Column, hi: Column, base: Column) -> Column:
    """What an edit in [lo, hi) leaves of a word of ``base`` characters, or of one more: its beginning and its end."""
    tail = F.greatest(base - hi, F.lit(0))
    return F.concat_ws("\0", F.substring("word", F.lit(1), lo), F.substring("word", F.char_length("word") - tail + 1, tail))


def tiles(vocabulary: DataFrame) -> DataFrame:
    """base, lo, hi, key, word and n: each word in all tiles where it may meet another."""
    base = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    rows = vocabulary.select("word", "n", base.alias("base")).filter("base > 0")
    half = F.floor((F.col("base") + 1) / 2).cast("int")
    bounds = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (F.col("base") + 1).alias("hi")))
    rows = rows.select("word", "n", "base", F.explode(bounds).alias("_b")).select("word", "n", "base", "_b.lo", "_b.hi")
    rows = rows.withColumn("key", _key(F.col("lo"), F.col("hi"), F.col("base")))
    out = None
    while True:
        big, path = stored(rows.groupBy(*KEY).count().filter((F.col("count") > TILE) & (F.col("hi") - F.col("lo") > 1)).drop("count"))
        if big.isEmpty():
            return rows if out is None else out.unionByName(rows)
        fine = rows.join(big, KEY, "left_anti")
        out = fine if out is None else out.unionByName(fine)
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
        split = rows.join(big, KEY, "left_semi").select("word", "n", "base", F.explode(halves).alias("_b")).select("word", "n", "base", "_b.lo", "_b.hi")
        rows = split.withColumn("key", _key(F.col("lo"), F.col("hi"), F.col("base")))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, near and near_n: all pairs of distinct words (word, n) one inserted, deleted or replaced character apart, in both directions."""

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[tuple]) -> pa.RecordBatch:
            base, lo, hi, key, words, n = (list(c) for c in zip(*rows, strict=True))
            fresh = [True, *[rows[i][:4] != rows[i - 1][:4] for i in range(1, len(rows))]]
            a, b = one_edit(words, np.cumsum(fresh), np.array(base), np.array(lo), np.array(hi))
            return pa.RecordBatch.from_arrays([pa.array([words[i] for i in a]), pa.array([words[i] for i in b]), pa.array(np.array(n, dtype=np.int64)[b])], schema=schema)

        schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
        held: list[tuple] = []
        tile: list[tuple] = []
        width = 0
        for batch in parts:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if tile and row[:4] != tile[0][:4]:
                    if len(tile) > 1:  # a word alone in its tile meets none
                        longest = max(width, tile[0][0] + 1)
                        if held and (len(held) + len(tile)) * longest > CELLS:
                            yield found(held)
                            held = []
                        held += tile
                        width = longest if len(held) > len(tile) else tile[0][0] + 1
                        if len(held) >= BLOCK:
                            yield found(held)
                            held = []
                    tile = []
                tile.append(row)
        if len(tile) > 1:
            held += tile
        if held:
            yield found(held)

    placed = tiles(vocabulary).select(*KEY, "word", "n")
    return placed.repartition(*KEY).sortWithinPartitions(*KEY, "word").mapInArrow(meet, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root of all rows (word, form): forms are followed to the last, twice as far each time; they form no circle."""
    spark = forms.sparkSession
    here, path = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        seen = Observation()
        there = here.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        after = here.join(there, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved"))
        after, new = stored(after.observe(seen, F.sum(F.col("_moved").cast("long")).alias("moved")))
        dropped(spark, path)
        here, path = after.select("word", "root"), new
        if not seen.get["moved"]:
            return here


def spelling_forms(words: DataFrame, length: int = 6, count: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of each distinct word of ``length`` characters and ``count`` rows at least.

    ``words`` has a row for each occurrence; null words count for nothing, other columns are ignored.  n are a word's rows, n_near the other
    words one edit apart.  form is the one of them with the largest n, of equals the smallest in code-point order, if its n is ``ratio``
    times the word's at least (2 or more, so that forms end); otherwise it is null, as is form_n.  root is the last form from word on.  Words of
    any length take part whole.  Repeated words are one; an empty table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 or more")
    long = words.select("word").filter(F.char_length("word") >= max(1, length))
    vocabulary, _ = stored(long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count))
    # at most an alphabet for each place, so a group of near words is small
    near = near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("_b"))
    fits = -F.col("_b.m") >= F.col("n") * ratio
    judged = vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("_b.near")).alias("form"), F.when(fits, -F.col("_b.m")).alias("form_n"))
    judged, _ = stored(judged)
    ends = roots(judged.filter("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
