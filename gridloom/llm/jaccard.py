"""N-gram Jaccard join: size-banded tiles, hashed bitmaps that bound the overlap, exact intersections.

Two documents link when the Jaccard similarity of their shingle sets reaches a threshold.  The way there:

1. Each set becomes a sorted array.  The order is global: first a level that says how common a shingle's hash
   bucket is (from counts over a fraction of the documents), then the hash.  Any fixed order gives the same links; this one puts
   passages that many documents share last.
2. Equal sets are one class.  A class keeps a prefix of its array (the rarest quarter), which two linked sets
   must share an element of, and a bitmap whose width follows its size band.
3. A tile is a prefix element and a size band.  Classes meet only in tiles of their own or the neighbouring
   band, if sizes and positions in the arrays allow enough overlap.
4. For a pair, set bits of one bitmap that the other lacks bound the overlap from above; what passes is
   decided by intersecting the sorted arrays.
5. Each class is first compared with the first class of each of its tiles, which joins large groups of copies; then all pairs
   of different components that share a tile are compared.  That gives the components, without spreading any group
   out into all its pairs.
6. Where links are asked for, each of these first components is cut into tiles by size band, and tiles into blocks.  Two blocks
   of one band or of bands whose sizes can link meet in one cell, where sizes and bit counts rule out pairs and exact
   overlaps decide the rest.  With the links between different components of step 5 these are all links, each once.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.llm.common import bit_table, bits_at, dropped, maybe_in, stored
from gridloom.llm.shingles import bounded, column_bytes, mix, shingle_hashes, word_hashes

#: The tables of levels, of shared prefix elements and of documents to intersect are broadcast.  Their sizes, as powers of
#: two, follow the number of documents up to these (4, 32 and 8 MB); beyond it they sort out less, which costs work, not links.
LEVEL_BITS = 22
SHARED_BITS = 28
WANTED_BITS = 26
#: The classes that index one tile are dealt into chunks of about so many, and what meets the tile meets each chunk by itself.
CHUNK = 256
#: One document of so many is counted for the levels, and a shingle seen so often among them is common.
LEVEL_SAMPLE = 16
COMMON = 3
#: A block of a component's tile has about so many classes, up to 16 times as many in large tiles, and so many elements at
#: most (16 MB), so a task holds two such blocks.
BLOCK = 512
BLOCK_ELEMENTS = 1 << 21


def _bits(rows: int, each: int, least: int, most: int) -> int:
    """The power of two of a table with 2 ** ``each`` places for each of so many rows, within bounds."""
    return min(most, max(least, max(1, rows).bit_length() + each))


def _node(s: np.ndarray) -> int | None:
    """The hash of a set, null for an empty one."""
    return int((mix(s).sum(dtype=np.uint64) ^ mix(np.uint64([len(s)]))[0]).astype(np.int64)) if len(s) else None


def _sets(texts: pa.Array, k: int, levels: np.ndarray | None) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct ordered shingles of each row) for pieces of a column."""
    for begin, rows in bounded(texts):
        hashes, offsets = shingle_hashes(*word_hashes(*column_bytes(texts.slice(begin, rows))), k)
        ordered = hashes >> np.uint64(8)
        if levels is not None:
            ordered |= levels[(hashes >> np.uint64(65 - len(levels).bit_length())).astype(np.int64)].astype(np.uint64) << np.uint64(56)
        yield begin, [np.unique(ordered[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _bitmap(s: np.ndarray) -> bytes:
    """A bit for each element's hash; the width is the power of two above the size, 64 at least."""
    width = max(64, 1 << int(len(s)).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(mix(s) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A wider bitmap brought to a smaller width: positions are the hash's low bits, so halves are joined by or."""
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0) if len(bits) > width else bits


def overlap_bound(a: bytes, b: bytes, n: int, m: int) -> int:
    """No fewer than the elements that two sets share: each lone bit is at least one element the other lacks."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    width = min(len(x), len(y))
    x, y = _folded(x, width), _folded(y, width)
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``; elements of one side count for nothing."""
    sizes = [len(s) for s in [*left, *right]]
    ids = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    cut = sum(sizes[: len(left)])
    a, b = ids[:cut], ids[cut:]
    rows, cols = np.repeat(np.arange(len(left)), sizes[: len(left)]), np.repeat(np.arange(len(right)), sizes[len(left) :])
    na, nb = np.bincount(a, minlength=ids.max() + 1), np.bincount(b, minlength=ids.max() + 1)
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    # elements of many pairs by products of matrices, the others pair by pair
    many = 100 * na * nb > out.size
    wide = 1024
    place = np.cumsum(many) - 1
    a_many, b_many = many[a], many[b]
    for begin in range(0, int(many.sum()), wide):
        parts = []
        for own, element, height, there in ((rows, a, len(left), a_many), (cols, b, len(right), b_many)):
            at = place[element] - begin
            take = there & (at >= 0) & (at < wide)
            part = np.zeros((height, wide), dtype=np.float32)
            part[own[take], at[take]] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    order = np.argsort(b, kind="stable")
    first = np.cumsum(nb) - nb
    few = np.flatnonzero(~a_many & (nb[a] > 0))
    ends = np.cumsum(nb[a[few]])
    begin, most = 0, 1 << 22
    while begin < len(few):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        some = few[begin:end]
        times = nb[a[some]]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        met = cols[order[np.repeat(first[a[some]], times) + inner]]
        out += np.bincount(np.repeat(rows[some], times) * len(right) + met, minlength=out.size).reshape(out.shape)
        begin = end
    return out


def levels_of(docs: DataFrame, k: int, bits: int) -> np.ndarray:
    """A table by hash bucket: 0, or about the logarithm of the count of the bucket's most common shingle."""
    part = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(LEVEL_SAMPLE)) == 0).select("text")

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = batch.column(0)
            for begin, rows in bounded(texts):
                hashes, offsets = shingle_hashes(*word_hashes(*column_bytes(texts.slice(begin, rows))), k)
                own = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                found, times = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))], ["h", "c"])

    counted = part.mapInArrow(spread, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= COMMON)
    bucket = F.shiftrightunsigned("h", 64 - bits).cast("int")
    # at most 2 ** bits rows, whatever the input
    rows = counted.groupBy(bucket.alias("b")).agg(F.floor(F.log2(F.max("c").cast("double"))).cast("int").alias("v")).toArrow()
    out = np.zeros(1 << bits, dtype=np.uint8)
    out[rows["b"].to_numpy()] = np.minimum(rows["v"].to_numpy(), 120)
    return out


def signatures(docs: DataFrame, k: int, threshold: Fraction, levels) -> DataFrame:
    """One row a row of ``docs``: doc_id, th (hash of the text), n, node (hash of the set; null for an empty one), bits, keys (prefix)."""
    num, den = threshold.numerator, threshold.denominator

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids, texts, own = batch.column(0), batch.column(1), batch.column(2)
            for begin, sets in _sets(texts, k, levels.value):
                n = [len(s) for s in sets]
                nodes = [_node(s) for s in sets]
                keys = [s[: len(s) - -(-num * len(s) // den) + 1].view(np.int64) if len(s) else s.view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, len(sets)), own.slice(begin, len(sets)), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array([_bitmap(s) if len(s) else None for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "th", "n", "node", "bits", "keys"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")).mapInArrow(sign, "doc_id long, th long, n long, node long, bits binary, keys array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that it is connected with.

    Alternates two star steps: each node hands the larger ones among its neighbours, then the smaller ones, to
    the smallest; ends when nothing changes.  Each step works on edges in Spark and is kept in the shared folder.
    """
    spark = edges.sparkSession
    here, path = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = here.union(here.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        seen = Observation()
        after = small.select("e.u", "e.v").filter("u <> v").distinct()
        after, new = stored(after.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        now = seen.get
        dropped(spark, path)
        here, path = after, new
        if now == state:
            break
        state = now
    return here.select(F.col("u").alias("node"), F.col("v").alias("root")).union(here.select("v", "v").distinct())


def _band(n: Column) -> Column:
    """The size band of a set of n elements: sizes from one power of two up to the next."""
    return F.floor(F.log2(n.cast("double") + 0.5)).cast("int")


def _enough(n: Column, m: Column, t: Fraction) -> Column:
    """The least overlap of linked sets of n and m elements: num * (n + m) / (num + den), rounded up."""
    return F.ceil((F.lit(t.numerator) * (n + m)).cast("double") / F.lit(float(t.numerator + t.denominator)) - F.lit(1e-9)).cast("long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, t: Fraction, levels, bits: int) -> tuple[DataFrame, str, DataFrame, str]:
    """The pairs (a, b) that are links, and the sorted arrays (node, s) of what was compared, with their paths.

    Bitmaps decide first, the sorted arrays what is left.
    """
    num, den = t.numerator, t.denominator
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))

    @F.pandas_udf("boolean")
    def may(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([(num + den) * overlap_bound(x, y, i, j) >= num * (i + j) for x, y, i, j in zip(a, b, n, m, strict=True)], dtype=bool)

    left, path = stored(pairs.join(side("a"), "a").join(side("b"), "b").filter(may("bitsa", "bitsb", "na", "nb")).select("a", "b"))
    wanted = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().join(classes.select("node", "first_id", "first_th", F.xxhash64("first_id", "first_th").alias("first")), "node")

    def arrays(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for begin, sets in _sets(batch.column(1), k, levels.value):
                nodes = [_node(s) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(sets)), pa.array(nodes, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "own", "s"])

    # texts that nothing asks for are dropped before the shuffle; one row has a class's id and text, or equal ones do
    known = bit_table(wanted, "first", bits)
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_th"), "text").withColumn("_first", F.xxhash64("_id", "_th"))
    same = (F.col("_first") == F.col("first")) & F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("_th") == F.col("first_th"))
    texts = own.filter(maybe_in("_first", known, bits)).join(wanted, same).select("node", "text")
    sets, sets_path = stored(texts.mapInArrow(arrays, "node long, own long, s binary").filter("node = own").groupBy("node").agg(F.first("s").alias("s")))

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(y, x)
            common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            out.append(den * common >= num * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)

    both = left.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    out, out_path = stored(both.filter(linked("sa", "sb")).select("a", "b"))
    dropped(docs.sparkSession, path)
    return out, out_path, sets, sets_path


def bit_rows(sets: list[np.ndarray], width: int) -> np.ndarray:
    """The bitmaps of sets, all of one width, as rows of 64-bit words."""
    flat = np.zeros((len(sets), width), dtype=np.uint8)
    sizes = [len(s) for s in sets]
    flat[np.repeat(np.arange(len(sets)), sizes), (mix(np.concatenate(sets)) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(flat, axis=1, bitorder="little").view(np.uint64)


def bounds(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``overlap_bound`` for each row of ``left`` (of n elements each) with each row of ``right`` (of m)."""
    common = np.zeros((len(left), len(right)), dtype=np.int64)
    if left.shape[1] < len(left):
        for x, y in zip(left.T, right.T, strict=True):
            common += np.bitwise_count(x[:, None] & y)
    else:
        for out, row in zip(common, left, strict=True):
            out[:] = np.bitwise_count(row & right).sum(axis=1, dtype=np.int64)
    spare, others = (size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64) for size, bits in ((n, left), (m, right)))
    return common + np.minimum(spare[:, None], others[None, :])


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray], t: Fraction, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) in two lists of sets of all pairs that link; of one list with itself (``same``) each pair once.

    Both lists are taken by size, a part of each at a time.  Sizes rule out whole parts, bit counts rule out pairs, and
    what is left is decided by exact overlaps: pair by pair where few are left, of all sets that have a pair left otherwise.
    """
    num, den = t.numerator, t.denominator
    width = max(64, 1 << max(map(len, [*left, *right])).bit_length())
    sides = []
    for sets in (left, right):
        n = np.array([len(s) for s in sets])
        order = np.argsort(n, kind="stable")
        sides.append((order, n[order], bit_rows([sets[i] for i in order], width)))
    (by_left, n, x), (by_right, m, y) = sides
    for i in range(0, len(n), BLOCK):
        for j in range(i if same else 0, len(m), BLOCK):
            ni, mj = n[i : i + BLOCK], m[j : j + BLOCK]
            if den * ni[-1] < num * mj[0] or den * mj[-1] < num * ni[0]:
                continue
            may = (num + den) * bounds(x[i : i + BLOCK], y[j : j + BLOCK], ni, mj) >= num * (ni[:, None] + mj[None, :])
            if same and i == j:
                may = np.triu(may, 1)
            rows, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
            if not len(rows):
                continue
            if 64 * may.sum() < len(rows) * len(cols):
                at, to = np.nonzero(may)
                common = np.array([len(np.intersect1d(left[by_left[i + p]], right[by_right[j + q]], assume_unique=True)) for p, q in zip(at, to, strict=True)])
                found = den * common >= num * (ni[at] + mj[to] - common)
                at, to = at[found], to[found]
            else:
                common = overlaps([left[by_left[i + p]] for p in rows], [right[by_right[j + q]] for q in cols])
                found = may[np.ix_(rows, cols)] & (den * common >= num * (ni[rows][:, None] + mj[cols][None, :] - common))
                at, to = np.nonzero(found)
                at, to = rows[at], cols[to]
            yield by_left[i + at], by_right[j + to]


def _inside(near: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame, t: Fraction, pairs: bool) -> DataFrame:
    """All links between classes of one component of ``near``: as pairs (a, b), or counted by class (node, n_links).

    A tile is a component and a size band, dealt into blocks by hash.  Every two blocks of one band or of bands whose sizes
    can link, and every block with itself, are a cell, so each pair is tried in exactly one cell and no task sees more
    than two blocks at a time.  Blocks grow with the tile up to a bound, so that a set has few copies.  A component of two is its only link.
    """
    reach = 0
    while t * 2**reach < 1:
        reach += 1
    member = roots.join(classes.select("node", "n"), "node").withColumn("band", _band(F.col("n")))
    rows = F.count(F.lit(1))
    block = F.least(F.lit(16 * BLOCK), F.greatest(F.lit(BLOCK), rows / 16))
    blocks = F.greatest(F.ceil(rows / block), F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS))).cast("int")
    tile = member.groupBy("root", "band").agg(rows.alias("m"), blocks.alias("blocks"))
    # sizes are below 2 ** 63, so a component has at most 63 bands
    plan = tile.groupBy("root").agg(F.sum("m").alias("m"), F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("plan"))
    name = lambda band, place: F.shiftleft(band.cast("long"), 32) + place
    dealt = member.join(plan, "root").withColumn("own", name(F.col("band"), F.pmod(F.xxhash64("node", F.lit(23)), F.try_element_at("plan", F.col("band")))))

    def others(band: Column) -> Column:
        n = F.try_element_at("plan", band)
        return F.when(n.isNull(), F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda place: name(band, place)))

    bands = F.sequence(F.col("band") - reach, F.col("band") + reach)
    cells = dealt.filter("m > 2").select("root", "node", "own", F.explode(F.flatten(F.transform(bands, others))).alias("other"))
    cells = cells.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "own").join(sets, "node")
    names = ["a", "b"] if pairs else ["node", "n_links"]

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: tuple, rows: list) -> Iterator[pa.RecordBatch]:
            sides = [[(node, np.frombuffer(s, np.uint64)) for node, own, s in rows if own == at] for at in key[1:]]
            left, right = ([s for _, s in side] for side in sides)
            a, b = (np.array([node for node, _ in side], dtype=np.int64) for side in sides)
            if not left or not right:
                return
            counts = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for i, j in linked_pairs(left, right, t, key[1] == key[2]):
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(b[j])], names)
                else:
                    counts[0][:] += np.bincount(i, minlength=len(a))
                    counts[1][:] += np.bincount(j, minlength=len(b))
            if not pairs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])), pa.array(np.concatenate(counts))], names)

        now, rows = None, []
        for batch in parts:
            for root, lo, hi, node, own, s in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (root, lo, hi) != now:
                    if rows:
                        yield from links(now, rows)
                    now, rows = (root, lo, hi), []
                rows.append((node, own, s))
        if rows:
            yield from links(now, rows)

    ordered = cells.select("root", "lo", "hi", "node", "own", "s").repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
    found = ordered.mapInArrow(meet, ", ".join(f"{c} long" for c in names))
    two = near.join(dealt.filter("m = 2").select(F.col("node").alias("a")), "a", "left_semi").select("a", "b").distinct()
    if pairs:
        return found.union(two)
    return found.union(two.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long")))


def jaccard_components(docs: DataFrame, k: int = 5, threshold: float = 0.75) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, component_id, n_links.

    component_id is the smallest doc_id that links lead to, its own included.  n_links counts all links of the
    document's class with other classes; ``jaccard_links`` gives the links themselves.

    A null text is an empty one; texts without words link with nothing and are their own component.  A null
    doc_id counts for nothing in the minimum; a component of nulls only has a null component_id.  Rows with one
    doc_id and several texts are judged by their texts.  Repeated rows are rows of one class.  Texts of any length
    are taken whole.  Other columns are ignored; an empty table gives an empty one.  Classes are told apart by
    64-bit hashes of their sets.
    """
    sig, member, links = _joined(docs, k, threshold, "counts")
    out = member.select("node", "component_id").join(links, "node", "left")
    return _labelled(sig.select("doc_id", "n", "node"), out).select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_links(docs: DataFrame, k: int = 5, threshold: float = 0.75) -> DataFrame:
    """One row a link between two classes of equal sets, each once: a, b (hashes of the sets), doc_a, doc_b (the smallest doc_id of each)."""
    _, member, links = _joined(docs, k, threshold, "pairs")
    side = lambda x: member.select(F.col("node").alias(x), F.col("first_id").alias(f"doc_{x}"))
    return links.join(side("a"), "a").join(side("b"), "b").select("a", "b", "doc_a", "doc_b")


def _labelled(sig: DataFrame, out: DataFrame) -> DataFrame:
    """Each row of ``sig`` with what ``out`` says of its class; a text without words is its own component."""
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return sig.join(out, "node", "left").withColumns({"n_shingles": F.col("n"), "component_id": component})


def _joined(docs: DataFrame, k: int, threshold: float, want: str | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Signatures; (node, first_id, root, component_id) of classes; all links as ``want`` says: counts, pairs or none."""
    spark = docs.sparkSession
    t = Fraction(threshold).limit_denominator(1000)
    docs = docs.select("doc_id", "text")
    size = docs.count()
    shared_bits, wanted_bits = _bits(size, 6, 18, SHARED_BITS), _bits(size, 5, 16, WANTED_BITS)
    levels = spark.sparkContext.broadcast(levels_of(docs, k, _bits(size, 1, 16, LEVEL_BITS)))
    sig, _ = stored(signatures(docs, k, t, levels))

    full = sig.filter("node is not null")
    classes, classes_path = stored(full.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))["th"].alias("first_th"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    # prefix elements that more than one row has
    shared = bit_table(full.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1"), "key", shared_bits)
    slots = full.select("node", "n", "keys", F.transform("keys", lambda x: F.pmod(F.xxhash64(x), F.lit(1 << shared_bits)).cast("int")).alias("slots"))
    num, den = t.numerator, t.denominator

    def tiles(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task gives each class once
        for batch in parts:
            nodes = batch.column("node").to_pylist()
            fresh = [x not in seen and not seen.add(x) for x in nodes]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            counts = np.diff(np.asarray(batch.column("keys").offsets))
            keep = bits_at(shared.value, np.asarray(batch.column("slots").flatten()).astype(np.int64))
            rows = np.repeat(np.arange(len(counts)), counts)
            share = (1000 * np.bincount(rows, keep, len(counts)) // np.maximum(counts, 1)).astype(np.int64)
            row = rows[keep]
            place = (np.arange(len(keep)) - np.repeat(np.cumsum(counts) - counts, counts))[keep]
            n = np.asarray(batch.column("n"))[row]
            least = -(-2 * num * n // (num + den))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(batch.column("node"))[row]), pa.array(n), pa.array(np.asarray(batch.column("keys").flatten())[keep]), pa.array(place), pa.array(place < n - least + 1), pa.array(share[row])],
                ["node", "n", "key", "place", "indexed", "share"],
            )

    once = slots.mapInArrow(tiles, "node long, n long, key long, place long, indexed boolean, share long").repartition("key").dropDuplicates(["key", "node"])
    # the first to be compared with is a class whose whole prefix is shared: in a group of copies, one that was changed little
    first = once.groupBy("key").agg(F.max(F.struct("share", "node"))["node"].alias("a"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key", "a")
    rows, rows_path = stored(once.join(first, "key").drop("share"))
    stars = rows.filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    sizes = classes.select(F.col("node").alias("a"), F.col("n").alias("na"))
    stars = stars.join(sizes, "a").join(sizes.toDF("b", "nb"), "b").filter((F.least("na", "nb") * den >= F.greatest("na", "nb") * num)).select("a", "b")
    near, near_path, sets, sets_path = _verified(stars, classes, docs, k, t, levels, wanted_bits)
    roots = components(near)
    inside, inside_path = stored(_inside(near, roots, classes, sets, t, want == "pairs")) if want else (None, None)
    dropped(spark, sets_path)

    # what is in different components and shares a tile is compared; a component is its root
    placed = rows.drop("a").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).repartition("key")
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum(F.col("indexed").cast("long")).alias("m")).filter("lo <> hi")
    placed, placed_path = stored(placed.join(mixed.select("key", F.ceil(F.col("m") / F.lit(CHUNK)).cast("int").alias("chunks")), "key").filter("chunks > 0"))
    index = placed.filter("indexed").select("key", F.pmod(F.xxhash64("node", F.lit(29)), F.col("chunks")).cast("int").alias("chunk"), _band(F.col("n")).alias("band"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("root").alias("ra"))
    lower = F.ceil(F.col("n") * num / F.lit(den))
    probe = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("key", "chunk", F.explode(F.sequence(_band(lower), _band(F.col("n")))).alias("band"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("root").alias("rb"))
    least = _enough(F.col("na"), F.col("nb"), t)
    fits = (F.col("ra") != F.col("rb")) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & (F.col("na") * den >= F.col("nb") * num)
    fits &= (F.col("na") - F.col("pa") >= least) & (F.col("nb") - F.col("pb") >= least)
    rest = index.join(probe, ["key", "chunk", "band"]).filter(fits).select("a", "b").distinct()
    # a node's place in the array bounds what can follow; equal sizes meet once, from the smaller node
    more, more_path, _, sets_path = _verified(rest, classes, docs, k, t, levels, wanted_bits)

    edges, edges_path = stored(near.union(more).distinct())
    roots = components(edges)
    member = classes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member, _ = stored(member.join(lowest, "root").select("node", "first_id", "root", "component_id"))
    links = None
    if want == "pairs":  # ``more`` joins different components, so no link is in both
        links = stored(inside.union(more.select("a", "b")))[0]
    elif want:
        ends = more.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n_links"))
        links = stored(inside.union(ends).groupBy("node").agg(F.sum("n_links").alias("n_links")))[0]
    dropped(spark, near_path, more_path, rows_path, placed_path, sets_path, edges_path, classes_path, *([inside_path] if want else []))
    return sig, member, links


def keep_one(docs: DataFrame, k: int = 5, threshold: float = 0.75) -> DataFrame:
    """``docs`` with one document of each component: of the smallest doc_id, its columns as they were.

    Rows are told apart by doc_id and text: of several texts of the smallest doc_id in one component one stays, a
    text that links with nothing always stays.  Texts without words all stay, as do rows with a null doc_id; of
    repeated rows with the chosen doc_id and text one stays.  An empty table gives an empty one.
    """
    sig, member, _ = _joined(docs, k, threshold, None)
    found = sig.filter("node is not null and doc_id is not null").groupBy("node", "doc_id", "th").agg(F.count(F.lit(1)).alias("rows")).join(member.select("node", "root"), "node")
    found, _ = stored(found.select("root", "doc_id", "th", "rows"))
    best = found.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("best"))
    judged = found.join(best, "root").select("doc_id", "th", "rows", (F.struct("doc_id", "th") == F.col("best")).alias("won"))
    # most rows leave or stay by themselves; the few repeated ones among those that stay are brought together
    repeated = judged.filter("won and rows > 1").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    gone = judged.filter("not won").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).union(repeated)
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_th"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    again = own.join(repeated, ["_id", "_th"]).groupBy("_id", "_th").agg(F.first("_row").alias("_row"))
    return own.join(gone, ["_id", "_th"], "left_anti").unionByName(again).select("_row.*")
