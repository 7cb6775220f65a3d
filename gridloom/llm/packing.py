"""Packing: documents to sequences of several sizes, long windows filled from shorter tiers, steps of even size.

Documents are encoded and packed where they are read, in buckets of some millions of tokens, so nothing is shuffled and no
task holds more than a bucket and a document.  In a bucket:

1. What fills whole windows of a document stands alone.  Its rest is routed to the smallest tier that holds it.
2. Tiers are packed from the longest on.  A rest of the tier opens a window; the gap takes the longest rests of shorter tiers
   that fit, and, when none does, the beginning of a rest that is longer, whose remainder is routed anew.
3. What the bucket has left, less than the smallest tier, is laid out in falling powers of two, so nothing is padded.
4. Windows are dealt to steps, the longest and dearest first, each to the step with the fewest tokens, of such the least attention.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (4096, 2048, 1024, 512, 256)
#: Tokens of a bucket, and of a step.
BUCKET = 1 << 22
STEP = 1 << 16
#: The id that ends a document.
END = 2
#: Texts are encoded in parts of about so many bytes; words remembered have so many at most.
PART = 1 << 23
REMEMBERED = 1 << 23


def byte_letters() -> dict[int, str]:
    """Letters of Latin-1 beyond ASCII as byte-level vocabularies write their UTF-8 bytes: printable ones as themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in shown)}
    return {c: "".join(chr(others.get(b, b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


@cache
def tokenizer(path: str | None):
    """The tokenizer in a file; without a path that of ``word_bpe_49k.json``, wherever it lies on this machine."""
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts, as the tokenizer gives them, from the ids of what white space parts.

    This holds for tokenizers that drop white space and join nothing across it.  Texts that name a special token, or have
    control characters that one side takes for white space and the other doesn't, are encoded whole.
    """

    ODD = r"[\x1c-\x1f]|<\|"
    #: A word with signs behind it: the vocabulary's model takes the word as it is.
    WORD = re.compile("([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:-@\\[-`{-~]*)")
    LETTERS = byte_letters()

    def __init__(self, path: str | None) -> None:
        self.tokenizer = tokenizer(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.cores: dict[str, tuple[int, ...]] = {}
        self.signs: dict[str, tuple[int, ...]] = {"": ()}
        self.size = 0
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        match, tokenize, signs, letters, cores = self.WORD.fullmatch, self.model.tokenize, self.signs, self.LETTERS, self.cores
        ids, counts, others = [], [], []
        for word in words:
            found = match(word)
            if not found:
                others.append(word)
                continue
            core, sign = found.groups()
            core = core.lower()
            own = cores.get(core)
            if own is None:
                own = cores[core] = tuple([t.id for t in tokenize(core if core.isascii() else core.translate(letters))])
            if sign:
                if sign not in signs:
                    signs[sign] = tuple(self.whole(sign))
                own = own + signs[sign]
            ids += own
            counts.append(len(own))
            self.known[word] = len(self.known)
        parts, sizes = [self.ids, np.array(ids, dtype=np.uint32)], [np.array(counts, dtype=np.int64)]
        for at in range(0, len(others), 4096):
            some = others[at : at + 4096]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            parts.append(np.array(found.ids, dtype=np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(some)))
            for word in some:
                self.known[word] = len(self.known)
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.concatenate(sizes))])
        self.ids = np.concatenate(parts)
        self.size += sum(map(len, words))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, whose characters together are few enough to be split at once."""
        if self.size > REMEMBERED:
            self.forget()
        split = pc.utf8_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            self.learn(new)
        codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[np.asarray(coded.indices)]
        begins = self.begins[codes]
        counts = self.begins[codes + 1] - begins
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(begins - ends[:-1], counts) + np.arange(ends[-1])]
        places = np.asarray(split.offsets).astype(np.int64)
        bounds = ends[places - places[0]]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each document, with the one that ends it."""
        end = np.array([END], dtype=np.uint32)
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.ODD).to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        alone = odd | (sizes > PART)
        total, at = np.cumsum(sizes), 0
        while at < len(texts):
            if alone[at]:
                text = texts[at].as_py()
                found = [np.array(self.whole(text), dtype=np.uint32)] if odd[at] else chain.from_iterable(self.encode(pa.array([p])) for p in parted(text))
                yield np.concatenate([*found, end])
                at += 1
                continue
            stop = int(np.searchsorted(total, total[at] - sizes[at] + PART, side="right"))
            later = np.flatnonzero(alone[at:stop])
            stop = at + int(later[0]) if len(later) else max(stop, at + 1)
            for ids in self.encode(texts.slice(at, stop - at)):
                yield np.concatenate([ids, end])
            at = stop


def parted(text: str) -> Iterator[str]:
    """A text in parts that begin at white space."""
    at, space = 0, re.compile(r"\s")
    while at < len(text):
        found = space.search(text, at + PART)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


class Rests:
    """What documents have left, by length; all lengths that occur are the bits of one number."""

    def __init__(self) -> None:
        self.by: dict[int, list[tuple[int, int]]] = {}
        self.lengths = self.tokens = 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            self.by.setdefault(length, []).append((doc, start))
            self.lengths |= 1 << length
            self.tokens += length

    def longest(self, most: int | None = None) -> int:
        """The greatest length, of those up to ``most``; 0 without any."""
        return max(0, (self.lengths if most is None else self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def take(self, length: int) -> tuple[int, int]:
        own = self.by[length]
        if len(own) == 1:
            self.lengths ^= 1 << length
        self.tokens -= length
        return own.pop()


def pack(lengths: Sequence[int], sizes: Sequence[int] = SIZES) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) and the size of each sequence.  All sequences are full."""
    pieces: list[tuple[int, int, int, int, int]] = []
    windows: list[int] = []
    rests, top = Rests(), sizes[0]
    for doc, n in enumerate(lengths):
        whole = n // top
        for k in range(whole):
            pieces.append((doc, k * top, top, len(windows), 0))
            windows.append(top)
        rests.add(doc, whole * top, n - whole * top)
    small = sizes[-1]
    falling = [1 << k for k in reversed(range(small.bit_length() - 1))]
    for size in [*sizes, *falling]:
        # the smallest tier takes all that is shorter, too
        while rests.tokens >= size and (size <= small or 2 * rests.longest() > size):
            gap = size
            while gap:
                length = rests.longest(gap)
                if length:
                    doc, start = rests.take(length)
                else:
                    long = rests.longest()
                    doc, start = rests.take(long)
                    length = gap
                    rests.add(doc, start + gap, long - gap)
                pieces.append((doc, start, length, len(windows), size - gap))
                gap -= length
            windows.append(size)
    return pieces, windows


def steps_of(pieces: Sequence[tuple[int, int, int, int, int]], windows: Sequence[int], step: int = STEP) -> list[int]:
    """The step of each sequence: even in tokens, then in attention (the squares of pieces)."""
    cost = [0] * len(windows)
    for _, _, length, sequence, _ in pieces:
        cost[sequence] += length * length
    heap = [(0, 0, i) for i in range(max(1, -(-sum(windows) // step)))]
    out = [0] * len(windows)
    for sequence in sorted(range(len(windows)), key=lambda s: (-windows[s], -cost[s], s)):
        tokens, spent, i = heapq.heappop(heap)
        out[sequence] = i
        heapq.heappush(heap, (tokens + windows[sequence], spent + cost[sequence], i))
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, size int, step long"


def pack_documents(docs: DataFrame, path: str | None = None, sizes: Sequence[int] = SIZES, bucket: int = BUCKET, step: int = STEP) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, size (of its sequence), step.

    ``docs`` has doc_id and text; other columns are ignored.  A document is its ids and one that ends it, so a null or empty
    text has one token.  ``sizes`` are falling powers of two.  Sequences are full at a power of two: of ``sizes``, or, a few at the
    end of each bucket, smaller.  Rows with one doc_id, and repeated rows, are documents of their own.  Very long texts are encoded in
    parts and fill windows of their own.  An empty table gives an empty one.  Numbers follow from the order of rows
    in the partitions that Spark reads, so a task that runs again gives the same.
    """
    sizes = tuple(sizes)
    if any(s & (s - 1) or s < 1 for s in sizes) or list(sizes) != sorted(set(sizes), reverse=True):
        raise ValueError("sizes are falling powers of two")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = Encoder(path), TaskContext.get().partitionId() << 33
        sequences = groups = 0

        def packed(ids: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal sequences, groups
            pieces, windows = pack([len(t) for t in tokens], sizes)
            dealt = steps_of(pieces, windows, step)
            views = [memoryview(t.astype("<u4", copy=False)).cast("B") for t in tokens]
            doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces, strict=True))
            crc = [zlib.crc32(views[d][4 * s : 4 * (s + n)]) for d, s, n, _, _ in pieces]
            size = np.array(windows, dtype=np.int32)[sequence]
            own = np.array(dealt, dtype=np.int64)[sequence]
            total = np.array([len(t) for t in tokens], dtype=np.int64)[doc]
            out = [pa.array([ids[d] for d in doc.tolist()], pa.int64()), *map(pa.array, (start, length)), pa.array(crc, pa.int64()), *map(pa.array, (total, base + sequences + sequence, offset, size, base + groups + own))]
            sequences += len(windows)
            groups += max(dealt) + 1
            return pa.RecordBatch.from_arrays(out, [c.split()[0] for c in SCHEMA.split(", ")])

        ids: list = []
        tokens: list[np.ndarray] = []
        held = 0
        for batch in parts:
            for one, found in zip(batch.column(0).to_pylist(), encoder.documents(batch.column(1)), strict=True):
                ids.append(one)
                tokens.append(found)
                held += len(found)
                if held >= bucket:
                    yield packed(ids, tokens)
                    ids, tokens, held = [], [], 0
        if ids:
            yield packed(ids, tokens)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
