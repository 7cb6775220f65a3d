"""Token counts: documents are encoded once, token spans are interval-joined to fields or sections."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Who gets a token that lies in several sections: the one with its first character, its last, or most of its
#: bytes (of equals the first).
RULES = ("first", "last", "most")
#: Runs of white space of so many characters are cut out, as the pattern goes through them with a stack that is as deep.
RUN = 4096
_WHITE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % RUN)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def tokenizer(path: str | None, pattern: str):
    """The encoding in a file of base64 tokens and ranks, and the tokens' lengths in bytes.

    Without a path it is ``byte_bpe_50k.tiktoken`` of the installed public tokenizers, wherever they lie on this machine.
    """
    import tiktoken

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def encoded(encoding, text: str) -> list[int]:
    """The tokens of a text; long runs of white space are encoded apart.

    In ``PATTERN`` a run that something follows is one piece but for its last character, which begins the next; a run at the end is one piece.
    """
    out: list[int] = []
    at = 0
    for run in _WHITE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[at : run.start()])
        out += encoding._encode_single_piece(text[run.start() : end])
        at = end
    return out + encoding.encode_ordinary(text[at:])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many lie in several.  ends: of the tokens, which follow each other from
    0; bounds: of the sections, ascending, from 0 to the end; both in bytes."""
    starts = np.concatenate([[0], ends[:-1]])
    low = np.searchsorted(bounds, starts, side="right") - 1
    high = np.searchsorted(bounds, ends, side="left") - 1
    owner = low if rule == "first" else high
    if rule == "most":
        owner = low.copy()
        for i in np.flatnonzero(high > low):
            inside = np.minimum(bounds[low[i] + 1 : high[i] + 2], ends[i]) - np.maximum(bounds[low[i] : high[i] + 1], starts[i])
            owner[i] = low[i] + int(np.argmax(inside))
    return np.bincount(owner, minlength=len(bounds) - 1), int((high > low).sum())


def token_counts(docs: DataFrame, fields: Sequence[str] = ("text",), rule: str = "first", split_last: bool = True, path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_tokens, n_chars, n_crossing, sections (name, start, end, tokens).

    A document is its fields, joined by line feeds, and is encoded as one text.  Sections are the fields, or,
    with ``split_last``, the lines of the last field instead of it (named by its name and a number from 0).  A
    line feed belongs to the section before it.  ``start`` and ``end`` count characters of the document.  A
    token that crosses a boundary is counted once, where ``rule`` says; so sections' tokens add up to n_tokens.

    Null fields are empty ones and have an empty section; an empty document has no tokens.  Repeated rows are
    counted each.  Texts of any length, and any run of one character in them, are encoded whole.  Other columns are ignored; an empty table gives an empty one.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}, not {rule!r}")
    fields = tuple(fields)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = tokenizer(path, pattern)
        section = pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.int64())])
        for batch in parts:
            columns = [batch.column(i + 1).to_pylist() for i in range(len(fields))]
            rows, chars, tokens, crossing = [], [], [], []
            for values in zip(*columns, strict=True):
                values = [v or "" for v in values]
                names, pieces = list(fields), [v + "\n" for v in values[:-1]] + values[-1:]
                if split_last:
                    lines = pieces.pop().split("\n")
                    names = names[:-1] + [f"{fields[-1]}.{i}" for i in range(len(lines))]
                    pieces += [x + "\n" for x in lines[:-1]] + lines[-1:]
                bounds = np.concatenate([[0], np.cumsum([len(x.encode()) for x in pieces])])
                places = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).tolist()
                ends = np.cumsum(lengths[np.array(encoded(encoding, "".join(pieces)), dtype=np.int64)])
                # an empty section holds no byte, so the search over distinct bounds passes over it
                full = np.flatnonzero(np.diff(bounds))
                by, crossed = attribute(ends, np.append(bounds[:-1][full], bounds[-1]), rule) if len(full) else (np.zeros(0, np.int64), 0)
                each = np.zeros(len(pieces), dtype=np.int64)
                each[full] = by
                rows.append([{"name": n, "start": s, "end": e, "tokens": k} for n, s, e, k in zip(names, places[:-1], places[1:], each.tolist(), strict=True)])
                tokens.append(len(ends))
                chars.append(places[-1])
                crossing.append(crossed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array(chars, pa.int64()), pa.array(crossing, pa.int64()), pa.array(rows, pa.list_(section))],
                ["doc_id", "n_tokens", "n_chars", "n_crossing", "sections"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(fields)])
    return columns.mapInArrow(count, "doc_id long, n_tokens long, n_chars long, n_crossing long, sections array<struct<name: string, start: long, end: long, tokens: long>>")
