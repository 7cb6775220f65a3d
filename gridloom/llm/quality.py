"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators for a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.shingles import bounded, column_bytes, mix, word_hashes, word_shapes

#: Hashed n-grams fall into this many features.
FEATURE_BITS = 19
#: The hinge-loss model is fitted on so many rows of each class at most, whose texts have so many bytes in all at most and so
#: many each; counts take all labelled rows, whole.
FIT_ROWS = 1000
FIT_BYTES = 32_000_000
FIT_TEXT = 1_000_000
#: Weight of a miss against the model's size, and what is added to counts; with the kinds of n-grams, these were chosen by
#: cross-validation inside the training rows.
COST, SMOOTH = 5.0, 0.5
#: Up to so many labels (some 50 MB) the join with texts broadcasts them; beyond it, both sides are shuffled.
BROADCAST_LABELS = 1_000_000
#: Kinds of n-grams: of word shapes (kinds of bytes, size, whether a word is the one before it again) and of the words
#: themselves, with the longest of each.
SHAPES, WORDS = ("shapes", 4), ("words", 2)
KINDS = (SHAPES, WORDS)


def features(texts: pa.Array, kinds: tuple[tuple[str, int], ...] = KINDS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct feature numbers of each row) for pieces of a column.

    Features are hashed n-grams.  Shapes say how a text is written whatever its language and subject; words, in A-Z
    lower case, what it says.
    """
    shift = np.uint64(64 - FEATURE_BITS)
    for begin, rows in bounded(texts):
        data, offsets = column_bytes(texts.slice(begin, rows))
        words, at = word_hashes(data, offsets)
        again = np.zeros(len(words), dtype=bool)
        again[1:] = words[1:] == words[:-1]
        again[at[:-1][at[:-1] < len(words)]] = False
        grams = []
        for kind, longest in kinds:
            signs = word_shapes(data, offsets) | (again.astype(np.uint64) << np.uint64(12)) if kind == "shapes" else words
            gram = np.full(len(words), 0 if kind == "shapes" else 1, dtype=np.uint64)
            for n in range(1, longest + 1):
                gram = mix(gram[: max(0, len(words) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + signs[n - 1 :] + np.uint64(1))
                grams.append((n - 1, (gram >> shift).astype(np.int32)))
        found = []
        for u, v in zip(at[:-1], at[1:], strict=True):
            found.append(np.unique(np.concatenate([g[u : max(u, v - n)] for n, g in grams])))
        yield begin, found


@dataclass(frozen=True)
class NbSvm:
    ratios: np.ndarray  # log-count ratio of each feature
    weights: np.ndarray  # ratio times the hinge model's weight
    bias: float
    floor: float  # added to squared lengths, so that texts of few n-grams stay near the middle
    slope: float
    shift: float

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        margins = np.array([self.weights[x].sum() / np.sqrt(np.square(self.ratios[x]).sum() + self.floor) if len(x) else 0.0 for x in rows])
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins + self.bias) + self.shift, -500, 500)))


def fit_hinge(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, prior: float = 0.5, cost: float = COST, epochs: int = 20, seed: int = 5) -> NbSvm:
    """Dual coordinate descent: each row's multiplier moves to its best value between 0 and its class's cost."""
    y = np.where(labels == 1, 1.0, -1.0)
    floor = float(np.median([np.square(ratios[x]).sum() for x in rows])) + 1e-9
    # a row's values are made from the ratios at each visit: kept, they would take as much memory as the rows again
    lengths = [np.sqrt(np.square(ratios[x]).sum() + floor) for x in rows]
    values = lambda i: ratios[rows[i]] / lengths[i]
    caps = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(y))
    norms = np.array([np.square(values(i)).sum() + 1.0 for i in range(len(y))])  # the bias is a feature of value 1
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            x, v = rows[i], values(i)
            gradient = y[i] * (w[x] @ v + bias) - 1
            after = min(max(alpha[i] - gradient / norms[i], 0.0), caps[i])
            if after != alpha[i]:
                w[x] += (after - alpha[i]) * y[i] * v
                bias += (after - alpha[i]) * y[i]
                alpha[i] = after
    margins = np.array([w[x] @ values(i) for i, x in enumerate(rows)]) + bias
    # a logistic curve through the margins, classes weighed as they occur, with smoothed targets
    share, slope, shift = np.where(y > 0, prior / max(1, (y > 0).sum()), (1 - prior) / max(1, (y < 0).sum())), 1.0, 0.0
    goal = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    for _ in range(500):
        miss = share * (goal - 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500))))
        slope, shift = slope + 4 * (miss @ margins), shift + 4 * miss.sum()
    return NbSvm(ratios, w * ratios, bias, floor, float(slope), float(shift))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> NbSvm:
    """Learn from the texts of labelled rows that aren't held out.

    Counts of n-grams by class take all these rows.  The hinge-loss model takes the ``fit_rows`` of each class
    whose hashed doc_id is smallest, as far as their texts fit ``FIT_BYTES`` and ``FIT_TEXT``.  Rows with a null id
    or a label other than 0 and 1 are passed over; an id with several labels has the smallest.  Of repeated rows,
    or several texts, of one id all count, and one text, of the smallest hash, is fitted.  With labels of one class
    only, or none, or empty tables, or if all texts of a class are too long to be fitted, every text has the score of that class's share.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).cast("int").alias("_y"))
    small = known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    rows = docs.select("doc_id", "text").join(F.broadcast(known) if small else known, "doc_id")

    def counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = False, np.zeros((2, (1 << FEATURE_BITS) + 1), dtype=np.int64)
        for batch in parts:
            y = np.asarray(batch.column(1))
            for begin, sets in features(batch.column(0)):
                for i, x in enumerate(sets):
                    found = True
                    sums[y[begin + i], x] += 1
                    sums[y[begin + i], -1] += 1
        if found:
            at = np.flatnonzero(sums.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["f", "c0", "c1"])

    # at most 2 ** FEATURE_BITS + 1 rows, whatever the input
    table = rows.select("text", "_y").mapInArrow(counts, "f long, c0 long, c1 long").groupBy("f").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toArrow()
    sums = np.zeros((2, (1 << FEATURE_BITS) + 1))
    sums[0, table["f"].to_numpy()], sums[1, table["f"].to_numpy()] = table["c0"].to_numpy(), table["c1"].to_numpy()
    n0, n1 = sums[:, -1]
    share = (n1 + 1) / (n0 + n1 + 2)
    flat = NbSvm(np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS), 0.0, 1.0, 1.0, float(np.log(share / (1 - share))))
    if not n0 or not n1:
        return flat
    # smoothing follows the classes' sizes, so an n-gram that was never seen speaks for neither
    smooth = SMOOTH / min(n0, n1)
    ratios = np.log(sums[1, :-1] / n1 + smooth) - np.log(sums[0, :-1] / n0 + smooth)

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for begin, found in features(batch.column(0)):
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(begin, len(found)), batch.column(1).slice(begin, len(found)), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "y", "x"])

    chosen = None
    for c in (0, 1):
        ids = known.filter(F.col("_y") == c).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(fit_rows)
        chosen = ids if chosen is None else chosen.union(ids)
    # ``fit_rows`` of each class at most
    some = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") <= FIT_TEXT).join(F.broadcast(chosen), "doc_id")
    some = some.groupBy("doc_id").agg(F.first("_y").alias("_y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    so_far = F.sum(F.octet_length("text").cast("long")).over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    some = some.withColumn("_bytes", so_far).filter(F.col("_bytes") <= FIT_BYTES)
    fit = some.select("text", "_y", "doc_id").mapInArrow(sets, "doc_id long, y int, x binary").toArrow().sort_by("doc_id")
    # views of the Arrow buffers, no copies
    found = [np.frombuffer(x.as_buffer(), np.int32) for x in fit["x"]]
    y = fit["y"].to_numpy()
    return fit_hinge(found, y, ratios, float(n1 / (n0 + n1))) if len(set(y.tolist())) == 2 else flat


def quality_score(docs: DataFrame, model: NbSvm) -> Callable[[str], Column]:
    """A column function: the score (0 to 1) of a text column.  A null text is an empty one, whose score is that of no n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ratios, model.weights, model.bias, model.floor, model.slope, model.shift))

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = NbSvm(*shared.value)
        for texts in parts:
            yield pa.array(np.concatenate([model.scores(found) for _, found in features(texts)] or [np.zeros(0)]))

    return score


def score_quality(docs: DataFrame, model: NbSvm) -> DataFrame:
    """Add ``score`` to every row of ``docs``; a column of that name is replaced.

    Only the text counts, whole, however long; repeated rows are scored each; an empty table gives an empty one.
    """
    return docs.withColumn("score", quality_score(docs, model)("text"))
