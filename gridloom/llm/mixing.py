"""Mixing sources to target weights with a low-discrepancy schedule over equal-token blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import bucket_of, buckets_for, running_start, stored

#: A block of a source's stream has between half of this and this many words.
BLOCK_WORDS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float], epochs: float, max_repeat: float) -> DataFrame:
    """Add weight and target to one row a source (source, source_size).

    Weights go by code point order of the source, null last, repeating.  ``epochs`` times the total is shared
    by weight; what a source would get beyond ``max_repeat`` times its size is shared again among the others,
    until none is above.  That fixed point has a closed form: with sources sorted by cap over weight, those
    below the water line take their cap and the rest share what is left, which one running sum finds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    df = totals.withColumn("weight", w).withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    everything = Window.partitionBy(F.lit(0))
    by_level = everything.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    df = df.withColumns(
        {
            "_all": F.least(F.sum("source_size").over(everything) * F.lit(float(epochs)), F.sum("_cap").over(everything)),
            "_filled": F.coalesce(F.sum("_cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "_left": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    df = df.withColumn("_line", (F.col("_all") - F.col("_filled")) / F.col("_left"))
    #: the first source whose cap is above its share sets the line for itself and all after it
    free = F.min(F.when(F.col("_cap") / F.col("weight") >= F.col("_line"), F.struct(F.col("_cap") / F.col("weight"), F.col("_line").alias("line")))).over(everything)
    target = F.least(F.col("_cap"), F.coalesce(free["line"] * F.col("weight"), F.col("_cap")))
    return df.select("source", "source_size", "weight", target.alias("target"))


def cells_of(targets: DataFrame, bits: int) -> DataFrame:
    """Add begin, end and block: the cells of each source on a grid of 2 ** ``bits``, and the words of its blocks.

    Slot t of the schedule plays the source whose stretch of the cumulated targets holds the van der Corput point
    of t, whose bits are those of t in reverse.  The points of all slots are the grid's cells, each once, so a
    source's slots are known by the cells of its stretch.  All blocks have the words of one cell.  A source whose
    stretch holds no cell has the one around its middle, and a block of its target's words.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    whole = F.sum("target").over(Window.partitionBy(F.lit(0)))
    size = F.lit(1 << bits)
    reach = F.coalesce(F.try_divide(F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, 0)), whole), F.lit(0.0))
    df = targets.withColumns({"_whole": whole, "end": F.least(F.ceil(reach * size), size).cast("long")})
    df = df.withColumn("begin", F.coalesce(F.lag("end").over(by_name), F.lit(0)).cast("long"))
    small = (F.col("end") <= F.col("begin")) & (F.col("target") > 0)
    middle = F.least(F.col("begin"), size - 1).cast("long")
    return df.select(
        "source", "source_size", "weight", "target",
        F.when(small, middle).otherwise(F.col("begin")).alias("begin"), F.when(small, middle + 1).otherwise(F.col("end")).alias("end"),
        F.when(small, F.col("target")).otherwise(F.try_divide(F.col("_whole"), size)).alias("block"),
    )


def slot_at(begin: Column, end: Column, rank: Column, bits: int) -> Column:
    """The slot of this rank (from 0) among those whose points lie in the cells from ``begin`` up to ``end``.

    Follows the slot's bits from the highest, which are the cell's from the lowest: at each, the cells of the
    stretch with a 0 there are counted, and a rank beyond them goes to those with a 1.
    """
    upto = lambda x, rest, step: F.floor((x - 1 - rest) / step)

    def descend(acc: Column, i: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(2).cast("long"), i)
        zeros = (upto(end, acc["cell"], step) - upto(begin, acc["cell"], step)).cast("long")
        one = acc["rank"] >= zeros
        return F.struct(
            (acc["cell"] + F.when(one, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))).alias("cell"),
            (acc["rank"] - F.when(one, zeros).otherwise(F.lit(0).cast("long"))).alias("rank"),
            (acc["slot"] * 2 + one.cast("long")).alias("slot"),
        )

    none = F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.struct(none.alias("cell"), rank.cast("long").alias("rank"), none.alias("slot")), descend)["slot"]


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), epochs: float = 1.5, max_repeat: int = 2, seed: int = 1, rows: bool = False) -> DataFrame:
    """One row a row of ``docs``: doc_id, source, size (words), source_size, target, slots; with ``rows``, row as well.

    A source's documents are shuffled (by a hash, the same in every run) into one stream, which starts again after
    its end, up to ``max_repeat`` times, and is cut into blocks of equally many words.  The schedule gives each
    source its slots, and block k of the stream plays in its k-th slot: a copy of a document is taken if the block
    that its middle lies in has a slot.  ``slots`` has the slot of each copy taken, so its length says how often.
    ``row`` is the whole row of ``docs`` as a struct, whatever its columns are called.

    A null text has no words; documents without words are never taken nor needed.  A null source is a source.
    Rows with equal doc_id and text are interchangeable and count one by one.  A source without words has the
    target 0; where no text has a word, all have and nothing is taken.  Texts are counted whole, however long.
    An empty table gives an empty one.  Shares depend on all sources, so one task works on a row for each of them,
    some 100 bytes: sources are meant to be thousands at most, not as many as documents.
    """
    base = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("_shuffle"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []),
    )
    narrow = base if rows else stored(base)[0]
    keyed = lambda df: df.withColumn("_null", F.col("source").isNull()).withColumn("_key", F.coalesce("source", F.lit("")))
    order, key, buckets = ["_shuffle", "doc_id"], ["_key", "_null"], buckets_for(narrow.count())
    parts, _ = stored(keyed(narrow).groupBy("source", *key, bucket_of(order, buckets).alias("bucket")).agg(F.sum("size").alias("_sum")))
    totals = parts.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    words = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * float(epochs)
    bits = max(4, math.ceil(math.log2(max(1.0, words) / BLOCK_WORDS)))
    plan = keyed(cells_of(source_targets(totals, weights, epochs, max_repeat), bits)).drop("source")
    placed = running_start(keyed(narrow), key, order, "size", "_start", buckets, parts.drop("source"), plan)
    middle = F.col("_start") + F.col("size") / F.lit(2.0)
    number = lambda i: F.floor(F.try_divide(i * F.col("source_size") + middle, F.col("block"))).cast("long")
    taken = F.filter(F.transform(F.array(*[F.lit(i) for i in range(max_repeat)]), number), lambda k: (k < F.col("end") - F.col("begin")) & (F.col("size") > 0))
    slots = F.transform(taken, lambda k: slot_at(F.col("begin"), F.col("end"), k, bits))
    return placed.select("doc_id", "source", "size", "source_size", "target", slots.alias("slots"), *(["row"] if rows else []))
