"""Word boxes for plain text: each line is a row of words in a fixed pitch, so texts can be read as grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import is_noise

CHARACTER, HEIGHT, PITCH = 40, 32, 54
KEYS = ["doc_id"]


def text_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, row and seq (from 0), token_id, text, box, conf and noise of every word of every line.

    Words are what single spaces part; the place of a word follows from the characters before it.  Everything
    after this is keyed by doc_id, so texts are dealt by it once, before they are words.
    """
    lines = docs.repartition("doc_id").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("row", "line"))
    words = lines.select("doc_id", "row", F.posexplode(F.split("line", " ")).alias("seq", "text"))
    before = Window.partitionBy("doc_id", "row").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("text")
    placed = words.withColumn("x", (F.coalesce(F.sum(size + 1).over(before), F.lit(0)) * CHARACTER).cast("long")).filter(F.trim("text") != "")
    return placed.select(
        "doc_id", "row", "seq", F.concat(F.lit("T"), F.col("row").cast("string"), F.lit("."), F.col("seq").cast("string")).alias("token_id"), "text", "x",
        (F.col("row") * PITCH).cast("long").alias("y"), (F.col("x") + size * CHARACTER).cast("long").alias("r"), (F.col("row") * PITCH + HEIGHT).cast("long").alias("b"),
        (F.col("row") * PITCH + HEIGHT / 2).cast("double").alias("cy"), (30 + (5 * size + 7 * F.col("seq")) % 70).cast("double").alias("conf"), is_noise(F.col("text")).alias("noise"),
    )
