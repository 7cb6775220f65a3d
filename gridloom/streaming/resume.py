"""Resumable runs as file streams: each file is read once, whatever its outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.fields import extract_fields


def extract_stream(spark: SparkSession, root: str, results: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame] = extract_fields, glob: str = "*.txt") -> None:
    """Extract fields of all new text files below a folder, append them to ``results`` by status, and stop.

    The checkpoint remembers which files are done, skipped and failed ones too; a run that was cut short goes
    on where its last whole batch ended.  A batch that is written again replaces itself.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    texts = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("full_text"))

    def keep(batch: DataFrame, number: int) -> None:
        parse(batch).drop("full_text").withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "status").parquet(results)

    texts.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
