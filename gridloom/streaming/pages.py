"""Word tables as a stream: each file of a growing folder is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.pages import PageSource
from gridloom.sources.store import Scratch
from gridloom.sources.tsv import parsed_words, with_uid


def word_stream(spark: SparkSession, root: str, out: str, checkpoint: str) -> None:
    """Append the tokens, pages and review of all new page files below ``root`` to tables below ``out``, and stop.

    The checkpoint and the log beside it remember what is done; a batch that is written again replaces itself.
    """
    spark.dataSource.register(PageSource)
    files = spark.readStream.format("gridloom_pages").option("log", f"{checkpoint}/files").load(root)

    def keep(batch: DataFrame, number: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            words = parsed_words(with_uid(batch).filter(F.col("name").rlike(r"\Apage\d+_result\.tsv\z")), scratch.keep)
            for name, table in (("tokens", words.tokens), ("pages", words.pages), ("review", words.review)):
                table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    files.writeStream.foreachBatch(keep).option("checkpointLocation", f"{checkpoint}/spark").trigger(once=True).start().awaitTermination()
