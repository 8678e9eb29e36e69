"""Passage files as a stream: each new file is weighted with a fixed word list and IDF table as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from passageloom.functions import text as T
from passageloom.operators.weighting import dense_tfidf
from passageloom.sources.files import skip_first_lines, with_split


def read_passage_stream(
    spark: SparkSession, folder: str, files_per_trigger: int = 1000, header: bool = False
) -> DataFrame:
    """(passage_id, passage) of the ``id,text`` lines of every file that appears in a folder.

    ``header=True`` skips the first line of each file.
    """
    lines = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    if header:
        lines = skip_first_lines(with_split(lines))
    return lines.select(
        T.key_before_comma(F.col("value")).alias("passage_id"), T.text_after_comma(F.col("value")).alias("passage")
    )


def weigh_passage_stream(
    passages: DataFrame, vocabulary_idf: DataFrame, output: str, checkpoint: str, digits: int | None = None, **trigger
) -> StreamingQuery:
    """Dense TF-IDF of a streaming passage table, into Parquet below ``output``, one folder for each micro-batch."""

    def weigh(batch: DataFrame, number: int) -> None:
        vectors = dense_tfidf(batch, vocabulary_idf, unique_ids=False, digits=digits)
        vectors.write.mode("overwrite").parquet(f"{output}/batch={number}")

    stream = passages.writeStream.foreachBatch(weigh).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
