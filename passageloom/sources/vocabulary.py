"""Word lists and IDF tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.functions import text as T
from passageloom.operators.staging import stage
from passageloom.operators.weighting import index_vocabulary
from passageloom.sources.files import read_lines


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(word): one word for each line, each word once."""
    return read_lines(spark, path).select(F.col("value").alias("word")).distinct()


def read_word_list(spark: SparkSession, path: str, whitespace: bool = False) -> DataFrame:
    """Staged (word_idx, word) in file order, repeated words kept: the column order of a dense vector.

    One word for each line, or with ``whitespace=True`` words separated by any white space.
    """
    lines = read_lines(spark, path)
    if whitespace:
        words = lines.select(
            "file", "block", "row", F.posexplode_outer(T.words(F.col("value"), lowercase=False)).alias("place", "word")
        ).where(F.col("word").isNotNull())
    else:
        words = lines.select("file", "block", "row", F.lit(0).alias("place"), F.col("value").alias("word"))
    return index_vocabulary(words, "file", "block", "row", "place")


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    """Staged (word, idf) from a CSV file with a header; the last row of a word wins, files in the order of their names."""
    rows = spark.read.csv(path, schema="word string, idf double", header=True, escape='"', lineSep="\n", mode="FAILFAST")
    placed = rows.select(
        "word",
        "idf",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    unique = placed.groupBy("word").agg(F.max_by("idf", F.struct("file", "block", "row")).alias("idf"))
    return stage(unique.select("word", "idf"), "idf")
