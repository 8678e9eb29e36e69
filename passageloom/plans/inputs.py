"""The given tables as passages, vocabularies, embeddings and requests. Every row of a table is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import spread, stage
from passageloom.operators.terms import vocabulary
from passageloom.sources.embeddings import embeddings_of_table
from passageloom.sources.passages import passages_of_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return passages_of_table(table(spark, folder, "documents"), "doc_id", "text")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return passages_of_table(table(spark, folder, "benchmark"), "item_id", "text")


def benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    """The fixed vocabulary: the words of the second corpus, some of which no document has."""
    return vocabulary(benchmark(spark, folder))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings_of_table(table(spark, folder, "embeddings"), "vec_id", "embedding")


def label_means(spark: SparkSession, folder: str) -> DataFrame:
    """(id, embedding): the mean vector of each label. A few query vectors that no single row equals."""
    rows = spread(table(spark, folder, "embeddings").select("label", "embedding"))
    values = rows.select("label", F.posexplode_outer("embedding").alias("i", "x"))
    means = values.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("xs"))
    return ordered.select(F.col("label").cast("bigint").alias("id"), F.transform("xs", lambda e: e["x"]).alias("embedding"))


def shifted_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(id, embedding): each vector plus the mean of its label. As many query vectors as rows, none equal to a row."""
    means = stage(label_means(spark, folder).select(F.col("id").alias("label"), F.col("embedding").alias("mean")), "means")
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    moved = F.zip_with("embedding", "mean", lambda x, y: x + y)
    return lookup_join(rows, means, "label").select(F.col("vec_id").cast("bigint").alias("id"), moved.alias("embedding"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """(request): one id and one word from each turn of a conversation; known ids, unknown ids and no ids."""
    turns = spread(table(spark, folder, "conversations").select("conv_id", "role"))
    return turns.select(F.explode(F.array(F.col("conv_id").cast("string"), F.col("role"))).alias("request"))


def embedding_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value): good and bad embedding lines from each turn of a conversation."""
    turns = spread(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    return turns.select(
        F.explode(
            F.array(
                F.concat_ws(",", "conv_id", F.concat_ws(":", "turn", F.length("text").cast("string"))),
                F.concat(F.col("conv_id").cast("string"), F.col("role"), F.lit(","), F.col("turn").cast("string")),
                F.concat_ws(",", "role", "turn"),
                F.concat_ws(",", "conv_id", "text"),
            )
        ).alias("value")
    )
