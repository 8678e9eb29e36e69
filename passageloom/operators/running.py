"""A document frequency table that grows batch by batch, on disk.

The table is bucketed by word, in versions. A batch brings its own counts, dealt into as many buckets; each bucket is
merged with the old one where it lies, so the old table is read but not shuffled. A ledger beside the table names the
batches in it, and a batch that is repeated changes nothing. A version counts from the moment its marker is written, which
is last: a job that dies leaves the version before it, and its own rest is never read.

One writer at a time. Defined cases: an empty batch enters the ledger with no passages; an empty or new folder has no words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.operators.frequency import CorpusFrequency, corpus_frequency

BUCKETS = 64
_MARKER = "_COMMITTED"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _versions(spark: SparkSession, folder: str) -> tuple[int, int]:
    """The last committed version and the last one that was begun; 0 for none."""
    system, path = _file_system(spark, folder)
    if not system.exists(path(folder)):
        return 0, 0
    begun = [f.getPath().getName() for f in system.listStatus(path(folder))]
    begun = sorted(int(n[1:]) for n in begun if n[:1] == "v" and n[1:].isdigit())
    done = [n for n in begun if system.exists(path(f"{folder}/v{n}/{_MARKER}"))]
    return max(done, default=0), max(begun, default=0)


def _bucketed(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """The written buckets as a table that the planner knows to be bucketed."""
    name = f"df_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (word STRING, df BIGINT) USING parquet CLUSTERED BY (word) SORTED BY (word) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def running_frequency(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> CorpusFrequency:
    """(word, df) and the number of passages of all batches so far."""
    version, _ = _versions(spark, folder)
    if not version:
        return CorpusFrequency(spark.createDataFrame([], "word string, df bigint"), 0)
    passages = spark.read.parquet(f"{folder}/v{version}/ledger").agg(F.sum("n_passages")).first()[0]
    return CorpusFrequency(_bucketed(spark, f"{folder}/v{version}/df", buckets), passages)


def batches(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, n_passages) of the ledger."""
    version, _ = _versions(spark, folder)
    if not version:
        return spark.createDataFrame([], "batch string, n_passages bigint")
    return spark.read.schema("batch string, n_passages bigint").parquet(f"{folder}/v{version}/ledger")


def add_batch(spark: SparkSession, folder: str, batch: str, passages: DataFrame, lowercase: bool = True, buckets: int = BUCKETS) -> bool:
    """Add the passages of a batch, unless the ledger has it. The number of buckets is that of the first batch."""
    ledger = batches(spark, folder)
    if ledger.where(F.col("batch") == batch).first() is not None:
        return False
    version, begun = _versions(spark, folder)
    new = corpus_frequency(passages, lowercase=lowercase)
    # Dealt as the buckets are, so that a task merges one bucket; the old side keeps its own layout.
    dealt = new.table.repartition(buckets, "word")
    merged = dealt.select("word", "df")
    if version:
        old = _bucketed(spark, f"{folder}/v{version}/df", buckets).withColumnRenamed("df", "old")
        both = old.hint("merge").join(dealt, "word", "full_outer")
        merged = both.select("word", (F.coalesce("old", F.lit(0)) + F.coalesce("df", F.lit(0))).alias("df"))
    target = f"{folder}/v{begun + 1}"
    merged.write.bucketBy(buckets, "word").sortBy("word").option("path", f"{target}/df").format("parquet").saveAsTable(f"df_{uuid.uuid4().hex}")
    added = spark.createDataFrame([(batch, new.n_passages)], "batch string, n_passages bigint")
    ledger.unionByName(added).write.parquet(f"{target}/ledger")
    system, path = _file_system(spark, folder)
    system.create(path(f"{target}/{_MARKER}"), True).close()
    return True
