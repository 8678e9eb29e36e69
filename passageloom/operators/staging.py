"""Intermediate tables in the shared folder, and how input is spread over the tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local master falls back to a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="passageloom-")
    return _local_folders[application]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/passageloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table once and go on from the written copy.

    The copy cuts the lineage, survives lost executors, and gives the planner a true size.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


SMALL_SCAN_BYTES = 4 * 1024 * 1024


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer splits than the session has task slots.

    A file of few row groups otherwise keeps one task busy and the others idle. Larger scans, which have enough splits,
    very small ones, and tables that come out of a shuffle stay as they are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) < SMALL_SCAN_BYTES or _has_shuffle(df) or df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate, which for a scan is the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _has_shuffle(df: DataFrame) -> bool:
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def null_row(df: DataFrame) -> DataFrame:
    """One row with the columns of ``df``, all null."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in df.schema.fields]
    return df.sparkSession.range(1).select(*nulls)
