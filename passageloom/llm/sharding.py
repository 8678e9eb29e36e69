"""Shards by jump consistent hashing: the shard of a key follows from the key and the number of shards alone.

No table of ring positions is kept; with one more shard, rows move only into the new one, about one in n + 1 of them.

Defined cases: null doc_ids share one key, so one shard; a null text has no bytes; equal rows get slots of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.llm.numbering import group_sizes, numbered, row_salt
from passageloom.operators.staging import stage

SHARDS = 8


def jump_hash(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key: from where it is, the key draws the next number of buckets at which it would move."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    while len(moving):
        at[moving] = jump[moving]
        # The multiplier and the shift of the published method.
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        jump[moving] = ((at[moving] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        moving = moving[jump[moving] < buckets]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a column of any type, by the 64-bit hash of its text."""

    @F.pandas_udf("int")
    def jump(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy().view(np.uint64), shards).astype(np.int32))

    return jump(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))))


def shard_rows(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard (with one shard more) of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        shard_of(F.col(doc_id), shards).alias("shard"),
        shard_of(F.col(doc_id), shards + 1).alias("grown_shard"),
    )
    staged = stage(rows.withColumn("__salt", row_salt()), "shards")
    return numbered(staged, "shard", "__salt", group_sizes(staged, "shard"), "slot")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, doc_id: str = "doc_id") -> None:
    """Write the rows as one folder for each shard; a shard takes as many files as the scan has tasks."""
    docs.withColumn("shard", shard_of(F.col(doc_id), shards)).write.partitionBy("shard").parquet(folder)


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
