"""Exact de-duplication by a tree merge of sorted digest runs.

Every task turns its rows into a run: one entry for each digest, in order of the digest, with its smallest row and its
number of rows. Runs then change hands in binomial rounds. A task's place is a number of a few digits; in round k it
exchanges with the tasks that differ in digit k only, sending each entry to the one whose digit k is that of the digest,
and merges the runs that arrive, keeping the smallest identifier. After the last round each place holds all entries of
its digests, and no task ever holds more than its share: copies shrink to one entry on every level, so a text that a
third of all rows share costs one entry for each task.

Texts count as equal when SHA-256, length and a second 64-bit hash of the normalised text all agree, on every level.

Defined cases: null counts as empty, so null and empty texts are copies of each other; of equal texts the smallest
doc_id stays, a null doc_id only where all are null, and of rows that repeat the id as well exactly one stays; an empty
table gives no rows; extra columns, whatever their names, are kept by ``drop_exact_copies`` and ignored by ``exact_groups``. A
row is known by its place in its file, which does not depend on how a scan is split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.llm.numbering import with_places, without_rows
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

#: Runs merged at once by a task, and so the base of the places.
FAN = 8
KEY = ["digest", "size", "check"]
ORDER = [*KEY, "no_id", "doc_id", "file", "row"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run of equal keys in sorted rows the first row, with the sum of their counts."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            columns = [pa.concat_arrays([a, b]) for a, b in zip(held.columns, batch.columns)]
            batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), dtype=np.uint64).reshape(-1, 4)
        numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "check")]
        first = np.ones(batch.num_rows, dtype=bool)
        first[1:] = (digest[1:] != digest[:-1]).any(axis=1)
        for values in numbers:
            first[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(first)
        sums = np.add.reduceat(batch.column("n_rows").to_numpy(zero_copy_only=False), starts)
        first_rows = batch.take(pa.array(starts))
        columns = [pa.array(sums, pa.int64()) if name == "n_rows" else first_rows.column(name) for name in batch.schema.names]
        merged = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        held = merged.slice(len(starts) - 1)
        if len(starts) > 1:
            yield merged.slice(0, len(starts) - 1)
    if held is not None:
        yield held


def tree_merge(rows: DataFrame, places: int) -> DataFrame:
    """One entry for each key of the rows (digest, size, check, no_id, doc_id, row, n_rows); ``places`` is a power of FAN."""
    owner = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(places))
    columns = rows.columns
    runs = rows.withColumn("place", F.pmod(F.spark_partition_id(), F.lit(places)).cast("long"))
    runs = runs.sortWithinPartitions(*ORDER)
    runs = runs.mapInArrow(_merge, runs.schema)
    digit = 1
    while digit < places:
        place = F.col("place") - F.floor(F.col("place") / digit) % FAN * digit + F.floor(owner / digit) % FAN * digit
        runs = runs.withColumn("place", place.cast("long")).repartitionById(places, F.col("place").cast("int"))
        runs = runs.sortWithinPartitions(*ORDER)
        runs = runs.mapInArrow(_merge, runs.schema)
        digit *= FAN
    return runs.select(*columns)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """file, row (the place of the row), doc_id, digest, keep_id, group_size, kept of every row."""
    return _groups(*with_places(docs), doc_id, text)


def _groups(docs: DataFrame, file: str, row: str, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    body = normalised(F.col(text))
    rows = stage(
        docs.select(F.col(file).alias("file"), F.col(row).alias("row"), F.col(doc_id).alias("doc_id"), body.alias("body")).select(
            "file",
            "row",
            "doc_id",
            F.col("doc_id").isNull().alias("no_id"),
            F.unhex(F.sha2(F.col("body"), 256)).alias("digest"),
            F.octet_length("body").cast("long").alias("size"),
            F.xxhash64("body").alias("check"),
        ),
        "digests",
    )
    places = FAN
    while places < int(spark.conf.get("spark.sql.shuffle.partitions")):
        places *= FAN
    entries = tree_merge(rows.withColumn("n_rows", F.lit(1).cast("long")), places).where("n_rows > 1")
    key = F.concat(F.hex("digest"), F.hex("size"), F.lit(":"), F.hex("check")).alias("key")
    groups = entries.select(key, F.col("doc_id").alias("first_id"), F.col("file").alias("first_file"), F.col("row").alias("first_row"), "n_rows")
    # Only texts that repeat are looked up; one that very many rows share is no hot key of this join.
    found = lookup_join(rows.select("*", key), stage(groups, "copies"), "key", "left")
    first = (F.col("file") == F.col("first_file")) & (F.col("row") == F.col("first_row"))
    return found.select(
        "file",
        "row",
        "doc_id",
        "digest",
        F.when(F.col("n_rows").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("n_rows", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n_rows").isNull() | first).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Rows, not ids, are dropped; the documents are not shuffled."""
    placed, file, row = with_places(docs)
    dropped = _groups(placed, file, row, doc_id, text).where("NOT kept")
    return without_rows(placed, file, row, dropped)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = r"""
WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM normal
WINDOW same AS (PARTITION BY text_sha256)
"""
