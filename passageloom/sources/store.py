"""Passages on disk in the order of their ids, so that looking some up reads a few row groups and not the collection.

``write_store`` deals passages by ranges of their ids into Parquet files with small row groups, sorted inside, with a Bloom
filter of the ids for each row group. Beside the files lies one row for each of them with its first and last id. A lookup
picks the files from those rows, and the Parquet reader picks the row groups and pages from their statistics and filters.

Defined cases: repeated ids are all kept, and an id with very many rows spans several files; a null id is stored and never
found; an empty table is a store in which nothing is found; of the other columns only ``passage`` is stored. A store counts
once its list of files is written, which is last. A folder is written once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.operators.lookup import BROADCAST_BYTES, fits_broadcast
from passageloom.operators.staging import stage

FILE_BYTES = 256 * 1024 * 1024
ROW_GROUP_BYTES = 8 * 1024 * 1024
#: Characters of an id in the list of files. Cutting keeps the order, so a cut range still holds all ids of its file.
EDGE = 64
_SCHEMA = "passage_id string, passage string, part int"
_PARTS = "part int, least string, most string, n_rows bigint"


def write_store(passages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, row_group_bytes: int = ROW_GROUP_BYTES, unique_ids: bool = False) -> None:
    """Store (passage_id, passage). Texts are shuffled once, here, and never again for a lookup.

    With ``unique_ids`` the caller vouches that no id repeats, as after ``read_passages``. Ranges then never need to part the
    rows of an id, so no copy of the texts is staged to number them; a repeated id would be kept, in one file.
    """
    spark = passages.sparkSession
    rows = passages.select("passage_id", "passage")
    rows = rows if unique_ids else stage(rows, "passages")
    size = F.coalesce(F.octet_length("passage"), F.lit(0)) + F.coalesce(F.octet_length("passage_id"), F.lit(0)) + 16
    total, count = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    files = max(1, -(-total // file_bytes))
    # The number of a row in the staged copy lets the bounds of a range fall inside the rows of one id.
    numbered = rows.withColumn("_row", F.lit(0) if unique_ids else F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(files, "passage_id", "_row")
    placed = dealt.sortWithinPartitions("passage_id").select("passage_id", "passage", F.spark_partition_id().alias("part"))
    placed.write.partitionBy("part").options(
        **{
            "parquet.block.size": str(row_group_bytes),
            "parquet.bloom.filter.enabled#passage_id": "true",
            "parquet.bloom.filter.expected.ndv#passage_id": str(max(1, count * row_group_bytes // max(1, total))),
        }
    ).parquet(f"{folder}/passages")
    edges = [f(F.substring("passage_id", 1, EDGE)).alias(n) for f, n in ((F.min, "least"), (F.max, "most"))]
    parts = _stored(spark, folder).groupBy("part").agg(*edges, F.count(F.lit(1)).alias("n_rows"))
    parts.coalesce(1).write.parquet(f"{folder}/parts")  # one row for each file


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{folder}/passages")


def store_parts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, least, most, n_rows): the files of a store with their first and last id, cut to ``EDGE`` characters."""
    return spark.read.schema(_PARTS).parquet(f"{folder}/parts")


def _read_parts(spark: SparkSession, folder: str, parts: list[int]) -> DataFrame:
    """Only the listed files: their folders are named, so the others are not even listed."""
    if not parts:
        return spark.createDataFrame([], "passage_id string, passage string")
    paths = [f"{folder}/passages/part={p}" for p in sorted(parts)]
    return spark.read.schema("passage_id string, passage string").parquet(*paths)


def stored_passage(spark: SparkSession, folder: str, passage_id: str) -> DataFrame:
    """(passage_id, passage) with one id, or no row. The comparison reaches the scan as a filter of row groups."""
    edge = passage_id[:EDGE]
    held = store_parts(spark, folder).where((F.col("least") <= F.lit(edge)) & (F.col("most") >= F.lit(edge)))
    return _read_parts(spark, folder, [r["part"] for r in held.select("part").collect()]).where(F.col("passage_id") == F.lit(passage_id))


def parts_of_keys(spark: SparkSession, folder: str, keys: DataFrame) -> list[int]:
    """The files that may hold one of the keys (passage_id).

    The list of files, two short edges each, goes to the tasks, where each key finds its files by bisection; back come the
    numbers of files. Both are as long as the listing of the folder, not as the data.
    """
    listed = store_parts(spark, folder).where("least IS NOT NULL").select("least", "most", "part").collect()
    # Edges in the order of their bytes, which is how Spark orders strings; files do not overlap but in an id or an edge.
    listed = sorted((r["least"].encode(), r["most"].encode(), r["part"]) for r in listed)
    shared = spark.sparkContext.broadcast(([e[0] for e in listed], [e[1] for e in listed], [e[2] for e in listed]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most, part = shared.value
        found: set[int] = set()
        for batch in batches:
            for edge in batch.column("edge").to_pylist():
                key = edge.encode()
                found.update(part[bisect_left(most, key) : bisect_right(least, key)])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["part"])

    edges = keys.where("passage_id IS NOT NULL").select(F.substring("passage_id", 1, EDGE).alias("edge"))
    return [r["part"] for r in edges.mapInArrow(find, "part int").distinct().collect()]


def stored_passages(spark: SparkSession, folder: str, keys: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """(passage_id, passage) of the ids in ``keys``, from the files that may hold one; a short list of keys is broadcast."""
    wanted = stage(keys.where("passage_id IS NOT NULL").select("passage_id").distinct(), "keys")
    held = _read_parts(spark, folder, parts_of_keys(spark, folder, wanted))
    if fits_broadcast(wanted, "passage_id", budget):
        wanted = F.broadcast(wanted)
    return held.join(wanted, "passage_id", "left_semi")
