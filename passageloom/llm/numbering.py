"""Numbers, places and names of rows that hold however often and however split a table is read.

Defined cases: an empty table has no numbers; equal rows get numbers and places of their own; ``numbered`` takes no null
group; names of helper columns are drawn from those that the caller's table leaves free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passageloom.operators.lookup import fits_broadcast
from passageloom.operators.staging import stage

#: Rows numbered together at most (on average); smaller where the session has few rows for each shuffle partition.
BUCKET_ROWS = 1_000_000


def free_names(columns: list[str], count: int) -> list[str]:
    """Column names that none of ``columns`` bears, whatever their case."""
    taken = {c.lower() for c in columns}
    return [n for i in range(len(taken) + count) if (n := f"__{i}") not in taken][:count]


def _plain_scan(docs: DataFrame) -> bool:
    """Whether the plan is one Parquet scan with nothing but deterministic projections and filters above it."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") and plan.deterministic():
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and "FileScan parquet" in docs._jdf.queryExecution().executedPlan().toString()


def with_places(docs: DataFrame, name: str = "documents") -> tuple[DataFrame, str, str]:
    """``docs`` with two columns that name each row for good (a hash of its file, its place there), and their names.

    Places in a file do not depend on how a scan is split, so two scans agree when executors come or go in between. A
    table that is no plain Parquet scan is written first.
    """
    if not _plain_scan(docs):
        docs = stage(docs, name)
    file, row = free_names(docs.columns, 2)
    return docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)), file, row


def without_rows(docs: DataFrame, file: str, row: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` (see ``with_places``) whose place is not among ``dropped`` (file, row), without their places.

    The list of dropped rows is staged and broadcast as far as it fits; beyond that the places, which no key can crowd, are
    joined by a shuffle.
    """
    gone = stage(dropped.select(F.col("file").alias(file), F.col("row").alias(row)), "dropped")
    hint = F.broadcast(gone) if fits_broadcast(gone, row) else gone
    return docs.join(hint, [file, row], "left_anti").drop(file, row)


def row_salt() -> Column:
    """A number for each row, to be written with a staged table so that later reads agree on it."""
    return F.xxhash64(F.monotonically_increasing_id())


def group_sizes(df: DataFrame, group: str) -> dict:
    """Rows of each group. The caller promises that the number of groups does not grow with the data."""
    return {row[0]: row[1] for row in df.groupBy(group).count().collect()}


def numbered(df: DataFrame, group: str, salt: str, sizes: dict, name: str) -> DataFrame:
    """Number the rows of each group from 0 in the column ``name``, and drop ``salt``.

    ``df`` is a staged table with a stored ``salt``. A group is dealt by its salt into buckets well below one shuffle
    partition; buckets are counted, their starts are running sums, and rows are numbered inside their bucket only.
    The group must not be null.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, min(BUCKET_ROWS, sum(sizes.values()) // (4 * partitions)))
    kind = df.schema[group].dataType.simpleString()
    buckets = spark.createDataFrame([(g, -(-n // share)) for g, n in sizes.items()], f"{group} {kind}, __buckets long")
    # As many rows as there are groups, which the caller bounds.
    dealt = df.join(F.broadcast(buckets), group).withColumn("__bucket", F.pmod(F.col(salt), F.col("__buckets")))
    counts = dealt.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "__bucket", F.coalesce(before, F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(salt)) - 1
    return (
        dealt.withColumn("__place", place)
        .join(starts, [group, "__bucket"])
        .withColumn(name, F.col("__start") + F.col("__place"))
        .drop("__buckets", "__bucket", "__place", "__start", salt)
    )


def in_order(df: DataFrame, order: list[str | Column], number: str, name: str) -> DataFrame:
    """A staged copy with the place of each row in the given order, from 0, in the column ``number``.

    The rows are sorted by range, so neither a key nor the whole table meets in one task, and written once with their
    places; the sizes of the ranges before are added when the copy is read. What reads the copy agrees on the numbers,
    however its scans are split.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumns({"__range": F.shiftright(place, 33), "__place": place.bitwiseAND(F.lit(2**33 - 1))}), name)
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each task of the sort.
    starts = F.broadcast(sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")))
    return placed.join(starts, "__range").withColumn(number, F.col("__start") + F.col("__place")).drop("__range", "__place", "__start")
