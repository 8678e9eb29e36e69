"""Lines of text files with their position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passageloom.operators.lookup import lookup_join
from passageloom.operators.weighting import index_vocabulary


def with_split(lines: DataFrame, *more: Column) -> DataFrame:
    """(value, file, block): each line of a text scan, batch or stream, with its file and the start of its split."""
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), *more
    )


def read_lines(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """(value, file, block, row): every line with the file it is in and its place there.

    Lines end at a line feed only. ``block`` is where the split starts in the file and ``row`` grows within a split,
    so (block, row) orders the lines of a file however it is split. ``header=True`` skips the first line of each file.
    """
    lines = with_split(spark.read.text(path, lineSep="\n"), F.monotonically_increasing_id().alias("row"))
    return skip_first_lines(lines) if header else lines


def skip_first_lines(lines: DataFrame) -> DataFrame:
    """Drop the first line of each file and nothing else.

    The rows of a split follow each other in its task, so a file's first line is where a run of rows with its name and
    the block 0 begins.
    """

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block").to_numpy()
            file = batch.column("file").dictionary_encode()
            code = file.indices.to_numpy()
            begins = np.ones(len(block), dtype=bool)
            begins[1:] = (block[1:] != block[:-1]) | (code[1:] != code[:-1])
            begins[0] = before != (file.dictionary[int(code[0])].as_py(), int(block[0]))
            before = (file.dictionary[int(code[-1])].as_py(), int(block[-1]))
            yield batch.filter(pa.array(~(begins & (block == 0))))

    return lines.mapInArrow(rest, lines.schema)


def with_place(lines: DataFrame) -> DataFrame:
    """Replace ``file``, ``block`` and ``row`` of all lines of a scan by ``place``, from 0 in the order of files and lines.

    Lines are neither sorted nor shuffled: their rows grow within a split, so the sizes of the splits before theirs are
    added. Both scans are in one plan and have the same splits. The sizes are one row for each split.
    """
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_size"), F.min("row").alias("_first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(before), F.lit(0))
    starts = splits.select("file", "block", (start - F.col("_first")).alias("_shift"))
    others = [c for c in lines.columns if c not in ("file", "block", "row")]
    placed = lines.join(F.broadcast(starts), ["file", "block"])
    return placed.select((F.col("row") + F.col("_shift")).alias("place"), *others)


def with_file_number(spark: SparkSession, lines: DataFrame, path: str | list[str]) -> DataFrame:
    """Replace ``file`` by the number of the file among all files of ``path``, in the order of their names.

    The names come from a listing that opens no file. They are numbered by range and attached by the lookup join, so
    neither their number nor a large file matters.
    """
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("word"))
    numbers = index_vocabulary(names.distinct()).select(F.col("word").alias("file"), F.col("word_idx").alias("_number"))
    others = [c for c in lines.columns if c != "file"]
    return lookup_join(lines, numbers, "file", "left").select(F.col("_number").alias("file"), *others)
