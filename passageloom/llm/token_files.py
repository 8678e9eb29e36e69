"""Token counts of flat token files without an index: a scan for the end-of-document id.

A file is a run of little-endian ids with one end id after each document. Spark has no writer for raw bytes, so a
stream is stored as rows of blocks (file_id, block, ids); blocks are cut by number of ids, wherever documents end. Raw
files are read with ``blocks_of_files``, by ranges of bytes. The end id of the streams is no id of the vocabulary, so a text
that spells an end marker does not end there. Each block is searched on its own, as an array. Then a prefix scan over the
blocks of a file (within segments, and over the segments) tells each block where it starts, how many documents ended
before it, and where the document that is open at its start began.

Defined cases: an empty or null text is a document of no ids; ids after the last end id are a document with ``closed``
false; a file that ends with an end id has none; an empty table gives no rows; block rows may repeat no (file_id, block);
with an end id that texts can hold, such a text is several documents, and its name goes to the one that ends with it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passageloom.llm.word_tokens import word_tokenizer
from passageloom.operators.staging import new_folder

BLOCK_IDS = 1 << 16
SEGMENT_BLOCKS = 1024
#: Larger than every id of the vocabulary (49,408 ids in two bytes).
END_OF_DOCUMENT = 0xFFFF
#: Blocks that a task reads of a raw file.
RANGE_BLOCKS = 256


def write_token_stream(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_OF_DOCUMENT, block_ids: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> None:
    """One stream for each task of the input. ``named`` has the places of a block where a document of a name ends; the scan needs none."""
    if end_id >= 1 << 16:
        raise ValueError("ids are stored in two bytes")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        file_id, block = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u2")
        parts: list[np.ndarray] = []
        ended: list[tuple[int, object]] = []  # where a document ends, counted from the start of the next block
        held = 0

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, ended, held, block
            if held < block_ids and not (last and held):
                return
            ids = np.concatenate(parts)
            whole = len(ids) if last else len(ids) // block_ids * block_ids
            first = 0
            for start in range(0, whole, block_ids):
                last = bisect_left(ended, start + block_ids, key=itemgetter(0))
                names = [{"at": at - start, "doc_id": d} for at, d in ended[first:last]]
                first = last
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file_id], pa.int64()),
                        pa.array([block], pa.int64()),
                        pa.array([ids[start : start + block_ids].tobytes()], pa.binary()),
                        pa.array([names], pa.list_(pa.struct([("at", pa.int64()), ("doc_id", pa.int64())]))),
                    ],
                    names=["file_id", "block", "ids", "named"],
                )
                block += 1
            parts, held = [ids[whole:]], len(ids) - whole
            ended = [(at - whole, d) for at, d in ended[first:]]

        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first in range(0, len(texts), 64):
                for name, ids in zip(names[first : first + 64], encoder.ids(texts[first : first + 64])):
                    parts += [ids.astype("<u2"), end]
                    held += len(ids) + 1
                    ended.append((held - 1, name))
                yield from blocks(last=False)
        yield from blocks(last=True)

    stream = docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        encode, "file_id long, block long, ids binary, named array<struct<at:long,doc_id:long>>"
    )
    stream.write.option("compression", "zstd").parquet(folder)


def blocks_of_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of raw files of little-endian ids of ``width`` bytes. A task reads ranges of bytes, whatever a file weighs.

    Files lie where the tasks can open them by the address that Spark lists.
    """
    step = block_ids * width

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, place = fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as file:
                    for block in range(first, min(first + RANGE_BLOCKS, -(-length // step))):
                        ids = file.read_at(min(step, length - block * step), block * step)
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block], pa.int64()), pa.array([ids], pa.binary())], names=["file_id", "block", "ids"])

    # Names and lengths only: the content column is not read.
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step), F.lit(RANGE_BLOCKS).cast("long")))
    ranges = files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), first.alias("first"), "length")
    return ranges.repartition("path", "first").mapInArrow(read, "file_id string, block long, ids binary")


def separators(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """For each block its number of ids, the places of the end ids, and the names of the documents that end there, if any."""
    kept = [c for c in blocks.columns if c not in ("ids", "named")]
    named = "named" in blocks.columns
    fields = [blocks.schema[c] for c in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_ids long", "ends array<long>", "doc_ids array<long>"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, names = [], [], []
            for i, value in enumerate(batch.column("ids")):
                ids = np.frombuffer(value.as_buffer() if value.is_valid else b"", dtype=f"<u{width}")
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id).tolist())
                known = {n["at"]: n["doc_id"] for n in batch.column("named")[i].as_py() or []} if named else {}
                names.append([known.get(at) for at in ends[-1]])
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.int64()))], names=[*kept, "n_ids", "ends", "doc_ids"])

    return blocks.mapInArrow(search, schema)


def document_tokens(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, width: int = 2, segment_blocks: int = SEGMENT_BLOCKS) -> DataFrame:
    """file_id, doc_no, start, n_tokens, closed of every document (and doc_id where the blocks name documents)."""
    found = separators(blocks, end_id, width).withColumn("segment", F.floor(F.col("block") / segment_blocks))
    named = "named" in blocks.columns
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))

    def running(window, amount, sums):
        return F.coalesce(F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(sums)

    inside = Window.partitionBy("file_id", "segment").orderBy("block")
    over = Window.partitionBy("file_id").orderBy("segment")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # Within a segment: starts count from the segment. A few numbers for each segment are then scanned over the file.
    local = found.select("*", running(inside, "n_ids", "start_in"), running(inside, F.size("ends"), "docs_in")).withColumn(
        "last_in", F.max(F.col("start_in") + last).over(earlier)
    )
    segments = local.groupBy("file_id", "segment").agg(
        F.sum("n_ids").alias("ids"), F.sum(F.size("ends")).alias("docs"), F.max(F.col("start_in") + last).alias("last")
    )
    segments = segments.select("*", running(over, "ids", "ids_before"), running(over, "docs", "docs_before"))
    segments = segments.select(
        "file_id", "segment", "ids_before", "docs_before",
        F.max(F.col("ids_before") + F.col("last")).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("last_before"),
        (F.col("segment") == F.max("segment").over(Window.partitionBy("file_id"))).alias("ends_file"),
    )
    placed = local.join(segments, ["file_id", "segment"]).select(
        "*",
        (F.col("ids_before") + F.col("start_in")).alias("at"),
        (F.coalesce(F.col("ids_before") + F.col("last_in"), "last_before", F.lit(-1)) + 1).alias("open"),
        (F.col("docs_before") + F.col("docs_in")).alias("doc_no"),
        (F.col("ends_file") & (F.col("block") == F.max("block").over(Window.partitionBy("file_id", "segment")))).alias("final"),
    )
    ends = F.transform("ends", lambda e: F.col("at") + e)
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: F.col("at") + e + 1))
    after = F.col("at") + F.col("n_ids")
    rest = F.col("final") & (after > F.element_at(starts, -1))
    ends = F.when(rest, F.concat(ends, F.array(after))).otherwise(ends)
    rows = placed.select("file_id", "doc_no", F.size("ends").alias("whole"), starts.alias("starts"), *([F.col("doc_ids")] if named else []), F.posexplode(ends).alias("i", "end"))
    start = F.get("starts", F.col("i"))
    return rows.select(
        *([F.get("doc_ids", F.col("i")).alias("doc_id")] if named else []),
        "file_id",
        (F.col("doc_no") + F.col("i")).alias("doc_no"),
        start.alias("start"),
        (F.col("end") - start).alias("n_tokens"),
        (F.col("i") < F.col("whole")).alias("closed"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat streams, and from the streams alone the number of tokens of each document."""
    import public_tokenizers

    folder = new_folder(spark, "token-stream")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_stream(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return document_tokens(spark.read.parquet(folder))
