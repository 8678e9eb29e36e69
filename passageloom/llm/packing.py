"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most one sequence. Only the number of pieces of each length matters for packing:
that table has one row for each length up to the capacity, whatever the corpus. On it, one bin after the other is filled:
the longest piece left comes first, and a subset-sum over the other lengths, kept as the bits of one integer, finds the
fullest combination that fits. It is removed as often as its lengths allow, so a few thousand combinations describe any
number of bins. The pieces then take their places by their number within their length.

Defined cases: a null or empty text is one piece that holds the end id only; equal rows are packed one by one; an empty
table gives no rows; extra columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.llm.numbering import group_sizes, numbered, row_salt
from passageloom.llm.word_tokens import word_tokenizer
from passageloom.operators.staging import stage

CAPACITY = 4096
# Fixed value: the id after each document.
END_ID = 1


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best: the subset sums are the bits of one integer."""
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        chunk = 1
        while left > 0:  # 1, 2, 4, ... copies at once reach every number of copies
            taken = min(chunk, left)
            steps.append((length, taken, reach))
            reach |= (reach << (length * taken)) & mask
            left -= taken
            chunk *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            total -= length * taken
            chosen[length] = chosen.get(length, 0) + taken
    return chosen


def minimum_slack_bins(sizes: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, pieces of each length) of all bins, each the fullest for what was left when it was filled."""
    left = {length: count for length, count in sizes.items() if count}
    bins = []
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        chosen = fullest({k: v for k, v in others.items() if v and k <= capacity - longest}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // count for length, count in chosen.items())
        bins.append((times, chosen))
        for length, count in chosen.items():
            left[length] -= times * count
            if not left[length]:
                del left[length]
    return bins


def _places(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Columns: length, first number of a piece, pieces of that length in a bin, first sequence, first offset."""
    rows, used, sequence = [], {}, 0
    for times, chosen in bins:
        offset = 0
        for length in sorted(chosen, reverse=True):
            count = chosen[length]
            rows.append((length, used.get(length, 0), count, sequence, offset))
            used[length] = used.get(length, 0) + times * count
            offset += length * count
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(tokenizer)
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(encode.ids([t or "" for t in batch.column(1).to_pylist()])):
                data = np.concatenate([ids, end]).astype("<u4").tobytes()
                for piece, start in enumerate(range(0, len(ids) + 1, capacity)):
                    part = data[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=schema.names,
            )

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, name: str = "pieces") -> DataFrame:
    """Add sequence_id and offset to rows that have a ``length`` of 1 to ``capacity``.

    The rows are staged once; the table of lengths (at most ``capacity`` rows) is all that reaches the driver.
    """
    staged = stage(pieces.withColumn("__salt", row_salt()), name)
    sizes = group_sizes(staged, "length")
    table = _places(minimum_slack_bins(sizes, capacity))
    ranked = numbered(staged, "length", "__salt", sizes, "__number")
    schema = T.StructType(
        [f for f in ranked.schema.fields if f.name != "__number"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    span = 1 << 44
    keys = table[:, 0] * span + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("__number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * span + number, side="right") - 1
            _, first, count, sequence, offset = table[at].T
            within = number - first
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in schema.names[:-2]]
                + [pa.array(sequence + within // count), pa.array(offset + within % count * length)],
                names=schema.names,
            )

    return ranked.mapInArrow(place, schema).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(token_pieces(docs, tokenizer, capacity, doc_id, text), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
