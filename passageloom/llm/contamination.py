"""Benchmark decontamination: windows of 13 words of the benchmark, looked up in every window of the documents.

Up to BROADCAST_BYTES the distinct windows are a hash set that every task has. A larger benchmark is joined: a filter of its
window hashes, of one size whatever it holds, goes to the tasks; the documents are read once and give the windows that
pass it, which are looked up by their words. A hash hit counts only if the words are the same, either way.

A document word inside any occurrence of a window is hit. Words are lower-cased (A-Z) runs of digits, letters and
characters outside ASCII.

Defined cases: a null or empty text has no words and is never contaminated; an item of fewer than 13 words is one window
of its own length, an item without words none; items of a null id are named by the empty string; items that repeat count
once by id; an empty table on either side leaves all documents clean; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.llm.byte_words import ALNUM, LOWER, hashes, window_hashes, word_bounds, word_chunks
from passageloom.llm.hash_filter import hash_filter, passes
from passageloom.llm.numbering import with_places
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

WINDOW_WORDS = 13
# Fixed value: a document is contaminated when at least one word in 20 is hit.
HIT_SHARE = 20
#: Bytes of windows (words, names and hashes) that are broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024


def benchmark_windows(benchmark: DataFrame, words: int = WINDOW_WORDS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, n_words of the window, its words; one row for each window of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes, windows = [], [], []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lowered = (body or "").encode("utf-8", "surrogatepass").translate(LOWER)
                starts, ends = word_bounds(np.frombuffer(lowered, dtype=np.uint8), ALNUM)
                found = [lowered[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                size = min(words, len(found))
                for i in range(len(found) - size + 1 if found else 0):
                    items.append(item or "")
                    sizes.append(size)
                    windows.append(b" ".join(found[i : i + size]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(sizes, pa.int32()), pa.array(windows, pa.binary())], names=["item", "n", "window"])

    return benchmark.select(F.col(item_id).cast("string"), F.col(text)).mapInArrow(cut, "item string, n int, window binary").distinct()


def _window_set(rows: list[tuple[str, int, bytes]]) -> tuple[dict[bytes, list[str]], dict[int, np.ndarray]]:
    """Items by window, and the sorted hashes of the windows of each size."""
    known: dict[bytes, list[str]] = {}
    for item, _, window in rows:
        known.setdefault(window, []).append(item)
    return known, {size: np.sort(_window_hashes([w for w in known if w.count(b" ") + 1 == size], size)) for size in {n for _, n, _ in rows}}


def _window_hashes(windows: list[bytes], size: int) -> np.ndarray:
    """Hashes of windows of one size, in their order."""
    data = np.frombuffer(b" ".join(windows), dtype=np.uint8)
    starts, ends = word_bounds(data, ALNUM)
    return window_hashes(hashes(data, starts, ends), size)[::size]


def _windows_of(texts: list, sizes: list[int], wanted) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """For each text the number of its words and (place, size, words) of its windows whose hashes are ``wanted(size, hashes)``."""
    for part, joined, starts, ends, of_text in word_chunks(texts, ALNUM):
        count = part.stop - part.start
        words = np.bincount(of_text, minlength=count)
        first = np.cumsum(words) - words
        found: dict[int, list[tuple[int, int, bytes]]] = {}
        values = hashes(np.frombuffer(joined, dtype=np.uint8), starts, ends) if len(starts) else np.zeros(0, dtype=np.uint64)
        for size in sizes:
            window = window_hashes(values, size)
            if not len(window):
                continue
            maybe = np.flatnonzero(wanted(size, window) & (of_text[: len(window)] == of_text[size - 1 :]))
            for i in maybe.tolist():
                phrase = b" ".join(joined[a:b] for a, b in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist()))
                t = int(of_text[i])
                found.setdefault(t, []).append((i - int(first[t]), size, phrase))
        for t in range(count):
            yield int(words[t]), found.get(t, [])


def _added(columns: list[str]) -> list[str]:
    """Names for the number of words, the hit words and the items, which no column bears."""
    taken, out = {c.lower() for c in columns}, []
    for name in ("__n_words", "__hit", "__items"):
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS, text: str = "text", budget: int = BROADCAST_BYTES) -> DataFrame:
    """The documents with three more columns: number of words, numbers of the hit words, names of the items found."""
    windows = stage(benchmark_windows(benchmark, words), "windows")
    weight = windows.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64)).first()[0] or 0
    return (_scan_with_set if 2 * weight <= budget else _scan_with_join)(docs, windows, text)


def _scan_with_set(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    rows = windows.toArrow().to_pylist()  # bounded by the budget
    sent = docs.sparkSession.sparkContext.broadcast([(r["item"], r["n"], bytes(r["window"])) for r in rows])
    kinds = [T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(_added(docs.columns), kinds)]])
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_size = _window_set(sent.value)

        def wanted(size: int, window: np.ndarray) -> np.ndarray:
            place = np.minimum(np.searchsorted(by_size[size], window), len(by_size[size]) - 1)
            return by_size[size][place] == window

        for batch in batches:
            n_words, hits, items = [], [], []
            for n, found in _windows_of(batch.column(at).to_pylist(), sorted(by_size), wanted):
                real = [(i, size, known[phrase]) for i, size, phrase in found if phrase in known]
                n_words.append(n)
                hits.append(sorted({w for i, size, _ in real for w in range(i, i + size)}))
                items.append(sorted({name for _, _, names in real for name in names}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _scan_with_join(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    spark = docs.sparkSession

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[bytes]] = {}
            for size, window in zip(batch.column("n").to_pylist(), batch.column("window").to_pylist()):
                by_size.setdefault(size, []).append(window)
            for size, some in by_size.items():
                yield pa.RecordBatch.from_arrays([pa.array(_window_hashes(some, size).view(np.int64))], names=["hash"])

    sent = spark.sparkContext.broadcast(hash_filter(windows.mapInArrow(hash_windows, "hash long"), "hash"))
    sizes = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most one for each length up to a window's
    placed, file, row = with_places(docs)
    fields = [("n_words", pa.int64()), ("windows", pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int32()), ("phrase", pa.binary())])))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_windows_of(batch.column("text").to_pylist(), sizes, lambda size, window: passes(sent.value, window)))
            columns = [[n for n, _ in found], [[{"at": i, "size": s, "phrase": p} for i, s, p in w] for _, w in found]]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row"), *[pa.array(c, k) for c, (_, k) in zip(columns, fields)]], names=["file", "row", "n_words", "windows"])

    source = placed.select(F.col(file).alias("file"), F.col(row).alias("row"), F.col(text).alias("text"))
    found = stage(source.mapInArrow(scan, "file long, row long, n_words long, windows array<struct<at:long,size:int,phrase:binary>>"), "scanned")
    names = stage(windows.groupBy(F.col("window").alias("phrase")).agg(F.collect_set("item").alias("items")), "window-items")
    hits = lookup_join(found.select("file", "row", F.inline("windows")), names, "phrase")
    hits = hits.select("file", "row", F.sequence("at", F.col("at") + F.col("size") - 1).alias("words"), "items")
    hits = hits.groupBy("file", "row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    counted = found.select("file", "row", "n_words").join(hits, ["file", "row"], "left")
    n_words, hit, items = _added(docs.columns)
    counted = stage(counted.select(F.col("file").alias(file), F.col("row").alias(row), F.col("n_words").alias(n_words), F.coalesce("hit", F.array().cast("array<long>")).alias(hit), F.coalesce("items", F.array().cast("array<string>")).alias(items)), "hits")
    return placed.join(counted, [file, row]).select(*docs.columns, n_words, hit, items)


def contaminated(n_words: str = "__n_words", hit: str = "__hit"):
    n_hit = F.size(hit).cast("long")
    return (n_hit > 0) & (HIT_SHARE * n_hit >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = scan_benchmark(docs, benchmark, text=text)
    return found.where(~contaminated(*found.columns[-3:-1])).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All documents; the hit words are cut out of the text, with what stands between two hit words."""

    @F.pandas_udf("string")
    def without(texts: pd.Series, hits: pd.Series) -> pd.Series:
        out = []
        for body, hit in zip(texts, hits):
            if body is None or not len(hit):
                out.append(body)
                continue
            raw = body.encode("utf-8", "surrogatepass")
            starts, ends = word_bounds(np.frombuffer(raw.translate(LOWER), dtype=np.uint8), ALNUM)
            hit = np.asarray(hit)
            breaks = np.flatnonzero(np.diff(hit) > 1)
            firsts, lasts = hit[np.concatenate([[0], breaks + 1])], hit[np.concatenate([breaks, [len(hit) - 1]])]
            kept, at = [], 0
            for a, b in zip(starts[firsts].tolist(), ends[lasts].tolist()):
                kept.append(raw[at:a])
                at = b
            out.append((b"".join(kept) + raw[at:]).decode("utf-8", "surrogatepass"))
        return pd.Series(out)

    found = scan_benchmark(docs, benchmark, text=text)
    hit = found.columns[-2]
    columns = [F.when(F.size(hit) > 0, without(F.col(c), F.col(hit))).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns]
    return found.select(*columns)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.size("__hit").cast("long").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP2_SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM item_words WHERE len(ws) > 0)
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(ws) >= n)
), hits AS (
  SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (n, phrase)
), hit_words AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(ws) AS BIGINT) AS n_words,
       coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
