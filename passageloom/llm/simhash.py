"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of 23, 23 and 18 bits (the last padded with zeros). The binary Golay
code (23, 12) is perfect: each 23-bit word lies within 3 bits of exactly one codeword, and within 4 bits of one or six.
Two words that differ in at most 2 bits share one of these codewords, since the one nearest to a word between them is
within 4 bits of both. The codewords within 4 bits, by their 12 message bits, are the fuzzy keys of a segment.

Four differing bits fall on the segments in one of two ways, and each has keys that agree:

* one segment is the same; of the other two, one differs in at most 2 bits: the whole segment with a fuzzy key of
  another one (six such tables, 30 to 35 bits);
* every segment differs, so by 1 or 2 bits each: fuzzy keys of the first two with a third of the last segment, one third
  of which is the same (three tables, 30 bits).

So no link within 4 bits is lost. Distinct fingerprints are dealt by key, those with the same key are compared, and each
key emits a forest of its links, not its pairs: the components are the same. Keys with more fingerprints than a block
are compared block by block, each pair of blocks a row of its own.

Defined cases: null and empty texts have fingerprint zero and link like any other; equal rows have equal fingerprints
and share a component; a component is named by its smallest doc_id, null only if it has no other; an empty table gives no
rows; ``drop_near_copies`` keeps all columns and one row of each component, the one with the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.llm.byte_words import LOWER
from passageloom.llm.components import components
from passageloom.llm.numbering import with_places, without_rows
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
# The seed of the hash, and the generator polynomial of the Golay code.
SEED = 42
GENERATOR = 0xAE3
#: Fingerprints of one key that are compared at once.
BLOCK = 16_384


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the hashes of the word shingles, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(found) - words + 1)
    spans = zip(starts[:last].tolist(), (ends[words - 1 :] if len(found) >= words else ends[-1:]).tolist())
    digest = xxhash.xxh64_intdigest
    hashed = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashed), 8192):
        bits = np.unpackbits(hashed[first : first + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashed), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """The other columns, and ``fingerprint`` (64 bits, read as signed) in place of the text."""
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("fingerprint", T.LongType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(values, pa.int64())], names=schema.names)

    return docs.mapInArrow(make, schema)


def _remainders(values: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit word by the generator: its syndrome."""
    out = values.copy()
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, GENERATOR << (bit - 11), 0)
    return out


_coset_table: list[np.ndarray] = []


def _coset_errors() -> np.ndarray:
    """By syndrome: the error patterns of up to 4 bits that lead to a codeword (1 or 6), the rest filled with -1."""
    if not _coset_table:
        bits = 1 << np.arange(23)
        patterns = [np.array([0])]
        for _ in range(4):
            grown = np.unique((patterns[-1][:, None] | bits[None, :]).ravel())
            patterns.append(grown[np.bitwise_count(grown) == len(patterns)])
        every = np.concatenate(patterns)
        syndrome = _remainders(every)
        order = np.argsort(syndrome, kind="stable")
        first = np.searchsorted(syndrome[order], np.arange(2048))
        rank = np.arange(len(every)) - first[syndrome[order]]
        table = np.full((2048, rank.max() + 1), -1, dtype=np.int64)
        table[syndrome[order], rank] = every[order]
        _coset_table.append(table)
    return _coset_table[0]


def fuzzy_keys(segment: np.ndarray) -> np.ndarray:
    """The message bits of all codewords within 4 bits of each word; one row for each word, -1 where there are fewer."""
    errors = _coset_errors()[_remainders(segment)]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the fingerprint, key) of every key of the fingerprints."""
    bits = values.view(np.uint64)
    segments = [(bits >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in ((0, 23), (23, 23), (46, 18))]
    fuzzy = [fuzzy_keys(s) for s in segments]
    rows, keys, table = [], [], 0
    for same in range(3):
        for other in range(3):
            if same != other:
                row, column = np.nonzero(fuzzy[other] >= 0)
                rows.append(row)
                keys.append(table << 36 | segments[same][row] << 12 | fuzzy[other][row, column])
                table += 1
    pair = np.where((fuzzy[0][:, :, None] < 0) | (fuzzy[1][:, None, :] < 0), -1, fuzzy[0][:, :, None] << 12 | fuzzy[1][:, None, :])
    row, one, two = np.nonzero(pair >= 0)
    for third in range(3):
        rows.append(row)
        keys.append((table + third) << 36 | pair[row, one, two] << 6 | segments[2][row] >> 6 * third & 63)
    return np.concatenate(rows), np.concatenate(keys)


def _near(one: np.ndarray, many: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(many ^ one) <= bits


def forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values that lie within ``bits`` of each other."""
    links: list[tuple[int, int]] = []
    left = values.view(np.uint64)  # bits of signed numbers would be counted by their absolute value
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            value = queue.pop()
            near = np.bitwise_count(left ^ value) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                one = int(value.view(np.int64))
                links += [(one, other) for other in found.view(np.int64).tolist()]
                queue += list(found)
    return links


LINKS = "a long, b long, key long, block int, members array<long>"


def _link_rows(links: list[tuple[int, int]]) -> pa.RecordBatch:
    n = len(links)
    nothing = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64()), *nothing], names=["a", "b", "key", "block", "members"])


def _linker(bits: int, block_size: int):
    """Links within runs of equal keys of sorted (key, fingerprint) rows; long runs also give their blocks."""

    def full(key: int, block: int, members: np.ndarray) -> pa.RecordBatch:
        one = [pa.array([key], pa.int64()), pa.array([block], pa.int32()), pa.array([members.view(np.int64)], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *one], names=["a", "b", "key", "block", "members"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        block = 0
        for batch in _with_end(batches):
            last = batch is None
            if not last:
                keys = np.concatenate([keys, batch.column("key").to_numpy()])
                values = np.concatenate([values, batch.column("fingerprint").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            stops = np.append(starts[1:], len(keys))
            done = len(starts) if last else len(starts) - 1
            links: list[tuple[int, int]] = []
            sizes = stops - starts
            pairs = np.flatnonzero(sizes[:done] == 2)
            one, two = values[starts[pairs]], values[starts[pairs] + 1]
            near = np.bitwise_count(one ^ two) <= bits
            links += list(zip(one[near].view(np.int64).tolist(), two[near].view(np.int64).tolist()))
            for i in np.flatnonzero((sizes[:done] > 2) | ((np.arange(done) == 0) & (block > 0))).tolist():
                run = values[starts[i] : stops[i]].view(np.int64)
                first_block = 0
                if i == 0 and block:
                    first_block, block = block, 0
                parts = [run[x : x + block_size] for x in range(0, len(run), block_size)]
                for n, part in enumerate(parts):
                    links += forest(part, bits)
                    if first_block or len(parts) > 1:
                        yield full(int(keys[starts[i]]), first_block + n, part)
            if done < len(starts):  # the last run may go on
                if done:
                    block = 0
                keys, values = keys[starts[done] :], values[starts[done] :]
                while len(keys) > 2 * block_size:
                    part = values[:block_size].view(np.int64)
                    links += forest(part, bits)
                    yield full(int(keys[0]), block, part)
                    block += 1
                    keys, values = keys[block_size:], values[block_size:]
            else:
                keys, values = keys[:0], values[:0]
            if links:
                yield _link_rows(links)

    return link


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links_of(distinct: DataFrame, bits: int = MAX_BITS, block_size: int = BLOCK) -> DataFrame:
    """(a, b) links whose components are those of all pairs of distinct fingerprints within ``bits`` (4 at most)."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys are complete for up to {MAX_BITS} differing bits")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for first in range(0, len(values), 2048):
                part = values[first : first + 2048]
                row, key = golay_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fingerprint"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1)):
                links = forest(np.concatenate([one.values.to_numpy(), two.values.to_numpy()]), bits)
                if links:
                    yield _link_rows(links)

    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("fingerprint").mapInArrow(deal, "key long, fingerprint long")
    dealt = keyed.repartition(partitions, "key").sortWithinPartitions("key", "fingerprint")
    found = stage(dealt.mapInArrow(_linker(bits, block_size), LINKS), "near")
    blocks = found.where("members IS NOT NULL")
    counts = stage(blocks.groupBy("key").agg(F.count(F.lit(1)).alias("blocks")), "blocks")
    # Each pair of blocks of a key is a key of its own, so the pairs of one key spread over the tasks.
    numbered = lookup_join(blocks.select("key", "block", "members"), counts, "key")
    later = F.when(F.col("block") + 1 < F.col("blocks"), F.sequence(F.col("block").cast("long") + 1, F.col("blocks") - 1))
    earlier = F.when(F.col("block") > 0, F.sequence(F.lit(0).cast("long"), F.col("block").cast("long") - 1))
    one = numbered.select("key", F.col("block").cast("long").alias("block1"), F.explode(later).alias("block2"), F.col("members").alias("members1"))
    two = numbered.select("key", F.explode(earlier).alias("block1"), F.col("block").cast("long").alias("block2"), F.col("members").alias("members2"))
    wide = one.join(two, ["key", "block1", "block2"]).select("members1", "members2")
    return found.where("members IS NULL").union(wide.mapInArrow(across, LINKS)).select("a", "b")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """file, row (the place of the row), doc_id, fingerprint, component_id, kept of every row."""
    return _groups(*with_places(docs), words, bits, doc_id, text)


def _groups(docs: DataFrame, file: str, row: str, words: int, bits: int, doc_id: str, text: str) -> DataFrame:
    placed = docs.select(F.col(file).alias("file"), F.col(row).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stage(fingerprints(placed, words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    distinct = stage(rows.groupBy("fingerprint").agg(F.min(first).alias("first")), "distinct")
    roots = components(links_of(distinct, bits), "components")
    joined = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = stage(joined.select("fingerprint", "root", "first"), "named")
    # Only components of several fingerprints and fingerprints of several rows can be large; neither is a hot key here.
    firsts = stage(named.groupBy("root").agg(F.min("first").alias("least")).select("root", "least.*").withColumnsRenamed({"doc_id": "component_id", "file": "first_file", "row": "first_row"}).drop("no_id"), "firsts")
    groups = stage(lookup_join(named.select("fingerprint", "root"), firsts, "root").drop("root"), "near-groups")
    kept = (F.col("file") == F.col("first_file")) & (F.col("row") == F.col("first_row"))
    return lookup_join(rows, groups, "fingerprint").select("file", "row", "doc_id", "fingerprint", "component_id", kept.alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns. The documents are not shuffled."""
    placed, file, row = with_places(docs)
    dropped = _groups(placed, file, row, words, bits, doc_id, text).where("NOT kept")
    return without_rows(placed, file, row, dropped)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
