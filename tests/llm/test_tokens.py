"""Token ids, packing, token streams, shards."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passageloom.llm.packing import _places, fullest, minimum_slack_bins, pack_documents
from passageloom.llm.sharding import jump_hash, shard_rows
from passageloom.llm.token_files import END_OF_DOCUMENT, blocks_of_files, document_tokens, write_token_stream
from passageloom.llm.word_tokens import word_tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    return word_tokenizer(PATH).slow.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(awkward_rows):
    rng = np.random.default_rng(3)
    texts = [r[1] or "" for r in awkward_rows] + ["word, Word. " * 120_000, "a\n" * 5, "!!??..", "ÀÉß ŉ ª º ² ½ ¼ µ", "x\x85y z"]
    texts += ["".join(rng.choice([chr(c) for c in range(1, top)], 60)) for top in (0x80, 0x180, 0x250, 0x3000) for _ in range(100)]
    for text, ids in zip(texts, word_tokenizer(PATH).ids(texts), strict=True):
        assert ids.tolist() == library_ids(text)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=5), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_best_subset(counts, room):
    sums = {sum(k * n for k, n in zip(counts, ns)) for ns in product(*[range(c + 1) for c in counts.values()])}
    chosen = fullest(counts, room)
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)
    assert all(n <= counts[k] for k, n in chosen.items())


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=20))
@settings(max_examples=100, deadline=None)
def test_bins_hold_every_piece_once(sizes):
    bins = minimum_slack_bins(sizes, 50)
    used = Counter()
    for times, chosen in bins:
        assert sum(k * n for k, n in chosen.items()) <= 50
        used.update({k: times * n for k, n in chosen.items()})
    assert used == Counter(sizes)
    assert len(_places(bins)) == sum(len(chosen) for _, chosen in bins)


def check_packing(rows, docs, capacity):
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(d[0] for d in docs)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_packing(awkward, awkward_rows, nothing):
    rows = pack_documents(awkward, PATH, capacity=64).collect()
    count = check_packing(rows, awkward_rows, 64)
    total = sum(r.length for r in rows)
    assert count <= -(-total // 64) + 1
    texts = {r[0]: r[1] for r in awkward_rows if r[0] is not None}
    pieces = defaultdict(dict)
    for r in rows:
        if r.doc_id is not None:
            pieces[r.doc_id][r.piece] = r
    for doc_id, text in texts.items():
        ids = np.array([*library_ids(text), 1], dtype="<u4")
        assert len(pieces[doc_id]) == -(-len(ids) // 64)
        for r in pieces[doc_id].values():
            part = ids[64 * r.piece : 64 * r.piece + 64]
            assert (r.start, r.length, r.ids_crc32) == (64 * r.piece, len(part), zlib.crc32(part.tobytes()))
    assert pack_documents(nothing, PATH).count() == 0


def test_token_stream(spark, tmp_path, awkward, awkward_rows, nothing):
    folder = str(tmp_path / "stream")
    write_token_stream(awkward, folder, PATH, block_ids=50)
    stream = spark.read.parquet(folder)
    rows = document_tokens(stream, segment_blocks=3).collect()
    # Every document has its own count, the one that spells an end marker as well.
    expected = Counter((r[0], len(library_ids(r[1]))) for r in awkward_rows)
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == expected and all(r.closed for r in rows)
    for file_id in {r.file_id for r in rows}:
        mine = sorted((r for r in rows if r.file_id == file_id), key=lambda r: r.doc_no)
        assert [r.doc_no for r in mine] == list(range(len(mine)))
        at = 0
        for r in mine:
            assert r.start == at
            at += r.n_tokens + 1
    write_token_stream(nothing, str(tmp_path / "none"), PATH)
    assert document_tokens(spark.read.schema(stream.schema).parquet(str(tmp_path / "none"))).count() == 0


def test_an_end_id_inside_a_text_moves_no_name(spark, tmp_path):
    docs = [(1, "one <|endoftext|> two"), (2, "three"), (3, "four five"), (4, "six"), (None, "seven"), (5, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    for end_id, block_ids in ((0xFFFF, 2), (0xFFFF, 1 << 16), (49407, 2), (49407, 1 << 16)):
        folder = str(tmp_path / f"{end_id}-{block_ids}")
        write_token_stream(frame, folder, PATH, end_id=end_id, block_ids=block_ids)
        rows = sorted(document_tokens(spark.read.parquet(folder), end_id=end_id).collect(), key=lambda r: r.doc_no)
        lengths = [(d, len(library_ids(t))) for d, t in docs]
        if end_id == 49407:
            lengths[:1] = [(None, len(library_ids("one"))), (1, len(library_ids("two")))]
        assert [(r.doc_id, r.n_tokens) for r in rows] == lengths


@pytest.mark.parametrize("width", [2, 4])
def test_raw_files(spark, tmp_path, width):
    rng = np.random.default_rng(5)
    expected = {}
    for name in ("a", "b", "c"):
        ids = rng.integers(0, 4, 400)
        ids = ids[: np.flatnonzero(ids == 3)[-1] + 1] if name == "a" else np.append(ids, 1)
        (tmp_path / f"{name}.bin").write_bytes(ids.astype(f"<u{width}").tobytes())
        ends = np.flatnonzero(ids == 3)
        starts = np.concatenate([[0], ends + 1])
        stops = np.append(ends, len(ids))
        expected[name] = [(int(s), int(e - s)) for s, e in zip(starts, stops) if e < len(ids) or s < len(ids)]
    blocks = blocks_of_files(spark, str(tmp_path), width=width, block_ids=16)
    rows = document_tokens(blocks, end_id=3, width=width, segment_blocks=4).collect()
    for name, documents in expected.items():
        mine = sorted((r for r in rows if r.file_id.endswith(f"{name}.bin")), key=lambda r: r.doc_no)
        assert [(r.start, r.n_tokens) for r in mine] == documents
        assert [r.closed for r in mine] == [True] * (len(mine) - (name != "a")) + [False] * (name != "a")


def scalar_jump(key, buckets):
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    for n in (1, 2, 8, 9, 100):
        assert jump_hash(keys, n).tolist() == [scalar_jump(int(k), n) for k in keys]
    now, grown = jump_hash(keys, 8), jump_hash(keys, 9)
    assert set(grown[now != grown].tolist()) == {8} and 0.06 < (now != grown).mean() < 0.17


def test_shards(awkward, awkward_rows, nothing):
    rows = shard_rows(awkward).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in awkward_rows
    )
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len({r.shard for r in rows if r.doc_id == i}) == 1 for i in {r.doc_id for r in rows})
    assert shard_rows(nothing).count() == 0
    assert END_OF_DOCUMENT < 2**16 and awkward.select(F.lit(1)).count() == len(awkward_rows)
