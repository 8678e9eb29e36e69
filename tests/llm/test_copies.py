"""Exact and near copies, components, contamination."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from passageloom.llm.components import components
from passageloom.llm.contamination import contaminated, drop_contaminated, remove_spans, scan_benchmark
from passageloom.llm.exact_dedup import drop_exact_copies, exact_groups
from passageloom.llm.numbering import with_places, without_rows
from passageloom.llm.pii import sanitise
from passageloom.llm.quality import keep_good
from passageloom.llm.simhash import drop_near_copies, fingerprint, forest, golay_keys, links_of, near_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


def test_exact_groups(awkward, awkward_rows, nothing):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", d[1] or "") for d in awkward_rows]
    rows = exact_groups(awkward).collect()
    keep = {t: smallest(d[0] for d, u in zip(awkward_rows, normal) if u == t) for t in set(normal)}
    size = Counter(normal)
    expected = Counter((d[0], keep[t], size[t], hashlib.sha256(t.encode()).digest()) for d, t in zip(awkward_rows, normal))
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in rows) == expected
    assert Counter(bytes(r.digest) for r in rows if r.kept) == Counter({hashlib.sha256(t.encode()).digest(): 1 for t in size})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_groups(nothing).count() == 0


def test_dropping_exact_copies_keeps_columns(awkward, awkward_rows, nothing):
    kept = drop_exact_copies(awkward)
    assert kept.columns == awkward.columns
    assert len(kept.collect()) == len({re.sub(r"[\x20\x09-\x0D]+", " ", d[1] or "") for d in awkward_rows})
    assert drop_exact_copies(nothing).count() == 0


def test_rows_keep_their_places_when_scans_are_split_anew(spark, tmp_path):
    """Executors that come or go change the splits of a scan; the rows dropped must be the same ones."""
    rng = random.Random(8)
    rows = [(i, f"text {rng.randrange(300)} " + "w " * rng.randrange(3)) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    normal = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in rows}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        placed, file, row = with_places(spark.read.parquet(str(tmp_path / "d")))
        dropped = exact_groups(spark.read.parquet(str(tmp_path / "d"))).where("NOT kept").persist()
        dropped.count()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        again, file, row = with_places(spark.read.parquet(str(tmp_path / "d")))
        kept = [r.doc_id for r in without_rows(again, file, row, dropped).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(kept) == sorted({t: min(i for i, u in normal.items() if u == t) for t in normal.values()}.values())


def test_columns_of_all_inner_names_are_kept(spark):
    names = ["__0", "__1", "__2", "row", "file", "key", "digest", "fingerprint", "__bad", "__hit", "__row", "__items", "__n_words", "kept", "root", "n_rows", "window", "base", "pairs"]
    rows = [(i, f"text number {i % 7} and some more words", *[str(i % 7)] * len(names)) for i in range(21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    benchmark = spark.createDataFrame([(1, "nothing of this")], "item_id long, text string")
    for kept in (drop_exact_copies(docs), drop_near_copies(docs), keep_good(docs), drop_contaminated(docs, benchmark), remove_spans(docs, benchmark), sanitise(docs)):
        assert kept.columns == docs.columns
        assert all(r["__row"] == r["__0"] == str(r.doc_id % 7) for r in kept.collect())
    assert drop_exact_copies(docs).count() == 7 and drop_near_copies(docs).count() <= 7 and drop_contaminated(docs, benchmark).count() == 21


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_golay_keys_lose_no_pair():
    rng = np.random.default_rng(1)
    values = rng.integers(-(2**63), 2**63 - 1, 400, dtype=np.int64)
    row, key = golay_keys(values)
    known = set(zip(row.tolist(), key.tolist()))
    for bits in range(5):
        changed = values.copy().view(np.uint64)
        for i in range(len(changed)):
            for b in rng.choice(64, bits, replace=False):
                changed[i] ^= np.uint64(1) << np.uint64(b)
        row2, key2 = golay_keys(changed.view(np.int64))
        assert {r for r, _ in known & set(zip(row2.tolist(), key2.tolist()))} == set(range(len(values)))


def test_near_groups(spark, awkward, awkward_rows, nothing):
    prints = [plain_fingerprint(d[1]) for d in awkward_rows]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = union_find(len(prints), links)
    expected = Counter((d[0], p, smallest(e[0] for e, s in zip(awkward_rows, root) if s == r)) for d, p, r in zip(awkward_rows, prints, root))
    rows = near_groups(awkward).collect()
    assert Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(set(root))
    kept = drop_near_copies(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(set(root))
    assert near_groups(nothing).count() == 0
    assert fingerprint("one two") == fingerprint("ONE\ttwo ") != 0 == fingerprint(None)


@pytest.mark.parametrize("block", [3, 10_000])
def test_dense_clusters_in_blocks(spark, block):
    """Many fingerprints around few centres: hot keys, cut into blocks or not, give the components of all pairs."""
    rng = random.Random(2)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randint(0, 3)))) for _ in range(60)}
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = links_of(frame, block_size=block)
    roots = {r.node: r.root for r in components(links).collect()}
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if ((values[i] ^ values[j]) % 2**64).bit_count() <= 4]
    expected = union_find(len(values), pairs)
    groups = {}
    for value, root in zip(values, expected):
        groups.setdefault(root, set()).add(roots.get(value, value))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)
    assert len(forest(np.array(values), 4)) == len(values) - len(groups)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7, 3)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(rows[i] == 0 for i in range(41) if i in rows) and all(rows[1000 + i] == 1000 for i in range(1, 200))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_hits(text, items):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    found, hit, names = cut(text), set(), set()
    for item, body in items:
        item_words = cut(body)
        n = min(13, len(item_words))
        for i in range(len(item_words) - n + 1 if item_words else 0):
            for at in range(len(found) - n + 1):
                if found[at : at + n] == item_words[i : i + n]:
                    hit |= set(range(at, at + n))
                    names.add("" if item is None else str(item))
    return len(found), sorted(hit), sorted(names)


@pytest.mark.parametrize("budget", [1 << 24, 2000])
def test_contamination(spark, budget):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["été", "1st"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 13, 20, 30])))) for i in range(12)]
    items += [(3, items[5][1]), (None, items[2][1]), (20, None), (21, ""), (22, "!!"), (23, "Solo")]
    docs = []
    for i in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0 and body:
            at = rng.randrange(len(body))
            body[at:at] = items[rng.randrange(12)][1].upper().split()
        docs.append((i, ", ".join(body), "x", 1))
    docs += [(100, None, None, None), (101, "", "x", 2), (None, items[2][1], "x", 3), (5, docs[5][1], "x", 1), (102, "solo " * 3 + "w " * 30_000, "x", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_words string, hit long").repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = scan_benchmark(frame, benchmark, budget=budget).withColumn("bad", contaminated()).collect()
    assert Counter((r.doc_id, r["__n_words"], tuple(r["__hit"]), tuple(r["__items"])) for r in rows) == Counter(
        (d[0], n, tuple(h), tuple(k)) for d in docs for n, h, k in [brute_hits(d[1], items)]
    )
    clean = drop_contaminated(frame, benchmark)
    expected = [d for d in docs for n, h, _ in [brute_hits(d[1], items)] if not (h and 20 * len(h) >= n)]
    assert clean.columns == frame.columns and Counter(map(tuple, clean.collect())) == Counter(expected)
    cut = {(r.doc_id, r.text) for r in remove_spans(frame, benchmark).collect()}
    assert all(not brute_hits(text, items[:12])[1] or doc_id in range(60) for doc_id, text in cut)
    assert (100, None) in cut and (101, "") in cut


def test_contamination_of_empty_tables(spark, awkward, awkward_rows, nothing):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert drop_contaminated(awkward, empty).count() == len(awkward_rows)
    assert drop_contaminated(nothing, spark.createDataFrame([(1, "a b")], empty.schema)).count() == 0
    assert scan_benchmark(awkward, empty).where(F.size("__hit") > 0).count() == 0
