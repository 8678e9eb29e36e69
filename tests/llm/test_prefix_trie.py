"""The prefix trie against a plain dictionary of all prefixes, and parentheses against a stack."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from passageloom.llm.parentheses import find_close, leaf_pairs, subtree_sums
from passageloom.llm.prefix_trie import ends_digests, op13_prefix_trie, prefix_trie, rebuilt

TURNS = "conv_id long, turn long, role string, text string"


def random_bits(rng, n, deep):
    bits, depth, left = [], 0, n
    while left or depth:
        if left and (not depth or rng.random() < deep):
            bits, depth, left = [*bits, 1], depth + 1, left - 1
        else:
            bits, depth = [*bits, 0], depth - 1
    return bits


@pytest.mark.parametrize("deep", [0.3, 0.55, 0.95])
@pytest.mark.parametrize("block", [2, 3, 64])
def test_find_close_equals_a_stack(deep, block):
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 130, 900):
        bits, stack, expected = random_bits(rng, n, deep), [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                expected[stack.pop()] = i
        opens, close = find_close(np.array(bits, dtype=np.uint8), block)
        assert dict(zip(opens.tolist(), close.tolist())) == expected
        weights = np.array([rng.randint(0, 9) for _ in range(n)], dtype=np.int64)
        order = {i: k for k, i in enumerate(sorted(expected))}
        (sums,) = subtree_sums(np.array(bits, dtype=np.uint8), weights)
        assert sums.tolist() == [sum(int(weights[order[j]]) for j in expected if i <= j < expected[i]) for i in sorted(expected)]
        assert leaf_pairs(np.array([*bits, 0])).tolist() == [expected[i] == i + 1 for i in sorted(expected)]


def plain_trie(turns):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))

    def key(row):
        turn, role, text = row
        return turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    own = {c: [r[1:] for r in sorted(rows, key=key)] for c, rows in own.items()}
    made = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = own.get(base, [])[:h] + rows[h:]
    members = {}
    for c, rows in made.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(node, [])]
        size = len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(x for x, _ in below) + (not below), sum(y for _, y in below) + (len(members[node]) - 1) * size)
    out = []
    for node, found in members.items():
        ended = sorted(c for c in found if len(made[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()
        out.append((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(kids.get(node, [])), *totals[node], digest))
    return sorted(out, key=str)


def some_turns(rng, convs=120):
    texts = ["Yes.", "No.", "é日本.", "", None, "A longer answer."]
    turns = []
    for conv in [None, *rng.sample(range(-20, 400), convs)]:
        for turn in range(rng.randint(1, 12)):
            turns.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", "system", None]), rng.choice(texts[: rng.randint(1, 6)])))
    # Many conversations that are the same, one that is very long, and repeated rows.
    turns += [(1000 + c, t, "user", "same") for c in range(60) for t in range(10)]
    turns += [(2000, t, "user" if t % 2 else "assistant", f"turn {t // 3}") for t in range(700)]
    turns += [(2005, t, "user" if t % 2 else "assistant", f"turn {t // 3}") for t in range(600)]
    return turns + turns[:7]


@pytest.mark.parametrize("shard_paths", [1, 4, 1 << 15])
def test_trie_equals_all_prefixes(spark, shard_paths):
    turns = some_turns(random.Random(2))
    extra = spark.createDataFrame([(*t, 1, "x", 2) for t in turns], TURNS + ", depth long, node string, path long").repartition(4)
    rows = prefix_trie(rebuilt(extra), shard_paths).collect()
    assert sorted((tuple(r) for r in rows), key=str) == plain_trie(turns)
    assert len({(r.depth, r.conv_id, r.n_convs) for r in rows}) == len(rows)


def test_hot_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr("passageloom.llm.prefix_trie.ENDS_IN_CHUNK", 7)
    pairs = [("hot", i) for i in range(500)] + [(f"n{i}", -i) for i in range(20)]
    random.Random(3).shuffle(pairs)
    rows = {r.node: r.ends_sha256 for r in ends_digests(spark.createDataFrame(pairs, "node string, conv_id long").repartition(5)).collect()}
    assert rows["hot"] == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert len(rows) == 21 and rows["n3"] == hashlib.sha256(b"-3").hexdigest()


def test_empty_and_turnless(spark, tmp_path):
    assert prefix_trie(rebuilt(spark.createDataFrame([], TURNS))).count() == 0
    turnless = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    spark.createDataFrame([(turnless, 0, "user", "gone")], TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    (row,) = op13_prefix_trie(spark, str(tmp_path)).collect()
    assert tuple(row) == (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())
