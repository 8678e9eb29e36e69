"""Repair of conversations against a plain search over all edits, and rows against a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from passageloom.llm.repair import (
    BLANK, CUT_OFF, DUPLICATE, LAST, OK, STATES, chain, conversation_key, damaged, lightest, op12_conversation_repair, repair_conversations,
    repaired_digests, repaired_turns,
)

TURNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """Forward over the rows: every reachable beginning of the grammar with its cheapest (cost, audit, turns)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may come after the last initial
    best = {"": (0, "", ())}

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def with_insertions(table):
        for _ in range(4):
            for state, (cost, audit, out) in list(table.items()):
                for role in after[state]:
                    if role != "s":
                        better(table, role, (cost + 3, audit + "I", (*out, (role, None))))
        return table

    best = with_insertions(best)
    for i, (initial, fault) in enumerate(rows):
        grown = {}
        for state, (cost, audit, out) in best.items():
            better(grown, state, (cost + 4, audit + "D", out))
            if fault in (BLANK, DUPLICATE):
                continue
            kept = cost + (3 if fault == CUT_OFF else 0)
            for role in after[state]:
                if role == initial:
                    better(grown, role, (kept, audit + "K", (*out, (role, i))))
                if role != "s":
                    better(grown, role, (kept + 3, audit + "R", (*out, (role, i))))
        best = with_insertions(grown)
    return min((v for s, v in best.items() if s in ("", "a")), key=lambda v: v[:2])


def exhaustive_repair(rows):
    """All audits with at most two insertions before and after each row, as a check of the search itself."""
    found = []

    def go(i, state, cost, audit, inserted):
        if inserted < 2:
            for role in "ua":
                if role in {"": "u", "s": "u", "u": "a", "a": "u"}[state]:
                    go(i, role, cost + 3, audit + "I", inserted + 1)
        if i == len(rows):
            if state in ("", "a"):
                found.append((cost, audit))
            return
        initial, fault = rows[i]
        go(i + 1, state, cost + 4, audit + "D", 0)
        if fault not in (BLANK, DUPLICATE):
            more = 3 if fault == CUT_OFF else 0
            for role in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                if role == initial:
                    go(i + 1, role, cost + more, audit + "K", 0)
                if role != "s":
                    go(i + 1, role, cost + more + 3, audit + "R", 0)

    go(0, "", 0, "", 0)
    return min(found)


def random_rows(rng, n):
    return [(rng.choice("suat"), rng.choice([OK, OK, OK, BLANK, DUPLICATE, CUT_OFF])) for _ in range(n)]


def test_lightest_derivation():
    rng = random.Random(3)
    for n in range(6):
        for _ in range(30):
            rows = random_rows(rng, n)
            ((_, found),) = lightest(rows, "", True, {"", "u", "s"}).items()
            assert found == exhaustive_repair(rows) == plain_repair(rows)[:2]


def test_pieces_give_the_same_repair():
    rng = random.Random(4)
    for _ in range(150):
        rows = random_rows(rng, rng.randint(1, 30))
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randint(0, min(4, len(rows) - 1)))) if len(rows) > 1 else []
        pieces = []
        for a, b in itertools.pairwise([0, *cuts, len(rows)]):
            options = []
            for end in range(len(STATES) + 1):
                for state, (cost, audit) in lightest(rows[a:b], "" if end == LAST else STATES[end], end == LAST).items():
                    options.append((end, state, cost, audit))
            pieces.append(options)
        total, path = chain(pieces)
        audit = "".join(next(o[3] for o in options if o[:2] == chosen) for options, chosen in zip(pieces, path))
        assert (total, audit) == plain_repair(rows)[:2]


def plain_rows(turns):
    """By conversation: the rows after damage, in order."""
    out = {}
    for conv, turn, role, text in turns:
        rows = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)

    def key(conv, row):
        turn, role, text = row
        name = "" if conv is None else f"={conv}"
        return turn is not None, turn or 0, role, hashlib.sha256(f"{len(name)}:{name}:{len(role)}:{role}:{text}".encode()).digest()

    return {conv: sorted(rows, key=lambda row: key(conv, row)) for conv, rows in out.items()}


def plain_answer(rows):
    seen, steps = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\v\f\r")[-1:]
        steps.append((role[:1], BLANK if not end else DUPLICATE if (role, text) in seen else CUT_OFF if end not in ".!?" else OK))
        seen.add((role, text))
    cost, audit, out = plain_repair(steps)
    names = {"u": "user", "a": "assistant"}
    lines = []
    for role, i in out:
        kept = i is not None and steps[i][0] == role
        lines.append(f"{rows[i][1] if kept else names[role]}:{'' if i is None else rows[i][2]}")
    turns = {t for t, _, _ in rows if t is not None}
    faults = [f for _, f in steps]
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(steps))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    assert GOOD.fullmatch("".join(r for r, _ in out))
    return gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_OFF), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def awkward_turns(rng):
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n ", None, "ends. \n", "é日本."]
    roles = ["user", "assistant", "system", "tool", None, ""]
    turns = []
    for conv in [None, *range(-3, 40)]:
        for turn in range(rng.randint(1, 9)):
            turns.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles[:2] * 4 + roles), rng.choice(texts)))
    # One conversation with a third of all rows, some texts of it repeated very often, and one very long text.
    turns += [(77, i, "user" if i % 2 else "assistant", rng.choice(["Same.", f"Row {i}.", "cut off"])) for i in range(len(turns) // 2)]
    turns += [(78, 0, "user", "long " * 400_000 + "."), (78, 1, "assistant", "Fine.")]
    return turns + turns[:5]


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_repair_of_awkward_conversations(spark, block_rows):
    turns = awkward_turns(random.Random(5))
    extra = spark.createDataFrame([(*t, 1, "x", 2.0) for t in turns], TURNS + ", number long, block string, conv double").repartition(5)
    found = repair_conversations(damaged(extra), block_rows)
    rows = found.summary.join(repaired_digests(found), "conv", "left").collect()
    nothing = hashlib.sha256(b"").hexdigest()
    got = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or nothing) for r in rows}
    expected = {"" if c is None else f"={c}": plain_answer(rows) for c, rows in plain_rows(turns).items() if rows}
    assert len(rows) == len(got) and got == expected
    lines = repaired_turns(found).orderBy("number").where("conv = '=77'").collect()
    assert GOOD.fullmatch("".join(r.role[0] for r in lines))


def test_query_returns_every_conversation(spark, tmp_path):
    turns = awkward_turns(random.Random(6))
    lost = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    folder = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([*turns, (lost, 0, "user", "Gone.")], TURNS).write.parquet(folder)
    rows = {r.conv_id: r for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert rows.keys() == {t[0] for t in turns} | {lost}
    assert tuple(rows[lost])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows[78].repaired_sha256 == plain_answer(plain_rows(turns)[78])[-1]


def test_no_conversations(spark):
    found = repair_conversations(damaged(spark.createDataFrame([], TURNS)))
    assert found.summary.count() == 0 and repaired_turns(found).count() == 0 and repaired_digests(found).count() == 0
    assert spark.range(1).select(conversation_key(F.lit(None))).first()[0] == ""
