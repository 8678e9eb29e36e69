"""Repair of the turn structure of conversations, by Knuth's lightest derivation.

The roles of a conversation have to read, by their initials, ``(s?(ua)+)?``: an optional system turn, then pairs of user
and assistant. A row may be kept, given another role, or deleted, and an empty turn may be inserted anywhere; blank and
duplicate rows have to go. The repair is the lightest derivation of the whole conversation in a weighted deduction
system: an item says that the rows from some row on become an end of that grammar which begins in some state, a
hyperedge derives an item from the item of the next row and an edit of this row (or from one item and an insertion), and
its value is the pair of cost and audit, the initials of the edits. Values grow along hyperedges, first by cost, then by
the number of rows used, and order equal items by their audit, so an agenda that pops the least value finalises items in
the right order and may stop at the goal. Equal costs go to the audit that comes first in ASCII.

A conversation of any length is taken apart into pieces of at most BLOCK_ROWS rows, since all rows are numbered in one
order (by range, see ``numbering.in_order``) and a block of numbers is a task's unit. A piece that may go on in another
block is solved for every state that may follow it. Edits of equal cost of one piece are never beginnings of each other
(they use the same rows, and end with one), so pieces compare by their ranks alone, and one short record for each piece
is all that meets when a long conversation is put together.

Defined cases: null roles and texts are one space, a null id or turn too where it is part of the damage key; rows are
ordered by turn (nulls first), then role, then the digest of role and text; a null conv_id names one conversation of its
own; equal rows are duplicates; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.llm.numbering import in_order
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

BLOCK_ROWS = 1024
#: Bytes of repaired text handed on at once where a conversation goes on in another block.
BLOB_BYTES = 1 << 20
# What the edits cost, and by how much an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

SPACE = " \t\n\v\f\r"
OK, BLANK, DUPLICATE, CUT_OFF = 0, 1, 2, 3
#: States of an end of a conversation, by the initial it begins with; "" is the empty end.
STATES = ["", "a", "u", "s"]
ACCEPTED = {"", "u", "s"}
LAST = 4  # the empty end, with insertions after the last row allowed
NAMES = {"u": "user", "a": "assistant"}
#: State after putting an initial before an end.
BEFORE = {("", "a"): "a", ("a", "u"): "u", ("u", "a"): "a", ("u", "s"): "s"}
#: The initial after an initial, if there is one.
NEXT = {"s": "u", "u": "a", "a": "u"}

Value = tuple[int, str]


def lightest(rows: list[tuple[str, int]], end: str, after_last: bool, goal: set[str] | None = None) -> dict[str, Value]:
    """(cost, audit) of the lightest derivation of the rows (initial, fault) before ``end``, by the state it begins with.

    With ``goal`` the agenda stops at the first of these states, and only that one is returned. Insertions after the
    last row are derived with ``after_last`` only.
    """
    n = len(rows)
    final: dict[tuple[int, str], Value] = {}
    # (cost, rows used, audit, state): an insertion adds cost, an edit uses a row, so every hyperedge raises the value.
    agenda: list[tuple[int, int, str, str]] = [(0, 0, "", end)]
    found: dict[str, Value] = {}
    while agenda:
        cost, used, audit, state = heapq.heappop(agenda)
        if (used, state) in final:
            continue
        final[used, state] = (cost, audit)
        if used == n and (goal is None or state in goal):
            found[state] = (cost, audit)
            if goal is not None or len(found) == len(STATES):
                break
        if used or after_last:
            for role in NAMES:
                if (state, role) in BEFORE:
                    heapq.heappush(agenda, (cost + INSERT, used, "I" + audit, BEFORE[state, role]))
        if used < n:
            initial, fault = rows[n - 1 - used]
            heapq.heappush(agenda, (cost + DELETE, used + 1, "D" + audit, state))
            if fault in (BLANK, DUPLICATE):
                continue
            kept = cost + (TRUNCATED if fault == CUT_OFF else 0)
            if (state, initial) in BEFORE:
                heapq.heappush(agenda, (kept + KEEP, used + 1, "K" + audit, BEFORE[state, initial]))
            for role in NAMES:
                if (state, role) in BEFORE:
                    heapq.heappush(agenda, (kept + REROLE, used + 1, "R" + audit, BEFORE[state, role]))
    return found


def chain(pieces: list[list[tuple[int, str, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost and, for each piece, (end, state) of the lightest way through pieces given by (end, state, cost, audit).

    From the last piece to the first each state keeps its best way, and the rank of that way among those of all states:
    audits of a piece are never beginnings of each other, so ways compare by audit of the piece, then by the rank behind.
    """
    ways: list[dict[str, tuple[int, int, int]]] = []  # by state: cost, rank, end
    behind: dict[str, tuple[int, int]] = {}
    for i in range(len(pieces) - 1, -1, -1):
        last = i == len(pieces) - 1
        audits = sorted({audit for end, _, _, audit in pieces[i] if (end == LAST) == last})
        rank_of = {audit: rank for rank, audit in enumerate(audits)}
        best: dict[str, tuple[int, tuple[int, int], int]] = {}
        for end, state, cost, audit in pieces[i]:
            if (end == LAST) != last or not last and STATES[end] not in behind:
                continue
            ahead, rank = (0, 0) if last else behind[STATES[end]]
            way = (cost + ahead, (rank_of[audit], rank), end)
            if state not in best or way[:2] < best[state][:2]:
                best[state] = way
        ranks = {r: n for n, r in enumerate(sorted({way[1] for way in best.values()}))}
        behind = {state: (cost, ranks[rank]) for state, (cost, rank, _) in best.items()}
        ways.append({state: (cost, ranks[rank], end) for state, (cost, rank, end) in best.items()})
    ways.reverse()
    state = min((s for s in ways[0] if s in ACCEPTED), key=lambda s: ways[0][s][:2])
    total, path = ways[0][state][0], []
    for way in ways:
        end = way[state][2]
        path.append((end, state))
        state = "" if end == LAST else STATES[end]
    return total, path


class Repair(NamedTuple):
    """Staged: ``summary`` (conv, blank, duplicate, truncated, illegal, gaps, cost, audit), ``plans`` (conv, block, first,
    whole, state, audit) of every piece, ``rows`` (conv, block, number, role, text)."""

    summary: DataFrame
    plans: DataFrame
    rows: DataFrame


def conversation_key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def damaged(turns: DataFrame) -> DataFrame:
    """conv, turn, role, text of the rows after damage, which crc32 of ``conv_id:turn`` modulo 20 decides."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = (F.crc32(named) % 20).cast("int")
    rows = turns.select(conversation_key(F.col("conv_id")).alias("conv"), "turn", F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind != 0").select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("twin")).drop("twin")


def _runs(batches: Iterator[pa.RecordBatch], key: Callable) -> Iterator[tuple]:
    """(key, rows) of consecutive rows with equal keys; rows are dictionaries and come one after the other."""
    return groupby((row for batch in batches for part in _sliced(batch) for row in part.to_pylist()), key)


def _sliced(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


PIECE = (
    "conv string, block long, first long, whole boolean, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "first_turn long, last_turn long, turns long, options array<struct<end:int,state:string,cost:long,audit:string>>"
)
SUMMARY = "conv string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"


def _legal(one: str, two: str) -> bool:
    return one + two in ("su", "ua", "au")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the rows of sorted blocks. The first and the last one of a block may go on outside of it."""
    for block, found in groupby(_runs(batches, itemgetter("block", "conv")), lambda run: run[0][0]):
        held = None
        out = []
        for number, ((_, conv), rows) in enumerate(found):
            if held is not None:
                out.append(_piece(*held, whole=held[0] > 0))
            held = (number, block, conv, list(rows))
        out.append(_piece(*held, whole=False))
        yield pa.RecordBatch.from_pylist(out, _PIECE_ARROW)


def _piece(_: int, block: int, conv: str, rows: list[dict], whole: bool) -> dict:
    steps = [(r["initial"], r["fault"]) for r in rows]
    options = []
    if whole:
        ((state, (cost, audit)),) = lightest(steps, "", True, ACCEPTED).items()
        options.append({"end": LAST, "state": state, "cost": cost, "audit": audit})
    else:
        for end in range(len(STATES) + 1):
            found = lightest(steps, "" if end == LAST else STATES[end], end == LAST)
            options += [{"end": end, "state": state, "cost": cost, "audit": audit} for state, (cost, audit) in found.items()]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    faults = [fault for _, fault in steps]
    return {
        "conv": conv, "block": block, "first": rows[0]["number"], "whole": whole,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT_OFF),
        "illegal": sum(not _legal(a, b) for (a, _), (b, _) in zip(steps, steps[1:])),
        "first_initial": steps[0][0], "last_initial": steps[-1][0],
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)), "options": options,
    }


_PIECE_ARROW = pa.schema(
    [("conv", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("whole", pa.bool_())]
    + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
    + [("first_initial", pa.string()), ("last_initial", pa.string())]
    + [(n, pa.int64()) for n in ("first_turn", "last_turn", "turns")]
    + [("options", pa.list_(pa.struct([("end", pa.int32()), ("state", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])))]
)
_JOINED_ARROW = pa.schema(
    [("conv", pa.string())]
    + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")]
    + [("audit", pa.string()), ("plans", pa.list_(pa.struct([("block", pa.int64()), ("first", pa.int64()), ("whole", pa.bool_()), ("state", pa.string()), ("audit", pa.string())])))]
)
JOINED = SUMMARY + ", plans array<struct<block:long,first:long,whole:boolean,state:string,audit:string>>"


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations from their pieces, which come in order."""
    for conv, run in _runs(batches, itemgetter("conv")):
        pieces = list(run)
        cost, path = chain([[(o["end"], o["state"], o["cost"], o["audit"]) for o in p["options"]] for p in pieces])
        plans = []
        for piece, (end, state) in zip(pieces, path):
            audit = next(o["audit"] for o in piece["options"] if (o["end"], o["state"]) == (end, state))
            plans.append({"block": piece["block"], "first": piece["first"], "whole": len(pieces) == 1, "state": state, "audit": audit})
        dated = [p for p in pieces if p["turns"]]
        distinct = sum(p["turns"] for p in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        row = {n: sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated", "illegal")}
        row["illegal"] += sum(not _legal(a["last_initial"], b["first_initial"]) for a, b in zip(pieces, pieces[1:]))
        row["gaps"] = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - distinct if dated else 0
        row |= {"conv": conv, "cost": cost, "audit": "".join(p["audit"] for p in plans), "plans": plans}
        yield pa.RecordBatch.from_pylist([row], _JOINED_ARROW)


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Repair:
    """The lightest repair of the conversations in (conv, turn, role, text) rows; conv, role and text are not null."""
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("conv").cast("string"), "conv", F.length("role").cast("string"), "role", "text"), 256))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT_OFF).otherwise(OK)
    facts = rows.select("conv", F.col("turn").cast("long").alias("turn"), "role", "text", digest.alias("digest"), fault.alias("fault"), F.monotonically_increasing_id().alias("twin"))
    # The last one keeps copies of one row apart, so that they spread over the ranges.
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("twin")]
    placed = in_order(facts, order, "number", "turns").withColumn("block", F.floor(F.col("number") / block_rows))
    narrow = placed.select("conv", "block", "number", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "digest")
    # Only texts that repeat within a conversation are looked up, however many copies one has.
    again = placed.groupBy("digest").agg(F.min("number").alias("seen"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    marked = lookup_join(narrow, stage(again.select("digest", "seen"), "repeated-turns"), "digest", "left")
    repeated = (F.col("fault") != BLANK) & (F.col("number") > F.col("seen"))
    marked = marked.select("block", "number", "conv", "turn", "initial", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"))
    blocks = marked.repartition("block").sortWithinPartitions("block", "number")
    pieces = stage(blocks.mapInArrow(_solve, PIECE), "pieces")
    cut = pieces.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "first")
    joined = stage(cut.mapInArrow(_join_pieces, JOINED), "joined-pieces")
    whole = pieces.where("whole").select("*", F.col("options")[0].alias("chosen"))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    done = whole.select("conv", "blank", "duplicate", "truncated", "illegal", gaps.alias("gaps"), "chosen.cost", "chosen.audit")
    plans = whole.select("conv", "block", "first", "whole", "chosen.state", "chosen.audit")
    plans = plans.unionByName(joined.select("conv", F.inline("plans")))
    return Repair(done.unionByName(joined.drop("plans")), plans, placed.select("conv", "block", "number", "role", "text"))


LINE = "conv string, whole boolean, first long, number long, edit string, role string, text string"
_LINE_ARROW = pa.schema([("conv", pa.string()), ("whole", pa.bool_()), ("first", pa.int64()), ("number", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns from sorted blocks in which the plan of a piece comes before its rows."""
    plan: dict = {}
    at, role = 0, ""
    for batch in batches:
        for part in _sliced(batch):
            out = []

            def add(edit: str, name: str, text: str) -> None:
                out.append({"conv": plan["conv"], "whole": plan["whole"], "first": plan["first"], "number": plan["number"], "edit": edit, "role": name, "text": text})

            def inserted() -> None:
                nonlocal at, role
                while at < len(plan["audit"]) and plan["audit"][at] == "I":
                    add("I", NAMES[role], "")
                    at, role = at + 1, NEXT[role]

            for row in part.to_pylist():
                if row["audit"] is not None:
                    plan, at, role = row, 0, row["state"]
                    plan["first"] = plan["number"]
                    continue
                plan["number"] = row["number"]
                inserted()
                edit = plan["audit"][at]
                at += 1
                if edit != "D":
                    add(edit, row["role"] if edit == "K" else NAMES[role], row["text"])
                    role = NEXT[role]
                if "I" * (len(plan["audit"]) - at) == plan["audit"][at:]:
                    inserted()
            if out:
                yield pa.RecordBatch.from_pylist(out, _LINE_ARROW)


def repaired_turns(found: Repair) -> DataFrame:
    """conv, whole (the conversation lies in one block), first (number of its first row here), number, edit, role, text.

    The turns of a piece follow each other in one task, in order; ``number`` and this order put the pieces together.
    """
    nothing = F.lit(None).cast("string")
    plans = found.plans.select("block", F.col("first").alias("number"), F.lit(0).alias("kind"), "conv", "whole", "state", "audit", nothing.alias("role"), nothing.alias("text"))
    rows = found.rows.select("block", "number", F.lit(1).alias("kind"), "conv", F.lit(None).cast("boolean").alias("whole"), nothing.alias("state"), nothing.alias("audit"), "role", "text")
    both = plans.unionByName(rows).repartition("block").sortWithinPartitions("block", "number", "kind")
    return both.mapInArrow(_apply, LINE)


def repaired_digests(found: Repair) -> DataFrame:
    """conv, repaired_sha256 of the conversations that keep a turn: ``role:text``, newline-joined.

    Conversations within a block are hashed where they are. The turns of other ones go on as blobs in order, which a
    hash takes one after the other by its definition, so no task holds more than a blob of a conversation.
    """

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, first), lines in _runs(batches, itemgetter("conv", "first")):
            digest, blob, size, part = hashlib.sha256(), [], 0, 0
            whole, started = True, False
            for line in lines:
                body = f"{line['role']}:{line['text']}".encode("utf-8", "surrogatepass")
                whole = line["whole"]
                if whole:
                    digest.update(b"\n" * started + body)
                else:
                    blob.append(body)
                    size += len(body)
                    if size > BLOB_BYTES:
                        yield _blobs([(conv, first, part, None, b"\n".join(blob))])
                        blob, size, part = [], 0, part + 1
                started = True
            if whole:
                yield _blobs([(conv, first, 0, digest.hexdigest(), None)])
            elif blob:
                yield _blobs([(conv, first, part, None, b"\n".join(blob))])

    def hash_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, blobs in _runs(batches, itemgetter("conv")):
            digest, started = hashlib.sha256(), False
            for row in blobs:
                digest.update(b"\n" * started + row["blob"])
                started = True
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    def _blobs(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=["conv", "first", "part", "repaired_sha256", "blob"])

    hashed = stage(repaired_turns(found).mapInArrow(hash_lines, "conv string, first long, part long, repaired_sha256 string, blob binary"), "turn-hashes")
    rest = hashed.where("blob IS NOT NULL").repartition("conv").sortWithinPartitions("conv", "first", "part")
    done = hashed.where("blob IS NULL").select("conv", "repaired_sha256")
    return done.unionByName(rest.mapInArrow(hash_blobs, "conv string, repaired_sha256 string"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair_conversations(damaged(turns))
    every = turns.select("conv_id").distinct().withColumn("conv", conversation_key(F.col("conv_id")))
    joined = every.join(found.summary, "conv", "left").join(repaired_digests(found), "conv", "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
