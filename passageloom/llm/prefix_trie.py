"""A prefix trie of conversations: nodes, members, leaves, and what sharing prefixes saves.

A node is a sequence of turns that some conversations begin with. It is known by its depth and two 64-bit hashes, each
the exclusive or of hashes of (place, turn) along the sequence; so they are running values along a conversation, which
add up over the ranges of a global order, and no conversation has to meet in one task. Members, children and smallest
members of all nodes are plain aggregates by that key.

Sums over subtrees come from the trie itself. Only its branching nodes and ends are put into it: between two of them a
chain of nodes has the same members, and what holds for such a node follows from the end of its chain. The paths of all
different conversations over these nodes (along a path, numbers of members fall strictly) are sorted by range and cut
into shards; a shard writes its part as balanced parentheses, finds where each node closes with a tree of block minima
(see ``parentheses``), counts the leaf pairs between by rank and takes savings from a cumulative array. A node on the
first or last path of a shard, its spine, may have parts in other shards: those are summed by node. Nodes that the
path before the shard opened weigh nothing in it, so nothing counts twice.

Defined cases: a null conv_id names no conversation; null roles and texts are empty; turns are ordered by turn (nulls
first), then role, then the digest of role and text; repeated rows are turns each; a conversation whose rebuilt form
has no turns is a member of the root; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passageloom.llm.numbering import in_order
from passageloom.llm.parentheses import leaf_pairs, subtree_sums
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

SHARD_PATHS = 1 << 15
#: Ids that are rendered into one string on the way to the digest of a node's ends.
ENDS_IN_CHUNK = 4096
# Conversations borrow turns from the first one of five, and at most eight.
FAMILY, BORROWED = 5, 9


def turns_of(conversations: DataFrame) -> DataFrame:
    """Staged conv_id, number, digest, bytes: the turns of all conversations in one order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("twin"),
    )
    # The last one keeps copies of one row apart, so that they spread over the ranges.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("twin")]
    return in_order(rows, order, "number", "trie-turns").select("conv_id", "number", "digest", "bytes")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, digest, bytes, ends: the turns (depth from 1) of the rebuilt conversations, and a row of depth 0 each.

    A conversation takes the first h turns of the first one of its family, h by a hash of its id, and goes on with its own
    turns behind its first h.
    """
    turns = turns_of(conversations)
    known = turns.groupBy("conv_id").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    known = known.select("*", (F.crc32(F.col("conv_id").cast("string")) % BORROWED).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    known = stage(known, "trie-conversations")
    lengths = known.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    # At most FAMILY conversations have one base.
    known = known.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    known = stage(known.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-lengths")
    placed = lookup_join(turns, known.select("conv_id", "first", "h", "taken", "length"), "conv_id").withColumn("at", F.col("number") - F.col("first"))
    own = placed.where("at >= h").select("conv_id", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "digest", "bytes", "length")
    heads = placed.where(F.col("at") < BORROWED).select(F.col("conv_id").alias("base"), "at", "digest", "bytes")
    lent = known.select("conv_id", "base", "h", "length").join(heads, "base").where("at < h")
    lent = lent.select("conv_id", (F.col("at") + 1).alias("depth"), "digest", "bytes", "length")
    tops = known.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("bytes"), "length")
    every = own.unionByName(lent).unionByName(tops)
    return every.select("conv_id", "depth", "digest", "bytes", (F.col("depth") == F.col("length")).alias("ends"))


RUNNING = "conv_id long, depth long, ends boolean, bytes long, a1 long, a2 long, part int, k1 long, k2 long, cum long"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running exclusive ors of a1 and a2 and running bytes along each conversation, within sorted rows."""
    before, held = None, [0, 0, 0]
    names = ["conv_id", "depth", "ends", "bytes", "a1", "a2", "part", "k1", "k2", "cum"]
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(conv))))
        sums = []
        for i, (name, add) in enumerate((("a1", np.bitwise_xor), ("a2", np.bitwise_xor), ("bytes", np.add))):
            total = add.accumulate(batch.column(name).to_numpy())
            offset = np.concatenate([[0], total[starts[1:] - 1]])
            back = total - offset[run] if add is np.add else total ^ offset[run]
            if before == int(conv[0]):
                first = slice(0, starts[1] if len(starts) > 1 else len(conv))
                back[first] = add(back[first], held[i])
            sums.append(back)
        before, held = int(conv[-1]), [int(s[-1]) for s in sums]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names[:7]], *[pa.array(s, pa.int64()) for s in sums]], names=names)


def node_name(depth: str, one: str, two: str) -> Column:
    return F.concat_ws(":", depth, one, two)


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, depth, ends, bytes, node, parent, cum (bytes down to the node) of every turn of (conv_id, depth, digest, bytes, ends)."""
    hashed = turns.select("conv_id", "depth", "ends", "bytes", F.xxhash64("depth", "digest").alias("a1"), F.xxhash64(F.lit(1), "depth", "digest").alias("a2"))
    ranged = hashed.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").withColumn("part", F.spark_partition_id())
    rows = stage(ranged.mapInArrow(_running, RUNNING), "trie-running")
    # What a conversation that goes over several ranges brings along: a few numbers for each range.
    sums = rows.groupBy("conv_id", "part").agg(F.bit_xor("a1").alias("x1"), F.bit_xor("a2").alias("x2"), F.sum("bytes").alias("xb"))
    cut = stage(sums.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").join(sums, "conv_id"), "trie-cut")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    brought = cut.select(
        F.concat_ws(":", "conv_id", "part").alias("piece"),
        *[F.coalesce(add(c).over(earlier), F.lit(0)).alias(c) for c, add in (("x1", F.bit_xor), ("x2", F.bit_xor), ("xb", F.sum))],
    )
    found = lookup_join(rows.withColumn("piece", F.concat_ws(":", "conv_id", "part")), stage(brought, "trie-brought"), "piece", "left")
    x1, x2, xb = (F.coalesce(c, F.lit(0)) for c in ("x1", "x2", "xb"))
    whole = found.select("conv_id", "depth", "ends", "bytes", "a1", "a2", F.col("k1").bitwiseXOR(x1).alias("k1"), F.col("k2").bitwiseXOR(x2).alias("k2"), (F.col("cum") + xb).alias("cum"))
    up = whole.select("*", F.col("k1").bitwiseXOR(F.col("a1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("a2")).alias("p2"), (F.col("depth") - 1).alias("above"))
    parent = F.when(F.col("depth") > 0, node_name("above", "p1", "p2"))
    return up.select("conv_id", "depth", "ends", "bytes", node_name("depth", "k1", "k2").alias("node"), parent.alias("parent"), "cum")


STEP = "struct<depth:long,node:string,n_convs:long,leaf:boolean,cum:long>"
SUMS = "node string, base long, n_leaves long, saved long, spine boolean"


def _shard(paths: list[list[dict]], before: list[dict] | None) -> pa.RecordBatch:
    """Leaves and savings of the nodes of a shard, from its sorted paths and the path before them."""
    bits: list[int] = []
    nodes, base, leaf, weight, own_base = [], [], [], [], []
    stack: list[str] = []

    def common(one: list[str], two: list[dict]) -> int:
        n = 0
        while n < len(one) and n < len(two) and one[n] == two[n]["node"]:
            n += 1
        return n

    def put(path: list[dict], start: int, counts: bool) -> None:
        for i in range(start, len(path)):
            above = path[i - 1]["cum"] if i else 0
            bits.append(1)
            nodes.append(path[i]["node"])
            base.append(above)
            leaf.append(path[i]["leaf"] and counts)
            weight.append((path[i]["n_convs"] - 1) * (path[i]["cum"] - above) if counts else 0)
            stack.append(path[i]["node"])

    if before is not None:
        put(paths[0][: common([s["node"] for s in before], paths[0])], 0, False)
    for path in paths:
        shared = common(stack, path)
        bits += [0] * (len(stack) - shared)
        del stack[shared:]
        put(path, shared, True)
    bits += [0] * len(stack)
    encoded = np.array(bits, dtype=np.uint8)
    leaves, saved = subtree_sums(encoded, leaf_pairs(encoded) & np.array(leaf, dtype=bool), np.array(weight, dtype=np.int64))
    spine = {s["node"] for path in (paths[0], paths[-1]) for s in path}
    columns = [pa.array(nodes), pa.array(base, pa.int64()), pa.array(leaves), pa.array(saved), pa.array([n in spine for n in nodes])]
    return pa.RecordBatch.from_arrays(columns, names=["node", "base", "n_leaves", "saved", "spine"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for start in range(0, batch.num_rows, 1024) for row in batch.slice(start, 1024).to_pylist())
    for _, found in groupby(rows, itemgetter("shard")):
        before, paths = None, []
        for row in found:
            if row["ghost"]:
                before = row["path"]
            else:
                paths.append(row["path"])
        if paths:
            yield _shard(paths, before)


def subtrees(paths: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """node, base, n_leaves, saved from different ``path`` arrays: shards of the sorted paths, spines merged."""
    ordered = in_order(paths, ["path"], "number", "trie-paths").withColumn("shard", F.floor(F.col("number") / shard_paths))
    last = ordered.where((F.col("number") + 1) % shard_paths == 0).withColumn("shard", F.col("shard") + 1)
    both = ordered.withColumn("ghost", F.lit(False)).unionByName(last.withColumn("ghost", F.lit(True)))
    dealt = both.repartition("shard").sortWithinPartitions("shard", "number").select("shard", "ghost", "path")
    found = stage(dealt.mapInArrow(_shards, SUMS), "trie-shards")
    spines = found.where("spine").groupBy("node").agg(F.max("base").alias("base"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    return found.where("NOT spine").drop("spine").unionByName(spines)


def ends_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 of (node, conv_id) rows: the ids of a node, ascending and comma-joined.

    Ids are rendered in the ranges of a sort, chunk by chunk, and the chunks of a node hashed one after the other.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for node, found in groupby(rows, itemgetter(0)):
            ids: list[int] = []
            for _, conv in found:
                ids.append(conv)
                if len(ids) == ENDS_IN_CHUNK:
                    yield chunk(node, ids)
                    ids = []
            if ids:
                yield chunk(node, ids)

    def chunk(node: str, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (pair for batch in batches for pair in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()))
        for node, found in groupby(rows, itemgetter(0)):
            total, started = hashlib.sha256(), False
            for _, ids in found:
                total.update(b"," * started + ids.encode())
                started = True
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([total.hexdigest()])], names=["node", "ends_sha256"])

    ranged = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = stage(ranged.mapInArrow(render, "node string, first long, ids string"), "trie-ends")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """The nodes of the trie of (conv_id, depth, digest, bytes, ends) rows, one row of depth 0 for each conversation."""
    paths = paths_of(turns)
    nodes = stage(
        paths.groupBy("node").agg(
            F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
            F.max("bytes").alias("bytes"), F.max("cum").alias("cum"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("first_end"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")

    # The trie of branching nodes and ends. (smallest member, members) names such a node as well as its chain.
    chain = F.concat_ws(":", "conv_id", "n_convs")
    corners = stage(nodes.where("n_ends > 0 OR n_children != 1").select("node", chain.alias("chain"), "n_convs", (F.col("n_children") == 0).alias("leaf")), "trie-corners")
    different = stage(nodes.where("n_ends > 0").select(F.col("first_end").alias("conv_id")), "trie-different")
    steps = lookup_join(lookup_join(paths.select("conv_id", "depth", "node", "cum"), different, "conv_id"), corners.drop("chain"), "node")
    step = F.struct("depth", "node", "n_convs", "leaf", "cum").cast(STEP)
    sums = subtrees(steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path")).select("path"), shard_paths)
    sums = stage(sums.join(corners.select("node", "chain"), "node").select("chain", "base", "n_leaves", "saved"), "trie-sums")

    several = stage(nodes.where("n_ends > 1").select("node"), "trie-several")
    digests = ends_digests(lookup_join(paths.where("ends").select("node", "conv_id"), several, "node"))
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = lookup_join(nodes.join(digests, "node", "left").withColumn("chain", chain), sums, "chain")
    found = lookup_join(found, stage(parents, "trie-parents"), "parent", "left")
    above = F.col("cum") - F.col("bytes") - F.col("base")
    one = F.sha2(F.coalesce(F.col("first_end").cast("string"), F.lit("")), 256)
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * above).alias("saved_tokens"),
        F.coalesce("ends_sha256", one).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_concat([CAST(i AS UBIGINT)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS t(i))
), known AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         CAST(xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
                              lambda a, x: xor(a >> 8, crc[CAST((xor(a, x) & 255) + 1 AS BIGINT)])), 4294967295) % 9 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc_table
), turns AS (
  SELECT conv_id, md5(length(r) || ':' || r || t) AS turn_key, octet_length(encode(t)) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, md5(length(r) || ':' || r || t)) - 1 AS at
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)
), taken AS (
  SELECT k.conv_id, count(t.at) AS n FROM known k LEFT JOIN turns t ON t.conv_id = k.base AND t.at < k.h GROUP BY k.conv_id
), made AS (
  SELECT k.conv_id, t.at + 1 AS depth, turn_key, bytes FROM known k JOIN turns t ON t.conv_id = k.base AND t.at < k.h
  UNION ALL
  SELECT k.conv_id, n + t.at - k.h + 1, turn_key, bytes FROM known k JOIN taken USING (conv_id) JOIN turns t ON t.conv_id = k.conv_id AND t.at >= k.h
), paths AS (
  SELECT conv_id, depth, bytes, sha256(string_agg(turn_key, ',' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM made
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM known
), steps AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM steps GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), trie AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)
), below AS (
  SELECT s.depth, s.node, count(*) FILTER (t.n_children = 0) AS n_leaves, CAST(sum((t.n_convs - 1) * t.bytes) AS BIGINT) AS saved_tokens
  FROM trie t JOIN paths s ON s.conv_id = t.conv_id AND s.depth <= t.depth GROUP BY ALL
)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, sha256(t.ended) AS ends_sha256
FROM trie t JOIN below USING (depth, node) LEFT JOIN trie p ON p.depth = t.depth - 1 AND p.node = t.parent
"""
