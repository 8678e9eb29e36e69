"""The passage with the highest cosine similarity, for each query.

Both tables have (id, embedding) and may have ``pos``, a struct of numbers that orders the rows of the input. Scores
that are not a number are no scores; equal scores go to the passage that comes last by ``pos``, or to the larger id.
Every query row is answered, with a null passage when no passage has a score.

No table of pairs is formed. The rows and the longest vector of each side are measured by one aggregate. The side with
fewer rows is broadcast as a matrix if that takes at most ``budget`` bytes, and the other side streams past it in Arrow
batches without a shuffle. Against broadcast queries each task hands its winners on as arrays, one row for each chunk of
queries, and rounds of merges leave one row for each chunk. If neither side fits, passages are dealt into cells around
pivots, and queries meet only the cells that may hold their best. All three ways give the same answers, and a winner's
vector is looked up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.operators import vector_blocks
from passageloom.operators.lookup import fits_broadcast, lookup_join
from passageloom.operators.staging import stage
from passageloom.operators.vector_blocks import (
    BATCH_BYTES, CHUNK_QUERIES, TILE_CELLS, BestSoFar, Block, all_scores, best_of, matrix_of, merged_winners, numbers_of,
    small_batches, widened, winner_row,
)

# Tasks get the helper with the job, so executors need nothing installed.
cloudpickle.register_pickle_by_value(vector_blocks)

SLICE_BYTES = 64 * 1024 * 1024
#: Parts of a chunk of queries that are merged into one, in each round.
FAN = 16
#: Cells of passages at most, the cell of rows without an angle, and what rounding may take from an angle or a score.
PIVOTS = 256
ODD_CELL = -1
SLACK = 1e-6
#: Rows of a block of all pairs, on each side.
BLOCK_ROWS = 1024
_PAIR_NAMES = ["query_id", "passage_id", "score"]
_PAIR_SCHEMA = "query_id bigint, passage_id bigint, score double"
_POSITION = {"pos"}


def _order_fields(passages: DataFrame) -> list[str]:
    if "pos" not in passages.columns:
        return []
    return [f"pos.{field.name}" for field in passages.schema["pos"].dataType.fields]


def _with_order(passages: DataFrame) -> tuple[DataFrame, list[str]]:
    """(id, embedding, order0, ...): the numbers that decide between equal scores: position, id, hash of the vector.

    Together they name a row: rows that agree in all of them are the same.
    """
    fields = _order_fields(passages)
    names = [f"order{i}" for i in range(len(fields) + 2)]
    numbers = [*(F.col(f).cast("bigint") for f in [*fields, "id"]), F.xxhash64("embedding")]
    order = [number.alias(n) for number, n in zip(numbers, names)]
    return passages.select("id", "embedding", *order), names


def vector_sizes(table: DataFrame) -> tuple[int, int]:
    """Rows and longest vector, from one aggregate whose tasks send two numbers each."""
    found = table.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("embedding")).alias("widest")).first()
    return found["rows"], max(1, found["widest"] or 1)


def _require_equal_lengths(queries: DataFrame, passages: DataFrame) -> None:
    lengths = queries.select(F.size("embedding").alias("n")).unionAll(passages.select(F.size("embedding")))
    found = lengths.where("n >= 0").agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    if found["least"] != found["most"]:
        raise ValueError(f"vectors have {found['least']} to {found['most']} numbers")


def _bytes(sizes: tuple[int, int], table: DataFrame) -> int:
    """Of the table as a matrix, in which every row is as long as the longest; floats stay floats."""
    floats = isinstance(table.schema["embedding"].dataType.elementType, T.FloatType)
    return (4 if floats else 8) * sizes[0] * sizes[1]


def _matrix(table: pa.Table) -> np.ndarray:
    return matrix_of(table.column("embedding").combine_chunks())


def best_passages(
    queries: DataFrame,
    passages: DataFrame,
    with_embedding: bool = False,
    budget: int = SLICE_BYTES,
    passage_sizes: tuple[int, int] | None = None,
    equal_lengths: bool = False,
) -> DataFrame:
    """(query_id, passage_id, score), one row for each query row; with the passage's embedding if asked for.

    Vectors of unequal length are compared over the shorter one; ``equal_lengths=True`` raises if there are any.

    Queries with ``pos`` keep it, so that the answers can be put in the order of the queries. ``passage_sizes`` spares
    the pass that measures the passages (``vector_sizes``), for a table that is searched again and again.
    """
    queries = queries.select("id", "embedding", *_POSITION.intersection(queries.columns))
    ordered, names = _with_order(passages)
    if equal_lengths:
        _require_equal_lengths(queries, passages)

    query_sizes = vector_sizes(queries)
    passage_sizes = passage_sizes or vector_sizes(passages)
    few_queries, few_passages = _bytes(query_sizes, queries) <= budget, _bytes(passage_sizes, passages) <= budget
    if few_passages and not (few_queries and query_sizes[0] < passage_sizes[0]):
        answers = _best_by_passage_slice(queries, ordered.toArrow(), names)
    elif few_queries:
        answers = _best_by_query_slice(queries, ordered, names)
    else:
        answers, _ = _best_by_cells(queries, ordered, names, budget, query_sizes, passage_sizes)
    if with_embedding:
        answers = _attach_embedding(answers, ordered, names, budget)
    return answers.drop("order")


def _attach_embedding(answers: DataFrame, passages: DataFrame, names: list[str], budget: int) -> DataFrame:
    """Add the winners' own vectors: only rows that won are looked up, however the winners were found."""
    answers = stage(answers.withColumn("_key", F.concat_ws(":", *[f"order.{n}" for n in names])), "answers")
    keyed = passages.select(F.concat_ws(":", *names).alias("_key"), "embedding")
    wanted = stage(answers.where("passage_id IS NOT NULL").select("_key").distinct(), "winners")
    won = keyed.join(F.broadcast(wanted) if fits_broadcast(wanted, "_key", budget) else wanted, "_key", "left_semi")
    vectors = stage(won.groupBy("_key").agg(F.first("embedding").alias("embedding")), "winning-vectors")
    return lookup_join(answers, vectors, "_key", "left", budget=budget).drop("_key")


def _winner_fields(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in ["id", *names]] + [T.StructField("score", T.DoubleType())]


def _answers(found: DataFrame, every: DataFrame, names: list[str]) -> DataFrame:
    """The best row of each query; ``every`` has (query_no, query_id, ...) once for each query, found or not."""
    carried = [c for c in every.columns if c != "query_no"]
    payload = F.struct("id", "score", F.struct(*names).alias("order"))
    order = F.when(F.col("score").isNotNull(), F.struct("score", *names))
    best = (
        every.unionByName(found, allowMissingColumns=True)
        .groupBy("query_no")
        .agg(F.max_by(payload, order).alias("best"), *[F.max(c).alias(c) for c in carried])
    )
    return best.select(
        "query_id",
        F.col("best.id").alias("passage_id"),
        F.col("best.score").alias("score"),
        F.col("best.order").alias("order"),
        *[c for c in carried if c != "query_id"],
    )


def _answer_schema(names: list[str], carried: list[T.StructField]) -> T.StructType:
    order = T.StructType([T.StructField(n, T.LongType()) for n in names])
    numbers = [T.StructField("query_id", T.LongType()), T.StructField("passage_id", T.LongType()), T.StructField("score", T.DoubleType())]
    return T.StructType([*numbers, T.StructField("order", order), *carried])


def _best_by_query_slice(
    queries: DataFrame, passages: DataFrame, names: list[str], chunk_queries: int = CHUNK_QUERIES, fan: int = FAN
) -> DataFrame:
    """Queries broadcast, passages streamed.

    A task sends the winners of a chunk of queries as one row of arrays. The rows of a chunk are dealt into parts, each
    part is merged into one row, and ever fewer parts follow, so that no task waits for all others and the number of
    rows shuffled does not depend on the number of queries within a chunk. A merge holds the winners of one chunk.
    """
    spark = passages.sparkSession
    known = queries.toArrow()
    carried = [field for field in queries.schema.fields if field.name not in ("id", "embedding")]
    shared = spark.sparkContext.broadcast(_matrix(known))
    asked = spark.sparkContext.broadcast(known.drop_columns(["embedding"]).combine_chunks())
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in ["q", "id", *names]]
    schema = T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("part", T.LongType()), *lists, T.StructField("score", T.ArrayType(T.DoubleType()))]
    )
    row_names, answer_schema = schema.names, _answer_schema(names, carried)
    carried_names = [field.name for field in carried]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        some = Block(matrix)
        best = BestSoFar(len(matrix), len(names))
        for batch in small_batches(batches):
            columns = numbers_of(batch, ["id", *names])
            block = matrix_of(batch.column("embedding"))
            width = max(block.shape[1], some.matrix.shape[1])
            if width > some.matrix.shape[1]:
                some = Block(widened(matrix, width))
            row, value = best_of(some, Block(widened(block, width), columns[1:]))
            q = np.flatnonzero(row >= 0)
            best.take(q, columns[:, row[q]], value[q])
        for chunk, first in enumerate(range(0, len(matrix), chunk_queries)):
            q = np.flatnonzero(best.found[first : first + chunk_queries])
            if len(q):
                yield winner_row(chunk, TaskContext.get().partitionId(), q, best.winner[:, first + q], best.score[first + q], row_names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part, best in merged_winners(batches, chunk_queries, len(names)):
            q = np.flatnonzero(best.found)
            yield winner_row(chunk, part, q, best.winner[:, q], best.score[q], row_names)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, best in merged_winners(batches, chunk_queries, len(names)):
            rows = asked.value.slice(chunk * chunk_queries, chunk_queries)
            n = rows.num_rows
            none = ~best.found[:n]
            ranks = pa.StructArray.from_arrays([pa.array(order[:n]) for order in best.winner[1:]], names=names, mask=pa.array(none))
            arrays = [rows.column("id").combine_chunks(), pa.array(best.winner[0][:n], mask=none), pa.array(best.score[:n], mask=none), ranks]
            arrays.extend(rows.column(name).combine_chunks() for name in carried_names)
            yield pa.RecordBatch.from_arrays(arrays, names=answer_schema.names)

    def dealt(rows: DataFrame, parts: int) -> DataFrame:
        # The default number of partitions, so that adaptive execution may join small ones.
        numbered = rows.withColumn("part", F.pmod("part", F.lit(parts).cast("long")))
        return numbered.repartition("chunk", "part").sortWithinPartitions("chunk", "part")

    chunks = -(-known.num_rows // chunk_queries)
    found = passages.mapInArrow(search, schema)
    parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, chunks))
    while parts > fan:
        found = dealt(found, parts).mapInArrow(merge, schema)
        parts = -(-parts // fan)
    # A row without winners for each chunk keeps the queries for which no task finds anything.
    empty = [F.lit(0).cast("long").alias("part"), *[F.array().cast(f.dataType).alias(f.name) for f in schema.fields[2:]]]
    every = spark.range(chunks).select(F.col("id").alias("chunk"), *empty)
    return dealt(found.unionByName(every), 1).mapInArrow(answer, answer_schema)


def _best_by_passage_slice(queries: DataFrame, few: pa.Table, names: list[str]) -> DataFrame:
    """Passages broadcast, queries streamed: each query row is answered where it is, nothing is shuffled."""
    shared = queries.sparkSession.sparkContext.broadcast((numbers_of(few, ["id", *names]), _matrix(few)))
    carried = [field for field in queries.schema.fields if field.name not in ("id", "embedding")]
    schema = _answer_schema(names, carried)
    carried_names = [field.name for field in carried]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, matrix = shared.value
        passages = Block(matrix, columns[1:])
        for batch in small_batches(batches):
            block = matrix_of(batch.column("embedding"))
            width = max(block.shape[1], passages.matrix.shape[1])
            if width > passages.matrix.shape[1]:
                passages = Block(widened(matrix, width), columns[1:])
            best, value = best_of(Block(widened(block, width)), passages)
            none = best < 0
            rows = columns[:, best] if columns.shape[1] else np.zeros((len(columns), len(best)), dtype=np.int64)
            ranks = pa.StructArray.from_arrays([pa.array(row) for row in rows[1:]], names=names)
            arrays = [batch.column("id"), pa.array(rows[0], mask=none), pa.array(value, mask=none), ranks]
            arrays.extend(batch.column(name) for name in carried_names)
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return queries.mapInArrow(search, schema)


def _best_by_cells(
    queries: DataFrame, passages: DataFrame, names: list[str], budget: int, query_sizes: tuple[int, int], passage_sizes: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """Neither side fits a broadcast: passages lie in cells around pivots, and a query goes to cells that may hold its best.

    A passage belongs to the pivot at the smallest angle, and a cell knows the smallest and largest angle of its passages to
    its pivot. By the triangle inequality for angles no passage of a cell is nearer to a query than the query's angle to the
    pivot minus the largest, or the smallest minus the query's. Each query is first answered by the cell of its own
    pivot; the score found there rules out all cells whose bound is worse, and the rest is searched. So a query is shuffled
    once for each cell that may matter to it. Rows whose norm cannot be divided out have no angle: such passages lie in a
    cell that every query visits, such queries visit every cell. Passages of a crowded cell are cut into parts of about
    ``budget`` bytes. Also returns (query_no, cell) of all visits.
    """
    spark = passages.sparkSession
    width = max(passage_sizes[1], query_sizes[1])
    count = min(PIVOTS, max(4, 4 * -(-8 * passage_sizes[0] * passage_sizes[1] // budget)))
    # A bounded sample: passages picked by a hash of their vector, so that equal vectors are one pivot.
    hashed = passages.where("embedding IS NOT NULL").select("embedding", F.xxhash64("embedding").alias("pick"))
    least = F.broadcast(hashed.select("pick").distinct().orderBy("pick").limit(count))
    picked = hashed.join(least, "pick", "left_semi").groupBy("pick").agg(F.first("embedding").alias("embedding"))
    sample = Block(widened(_matrix(picked.toArrow().sort_by("pick")), width))
    pivots = spark.sparkContext.broadcast(sample.unit[sample.safe])

    def angles(block: Block) -> np.ndarray:
        return np.arccos(np.clip(block.unit @ pivots.value.T, -1.0, 1.0))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            block = Block(widened(matrix_of(batch.column("embedding")), width))
            far = angles(block)
            regular = block.safe & (far.shape[1] > 0)
            cell = np.where(regular, far.argmin(axis=1) if far.shape[1] else 0, ODD_CELL)
            angle = np.where(regular, far.min(axis=1) if far.shape[1] else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    def placed(rows: DataFrame, number: str, name: str) -> DataFrame:
        schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
        return stage(rows.mapInArrow(place, schema).withColumn(number, F.monotonically_increasing_id()), name)

    stored, asked = placed(passages, "_no", "passages"), placed(queries, "query_no", "queries")
    cells = stored.groupBy("cell").agg(F.min("angle").alias("least"), F.max("angle").alias("most"), F.count(F.lit(1)).alias("rows")).collect()
    bounds = spark.sparkContext.broadcast({r["cell"]: (r["least"], r["most"]) for r in cells})  # PIVOTS + 1 at most
    parts = {r["cell"]: -(-8 * width * r["rows"] // budget) for r in cells}
    held = {r["cell"]: r["rows"] for r in cells}
    schema = T.StructType([T.StructField("query_no", T.LongType()), *_winner_fields(names)])
    keys = ["cell", "part", "q_part"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by their group: first the passages, which are held, then the queries, which stream past them."""
        at, some, block = None, [], None
        for batch in batches:
            number = numbers_of(batch, [*keys, "kind"])
            cuts = np.flatnonzero((number[:, 1:] != number[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if start == stop:
                    continue
                *group, kind = number[:, start].tolist()
                if group != at:
                    at, some, block = group, [], None
                rows = batch.slice(start, stop - start)
                if kind == 0:
                    some.append(rows)
                    continue
                if not some:
                    continue
                if block is None:
                    many = pa.Table.from_batches(some)
                    columns = numbers_of(many, ["id", *names])
                    block = Block(widened(matrix_of(many.column("embedding").combine_chunks()), width), columns[1:])
                for queries_of in small_batches(iter([rows])):
                    row, value = best_of(Block(widened(matrix_of(queries_of.column("embedding")), width)), block)
                    q = np.flatnonzero(row >= 0)
                    query_no = numbers_of(queries_of, ["query_no"])[0]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in [query_no[q], *columns[:, row[q]], value[q]]], names=schema.names)

    def meet(visits: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Searches (query_no, embedding, cell).

        Visitors of a cell stream past each of its parts, so they need no memory and passages need no copies. Only a cell
        with more work than a task's share of all work has its visitors cut as well, and its passages copied as often:
        groups number as many as the tasks and the parts together, however many rows there are.
        """
        visits = stage(visits, name)
        seen = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect() if r["cell"] in held}
        work = max(1, sum(n * held[c] for c, n in seen.items()))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        known = [(c, parts[c], -(-n * held[c] * tasks // (work * parts[c]))) for c, n in seen.items()]
        table = F.broadcast(spark.createDataFrame(known, "cell int, parts long, crowd long"))  # PIVOTS + 1 at most
        one = visits.join(table, "cell").withColumn("q_part", F.pmod(F.xxhash64("query_no"), F.col("crowd")))
        one = one.select("cell", "q_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "query_no", "embedding")
        two = stored.join(table, "cell").withColumn("part", F.pmod(F.xxhash64("_no"), F.col("parts")))
        two = two.select("cell", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("crowd") - 1)).alias("q_part"), F.lit(0).alias("kind"), "id", *names, "embedding")
        # Numbers that the other kind lacks are zeros, which Arrow hands on without a mask.
        one = one.select(*keys, "kind", "query_no", *[F.lit(0).cast("long").alias(n) for n in ["id", *names]], F.col("embedding").cast("array<double>"))
        two = two.select(*keys, "kind", F.lit(0).cast("long").alias("query_no"), "id", *names, F.col("embedding").cast("array<double>"))
        met = two.unionAll(one).repartition(*keys).sortWithinPartitions(*keys, "kind")
        return met.mapInArrow(search, schema), visits.select("query_no", "cell")

    near, first = meet(asked.select("query_no", "embedding", "cell"), "own-cells")
    near = stage(near, "own-winners")
    known = near.groupBy("query_no").agg(F.max("score").alias("known"))
    rest = asked.select("query_no", "embedding", "cell").join(known, "query_no", "left")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sorted(bounds.value)
        least, most = (np.array([bounds.value[c][i] for c in order]) for i in (0, 1))
        for batch in small_batches(batches):
            block = Block(widened(matrix_of(batch.column("embedding")), width))
            far = angles(block)
            column = np.array([c if c != ODD_CELL else 0 for c in order], dtype=np.int64)
            own = far[:, column] if far.shape[1] else np.zeros((len(block), len(order)))
            nearest = np.maximum(np.maximum(own - most, least - own), 0.0) - SLACK
            score = np.nan_to_num(batch.column("known").to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
            wanted = np.cos(np.clip(nearest, 0.0, np.pi)) >= score[:, None] - SLACK
            wanted |= (np.array(order) == ODD_CELL)[None, :] | ~block.safe[:, None]
            wanted &= np.array(order)[None, :] != batch.column("cell").to_numpy()[:, None]
            q, c = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays([batch.column("query_no").take(pa.array(q)), batch.column("embedding").take(pa.array(q)), pa.array(np.array(order, dtype=np.int32)[c], pa.int32())], names=["query_no", "embedding", "cell"])

    visits = rest.mapInArrow(visit, rest.select("query_no", "embedding", "cell").schema)
    others, more = meet(visits, "other-cells")
    carried = [c for c in queries.columns if c not in ("id", "embedding")]
    every = asked.select("query_no", F.col("id").alias("query_id"), *carried)
    return _answers(near.unionByName(others), every, names), first.unionByName(more)


def visited_share(queries: DataFrame, passages: DataFrame, budget: int = SLICE_BYTES) -> float:
    """Of all pairs of a query and a cell of passages, the share that the search of two large tables does not skip."""
    ordered, names = _with_order(passages)
    queries = queries.select("id", "embedding")
    _, visits = _best_by_cells(queries, ordered, names, budget, vector_sizes(queries), vector_sizes(passages))
    found = visits.agg(F.count(F.lit(1)).alias("visits"), F.count_distinct("query_no").alias("q"), F.count_distinct("cell").alias("c")).first()
    return found["visits"] / max(1, found["q"] * found["c"])


def similarities(queries: DataFrame, passages: DataFrame, budget: int = SLICE_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, passage_id, score) of every query with every passage; null where there is no score.

    The result has as many rows as both tables multiplied; ``best_passages`` forms no such rows. Queries of at most
    ``budget`` bytes are broadcast and nothing is shuffled. More of them are met in blocks: both tables are cut into parts
    of about ``block_rows`` rows (fewer if vectors are long), and each pair of parts is a group of its own. A row is then
    copied once for each part of the other table, which is a ``block_rows``-th of the rows that it gives.
    """
    sizes = vector_sizes(queries)
    if _bytes(sizes, queries) > budget:
        return _similarities_in_blocks(queries, passages, sizes, block_rows)
    known = queries.select("id", "embedding").toArrow()
    shared = passages.sparkSession.sparkContext.broadcast((numbers_of(known, ["id"])[0], _matrix(known)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for batch in small_batches(batches):
            passage_ids = numbers_of(batch, ["id"])[0]
            block = matrix_of(batch.column("embedding"))
            width = max(block.shape[1], matrix.shape[1])
            passages_block = Block(widened(block, width))
            step = max(1, TILE_CELLS // max(1, len(block)))
            for q0 in range(0, len(ids), step):
                part = Block(widened(matrix[q0 : q0 + step], width))
                arrays = _pair_arrays(ids[q0 : q0 + step], passage_ids, all_scores(part, passages_block))
                yield pa.RecordBatch.from_arrays(arrays, names=_PAIR_NAMES)

    return passages.select("id", "embedding").mapInArrow(score, _PAIR_SCHEMA)


def _pair_arrays(query_ids: np.ndarray, passage_ids: np.ndarray, scores: np.ndarray) -> list[pa.Array]:
    values = scores.ravel()
    ids = [pa.array(np.repeat(query_ids, len(passage_ids))), pa.array(np.tile(passage_ids, len(query_ids)))]
    return [*ids, pa.array(values, mask=np.isnan(values))]


def _similarities_in_blocks(queries: DataFrame, passages: DataFrame, sizes: tuple[int, int], block_rows: int) -> DataFrame:
    passage_sizes = vector_sizes(passages)
    width = max(sizes[1], passage_sizes[1])
    rows = max(1, min(block_rows, BATCH_BYTES // (8 * width)))
    q_parts, p_parts = (max(1, -(-n // rows)) for n in (sizes[0], passage_sizes[0]))

    def dealt(table: DataFrame, name: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        # Parts come from row numbers of a staged copy, so repeated ids are spread as well.
        numbered = stage(table.select("id", "embedding", F.monotonically_increasing_id().alias("_no")), name)
        part = F.pmod(F.xxhash64("_no"), F.lit(n_own)).alias(own)
        return numbered.select(part, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other), "id", "embedding")

    one = dealt(queries, "queries", "q_part", q_parts, "p_part", p_parts)
    two = dealt(passages, "passages", "p_part", p_parts, "q_part", q_parts)

    def score(some: pa.Table, many: pa.Table) -> pa.Table:
        blocks = [Block(widened(matrix_of(t.column("embedding").combine_chunks()), width)) for t in (some, many)]
        ids = [numbers_of(t, ["id"])[0] for t in (some, many)]
        return pa.Table.from_arrays(_pair_arrays(*ids, all_scores(*blocks)), names=_PAIR_NAMES)

    keys = ["q_part", "p_part"]
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(score, _PAIR_SCHEMA)
