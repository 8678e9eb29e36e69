import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from passageloom.functions import vectors as V
from passageloom.operators import retrieval
from passageloom.operators.requests import answer_requests
from passageloom.operators.retrieval import best_passages, similarities
from passageloom.operators.vector_blocks import Block, best_of

SCHEMA = "id bigint, embedding array<double>"
G6 = [(1, [0.0, 1.0]), (2, [2.0, 0.0]), (5, [1.0]), (3, [5.0, 0.0]), (4, [0.0, 0.0])]


def with_position(spark, rows):
    return spark.createDataFrame(
        [(i, v, (n,)) for n, (i, v) in enumerate(rows)], SCHEMA + ", pos struct<row: bigint>"
    )


def answers(df):
    return sorted((r["query_id"], r["passage_id"]) for r in df.collect())


def cosine(a, b):
    """Left to right over the shorter vector, as the definition says."""
    # Not sum(), which corrects its rounding errors.
    def total(values):
        result = 0.0
        for value in values:
            result += value
        return result

    dot = total(x * y for x, y in zip(a, b))
    na = math.sqrt(total(x * x for x in a))
    nb = math.sqrt(total(x * x for x in b))
    return math.nan if na * nb == 0 else dot / (na * nb)


def brute_force(queries, passages):
    """(query id, passage id, score) by the definition; rows in input order, ties to the last."""
    out = []
    for qid, q in queries:
        best = None
        for pid, p in passages:
            score = cosine(q, p)
            if not math.isnan(score) and (best is None or score >= best[1]):
                best = (pid, score)
        out.append((qid, *(best or (None, None))))
    return out


def test_last_of_equal_scores_wins_and_undefined_scores_are_dropped(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 0.0])], SCHEMA)
    assert answers(best_passages(queries, with_position(spark, G6))) == [(7, 3), (8, None)]


def test_without_position_the_larger_id_wins(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0])], SCHEMA)
    passages = spark.createDataFrame(G6, SCHEMA)
    assert answers(best_passages(queries, passages)) == [(7, 5)]


def test_ties_do_not_depend_on_partitions(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0])], SCHEMA)
    passages = with_position(spark, G6)
    for parts in (1, 2, 5, 9):
        assert answers(best_passages(queries, passages.repartition(parts))) == [(7, 3)]


def test_no_passages(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0])], SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert answers(best_passages(queries, none)) == [(7, None)]
    assert answers(best_passages(none, queries)) == []


def test_repeated_query_ids_are_answered_row_by_row(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [1.0, 0.0])], SCHEMA)
    assert answers(best_passages(queries, with_position(spark, G6))) == [(7, 1), (7, 3), (7, 3)]


@pytest.mark.parametrize("shape", ["few queries", "few passages", "both in blocks"])
def test_every_strategy_equals_the_definition(spark, shape):
    rng = np.random.default_rng(5)
    # Small whole numbers: many exact ties, equal vectors, multiples, zero vectors, and ragged lengths.
    def rows(n, base):
        return [(base + i, [float(x) for x in rng.integers(-2, 3, rng.integers(1, 5))]) for i in range(n)]

    queries, passages = (rows(6, 0), rows(300, 1000)) if shape == "few queries" else (rows(300, 0), rows(40, 1000))
    got = best_passages(
        spark.createDataFrame(queries, SCHEMA).repartition(3),
        with_position(spark, passages).repartition(4),
        budget=retrieval.SLICE_BYTES if shape != "both in blocks" else 8 * 4 * 20,
    )
    expected = sorted(brute_force(queries, passages))
    assert sorted((r["query_id"], r["passage_id"], r["score"]) for r in got.collect()) == expected


@pytest.mark.parametrize("dimensions", [3, 64, 301])
def test_scores_equal_the_column_expression_bit_for_bit(spark, dimensions):
    rng = np.random.default_rng(dimensions)
    queries = [(i, rng.normal(size=dimensions).tolist()) for i in range(5)]
    passages = [(100 + i, rng.normal(size=dimensions).tolist()) for i in range(200)]
    passages += [(400 + i, v) for i, (_, v) in enumerate(passages)]
    got = best_passages(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(passages, SCHEMA).repartition(3))
    vectors = {**dict(queries), **dict(passages)}
    rows = got.collect()
    assert sorted((r["query_id"], r["passage_id"], r["score"]) for r in rows) == sorted(brute_force(queries, passages))
    pairs = spark.createDataFrame(
        [(r["score"], vectors[r["query_id"]], vectors[r["passage_id"]]) for r in rows],
        "score double, a array<double>, b array<double>",
    )
    for r in pairs.select("score", V.cosine(F.col("a"), F.col("b")).alias("column")).collect():
        assert r["score"] == r["column"]


def test_a_third_of_the_passages_are_copies_of_the_best():
    rng = np.random.default_rng(1)
    passages = rng.normal(size=(3000, 16))
    passages[::3] = passages[0]
    queries = np.concatenate([passages[:1] * 3.0, rng.normal(size=(50, 16))])
    best, score = best_of(Block(queries), Block(passages))
    assert best[0] == 2997
    for q in range(0, 51, 10):
        expected = [cosine(queries[q], p) for p in passages]
        assert score[q] == max(expected)
        assert best[q] == max(i for i, s in enumerate(expected) if s == score[q])


def test_extreme_norms_are_scored_directly(spark):
    queries = [(1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [float("inf"), 1.0])]
    passages = [(10, [1e200, 1e200]), (11, [-1.0, -1.0]), (12, [1e-200, 0.0]), (13, [float("nan"), 1.0])]
    got = best_passages(spark.createDataFrame(queries, SCHEMA), with_position(spark, passages))
    assert sorted((r[0], r[1], r[2]) for r in got.collect()) == sorted(brute_force(queries, passages))


def test_null_and_empty_vectors_have_no_score(spark):
    queries = spark.createDataFrame([(1, None), (2, []), (3, [1.0])], SCHEMA)
    passages = spark.createDataFrame([(10, None), (11, []), (12, [2.0, 1.0])], SCHEMA)
    for few in (queries, queries.where("id <> 2")):
        got = dict(answers(best_passages(few, passages)))
        assert got == {r["id"]: (12 if r["id"] == 3 else None) for r in few.collect()}
    scores = similarities(queries, passages).where("score IS NOT NULL").collect()
    assert [(r["query_id"], r["passage_id"]) for r in scores] == [(3, 12)]


def test_winner_with_its_embedding(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 0.0])], SCHEMA)
    for parts in (1, 3):
        got = best_passages(queries, with_position(spark, G6).repartition(parts), with_embedding=True)
        assert {r["query_id"]: r["embedding"] for r in got.collect()} == {7: [5.0, 0.0], 8: None}
    many = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(9)], SCHEMA)
    got = best_passages(many, with_position(spark, G6), with_embedding=True)
    assert [r["embedding"] for r in got.collect()] == [[5.0, 0.0]] * 9


def test_similarities_are_all_pairs(spark):
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, [1.0, 1.0])], SCHEMA)
    rows = similarities(queries, spark.createDataFrame(G6, SCHEMA).repartition(2)).collect()
    got = {(r["query_id"], r["passage_id"]): r["score"] for r in rows}
    assert len(rows) == 10 and got[7, 4] is None and got[7, 1] == 0.0 and got[7, 5] == 1.0
    assert got[8, 2] == cosine([1.0, 1.0], [2.0, 0.0])


def test_requested_ids(spark):
    queries = with_position(spark, [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (9, [0.0, 0.0])])
    requests = spark.createDataFrame(
        [("7",), ("99",), ("abc",), ("7 x",), (" 7",), ("7 ",), ("-1",), ("9",), ("",), (None,), ("7\n",), ("99999999999999999999",)],
        "request string",
    )
    for budget in (1 << 20, 200, 0):
        got = answer_requests(requests, queries, with_position(spark, G6), budget=budget)
        assert {r["request"]: (r["status"], r["passage_id"]) for r in got.collect()} == {
            "7": ("ok", 3), "99": ("not_found", None), "abc": ("invalid", None), "7 x": ("invalid", None),
            " 7": ("ok", 3), "7 ": ("invalid", None), "-1": ("not_found", None), "9": ("ok", None),
            "": ("invalid", None), None: ("invalid", None), "7\n": ("invalid", None),
            "99999999999999999999": ("not_found", None),
        }


def test_cosine_columns(spark):
    rows = [([1.0, 2.0], [3.0]), ([], [1.0]), ([0.0], [1.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    got = df.select(V.dot_product(a, b), V.norm(a), V.cosine(a, b), V.cosine_or_zero_if_empty(a, b)).collect()
    assert tuple(got[0]) == (3.0, math.sqrt(5), cosine(*rows[0]), cosine(*rows[0]))
    assert tuple(got[1]) == (0.0, 0.0, None, 0.0)
    assert tuple(got[2]) == (0.0, 0.0, None, None)


@pytest.mark.parametrize("budget", [retrieval.SLICE_BYTES, 8 * 2 * 3])
@pytest.mark.parametrize("repeats", [1, 9])
def test_winners_keep_their_own_vector(spark, budget, repeats):
    """A winner shorter than the others comes back as it is, whichever way it was found."""
    queries = spark.createDataFrame([(7 + i, [1.0, 0.0]) for i in range(repeats)], SCHEMA)
    passages = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0]), (3, [0.0, 2.0]), (4, [-1.0, 0.0])], SCHEMA)
    got = best_passages(queries, passages, with_embedding=True, budget=budget).collect()
    assert [(r["passage_id"], r["embedding"]) for r in got] == [(2, [1.0])] * repeats
    with pytest.raises(ValueError, match="1 to 2 numbers"):
        best_passages(queries, passages, equal_lengths=True)


def test_cells_are_skipped_without_changing_answers(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(8, 24))
    passages = [(1000 + i, (centres[i % 8] + 0.05 * rng.normal(size=24)).tolist()) for i in range(900)]
    passages += [(3000 + i, passages[0][1]) for i in range(300)]  # a hot vector, in one cell
    passages += [(4000, [0.0] * 24), (4001, [1e-200] * 24), (4002, [1.0, 2.0])]
    queries = [(i, (centres[i % 8] + 0.05 * rng.normal(size=24)).tolist()) for i in range(300)]
    queries += [(500, [0.0] * 24), (501, [1e-200] * 24), (502, [3.0])]
    asked, stored = spark.createDataFrame(queries, SCHEMA).repartition(3), spark.createDataFrame(passages, SCHEMA).repartition(4)
    budget = 8 * 24 * 100
    got = best_passages(asked, stored, budget=budget).collect()
    # The scores of the tiny vectors overflow in the plain definition as well; ids and scores have to agree.
    expected = brute_force(queries, passages)
    assert sorted((r["query_id"], r["passage_id"], r["score"]) for r in got) == sorted(expected)
    assert retrieval.visited_share(asked, stored, budget) < 0.5


def test_all_pairs_in_blocks_equal_those_of_a_broadcast(spark):
    """Repeated ids, null, empty and zero vectors, lengths that differ; both sides cut into several parts."""
    import random

    random.seed(3)

    def rows(n):
        vectors = [[random.uniform(-1, 1) for _ in range(random.choice((2, 3, 5)))] for _ in range(n)]
        return [(i % 20, v) for i, v in enumerate(vectors)] + [(50, None), (51, []), (52, [0.0, 0.0]), (53, [float("nan")])]

    schema = "id bigint, embedding array<double>"
    queries, passages = (spark.createDataFrame(rows(n), schema) for n in (60, 90))

    def got(**options):
        return sorted((tuple(r) for r in similarities(queries, passages, **options).collect()), key=repr)

    expected = got()
    assert len(expected) == 64 * 94
    for block_rows in (7, 1000):
        assert got(budget=1, block_rows=block_rows) == expected
    nothing = spark.createDataFrame([], schema)
    assert similarities(queries, nothing, budget=1).count() == 0 == similarities(nothing, passages, budget=-1).count()


@pytest.mark.parametrize("partitions, chunk_queries, fan", [(40, 3, 2), (7, 50, 2), (8, 1000, 16)])
def test_winners_are_merged_in_rounds(spark, partitions, chunk_queries, fan):
    """Chunks that no task answers, chunks cut short, ties that are decided in a merge; a hot vector in every task."""
    rng = np.random.default_rng(8)
    queries = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(20)] + [(100 + i, [0.0]) for i in range(7)]
    passages = [(1000 + i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(200)] + [(5000, [1.0, 1.0, 1.0])] * 100
    asked = spark.createDataFrame([(i, v, (n,)) for n, (i, v) in enumerate(queries)], SCHEMA + ", pos struct<row: bigint>")
    ordered, names = retrieval._with_order(with_position(spark, passages).repartition(11))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = retrieval._best_by_query_slice(asked, ordered, names, chunk_queries, fan).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["query_id"], r["passage_id"], r["score"]) for r in got) == sorted(brute_force(queries, passages))
    assert sorted((r["query_id"], r["pos"]["row"]) for r in got) == [(i, n) for n, (i, _) in enumerate(queries)]


def test_no_more_rows_are_shuffled_for_more_queries(spark):
    """Each task hands on one row for a chunk of queries, whatever their number."""
    passages = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(64)], SCHEMA).repartition(4)
    for n in (3, 300):
        queries = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(n)], SCHEMA)
        got = retrieval._best_by_query_slice(queries, *retrieval._with_order(passages))
        assert got.count() == n
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and "Aggregate" not in plan


@pytest.mark.parametrize("kind", ["double", "float"])
@pytest.mark.parametrize("few", ["queries", "passages"])
def test_single_precision_never_decides(spark, kind, few):
    """Scores that agree in single precision, and some in double as well: answers are those of the definition."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(4, 48))
    close = [(base[i % 4] * (1 + 1e-9 * rng.normal(size=48))).astype("f4" if kind == "float" else "f8") for i in range(240)]
    passages = [(1000 + i, [float(x) for x in v]) for i, v in enumerate(close)]
    passages += [(2000 + i, v) for i, (_, v) in enumerate(passages[:30])]
    queries = [(i, [float(x) for x in v.astype("f4" if kind == "float" else "f8")]) for i, v in enumerate([*base, *rng.normal(size=(6, 48))])]
    if few == "passages":
        queries = [(i + 10 * n, v) for n in range(40) for i, v in queries]
    schema = f"id bigint, embedding array<{kind}>"
    got = best_passages(spark.createDataFrame(queries, schema).repartition(2), spark.createDataFrame(passages, schema).repartition(3))
    assert sorted((r["query_id"], r["passage_id"], r["score"]) for r in got.collect()) == sorted(brute_force(queries, passages))


def test_the_error_of_a_single_precision_product_is_below_the_slack():
    rng = np.random.default_rng(6)
    for width in (1, 2, 33, 700, 4097):
        for scale in (1.0, 1e-30, 1e30):
            one, two = (Block(rng.normal(size=(40, width)) * scale * 10.0 ** rng.uniform(-6, 6, width)) for _ in range(2))
            off = np.abs(one.single @ two.single.T - one.unit @ two.unit.T).max()
            assert 2 * off <= 2.0 * (width + 8) * np.finfo(np.float32).eps


def test_vectors_of_floats_take_half_the_memory(spark):
    floats = spark.createDataFrame([(1, [1.0, 0.1])], "id bigint, embedding array<float>")
    assert retrieval._bytes((10, 3), floats) * 2 == retrieval._bytes((10, 3), floats.select(F.col("embedding").cast("array<double>")))
    assert retrieval._matrix(floats.toArrow()).dtype == np.float32
    assert retrieval._matrix(spark.createDataFrame([(1, [1.0, None]), (2, None)], "id bigint, embedding array<float>").toArrow()).dtype == np.float32
