import math
import time

import pytest
from pyspark.sql import functions as F

from passageloom.functions import text as T
from passageloom.operators import frequency, running, terms, weighting
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage
from passageloom.plans.corpus import dense_of_tables

PASSAGES = "passage_id string, passage string"
# log2(3 / df): red is in all three passages, fox and hen in two, owl in one.
G1 = [("1", "red fox"), ("2", "red hen red"), ("3", "fox owl hen red")]
TWO, ONE = math.log2(3 / 2), math.log2(3)


@pytest.fixture
def g1(spark):
    return spark.createDataFrame(G1, PASSAGES)


def words_of(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def as_dict(df, *keys, value):
    return {tuple(r[k] for k in keys): r[value] for r in df.collect()}


def approx(expected):
    return pytest.approx(expected, abs=1e-12, nan_ok=True)


def vectors(df):
    return {r["passage_id"]: r["vector"] for r in df.collect()}


def test_idf_and_weights_of_three_passages(g1):
    df = {("red",): 3, ("fox",): 2, ("hen",): 2, ("owl",): 1}
    assert as_dict(frequency.document_frequency(g1), "word", value="df") == df
    idf = {("red",): 0.0, ("fox",): TWO, ("hen",): TWO, ("owl",): ONE}
    assert as_dict(frequency.idf_table(g1), "word", value="idf") == approx(idf)
    assert as_dict(weighting.tfidf_sparse(g1), "passage_id", "word", value="tfidf") == approx(
        {
            ("1", "red"): 0.0, ("1", "fox"): TWO / 2, ("2", "red"): 0.0, ("2", "hen"): TWO / 3,
            ("3", "red"): 0.0, ("3", "fox"): TWO / 4, ("3", "hen"): TWO / 4, ("3", "owl"): ONE / 4,
        }
    )


def test_dense_vectors_in_vocabulary_order(spark, g1):
    expected = {"1": [TWO / 2, 0, 0], "2": [0, TWO / 3, 0], "3": [TWO / 4, TWO / 4, 0]}
    words = words_of(spark, "fox", "hen", "red")
    got = vectors(dense_of_tables(g1, words))
    assert {k: approx(v) for k, v in expected.items()} == got
    got = vectors(weighting.densify(weighting.tfidf_sparse(g1), weighting.index_vocabulary(words), g1))
    assert {k: approx(v) for k, v in expected.items()} == got


def test_word_in_no_passage(spark, g1):
    words = words_of(spark, "fox", "zebra")
    assert as_dict(frequency.document_frequency_for(g1, words), "word", value="df") == {("fox",): 2, ("zebra",): 0}
    assert as_dict(frequency.idf_table(g1, words), "word", value="idf") == approx({("fox",): TWO})
    strict = frequency.idf_table(g1, words, zero_df="ieee")
    assert as_dict(strict, "word", value="idf") == approx({("fox",): TWO, ("zebra",): math.inf})
    listed = weighting.attach_idf(weighting.index_vocabulary(words), strict)
    got = vectors(weighting.dense_tfidf(g1, listed))
    assert got == {"1": approx([TWO / 2, math.nan]), "2": approx([0.0, math.nan]), "3": approx([TWO / 4, math.nan])}
    assert vectors(dense_of_tables(g1, words))["2"] == [0.0, 0.0]


def test_passage_without_words(spark):
    passages = spark.createDataFrame([*G1, ("4", ""), ("5", " \t ")], PASSAGES)
    assert as_dict(terms.passage_lengths(passages), "passage_id", value="n_words")[("5",)] == 0
    words = words_of(spark, "fox")
    idf = frequency.idf_table(passages, words)
    assert idf.first()["idf"] == pytest.approx(math.log2(5 / 2))
    listed = weighting.attach_idf(weighting.index_vocabulary(words), idf)
    assert vectors(weighting.dense_tfidf(passages, listed))["4"] == [0.0]
    strict = vectors(weighting.dense_tfidf(passages, listed, empty="nan"))
    assert math.isnan(strict["4"][0]) and math.isnan(strict["5"][0]) and strict["2"] == [0.0]
    assert len(strict) == 5


def test_empty_corpus_and_empty_word_list(spark, g1):
    none = spark.createDataFrame([], PASSAGES)
    assert weighting.tfidf_sparse(none).count() == 0
    assert frequency.corpus_frequency(none).n_passages == 0
    assert set(map(tuple, vectors(dense_of_tables(g1, words_of(spark).where("word <> ''"))).values())) == {()}


def test_case(spark):
    passages = spark.createDataFrame([("1", "Red red")], PASSAGES)
    assert as_dict(terms.term_counts(passages), "word", value="tf") == {("red",): 2}
    assert as_dict(terms.term_counts(passages, lowercase=False), "word", value="tf") == {("Red",): 1, ("red",): 1}


def test_lower_case_and_white_space_character_by_character(spark):
    text = "İΣΑΣ ΟΔΟΣ x y　z\x0bv\x0cf\rr​q\x1cp\u0085n"
    df = spark.createDataFrame([(text,)], "passage string")
    got = df.select(T.words(F.col("passage"))).first()[0]
    assert got == ["iσασ", "οδοσ", "x", "y", "z", "v", "f", "r​q\x1cp\u0085n"]


def test_repeated_words_and_order(spark):
    passages = spark.createDataFrame([("1", "b a b c a b"), ("2", "z"), ("3", "")], PASSAGES)
    assert [(r["position"], r["word"]) for r in terms.passage_words(passages).where("passage_id = 1").collect()] == list(
        enumerate("b a b c a b".split())
    )
    assert as_dict(terms.term_counts(passages), "passage_id", "word", value="tf") == {
        ("1", "a"): 2, ("1", "b"): 3, ("1", "c"): 1, ("2", "z"): 1,
    }
    ends = terms.term_counts_with_end(passages).where("word IS NULL")
    assert as_dict(ends, "passage_id", value="n_words") == {("1",): 6, ("2",): 1, ("3",): 0}


def test_word_list_order_with_a_repeated_word(spark, g1):
    listed = spark.createDataFrame([(0, "hen"), (1, "fox"), (2, "hen"), (3, "nil")], "word_idx int, word string")
    got = vectors(weighting.dense_tfidf(g1, weighting.attach_idf(listed, frequency.idf_table(g1))))
    assert got["2"] == approx([TWO / 3, 0, TWO / 3, 0]) and got["3"] == approx([TWO / 4, TWO / 4, TWO / 4, 0])


def test_equal_ids_stay_separate_on_request(spark):
    passages = spark.createDataFrame([("1", "a b"), ("1", "a"), ("1", "a")], PASSAGES).repartition(3)
    listed = spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0)], "word_idx int, word string, idf double")
    got = weighting.dense_tfidf(passages, listed, unique_ids=False).collect()
    assert sorted(r["vector"] for r in got) == [[0.5, 1.0], [1.0, 0.0], [1.0, 0.0]]


def test_long_list_of_words_without_idf(spark, g1):
    """A vector may be long, and most of it NaN: nothing of it goes into the plan."""
    n = 100_000
    words = spark.range(n).select(F.concat(F.lit("w"), F.col("id")).alias("word")).union(words_of(spark, "fox"))
    idf = frequency.idf_table(g1, words, zero_df="ieee")
    listed = weighting.attach_idf(weighting.index_vocabulary(words), idf)
    start = time.perf_counter()
    dense = weighting.dense_tfidf(g1, listed)
    dense._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 20
    got = vectors(dense)
    assert all(len(v) == n + 1 and sum(map(math.isnan, v)) == n for v in got.values())
    assert {k: v[0] for k, v in got.items()} == approx({"1": TWO / 2, "2": 0.0, "3": TWO / 4})


def test_word_list_larger_than_a_broadcast(spark, skewed):
    """Dense vectors over the whole vocabulary do not depend on the broadcast budget."""
    passages = skewed.unionByName(spark.createDataFrame([("none", "")], PASSAGES))
    words = weighting.index_vocabulary(terms.vocabulary(passages))
    listed = weighting.attach_idf(words, frequency.idf_table(passages))
    expected = vectors(weighting.dense_tfidf(passages, listed))
    assert len(expected) == 201 and len(expected["none"]) == 208
    sparse = weighting.tfidf_sparse(passages)
    for budget in (1, 2000):
        assert vectors(weighting.dense_tfidf(passages, listed, budget=budget)) == expected
        got = vectors(weighting.densify(sparse, words, passages, budget=budget))
        assert got.keys() == expected.keys() and got["7"] == approx(expected["7"])
    strict = vectors(weighting.dense_tfidf(passages, listed, budget=1, empty="nan", unique_ids=False))
    assert math.isnan(strict["none"][0]) and strict["7"] == expected["7"]


def test_index_over_many_ranges(spark):
    words = spark.range(5000).select(F.format_string("w%05d", F.col("id") * 7919 % 5000).alias("word")).repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = weighting.index_vocabulary(words).orderBy("word_idx").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [tuple(r) for r in rows] == [(i, f"w{i:05d}") for i in range(5000)]


def test_missing_idf(spark, g1):
    table = stage(frequency.idf_table(g1), "idf")
    other = spark.createDataFrame([("9", "fox zebra")], PASSAGES)
    for budget in (1 << 20, 1):
        got = weighting.tfidf_with_table(terms.term_counts(other), table, missing_idf=1.0, budget=budget)
        assert as_dict(got, "word", value="tfidf") == approx({("fox",): TWO / 2, ("zebra",): 0.5})


def test_batches_add_up(spark, g1):
    batches = [spark.createDataFrame([row], PASSAGES) for row in G1]
    merged = frequency.merge_counts(*(frequency.document_frequency(b) for b in batches))
    assert sorted(merged.collect()) == sorted(frequency.document_frequency(g1).collect())


def test_vocabulary_larger_than_a_broadcast(spark, g1):
    words = words_of(spark, "fox", "zebra")
    for budget in (1 << 20, 1):
        small = frequency.document_frequency_for(g1, words, budget=budget)
        assert as_dict(small, "word", value="df") == {("fox",): 2, ("zebra",): 0}
        found = frequency.corpus_frequency(g1, words, budget=budget)
        assert found.n_passages == 3
        assert as_dict(found.table, "word", value="df") == {("fox",): 2, ("zebra",): 0}


@pytest.fixture(scope="module")
def skewed(spark):
    """One word is in every passage and makes up more than a third of all rows."""
    rows = [(str(i), " ".join(["the"] * 5 + [f"w{i % 7}", f"rare{i}"])) for i in range(200)]
    return spark.createDataFrame(rows, PASSAGES)


@pytest.mark.parametrize("budget", [1, 200, 1000, 5000])
def test_weights_do_not_depend_on_the_broadcast_budget(spark, skewed, budget):
    expected = as_dict(weighting.tfidf_sparse(skewed), "passage_id", "word", value="tfidf")
    got = weighting.tfidf_sparse(skewed, budget=budget)
    assert got.count() == len(expected) == 600
    assert as_dict(got, "passage_id", "word", value="tfidf") == expected


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("budget", [1, 150, 400, 1 << 20])
def test_lookup_join_equals_a_plain_join(spark, how, budget):
    facts = spark.createDataFrame(
        [("hot", i) for i in range(100)] + [("absent", i) for i in range(50)] + [(None, 7), (None, 8), ("b", 1), ("c", 2)],
        "k string, n int",
    )
    table = stage(spark.createDataFrame([("hot", 1.0, [1]), ("b", 2.0, None), ("unused", 3.0, [])], "k string, v double, a array<int>"), "t")
    expected = facts.join(table, "k", how).select("k", "n", "v", "a").collect()
    got = lookup_join(facts, table, "k", how, budget=budget).select("k", "n", "v", "a").collect()
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_frequent_rows_stay_out_of_the_shuffle(spark, skewed):
    """Beyond the budget only the hot words are broadcast, and the words are still taken apart once."""
    found = frequency.corpus_frequency(skewed)
    counts = found.table.select("word", F.col("df").alias("n"))
    plan = lookup_join(
        terms.term_counts(skewed), stage(frequency.idf_of(found), "idf"), "word", counts=counts, budget=1000
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Generate") == 1 and "strategy=broadcast" in plan and "_salt" in plan


def test_sparse_equals_the_non_zeros_of_dense(spark, skewed):
    words = terms.vocabulary(skewed)
    listed = stage(weighting.index_vocabulary(words), "list")
    names = {r["word_idx"]: r["word"] for r in listed.collect()}
    dense = vectors(dense_of_tables(skewed, words))
    non_zero = {(p, names[i]): w for p, v in dense.items() for i, w in enumerate(v) if w}
    sparse = as_dict(weighting.tfidf_sparse(skewed), "passage_id", "word", value="tfidf")
    assert {k: v for k, v in sparse.items() if v} == approx(non_zero)


def test_counts_add_up_to_the_length(spark, skewed):
    sums = terms.term_counts(skewed).groupBy("passage_id").agg(F.sum("tf").alias("n_words"))
    assert sorted(sums.collect()) == sorted(terms.passage_lengths(skewed).collect())
    assert frequency.document_frequency(skewed).where("df > 200").count() == 0


def test_answers_do_not_depend_on_partitions(spark, skewed):
    expected = sorted(weighting.tfidf_sparse(skewed.coalesce(1)).collect())
    assert sorted(weighting.tfidf_sparse(skewed.repartition(7)).collect()) == expected


def test_texts_are_taken_apart_once(spark, skewed):
    plan = weighting.tfidf_sparse(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "term-counts" in plan


def test_running_document_frequency(spark, tmp_path):
    folder = str(tmp_path / "state")
    one = spark.createDataFrame([("1", "a b a"), ("2", "b c")], "passage_id string, passage string")
    two = spark.createDataFrame([("1", "c d"), ("3", "")], "passage_id string, passage string")
    assert running.running_frequency(spark, folder).table.count() == 0
    assert [running.add_batch(spark, folder, n, b, buckets=4) for n, b in (("x", one), ("y", two), ("y", two), ("x", two), ("z", two.limit(0)))] == [True, True, False, False, True]
    found = running.running_frequency(spark, folder, buckets=4)
    assert {r.word: r.df for r in found.table.collect()} == {"a": 1, "b": 2, "c": 2, "d": 1} and found.n_passages == 4
    # A version without its marker, as a job that died leaves it, is not read and not reused.
    (tmp_path / "state" / "v4" / "df").mkdir(parents=True)
    assert running.running_frequency(spark, folder, buckets=4).n_passages == 4
    assert running.add_batch(spark, folder, "w", one, buckets=4) and running.running_frequency(spark, folder, buckets=4).n_passages == 6
    assert {r.batch: r.n_passages for r in running.batches(spark, folder).collect()} == {"x": 2, "y": 2, "z": 0, "w": 2}


def test_text_of_dense_vectors(spark, g1):
    """The text for the sinks equals the rendered numbers, whatever stands in the vectors, and ids ascend."""
    passages = g1.unionByName(spark.createDataFrame([("10", "none of these"), ("11", " ")], PASSAGES)).repartition(3)
    lists = ([("fox", 0.5), ("unseen", float("inf")), ("red", 1e-7), ("void", None)], [("fox", 0.5)], [("zebra", 1.0)], [])
    for listed in lists:
        table = spark.createDataFrame([(i, *row) for i, row in enumerate(listed)], "word_idx int, word string, idf double")
        for empty in ("zero", "nan"):
            rows = weighting.dense_tfidf(passages, stage(table, "list"), empty=empty)
            expected = sorted(map(tuple, rows.select("passage_id", F.array_join(F.transform("vector", lambda x: x.cast("string")), ";")).collect()))
            got = weighting.dense_tfidf(passages, stage(table, "list"), empty=empty, ordered=True, text=";").collect()
            assert [tuple(r) for r in got] == expected


def test_staged_hits_give_the_same_text_for_each_use(spark, g1):
    """The texts are taken apart for the short arrays only, whichever way the list is attached."""
    listed = stage(spark.createDataFrame([(0, "fox", 0.5), (1, "unseen", 2.0), (2, "red", 1e-7)], "word_idx int, word string, idf double"), "list")
    for budget in (1, 1 << 20):
        expected = sorted(map(tuple, weighting.dense_tfidf(g1, listed, budget=budget, text=",").collect()))
        rows = weighting.dense_tfidf(g1, listed, budget=budget, text=",", staged=True)
        assert sorted(map(tuple, rows.collect())) == expected == sorted(map(tuple, rows.collect()))
        assert "split(" not in rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("budget", [1, 150, 400, 1 << 20])
def test_stored_facts_are_split_by_key(spark, how, budget):
    facts = stage(spark.createDataFrame(
        [("hot", i) for i in range(100)] + [("absent", i) for i in range(50)] + [(None, 7), (None, 8), ("b", 1), ("c", 2)],
        "k string, n int",
    ), "facts")
    table = stage(spark.createDataFrame([("hot", 1.0, [1]), ("b", 2.0, None), ("unused", 3.0, [])], "k string, v double, a array<int>"), "t")
    expected = facts.join(table, "k", how).select("k", "n", "v", "a").collect()
    joined = lookup_join(facts, table, "k", how, budget=budget, stored=True)
    assert sorted(joined.select("k", "n", "v", "a").collect(), key=repr) == sorted(expected, key=repr)


def test_frequent_words_of_stored_counts_are_not_shuffled(spark, skewed):
    plan = weighting.tfidf_sparse(skewed, budget=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "_salt" not in plan


def test_runs_of_words_are_found_in_one_pass(spark):
    passages = spark.createDataFrame([("1", "b a b"), ("2", ""), ("3", "c")], PASSAGES)
    counted = terms.with_term_counts(passages)
    assert {r.passage_id: [tuple(t) for t in r.terms] for r in counted.collect()} == {"1": [("a", 1), ("b", 2)], "2": [], "3": [("c", 1)]}
    assert "array_distinct" not in counted._jdf.queryExecution().optimizedPlan().toString()
