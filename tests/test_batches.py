"""Batches of dense lines: once, whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from passageloom.sinks.batches import add_dense_batch, batches_of
from passageloom.sources.files import read_lines

VECTORS = "passage_id string, vector array<double>"


def words_of(spark, *words):
    return spark.createDataFrame(list(enumerate(words)), "word_idx int, word string")


def seen(spark, folder):
    return sorted(r["value"] for r in read_lines(spark, f"{folder}/*").collect())


def test_a_batch_counts_once(spark, tmp_path):
    folder, words = str(tmp_path / "out"), words_of(spark, "b", "a")
    assert batches_of(spark, folder) == []
    one = spark.createDataFrame([("2", [0.5, 0.0]), ("10", [0.25, 1e-7])], VECTORS)
    two = spark.createDataFrame([("3", [1.0, 2.0])], VECTORS)
    assert add_dense_batch(one, words, folder, "one") and add_dense_batch(two, words, folder, "two")
    assert not add_dense_batch(one, words, folder, "one") and not add_dense_batch(two, words, folder, "two")
    assert batches_of(spark, folder) == ["one", "two"]
    assert seen(spark, folder) == ["10,0.25,1.0E-7", "2,0.5,0.0", "3,1.0,2.0", "passageId,b,a"]
    files = sorted(f for f in os.listdir(f"{folder}/lines-one") if f.startswith("part-"))
    assert [line for f in files for line in open(f"{folder}/lines-one/{f}")] == ["10,0.25,1.0E-7\n", "2,0.5,0.0\n"]


def test_a_failed_batch_leaves_nothing_and_can_come_again(spark, tmp_path):
    folder, words = str(tmp_path / "out"), words_of(spark, "a")
    rows = spark.range(200).select(F.col("id").cast("string").alias("passage_id"), F.array(F.col("id").cast("double")).alias("vector"))
    add_dense_batch(rows, words, folder, "good")
    broken = rows.withColumn("vector", F.when(F.col("passage_id") == "77", F.raise_error(F.lit("broken")).cast("array<double>")).otherwise(F.col("vector")))
    with pytest.raises(Exception, match="broken"):
        add_dense_batch(broken, words, folder, "late")
    assert sorted(n for n in os.listdir(folder) if not n.startswith(".")) == ["header", "lines-good"]
    assert len(seen(spark, folder)) == 201
    assert add_dense_batch(rows, words, folder, "late") and len(seen(spark, folder)) == 401


def test_refused_and_odd_batches(spark, tmp_path):
    folder, words = str(tmp_path / "out"), words_of(spark, "a")
    empty = spark.createDataFrame([], VECTORS)
    assert add_dense_batch(empty, words, folder, "none") and not add_dense_batch(empty, words, folder, "none")
    assert seen(spark, folder) == ["passageId,a"]
    extra = spark.createDataFrame([("1", [3.0], "x", 9)], VECTORS + ", line string, word int")
    assert add_dense_batch(extra, words, folder, "extra") and seen(spark, folder) == ["1,3.0", "passageId,a"]
    with pytest.raises(ValueError, match="word list"):
        add_dense_batch(extra, words_of(spark, "b"), folder, "other")
    for name in ("", "a/b", "a=b", "a b", "*"):
        with pytest.raises(ValueError, match="name"):
            add_dense_batch(extra, words, folder, name)


def test_compressed_batches(spark, tmp_path):
    folder, words = str(tmp_path / "out"), words_of(spark, "b", "a")
    one = spark.createDataFrame([("2", [0.5, 0.0]), ("10", [0.25, 1e-7])], VECTORS)
    two = spark.createDataFrame([("3", [1.0, 2.0])], VECTORS)
    assert add_dense_batch(one, words, folder, "one", compression="lz4") and not add_dense_batch(one, words, folder, "one", compression="lz4")
    assert add_dense_batch(two, words, folder, "two")
    assert seen(spark, folder) == ["10,0.25,1.0E-7", "2,0.5,0.0", "3,1.0,2.0", "passageId,b,a"]
    with pytest.raises(ValueError, match="word list"):
        add_dense_batch(two, words_of(spark, "b"), folder, "other", compression="lz4")
