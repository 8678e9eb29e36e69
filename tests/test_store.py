"""The clustered store of passages, and what a lookup reads of it."""

import random

import pytest

from passageloom.operators.staging import new_folder
from passageloom.sources import store as S

SCHEMA = "passage_id string, passage string"


def rows_read(df):
    """Rows that the scan hands on, after row groups and pages are picked; and the answer."""
    got = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return got, leaves.head().metrics().get("numOutputRows").get().value()


def key_table(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "passage_id string")


@pytest.fixture(scope="module")
def filled(spark):
    """20,000 passages in some eight files of several row groups each."""
    random.seed(5)
    rows = [(f"{i * 2:06d}", "".join(random.choices("abcdefgh ", k=200))) for i in range(20000)]
    random.shuffle(rows)
    folder = new_folder(spark, "store-test")
    S.write_store(spark.createDataFrame(rows, SCHEMA), folder, file_bytes=600_000, row_group_bytes=100_000)
    return folder, dict(rows)


def test_files_hold_ranges_of_ids(spark, filled):
    folder, expected = filled
    parts = sorted(S.store_parts(spark, folder).collect(), key=lambda r: r["least"])
    assert len(parts) >= 6 and sum(r["n_rows"] for r in parts) == len(expected)
    assert all(a["most"] < b["least"] for a, b in zip(parts, parts[1:]))


def test_one_id_reads_a_part_of_one_file(spark, filled):
    folder, expected = filled
    for key in ("000000", "020000", "039998"):
        found = S.stored_passage(spark, folder, key)
        assert len(found.inputFiles()) == 1
        got, read = rows_read(found)
        assert [tuple(r) for r in got] == [(key, expected[key])]
        assert read <= 1500  # of 20,000
    # Between two ids of a row group: no filter holds it, so nothing is read.
    for key in ("000001", "999999", "", "020000x"):
        assert S.stored_passage(spark, folder, key).collect() == []


def test_many_ids_read_their_files_only(spark, filled):
    folder, expected = filled
    few = key_table(spark, ["000010", "000010", "000012", "000013", None, "zzz"])
    assert len(S.parts_of_keys(spark, folder, few)) == 1
    for budget in (1 << 20, 1):
        assert sorted(map(tuple, S.stored_passages(spark, folder, few, budget).collect())) == [(k, expected[k]) for k in ("000010", "000012")]
    every = sorted(random.Random(1).sample(sorted(expected), 3000))
    got = S.stored_passages(spark, folder, key_table(spark, every + ["nothing"]))
    assert sorted(map(tuple, got.collect())) == [(k, expected[k]) for k in every]
    assert S.stored_passages(spark, folder, key_table(spark, [])).collect() == []


def test_odd_ids(spark):
    """Null and empty ids, ids longer than an edge of the list, characters beyond the basic plane, null texts."""
    long = "k" * 200
    rows = [(None, "no id"), ("", "empty"), (long + "a", "long a"), (long + "b", "long b"), (long, "long"), ("\U0001f600", "face"), ("￿", "last"), ("é", None)]
    rows += [(f"n{i:03d}", "text " * 20) for i in range(300)]
    folder = new_folder(spark, "store-odd")
    S.write_store(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, file_bytes=2000, row_group_bytes=1000)
    assert S.store_parts(spark, folder).count() > 5
    for key, text in rows[1:8]:
        assert [r["passage"] for r in S.stored_passage(spark, folder, key).collect()] == [text]
    got = S.stored_passages(spark, folder, key_table(spark, [r[0] for r in rows]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows[1:], key=repr)


def test_an_id_with_a_third_of_all_rows_spans_files(spark):
    rows = [("hot", f"copy {i}") for i in range(3000)] + [(f"{i}", "cold") for i in range(6000)]
    folder = new_folder(spark, "store-hot")
    S.write_store(spark.createDataFrame(rows, SCHEMA), folder, file_bytes=20_000, row_group_bytes=10_000)
    parts = S.store_parts(spark, folder).collect()
    assert max(r["n_rows"] for r in parts) < 3000
    found = S.stored_passage(spark, folder, "hot")
    assert 1 < len(found.inputFiles()) < len(parts)
    assert sorted(r["passage"] for r in found.collect()) == sorted(f"copy {i}" for i in range(3000))
    assert S.stored_passages(spark, folder, key_table(spark, ["hot", "7"])).count() == 3001


def test_empty_table_other_columns_and_a_second_write(spark):
    folder = new_folder(spark, "store-empty")
    S.write_store(spark.createDataFrame([], SCHEMA), folder)
    assert S.stored_passage(spark, folder, "1").collect() == []
    assert S.stored_passages(spark, folder, key_table(spark, ["1"])).collect() == []
    folder = new_folder(spark, "store-clash")
    clash = spark.createDataFrame([("1", "a", 5, 6, "x")], SCHEMA + ", part int, _row int, least string")
    S.write_store(clash, folder)
    assert [tuple(r) for r in S.stored_passage(spark, folder, "1").collect()] == [("1", "a")]
    with pytest.raises(Exception, match="already exists"):
        S.write_store(clash, folder)


def test_unique_ids_need_no_staged_copy(spark):
    rows = [(f"{i:04d}", f"text {i}") for i in range(3000)] + [(None, "no id"), ("twice", "a"), ("twice", "b")]
    found = []
    for unique in (True, False):
        folder = new_folder(spark, "store-unique")
        S.write_store(spark.createDataFrame(rows, SCHEMA), folder, file_bytes=10_000, row_group_bytes=5_000, unique_ids=unique)
        assert S.store_parts(spark, folder).count() > 3
        keys = key_table(spark, ["0000", "2999", "twice", "none"])
        found.append(sorted(map(tuple, S.stored_passages(spark, folder, keys).collect())))
    assert found[0] == found[1] == [("0000", "text 0"), ("2999", "text 2999"), ("twice", "a"), ("twice", "b")]
