import glob
import math
import os

import pytest

from passageloom.operators import staging, terms
from passageloom.operators.staging import stage
from passageloom.plans import catalogue, corpus, search
from passageloom.sinks import files as sinks
from passageloom.sources.files import read_lines, with_place
from passageloom.sources import embeddings as E
from passageloom.sources import passages as P
from passageloom.sources import vocabulary as V
from passageloom.streaming.passages import read_passage_stream, weigh_passage_stream
from passageloom.streaming.requests import answer_request_stream

PASSAGES = "passage_id string, passage string"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def lines_of(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            out += open(f"{folder}/{name}", encoding="utf-8", newline="\n").read().split("\n")[:-1]
    return out


def passages_of(df):
    return {r["passage_id"]: r["passage"] for r in df.collect()}


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "in/a.csv", "id,passage\n1,x, y\n1,z\n\n2,b,c\r\nnocomma\n")
    write(tmp_path / "in/b.csv", "id,passage\n1,other\n3,d\n")
    return str(tmp_path / "in")


def test_passage_lines(spark, folder):
    got = passages_of(P.read_passages(spark, folder))
    assert got == {"1": "z", "": "", "2": "b c\r", "nocomma": "", "3": "d"}
    got = passages_of(P.read_passages(spark, folder, header=False))
    assert got == {"id": "passage", "1": "z", "": "", "2": "b c\r", "nocomma": "", "3": "d"}
    assert "" not in passages_of(P.read_passages(spark, folder, header=False, keep_blank=False))
    assert P.read_passages(spark, folder, unique=False).count() == 7
    words = terms.passage_words(P.read_passages(spark, folder)).where("passage_id = '2'")
    assert [r["word"] for r in words.collect()] == ["b", "c"]


def test_header_skip_loses_nothing_else(spark, tmp_path):
    """Blank lines, odd characters and long files in many splits; only the first line of each file goes."""
    odd = ["1,left\uffffright", "", "2,nul\x00inside", '3,"quoted, not', "#4,comment", " ", "5,last"]
    for name in "abc":
        write(tmp_path / f"in/{name}.csv", "id,passage\n" + "\n".join([*odd, *(f"{name}{i},text {i}" for i in range(2000))]) + "\n")
    write(tmp_path / "in/d.csv", "only a header\n")
    write(tmp_path / "in/e.csv", "")
    expected = sorted(3 * odd + [f"{name}{i},text {i}" for name in "abc" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = read_lines(spark, str(tmp_path / "in"), header=True)
            assert sorted(r["value"] for r in lines.collect()) == expected
        assert lines.rdd.getNumPartitions() < 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_file_and_one_passage(spark, folder):
    assert passages_of(P.read_passages(spark, f"{folder}/b.csv")) == {"1": "other", "3": "d"}
    assert corpus.show_passage(spark, f"{folder}/a.csv", "1").first()["passage"] == "z"
    assert corpus.show_passage(spark, folder, "none").count() == 0
    assert sorted(r[0] for r in P.passage_texts(P.read_passages(spark, f"{folder}/b.csv")).collect()) == ["d", "other"]


def test_last_line_wins_in_a_file_of_many_splits(spark, tmp_path):
    path = write(tmp_path / "big/a.csv", "".join(f"{i % 50},text {i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = P.read_passages(spark, path, header=False, unique=False)
        assert rows.rdd.getNumPartitions() > 20
        got = passages_of(P.read_passages(spark, path, header=False))
        skipped = P.read_passages(spark, path, header=True, unique=False)
        assert skipped.count() == 19999 and skipped.where("passage = 'text 0'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f"text {19950 + i}" for i in range(50)}


def test_key_with_very_many_copies(spark, tmp_path):
    path = write(tmp_path / "hot/a.csv", "".join(f"{'hot' if i % 3 else i},{i}\n" for i in range(3000)))
    got = passages_of(P.read_passages(spark, path, header=False))
    assert len(got) == 1001 and got["hot"] == "2999"


def test_passages_of_keys(spark):
    passages = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], PASSAGES)
    keys = spark.createDataFrame([("3",), ("1",), ("3",), ("8",)], "passage_id string")
    for budget in (1 << 20, 1):
        assert passages_of(P.lookup_passages(passages, keys, budget)) == {"1": "a", "3": "c"}


def test_vocabulary_file(spark, tmp_path, folder):
    out = str(tmp_path / "vocabulary")
    got = corpus.build_vocabulary(spark, folder, out)
    assert lines_of(out) == ["b", "c", "d", "z"]
    assert sorted(r[0] for r in got.collect()) == ["b", "c", "d", "z"]


def test_word_lists_keep_file_order(spark, tmp_path):
    path = write(tmp_path / "words.txt", "pear\napple\nfig\napple\n")
    rows = V.read_word_list(spark, path).orderBy("word_idx").collect()
    assert [tuple(r) for r in rows] == [(0, "pear"), (1, "apple"), (2, "fig"), (3, "apple")]
    path = write(tmp_path / "spaced.txt", "pear  Apple\n\n fig\tkiwi\n")
    rows = V.read_word_list(spark, path, whitespace=True).orderBy("word_idx").collect()
    assert [r["word"] for r in rows] == ["pear", "Apple", "fig", "kiwi"]


def test_idf_file(spark, tmp_path):
    words = ['pl"ain', '"quoted"', "back\\slash", "#hash", "\x1cedge\x1c", "é", "zz"]
    table = spark.createDataFrame([(w, 0.1 * i + 1e-7) for i, w in enumerate(words)], "word string, idf double")
    out = str(tmp_path / "idf")
    sinks.write_idf(table, out)
    assert lines_of(out)[0] == "Key,Value"
    assert sorted(map(tuple, V.read_idf(spark, out).collect())) == sorted(map(tuple, table.collect()))
    path = write(tmp_path / "twice.csv", "Key,Value\na,1.0\nb,2.0\na,3.0\n")
    assert sorted(map(tuple, V.read_idf(spark, path).collect())) == [("a", 3.0), ("b", 2.0)]


def test_dense_files(spark, tmp_path):
    vectors = spark.createDataFrame([("2", [0.5, 0.0]), ("10", [0.25, 1e-7])], "passage_id string, vector array<double>")
    words = spark.createDataFrame([(0, "b"), (1, "a")], "word_idx int, word string")
    sinks.write_dense_csv(vectors, words, str(tmp_path / "csv"))
    assert lines_of(tmp_path / "csv") == ["passageId,b,a", "10,0.25,1.0E-7", "2,0.5,0.0"]
    for _ in range(2):
        sinks.append_dense_csv(vectors, str(tmp_path / "appended"))
    assert sorted(lines_of(tmp_path / "appended")) == ["10,0.25,1.0E-7"] * 2 + ["2,0.5,0.0"] * 2
    sinks.write_dense_vectors(vectors, str(tmp_path / "vectors"))
    assert lines_of(tmp_path / "vectors") == ["10,0.25:1.0E-7", "2,0.5:0.0"]
    back = E.read_embeddings(spark, str(tmp_path / "vectors"))
    assert {r["id"]: r["embedding"] for r in back.collect()} == {10: [0.25, 1e-7], 2: [0.5, 0.0]}


def test_embedding_lines(spark, tmp_path):
    path = write(tmp_path / "good.csv", "12,0.5:1.0e-2\n12ab,1.0\n")
    assert [(r["id"], r["embedding"]) for r in E.read_embeddings(spark, path).collect()] == [(12, [0.5, 0.01]), (12, [1.0])]
    bad = ["-1,1.0", "id,embedding", "1,2,3", "7,x:1.0", " 1,1.0", "7,1.0:", ""]
    path = write(tmp_path / "bad.csv", "12,0.5\n" + "".join(line + "\n" for line in bad))
    assert [r["id"] for r in E.read_embeddings(spark, path, on_error="drop").collect()] == [12]
    rejected = {r["value"]: r["error"].split(":")[0] for r in E.rejected_embeddings(spark, path).collect()}
    assert rejected == {
        "-1,1.0": "invalid id", "id,embedding": "invalid id", "1,2,3": "invalid line", "7,x:1.0": "invalid number",
        " 1,1.0": "invalid id", "7,1.0:": "invalid number", "": "invalid line",
    }
    with pytest.raises(Exception, match="invalid"):
        E.read_embeddings(spark, path).select("id").collect()


def test_answers_of_files(spark, tmp_path):
    queries = write(tmp_path / "q.csv", "7,1.0:0.0\n8,0.0:0.0\n5,0.0:1.0\n7,0.0:1.0\n")
    passages = write(tmp_path / "p.csv", "1,0.0:1.0\n2,2.0:0.0\n5,1.0\n3,5.0:0.0\n4,0.0:0.0\n")
    answers = search.answer_all(spark, queries, passages, str(tmp_path / "answers"))
    got = sorted((r["query_id"], r["passage_id"]) for r in answers.collect() if r["passage_id"])
    assert got == [(5, 1), (7, 1), (7, 3)] and answers.count() == 4
    assert lines_of(tmp_path / "answers") == ["(7, 3)", "(5, 1)", "(7, 1)"]
    requests = spark.createDataFrame([("7",), ("no",)], "request string")
    got = search.answer_requested(spark, requests, queries, passages).collect()
    assert {(r["request"], r["status"], r["passage_id"]) for r in got} == {("7", "ok", 3), ("no", "invalid", None)}


def test_equal_scores_in_several_files(spark, tmp_path):
    queries = write(tmp_path / "q.csv", "7,1.0:0.0\n")
    for name, ids in (("a b%.csv", (9, 8)), ("é.csv", (2, 3)), ("c.csv", (5, 6))):
        write(tmp_path / "in" / name, "".join(f"{i},{i}.0:0.0\n" for i in ids))
    answers = search.answer_all(spark, queries, str(tmp_path / "in"))
    assert [r["passage_id"] for r in answers.collect()] == [3]
    order = [r["id"] for r in E.read_embeddings(spark, str(tmp_path / "in")).orderBy("pos").collect()]
    assert order == [9, 8, 5, 6, 2, 3]


def test_whole_jobs(spark, tmp_path):
    passages = write(tmp_path / "in/a.csv", "id,passage\n1,red fox\n2,red hen red\n3,Fox,owl hen red\n")
    words = write(tmp_path / "words.txt", "fox\nhen\nred\nzebra\n")
    log = math.log2(3 / 2)
    expected = {"1": [log / 2, 0, 0, 0], "2": [0, log / 3, 0, 0], "3": [log / 4, log / 4, 0, 0]}

    def check(df, expected=expected):
        got = {r["passage_id"]: r["vector"] for r in df.collect()}
        assert got == {k: pytest.approx(v, abs=1e-12, nan_ok=True) for k, v in expected.items()}

    check(corpus.one_shot(spark, passages, words, str(tmp_path / "one")))
    assert lines_of(tmp_path / "one")[0] == "passageId,fox,hen,red,zebra" and len(lines_of(tmp_path / "one")) == 4
    corpus.build_idf(spark, passages, words, str(tmp_path / "idf"))
    check(corpus.with_saved_idf(spark, passages, words, str(tmp_path / "idf"), str(tmp_path / "two")))
    assert len(lines_of(tmp_path / "two")) == 3
    strict = {k: v[:3] + [math.nan] for k, v in expected.items()}
    check(corpus.one_shot(spark, passages, words, zero_df="ieee"), strict)
    # Without lower case, "Fox" is another word than "fox", but still counts for the length.
    cased = {"1": [math.log2(3) / 2, 0, 0, 0], "2": [0, log / 3, 0, 0], "3": [0, log / 4, 0, 0]}
    check(corpus.first_generation(spark, passages, words, str(tmp_path / "three")), cased)
    assert len(lines_of(tmp_path / "three")) == 3
    # The header counts as a passage when it is not skipped.
    assert len(corpus.one_shot(spark, passages, words, header=False).collect()) == 4


def test_request_stream(spark, tmp_path):
    schema = "id bigint, embedding array<double>"
    queries = spark.createDataFrame([(7, [1.0, 0.0])], schema)
    passages = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.1])], schema)
    output, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for part, text in (("a", "7\n8\n"), ("b", "x\n7\n")):
        write(tmp_path / f"in/{part}.txt", text)
        stream = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "request")
        answer_request_stream(stream, queries, passages, output, progress).awaitTermination()
    rows = spark.read.parquet(output).select("request", "status", "passage_id").collect()
    assert sorted(map(tuple, rows), key=repr) == [("7", "ok", 2), ("7", "ok", 2), ("8", "not_found", None), ("x", "invalid", None)]


def test_passage_stream(spark, tmp_path):
    listed = stage(spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0)], "word_idx int, word string, idf double"), "list")
    output, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for part, text in (("a", "1,a b\n2,c\n"), ("b", "3,b\n")):
        write(tmp_path / f"in/{part}.csv", text)
        stream = read_passage_stream(spark, str(tmp_path / "in"))
        weigh_passage_stream(stream, listed, output, progress).awaitTermination()
    got = {r["passage_id"]: r["vector"] for r in spark.read.parquet(output).collect()}
    assert got == {"1": [0.5, 1.0], "2": [0.0, 0.0], "3": [0.0, 2.0]}


def test_duplicates_are_found_without_sorting_texts(spark, tmp_path):
    folder = tmp_path / "passages"
    folder.mkdir()
    for part in range(3):
        lines = [f"{i % 40},text {part} {i}" for i in range(200)] + ["hot,copy"] * 300 + [f"hot,last {part}", f",no id {part}"]
        (folder / f"p{part}").write_text("\n".join(lines) + "\n")
    rows = P.read_passages(spark, str(folder), header=False)
    got = {r.passage_id: r.passage for r in rows.collect()}
    expected = {str(i % 40): f"text 0 {i}" for i in range(200)} | {"hot": "last 0", "": "no id 0"}
    assert got == expected and rows.count() == len(expected)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_last_line_wins_however_files_are_split(spark, tmp_path):
    folder = tmp_path / "one"
    folder.mkdir()
    (folder / "p").write_text("".join(f"{i % 7},{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "7k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.passage_id: r.passage for r in P.read_passages(spark, str(folder), header=False).collect()}
            assert got == {str(i % 7): str(i) for i in range(5000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_places_of_lines_without_moving_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    for part, at in (("a", 0), ("b", 7), ("c", 1500), ("d", 1500)):
        until = {"a": 7, "b": 1500, "c": 1500, "d": 3000}[part]
        (tmp_path / "in" / part).write_text("".join(f"{line}\n" for line in lines[at:until]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "7k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            placed = with_place(read_lines(spark, str(tmp_path / "in")))
            assert [r["value"] for r in sorted(placed.collect())] == lines
            assert sorted(r["place"] for r in placed.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_ordered_vectors_are_written_without_a_sort(spark, tmp_path):
    rows = [(f"{i:03d}", f"0.0,{float(i)}") for i in range(200)]
    vectors = spark.createDataFrame(rows, "passage_id string, values string").orderBy("passage_id")
    words = spark.createDataFrame([(0, "b"), (1, "a")], "word_idx int, word string")
    sinks.write_dense_csv(vectors, words, str(tmp_path / "csv"), ordered=True)
    assert lines_of(tmp_path / "csv") == ["passageId,b,a", *[f"{i},{v}" for i, v in rows]]
    sinks.write_dense_vectors(vectors, str(tmp_path / "vectors"), ordered=True)
    assert lines_of(tmp_path / "vectors") == [f"{i},{v}" for i, v in rows]
    assert "Sort" not in sinks.in_order(spark.range(3), True)._jdf.queryExecution().optimizedPlan().toString()


def test_header_files_grow_in_number(spark, tmp_path, monkeypatch):
    """More files, not longer ones, for a larger table; the passages stay the same."""
    rows = [(i, f"text {i}, with\na comma") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = sorted(catalogue.passages_from_files_with_header(spark, str(tmp_path)).collect())
    monkeypatch.setattr(catalogue, "HEADER_FILE_BYTES", 300)
    written = []
    real = catalogue._files_with_header
    monkeypatch.setattr(catalogue, "_files_with_header", lambda *a: written.append(real(*a)) or written[-1])
    assert sorted(catalogue.passages_from_files_with_header(spark, str(tmp_path)).collect()) == expected
    files = glob.glob(f"{written[0]}/part-*")
    assert len(expected) == 301 and len(files) > 8 and all(open(f).readline() == "id,passage\n" for f in files)


@pytest.mark.parametrize("job", ["dense_csv_appended", "dense_vector_lines", "dense_csv_batches", "dense_csv_lines"])
def test_dense_jobs_keep_less_than_their_lines(spark, tmp_path, monkeypatch, job):
    """All that a job keeps, its lines in every copy too, takes less than half of the plain lines; the vectors are whole."""
    words, rows = [f"w{i:04d}" for i in range(3000)], [(i, f"w{i:04d} w{i + 7:04d} w{i:04d} other") for i in range(80)]
    spark.createDataFrame([(1, " ".join(words))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    expected = {r["passage_id"]: r["vector"] for r in catalogue.tfidf_dense(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path / "kept"))
    got = [r for r in getattr(catalogue, job)(spark, str(tmp_path)).collect() if r["passage_id"] != "passageId"]
    assert len(expected) == 80 and all(len(v) == 3000 and sum(map(bool, v)) == 2 for v in expected.values())
    assert len(got) == (160 if job == "dense_csv_appended" else 80) and all(r["vector"] == expected[r["passage_id"]] for r in got)
    if job != "dense_csv_appended":
        assert [r["passage_id"] for r in sorted(got, key=lambda r: r["place"])] == sorted(expected)
    kept = sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(tmp_path / "kept") for f in names)
    assert kept < 80 * 3000 * len("0.0,") / 2


@pytest.mark.parametrize("codec", ["lz4", "gzip"])
def test_compressed_dense_files_come_back_in_their_places(spark, tmp_path, codec):
    rows = [(f"{i:03d}", f"0.0,{float(i)}") for i in range(200)]
    vectors = spark.createDataFrame(rows, "passage_id string, values string").orderBy("passage_id")
    words = spark.createDataFrame([(0, "b"), (1, "a")], "word_idx int, word string")
    sinks.write_dense_csv(vectors, words, str(tmp_path / "csv"), ordered=True, compression=codec)
    sinks.write_dense_vectors(vectors, str(tmp_path / "vectors"), ordered=True, compression=codec)
    for _ in range(2):
        sinks.append_dense_csv(vectors, str(tmp_path / "appended"), codec)
    for folder, expected in (("csv", ["passageId,b,a", *map(",".join, rows)]), ("vectors", list(map(",".join, rows)))):
        placed = sorted(with_place(read_lines(spark, str(tmp_path / folder))).select("place", "value").collect())
        assert [tuple(r) for r in placed] == list(enumerate(expected))
    assert sorted(r["value"] for r in read_lines(spark, str(tmp_path / "appended")).collect()) == sorted(2 * list(map(",".join, rows)))
