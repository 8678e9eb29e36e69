"""Every operator as a named job over the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.functions import vectors as V
from passageloom.operators import frequency, terms, weighting
from passageloom.operators.dedup import first_file_last_line
from passageloom.operators.lookup import lookup_join
from passageloom.operators.requests import answer_requests
from passageloom.operators.retrieval import best_passages, similarities
from passageloom.operators.running import add_batch, running_frequency
from passageloom.operators.staging import estimated_bytes, new_folder, spread, stage
from passageloom.plans import corpus, inputs, search
from passageloom.sinks.batches import add_dense_batch
from passageloom.sinks.files import (
    append_dense_csv, write_answers, write_dense_csv, write_dense_vectors, write_embeddings, write_passages, write_vocabulary,
)
from passageloom.sources.embeddings import parse_embedding_lines, read_embeddings
from passageloom.sources.files import read_lines, with_place
from passageloom.sources.passages import lookup_passages, passage_texts, read_passages
from passageloom.sources.store import stored_passages, write_store
from passageloom.streaming.passages import read_passage_stream, weigh_passage_stream
from passageloom.streaming.requests import answer_request_stream

DIGITS = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# Words and counts


def passage_words(spark: SparkSession, folder: str) -> DataFrame:
    return terms.passage_words(inputs.documents(spark, folder)).withColumn("position", F.col("position").cast("bigint"))


def term_count(spark: SparkSession, folder: str) -> DataFrame:
    return terms.term_counts(inputs.documents(spark, folder)).select("passage_id", "word", "tf")


def term_count_cased(spark: SparkSession, folder: str) -> DataFrame:
    return terms.term_counts(inputs.documents(spark, folder), lowercase=False).select("passage_id", "word", "tf")


def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(weighting.term_frequencies(inputs.documents(spark, folder)), "tf")


def passage_length(spark: SparkSession, folder: str) -> DataFrame:
    return terms.passage_lengths(inputs.documents(spark, folder))


def distinct_passage_words(spark: SparkSession, folder: str) -> DataFrame:
    return terms.distinct_passage_words(inputs.documents(spark, folder))


# Vocabulary, document frequency, IDF


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return terms.vocabulary(inputs.documents(spark, folder))


def vocabulary_union(spark: SparkSession, folder: str) -> DataFrame:
    return terms.vocabulary_union(
        terms.vocabulary(inputs.documents(spark, folder)), inputs.benchmark_words(spark, folder)
    )


def vocabulary_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return weighting.index_vocabulary(inputs.benchmark_words(spark, folder))


def doc_count(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.passage_count(inputs.documents(spark, folder))


def doc_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.document_frequency(inputs.documents(spark, folder))


def doc_frequency_fixed_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.document_frequency_for(inputs.documents(spark, folder), inputs.benchmark_words(spark, folder))


def df_running(spark: SparkSession, folder: str) -> DataFrame:
    """A saved table that gets the documents and the benchmark, the benchmark twice by mistake."""
    state = new_folder(spark, "running-df")
    for batch, passages in (("documents", inputs.documents), ("benchmark", inputs.benchmark), ("benchmark", inputs.benchmark)):
        add_batch(spark, state, batch, passages(spark, folder))
    return running_frequency(spark, state).table


def df_merge(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.merge_counts(
        frequency.document_frequency(inputs.documents(spark, folder)),
        frequency.document_frequency(inputs.benchmark(spark, folder)),
    )


def idf(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(frequency.idf_table(inputs.documents(spark, folder)), "idf")


def idf_fixed_vocab(spark: SparkSession, folder: str) -> DataFrame:
    words = inputs.benchmark_words(spark, folder)
    return _rounded(frequency.idf_table(inputs.documents(spark, folder), words), "idf")


def idf_fixed_vocab_ieee(spark: SparkSession, folder: str) -> DataFrame:
    table = frequency.idf_table(
        inputs.documents(spark, folder), inputs.benchmark_words(spark, folder), zero_df="ieee"
    )
    finite = F.col("idf") < F.lit(float("inf"))
    return table.select(
        "word", F.when(finite, F.round("idf", DIGITS)).alias("idf"), (~finite).cast("int").alias("infinite")
    )


# TF-IDF


def tfidf_sparse(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(weighting.tfidf_sparse(inputs.documents(spark, folder)), "tfidf")


def tfidf_sparse_cased(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(weighting.tfidf_sparse(inputs.documents(spark, folder), lowercase=False), "tfidf")


def tfidf_missing_idf(spark: SparkSession, folder: str) -> DataFrame:
    """Term counts of the second corpus, weighted with the IDF of the first; unseen words have an IDF of 1."""
    table = stage(frequency.idf_table(inputs.documents(spark, folder)), "idf")
    counts = terms.term_counts(inputs.benchmark(spark, folder))
    return _rounded(weighting.tfidf_with_table(counts, table, missing_idf=1.0), "tfidf")


def tfidf_fixed_vocab(spark: SparkSession, folder: str) -> DataFrame:
    passages = inputs.documents(spark, folder)
    table = stage(frequency.idf_table(passages, inputs.benchmark_words(spark, folder)), "idf")
    return _rounded(weighting.tfidf_for_vocabulary(passages, table), "tfidf")


def tfidf_dense(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder)


def _dense(spark: SparkSession, folder: str, **form) -> DataFrame:
    words = inputs.benchmark_words(spark, folder)
    return corpus.dense_of_tables(inputs.documents(spark, folder), words, digits=DIGITS, **form)


def tfidf_sparse_beyond_a_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """As ``tfidf_sparse``, with a budget that the IDF table exceeds: only frequent words are broadcast."""
    return _rounded(weighting.tfidf_sparse(inputs.documents(spark, folder), budget=200_000), "tfidf")


def _nan_as_null(vectors: DataFrame) -> DataFrame:
    return vectors.select("passage_id", F.transform("vector", lambda x: F.when(~F.isnan(x), x)).alias("vector"))


def tfidf_dense_ieee(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the list that no document has weigh NaN, shown as null."""
    passages = inputs.documents(spark, folder)
    words = weighting.index_vocabulary(inputs.benchmark_words(spark, folder))
    idf = frequency.idf_table(passages, words.select("word"), zero_df="ieee")
    return _nan_as_null(weighting.dense_tfidf(passages, weighting.attach_idf(words, idf), digits=DIGITS))


def tfidf_dense_empty_nan(spark: SparkSession, folder: str) -> DataFrame:
    """The items as passages without words beside the documents: their vectors are NaN, shown as null."""
    items = inputs.benchmark(spark, folder).select(F.concat(F.lit("item"), "passage_id").alias("passage_id"), F.lit(" ").alias("passage"))
    passages = inputs.documents(spark, folder).unionByName(items)
    words = weighting.index_vocabulary(inputs.benchmark_words(spark, folder))
    idf = frequency.idf_table(inputs.documents(spark, folder), words.select("word"))
    return _nan_as_null(weighting.dense_tfidf(passages, weighting.attach_idf(words, idf), empty="nan", digits=DIGITS))


def tfidf_densified(spark: SparkSession, folder: str) -> DataFrame:
    """Long weights over the whole vocabulary, then dense over the words of a list."""
    passages = inputs.documents(spark, folder)
    words = weighting.index_vocabulary(inputs.benchmark_words(spark, folder))
    return weighting.densify(_rounded(weighting.tfidf_sparse(passages), "tfidf"), words, passages)


# Vectors and retrieval


def vector_norm(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.vectors(spark, folder)
    return rows.select(F.col("id").alias("vec_id"), F.round(V.norm(F.col("embedding")), DIGITS).alias("norm"))


def cosine_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector with the mean of its label."""
    means = stage(
        inputs.label_means(spark, folder).select(F.col("id").alias("label"), F.col("embedding").alias("mean")), "means"
    )
    rows = spread(inputs.table(spark, folder, "embeddings"), "vec_id").select(
        "vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    a, b = F.col("embedding"), F.col("mean")
    return lookup_join(rows, means, "label").select(
        "vec_id",
        F.round(V.dot_product(a, b), DIGITS).alias("dot"),
        F.round(V.cosine(a, b), DIGITS).alias("cosine"),
        F.round(V.cosine_or_zero_if_empty(a, F.slice(b, 1, 0)), DIGITS).alias("cosine_with_empty"),
    )


def similarity_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(similarities(inputs.label_means(spark, folder), inputs.vectors(spark, folder)), "score")


def similarity_rows_in_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """As ``similarity_rows``, with queries beyond the budget."""
    rows = similarities(inputs.label_means(spark, folder), inputs.vectors(spark, folder), budget=1)
    return _rounded(rows, "score")


def best_passage(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(best_passages(inputs.label_means(spark, folder), inputs.vectors(spark, folder)), "score")


def best_passage_many_queries(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(best_passages(inputs.vectors(spark, folder), inputs.label_means(spark, folder)), "score")


def best_passage_row(spark: SparkSession, folder: str) -> DataFrame:
    best = best_passages(inputs.label_means(spark, folder), inputs.vectors(spark, folder), with_embedding=True)
    return best.select("query_id", "passage_id", F.transform("embedding", lambda x: F.round(x, DIGITS)).alias("embedding"))


def _rows_of_best(best: DataFrame) -> DataFrame:
    return best.select("query_id", "passage_id", F.transform("embedding", lambda x: F.round(x, DIGITS)).alias("embedding"))


def best_passage_row_many_queries(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_of_best(best_passages(inputs.vectors(spark, folder), inputs.label_means(spark, folder), with_embedding=True))


def best_passage_all_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector plus the mean of its label against every vector, in blocks: neither side fits the small budget."""
    best = best_passages(inputs.shifted_vectors(spark, folder), inputs.vectors(spark, folder), budget=100_000)
    return _rounded(best, "score")


def best_passage_requests(spark: SparkSession, folder: str) -> DataFrame:
    return answer_requests(
        inputs.requests(spark, folder), inputs.label_means(spark, folder), inputs.vectors(spark, folder)
    )


# Keys


def passages_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as lines, roles as files, conversations as ids."""
    turns = spread(inputs.table(spark, folder, "conversations")).select(
        F.col("conv_id").cast("string").alias("passage_id"), F.col("text").alias("passage"), "role", "turn"
    )
    return first_file_last_line(turns, "passage_id", F.col("role"), [F.col("turn")]).select("passage_id", "passage")


def passage_lookup(spark: SparkSession, folder: str) -> DataFrame:
    keys = inputs.table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("passage_id"))
    return lookup_passages(inputs.documents(spark, folder), keys)


# Files: the given tables are written in the text formats and read back


def _passage_files(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "passage-files")
    write_passages(inputs.documents(spark, folder), path)
    return path


def _word_file(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "word-file")
    write_vocabulary(inputs.benchmark_words(spark, folder), path)
    return path


def passages_from_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_passages(spark, _passage_files(spark, folder), header=False)


def passages_from_files_with_header(spark: SparkSession, folder: str) -> DataFrame:
    """Files with a header each, blank lines, and ids repeated within a file and in a later one."""
    text = F.replace(F.col("passage"), F.lit("\n"), F.lit(" "))
    line = F.concat("passage_id", F.lit(","), text, F.lit("\uffff"))
    copies = F.array(
        F.struct(F.lit(0).alias("later"), F.lit(1).alias("place"), F.concat("passage_id", F.lit(",old")).alias("line")),
        F.struct(F.lit(0).alias("later"), F.lit(2).alias("place"), line.alias("line")),
        F.struct(F.lit(0).alias("later"), F.lit(3).alias("place"), F.lit("").alias("line")),
        F.struct(F.lit(1).alias("later"), F.lit(1).alias("place"), F.concat("passage_id", F.lit(",later")).alias("line")),
    )
    rows = inputs.documents(spark, folder).select(F.pmod(F.crc32("passage_id"), F.lit(3)).alias("first"), "passage_id", F.inline(copies))
    lines = rows.select((F.col("first") + F.col("later")).alias("part"), "passage_id", "place", "line")
    return read_passages(spark, _files_with_header(spark, lines, inputs.table(spark, folder, "documents")))


HEADER_FILE_BYTES = 16 * 1024 * 1024


def _files_with_header(spark: SparkSession, lines: DataFrame, table: DataFrame) -> str:
    """Files of the parts 0 to 3 of (part, passage_id, place, line), each with a header before the other lines.

    All lines of an id in a part are in one file. A part has more files the larger the table is that the lines come from,
    as a file is what one task writes.
    """
    files = 1 + estimated_bytes(table) // (4 * HEADER_FILE_BYTES)
    name = F.format_string("%d-%06d", F.col("part").cast("int"), F.col("file").cast("int")).alias("part")
    header = spark.range(4 * files).select(
        (F.col("id") % 4).alias("part"), F.floor(F.col("id") / 4).alias("file"), F.lit(0).alias("place"), F.lit("id,passage").alias("line")
    )
    dealt = lines.withColumn("file", F.pmod(F.xxhash64("passage_id"), F.lit(files))).drop("passage_id")
    path = new_folder(spark, "header-files")
    task = F.coalesce(F.col("part") * files + F.col("file"), F.lit(0)).cast("int").alias("task")
    named = header.unionByName(dealt).select(name, "place", "line", task)
    # A task for each file: by their hash several files would meet in one.
    ordered = named.repartitionById(4 * files, "task").sortWithinPartitions("part", "place")
    ordered.select("part", "line").write.partitionBy("part").text(path, lineSep="\n")
    return f"{path}/part=*"


def passages_from_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Two folders at once, whose ids overlap: the first file by name wins."""
    path = new_folder(spark, "two-folders")
    write_passages(inputs.documents(spark, folder), f"{path}/a")
    write_passages(inputs.benchmark(spark, folder), f"{path}/b")
    return read_passages(spark, [f"{path}/a", f"{path}/b"], header=False)


def passage_shown(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.show_passage(spark, _passage_files(spark, folder), "1", header=False)


def passage_shown_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """The passage files stored by id once, then one passage of them."""
    store = new_folder(spark, "store")
    corpus.store_passages(spark, _passage_files(spark, folder), store, header=False)
    return corpus.show_stored(spark, store, "1")


def passage_lookup_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """As ``passage_lookup``, from a store of several files."""
    store = new_folder(spark, "store")
    write_store(inputs.documents(spark, folder), store, file_bytes=1 << 20, row_group_bytes=1 << 17)
    keys = inputs.table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("passage_id"))
    return stored_passages(spark, store, keys)


def passage_text_column(spark: SparkSession, folder: str) -> DataFrame:
    return passage_texts(inputs.documents(spark, folder))


def _lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(place, line) of all lines of a folder, in the order of files and lines."""
    return with_place(read_lines(spark, path)).select("place", F.col("value").alias("line"))


def _numbers(fields: Column) -> Column:
    return F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(1))).cast("array<double>")


#: A dense line has a number for each word of the list; plain, the lines alone are several times the input.
LINE_CODEC = "lz4"


def dense_csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a dense CSV in their places: the header first, then the passages by id."""
    words = weighting.index_vocabulary(inputs.benchmark_words(spark, folder))
    path = new_folder(spark, "dense-csv")
    write_dense_csv(_dense(spark, folder, ordered=True, text=","), words, path, ordered=True, compression=LINE_CODEC)
    return _dense_csv_rows(spark, path)


def _dense_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    fields = F.split("line", ",")
    first = F.col("place") == 0
    return _lines_in_order(spark, path).select(
        "place",
        F.get(fields, F.lit(0)).alias("passage_id"),
        F.when(first, F.array_join(fields, ",")).alias("header"),
        F.when(~first, _numbers(fields)).alias("vector"),
    )


def dense_csv_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of lines added to one folder."""
    path = new_folder(spark, "dense-csv")
    vectors = _dense(spark, folder, text=",", staged=True)
    append_dense_csv(vectors, path, LINE_CODEC)
    append_dense_csv(vectors, path, LINE_CODEC)
    fields = F.split("value", ",")
    return spark.read.text(path).select(F.get(fields, F.lit(0)).alias("passage_id"), _numbers(fields).alias("vector"))


def dense_csv_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a dense CSV to which one batch was added twice: the header, then each passage once."""
    words = stage(weighting.index_vocabulary(inputs.benchmark_words(spark, folder)), "words")
    path = new_folder(spark, "dense-batches")
    vectors = _dense(spark, folder, ordered=True, text=",")
    for _ in range(2):
        add_dense_batch(vectors, words, path, "documents", ordered=True, compression=LINE_CODEC)
    return _dense_csv_rows(spark, f"{path}/*")


def dense_vector_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "dense-vectors")
    write_dense_vectors(_dense(spark, folder, ordered=True, text=":"), path, ordered=True, compression=LINE_CODEC)
    fields = F.split("line", ",", 2)
    numbers = F.coalesce(V.embedding_of_text(F.get(fields, F.lit(1))), F.array().cast("array<double>"))
    return _lines_in_order(spark, path).select("place", F.get(fields, F.lit(0)).alias("passage_id"), numbers.alias("vector"))


def answer_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "answers")
    write_answers(best_passages(inputs.label_means(spark, folder), inputs.vectors(spark, folder)), path)
    return _lines_in_order(spark, path)


def vocabulary_from_files(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.build_vocabulary(
        spark, _passage_files(spark, folder), new_folder(spark, "vocabulary-file"), header=False
    )


def idf_from_files(spark: SparkSession, folder: str) -> DataFrame:
    table = corpus.build_idf(
        spark, _passage_files(spark, folder), _word_file(spark, folder), new_folder(spark, "idf-file"), header=False
    )
    return _rounded(table, "idf")


def tfidf_first_generation(spark: SparkSession, folder: str) -> DataFrame:
    passages, words = _passage_files(spark, folder), _word_file(spark, folder)
    return corpus.first_generation(spark, passages, words, header=False, digits=DIGITS)


def tfidf_saved_idf(spark: SparkSession, folder: str) -> DataFrame:
    passages, words, saved = _passage_files(spark, folder), _word_file(spark, folder), new_folder(spark, "idf-file")
    corpus.build_idf(spark, passages, words, saved, header=False)
    return corpus.with_saved_idf(spark, passages, words, saved, header=False, digits=DIGITS)


def tfidf_one_shot(spark: SparkSession, folder: str) -> DataFrame:
    passages, words = _passage_files(spark, folder), _word_file(spark, folder)
    return corpus.one_shot(spark, passages, words, header=False, digits=DIGITS)


def embedding_parse(spark: SparkSession, folder: str) -> DataFrame:
    return parse_embedding_lines(inputs.embedding_lines(spark, folder))


def embeddings_from_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "embedding-files")
    write_embeddings(inputs.vectors(spark, folder), path)
    return read_embeddings(spark, path).select("id", "embedding")


def best_passage_from_files(spark: SparkSession, folder: str) -> DataFrame:
    queries, passages = new_folder(spark, "query-files"), new_folder(spark, "embedding-files")
    write_embeddings(inputs.label_means(spark, folder), queries)
    write_embeddings(inputs.vectors(spark, folder), passages)
    answers = search.answer_all(spark, queries, passages)
    return _rounded(answers.select("query_id", "passage_id", "score"), "score")


# Streams


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    incoming, output, progress = (new_folder(spark, n) for n in ("requests", "answers", "progress"))
    inputs.requests(spark, folder).write.text(incoming)
    stream = spark.readStream.text(incoming).withColumnRenamed("value", "request")
    queries = stage(inputs.label_means(spark, folder), "query-vectors")
    run = answer_request_stream(stream, queries, inputs.vectors(spark, folder), output, progress)
    run.awaitTermination()
    return spark.read.schema("request string, query_id bigint, status string, passage_id bigint").parquet(
        f"{output}/batch=*"
    )


def passage_stream(spark: SparkSession, folder: str) -> DataFrame:
    passages, words, saved = _passage_files(spark, folder), _word_file(spark, folder), new_folder(spark, "idf-file")
    corpus.build_idf(spark, passages, words, saved, header=False)
    output, progress = new_folder(spark, "vectors"), new_folder(spark, "progress")
    run = weigh_passage_stream(
        read_passage_stream(spark, passages), corpus.word_list_with_idf(spark, words, saved), output, progress, DIGITS
    )
    run.awaitTermination()
    return spark.read.schema("passage_id string, vector array<double>").parquet(f"{output}/batch=*")


def passage_stream_with_header(spark: SparkSession, folder: str) -> DataFrame:
    text = F.replace(F.col("passage"), F.lit("\n"), F.lit(" "))
    lines = inputs.documents(spark, folder).select(
        F.pmod(F.crc32("passage_id"), F.lit(4)).alias("part"), "passage_id", F.lit(1).alias("place"), F.concat("passage_id", F.lit(","), text).alias("line")
    )
    passages, words, saved = _passage_files(spark, folder), _word_file(spark, folder), new_folder(spark, "idf-file")
    corpus.build_idf(spark, passages, words, saved, header=False)
    output, progress = new_folder(spark, "vectors"), new_folder(spark, "progress")
    written = _files_with_header(spark, lines, inputs.table(spark, folder, "documents"))
    stream = read_passage_stream(spark, written, header=True)
    weigh_passage_stream(stream, corpus.word_list_with_idf(spark, words, saved), output, progress, DIGITS).awaitTermination()
    return spark.read.schema("passage_id string, vector array<double>").parquet(f"{output}/batch=*")


JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    job.__name__: job
    for job in (
        passage_words, term_count, term_count_cased, term_frequency, passage_length, distinct_passage_words,
        vocabulary, vocabulary_union, vocabulary_indexed, doc_count, doc_frequency, doc_frequency_fixed_vocab,
        df_merge, df_running, idf, idf_fixed_vocab, idf_fixed_vocab_ieee,
        tfidf_sparse, tfidf_sparse_cased, tfidf_missing_idf, tfidf_fixed_vocab, tfidf_dense, tfidf_densified,
        vector_norm, cosine_pairs, similarity_rows, similarity_rows_in_blocks,
        best_passage, best_passage_many_queries, best_passage_row, best_passage_requests,
        passages_dedup, passage_lookup,
        passages_from_files, vocabulary_from_files, idf_from_files,
        tfidf_first_generation, tfidf_saved_idf, tfidf_one_shot,
        embedding_parse, embeddings_from_files, best_passage_from_files,
        request_stream, passage_stream, passage_stream_with_header,
        tfidf_sparse_beyond_a_broadcast, tfidf_dense_ieee, tfidf_dense_empty_nan,
        best_passage_row_many_queries, best_passage_all_vectors,
        passages_from_files_with_header, passages_from_folders, passage_shown, passage_text_column,
        passage_shown_from_store, passage_lookup_from_store,
        dense_csv_lines, dense_csv_appended, dense_csv_batches, dense_vector_lines, answer_lines,
    )
}
