"""Whole jobs over passage files: vocabulary, IDF table, dense TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passageloom.operators.frequency import corpus_frequency, idf_of
from passageloom.operators.staging import stage
from passageloom.operators.terms import vocabulary
from passageloom.operators.weighting import attach_idf, dense_tfidf, index_vocabulary
from passageloom.sinks.files import append_dense_csv, write_dense_csv, write_dense_vectors, write_idf, write_vocabulary
from passageloom.sources.passages import lookup_passage, read_passages
from passageloom.sources.store import stored_passage, write_store
from passageloom.sources.vocabulary import read_idf, read_vocabulary, read_word_list


def build_vocabulary(spark: SparkSession, passages: str, output: str, header: bool = True) -> DataFrame:
    """Passage files to a sorted word list."""
    write_vocabulary(vocabulary(read_passages(spark, passages, header=header)), output)
    return read_vocabulary(spark, output)


def build_idf(
    spark: SparkSession, passages: str, word_list: str, output: str, header: bool = True, zero_df: str = "omit"
) -> DataFrame:
    """Passage files and a word list to a saved IDF table."""
    frequency = corpus_frequency(read_passages(spark, passages, header=header), read_vocabulary(spark, word_list))
    write_idf(idf_of(frequency, zero_df), output)
    return read_idf(spark, output)


def first_generation(
    spark: SparkSession, passages: str, word_list: str, output: str | None = None, header: bool = True, digits: int | None = None
) -> DataFrame:
    """Case-sensitive TF-IDF of a corpus, dense over the words of a list; ``id,v:v:...:v`` if an output is given.

    The weights come from the vocabulary of the corpus, but only those of the list are ever asked for, so only its
    words are counted.
    """
    rows = stage(read_passages(spark, passages, header=header), "passages")
    words = read_word_list(spark, word_list, whitespace=True)
    idf = idf_of(corpus_frequency(rows, words, lowercase=False))
    vectors = dense_tfidf(rows, attach_idf(words, idf), lowercase=False, share_first=True, digits=digits, ordered=output is not None)
    if output is not None:
        write_dense_vectors(vectors, output, ordered=True)
    return vectors


def word_list_with_idf(spark: SparkSession, word_list: str, idf: str) -> DataFrame:
    return attach_idf(read_word_list(spark, word_list), read_idf(spark, idf))


def with_saved_idf(
    spark: SparkSession, passages: str, word_list: str, idf: str, output: str | None = None, header: bool = True, digits: int | None = None
) -> DataFrame:
    """Dense TF-IDF with a saved IDF table. Rows are weighted one by one: equal ids stay separate."""
    rows = read_passages(spark, passages, header=header, unique=False)
    vectors = dense_tfidf(rows, word_list_with_idf(spark, word_list, idf), unique_ids=False, digits=digits)
    if output is not None:
        append_dense_csv(vectors, output)
    return vectors


def one_shot(
    spark: SparkSession,
    passages: str,
    word_list: str,
    output: str | None = None,
    header: bool = True,
    zero_df: str = "omit",
    empty: str = "zero",
    digits: int | None = None,
) -> DataFrame:
    """Passage files and a word list to dense TF-IDF, the IDF computed on the way.

    The de-duplicated passages are written once, because both steps read them.
    """
    rows = stage(read_passages(spark, passages, header=header), "passages")
    words = read_word_list(spark, word_list)
    idf = idf_of(corpus_frequency(rows, words), zero_df)
    vectors = dense_tfidf(rows, attach_idf(words, idf), empty=empty, digits=digits, ordered=output is not None)
    if output is not None:
        write_dense_csv(vectors, words, output, ordered=True)
    return vectors


def dense_of_tables(passages: DataFrame, words: DataFrame, digits: int | None = None, **form) -> DataFrame:
    """Dense TF-IDF of a passage table over a table of different words, in ascending order; ``form`` as in ``dense_tfidf``."""
    listed = stage(words, "words")
    idf = idf_of(corpus_frequency(passages, listed, vocabulary_is_staged=True))
    listed = index_vocabulary(listed)
    return dense_tfidf(passages, attach_idf(listed, idf), digits=digits, **form)


def show_passage(spark: SparkSession, path: str, passage_id: str, header: bool = True) -> DataFrame:
    return lookup_passage(read_passages(spark, path, header=header), passage_id)


def store_passages(spark: SparkSession, path: str, folder: str, header: bool = True) -> None:
    """Read passage files once and store them by id, for ``show_stored``."""
    write_store(read_passages(spark, path, header=header), folder, unique_ids=True)


def show_stored(spark: SparkSession, folder: str, passage_id: str) -> DataFrame:
    """As ``show_passage``, from a store: only the row groups that may hold the id are read."""
    return stored_passage(spark, folder, passage_id)
