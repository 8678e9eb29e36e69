"""Document frequencies and the IDF table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passageloom.functions import text as T
from passageloom.functions.weights import inverse_document_frequency
from passageloom.operators.lookup import BROADCAST_BYTES, fits_broadcast
from passageloom.operators.staging import null_row, stage
from passageloom.operators.terms import distinct_passage_words


class CorpusFrequency(NamedTuple):
    """Staged (word, df) table and the number of passages."""

    table: DataFrame
    n_passages: int


def passage_count(passages: DataFrame) -> DataFrame:
    return passages.agg(F.count("*").alias("n_passages"))


def document_frequency(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(word, df) over the vocabulary of the corpus. A passage counts a word once, before any shuffle."""
    return distinct_passage_words(passages, lowercase).groupBy("word").agg(F.count("*").alias("df"))


def document_frequency_for(
    passages: DataFrame, vocabulary: DataFrame, lowercase: bool = True, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """(word, df) for the words of ``vocabulary``, zeros kept."""
    listed = stage(vocabulary.select("word").distinct(), "vocabulary")
    words = distinct_passage_words(passages, lowercase)
    if fits_broadcast(listed, "word", budget):
        words = words.join(F.broadcast(listed), "word", "left_semi")
    # A larger vocabulary is met after the aggregate, where both sides have one row for each word.
    counts = words.groupBy("word").agg(F.count("*").alias("df"))
    return listed.join(counts, "word", "left").select("word", F.coalesce("df", F.lit(0)).cast("bigint").alias("df"))


def merge_counts(*frequencies: DataFrame) -> DataFrame:
    """Add up (word, df) tables of disjoint batches of passages."""
    union = frequencies[0].select("word", "df")
    for other in frequencies[1:]:
        union = union.unionByName(other.select("word", "df"))
    return union.groupBy("word").agg(F.sum("df").alias("df"))


def corpus_frequency(
    passages: DataFrame,
    vocabulary: DataFrame | None = None,
    lowercase: bool = True,
    budget: int = BROADCAST_BYTES,
    vocabulary_is_staged: bool = False,
) -> CorpusFrequency:
    """Document frequencies and the number of passages from one pass over the corpus.

    ``vocabulary_is_staged`` tells that the vocabulary is a written table with each word once.

    Each passage adds one null to its distinct words, so the count of the null word is the number of passages.
    """
    marked = F.array_append(T.distinct_words(F.col("passage"), lowercase), F.lit(None).cast("string"))
    words = passages.select(F.explode_outer(marked).alias("word"))
    listed = None
    if vocabulary is not None:
        listed = vocabulary.select("word")
        if not vocabulary_is_staged:
            listed = stage(listed.distinct(), "vocabulary")
        if fits_broadcast(listed, "word", budget):
            wanted = listed.unionByName(null_row(listed))
            words = words.join(
                F.broadcast(wanted.withColumnRenamed("word", "_wanted")),
                F.col("word").eqNullSafe(F.col("_wanted")),
                "left_semi",
            )
    counted = stage(words.groupBy("word").agg(F.count("*").alias("df")), "document-frequency")
    frequency = _counted(counted)
    if listed is None:
        return frequency
    table = listed.join(frequency.table, "word", "left")
    return CorpusFrequency(table.select("word", F.coalesce("df", F.lit(0)).cast("bigint").alias("df")), frequency.n_passages)


def _counted(counted: DataFrame) -> CorpusFrequency:
    total = counted.where(F.col("word").isNull()).first()
    return CorpusFrequency(counted.where(F.col("word").isNotNull()), 0 if total is None else total["df"])


def frequency_of_counts(counted: DataFrame) -> CorpusFrequency:
    """As ``corpus_frequency``, from staged term counts (``with_term_counts``): the texts are not taken apart again."""
    marked = F.array_append(F.transform("terms", lambda term: term["word"]), F.lit(None).cast("string"))
    words = counted.select(F.explode_outer(marked).alias("word"))
    return _counted(stage(words.groupBy("word").agg(F.count("*").alias("df")), "document-frequency"))


def idf_of(frequency: CorpusFrequency, zero_df: str = "omit") -> DataFrame:
    """(word, df, idf); words in no passage are left out, or get Infinity with ``zero_df="ieee"``."""
    idf = inverse_document_frequency(F.lit(frequency.n_passages), F.col("df"), zero_df)
    return frequency.table.select("word", "df", idf.alias("idf")).where(F.col("idf").isNotNull())


def idf_table(
    passages: DataFrame, vocabulary: DataFrame | None = None, lowercase: bool = True, zero_df: str = "omit"
) -> DataFrame:
    return idf_of(corpus_frequency(passages, vocabulary, lowercase), zero_df).select("word", "idf")
