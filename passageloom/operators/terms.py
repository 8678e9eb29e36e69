"""Words and term counts of passages.

A passage is one row, so everything about its own words is computed inside that row: no shuffle, no grouping.
``explode_outer`` and ``inline_outer`` are used throughout, because for the plain forms the optimizer adds a filter
that evaluates the whole tokenising expression a second and third time below the generator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passageloom.functions import text as T


def passage_words(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(passage_id, position, word), positions from 0."""
    exploded = passages.select("passage_id", F.posexplode_outer(T.words(F.col("passage"), lowercase)).alias("position", "word"))
    return exploded.where(F.col("word").isNotNull())


def passage_lengths(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(passage_id, n_words), words outside any vocabulary included."""
    return passages.select("passage_id", F.size(T.words(F.col("passage"), lowercase)).cast("bigint").alias("n_words"))


def distinct_passage_words(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(passage_id, word), each word of a passage once."""
    exploded = passages.select("passage_id", F.explode_outer(T.distinct_words(F.col("passage"), lowercase)).alias("word"))
    return exploded.where(F.col("word").isNotNull())


def with_term_counts(passages: DataFrame, lowercase: bool = True, end: bool = False) -> DataFrame:
    """Replace the passage by ``n_words`` and ``terms``, an array of (word, tf) sorted by word.

    The words of the row are sorted and counted as runs: a run starts where a word differs from the one before it,
    and its length is the distance to the start of the next run. ``end=True`` adds an element with a null word, so that
    a passage without words keeps a row when the array is unfolded.
    """
    keep = [c for c in passages.columns if c != "passage"]
    tokenised = passages.select(*keep, T.words(F.col("passage"), lowercase).alias("_words"))
    ordered = tokenised.select(*keep, F.size("_words").alias("n_words"), F.sort_array("_words").alias("_sorted"))
    places = F.when(F.col("n_words") > 0, F.sequence(F.lit(0), F.col("n_words") - 1)).otherwise(F.array().cast("array<int>"))
    word_at = lambda i: F.get(F.col("_sorted"), i)
    starts = ordered.select(
        *keep, "n_words", "_sorted", F.filter(places, lambda i: (i == 0) | (word_at(i) != word_at(i - 1))).alias("_starts")
    )
    ends = F.slice(F.array_append("_starts", F.col("n_words")), F.lit(2), F.size("_starts"))
    distinct = F.transform("_starts", word_at)
    lengths = F.zip_with("_starts", ends, lambda start, stop: stop - start)
    if end:
        distinct = F.array_append(distinct, F.lit(None).cast("string"))
        lengths = F.array_append(lengths, F.lit(0))
    return starts.select(*keep, "n_words", F.arrays_zip(distinct.alias("word"), lengths.alias("tf")).alias("terms"))


def _unfolded(counted: DataFrame) -> DataFrame:
    keep = [c for c in counted.columns if c not in ("n_words", "terms")]
    rows = counted.select(*keep, "n_words", F.inline_outer("terms"))
    return rows.select(
        *keep, F.col("n_words").cast("bigint").alias("n_words"), "word", F.col("tf").cast("bigint").alias("tf")
    )


def counts_of(counted: DataFrame) -> DataFrame:
    """(passage_id, n_words, word, tf) from the rows of ``with_term_counts``."""
    return _unfolded(counted).where(F.col("word").isNotNull())


def term_counts(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(passage_id, n_words, word, tf), one row for each distinct word of a passage."""
    return counts_of(with_term_counts(passages, lowercase))


def term_counts_with_end(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """As ``term_counts``, plus one row with a null word for each passage, so that no passage gets lost in a join."""
    return _unfolded(with_term_counts(passages, lowercase, end=True))


def vocabulary(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(word), each word of the corpus once."""
    return (
        passages.select(F.explode_outer(T.distinct_words(F.col("passage"), lowercase)).alias("word"))
        .where(F.col("word").isNotNull())
        .distinct()
    )


def vocabulary_union(*vocabularies: DataFrame) -> DataFrame:
    union = vocabularies[0].select("word")
    for other in vocabularies[1:]:
        union = union.unionByName(other.select("word"))
    return union.distinct()
