"""Column expressions for term weights. All logarithms have base 2 and nothing is smoothed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inverse_document_frequency(n_passages: Column, df: Column, zero_df: str = "omit") -> Column:
    """log2(N / df). A word in no passage gives null, or Infinity with ``zero_df="ieee"``."""
    if zero_df not in ("omit", "ieee"):
        raise ValueError(f"zero_df must be 'omit' or 'ieee', not {zero_df!r}")
    unseen = F.lit(float("inf")) if zero_df == "ieee" else F.lit(None).cast("double")
    return F.when(df > 0, F.log2(n_passages / df)).otherwise(unseen)


def term_frequency(tf: Column, n_words: Column) -> Column:
    return F.try_divide(tf.cast("double"), n_words.cast("double"))


def tfidf_of_share(tf: Column, n_words: Column, idf: Column) -> Column:
    """The share of the passage first, then times idf."""
    return term_frequency(tf, n_words) * idf


def tfidf_of_product(tf: Column, n_words: Column, idf: Column) -> Column:
    """Count times idf first, then divided by the length of the passage."""
    return F.try_divide(tf.cast("double") * idf, n_words.cast("double"))
