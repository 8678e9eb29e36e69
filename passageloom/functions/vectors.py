"""Column expressions over embeddings (``array<double>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_product(a: Column, b: Column) -> Column:
    """Sum of products over the shorter of the two vectors, added from left to right."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; null where a norm is zero. Give the norms when they are already columns."""
    norm_a = norm(a) if norm_a is None else norm_a
    norm_b = norm(b) if norm_b is None else norm_b
    return F.try_divide(dot_product(a, b), norm_a * norm_b)


def cosine_or_zero_if_empty(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(cosine(a, b))


def embedding_of_text(text: Column) -> Column:
    """``v:v:...:v`` as an array of doubles; a piece that is not a number raises."""
    return F.split(text, ":").cast("array<double>")


def embedding_of_text_or_null(text: Column) -> Column:
    """As ``embedding_of_text``, but null when a piece is not a number."""
    numbers = F.transform(F.split(text, ":"), lambda piece: piece.try_cast("double"))
    return F.when(~F.exists(numbers, lambda x: x.isNull()), numbers)


def text_of_embedding(embedding: Column) -> Column:
    return F.array_join(embedding.cast("array<string>"), ":")
