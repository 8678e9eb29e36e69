"""Embedding tables: (id bigint, embedding array<double>, pos struct of numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.functions.vectors import embedding_of_text_or_null
from passageloom.operators.staging import spread
from passageloom.sources.files import read_lines, with_file_number

# Fixed value: an id is read from the digits at the start of its field, and what follows them is ignored.
_LEADING_DIGITS = "^([0-9]+)"


def parse_embedding_lines(lines: DataFrame) -> DataFrame:
    """Add ``id``, ``embedding`` and ``error`` (null for a good line) to rows with a ``value`` of ``id,v:v:...:v``."""
    fields = F.split(F.col("value"), ",")
    split = lines.withColumn("_fields", fields)
    digits = F.regexp_extract(F.get(F.col("_fields"), F.lit(0)), _LEADING_DIGITS, 1)
    parsed = split.withColumn("_id", F.when(digits != "", digits.try_cast("bigint"))).withColumn(
        "_embedding", embedding_of_text_or_null(F.get(F.col("_fields"), F.lit(1)))
    )
    error = (
        F.when(F.size("_fields") != 2, F.concat(F.lit("invalid line: "), F.col("value")))
        .when(F.col("_id").isNull(), F.concat(F.lit("invalid id: "), F.col("value")))
        .when(F.col("_embedding").isNull(), F.concat(F.lit("invalid number: "), F.col("value")))
    )
    good = error.isNull()
    return parsed.select(
        *lines.columns,
        F.when(good, F.col("_id")).alias("id"),
        F.when(good, F.col("_embedding")).alias("embedding"),
        error.alias("error"),
    )


def read_embeddings(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Read ``id,v:v:...:v`` lines with the position of each row (``pos``: file by name, then place in the file).

    The first bad line fails the job; with ``on_error="drop"`` bad lines are left out (see ``rejected_embeddings``).
    """
    if on_error not in ("raise", "drop"):
        raise ValueError(f"on_error must be 'raise' or 'drop', not {on_error!r}")
    parsed = parse_embedding_lines(with_file_number(spark, read_lines(spark, path), path))
    if on_error == "raise":
        # In the filter, so that the check runs whichever columns are used later.
        parsed = parsed.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("error")).cast("boolean")))
    else:
        parsed = parsed.where(F.col("error").isNull())
    return parsed.select("id", "embedding", F.struct("file", "block", "row").alias("pos"))


def rejected_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """(value, error) of the bad lines of an embeddings file."""
    return parse_embedding_lines(read_lines(spark, path)).where(F.col("error").isNotNull()).select("value", "error")


def embeddings_of_table(table: DataFrame, id_column: str, embedding_column: str) -> DataFrame:
    """A table of vectors as (id, embedding). Without a position, equal scores are decided by the larger id."""
    rows = table.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(embedding_column).cast("array<double>").alias("embedding")
    )
    return spread(rows, "id")
