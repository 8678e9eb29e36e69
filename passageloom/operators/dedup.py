"""One row for each key, by a hash aggregate over numbers; the other columns take no part in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passageloom.operators.lookup import BROADCAST_BYTES, lookup_join
from passageloom.operators.staging import stage

#: Digits of a place: file number, start of the split in the file (counted backwards), line of the split (backwards).
FILE_DIGITS, BLOCK_DIGITS, LINE_DIGITS = 12, 16, 10


def place_of(file: Column, block: Column, line: Column) -> Column:
    """One number that orders lines: first file first, last line first. A decimal, which a hash aggregate updates in place."""

    def digits(number: Column, n: int) -> Column:
        return number.cast(f"decimal({n},0)")

    def shifted(number: Column, n: int) -> Column:
        return (number * F.lit("1" + "0" * n).cast(f"decimal({n + 1},0)")).cast("decimal(38,0)")

    backwards = F.lit(10**BLOCK_DIGITS - 1) - block
    late = shifted(digits(backwards, BLOCK_DIGITS), LINE_DIGITS) + digits(F.lit(10**LINE_DIGITS - 1) - line, LINE_DIGITS).cast("decimal(38,0)")
    return (shifted(digits(file, FILE_DIGITS), BLOCK_DIGITS + LINE_DIGITS) + late).cast("decimal(38,0)")


def least_place(rows: DataFrame, key: str, place: str, budget: int = BROADCAST_BYTES) -> DataFrame:
    """Of the rows of each key the one with the smallest place; ``rows`` is a staged table, so places are stored numbers.

    The aggregate reads and shuffles keys and places only, a hot key as one row for each task. Only keys that repeat are
    then looked up, so the other columns are not sorted, and not shuffled while those keys fit a broadcast. Rows of one
    key and place are the same line.
    """
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), F.min(place).alias("_least"))
    # A null key is a key as well, which a join does not meet.
    repeated = stage(found.where("_copies > 1"), "repeated-keys")
    none = repeated.where(F.col(key).isNull()).first()
    kept = lookup_join(rows, repeated.where(F.col(key).isNotNull()).select(key, "_least"), key, "left", budget=budget)
    least = F.coalesce("_least", F.when(F.col(key).isNull(), F.lit(None if none is None else none["_least"]).cast("decimal(38,0)")))
    return kept.where(least.isNull() | (F.col(place) == least)).select(*rows.columns)


def first_file_last_line(rows: DataFrame, key: str, file: Column, line: list[Column]) -> DataFrame:
    """Keep, for each key, the last line of the first file (by name) that has it.

    For tables whose files are named by strings. Both rules are one aggregate: the smallest (file, minus line position)
    wins. Its partial step runs before the shuffle, so a key with very many copies reaches the final step as one row for
    each task. ``line`` columns are numbers; every other column is kept.
    """
    values = [c for c in rows.columns if c != key]
    order = F.struct(file.alias("file"), *[(-position).alias(f"line{i}") for i, position in enumerate(line)])
    winner = rows.select(key, F.struct(*values).alias("_row"), order.alias("_order"))
    return winner.groupBy(key).agg(F.min_by("_row", "_order").alias("_row")).select(key, "_row.*")


def first_row(rows: DataFrame, key: str, position: Column) -> DataFrame:
    """Keep the first row of each key."""
    values = [c for c in rows.columns if c != key]
    winner = rows.select(key, F.struct(*values).alias("_row"), position.alias("_order"))
    return winner.groupBy(key).agg(F.min_by("_row", "_order").alias("_row")).select(key, "_row.*")
