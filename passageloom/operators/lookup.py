"""Join of many rows to a table with one row for each key, safe for skewed keys and for a table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.operators.staging import stage

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64


def key_bytes(key: str) -> Column:
    return F.octet_length(F.col(key).cast("string")) + F.lit(_ROW_OVERHEAD)


def payload_bytes(table: DataFrame, key: str) -> Column:
    """Estimate of what the columns beside the key take in one row."""
    total = F.lit(0).cast("bigint")
    for field in table.schema.fields:
        column = F.col(field.name)
        if field.name == key:
            continue
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif isinstance(field.dataType, T.ArrayType):
            total = total + F.coalesce(F.size(column), F.lit(0)) * 8 + 24
        else:
            total = total + 8
    return total


def table_bytes(table: DataFrame, key: str) -> tuple[int, int]:
    """What a broadcast of the table takes, and the widest payload of a row."""
    payload = payload_bytes(table, key)
    sizes = table.agg(
        F.coalesce(F.sum(key_bytes(key) + payload), F.lit(0)).alias("total"),
        F.coalesce(F.max(payload), F.lit(0)).alias("widest"),
    ).first()
    return sizes["total"], sizes["widest"]


def fits_broadcast(table: DataFrame, key: str, budget: int = BROADCAST_BYTES) -> bool:
    return table_bytes(table, key)[0] <= budget


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    budget: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Attach the columns of ``table`` to ``facts``.

    ``table`` is staged and has one row for each key. While it stays below ``budget`` bytes it is broadcast and
    ``facts`` is not shuffled. Beyond that the frequent keys are broadcast and only the rare ones are shuffled: with n
    the rows of a key in ``facts``, c at least the bytes of its table row and W the sum of all n * c, a key is frequent
    when n > W / budget. The frequent rows then take less than ``budget`` bytes together (sum c < sum n * c * budget
    / W <= budget), and no rare key has more than W / budget rows, so the shuffled part has no skew.

    ``counts`` (key, n) holds the rows of ``facts`` for each key, if the caller has them. ``stored`` tells that ``facts`` are
    read from a stored table: beyond the budget they are then read twice, and the frequent rows are not shuffled at all.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    total, widest = table_bytes(table, key)
    if total <= budget:
        return facts.join(F.broadcast(table), key, how)

    if counts is None:
        counts = stage(facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), "key-counts")
    row = (key_bytes(key) + F.lit(widest)).cast("double")
    volume = counts.agg(F.sum(F.col("n") * row).alias("volume")).first()["volume"] or 0.0
    frequent = counts.where(F.col("n") > F.lit(volume / max(budget, 1))).select(key)

    if stored:
        known = table.join(F.broadcast(frequent), key, "left_semi")
        near = facts.join(F.broadcast(frequent.join(F.broadcast(known), key, how)), key)
        rest = facts.where(F.col(key).isNotNull()).join(F.broadcast(frequent), key, "left_anti").join(table, key, how)
        parts = near.unionByName(rest)
        if how == "left":
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name != key]
            parts = parts.unionByName(facts.where(F.col(key).isNull()).select(*facts.columns, *nulls))
        return parts.select(*facts.columns, *[c for c in table.columns if c != key])

    # One evaluation of the facts: the broadcast leaves a payload on the frequent rows. These then have no key any more,
    # and a salt in its place, so they match nothing in the shuffled join and are spread over its tasks.
    known = table.join(F.broadcast(frequent), key, "left_semi").withColumn("_is_known", F.lit(True))
    payload = [c for c in table.columns if c != key]
    near = frequent.join(F.broadcast(known), key, "left").select(
        F.col(key).alias("_frequent"), F.struct(*payload).alias("_near"), F.col("_is_known")
    )
    marked = facts.join(F.broadcast(near), F.col(key) == F.col("_frequent"), "left")
    settled = F.col("_frequent").isNotNull() | F.col(key).isNull()
    marked = marked.withColumns(
        {
            "_rare": F.when(~settled, F.col(key)),
            "_salt": F.when(settled, 1 + F.pmod(F.xxhash64(*facts.columns), F.lit(2**31 - 1))).otherwise(F.lit(0)),
        }
    )
    far = table.select(F.col(key).alias("_rare_key"), F.struct(*payload).alias("_far"), F.lit(0).cast("bigint").alias("_zero"))
    both = marked.join(far, (F.col("_rare") == F.col("_rare_key")) & (F.col("_salt") == F.col("_zero")), "left")
    joined = both.select(*facts.columns, F.coalesce("_near", "_far").alias("_payload"), (F.col("_rare_key").isNotNull() | F.coalesce("_is_known", F.lit(False))).alias("_hit"))
    if how == "inner":
        joined = joined.where("_hit")
    return joined.select(*facts.columns, *[F.col(f"_payload.{c}").alias(c) for c in payload])
