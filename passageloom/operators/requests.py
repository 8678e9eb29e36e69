"""Best passages for a table of requested query ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passageloom.operators.dedup import first_row
from passageloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup_join
from passageloom.operators.retrieval import SLICE_BYTES, best_passages
from passageloom.operators.staging import stage

# Fixed value: a request is a whole number, blanks allowed before it and nothing after it.
_REQUEST = r"\A\s*-?[0-9]+\z"


def first_query_of_id(queries: DataFrame) -> DataFrame:
    """(id, embedding): of several queries with one id the first by ``pos``, or the smallest vector without ``pos``."""
    if "pos" not in queries.columns:
        return queries.groupBy("id").agg(F.min("embedding").alias("embedding"))
    return first_row(queries.select("id", "embedding", "pos"), "id", F.col("pos")).select("id", "embedding")


def answer_requests(
    requests: DataFrame,
    queries: DataFrame,
    passages: DataFrame,
    slice_bytes: int = SLICE_BYTES,
    budget: int = BROADCAST_BYTES,
    passage_sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Answer each ``request`` (text): add ``query_id``, ``status`` and ``passage_id``.

    The status is ``ok``, ``not_found`` (no query has this id) or ``invalid`` (not a number). Each requested query is
    scored once, however often it is asked for.
    """
    text = F.col("request")
    parsed = requests.withColumn("query_id", F.when(text.rlike(_REQUEST), text.try_cast("bigint")))
    valid = F.coalesce(text.rlike(_REQUEST), F.lit(False))
    wanted = parsed.where(F.col("query_id").isNotNull()).select(F.col("query_id").alias("id")).distinct()
    wanted = stage(wanted, "requested-ids")
    if fits_broadcast(wanted, "id", budget):
        asked = first_query_of_id(queries.join(F.broadcast(wanted), "id", "left_semi"))
    else:
        asked = first_query_of_id(queries.join(wanted, "id", "left_semi"))
    answers = best_passages(stage(asked, "requested-queries"), passages, budget=slice_bytes, passage_sizes=passage_sizes)
    answers = stage(answers.select("query_id", "passage_id", F.lit(True).alias("_found")), "answers")
    status = F.when(~valid, "invalid").when(F.col("_found").isNull(), "not_found").otherwise("ok")
    return lookup_join(parsed, answers, "query_id", "left", budget=budget).select(
        *requests.columns, "query_id", status.alias("status"), "passage_id"
    )
