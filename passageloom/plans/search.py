"""Whole jobs over embedding files: batch answers and answers to requested ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passageloom.operators.requests import answer_requests
from passageloom.operators.retrieval import best_passages
from passageloom.operators.staging import stage
from passageloom.sinks.files import write_answers
from passageloom.sources.embeddings import read_embeddings


def answer_all(
    spark: SparkSession, queries: str, passages: str, output: str | None = None, on_error: str = "raise"
) -> DataFrame:
    """(query_id, passage_id, score) for every query of a file. Passages are parsed once into a columnar table."""
    answers = best_passages(
        read_embeddings(spark, queries, on_error), stage(read_embeddings(spark, passages, on_error), "passage-vectors")
    )
    if output is not None:
        write_answers(answers, output)
    return answers


def answer_requested(
    spark: SparkSession, requests: DataFrame, queries: str, passages: str, on_error: str = "raise"
) -> DataFrame:
    """Answers to a table of requested query ids (column ``request``)."""
    return answer_requests(
        requests,
        stage(read_embeddings(spark, queries, on_error), "query-vectors"),
        stage(read_embeddings(spark, passages, on_error), "passage-vectors"),
    )
