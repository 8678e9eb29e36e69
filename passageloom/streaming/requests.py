"""Requests as a stream: the unbounded form of asking for one query id after the other.

An answer depends on its own request only, so a micro-batch is the batch operator and no state is kept. The folder of
a micro-batch is named by its number and overwritten, so a batch that is repeated after a failure counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from passageloom.operators.requests import answer_requests
from passageloom.operators.retrieval import vector_sizes


def answer_request_stream(
    requests: DataFrame, queries: DataFrame, passages: DataFrame, output: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Answer a streaming table of ``request`` against static embeddings, into Parquet below ``output``."""

    sizes = vector_sizes(passages)  # the table is static: measured once, not for each micro-batch

    def answer(batch: DataFrame, number: int) -> None:
        answer_requests(batch, queries, passages, passage_sizes=sizes).write.mode("overwrite").parquet(f"{output}/batch={number}")

    stream = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
