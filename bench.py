"""Time the headline jobs and print one JSON line.

Each job is planned and run in full (its staging included) into the noop sink. All jobs run once as a warm-up, then three
times in turn; the figure of a job is the median of the three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from passageloom.plans.catalogue import JOBS  # noqa: E402
from passageloom.session import local_session  # noqa: E402

HEADLINE = [
    "term_count",
    "passage_length",
    "vocabulary",
    "doc_frequency",
    "idf",
    "idf_fixed_vocab",
    "tfidf_sparse",
    "tfidf_fixed_vocab",
    "tfidf_dense",
    "tfidf_one_shot",
    "vector_norm",
    "similarity_rows",
    "best_passage",
    "best_passage_many_queries",
    "best_passage_all_vectors",
    "best_passage_requests",
    "passages_dedup",
    "passage_lookup",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    JOBS[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "passageloom-bench")
    names = sys.argv[1:] or HEADLINE
    rounds = [[run(spark, name, folder) for name in names] for _ in range(4)]
    seconds = {name: statistics.median(times) for name, *times in zip(names, *rounds[1:])}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
