"""The registered jobs against their SQL. All of them: python tests/oracle_check.py"""

import os

import pytest

import __spark_entry__ as entry
from passageloom.plans.catalogue import JOBS
from passageloom.plans.oracles import SQL
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "term_count", "doc_count", "idf_fixed_vocab", "tfidf_sparse", "tfidf_dense", "vector_norm", "cosine_pairs",
    "best_passage", "best_passage_many_queries", "passages_dedup", "embedding_parse", "embeddings_from_files",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not there")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_job_has_sql_that_runs(connection):
    assert JOBS.keys() == SQL.keys()
    assert JOBS.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
    for sql in entry.oracle_sql().values():
        connection.execute(f"EXPLAIN {sql}")


def test_entry(spark):
    assert entry.entry(spark).columns == ["passage_id", "word", "tfidf"]


@pytest.mark.parametrize("name", QUICK)
def test_job_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None
