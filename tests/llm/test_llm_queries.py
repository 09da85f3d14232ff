"""Registered queries: the SQL where there is one, and the whole table as the result."""

import pytest

from suite.check import differences, duck
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = {"op1": "pages", "op4": "pages", "op7": "embeddings"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_best_fit_packing", "op12_source_divergence"}))
def test_a_row_for_each_input_row(spark, name):
    table = TABLES.get(name.split("_")[0], "documents")
    key = {"pages": "page_id", "embeddings": "vec_id", "documents": "doc_id"}[table]
    want = spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()
    got = QUERIES[name](spark, SF).select(key).collect()
    assert sorted(want) == sorted(got)
