"""Every registered query against its SQL, over the whole small tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from timelegs.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Training runs are covered by the modelling tests; here one model is enough.
ROWS_ONLY = {"split_summary", "model_comparison", "anomaly_scores", "feature_importance"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield connection
    connection.close()


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 6))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_only_trained_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    rows = df.collect()
    relation = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in relation.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, relation.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "time_of_day" and df.count() == 4
