"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from opsledger.plans.catalog import QUERIES
from opsledger.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return ""
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, bool) or type(v).__name__ == "bool":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, FOLDER).toPandas()
    expected = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(found.columns) == sorted(expected.columns)
    assert canonical(found) == canonical(expected)


def test_every_question_with_a_customer_gets_its_status(spark):
    customers = {r["c_custkey"]: r["c_mktsegment"] for r in spark.read.parquet(f"{FOLDER}/customer.parquet").collect()}
    found = {r["query_id"]: r["status"] for r in QUERIES["ask_questions_all"](spark, FOLDER).collect()}
    assert any(q % 2 for q in found) and found == {q: customers.get(q) for q in found}
