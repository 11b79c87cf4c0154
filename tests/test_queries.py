"""Every query with SQL gives the rows DuckDB gives, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from rivulet.plans import ORACLES, QUERIES
from tools.check import TABLES, rows_sorted

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows_sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = rows_sorted([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: Fits that take minutes; tests/test_learning.py tests their operators.
LONG = {"choose_by_cv", "soft_vote", "batch_predict_censored", "prediction_summary", "permutation_importance",
        "random_forest", "train_text_classifier", "text_classifier_grid", "export_model", "silhouette_by_k", "segment_table", "lsa"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_runs_as_registered(spark, name):
    """Queries without SQL run to the end, with rows, and without a value that is not a number."""
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    assert not any(isinstance(v, float) and v != v for r in rows for v in r)
