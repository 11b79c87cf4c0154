import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, kind, rows_sorted


@pytest.fixture
def agrees(spark):
    """Run a registered query and its SQL on one folder and compare columns, types and rows."""

    def run(name, sf="/root/testdata/sf0.001"):
        df = entry.queries()[name](spark, sf)
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        cur = con.execute(entry.oracle_sql()[name])
        types = {d[0]: kind(str(d[1])) for d in cur.description}
        want = rows_sorted([d[0] for d in cur.description], cur.fetchall())
        got = rows_sorted(df.columns, [tuple(r) for r in df.collect()])
        assert got == want
        assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types

    return run
