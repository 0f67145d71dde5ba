"""Every registered query against its DuckDB oracle (row count, column names, value hash)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import TABLES, digest
from tripmart import catalog, oracle

SF = "/root/testdata/sf0.001"
KEYS = sorted(catalog.queries())  # the text operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    hs, sc, _ = digest(df.columns, s_rows)
    hd, dc, _ = digest(d_cols, d_rows)
    assert sc == dc
    assert len(s_rows) == len(d_rows)
    assert hs == hd


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["borough", "trips"] and len(rows) == 5


from tripmart.presentation import NULLABLE_INT_OUTPUTS  # noqa: E402

PRESENTED = sorted(set(NULLABLE_INT_OUTPUTS) | {"date_series", "dim_date", "date_range", "stg_trips"})


@pytest.mark.parametrize("key", PRESENTED)
def test_query_matches_oracle_through_pandas(spark, duck, key):
    """Nullable ints and dates are presented so that pandas conversions of both engines agree too."""
    a = queries()[key](spark, SF).toPandas().astype(str)
    b = duck.execute(oracle_sql()[key]).df().astype(str)
    ha, _, _ = digest(list(a.columns), [tuple(r) for r in a.values.tolist()])
    hb, _, _ = digest(list(b.columns), [tuple(r) for r in b.values.tolist()])
    assert ha == hb
