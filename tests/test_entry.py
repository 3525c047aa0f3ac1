import importlib

import duckdb
import pytest

from orderlens.plans import queries as Q

E = importlib.import_module("__spark_entry__")

TABLES = ["part", "orders", "lineitem"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["user_id", "snapshot_date"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    """Of the library itself: a training-data query that SQL can't express has none."""
    own = set(Q.queries())
    assert own == set(Q.oracle_sql()) and own <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: repr(float(v)) if isinstance(v, float) else (None if v is None else str(v))
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["clv_daily", "clv_month_end", "rfm", "churn", "sales_trends",
                                  "loyalty_impact", "location_performance", "addon_revenue",
                                  "qc_report", "rfm_score_mix"])
def test_query_matches_oracle_small(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = E.queries()[name](spark, sf_small)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want
