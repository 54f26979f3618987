"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale so the suite stays quick; scripts/check_oracle.py runs
the same comparison at sf0.01."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tripflow.plans import catalog, oracle

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= E.queries().items() and ORACLE.items() <= E.oracle_sql().items()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_rides" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = df.collect()
    cur = duck.execute(ORACLE[name])
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dnames)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dnames, drows)


def test_rounding_is_tie_safe_and_equal_across_engines(spark):
    """Values a few ulps either side of an exact tie round the same way, in
    Spark and in the oracle's rewritten SQL."""
    from tripflow.functions.columns import round_doubles
    from tripflow.plans.oracle import _snap_rounds

    vals = [13.529687499999998, 13.5296875, 13.529687500000002, -2.0000005, 0.1, float("nan"), None]
    got = [r.x for r in round_doubles(spark.createDataFrame([(v,) for v in vals], "x double")).collect()]
    con = duckdb.connect()
    sql = _snap_rounds("SELECT round(x, 6) AS x FROM (SELECT unnest(?::DOUBLE[]) AS x, generate_subscripts(?::DOUBLE[], 1) AS i) ORDER BY i")
    want = [r[0] for r in con.execute(sql, [vals, vals]).fetchall()]
    assert got[:3] == [13.529688] * 3 and got[3] == -2.000001 and got[4] == 0.1
    assert [_norm(v) for v in got] == [_norm(v) for v in want]


def test_snap_rounds_rewrites_only_six_place_rounds():
    from tripflow.plans.oracle import _snap_rounds

    out = _snap_rounds("SELECT round(a / (b + 1), 6) AS x, round(c, 2) AS y, ground(d) AS z FROM t")
    assert "round(c, 2)" in out and "ground(d)" in out
    assert "TRY_CAST(a / (b + 1) AS DECIMAL(38, 9))" in out and out.count("DECIMAL(38, 9)") == 1
    # Every registered oracle runs as rewritten (no plain 6-place round left).
    assert all(", 6) AS DOUBLE)" in q or "round(" not in q for q in ORACLE.values())
