"""Profiles kept by day: merged parts against the rows themselves."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tripflow.operators import profile as P
from tripflow.operators import silver as SV
from tripflow.sources.trips import read_trips


@pytest.fixture(scope="module")
def silver(spark):
    s = SV.build_silver(read_trips(spark, SF_CHECK)).cache()
    yield s
    s.unpersist()


def _same(got, want):
    assert {r.column_name for r in got} == {r.column_name for r in want}
    want = {r.column_name: r for r in want}
    for r in got:
        w = want[r.column_name]
        assert r.n_values == w.n_values and r.min_value == w.min_value and r.max_value == w.max_value
        assert math.isclose(r.mean, w.mean, rel_tol=1e-9) and math.isclose(r.stddev, w.stddev, rel_tol=1e-9)


def test_any_range_from_parts_only(spark, tmp_path, silver):
    path = str(tmp_path / "p")
    early = F.col("pickup_hour") < 9
    P.write_day_profiles(silver.filter(early), path, "a")
    P.write_day_profiles(silver.filter(~early), path, "b")
    P.write_day_profiles(silver.filter(~early), path, "b")  # a rerun replaces its part
    for first, last in (((2024, 1, 1), (2024, 1, 31)), ((2024, 1, 7), (2024, 1, 7)), ((2024, 1, 29), (2025, 2, 1))):
        rows = silver.filter(P.day_number().between(P.number_of(first), P.number_of(last)))
        got = P.read_day_profiles(spark, path, first, last)
        _same(got.collect(), P.profile(rows).collect())
        for r in P.exact_errors(rows, got).collect():
            assert r.distinct_error < 0.08 and r.median_rank_error < 0.03 and r.distinct_close and r.median_close
    assert P.read_day_profiles(spark, path, (2020, 1, 1), (2020, 1, 2)).collect() == []


def test_errors_over_many_values(spark, tmp_path):
    """A hot day, skewed values: the sketches' errors stay within their bounds."""
    rows = spark.range(300_000).select(
        F.lit(2024).alias("pickup_year"), F.lit(1).alias("pickup_month"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 20).cast("int").alias("pickup_day"), F.exp(F.rand(1) * 9).alias("trip_distance"), F.floor(F.rand(2) * 50).alias("fare_amount")
    )
    columns = ["trip_distance", "fare_amount"]
    P.write_day_profiles(rows, str(tmp_path / "p"), "x", columns)
    got = P.read_day_profiles(spark, str(tmp_path / "p"), (2024, 1, 0), (2024, 1, 31))
    for r in P.exact_errors(rows, got).collect():
        assert r.distinct_error < 0.05 and r.median_rank_error < 0.015


def test_nulls_nan_and_days_without_values(spark, tmp_path):
    nan = float("nan")
    rows = spark.createDataFrame(
        [(2024, 1, 1, 1.0), (2024, 1, 1, None), (2024, 1, 2, None), (2024, 1, 3, 3.0), (None, None, None, 9.0), (2024, 1, 4, nan)], "pickup_year int, pickup_month int, pickup_day int, trip_distance double"
    )
    path = str(tmp_path / "p")
    P.write_day_profiles(rows, path, "x", ["trip_distance"])
    (r,) = P.read_day_profiles(spark, path, (2024, 1, 1), (2024, 1, 3)).collect()
    assert (r.n_values, r.mean, r.min_value, r.max_value, r.n_distinct, r.q50) == (2, 2.0, 1.0, 3.0, 2, 1.0) and math.isclose(r.stddev, math.sqrt(2))
    (one,) = P.read_day_profiles(spark, path, (2024, 1, 1), (2024, 1, 1)).collect()
    assert one.n_values == 1 and one.stddev is None
    assert P.read_day_profiles(spark, path, (2024, 1, 2), (2024, 1, 2)).collect() == []
    (n,) = P.read_day_profiles(spark, path, (2024, 1, 3), (2024, 1, 4)).collect()
    assert n.n_values == 2 and math.isnan(n.max_value) and n.q50 == 3.0
