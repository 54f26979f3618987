"""Silver and gold semantics: the worked example (FIXTURES §4) and the
edge-case wire records (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import BASE, SF_CHECK, payloads, trip
from tripflow import schema as S
from tripflow.operators import gold as G
from tripflow.operators import silver as SV
from tripflow.operators.wire import from_wire


def silver_of(spark, records, **kw):
    return SV.build_silver(from_wire(payloads(spark, records)), **kw)


def test_worked_example_three_trips_one_gold_row(spark):
    a = trip()
    b = trip(tpep_pickup_datetime="2024-01-01 08:15:00", tpep_dropoff_datetime="2024-01-01 08:25:00", trip_distance=0.5, fare_amount=10.0, tip_amount=0.0, total_amount=12.0)
    c = trip(tpep_pickup_datetime="2024-01-01 08:50:00", tpep_dropoff_datetime="2024-01-01 09:50:00", trip_distance=25.5, fare_amount=50.0, tip_amount=10.0, total_amount=66.0)
    rows = G.build_gold(silver_of(spark, [a, b, c])).collect()
    assert len(rows) == 1
    g = rows[0].asDict()
    assert (g["pickup_year"], g["pickup_month"], g["pickup_day"], g["pickup_hour"]) == (2024, 1, 1, 8)
    assert g["pickup_day_of_week"] == 2  # Monday; 1 = Sunday
    assert (g["PULocationID"], g["DOLocationID"]) == (1, 2)
    assert g["total_rides"] == 3
    assert g["total_fare"] == 80 and g["total_tip"] == 15 and g["total_revenue"] == 108
    assert g["avg_fare"] == pytest.approx(26.6667, abs=1e-4)
    assert g["avg_tip_pct"] == pytest.approx(15.0)
    assert g["num_high_tip_trips"] == 1
    assert g["avg_trip_distance"] == pytest.approx(12.0)
    assert g["avg_trip_duration"] == pytest.approx(33.3333, abs=1e-4)
    assert g["sum_trip_distance"] == pytest.approx(36.0)
    assert (g["num_long_trips"], g["num_short_trips"], g["num_rush_hour_rides"]) == (1, 1, 3)
    assert g["revenue_per_mile"] == pytest.approx(3.0)
    assert g["avg_revenue_per_ride"] == pytest.approx(36.0)
    assert g["avg_speed_mph"] == pytest.approx(21.6)
    assert g["tip_per_mile"] == pytest.approx(0.4167, abs=1e-4)


def test_schemas_match_contract(spark):
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    s = silver_of(spark, [trip()])
    assert shape(s.schema) == shape(S.SILVER)
    assert shape(G.build_gold(s).schema) == shape(S.GOLD)


@pytest.mark.parametrize(
    "record, kept",
    [
        (trip(), True),  # 1
        ("garbage", False),  # 2
        (None, False),  # 3
        ('{"VendorID": "1", "passenger_count": "x"}', False),  # 4
        (trip(VendorID=1), True),  # 7 number → text
        (trip(unknown_field=5), True),  # 8
        (trip(tpep_pickup_datetime=...), False),  # 11
        (trip(fare_amount=0.0), False),  # 12
        (trip(fare_amount=-5.0), False),  # 12
    ],
)
def test_edge_records_kept_or_dropped(spark, record, kept):
    assert silver_of(spark, [record]).count() == (1 if kept else 0)


def test_nan_measure_passes_filter_unless_nulled(spark):
    # 5: bare NaN token; NaN > 0 is true in Spark.
    rec = '{"VendorID":"1","tpep_pickup_datetime":"2024-01-01 08:00:00","tpep_dropoff_datetime":"2024-01-01 08:30:00","passenger_count":NaN,"trip_distance":10.0,"fare_amount":20.0,"total_amount":30.0,"tip_amount":5.0}'
    rows = silver_of(spark, [rec]).collect()
    assert len(rows) == 1 and math.isnan(rows[0]["passenger_count"])
    assert silver_of(spark, [rec], nan_policy="null").count() == 0


def test_nan_string_kept_or_nulled(spark):
    # 6: NaN token in a string field.
    rec = '{"VendorID":"1","tpep_pickup_datetime":"2024-01-01 08:00:00","tpep_dropoff_datetime":"2024-01-01 08:30:00","passenger_count":1,"trip_distance":10.0,"fare_amount":20.0,"total_amount":30.0,"store_and_fwd_flag":NaN}'
    kept = silver_of(spark, [rec]).collect()
    assert len(kept) == 1 and "NaN" in kept[0]["store_and_fwd_flag"]
    assert silver_of(spark, [rec], nan_policy="null").collect()[0]["store_and_fwd_flag"] is None


@pytest.mark.parametrize("pickup", ["2024-01-01T08:00:00", "2024-01-01 08:00:00.5"])
def test_bad_timestamp_fails_or_is_diverted(spark, pickup):
    # 9, 10: strict pattern under ANSI.
    df = silver_of(spark, [trip(tpep_pickup_datetime=pickup)])
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.collect()
    ok, bad = SV.divert_unparsable(SV.clean(from_wire(payloads(spark, [trip(tpep_pickup_datetime=pickup), trip()]))))
    assert ok.count() == 1 and bad.count() == 1
    nulled = silver_of(spark, [trip(tpep_pickup_datetime=pickup)], on_bad_value="null").collect()
    assert nulled[0][S.PICKUP_TS] is None


def test_strict_thresholds(spark):
    # 13, 14
    rows = silver_of(spark, [trip(trip_distance=20.0), trip(trip_distance=1.0), trip(tip_amount=4.0)]).collect()
    assert [(r.is_long_trip, r.is_short_trip) for r in rows[:2]] == [(0, 0), (0, 0)]
    assert rows[2].tip_pct == pytest.approx(20.0) and rows[2].high_tip_flag == 0


def test_missing_tip_is_null_pct_and_ignored_by_avg(spark):
    # 15
    s = silver_of(spark, [trip(tip_amount=...), trip()])
    rows = s.orderBy(F.col("tip_pct").asc_nulls_first()).collect()
    assert rows[0].tip_pct is None and rows[0].high_tip_flag == 0
    g = G.build_gold(s).collect()[0]
    assert g.avg_tip_pct == pytest.approx(25.0) and g.total_rides == 2


def test_negative_duration_kept_and_speed_guarded(spark):
    # 16
    s = silver_of(spark, [trip(tpep_dropoff_datetime="2024-01-01 07:50:00")])
    assert s.collect()[0].trip_duration_minutes == pytest.approx(-10.0)
    assert G.build_gold(s).collect()[0].avg_speed_mph == 0.0


def test_rush_hour_inclusive_ranges(spark):
    # 17
    hours = [6, 7, 10, 11, 15, 16, 19, 20]
    recs = [trip(tpep_pickup_datetime=f"2024-01-01 {h:02d}:30:00", tpep_dropoff_datetime=f"2024-01-01 {h:02d}:45:00") for h in hours]
    flagged = G.add_rush_hour(silver_of(spark, recs)).orderBy("pickup_hour").collect()
    assert [r.rush_hour_flag for r in flagged] == [0, 1, 1, 0, 0, 1, 1, 0]


def test_null_zone_forms_own_group(spark):
    # 18
    g = G.build_gold(silver_of(spark, [trip(PULocationID=...), trip()])).collect()
    assert sorted((r.PULocationID is None, r.total_rides) for r in g) == [(False, 1), (True, 1)]


def test_nan_zone_cast_fails_or_nulls(spark):
    # 19
    rec = '{"VendorID":"1","tpep_pickup_datetime":"2024-01-01 08:00:00","tpep_dropoff_datetime":"2024-01-01 08:30:00","passenger_count":1,"trip_distance":10.0,"fare_amount":20.0,"total_amount":30.0,"PULocationID":NaN}'
    s = silver_of(spark, [rec])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        G.build_gold(s).collect()
    assert G.build_gold(s, on_bad_value="null").collect()[0].PULocationID is None


def test_untyped_text_measure_cast(spark):
    # 20
    df = spark.createDataFrame([("abc", "1", "10", "30", "5")], "fare_amount string, passenger_count string, trip_distance string, total_amount string, tip_amount string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        SV.cast_measures(df).collect()
    assert SV.cast_measures(df, on_bad_value="null").collect()[0].fare_amount is None


def test_bronze_json_bad_double_reads_null(spark, tmp_path):
    # 21
    from tripflow.sources.files import read_bronze

    p = tmp_path / "bronze"
    p.mkdir()
    rec = dict(BASE, fare_amount="abc")
    import json

    (p / "part-0.json").write_text(json.dumps(rec) + "\n")
    df = read_bronze(spark, str(p))
    assert df.collect()[0].fare_amount is None
    assert SV.build_silver(df).count() == 0


def test_reject_report_counts_each_rule(spark):
    recs = [trip(), trip(fare_amount=0.0), trip(passenger_count=...), trip(tpep_dropoff_datetime=...), trip(fare_amount=0.0, total_amount=-1.0)]
    got = {r.rule: r.rejected for r in SV.reject_report(from_wire(payloads(spark, recs))).collect()}
    assert got["fare_amount_positive"] == 2
    assert got["total_amount_positive"] == 1
    assert got["passenger_count_positive"] == 1
    assert got["dropoff_present"] == 1
    assert got["any_rule"] == 4 and got["rows_in"] == 5


def test_derived_averages_equal_avg_exactly(spark):
    """avg_fare / avg_trip_distance from sums and ride counts are bit-equal to
    ``avg`` over silver, where the quality rules leave no nulls."""
    from tripflow.plans import catalog as K

    s = G.add_rush_hour(G.cast_zone_ids(K.silver(spark, SF_CHECK)))
    new = G.aggregate(s).select(*S.GOLD_KEYS, "avg_fare", "avg_trip_distance")
    old = s.groupBy(*S.GOLD_KEYS).agg(F.avg("fare_amount").alias("o_fare"), F.avg("trip_distance").alias("o_dist"))
    j = new.join(old, [new[k].eqNullSafe(old[k]) for k in S.GOLD_KEYS])
    assert j.count() == new.count()
    assert j.filter((F.col("avg_fare") != F.col("o_fare")) | (F.col("avg_trip_distance") != F.col("o_dist"))).count() == 0
