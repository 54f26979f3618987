"""Plan shape: pruning, pushdown, one shuffle for gold, no Python in rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow.operators import gold as G
from tripflow.operators import sample as SM
from tripflow.operators import silver as SV
from tripflow.plans import catalog as K
import plan_inspect as PI
from tripflow.sinks.files import write_partitioned
from tripflow.sources import files as SF
from tripflow.sources.trips import read_trips


def test_gold_has_exactly_one_hash_exchange_with_partial_agg(spark):
    g = K.gold(spark, SF_SMALL)
    ex = PI.exchanges(g)
    assert len(ex) == 1 and "hashpartitioning(pickup_year" in ex[0]
    assert "partial_count" in PI.plan_text(g) or "partial_sum" in PI.plan_text(g)


def test_gold_scan_reads_only_needed_columns(spark, tmp_path):
    write_partitioned(K.silver(spark, SF_SMALL), str(tmp_path / "s"))
    (schema,) = PI.read_schemas(G.build_gold(SF.read_table(spark, str(tmp_path / "s"))))
    read = {f.split(":")[0] for f in schema.removeprefix("struct<").removesuffix(">").split(",")}
    # 17 columns feed gold; the three of the day come from folder names.
    assert read == {
        "pickup_hour", "pickup_day_of_week", "pickup_day_of_month", "PULocationID", "DOLocationID", "fare_amount", "tip_amount", "total_amount",
        "tip_pct", "high_tip_flag", "trip_distance", "trip_duration_minutes", "is_long_trip", "is_short_trip",
    }


def test_no_python_evaluation_anywhere(spark):
    qs = K.queries()
    for name in ["gold_trip_kpis", "silver_trips", "wire_decode", "reject_report", "silver_profile", "tip_patterns", "busiest_zones"]:
        assert not PI.uses_python(qs[name](spark, SF_SMALL)), name


def test_day_read_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "gold")
    write_partitioned(K.gold(spark, SF_SMALL), root)
    day = SF.read_day(spark, root, 2024, 1, 15)
    (pf,) = PI.partition_filters(day)
    assert "pickup_day" in pf and "15" in pf
    assert "PartitionFilters" in PI.plan_text(day) and day.count() > 0


def test_parquet_filters_pushed_to_scan(spark, tmp_path):
    root = str(tmp_path / "silver")
    write_partitioned(K.silver(spark, SF_SMALL), root)
    df = SF.read_table(spark, root).filter(F.col("fare_amount") > 10).select("fare_amount", "pickup_day")
    (pushed,) = PI.pushed_filters(df)
    assert "GreaterThan(fare_amount,10.0)" in pushed
    (schema,) = PI.read_schemas(df)
    assert schema == "struct<fare_amount:double>"


def test_partitioned_write_rebalances_by_day(spark):
    silver = K.silver(spark, SF_SMALL).hint("rebalance", "pickup_year", "pickup_month", "pickup_day")
    assert "RebalancePartitions" in PI.plan_text(silver, "extended")


def test_reports_pre_aggregate_before_joins(spark):
    from tripflow.operators import reports as R
    from tripflow.sources.trips import read_zones

    plan = PI.plan_text(R.borough_routes(K.gold(spark, SF_SMALL), read_zones(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan
    # The join's probe side is the route aggregate, not trip rows.
    join_at = plan.index("BroadcastHashJoin")
    assert "HashAggregate" in plan[join_at:]


def test_spread_sample_scans_data_once(spark):
    pos = SM.with_position(read_trips(spark, SF_SMALL, keep=("_file", "_row")))
    sample = SM.spread_sample(pos.df, pos.total, 105, 10, seed=1)
    plan = PI.plan_text(sample)
    assert sum("event_id" in r for r in PI.read_schemas(sample)) == 1
    assert not [e for e in PI.exchanges(sample) if "hashpartitioning(_file" in e]  # the offset table is broadcast


def test_silver_stays_map_only(spark):
    assert PI.exchanges(SV.build_silver(read_trips(spark, SF_SMALL))) == []
    assert len(PI.exchanges(G.build_gold(SV.build_silver(read_trips(spark, SF_SMALL))))) == 1


@pytest.mark.parametrize("name", ["reject_report", "silver_profile"])
def test_global_aggregates_ship_one_row_per_task(spark, name):
    ex = PI.exchanges(K.queries()[name](spark, SF_SMALL))
    assert ex and all("SinglePartition" in e for e in ex)


def test_refresh_equals_full_rebuild(spark, tmp_path):
    from tripflow import schema as S
    from tripflow.plans import jobs as J

    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitioned(K.silver(spark, SF_SMALL), silver_root)
    write_partitioned(G.build_gold(SF.read_table(spark, silver_root).filter(F.col("pickup_day") != 7)), gold_root)
    days = SF.list_partitions(spark, silver_root).filter(F.col("pickup_day") == 7)
    out = J.refresh_gold_days(spark, silver_root, gold_root, days)
    full = K.gold(spark, SF_SMALL)
    from tripflow.functions.columns import round_doubles

    def rows(df):  # sums of doubles depend on order: compare at 9 places
        return sorted(map(tuple, round_doubles(df.select(*S.GOLD.names), 9).collect()), key=repr)

    assert rows(out) == rows(full)


def test_refresh_from_a_day_list_equals_full_rebuild(spark, tmp_path):
    from tripflow import schema as S
    from tripflow.functions.columns import round_doubles
    from tripflow.plans import jobs as J

    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitioned(K.silver(spark, SF_SMALL), silver_root)
    write_partitioned(G.build_gold(SF.read_table(spark, silver_root).filter(~F.col("pickup_day").isin(7, 8))), gold_root)
    out = J.refresh_gold_days(spark, silver_root, gold_root, [(2024, 1, 7), (2024, 1, 8), (2024, 1, 7)])

    def rows(df):
        return sorted(map(tuple, round_doubles(df.select(*S.GOLD.names), 9).collect()), key=repr)

    assert rows(out) == rows(K.gold(spark, SF_SMALL))


# Where a registered query may bring rows into one partition, and why that is
# bounded whatever the data size. Anything else doing so is a scale bug.
BOUNDED_SINGLE_PARTITION = {
    "reject_report": "global aggregate: one partial row per task",
    "table_counts": "global aggregates: one partial row per task",
    "silver_profile": "global aggregate: one partial row per task",
    "preview": "a limit's few rows",
    "schema_check": "global aggregate: one partial row per task",
    "sample_head": "running sum over one row per range of files",
    "sample_spread": "running sum over one row per range of files",
    "sample_spread_7": "running sum over one row per range of files",
    "sample_half": "running sum over one row per range of files",
    "ingest_quarantine": "global aggregate: one partial row per task",
    "busiest_zones": "rank over the k rows of a top-k",
}


def test_single_partition_only_where_bounded_and_no_python(spark):
    for name, fn in K.queries().items():
        df = fn(spark, SF_SMALL)
        assert not PI.uses_python(df), name  # every query stays in the JVM
        lines = PI.physical_section(df).splitlines()
        at = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
        if not at:
            continue
        assert name in BOUNDED_SINGLE_PARTITION, name
        if name not in ("busiest_zones", "preview", "sample_head", "sample_spread", "sample_spread_7", "sample_half"):  # the others carry partial aggregates only
            assert all("HashAggregate" in lines[i + 1] for i in at), name
