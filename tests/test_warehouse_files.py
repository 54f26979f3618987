"""Round trips: partitioned Parquet, CSV, JDBC warehouse (embedded Derby)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import schema as S
from tripflow.operators import gold as G
from tripflow.operators import silver as SV
from tripflow.plans import jobs as J
from tripflow.sinks.files import write_csv, write_partitioned, write_table
from tripflow.sinks.warehouse import load_warehouse, write_warehouse
from tripflow.sources import files as SF
from tripflow.sources.trips import read_trips
from tripflow.sources.warehouse import read_warehouse

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def gold_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold") / "gold")
    write_partitioned(G.build_gold(SV.build_silver(read_trips(spark, SF_SMALL))), root)
    return root


def test_bronze_silver_gold_jobs(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    write_table(t, str(tmp_path / "bronze"), "json", "overwrite")
    stats = {}
    silver = J.silver_job(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), stats=stats)
    assert stats == {"rows_in": 1000, "rows_out": 769}  # counted during the write
    gold = J.gold_job(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))
    expect = G.build_gold(SV.build_silver(t))
    assert silver.count() == SV.build_silver(t).count()
    assert _rows(gold, S.GOLD.names) == _rows(expect, S.GOLD.names)
    # Partition columns are discovered as int from the folder names.
    assert dict(silver.dtypes)["pickup_day"] == "int"


def test_dynamic_overwrite_replaces_only_given_days(spark, tmp_path):
    t = SV.build_silver(read_trips(spark, SF_SMALL))
    root = str(tmp_path / "silver")
    write_partitioned(t, root)
    day1 = t.filter(F.col("pickup_day") == 1)
    write_partitioned(day1.limit(1), root, dynamic=True)
    back = SF.read_table(spark, root)
    assert back.filter(F.col("pickup_day") == 1).count() == 1
    assert back.filter(F.col("pickup_day") != 1).count() == t.filter(F.col("pickup_day") != 1).count()


def test_read_day_keeps_partition_columns(spark, gold_root):
    day = SF.read_day(spark, gold_root, 2024, 1, 15)
    rows = day.collect()
    assert rows and all((r.pickup_year, r.pickup_month, r.pickup_day) == (2024, 1, 15) for r in rows)


def test_list_partitions(spark, gold_root):
    parts = SF.list_partitions(spark, gold_root).collect()
    assert len(parts) == 30 and all(p.pickup_year == 2024 for p in parts)


def test_csv_roundtrip(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    write_csv(t, str(tmp_path / "csv"))
    assert _rows(SF.read_csv(spark, str(tmp_path / "csv")), S.TRIP.names) == _rows(t, S.TRIP.names)


def test_missing_raw_parquet_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        SF.read_raw_parquet(spark, str(tmp_path / "nope.parquet"))


def test_warehouse_recreate_truncate_append(spark, tmp_path, gold_root):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    gold = SF.read_table(spark, gold_root)
    n = gold.count()
    write_warehouse(gold, url, "gold_aggregates", "recreate", properties=DERBY, num_partitions=2)
    write_warehouse(gold, url, "gold_aggregates", "append", properties=DERBY)
    assert read_warehouse(spark, url, "gold_aggregates", DERBY).count() == 2 * n
    write_warehouse(gold, url, "gold_aggregates", "truncate", properties=DERBY)
    back = read_warehouse(spark, url, "gold_aggregates", DERBY, "pickup_day", 1, 32, 4)
    assert back.count() == n
    # The partition columns arrive filled, with the contract's types.
    assert back.filter(F.col("pickup_year").isNull()).count() == 0
    assert dict(back.dtypes)["total_rides"] == "bigint" and dict(back.dtypes)["pickup_day"] == "int"
    assert _rows(back, S.GOLD.names) == _rows(gold, S.GOLD.names)


def test_load_summary_counts_during_write(spark, tmp_path, gold_root):
    url = f"jdbc:derby:{tmp_path}/db2;create=true"
    gold = SF.read_table(spark, gold_root)
    summary = load_warehouse(gold, url, "gold_aggregates", properties=DERBY)
    assert summary.rows == gold.count() and summary.partitions == 30


def test_bad_policy(spark, gold_root):
    with pytest.raises(ValueError):
        write_warehouse(SF.read_table(spark, gold_root), "jdbc:derby:memory:x", "t", "upsert")


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """A day holding a third of all rows is split by the rebalance, not
    written by one task (adaptive skew split of the rebalance shuffle)."""
    import os

    from tripflow.sources.trips import read_trips as rt

    # Many input tasks, as many input files give at scale (the test table is
    # one row group; AQE splits a skewed partition along map outputs).
    t = SV.build_silver(rt(spark, "/root/testdata/sf0.1")).repartition(16)
    # Move a third of the rows onto day 1.
    hot = t.withColumn("pickup_day", F.when(F.xxhash64("tip_amount", "fare_amount") % 3 == 0, F.lit(1)).otherwise(F.col("pickup_day")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        write_partitioned(hot, str(tmp_path / "s"))
    finally:
        spark.conf.set(key, old)
    day1 = tmp_path / "s" / "pickup_year=2024" / "pickup_month=1" / "pickup_day=1"
    files = [f for f in os.listdir(day1) if f.endswith(".parquet")]
    assert len(files) > 2
    back = SF.read_table(spark, str(tmp_path / "s"))
    assert back.count() == hot.count()


def test_load_verifies_and_reloads_on_duplicates(spark, tmp_path, gold_root, monkeypatch):
    """A staging table that ends up with extra rows (as a re-run task after a
    lost executor would leave) is loaded again before it goes live."""
    import tripflow.sinks.warehouse as WH

    url = f"jdbc:derby:{tmp_path}/db3;create=true"
    gold = SF.read_table(spark, gold_root)
    real_write = WH.write_warehouse
    calls = []

    def flaky_write(df, url_, table, policy, **kw):
        calls.append(policy)
        real_write(df, url_, table, policy, **kw)
        if len(calls) == 1:  # duplicate one partition's worth of rows
            real_write(gold.limit(7), url_, table, "append", properties=DERBY)

    monkeypatch.setattr(WH, "write_warehouse", flaky_write)
    summary = WH.load_warehouse(gold, url, "gold_aggregates", properties=DERBY)
    assert calls == ["recreate", "recreate"] and summary.attempts == 2
    assert WH.table_rows(spark, url, "gold_aggregates", DERBY) == gold.count() == summary.rows


@pytest.mark.parametrize("policy", ["recreate", "truncate", "append"])
def test_a_failing_load_leaves_the_old_rows(spark, tmp_path, gold_root, policy):
    import tripflow.sinks.warehouse as WH

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    gold = SF.read_table(spark, gold_root)
    load_warehouse(gold, url, "gold_aggregates", properties=DERBY)
    n = gold.count()
    broken = gold.withColumn("total_fare", F.when(F.col("pickup_day") == 9, F.raise_error(F.lit("bad row"))).otherwise(F.col("total_fare")).cast("double"))
    with pytest.raises(Exception, match="bad row"):
        load_warehouse(broken, url, "gold_aggregates", policy, properties=DERBY)
    assert WH.table_rows(spark, url, "gold_aggregates", DERBY) == n
    again = load_warehouse(gold, url, "gold_aggregates", policy, properties=DERBY, num_partitions=2)
    assert WH.table_rows(spark, url, "gold_aggregates", DERBY) == (2 * n if policy == "append" else n)
    per_day = {(r.pickup_year, r.pickup_month, r.pickup_day): r["count"] for r in gold.groupBy(*S.PARTITION_COLS).count().collect()}
    assert again.days == per_day and again.partitions == 30


def test_warehouse_is_read_by_day(spark, tmp_path, gold_root):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    gold = SF.read_table(spark, gold_root)
    odd = gold.limit(3).withColumn("pickup_day", F.lit(None).cast("int"))
    write_warehouse(gold.unionByName(odd), url, "g", properties=DERBY)
    days = SF.list_partitions(spark, gold_root)
    for listed in (days, days.limit(4), days.limit(0), days.limit(2).union(spark.createDataFrame([(2024, 1, None)], "y int, m int, d int"))):
        back = read_warehouse(spark, url, "g", DERBY, days=listed)
        assert back.rdd.getNumPartitions() == listed.count() + 1
        assert _rows(back, S.GOLD.names) == _rows(gold.unionByName(odd), S.GOLD.names)


def test_head_reads_only_the_files_it_needs(spark, tmp_path):
    from tripflow.operators import sample as SM

    raw = str(tmp_path / "raw")
    read_trips(spark, SF_SMALL).repartition(8).write.parquet(raw)
    head = SM.read_head(spark, raw, 200)
    assert len([f for f in head.inputFiles() if f.startswith(f"file://{raw}") or raw in f]) == 2  # 125 rows each
    assert sorted(r[SM.POS] for r in head.collect()) == list(range(200))
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "none"))
    assert SM.read_head(spark, str(tmp_path / "none"), 5).collect() == []


def test_contract_check_finds_differences(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, "y")], "pickup_year int, total_fare double, extra string")
    got = {r.column_name: r for r in S.check_contract(df, S.GOLD).collect()}
    assert got["pickup_year"].ok and got["total_fare"].n_nulls == 1
    assert not got["extra"].ok and got["extra"].position is None and got["total_rides"].actual_type is None
    assert len(got) == len(S.GOLD.names) + 1


def test_inferred_bronze_has_all_contract_columns(spark, tmp_path):
    t = read_trips(spark, SF_SMALL).withColumn("airport_fee", F.lit(None).cast("double"))
    write_table(t, str(tmp_path / "b"), "json", "overwrite")
    back = SF.read_bronze(spark, str(tmp_path / "b"), schema=None)
    assert back.columns == S.TRIP.names and back.filter("airport_fee is not null").count() == 0


def _stages_run(spark, group, fn):
    """Stages of all jobs ``fn`` ran (AQE submits each query stage as a job)."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setJobGroup("", "")
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    # Leave out the read-back's footer-reading job (named after ``parquet``).
    return sum(1 for s in stages if not tracker.getStageInfo(s).name.startswith("parquet at"))


def test_silver_job_rebalances_unless_told_not_to(spark, tmp_path):
    write_table(read_trips(spark, SF_SMALL), str(tmp_path / "bronze"), "json", "overwrite")
    plain = _stages_run(spark, "silver-plain", lambda: J.silver_job(spark, str(tmp_path / "bronze"), str(tmp_path / "s1"), rebalance=False))
    shuffled = _stages_run(
        spark, "silver-rebalanced", lambda: J.silver_job(spark, str(tmp_path / "bronze"), str(tmp_path / "s2"))
    )
    assert plain == 1  # scan → clean → enrich → write, one stage
    assert shuffled >= 2  # the rebalance exchange splits it
    assert _rows(SF.read_table(spark, str(tmp_path / "s1")), S.SILVER.names) == _rows(SF.read_table(spark, str(tmp_path / "s2")), S.SILVER.names)


def test_read_days_reads_only_those_folders(spark, gold_root):
    got = SF.read_days(spark, gold_root, [(2024, 1, 3), (2024, 1, 17)])
    assert all("pickup_day=3/" in f or "pickup_day=17/" in f for f in got.inputFiles())
    assert dict(got.dtypes)["pickup_day"] == "int"  # partition columns kept
    want = SF.read_table(spark, gold_root).filter(F.col("pickup_day").isin(3, 17))
    assert _rows(got, S.GOLD.names) == _rows(want, S.GOLD.names)


def test_read_days_missing_day_raises(spark, gold_root):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        SF.read_days(spark, gold_root, [(2024, 2, 30)])


def test_scratch_is_deleted_and_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    import os

    from tripflow import session

    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    mine = session._scratch[spark.sparkContext.applicationId]
    kept = mine[:-1]
    session._scratch[spark.sparkContext.applicationId] = mine[-1:]
    assert session.clean_scratch(spark) == 1 and not os.path.exists(path)
    session._scratch[spark.sparkContext.applicationId] = kept

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
