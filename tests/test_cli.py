"""The spark-submit entry points, run in-process on the test session."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import schema as S
from tripflow.plans import catalog as K
from tripflow.plans.cli import run
from tripflow.sinks.files import write_table
from tripflow.sources.trips import read_trips


def test_pipeline_through_cli(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    write_table(t, str(tmp_path / "bronze"), "json", "overwrite")
    out = run(["silver", "--bronze", str(tmp_path / "bronze"), "--silver", str(tmp_path / "silver")], spark)
    assert out == {"cmd": "silver", "rows_in": 1000, "rows_out": 769}
    run(["gold", "--silver", str(tmp_path / "silver"), "--gold", str(tmp_path / "gold")], spark)
    run(["gold", "--silver", str(tmp_path / "silver"), "--gold", str(tmp_path / "gold"), "--days", "2024-01-03,2024-01-04"], spark)
    gold = spark.read.parquet(str(tmp_path / "gold"))
    assert gold.count() == K.gold(spark, SF_SMALL).count()
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    res = run(["load", "--gold", str(tmp_path / "gold"), "--url", url, "--prop", "driver=org.apache.derby.iapi.jdbc.AutoloadedDriver"], spark)
    assert res["rows"] == gold.count() and res["attempts"] == 1
    run(["report", "--name", "peak_hours", "--gold", str(tmp_path / "gold"), "--out", str(tmp_path / "peak"), "--k", "3"], spark)
    assert spark.read.parquet(str(tmp_path / "peak")).count() == 3


def test_sample_and_ingest_through_cli(spark, tmp_path):
    res = run(["sample", "--raw", f"{SF_SMALL}/events.parquet", "--out", str(tmp_path / "s"), "--n", "105"], spark)
    assert res["total"] == 1000
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 105
    from tripflow.plans import jobs as J

    J.publish(read_trips(spark, SF_SMALL)).write.parquet(str(tmp_path / "wire"))
    run(["ingest", "--source", "file", "--bronze", str(tmp_path / "b"), "--checkpoint", str(tmp_path / "c"),
         "--trigger", "available_now", "--opt", f"path={tmp_path / 'wire'}", "--timeout", "300", "--max-files-per-batch", "2"], spark)
    assert spark.read.schema(S.TRIP).json(str(tmp_path / "b")).count() == 1000


def test_incremental_through_cli(spark, tmp_path):
    from tripflow.functions.columns import round_doubles

    t = read_trips(spark, SF_SMALL)
    write_table(t.repartitionByRange(2, S.PICKUP_TS), str(tmp_path / "bronze"), "json", "overwrite")
    res = run(["incremental", "--bronze", str(tmp_path / "bronze"), "--silver", str(tmp_path / "silver"), "--gold", str(tmp_path / "gold"),
               "--checkpoint", str(tmp_path / "c"), "--max-files-per-trigger", "1", "--timeout", "300"], spark)
    assert res["batches"] >= 1
    got = round_doubles(spark.read.parquet(str(tmp_path / "gold")).select(*S.GOLD.names), 9).collect()
    want = round_doubles(K.gold(spark, SF_SMALL).select(*S.GOLD.names), 9).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_silver_from_parquet_bronze_through_cli(spark, tmp_path):
    write_table(read_trips(spark, SF_SMALL), str(tmp_path / "bronze"), "parquet", "overwrite")
    out = run(["silver", "--bronze", str(tmp_path / "bronze"), "--bronze-format", "parquet", "--silver", str(tmp_path / "silver")], spark)
    assert out == {"cmd": "silver", "rows_in": 1000, "rows_out": 769}
