"""Incremental silver + gold: equals a full rebuild, replays are idempotent,
untouched gold days are left alone."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import schema as S
from tripflow.functions.columns import round_doubles
from tripflow.operators import gold as G
from tripflow.operators import silver as SV
from tripflow.sinks.files import write_table
from tripflow.sources import files as SF
from tripflow.sources.trips import read_trips
from tripflow.streaming import incremental as INC
from tripflow.streaming.ingest import run_to_end


def _gold_rows(df):  # sums of doubles depend on order: compare at 9 places
    return sorted(map(tuple, round_doubles(df.select(*S.GOLD.names), 9).collect()), key=repr)


def _day_files(gold_root, day):
    d = os.path.join(gold_root, "pickup_year=2024", "pickup_month=1", f"pickup_day={day}")
    return sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for f in os.listdir(d) if f.endswith(".parquet"))


def test_batches_equal_full_rebuild_and_replay_is_idempotent(spark, tmp_path):
    silver = SV.build_silver(read_trips(spark, SF_SMALL))
    early = silver.filter(F.col("pickup_day") < 16)
    late = silver.filter(F.col("pickup_day") >= 16)
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write = INC.silver_gold_batch_writer(spark, silver_root, gold_root)
    write(early, 0)
    before = _day_files(gold_root, 3)
    write(late, 1)
    write(late, 1)  # a replayed batch replaces its own folder
    write(late.limit(0), 2)  # an empty batch writes nothing
    assert _day_files(gold_root, 3) == before  # day 3 was not in batch 1: untouched
    back = SF.read_table(spark, silver_root)
    assert back.count() == silver.count()
    assert sorted(r[0] for r in back.select(INC.BATCH_COL).distinct().collect()) == [0, 1]
    assert _gold_rows(SF.read_table(spark, gold_root)) == _gold_rows(G.build_gold(silver))


def test_stream_over_bronze_files_in_time_order(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    bronze = str(tmp_path / "bronze")
    write_table(t.repartitionByRange(3, S.PICKUP_TS), bronze, "json", "overwrite")
    q = INC.silver_gold_incremental(
        spark, bronze, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "ckpt"), max_files_per_trigger=1
    )
    run_to_end(q, 300)
    assert q.lastProgress["batchId"] >= 2  # one file per micro-batch
    assert _gold_rows(SF.read_table(spark, str(tmp_path / "gold"))) == _gold_rows(G.build_gold(SV.build_silver(t)))
    # A second run finds no new bronze files and changes nothing.
    q2 = INC.silver_gold_incremental(spark, bronze, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "ckpt"))
    run_to_end(q2, 300)
    assert SF.read_table(spark, str(tmp_path / "silver")).count() == SV.build_silver(t).count()


def test_late_trips_for_a_finished_day_are_included(spark, tmp_path):
    """Trips of day 5 that arrive with the batch of the last days (late) end
    up in day 5's gold row set, as a full rebuild would have it."""
    silver = SV.build_silver(read_trips(spark, SF_SMALL))
    late_hours = F.col("pickup_hour") >= 12
    first = silver.filter((F.col("pickup_day") <= 20) & ~((F.col("pickup_day") == 5) & late_hours))
    second = silver.filter((F.col("pickup_day") > 20) | ((F.col("pickup_day") == 5) & late_hours))
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write = INC.silver_gold_batch_writer(spark, silver_root, gold_root)
    write(first, 0)
    partial_day5 = SF.read_table(spark, gold_root).filter(F.col("pickup_day") == 5).count()
    write(second, 1)
    day5 = SF.read_table(spark, gold_root).filter(F.col("pickup_day") == 5)
    assert day5.count() > partial_day5  # the late trips added gold rows to day 5
    assert _gold_rows(SF.read_table(spark, gold_root)) == _gold_rows(G.build_gold(silver))


def test_a_later_batch_reads_its_own_trips_and_parts_only(spark, tmp_path):
    """The second batch of a day must not need the first batch's trips."""
    import shutil

    silver = SV.build_silver(read_trips(spark, SF_SMALL))
    morning = F.col("pickup_hour") < 12
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write = INC.silver_gold_batch_writer(spark, silver_root, gold_root)
    write(silver.filter(morning), 0)
    for folder, dirs, _ in os.walk(silver_root):
        for d in dirs:
            if d == f"{INC.BATCH_COL}=0":
                shutil.move(os.path.join(folder, d), os.path.join(folder, "_gone"))
    write(silver.filter(~morning), 1)
    assert _gold_rows(SF.read_table(spark, gold_root)) == _gold_rows(G.build_gold(silver))


def test_bad_rows_are_diverted_per_batch(spark, tmp_path):
    t = read_trips(spark, SF_SMALL).withColumn(S.PICKUP_TS, F.when(F.col("VendorID") == "2", F.lit("noon")).otherwise(F.col(S.PICKUP_TS)))
    bronze = str(tmp_path / "bronze")
    write_table(t, bronze, "json", "overwrite")
    run_to_end(INC.silver_gold_incremental(spark, bronze, str(tmp_path / "s"), str(tmp_path / "g"), str(tmp_path / "c"), on_bad_value="null"))
    good, bad = SV.split_silver(t)
    assert SF.read_table(spark, str(tmp_path / "s")).count() == good.count() > 0
    assert spark.read.parquet(str(tmp_path / "s_rejects")).count() == bad.count() > 0
    assert _gold_rows(SF.read_table(spark, str(tmp_path / "g"))) == _gold_rows(G.build_gold(good))
