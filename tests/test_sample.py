"""Positional samples checked against brute force on small inputs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow.operators import sample as SM
from tripflow.sources.trips import read_trips


def test_positions_follow_file_order(spark):
    pos, total = SM.with_position(read_trips(spark, SF_SMALL, keep=("event_id", "_file", "_row")))
    assert total == 1000
    # events.parquet is stored in event_id order: the position is the event id.
    assert pos.filter(F.col(SM.POS) != F.col("event_id")).count() == 0
    assert pos.count() == 1000


def test_positions_across_files(spark, tmp_path):
    df = spark.range(0, 997).withColumn("v", F.col("id") * 2)
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    raw = spark.read.parquet(str(tmp_path / "t")).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    got = SM.with_position(raw).df.select(SM.POS, "id").collect()
    # Brute force: files by name, rows in file order.
    import pyarrow.parquet as pq
    import os

    files = sorted(f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet"))
    expected_ids = [i for f in files for i in pq.read_table(str(tmp_path / "t" / f)).column("id").to_pylist()]
    assert sorted((r[SM.POS], r.id) for r in got) == list(enumerate(expected_ids))


def test_head_sample(spark):
    pos = SM.with_position(read_trips(spark, SF_SMALL, keep=("event_id", "_file", "_row"))).df
    ids = sorted(r.event_id for r in SM.head_sample(pos, 10).collect())
    assert ids == list(range(10))


def brute_spread(total, size, chunks, seed):
    """Positions and chunks drawn in MD5 order, by sorting every chunk."""
    import hashlib
    import random

    size = min(size, total)
    per, bounds = size // chunks, [(i * total // chunks, (i + 1) * total // chunks) for i in range(chunks)]
    order = list(range(chunks))
    random.Random(seed).shuffle(order)
    extra, left = [0] * chunks, size - per * chunks
    while left:
        for i in order:
            if left and bounds[i][1] - bounds[i][0] > per + extra[i]:
                extra[i] += 1
                left -= 1
    out = set()
    for i, (lo, hi) in enumerate(bounds):
        drawn = sorted(range(lo, hi), key=lambda p: hashlib.md5(f"{seed}:{p}".encode()).hexdigest())
        out |= {(p, i) for p in drawn[:per]} | {(p, chunks) for p in drawn[per : per + extra[i]]}
    return out


@pytest.mark.parametrize("chunks", [1, 7, 10])
@pytest.mark.parametrize("total, size", [(1000, 1005), (1003, 105), (9999, 1007), (50, 3), (7, 100), (61, 30), (61, 61), (115, 100), (122, 9), (230, 229), (0, 5), (5, 0)])
def test_spread_sample_exact(spark, total, size, chunks):
    positioned = spark.range(total).withColumnRenamed("id", SM.POS)
    rows = SM.spread_sample(positioned, total, size, chunks, seed=7).collect()
    assert len(rows) == min(size, total)
    assert {(r[SM.POS], r[SM.CHUNK]) for r in rows} == brute_spread(total, size, chunks, 7)


def test_chunks_cover_all_positions():
    for total, chunks in [(25, 10), (10_000_019, 10), (61, 7), (3, 7), (0, 4)]:
        b = SM.chunk_bounds(total, chunks)
        assert b[0][0] == 0 and b[-1][1] == total and all(x[1] == y[0] for x, y in zip(b, b[1:]))


@pytest.mark.parametrize("key", [lambda pos: F.lpad(F.hex(pos + (1 << 40)), 32, "f"), lambda pos: F.lpad(F.hex(pos), 32, "0"), lambda pos: F.concat(F.hex(pos % 16), F.lpad(F.hex(pos), 31, "0"))])
def test_cut_offs_are_found_where_keys_are_not_spread(spark, monkeypatch, key):
    """Keys that crowd at one end, agree in all digits that are counted, or come in clumps."""
    total, chunks = 4000, 3
    monkeypatch.setattr(SM, "draw_key", lambda pos, seed: key(pos))
    got = SM.cut_offs(spark, total, {0: [2], 1: [600, 601], 2: [5, 1300]}, chunks, 1)
    keys = [sorted(r.k for r in spark.range(lo, hi).select(key(F.col("id")).alias("k")).collect()) for lo, hi in SM.chunk_bounds(total, chunks)]
    assert got == {(0, 2): keys[0][1], (1, 600): keys[1][599], (1, 601): keys[1][600], (2, 5): keys[2][4], (2, 1300): keys[2][1299]}


def test_half_of_a_table_is_cut_off_by_counts(spark, monkeypatch):
    """Two passes of counts and no window, however large the sample."""
    import hashlib

    passes, real = [], SM.draw_key
    monkeypatch.setattr(SM, "draw_key", lambda pos, seed: passes.append(1) or real(pos, seed))
    monkeypatch.setattr(SM.Window, "partitionBy", lambda *a: 1 / 0)
    total = 300_000
    got = SM.cut_offs(spark, total, {i: [7500] for i in range(20)}, 20, 5)
    assert len(passes) <= 3
    for i, (lo, hi) in enumerate(SM.chunk_bounds(total, 20)):
        assert got[i, 7500] == sorted(hashlib.md5(f"5:{p}".encode()).hexdigest() for p in range(lo, hi))[7499]


def test_spread_sample_is_deterministic(spark):
    positioned = spark.range(5000).withColumnRenamed("id", SM.POS)
    a = sorted(r[SM.POS] for r in SM.spread_sample(positioned, 5000, 503, seed=3).collect())
    b = sorted(r[SM.POS] for r in SM.spread_sample(positioned, 5000, 503, seed=3).collect())
    c = sorted(r[SM.POS] for r in SM.spread_sample(positioned, 5000, 503, seed=4).collect())
    assert a == b and a != c


@pytest.mark.parametrize("buckets, per_range", [(1, None), (3, None), (64, None), (None, 5), (None, 100_000)])
def test_file_offsets_in_ranges_equal_running_sum(spark, tmp_path, monkeypatch, buckets, per_range):
    """Offsets computed range by range equal a plain running sum over files
    sorted by name, for fewer and for more ranges than files."""
    if per_range:
        monkeypatch.setattr(SM, "FILES_PER_RANGE", per_range)  # 23 files → 5 ranges, or 1
    df = spark.range(0, 4000).withColumn("v", F.col("id") % 7)
    df.repartition(23).write.parquet(str(tmp_path / "t"))
    raw = spark.read.parquet(str(tmp_path / "t")).select("*", F.col("_metadata.file_path").alias("_file"))
    got = {r._file: (r._rows, r._offset) for r in SM.file_offsets(raw, buckets=buckets).collect()}
    counts = {r._file: r.n for r in raw.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    run, expect = 0, {}
    for f in sorted(counts):
        expect[f] = (counts[f], run)
        run += counts[f]
    assert got == expect


@pytest.mark.parametrize("threshold, join", [("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_positions_same_for_every_join_of_the_offsets(spark, tmp_path, threshold, join):
    """Spark's size threshold decides how the offsets are joined; positions are the same."""
    import plan_inspect as PI

    df = spark.range(0, 997).withColumn("v", F.col("id") * 2)
    df.repartition(5).write.parquet(str(tmp_path / "t"))
    raw = spark.read.parquet(str(tmp_path / "t")).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        pos = SM.with_position(raw)
        assert join in PI.physical_section(pos.df)
        got = sorted((r[SM.POS], r.id) for r in pos.df.select(SM.POS, "id").collect())
    finally:
        spark.conf.set(key, old)
    import os

    import pyarrow.parquet as pq

    files = sorted(f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet"))
    expected_ids = [i for f in files for i in pq.read_table(str(tmp_path / "t" / f)).column("id").to_pylist()]
    assert got == list(enumerate(expected_ids)) and pos.total == 997
