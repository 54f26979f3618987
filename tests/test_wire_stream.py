"""Wire codec, source option mapping, and streaming ingest (stream = batch,
restart exactly once, orphan files, replay-safe foreachBatch)."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, payloads, trip
from tripflow import schema as S
from tripflow.operators import wire as W
from tripflow.plans import jobs as J
from tripflow.sources.files import read_bronze
from tripflow.sources.trips import read_trips
from tripflow.streaming import ingest as I

TRIP_COLS = S.TRIP.names


def _sorted(df):
    return sorted(map(tuple, df.select(*TRIP_COLS).collect()), key=repr)


def test_encode_decode_roundtrip(spark):
    t = read_trips(spark, SF_SMALL)
    assert _sorted(W.from_wire(J.publish(t))) == _sorted(t)


def test_encoded_payload_carries_every_key_including_nulls(spark):
    t = read_trips(spark, SF_SMALL).filter(F.col("airport_fee").isNull()).limit(1)
    text = W.to_wire(t).select(F.col("value").cast("string")).first()[0]
    import json

    obj = json.loads(text)
    assert list(obj) == TRIP_COLS and obj["airport_fee"] is None


def test_keys_fall_back_to_row_hash(spark):
    df = spark.createDataFrame([("1", 1.0), (None, 2.0), (None, 3.0)], "VendorID string, x double")
    keys = [r.key for r in W.to_wire(df, key_cols=["VendorID"]).collect()]
    assert keys[0] == "1" and keys[1] and keys[2] and keys[1] != keys[2]
    missing = [r.key for r in W.to_wire(df.drop("VendorID"), key_cols=["VendorID"]).collect()]
    assert len(set(missing)) == 3


def test_split_malformed(spark):
    df = payloads(spark, [trip(), "garbage", None, '{"passenger_count": "x"}'])
    good, bad = W.split_malformed(W.decode_flagged(df))
    assert good.count() == 1 and bad.count() == 3


def test_conform_reorders_and_strict_checks(spark):
    df = spark.createDataFrame([(1.0, "2")], "fare_amount double, VendorID string")
    sub = S.TRIP.__class__([S.TRIP["VendorID"], S.TRIP["fare_amount"]])
    assert W.conform(df, sub).columns == ["VendorID", "fare_amount"]
    assert W.conform(df, sub, strict=True).columns == ["VendorID", "fare_amount"]
    # strict: a missing nullable column comes back null, an unsafe type fails.
    assert W.conform(df.drop("fare_amount"), sub, strict=True).first().fare_amount is None
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        W.conform(spark.createDataFrame([("x", "2")], "fare_amount string, VendorID string"), sub, strict=True)


def test_kafka_options():
    src = I.wire_source("kafka", servers="broker:9092", topic="taxi_trips")
    assert src.fmt == "kafka" and src.payload_col == "value"
    assert src.options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "taxi_trips",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    capped = I.wire_source("kafka", servers="b:9092", topic="t", max_offsets_per_trigger=500_000, minPartitions=64)
    assert capped.options["maxOffsetsPerTrigger"] == "500000" and capped.options["minPartitions"] == 64


def test_kinesis_options():
    src = I.wire_source("aws-kinesis", stream="trips", region="us-east-2")
    assert src.fmt == "aws-kinesis" and src.payload_col == "data"
    assert src.options["kinesis.startingposition"] == "LATEST"
    assert src.options["kinesis.endpointUrl"] == "https://kinesis.us-east-2.amazonaws.com"
    assert src.options["kinesis.consumerType"] == "GetRecords"
    with pytest.raises(ValueError):
        I.wire_source("socket")


def _payload_dir(spark, path, df, files=3):
    J.publish(df).repartition(files).write.mode("append").parquet(str(path))


def _run(spark, src, bronze, ckpt, fmt="json"):
    raw, payload = I.read_wire_stream(spark, "file", path=str(src), max_files_per_trigger=1)
    q = I.write_bronze_stream(W.from_wire(raw, payload), str(bronze), str(ckpt), fmt, trigger="available_now")
    I.run_to_end(q, 300)
    return q


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_stream_equals_batch(spark, tmp_path, fmt):
    t = read_trips(spark, SF_SMALL)
    _payload_dir(spark, tmp_path / "src", t)
    q = _run(spark, tmp_path / "src", tmp_path / "bronze", tmp_path / "ckpt", fmt)
    assert q.lastProgress is not None
    assert _sorted(read_bronze(spark, str(tmp_path / "bronze"), fmt=fmt)) == _sorted(t)


def test_restart_each_row_once_and_orphans_ignored(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    # The stream stops mid-month; later trips arrive while it is down.
    early = F.coalesce(F.col(S.PICKUP_TS) < F.lit("2024-01-16 00:00:00"), F.lit(False))
    _payload_dir(spark, tmp_path / "src", t.filter(early))
    _run(spark, tmp_path / "src", tmp_path / "bronze", tmp_path / "ckpt")
    _payload_dir(spark, tmp_path / "src", t.filter(~early))
    _run(spark, tmp_path / "src", tmp_path / "bronze", tmp_path / "ckpt")
    # An orphan file beside committed output (as a failed batch may leave).
    some = next(p for p in os.listdir(tmp_path / "bronze") if p.endswith(".json"))
    shutil.copy(tmp_path / "bronze" / some, tmp_path / "bronze" / "orphan-part.json")
    assert _sorted(read_bronze(spark, str(tmp_path / "bronze"))) == _sorted(t)
    # A glob bypasses the sink log and sees the orphan too (why we never glob).
    assert spark.read.schema(S.TRIP).json(str(tmp_path / "bronze" / "*.json")).count() > t.count()


def test_foreach_batch_replay_overwrites(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    write = I.batch_writer(str(tmp_path / "out"))
    write(t, 0)
    write(t, 0)  # a replay of batch 0 replaces it
    write(t.limit(0), 1)  # empty batches write nothing
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == t.count()
    assert sorted(r.batch_id for r in out.select("batch_id").distinct().collect()) == [0]


def test_foreach_batch_stream(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    _payload_dir(spark, tmp_path / "src", t)
    raw, payload = I.read_wire_stream(spark, "file", path=str(tmp_path / "src"), max_files_per_trigger=1)
    I.run_to_end(I.append_batches(W.from_wire(raw, payload), str(tmp_path / "out"), str(tmp_path / "ckpt"), trigger="available_now"), 300)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert _sorted(out) == _sorted(t)
    assert out.select("batch_id").distinct().count() == 3  # one file per trigger


def test_processing_time_trigger_then_stop(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    _payload_dir(spark, tmp_path / "src", t)
    q = I.ingest_bronze(
        spark, "file", str(tmp_path / "bronze"), str(tmp_path / "ckpt"), fmt="json", trigger="1 second",
        source_options={"path": str(tmp_path / "src"), "max_files_per_trigger": 1},
    )
    try:
        assert q.isActive
        q.processAllAvailable()
    finally:
        q.stop()
    assert not q.isActive and q.exception() is None
    assert _sorted(read_bronze(spark, str(tmp_path / "bronze"))) == _sorted(t)


def test_publish_writes_through_any_sink_format(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    J.publish(t, key_cols=["VendorID"], sink_format="parquet", sink_options={"path": str(tmp_path / "out")})
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["value", "key"] and out.count() == t.count()
    assert _sorted(W.from_wire(out)) == _sorted(t)


def test_bronze_files_per_batch_bounded(spark, tmp_path):
    t = read_trips(spark, SF_SMALL)
    J.publish(t).repartition(6).write.parquet(str(tmp_path / "src"))  # 6 files: 6 read partitions
    raw, payload = I.read_wire_stream(spark, "file", path=str(tmp_path / "src"))
    q = I.write_bronze_stream(
        W.from_wire(raw, payload), str(tmp_path / "bronze"), str(tmp_path / "ckpt"), "json", trigger="available_now",
        max_files_per_batch=2,
    )
    I.run_to_end(q, 300)
    files = [f for f in os.listdir(tmp_path / "bronze") if f.endswith(".json")]
    assert 1 <= len(files) <= 2 * (q.lastProgress["batchId"] + 1)
    assert _sorted(read_bronze(spark, str(tmp_path / "bronze"))) == _sorted(t)


def test_a_timeout_is_an_error_not_a_short_result(spark, tmp_path):
    _payload_dir(spark, tmp_path / "src", read_trips(spark, SF_SMALL), files=40)
    opts = {"path": str(tmp_path / "src"), "max_files_per_trigger": 1}
    q = I.ingest_bronze(spark, "file", str(tmp_path / "bronze"), str(tmp_path / "ckpt"), trigger="available_now", source_options=opts)
    with pytest.raises(TimeoutError, match="input left"):
        I.run_to_end(q, 1)
    assert not q.isActive
    # A restart without a limit works off the rest.
    I.run_to_end(I.ingest_bronze(spark, "file", str(tmp_path / "bronze"), str(tmp_path / "ckpt"), trigger="available_now", source_options=opts))
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 1000


def test_a_continuous_query_is_stopped_on_request(spark, tmp_path):
    _payload_dir(spark, tmp_path / "src", read_trips(spark, SF_SMALL))
    q = I.ingest_bronze(spark, "file", str(tmp_path / "b"), str(tmp_path / "c"), trigger="1 second", source_options={"path": str(tmp_path / "src")})
    q.processAllAvailable()
    assert I.run_for(q, 1) is True and not q.isActive
    with pytest.raises(ValueError, match="once"):
        I.with_trigger(None, "once")


def test_an_error_of_a_stream_keeps_its_cause(spark, tmp_path):
    _payload_dir(spark, tmp_path / "src", read_trips(spark, SF_SMALL))

    def fail(batch, batch_id):
        raise ValueError("no room")

    raw, payload = I.read_wire_stream(spark, "file", path=str(tmp_path / "src"))
    q = I.with_trigger(W.from_wire(raw, payload).writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c")), "available_now").start()
    with pytest.raises(RuntimeError, match="no room") as e:
        I.run_to_end(q)
    assert e.value.__cause__ is not None


def test_a_batch_is_hidden_until_it_is_whole(spark, tmp_path):
    out = str(tmp_path / "out")
    I.batch_writer(out)(read_trips(spark, SF_SMALL), 3)
    I.batch_writer(out)(read_trips(spark, SF_SMALL).limit(0), 4)
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["batch_id=3"]
