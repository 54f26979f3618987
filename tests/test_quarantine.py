"""Quarantine and duplicate deliveries in the stream: nothing lost, nothing doubled."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tripflow import schema as S
from tripflow.sources import files as SF
from tripflow.streaming import quarantine as Q
from tripflow.streaming.ingest import run_to_end

GOOD = {"VendorID": "1", "tpep_pickup_datetime": "2024-01-01 08:00:00", "trip_distance": 2.5}


def message(**fields):
    return json.dumps(GOOD | fields).encode()


CASES = [
    (message(), None),
    (message(trip_distance=None), None),
    (b"{}", None),
    (None, Q.NO_PAYLOAD),
    (b"", Q.NOT_A_RECORD),
    (b"null", Q.NOT_A_RECORD),
    (b"garbage", Q.NOT_A_RECORD),
    (b'{"VendorID": "1"', Q.NOT_A_RECORD),
    (b"\xff\xfe\x00", Q.NOT_A_RECORD),
    (message(trip_distance="far"), Q.WRONG_TYPE),
    (message(passenger_count=[1]), Q.WRONG_TYPE),
]


def test_reasons_and_raw_payloads(spark):
    rows = spark.createDataFrame([(p,) for p, _ in CASES], "value binary")
    got = Q.judge_messages(rows).collect()
    assert [r.reason for r in got] == [why for _, why in CASES]
    for r, (raw, why) in zip(got, CASES):
        assert r.verdict == ("bad" if why else "good")
        assert (None if r.payload is None else bytes(r.payload)) == (raw if why else None)
        assert not why or all(r[f.name] is None for f in S.TRIP.fields)
    assert got[0].trip_distance == 2.5


def _deliver(spark, src, payloads, files=1):
    spark.createDataFrame([(p,) for p in payloads], "value binary").coalesce(files).write.mode("append").parquet(src)


def _paths(tmp_path):
    return [str(tmp_path / n) for n in ("src", "bronze", "bad", "ckpt")]


def _run(spark, src, bronze, bad, ckpt, **more):
    run_to_end(Q.ingest_quarantine(spark, "file", bronze, bad, ckpt, trigger="available_now", source_options={"path": src, "max_files_per_trigger": 1}, **more), 120)


def test_good_and_quarantined_are_all_messages_through_a_restart(spark, tmp_path):
    src, bronze, bad, ckpt = _paths(tmp_path)
    payloads = [p for p, _ in CASES]
    _deliver(spark, src, payloads)
    _run(spark, src, bronze, bad, ckpt)
    _deliver(spark, src, payloads[:4] + [None])
    _run(spark, src, bronze, bad, ckpt)
    _deliver(spark, src, [message()])  # a batch without bad rows leaves no folder in quarantine
    _run(spark, src, bronze, bad, ckpt)
    held = Q.read_quarantine(spark, bad)
    assert SF.read_bronze(spark, bronze, fmt="parquet").count() == 3 + 3 + 1
    assert sorted((r.batch_id, r.reason) for r in held.collect()) == sorted([(0, why) for _, why in CASES if why] + [(1, Q.NO_PAYLOAD)] * 2)
    assert sorted(n for n in os.listdir(bad) if n.startswith("batch")) == ["batch_id=0", "batch_id=1"]
    assert not [n for n in os.listdir(bronze) if n.startswith("_batch")]


@pytest.mark.parametrize("at", [1, 2])
def test_a_crash_between_the_two_tables(spark, tmp_path, monkeypatch, at):
    """The batch dies after it has renamed one half (or none); the restart commits both, once."""
    src, bronze, bad, ckpt = _paths(tmp_path)
    _deliver(spark, src, [p for p, _ in CASES])
    real, calls = Q.replace_folder, []

    def dies(spark, staged, final):
        calls.append(final)
        if len(calls) == at:
            raise OSError("lost")
        return real(spark, staged, final)

    with monkeypatch.context() as m:
        m.setattr(Q, "replace_folder", dies)
        with pytest.raises(RuntimeError):
            _run(spark, src, bronze, bad, ckpt)
    _run(spark, src, bronze, bad, ckpt)
    assert SF.read_bronze(spark, bronze, fmt="parquet").count() == 3
    assert Q.read_quarantine(spark, bad).count() == len(CASES) - 3


def test_never_written_quarantine_is_empty(spark, tmp_path):
    assert Q.read_quarantine(spark, str(tmp_path / "none")).collect() == []


def _once(spark, src, bronze, ckpt, **more):
    run_to_end(Q.ingest_once(spark, "file", bronze, ckpt, trigger="available_now", source_options={"path": src}, **more), 120)
    return SF.read_bronze(spark, bronze)


def test_redelivered_records_add_nothing_within_the_bound(spark, tmp_path):
    src, bronze, _, ckpt = _paths(tmp_path)
    a, b, c = (message(VendorID=v) for v in "abc")
    _deliver(spark, src, [a, b, a, None, None, b"x"])
    assert _once(spark, src, bronze, ckpt).count() == 5  # a once; messages without payload are not records
    _deliver(spark, src, [b, c, a])
    _deliver(spark, src, [c])
    assert sorted(r.VendorID for r in _once(spark, src, bronze, ckpt).filter("VendorID is not null").collect()) == ["a", "b", "c"]


def test_a_redelivery_after_the_bound_counts(spark, tmp_path):
    src, bronze, _, ckpt = _paths(tmp_path)
    a = message(VendorID="a")
    _deliver(spark, src, [a])
    assert _once(spark, src, bronze, ckpt, within="1 second").count() == 1
    for n in range(2):  # later batches move the watermark past the first arrival
        time.sleep(2.5)
        _deliver(spark, src, [message(VendorID=f"later{n}")])
        _once(spark, src, bronze, ckpt, within="1 second")
    _deliver(spark, src, [a])
    assert _once(spark, src, bronze, ckpt, within="1 second").filter("VendorID = 'a'").count() == 2


def test_records_by_key_fields(spark, tmp_path):
    src, bronze, _, ckpt = _paths(tmp_path)
    _deliver(spark, src, [message(VendorID="a", tip_amount=1.0), message(VendorID="a", tip_amount=2.0), message(VendorID="b"), b"x", b"x"])
    got = _once(spark, src, bronze, ckpt, key_cols=["VendorID", "tpep_pickup_datetime"])
    assert sorted(r.VendorID or "" for r in got.collect()) == ["", "", "a", "b"]


def test_quarantine_without_duplicates(spark, tmp_path):
    src, bronze, bad, ckpt = _paths(tmp_path)
    _deliver(spark, src, [message(), message(), b"x", b"x", None])
    _run(spark, src, bronze, bad, ckpt, redelivered_within="1 hour")
    assert SF.read_bronze(spark, bronze, fmt="parquet").count() == 1
    assert Q.read_quarantine(spark, bad).select(F.count("payload"), F.count("reason")).first()[:] == (1, 2)
