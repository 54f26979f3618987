"""Checkpoint report: against a stream's own files, and against logs of other sources."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow.plans import catalog as K
from tripflow.sources.trips import read_trips
from tripflow.streaming import ingest as I
from tripflow.streaming.report import REPORT, checkpoint_report


def test_report_of_a_stream(spark, tmp_path):
    src, bronze, ckpt = (str(tmp_path / n) for n in ("src", "bronze", "ckpt"))
    K._payload_files(spark, SF_SMALL, src, files=3)
    K._stream_to_bronze(spark, src, bronze, ckpt, "json")
    rows = checkpoint_report(spark, ckpt).orderBy("batch_id").collect()
    assert [(r.batch_id, r.source, r.kind, r.committed, r.position, r.advance) for r in rows] == [(i, 0, "files", True, i + 1, 1) for i in range(3)]
    assert rows[0].gap_s is None and all(r.gap_s > 0 for r in rows[1:]) and all(r.planned for r in rows)
    os.remove(os.path.join(ckpt, "commits", "2"))  # planned, not finished
    assert [r.committed for r in checkpoint_report(spark, ckpt).orderBy("batch_id").collect()] == [True, True, False]
    assert read_trips(spark, SF_SMALL).count() == spark.read.json(bronze).count()


def _offsets(folder, batch, ms, *sources):
    with open(os.path.join(folder, str(batch)), "w") as f:
        f.write("\n".join(["v1", f'{{"batchWatermarkMs":0,"batchTimestampMs":{ms},"conf":{{}}}}', *sources]))


def test_messages_of_topics_and_several_sources(spark, tmp_path):
    folder = tmp_path / "offsets"
    folder.mkdir()
    _offsets(folder, 22, 1_000, '{"trips":{"0":100,"1":50},"other":{"0":7}}', '{"logOffset":4}')
    _offsets(folder, 23, 6_500, '{"trips":{"0":130,"1":50},"other":{"0":9}}', '{"logOffset":4}')
    _offsets(folder, 24, 12_500, '{"trips":{"0":131,"1":52},"other":{"0":9}}', "-")
    (folder / ".25.crc").write_text("x")
    rows = checkpoint_report(spark, str(tmp_path)).orderBy("source", "batch_id").collect()
    assert [(r.batch_id, r.source, r.kind, r.committed, r.position, r.advance, r.gap_s) for r in rows] == [
        (22, 0, "messages", False, 157, None, None),
        (23, 0, "messages", False, 189, 32, 5.5),
        (24, 0, "messages", False, 192, 3, 6.0),
        (22, 1, "files", False, 5, None, None),
        (23, 1, "files", False, 5, 0, 5.5),
        (24, 1, None, False, None, None, 6.0),
    ]


def test_no_batches(spark, tmp_path):
    got = checkpoint_report(spark, str(tmp_path))
    assert got.collect() == [] and got.schema == spark.createDataFrame([], REPORT).schema
    assert set(checkpoint_report(spark, str(tmp_path)).columns) == {f.split()[0] for f in REPORT.split(", ")} and F
