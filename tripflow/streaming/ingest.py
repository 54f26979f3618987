"""Streaming ingest: broker (or files) → decoded trips → bronze.

The stream is stateless: decode is a projection, the sink appends. Exactly
once comes from the checkpoint (offsets + commits) and, for file sinks, the
sink's own ``_spark_metadata`` log; readers must read the bronze directory,
never a glob (D13). The checkpoint lives outside the table.

Connectors (Kafka, Kinesis) are supplied by the user as Spark packages; this
module only maps options. Everything after the source is exercised with a
file stream of binary payloads.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StructField, StructType

from tripflow import schema as S
from tripflow.operators.wire import PAYLOAD_COLUMN, from_wire
from tripflow.sinks.files import delete_folder, replace_folder

PAYLOAD_FILE_SCHEMA = StructType([StructField("value", BinaryType())])


@dataclass
class WireSource:
    fmt: str
    payload_col: str
    options: dict = field(default_factory=dict)


def wire_source(kind: str, **opts) -> WireSource:
    """Source format, options and payload column for a source kind.

    kafka: ``servers``, ``topic``, ``starting`` (default earliest),
    ``fail_on_data_loss`` (default False), ``max_offsets_per_trigger``
    (bounds each micro-batch, so a large backlog read from the earliest
    offset is worked off in batches of a known size, not in one batch).
    aws-kinesis: ``stream``, ``region``, ``starting`` (default LATEST),
    ``endpoint`` (default from region), ``consumer_type`` (default GetRecords).
    file: ``path``, ``max_files_per_trigger``; files hold a binary ``value``.
    Other keys pass through as source options unchanged.
    """
    opts = dict(opts)
    if kind == "kafka":
        o = {
            "kafka.bootstrap.servers": opts.pop("servers"),
            "subscribe": opts.pop("topic"),
            "startingOffsets": opts.pop("starting", "earliest"),
            "failOnDataLoss": str(opts.pop("fail_on_data_loss", False)).lower(),
        }
        if "max_offsets_per_trigger" in opts:
            o["maxOffsetsPerTrigger"] = str(opts.pop("max_offsets_per_trigger"))
        return WireSource("kafka", PAYLOAD_COLUMN["kafka"], {**o, **opts})
    if kind in ("aws-kinesis", "kinesis"):
        region = opts.pop("region")
        o = {
            "kinesis.region": region,
            "kinesis.streamName": opts.pop("stream"),
            "kinesis.consumerType": opts.pop("consumer_type", "GetRecords"),
            "kinesis.endpointUrl": opts.pop("endpoint", f"https://kinesis.{region}.amazonaws.com"),
            "kinesis.startingposition": opts.pop("starting", "LATEST"),
        }
        return WireSource("aws-kinesis", PAYLOAD_COLUMN["aws-kinesis"], {**o, **opts})
    if kind == "file":
        o = {"path": opts.pop("path")}
        if "max_files_per_trigger" in opts:
            o["maxFilesPerTrigger"] = str(opts.pop("max_files_per_trigger"))
        return WireSource("parquet", PAYLOAD_COLUMN["file"], {**o, **opts})
    raise ValueError(f"unknown source kind {kind!r}")


def read_wire_stream(spark: SparkSession, kind: str, **opts) -> tuple[DataFrame, str]:
    """Streaming DataFrame of raw messages, and its payload column name."""
    src = wire_source(kind, **opts)
    reader = spark.readStream.format(src.fmt)
    if kind == "file":
        reader = reader.schema(PAYLOAD_FILE_SCHEMA)
    return reader.options(**src.options).load(), src.payload_col


def with_trigger(writer, trigger):
    """``trigger``: "available_now" (works off the backlog in batches of the
    source's per-trigger limit, then ends) or a processing-time interval."""
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        raise ValueError('"once" takes a whole backlog as one batch; use "available_now"')
    return writer.trigger(processingTime=trigger)


def write_bronze_stream(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger=None,
    query_name: str | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append decoded rows to a file table (K1 json, K2 parquet; T1, T3, T4).

    Each micro-batch writes one file per source partition. With many topic
    partitions and short triggers that is a flood of small files;
    ``max_files_per_batch`` deals the decoded rows to at most that many
    writers (one shuffle), so reading and decoding keep all their tasks.
    """
    if max_files_per_batch:
        decoded = decoded.repartition(max_files_per_batch)
    w = decoded.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()


def batch_writer(path: str, fmt: str = "parquet", columns: list[str] | None = None):
    """foreachBatch function: each non-empty micro-batch becomes its own
    ``batch_id=N`` folder, so a replayed batch replaces, never duplicates (K3, F5).

    The batch is written to a hidden folder and renamed when it is whole, so
    readers never see part of one. Its rows are counted while it is written;
    an empty batch leaves no folder, and its source is read once.
    """
    cols = columns or [f.name for f in S.TRIP.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        obs = Observation(f"batch-{batch_id}-{uuid.uuid4().hex[:8]}")
        staged = f"{path}/_batch_id={batch_id}"
        batch.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(staged)
        if obs.get["rows"]:
            replace_folder(spark, staged, f"{path}/batch_id={batch_id}")
        else:
            delete_folder(spark, staged)

    return write


def append_batches(decoded: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger=None) -> StreamingQuery:
    w = decoded.writeStream.foreachBatch(batch_writer(path, fmt)).option("checkpointLocation", checkpoint)
    return with_trigger(w, trigger).start()


def ingest_bronze(
    spark: SparkSession,
    kind: str,
    bronze_path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger="5 seconds",
    source_options: dict | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Source → decode → bronze. Returns the running query to the caller."""
    raw, payload = read_wire_stream(spark, kind, **(source_options or {}))
    return write_bronze_stream(
        from_wire(raw, payload), bronze_path, checkpoint, fmt, trigger, max_files_per_batch=max_files_per_batch
    )


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until a query ends by itself, as an ``availableNow`` one does.

    Its error is re-raised. A query still running after ``timeout_s`` is
    stopped and raises ``TimeoutError``: what it has written is only part of
    its input. To run a continuous query for a while, use ``run_for``.
    """
    try:
        ended = query.awaitTermination() is None if timeout_s is None else query.awaitTermination(timeout_s)
    except Exception as e:
        raise RuntimeError(f"streaming query {query.id} failed: {e}") from e
    finally:
        if query.isActive:
            query.stop()
    if not ended:
        raise TimeoutError(f"streaming query {query.id} was stopped after {timeout_s} s with input left to read")
    return query


def run_for(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Run a continuous query, for ``seconds`` if given, then stop it.

    Returns whether it was stopped here (its checkpoint holds the place, and
    a restart goes on from it). Its error is re-raised.
    """
    try:
        ended = query.awaitTermination() is None if seconds is None else query.awaitTermination(seconds)
    except Exception as e:
        raise RuntimeError(f"streaming query {query.id} failed: {e}") from e
    finally:
        if query.isActive:
            query.stop()
    return not ended
