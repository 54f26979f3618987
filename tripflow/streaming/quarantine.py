"""Ingest that loses and doubles nothing: bad messages are kept aside, redelivered ones dropped.

**Quarantine.** PERMISSIVE decoding turns a message that cannot be read into a row of
nulls, which the silver rules then drop: the message is gone. Here each
micro-batch is committed to two tables: rows that decode, and, for the rest, the
raw payload with the reason. The batch is decoded and written once, in a hidden
folder divided by verdict; then each half is renamed to its table's ``batch_id=N``
folder, the quarantine first. A replay writes and renames both again, so good
and quarantined rows together are the messages, whatever step a crash hits.

Reasons: ``no payload`` (null), ``not a record`` (no JSON object of which a field could be
read), ``wrong type`` (a record with a field of another type than the contract's).

**Duplicate deliveries.** A producer that retries, or a replayed source file, delivers
records again under other offsets. ``drop_redelivered`` keeps the first of the records
with one key that arrive within a stated time of it (``dropDuplicatesWithinWatermark``).
The clock is the arrival time, so no record is ever too late, however old the
trip; a redelivery after that time counts as a new record. The state holds a
32-byte key for each record that arrived within that time (twice that at most, until
the next batch moves the watermark), spread over the shuffle partitions;
for a large one use Spark's RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tripflow import schema as S
from tripflow.operators.wire import CORRUPT, from_wire, payload_text
from tripflow.sinks.files import delete_folder, folder_exists, replace_folder
from tripflow.streaming.ingest import read_wire_stream, with_trigger, write_bronze_stream

NO_PAYLOAD, NOT_A_RECORD, WRONG_TYPE = "no payload", "not a record", "wrong type"
VERDICT = "verdict"
QUARANTINE = StructType([StructField("payload", BinaryType()), StructField("reason", StringType())])


def judge_messages(raw: DataFrame, payload_col: str = "value", schema: StructType = S.TRIP) -> DataFrame:
    """Fields of the contract, ``payload`` and ``reason`` (null for good rows) and ``verdict`` (good or bad)."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = raw.select(F.col(payload_col).alias("_raw"), F.from_json(payload_text(payload_col), wide, {"columnNameOfCorruptRecord": CORRUPT}).alias("_data"))
    nothing = F.coalesce(*[F.col(f"_data.{f.name}").cast("string") for f in schema.fields]).isNull()
    corrupt = F.col(f"_data.{CORRUPT}").isNotNull()
    reason = (
        F.when(F.col("_raw").isNull(), NO_PAYLOAD)
        .when(F.col("_data").isNull() | (corrupt & nothing), NOT_A_RECORD)
        .when(corrupt, WRONG_TYPE)
    )
    judged = parsed.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return judged.select(
        *[F.when(good, F.col(f"_data.{f.name}")).alias(f.name) for f in schema.fields],
        F.when(~good, F.col("_raw")).alias("payload"),
        "reason",
        F.when(good, "good").otherwise("bad").alias(VERDICT),
    )


def quarantine_writer(good_path: str, bad_path: str, fmt: str = "parquet"):
    """foreachBatch function over ``judge_messages`` rows: one write, two tables.

    It returns (good, bad) row counts. Files of the good table carry ``payload`` and ``reason`` as
    nulls, which readers by the contract's schema never see.
    """

    def write(batch: DataFrame, batch_id: int) -> tuple[int, int]:
        spark = batch.sparkSession
        obs = Observation(f"verdicts-{batch_id}-{uuid.uuid4().hex[:8]}")
        staged = f"{good_path}/_batch_id={batch_id}"
        counted = batch.observe(obs, *(F.count_if(F.col(VERDICT) == v).alias(v) for v in ("good", "bad")))
        counted.write.mode("overwrite").partitionBy(VERDICT).format(fmt).save(staged)
        rows = obs.get
        for verdict, path in (("bad", bad_path), ("good", good_path)):
            half, final = f"{staged}/{VERDICT}={verdict}", f"{path}/batch_id={batch_id}"
            if rows.get(verdict):
                _make_parent(spark, path)
                replace_folder(spark, half, final)
            elif folder_exists(spark, final):
                delete_folder(spark, final)
        delete_folder(spark, staged)
        return int(rows.get("good") or 0), int(rows.get("bad") or 0)

    return write


def _make_parent(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def ingest_quarantine(
    spark: SparkSession,
    kind: str,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger="5 seconds",
    source_options: dict | None = None,
    redelivered_within: str | None = None,
) -> StreamingQuery:
    """J1 with a quarantine: source → decode → bronze and quarantine. Returns the running query."""
    raw, payload = read_wire_stream(spark, kind, **(source_options or {}))
    if redelivered_within:
        raw = drop_redelivered(raw, payload, redelivered_within)
    writer = quarantine_writer(bronze_path, quarantine_path, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)

    stream = judge_messages(raw, payload).writeStream.foreachBatch(write)
    return with_trigger(stream.option("checkpointLocation", checkpoint), trigger).start()


def read_quarantine(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(payload, reason, batch_id) of a quarantine table; no rows if it was never written."""
    schema = StructType([*QUARANTINE.fields, StructField("batch_id", S.GOLD["total_rides"].dataType)])
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def drop_redelivered(raw: DataFrame, payload_col: str = "value", within: str = "1 hour", key_cols: list[str] | None = None) -> DataFrame:
    """``raw`` without records that arrive again within ``within`` of their first arrival.

    Records are equal if their payloads are, or, with ``key_cols`` (fields of the contract,
    e.g. a trip's id), if these fields are. Messages without a key (no payload, or one that
    does not decode) are never dropped.
    """
    if key_cols:
        fields = StructType([S.TRIP[c] for c in key_cols])
        key = F.from_json(payload_text(payload_col), fields)
        known = F.coalesce(*[key[c].cast("string") for c in key_cols]).isNotNull()
        key = F.when(known, F.to_json(key, {"ignoreNullFields": "false"}).cast("binary"))
    else:
        key = F.col(payload_col).cast("binary")
    own = F.unhex(F.replace(F.uuid(), F.lit("-")))
    keyed = raw.withColumns({"_key": F.coalesce(F.unhex(F.sha2(key, 256)), own), "_arrived": F.current_timestamp()})
    return keyed.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def ingest_once(
    spark: SparkSession,
    kind: str,
    bronze_path: str,
    checkpoint: str,
    within: str = "1 hour",
    fmt: str = "json",
    trigger="5 seconds",
    source_options: dict | None = None,
    key_cols: list[str] | None = None,
) -> StreamingQuery:
    """J1 without duplicate deliveries: source → ``drop_redelivered`` → decode → bronze."""
    raw, payload = read_wire_stream(spark, kind, **(source_options or {}))
    return write_bronze_stream(from_wire(drop_redelivered(raw, payload, within, key_cols), payload), bronze_path, checkpoint, fmt, trigger)
