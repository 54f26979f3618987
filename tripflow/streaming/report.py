"""What a stream has done, from its checkpoint: one row per batch and source (T3, item of operations).

A checkpoint keeps a file per batch under ``offsets`` (planned: when, from which position
to read) and ``commits`` (finished). ``checkpoint_report`` reads both as text, in one
small Spark job over the files Spark has kept (100 batches by default), and says for each batch whether it was
committed, when it was planned, how long after the batch before it, where each source
stood, and by how much it had moved: messages for Kafka (the sum over its partitions),
files for a file source.

Defined results: the first batch kept has no gap, and no advance either, unless it is batch 0 of a
file source, whose positions begin at 0; a source whose positions are no numbers (or one
that read nothing yet) has null positions; a checkpoint without batches has no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.sinks.files import folder_exists

REPORT = "batch_id bigint, source int, kind string, committed boolean, planned timestamp, gap_s double, position bigint, advance bigint"


def _log(spark: SparkSession, checkpoint: str, log: str) -> DataFrame:
    """(batch_id, lines) of each file of a checkpoint's log."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/{log}", wholetext=True)
    named = text.select(F.col("_metadata.file_name").alias("name"), F.split("value", "\n").alias("lines"))
    return named.filter(F.col("name").rlike("^[0-9]+$")).select(F.col("name").cast("bigint").alias("batch_id"), "lines")


def checkpoint_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The columns of ``REPORT``, a row per batch and source."""
    if not folder_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        return spark.createDataFrame([], REPORT)
    # Line 1: format version; line 2: about the batch; then a line per source ("-": nothing read yet).
    planned = _log(spark, checkpoint, "offsets").select(
        "batch_id",
        F.timestamp_millis(F.get_json_object(F.get("lines", F.lit(1)), "$.batchTimestampMs").cast("bigint")).alias("planned"),
        F.posexplode(F.filter(F.slice("lines", F.lit(3), F.greatest(F.size("lines") - 2, F.lit(0))), lambda x: x != "")).alias("source", "offset"),
    )
    files = F.get_json_object("offset", "$.logOffset").cast("bigint")
    topics = F.from_json("offset", "map<string,map<string,bigint>>")
    read = F.aggregate(F.flatten(F.transform(F.map_values(topics), F.map_values)), F.lit(0).cast("bigint"), lambda a, n: a + F.coalesce(n, F.lit(0)))
    kind = F.when(files.isNotNull(), "files").when(read.isNotNull() & F.col("offset").startswith("{"), "messages")
    # A file source's offset is the last entry of its log, counted from 0.
    position = F.when(kind == "files", files + 1).when(kind == "messages", read)
    rows = planned.select("batch_id", "source", "planned", kind.alias("kind"), position.alias("position"))
    if folder_exists(spark, f"{checkpoint.rstrip('/')}/commits"):
        done = _log(spark, checkpoint, "commits").select("batch_id", F.lit(True).alias("done"))
    else:
        done = spark.createDataFrame([], "batch_id bigint, done boolean")
    batches = Window.partitionBy("source").orderBy("batch_id")  # as many rows as batches are kept
    start = F.when((F.col("kind") == "files") & (F.col("batch_id") == 0), F.lit(0))
    return rows.join(done, "batch_id", "left").select(
        "batch_id",
        "source",
        "kind",
        F.coalesce("done", F.lit(False)).alias("committed"),
        "planned",
        (F.col("planned").cast("double") - F.lag(F.col("planned").cast("double")).over(batches)).alias("gap_s"),
        "position",
        (F.col("position") - F.coalesce(F.lag("position").over(batches), start)).alias("advance"),
    )
