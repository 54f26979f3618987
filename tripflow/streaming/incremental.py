"""Bronze → silver → gold, incrementally (J2 + J3 with D14's late-data rule).

The batch jobs rebuild silver and gold from all of bronze. On a table that
grows by the hour that is a full pass over everything, every run. Here the
same transforms run as a Structured Streaming query over the bronze
directory: each micro-batch holds only the bronze files that arrived since
the previous one.

Per micro-batch (``foreachBatch``):

0. the batch gets its number in the table from the ``ledger`` of source files,
   and files that another run (another checkpoint) has put into the table are
   left out: a lost checkpoint adds nothing twice;
1. clean + enrich the new trips (the same ``build_silver``: map-only) and
   write them under ``silver/pickup_year=…/pickup_month=…/pickup_day=…/
   ingest_batch=N``, replacing only those folders (dynamic overwrite). A
   replayed batch rewrites its own folders, so every trip is in silver
   exactly once however often a batch is retried. The days the batch holds and
   its files are collected while it is written (``observe`` with ``collect_set``: one
   small set per task, bounded by the days in the batch and
   ``max_files_per_trigger``), with no second pass over it;
2. aggregate just those new trips to the gold keys, as mergeable parts (sums
   and counts), and write them under ``<gold>_partials/…day…/part=t0_N_N``;
3. rebuild gold for just those days by merging their live parts: a micro-batch
   reads its own trips and the parts of the days it touches, never
   the days' trips again. All measures are sums and counts (averages are
   divided at the end), so the result equals a full rebuild, and a replay
   rewrites the same parts and days;
4. record the batch in the ledger;
5. merge the parts of days that have ``fan`` of them in a tier (see ``tiers``): after k
   batches a day has O(log k) parts to read, not k.

With ``on_bad_value="null"``, clean trips with a datetime that does not parse
are diverted per batch to ``reject_path/batch_id=N``.

Readers see silver as one table: ``ingest_batch`` is one more partition
column below the day, and filters on the pickup day still prune folders.
The incremental job owns its silver folder: a folder written by the batch
``silver_job`` (days without ``ingest_batch`` below them) is a different
layout, and the two must not share a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tripflow import schema as S
from tripflow.operators.gold import combine_partials, finish_gold, gold_input, merge_partials, partial_aggregate
from tripflow.operators.silver import build_silver, split_silver
from tripflow.sinks.files import _file_system, delete_folder, write_partitioned
from tripflow.sources import files as SF
from tripflow.streaming import tiers as T
from tripflow.streaming.ingest import batch_writer, with_trigger
from tripflow.streaming.ledger import SourceLedger, run_id

BATCH_COL = "ingest_batch"
SILVER_LAYOUT = [*S.PARTITION_COLS, BATCH_COL]
PARTS_LAYOUT = [*S.PARTITION_COLS, T.PART_COL]
FILE_COL = "_source_file"
FAN = 8
SILVER_STORED = StructType([*S.SILVER.fields, StructField(BATCH_COL, IntegerType())])


def partials_of(gold_path: str) -> str:
    """Where the mergeable parts of a gold table lie."""
    return f"{gold_path.rstrip('/')}_partials"


def ledger_of(silver_path: str) -> str:
    """Where the ledger of the files in a silver table lies."""
    return f"{silver_path.rstrip('/')}_ledger"


def _parts_schema(spark: SparkSession) -> StructType:
    """Of the stored parts: what ``partial_aggregate`` gives, and the part's name."""
    trips = spark.createDataFrame([], S.SILVER)
    return StructType([*partial_aggregate(gold_input(trips)).schema.fields, StructField(T.PART_COL, StringType())])


class GoldParts:
    """The mergeable parts of a gold table, by day."""

    def __init__(self, spark: SparkSession, gold_path: str, fan: int = FAN):
        if fan < 2:
            raise ValueError("fan must be at least 2")
        self.spark, self.gold_path, self.path, self.fan = spark, gold_path, partials_of(gold_path), fan
        self.schema = _parts_schema(spark)

    def of_day(self, day: tuple) -> list[T.Part]:
        return T.parts_in(self.spark, SF.day_path(self.path, day))

    def read(self, parts: dict[tuple, list[T.Part]]) -> DataFrame:
        listed = [(*day, p.name) for day, of in parts.items() for p in of]
        return SF.read_days(self.spark, self.path, listed, PARTS_LAYOUT, self.schema)

    def add(self, new: DataFrame, batch: int) -> None:
        """Write the parts of a batch (rows of ``partial_aggregate``)."""
        named = new.withColumn(T.PART_COL, F.lit(T.new_part(batch).name))
        write_partitioned(named, self.path, partition_cols=PARTS_LAYOUT, dynamic=True)

    def rebuild(self, days: list[tuple]) -> dict[tuple, int]:
        """Gold of the given days from their live parts; returns how many parts each day had to read."""
        parts = {day: found for day in days if (found := T.live(self.of_day(day)))}
        if parts:
            write_partitioned(finish_gold(merge_partials(self.read(parts))), self.gold_path, dynamic=True)
        for day in days:
            if day not in parts:
                delete_folder(self.spark, SF.day_path(self.gold_path, day))
        return {day: len(found) for day, found in parts.items()}

    def compact(self, days: list[tuple]) -> int:
        """Merge the parts of days with a full tier, in one job; returns how many parts went."""
        merges = {day: due for day in days if (due := T.due(self.of_day(day), self.fan))}
        if merges:
            into = [(*day, old.name, new.name) for day, (new, olds) in merges.items() for old in olds]
            names = self.spark.createDataFrame(into, ", ".join([*(f"d_{c} int" for c in S.PARTITION_COLS), "d_part string", "merged string"]))
            same = [F.col(c).eqNullSafe(F.col(f"d_{c}")) for c in S.PARTITION_COLS]
            old = self.read({day: olds for day, (_, olds) in merges.items()})
            tagged = old.join(names, [*same, F.col(T.PART_COL) == F.col("d_part")])
            merged = combine_partials(tagged, [*S.GOLD_KEYS, "merged"]).withColumnRenamed("merged", T.PART_COL)
            write_partitioned(merged, self.path, partition_cols=PARTS_LAYOUT, dynamic=True)
        gone = 0
        for day in days:
            every = self.of_day(day)
            for dead in {*every} - {*T.live(every)}:
                delete_folder(self.spark, SF.day_path(self.path, (*day, dead.name), PARTS_LAYOUT))
                gone += 1
        return gone


def _days_with(spark: SparkSession, root: str, folder: str) -> list[tuple]:
    """Days of a table that have a folder of this name (all day folders are listed)."""
    fs, at = _file_system(spark, f"{root}/*/*/*/{folder}")
    days = []
    for s in fs.globStatus(at) or []:
        above, values = s.getPath().getParent(), []
        for _ in S.PARTITION_COLS:
            value = above.getName().partition("=")[2]
            values.append(None if value == SF.NULL_PARTITION else int(value))
            above = above.getParent()
        days.append(tuple(reversed(values)))
    return days


def silver_gold_batch_writer(spark: SparkSession, silver_path: str, gold_path: str, on_bad_value: str = "fail", fan: int = FAN):
    """Function of (silver rows, batch number): write the rows into the batch's own
    folders, then rebuild the gold days it touched (idempotent). It returns the
    days and how many parts each had to read; ``write.parts`` are the gold parts."""
    parts = GoldParts(spark, gold_path, fan)

    def write(batch: DataFrame, number: int) -> dict[tuple, int]:
        obs = Observation(f"days-{number}")
        tagged = batch.withColumn(BATCH_COL, F.lit(number)).observe(
            obs, F.collect_set(F.struct(*S.PARTITION_COLS)).alias("days")
        )
        # Bronze arrives in time order: a batch holds few days, so a
        # map-only write gives few files per day.
        write_partitioned(tagged, silver_path, partition_cols=SILVER_LAYOUT, dynamic=True, rebalance=False)
        days = [tuple(d) for d in obs.get.get("days") or []]
        if not days:
            return {}  # an empty batch: nothing written, nothing to refresh
        new = SF.read_days(spark, silver_path, [(*d, number) for d in days], SILVER_LAYOUT, SILVER_STORED)
        parts.add(partial_aggregate(gold_input(new, on_bad_value)), number)
        return parts.rebuild(days)

    write.parts = parts
    return write


def undo_batch(spark: SparkSession, silver_path: str, parts: GoldParts, number: int) -> None:
    """Take an unfinished batch out of silver and gold."""
    trips, part = f"{BATCH_COL}={number}", f"{T.PART_COL}={T.new_part(number).name}"
    days = {*_days_with(spark, silver_path, trips), *_days_with(spark, parts.path, part)}
    for day in days:
        delete_folder(spark, f"{SF.day_path(silver_path, day)}/{trips}")
        delete_folder(spark, f"{SF.day_path(parts.path, day)}/{part}")
    parts.rebuild(sorted(days, key=repr))


def silver_gold_incremental(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    gold_path: str,
    checkpoint: str,
    bronze_format: str = "json",
    trigger="available_now",
    max_files_per_trigger: int = 1000,
    on_bad_value: str = "fail",
    nan_policy: str = "keep",
    reject_path: str | None = None,
    fan: int = FAN,
) -> StreamingQuery:
    """Start the incremental silver + gold query over a bronze directory.

    Bronze is read through its sink log (as a directory, D13) with the fixed
    trip schema; ``max_files_per_trigger`` bounds each micro-batch, and with it
    the file names that come to the driver. The
    offsets of processed files live in ``checkpoint``, and their names in the
    ledger beside silver, so a new checkpoint over the same tables goes on
    where the old one stood.
    """
    reader = spark.readStream.schema(S.TRIP).format(bronze_format).option("maxFilesPerTrigger", str(max_files_per_trigger))
    bronze = reader.load(bronze_path).select("*", F.col("_metadata.file_path").alias(FILE_COL))
    write = silver_gold_batch_writer(spark, silver_path, gold_path, on_bad_value, fan)
    rejected = batch_writer(reject_path or f"{silver_path.rstrip('/')}_rejects")
    ledgers: list[SourceLedger] = []

    def write_bronze(batch: DataFrame, batch_id: int) -> None:
        if not ledgers:  # the checkpoint has its id once the query runs
            ledgers.append(SourceLedger(spark, ledger_of(silver_path), run_id(spark, checkpoint)))
        ledger = ledgers[0]
        number = ledger.begin(batch_id, lambda seq: undo_batch(spark, silver_path, write.parts, seq))
        if seen := ledger.seen(batch.select(F.col(FILE_COL).alias("file"))):
            batch = batch.filter(~F.col(FILE_COL).isin(seen))
        obs = Observation(f"files-{number}")
        watched = batch.observe(obs, F.collect_set(FILE_COL).alias("files")).drop(FILE_COL)
        if on_bad_value == "null":
            silver, _ = split_silver(watched, nan_policy)
            _, bad = split_silver(batch.drop(FILE_COL), nan_policy)
            rejected(bad, number)
        else:
            silver = build_silver(watched, on_bad_value, nan_policy)
        days = write(silver, number)
        ledger.finish(batch_id, number, list(obs.get.get("files") or []))
        write.parts.compact([*days])

    writer = bronze.writeStream.foreachBatch(write_bronze)
    return with_trigger(writer.option("checkpointLocation", checkpoint), trigger).start()
