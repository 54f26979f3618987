"""Composite jobs (J2–J6): the transforms wired to sources and sinks.

Each job is one Spark plan per written table; steps hand over through the
written tables, which also cut lineage, so a lost executor re-runs only the
tasks of the current stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow import schema as S
from tripflow.operators import gold as G
from tripflow.operators import sample as SM
from tripflow.operators import silver as SV
from tripflow.operators.wire import to_wire
from tripflow.sinks.files import delete_folder, folder_exists, write_csv, write_partitioned
from tripflow.sources import files as SF


def silver_job(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    on_bad_value: str = "fail",
    nan_policy: str = "keep",
    dynamic: bool = False,
    stats: dict | None = None,
    rebalance: bool = True,
    bronze_format: str = "json",
    reject_path: str | None = None,
) -> DataFrame:
    """Bronze directory (JSON, or Parquet as the cloud variant writes it)
    → silver table, partitioned by pickup y/m/d.

    The write shuffles once by day (a rebalance that splits hot days), so the
    number of files follows the data, not tasks x days. ``rebalance=False``
    writes map-only, one file per task and day: for bronze known to be in
    arrival order, where a task's rows span a day or two.

    ``on_bad_value="null"``: clean trips with a datetime that does not parse
    are written as they came to ``reject_path`` (default: beside silver,
    ``<silver>_rejects``), and silver holds none of them.

    With ``stats`` (a dict), rows read, written and, in "null" mode, diverted
    are counted while the writes run (``observe``): ``rows_in``, ``rows_out``,
    ``rows_rejected``.
    """
    bronze = SF.read_bronze(spark, bronze_path, fmt=bronze_format)
    counted = {n: Observation(n) for n in ("rows_in", "rows_out", "rows_rejected")}

    def watched(df: DataFrame, name: str) -> DataFrame:
        return df if stats is None else df.observe(counted[name], F.count(F.lit(1)).alias("rows"))

    if on_bad_value == "null":
        silver, _ = SV.split_silver(watched(bronze, "rows_in"), nan_policy)
        _, rejects = SV.split_silver(bronze, nan_policy)
        watched(rejects, "rows_rejected").write.mode("overwrite").parquet(reject_path or f"{silver_path.rstrip('/')}_rejects")
    else:
        silver = SV.build_silver(watched(bronze, "rows_in"), on_bad_value, nan_policy)
        counted.pop("rows_rejected")
    write_partitioned(watched(silver, "rows_out"), silver_path, dynamic=dynamic, rebalance=rebalance)
    if stats is not None:
        stats |= {name: int(obs.get["rows"]) for name, obs in counted.items()}
    return SF.read_table(spark, silver_path)


def gold_job(spark: SparkSession, silver_path: str, gold_path: str, on_bad_value: str = "fail", dynamic: bool = False) -> DataFrame:
    """Silver table → gold table, same partitioning."""
    gold = G.build_gold(SF.read_table(spark, silver_path, S.SILVER), on_bad_value)
    write_partitioned(gold, gold_path, dynamic=dynamic)
    return SF.read_table(spark, gold_path)


def refresh_gold_days(spark: SparkSession, silver_path: str, gold_path: str, days, on_bad_value: str = "fail") -> DataFrame:
    """Rebuild gold for the given days only (late data, D14 incremental).

    ``days`` holds (pickup_year, pickup_month, pickup_day), null for trips
    without a day, either as a DataFrame (e.g. the partitions of a newly
    appended silver batch; the distinct days come to the driver) or as a list.

    Only those silver folders are listed and read. The rebuilt days replace
    theirs in gold (dynamic overwrite), and a listed day that silver no longer
    has is removed from gold; the rest of gold is untouched. Gold's keys
    contain the day, so the result equals a full rebuild.
    """
    if isinstance(days, DataFrame):
        days = days.select(*S.PARTITION_COLS).distinct().collect()
    listed = set(map(tuple, days))
    present = [d for d in listed if folder_exists(spark, SF.day_path(silver_path, d))]
    if present:
        gold = G.build_gold(SF.read_days(spark, silver_path, present), on_bad_value)
        obs = Observation("refreshed")
        write_partitioned(gold.observe(obs, F.collect_set(F.struct(*S.PARTITION_COLS)).alias("days")), gold_path, dynamic=True)
        listed -= {tuple(d) for d in obs.get["days"] or []}
    for day in listed:
        delete_folder(spark, SF.day_path(gold_path, day))
    return SF.read_table(spark, gold_path)


def export_csv(trips: DataFrame, path: str) -> None:
    """A whole table → CSV with header, one file per task."""
    write_csv(trips.drop(SM.POS, SM.CHUNK), path)


def export_sample(spark: SparkSession, raw_path: str, path: str, how: str = "spread", n: int = 100_000, chunks: int = 10, seed: int = 42) -> int:
    """Head or spread sample of a raw Parquet table → CSV with header.

    Returns the rows of the table a spread sample was drawn from (a head
    sample reads only the files it needs, so it returns ``n``).
    """
    if how == "head":
        export_csv(SM.read_head(spark, raw_path, n), path)
        return n
    raw = SF.read_raw_parquet(spark, raw_path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    pos = SM.with_position(raw)
    export_csv(SM.spread_sample(pos.df, pos.total, n, chunks, seed), path)
    return pos.total


def publish_csv(spark: SparkSession, csv_path: str, **publish_options) -> DataFrame:
    """J6 from a CSV file or folder: read with the trip schema, encode, send (see ``publish``)."""
    return publish(SF.read_csv(spark, csv_path), **publish_options)


def publish(df: DataFrame, key_cols: list[str] | None = None, payload_col: str = "value", sink_format: str | None = None, sink_options: dict | None = None) -> DataFrame:
    """Rows → wire messages (and keys). With ``sink_format`` (e.g. "kafka"
    with ``topic`` and ``kafka.bootstrap.servers``) they are also sent, by
    the executors, in one write; pacing is not reproduced."""
    wire = to_wire(df, payload_col, key_cols)
    if sink_format:
        wire.write.format(sink_format).options(**(sink_options or {})).save()
    return wire
