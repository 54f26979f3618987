"""File sinks: partitioned Parquet (silver, gold), CSV, bronze batches (K4, K8).

``write_partitioned`` shuffles once with a ``rebalance`` hint on the
partition columns: rows of a day go to the same tasks (few files per day),
and adaptive execution splits a hot day into several tasks of the advisory
size and merges small days, so a day holding a third of all rows is written
by many tasks, not one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow import schema as S


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols=S.PARTITION_COLS,
    mode: str = "overwrite",
    dynamic: bool = False,
    rebalance: bool = True,
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a Hive-partitioned table.

    ``dynamic=True`` replaces only the partitions present in ``df`` (for
    incremental rebuilds of touched days); the default rewrites the table.
    """
    out = df.hint("rebalance", *partition_cols) if rebalance else df
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*partition_cols).format(fmt).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV export with a header line (K8); one file per task."""
    df.write.mode(mode).option("header", header).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Plain batch write of a bronze-style table."""
    df.write.mode(mode).format(fmt).save(path)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return bool(fs.exists(at))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system; a missing one is no error."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file from the driver, on any file system."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def replace_folder(spark: SparkSession, staged: str, final: str) -> None:
    """Put a written folder in the place of another by renaming it.

    One metadata operation on file systems with atomic rename; on object
    stores it copies, so readers there should go by a table format's log.
    """
    fs, at = _file_system(spark, staged)
    to = _file_system(spark, final)[1]
    fs.delete(to, True)
    if not fs.rename(at, to):
        raise OSError(f"{staged} could not be renamed to {final}")
