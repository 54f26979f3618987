"""File sources: bronze JSON, partitioned Parquet, CSV, raw Parquet.

Tables are read as directories, never by glob, so a streaming sink's
``_spark_metadata`` log decides which files are committed (D13), and Spark
discovers Hive-style partition columns from the table root (D12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import schema as S


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = S.TRIP, fmt: str = "json") -> DataFrame:
    """Bronze table (S4). With the fixed schema, stored "NaN" reads back as NaN
    and unparsable text as null; ``schema=None`` infers (one extra pass;
    columns come back alphabetical and may be typed as text, D3)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if schema is not None:
        return df
    # Inference drops a column that is null in every row: it comes back as typed nulls.
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.TRIP.fields])


def read_table(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Partitioned Parquet table read from its root (S5): partition columns are
    discovered (as int for y/m/d) and filters on them prune directories. With
    ``schema`` (e.g. ``schema.SILVER``) no file footer is read to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root)


def read_day(spark: SparkSession, root: str, year: int, month: int, day: int, partition_cols=S.PARTITION_COLS) -> DataFrame:
    """One day of a partitioned table (S6, F6): a partition filter on the root,
    so only that directory is listed and read, and the columns stay filled."""
    y, m, d = partition_cols
    return read_table(spark, root).filter((F.col(y) == year) & (F.col(m) == month) & (F.col(d) == day))


# Folder name Spark writes for a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def day_path(root: str, day, partition_cols=S.PARTITION_COLS) -> str:
    """Folder of one day (or deeper partition) of a table; null has its own folder name."""
    return "/".join([root.rstrip("/")] + [f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(partition_cols, day)])


def read_days(spark: SparkSession, root: str, days, partition_cols=S.PARTITION_COLS, schema: StructType | None = None) -> DataFrame:
    """The given days of a partitioned table, listing only their folders.

    ``days`` is a small list of (year, month, day) tuples. Unlike a filter
    on the root, which lists every folder of the table before pruning, this
    reads the day folders by path (``basePath`` keeps the partition columns,
    and any deeper partition folders below a day are discovered as usual).
    Every listed day must exist: a missing folder raises ``PATH_NOT_FOUND``
    before any job runs, rather than silently reading nothing. With ``schema``
    no file footer is read to infer it.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", root.rstrip("/")).parquet(*[day_path(root, day, partition_cols) for day in days])


def list_partitions(spark: SparkSession, root: str, partition_cols=S.PARTITION_COLS) -> DataFrame:
    """Distinct (integer) partition values of a table (S7), from its folder
    names: no data file is listed or opened."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [((), at)]
    for c in partition_cols:
        below = [(values, s.getPath()) for values, folder in found for s in fs.listStatus(folder) if s.isDirectory()]
        named = [(values, p, p.getName()) for values, p in below if p.getName().startswith(f"{c}=")]
        found = [((*values, None if (v := name.partition("=")[2]) == NULL_PARTITION else int(v)), p) for values, p, name in named]
    return spark.createDataFrame([values for values, _ in found], ", ".join(f"{c} int" for c in partition_cols))


def read_csv(spark: SparkSession, path: str, schema: StructType = S.TRIP, header: bool = True) -> DataFrame:
    """CSV with header and a fixed schema (S8); no inference pass."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Raw Parquet file or folder (S9). A missing path raises when the
    DataFrame is created (``PATH_NOT_FOUND``), before any job runs."""
    return spark.read.parquet(path)
