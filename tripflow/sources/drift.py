"""Bronze whose files do not all have the contract's schema (S4, L7): read to the contract, with a report.

Producers change: a column turns from whole numbers to decimals, comes as text, is
missing, or is new. Spark reads a Parquet table by one schema, and fails at (or
misreads) files of another. Here the folders of a batch-wise table (files of one
batch have one schema) are grouped by the schema they really have, each group is
read by its own, and its columns are brought to the contract by the plan below;
the table is the union of a few such scans. Nothing is inferred from data.

Found schemas are kept beside the table (``<root>_schemas``), so each run opens one footer of
each *new* folder only, several at a time, however many there are.

| found | contract | action |
|---|---|---|
| same type | | ``as is`` |
| other number | number | ``widen`` (cast) |
| text | number | ``parse`` (NaN stays NaN; text that is no number becomes null and is counted) |
| number, boolean, date, timestamp | text | ``print`` (timestamps in the contract's format) |
| nothing | any | ``missing`` (null) |
| any | nothing | ``extra`` (dropped) |
| other | any | ``unreadable`` (null) |
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

from tripflow import schema as S
from tripflow.sinks.files import folder_exists
from tripflow.streaming.compact import live_folders

THREADS = 8
LOG = "folder string, found string"
REPORT = "column_name string, found_type string, expected_type string, action string, n_folders bigint, ok boolean"


def schema_groups(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Schema (as JSON) → the table's live folders that have it; new folders are looked at and noted."""
    root = root.rstrip("/")
    log = f"{root}_schemas"
    folders = live_folders(spark, root)
    known = {}
    if folder_exists(spark, log):
        known = {r.folder: r.found for r in spark.read.schema(LOG).parquet(log).collect()}  # a row per folder
    new = [f for f in folders if f not in known]

    def look(folder: str) -> tuple[str, str]:
        return folder, spark.read.parquet(folder).schema.json()

    if new:
        with ThreadPoolExecutor(THREADS) as pool:
            found = list(pool.map(look, new))
        spark.createDataFrame(found, LOG).coalesce(1).write.mode("append").parquet(log)
        known |= dict(found)
    out: dict[str, list[str]] = {}
    for f in folders:
        out.setdefault(known[f], []).append(f)
    return out


def action(found: DataType | None, expected: DataType | None) -> str:
    """What brings a column of one type to another (None: the column is not there)."""
    if expected is None:
        return "extra"
    if found is None:
        return "missing"
    if found == expected:
        return "as is"
    if isinstance(expected, NumericType):
        return "widen" if isinstance(found, NumericType) else "parse" if isinstance(found, StringType) else "unreadable"
    if isinstance(expected, StringType):
        return "print" if isinstance(found, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)) else "unreadable"
    return "unreadable"


def _brought(name: str, found: DataType | None, expected: DataType) -> Column:
    c, how = F.col(f"`{name}`"), action(found, expected)
    if how in ("missing", "unreadable"):
        c = F.lit(None).cast(expected)
    elif how in ("widen", "parse"):
        c = c.try_cast(expected)
    elif how == "print":
        c = F.date_format(c, S.TS_FORMAT) if isinstance(found, (TimestampType, TimestampNTZType)) else c.cast("string")
    return c.alias(name)


def _types(schema: StructType) -> dict[str, DataType]:
    return {f.name: f.dataType for f in schema.fields}


def read_drifted(spark: SparkSession, root: str, contract: StructType = S.TRIP, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """The table by the contract: one scan for each schema that occurs (no rows for an empty table)."""
    groups = schema_groups(spark, root) if groups is None else groups
    scans = []
    for found, folders in groups.items():
        physical = StructType.fromJson(json.loads(found))
        types = _types(physical)
        scans.append(spark.read.schema(physical).parquet(*folders).select(*[_brought(f.name, types.get(f.name), f.dataType) for f in contract.fields]))
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], contract)


def _names(types: Iterable[dict[str, DataType]], contract: StructType) -> list[str]:
    return list(dict.fromkeys([*contract.names, *(n for t in types for n in t)]))


def drift_report(spark: SparkSession, root: str, contract: StructType = S.TRIP) -> DataFrame:
    """A row for each column and type that occurs: what is found, what is done, in how many folders.

    ``ok`` is false where values are lost: ``unreadable`` and ``extra`` columns. From the schemas alone.
    """
    groups = [(_types(StructType.fromJson(json.loads(found))), len(folders)) for found, folders in schema_groups(spark, root).items()]
    expected, rows = _types(contract), {}
    for name in _names((t for t, _ in groups), contract):
        for types, n in groups:
            if name in types or name in expected:
                found = types.get(name)
                how = action(found, expected.get(name))
                key = (name, found and found.simpleString(), name in expected and expected[name].simpleString() or None, how)
                rows[key] = rows.get(key, 0) + n
    return spark.createDataFrame([(*key, n, key[3] not in ("unreadable", "extra")) for key, n in rows.items()], REPORT)


def unparsed(spark: SparkSession, root: str, contract: StructType = S.TRIP) -> DataFrame:
    """(column_name, n_rows): texts that are no numbers where the contract has a number (read as null)."""
    counts = []
    for found, folders in schema_groups(spark, root).items():
        physical = StructType.fromJson(json.loads(found))
        types = _types(physical)
        texts = [f for f in contract.fields if action(types.get(f.name), f.dataType) == "parse"]
        if texts:
            bad = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name) for f in texts]
            counts.append(spark.read.schema(physical).parquet(*folders).agg(*bad).unpivot([], [f.name for f in texts], "column_name", "n"))
    if not counts:
        return spark.createDataFrame([], "column_name string, n_rows bigint")
    return reduce(DataFrame.unionByName, counts).groupBy("column_name").agg(F.sum("n").alias("n_rows"))
