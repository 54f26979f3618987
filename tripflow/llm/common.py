"""Shared helpers: tables, Arrow batches in bounded slices, worker-lifetime memory."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripflow.session import scratch_path

# Text handled at once inside a task; batches above it are cut into row ranges.
SLICE_BYTES = 8 << 20
MAX_TOKENIZER_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def read_tokenizer(path: str) -> str:
    """Text of a tokenizer file, read by the driver (at most ``MAX_TOKENIZER_BYTES``) to be broadcast."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(text) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} has more than {MAX_TOKENIZER_BYTES} characters")
    return text


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the table has no such column (in any case, as Spark compares names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``df.mapInArrow`` for tables whose column names may have dots, which Spark's own does not find."""
    names = {}
    for c in df.columns:
        if "." in c or "`" in c:
            names[c] = free_name(df.select(*map(quoted, df.columns), *(F.lit(None).alias(n) for n in names.values())), c.replace(".", "_").replace("`", "_"))
    plain = StructType([StructField(names.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    return df.toDF(*(names.get(c, c) for c in df.columns)).mapInArrow(run, plain).toDF(*schema.names)


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with the fields of ``ddl`` after it; names must not clash (in any case)."""
    more = StructType.fromDDL(ddl)
    taken = {c.lower() for c in df.columns}
    if clash := {n for n in more.names if n.lower() in taken}:
        raise ValueError(f"the table already has columns {sorted(clash)}")
    return StructType([*df.schema.fields, *more.fields])


def worker_memo(owner: str, name: str, make: Callable):
    """A value kept for the life of the Python worker process (``make()`` on first use).

    Functions are shipped by value, so module globals do not outlive a task.
    A worker keeps the values of one owner (an operator) at a time: those of
    the operator before it are let go, so a chain of operators does not add up.
    """
    home = sys.modules.setdefault("_tripflow_worker", types.ModuleType("_tripflow_worker")).__dict__
    if home.get("owner") != owner:
        home["owner"], home["values"] = owner, {}
    if name not in home["values"]:
        home["values"][name] = make()
    return home["values"][name]


def gapless(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows as a stored table, numbered from 0 in ``column`` in the order they have, part by part."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    at = free_name(df, "_at")
    kept = df.withColumn(at, F.monotonically_increasing_id())
    kept.write.parquet(path)
    rows = spark.read.schema(kept.schema).parquet(path)
    part, n, start = (free_name(kept, c) for c in ("_part", "_n", "_start"))
    sizes = rows.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count(F.lit(1)).alias(n))  # a row a part
    starts = sizes.select(part, F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(start))
    number = (F.col(start) + quoted(at).bitwiseAND((1 << 33) - 1)).cast("long")
    return rows.withColumn(part, F.shiftright(at, 33)).join(starts, part).select(*map(quoted, df.columns), number.alias(column))


class BoundedCache(dict):
    """A memo that starts again when it holds ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room(self, n: int = 1) -> None:
        if len(self) + n > self.limit:
            self.clear()


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def utf8_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of the texts of a batch; null counts as empty."""
    col = batch.column(column)
    col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return [b"" if t is None else t for t in col.to_pylist()]


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """(key, other columns as arrays) of each run of rows with equal integer keys.

    For partitions sorted by ``keys``; holds one group and one batch at a time.
    """
    held: list[dict[str, np.ndarray]] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        turn = np.zeros(batch.num_rows, bool)
        for k in keys:
            turn[1:] |= columns[k][1:] != columns[k][:-1]
        cuts = [0, *np.flatnonzero(turn).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            key = tuple(int(columns[k][lo]) for k in keys)
            if key != current:
                if held:
                    yield current, _joined(held)
                current, held = key, []
            held.append({c: v[lo:hi] for c, v in columns.items() if c not in keys})
    if held:
        yield current, _joined(held)


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
