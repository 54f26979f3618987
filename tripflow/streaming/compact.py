"""Small files of a batch-wise table packed into large ones (K1–K3), without a moment in which readers see either both or neither.

A stream that appends every few seconds leaves a ``batch_id=N`` folder each time. ``compact_batches``
packs runs of neighbouring batches into folders of about ``target_bytes``, in one
Spark job, and names them after the batches they hold (``part=t1_0_99``, see
``tiers``). The new folder is written aside and renamed into the table; from then on it is in
force, and the folders it covers are dead. ``read_batches`` reads the live folders only,
so every reader sees every batch once, before, during and after. Dead folders stay
for readers that have begun, until ``vacuum_batches``.

A crash leaves a hidden folder at most, which the next run removes; a repeated run
finds nothing left to pack. Folders that already have ``target_bytes`` are not
written again, so over the table's life a row is rewritten as often as the
logarithm of its size in batches. One compaction at a time; the stream may go on
meanwhile, as it only adds batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import schema as S
from tripflow.sinks.files import _file_system, delete_folder, folder_exists, replace_folder
from tripflow.streaming import tiers as T

TARGET_BYTES = 256 << 20
_STAGED = "_compacting-"


def _folders(spark: SparkSession, root: str) -> dict[T.Part, str]:
    """All parts of a table and their folder names."""
    out = {}
    for name in T.children(spark, root):
        key, _, value = name.partition("=")
        if key == "batch_id" and value.isdigit():
            out[T.new_part(int(value))] = name
        elif key == T.PART_COL and (part := T.parse(value)):
            out[part] = name
    return out


def live_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders that hold each batch once, oldest first."""
    found = _folders(spark, root)
    return [f"{root.rstrip('/')}/{found[p]}" for p in T.live(found)]


def read_batches(spark: SparkSession, root: str, schema: StructType = S.TRIP, fmt: str = "parquet") -> DataFrame:
    """The table as it stands: its live folders (of a table without batches, no rows)."""
    folders = live_folders(spark, root)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(folders)


def pack(sizes: list[tuple[T.Part, int]], target_bytes: int) -> list[list[T.Part]]:
    """Runs of neighbouring parts to be packed together: each of at least two, and closed by the part that fills it."""
    runs, held, size = [], [], 0
    for part, n in [*sizes, (None, target_bytes)]:
        if n >= target_bytes:  # large enough as it is, or the end
            runs.append(held)
            held, size = [], 0
            continue
        held.append(part)
        size += n
        if size >= target_bytes:
            runs.append(held)
            held, size = [], 0
    return [r for r in runs if len(r) > 1]


def compact_batches(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, schema: StructType = S.TRIP, fmt: str = "parquet") -> int:
    """Pack small batches; returns how many folders were made."""
    root = root.rstrip("/")
    for name in T.children(spark, root):
        if name.startswith(_STAGED):
            delete_folder(spark, f"{root}/{name}")  # of a run that was cut off
    found = _folders(spark, root)
    sizes = []
    for p in T.live(found):
        fs, at = _file_system(spark, f"{root}/{found[p]}")
        sizes.append((p, int(fs.getContentSummary(at).getLength())))
    runs = pack(sizes, target_bytes)
    if not runs:
        return 0
    new = {T.Part(1 + max(p.tier for p in run), run[0].first, run[-1].last): run for run in runs}
    names = spark.createDataFrame([(found[p], part.name) for part, run in new.items() for p in run], "folder string, part string")  # a row per folder
    rows = spark.read.schema(schema).format(fmt).load([f"{root}/{found[p]}" for run in runs for p in run])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    columns = rows.columns
    tagged = rows.select("*", F.url_decode(folder).alias("_folder")).join(F.broadcast(names), F.col("_folder") == F.col("folder"))
    staged = f"{root}/{_STAGED}{uuid.uuid4().hex}"
    # Rebalanced by part: neighbouring rows of a part fill its files, a large part has several.
    tagged.select(*columns, F.col("part").alias(T.PART_COL)).hint("rebalance", T.PART_COL).write.partitionBy(T.PART_COL).format(fmt).save(staged)
    made = 0
    for part in new:
        if folder_exists(spark, f"{staged}/{T.PART_COL}={part.name}"):
            replace_folder(spark, f"{staged}/{T.PART_COL}={part.name}", f"{root}/{T.PART_COL}={part.name}")
            made += 1
    delete_folder(spark, staged)
    return made


def vacuum_batches(spark: SparkSession, root: str) -> int:
    """Delete folders that a packed one covers; returns how many. For when no reader of before is left."""
    found = _folders(spark, root)
    dead = {*found} - {*T.live(found)}
    for p in dead:
        delete_folder(spark, f"{root.rstrip('/')}/{found[p]}")
    return len(dead)
