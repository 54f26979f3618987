"""Positional samples: first N rows and the spread sample.

Row position means file order, as a reader of the raw file sees it: position
= (rows in the files before this one, by file name) + the row's index inside
its file (``_metadata.row_index``). Only the per-file row counts are
aggregated, so numbering the rows needs no shuffle of the data and no global
window; the offset table has one row per file, and its running sum is itself
computed in ranges (``file_offsets``).

The spread sample cuts the positions into equal contiguous chunks and draws
``sample_size // chunks`` rows from each, without replacement: those with the
lowest keyed hash (MD5 of seed and position), which is a random draw that any
engine can repeat. The rounding shortfall (fewer than ``chunks`` rows) takes
the next-lowest of chunks in a seeded order. The hashes depend on positions
alone, so each chunk's cut-off is found without touching the data (by counting
hashes in narrowing ranges, never by ranking them), and picking rows is a row-local
filter: a sample of half the table is as balanced as the scan.
"""

from __future__ import annotations

import random
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.session import scratch_path

POS = "_pos"
CHUNK = "_chunk"

# Files per range of the running sum over the file list (rows one window
# task sorts); the number of ranges follows from the file count.
FILES_PER_RANGE = 100_000


def file_offsets(df: DataFrame, file_col: str = "_file", buckets: int | None = None) -> DataFrame:
    """(file, rows, offset): rows in the files ordered before each file.

    A two-level prefix sum, so no task ever holds the whole file list:

    1. one row per file (only the file-path metadata column is read), stored:
       the data is scanned once, and the file count sizes the ranges below;
    2. the files are range-partitioned by name into ``buckets`` contiguous
       ranges (default: one per ``FILES_PER_RANGE`` files) and each row is
       tagged with its range's index (``spark_partition_id`` right after the
       range exchange, so the index order is the name order);
    3. a window *partitioned by range* gives each file's offset inside its
       range; this is stored too, so both uses below see the same ranges even
       if a task is re-run;
    4. the range totals (one row per range) get their own running sum, over
       at most ``buckets`` rows, and are broadcast back: that size bound holds
       by construction.
    """
    return _offsets(*_file_rows(df, file_col), file_col, buckets)


def _stored(rows: DataFrame, name: str) -> DataFrame:
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _file_rows(df: DataFrame, file_col: str) -> tuple[DataFrame, int, int]:
    """(rows per file, stored; files; rows)."""
    counts = _stored(df.groupBy(file_col).agg(F.count(F.lit(1)).alias("_rows")), "file-rows")
    files, total = counts.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    return counts, files, int(total or 0)


def _offsets(counts: DataFrame, files: int, total: int, file_col: str, buckets: int | None = None) -> DataFrame:
    n = buckets or max(1, -(-files // FILES_PER_RANGE))
    ranged = counts.repartitionByRange(n, file_col).withColumn("_bucket", F.spark_partition_id())
    inside = Window.partitionBy("_bucket").orderBy(file_col).rowsBetween(Window.unboundedPreceding, -1)
    local = _stored(ranged.withColumn("_local", F.coalesce(F.sum("_rows").over(inside), F.lit(0))), "file-offsets")
    totals = local.groupBy("_bucket").agg(F.sum("_rows").alias("_bucket_rows"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_bucket", F.coalesce(F.sum("_bucket_rows").over(before), F.lit(0)).alias("_base"))
    return local.join(F.broadcast(bases), "_bucket").select(
        file_col, "_rows", (F.col("_base") + F.col("_local")).cast("bigint").alias("_offset")
    )


class Positioned(NamedTuple):
    df: DataFrame
    total: int


def with_position(df: DataFrame, file_col: str = "_file", row_col: str = "_row") -> Positioned:
    """Add ``_pos`` (0-based row position in file order); drops the helpers.

    The (file, offset) table is joined by file path without a hint: Spark
    broadcasts it while it is below its threshold, else both sides shuffle by
    file and adaptive execution splits a large file's rows.
    """
    counts, files, total = _file_rows(df, file_col)
    offsets = _offsets(counts, files, total, file_col)
    joined = df.join(offsets.select(file_col, "_offset"), file_col)
    return Positioned(joined.withColumn(POS, F.col("_offset") + F.col(row_col)).drop("_offset", file_col, row_col), total)


def head_sample(positioned: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in file order (L3) of a positioned table: a map-only filter."""
    return positioned.filter(F.col(POS) < n)


def read_head(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` rows of a Parquet table in file order, with ``_pos`` (L3).

    Rows per file come from the files' footers (no column is read); only the
    files that hold a position below ``n`` (at most ``n`` of them) are opened
    for data.
    """
    listing = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("_file"))
    first = file_offsets(listing).filter(F.col("_offset") < n).orderBy("_offset").collect()
    if not first:
        return spark.read.parquet(path).withColumn(POS, F.lit(0).cast("bigint")).limit(0)
    offsets = spark.createDataFrame([(r["_file"], r["_offset"]) for r in first], "_file string, _offset bigint")
    rows = spark.read.parquet(*[r["_file"] for r in first]).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return head_sample(rows.join(F.broadcast(offsets), "_file").withColumn(POS, F.col("_offset") + F.col("_row")).drop("_file", "_offset", "_row"), n)


def chunk_bounds(total: int, chunks: int) -> list[tuple[int, int]]:
    """[start, end) of each chunk, in whole numbers: they cover 0..total-1."""
    return [(i * total // chunks, (i + 1) * total // chunks) for i in range(chunks)]


def chunk_of(pos: Column, total: int, chunks: int) -> Column:
    """Index of the chunk that holds a position."""
    # The largest i with i * total // chunks <= pos, in whole numbers (pos * chunks fits a long).
    return F.call_function("div", (pos + 1) * F.lit(chunks).cast("bigint") - 1, F.lit(max(total, 1)).cast("bigint")).cast("int")


def draw_key(pos: Column, seed: int) -> Column:
    """The keyed hash of a position, as hex text; rows are drawn in its order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), pos.cast("string")))


def topup_chunks(sizes: list[int], per: int, shortfall: int, seed: int) -> list[int]:
    """Extra rows of each chunk: one at a time, in a seeded order, where rows are left."""
    order = list(range(len(sizes)))
    random.Random(seed).shuffle(order)
    extra = [0] * len(sizes)
    while shortfall and any(sizes[i] > per + extra[i] for i in order):
        for i in order:
            if shortfall and sizes[i] > per + extra[i]:
                extra[i] += 1
                shortfall -= 1
    return extra


KEY_DIGITS = 15  # hex digits of a key that make its number
KEY_END = 16**KEY_DIGITS
BINS = 1024  # counts per chunk that come back from a pass
FEW = 256  # keys per chunk that come back in the end


def key_number(key: Column) -> Column:
    """The first digits of a key, as a whole number in the same order."""
    return F.conv(F.substring(key, 1, KEY_DIGITS), 16, 10).cast("bigint")


class _Range:
    """Where one wanted key is looked for: numbers from ``low`` to before ``high``, with ``below`` keys under them."""

    def __init__(self, rank: int, size: int):
        self.rank, self.below, self.inside = rank, 0, None
        slack = 8 * rank**0.5 + 20
        self.low = max(0, int((rank - slack) / size * KEY_END))
        self.high = min(KEY_END, int((rank + slack) / size * KEY_END) + 1)

    @property
    def width(self) -> int:
        """Numbers of a bin."""
        return -(-(self.high - self.low) // BINS)

    def narrow(self, under: int, bins: dict[int, int]) -> None:
        """Take in a pass: ``under`` keys below ``low``, and counts by bin."""
        if under >= self.rank:  # not where it was expected: below
            self.low, self.high = 0, self.low
        elif under + sum(bins.values()) < self.rank:  # or above
            self.low, self.high = self.high, KEY_END
        else:
            run = under
            for b in sorted(bins):
                if run + bins[b] >= self.rank:
                    break
                run += bins[b]
            width = self.width
            self.below, self.low = run, self.low + b * width
            self.high = min(self.high, self.low + width)
            if bins[b] <= FEW or self.high - self.low == 1:
                self.inside = bins[b]


def cut_offs(spark: SparkSession, total: int, wanted: dict[int, list[int]], chunks: int, seed: int) -> dict[tuple[int, int], str]:
    """Key of the ``rank``-th drawn position (from 1) of each chunk, for the wanted ranks.

    Nothing is ranked: keys are counted by ranges of their numbers, each pass inside the
    range that the pass before it found to hold the wanted rank, until few keys are
    left in it. Keys are hashes, so the first range is where the rank is
    expected, give or take eight deviations; the counts tell if it is not there. A pass is one map
    over the positions with a partial count per task, and returns at most
    ``BINS`` counts for each rank; two or three passes find the cut-off of any sample.
    """
    bounds = chunk_bounds(total, chunks)
    ranges = {(i, r): _Range(r, bounds[i][1] - bounds[i][0]) for i, ranks in wanted.items() for r in ranks}
    slots: list[dict[int, _Range]] = []  # a chunk's ranks go to different slots
    for (i, _), x in sorted(ranges.items()):
        k = next((k for k, s in enumerate(slots) if i not in s), len(slots))
        slots[k:] = slots[k:] or [{}]
        slots[k][i] = x

    def keyed() -> DataFrame:
        pos = spark.range(total).select("id", chunk_of(F.col("id"), total, chunks).alias("chunk"), draw_key(F.col("id"), seed).alias("key"))
        return pos.withColumn("x", key_number(F.col("key")))

    def of(slot: dict[int, _Range], value) -> Column:
        return F.element_at(F.array(*[F.lit(value(slot[i]) if i in slot else 0).cast("bigint") for i in range(chunks)]), F.col("chunk") + 1)

    def open_(slot: dict[int, _Range]) -> dict[int, _Range]:
        return {i: x for i, x in slot.items() if x.inside is None}

    while any(map(open_, slots)):
        places = []
        for k, slot in enumerate(map(open_, slots)):
            if slot:
                low = of(slot, lambda x: x.low)
                bin_ = F.when(F.col("x") < low, F.lit(-1).cast("bigint")).otherwise(F.call_function("div", F.col("x") - low, of(slot, lambda x: x.width) + (~F.col("chunk").isin([*slot])).cast("int")))
                asked = F.col("chunk").isin([*slot]) & (F.col("x") < of(slot, lambda x: x.high))
                places.append(F.struct(F.lit(k).alias("slot"), F.when(asked, bin_).alias("bin")))
        counts = keyed().select("chunk", F.inline(F.array(*places))).filter("bin IS NOT NULL").groupBy("chunk", "slot", "bin").agg(F.count(F.lit(1)).alias("n"))
        found: dict[tuple[int, int], dict[int, int]] = {}
        for r in counts.collect():
            found.setdefault((r.chunk, r.slot), {})[r.bin] = r.n
        for k, slot in enumerate(map(open_, slots)):
            for i, x in slot.items():
                bins = found.get((i, k), {})
                x.narrow(bins.pop(-1, 0), bins)

    def within(slot: dict[int, _Range]) -> Column:
        return F.col("chunk").isin([*slot]) & (F.col("x") >= of(slot, lambda x: x.low)) & (F.col("x") < of(slot, lambda x: x.high))

    out: dict[tuple[int, int], str] = {}
    plain = [{i: x for i, x in slot.items() if x.inside <= FEW} for slot in slots]
    places = [F.struct(F.lit(k).alias("slot"), within(slot).alias("inside")) for k, slot in enumerate(plain) if slot]
    keys: dict[tuple[int, int], list[str]] = {(i, k): [] for k, slot in enumerate(plain) for i in slot}
    if places:  # one more pass brings the few keys of all ranges
        for r in keyed().select("chunk", "key", F.inline(F.array(*places))).filter("inside").collect():
            keys[r.chunk, r.slot].append(r.key)
    for (i, k), found in keys.items():
        x = plain[k][i]
        out[i, x.rank] = sorted(found)[x.rank - x.below - 1]
    for slot in slots:
        crowded = {i: x for i, x in slot.items() if x.inside > FEW}  # keys that agree in all digits of their numbers
        if crowded:
            place = F.row_number().over(Window.partitionBy("chunk").orderBy("key", "id"))
            ranked = keyed().filter(within(crowded)).withColumn("place", place)
            out |= {(r.chunk, crowded[r.chunk].rank): r.key for r in ranked.filter(F.col("place") == of(crowded, lambda x: x.rank - x.below)).collect()}
    return out


def spread_sample(positioned: DataFrame, total: int, sample_size: int = 100_000, chunks: int = 10, seed: int = 42) -> DataFrame:
    """Spread sample over ``positioned`` (with ``_pos``) of ``total`` rows.

    One row-local filter over the data. Returns the picked rows with
    ``_chunk`` = chunk index, or ``chunks`` for the top-up rows.
    """
    size = min(sample_size, total)
    per = size // chunks
    sizes = [hi - lo for lo, hi in chunk_bounds(total, chunks)]
    extra = topup_chunks(sizes, per, size - per * chunks, seed)
    wanted = {i: [r for r in {per, per + extra[i]} if r] for i in range(chunks)}
    cut = cut_offs(positioned.sparkSession, total, wanted, chunks, seed) if size else {}

    def at(ranks: list[int]) -> Column:
        # Every key is above the empty text.
        return F.element_at(F.array(*[F.lit(cut.get((i, r), "")) for i, r in enumerate(ranks)]), F.col(CHUNK) + 1)

    keyed = positioned.withColumn(CHUNK, chunk_of(F.col(POS), total, chunks)).withColumn("_key", draw_key(F.col(POS), seed))
    last = at([per + e for e in extra])
    picked = keyed.filter(F.col("_key") <= last)
    return picked.withColumn(CHUNK, F.when(F.col("_key") <= at([per] * chunks), F.col(CHUNK)).otherwise(F.lit(chunks))).drop("_key")
