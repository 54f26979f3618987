"""Hard negatives by segment summaries.

For each anchor (a stated query set) the rows of its label with the highest scores
are its positives; a positive's hard negatives are the highest rows of other labels whose
score lies in a window below the positive's. A score is the inner product of two
integer vectors, and is exact.

A vector is stored with summaries at ``LEVELS`` of 1, 4 and 16 segments: per segment
its sum (mean times length) and its deviation, the length of what is left when the
mean is taken off. Over a segment of L components the inner product is

    sum * sum / L  +-  deviation * deviation   (Cauchy-Schwarz on what is left),

so the sums of these over the segments bound a score from above and below. A
pair of anchor and row goes from level to level, with the bounds closer each time, and is
dropped as soon as the upper bound is under what the anchor still needs, or the lower bound
over it; only pairs that pass all levels are scored. Bounds are widened by more than
their rounding, so no pair is lost.

Rows and anchors meet as blocks: ``anchor_bytes`` of anchors at a time (about 4 MB, by
the vectors' real length) are broadcast, and every task goes through its rows in chunks,
keeping the few best of each anchor. Only these are shuffled: at most
``positives``, then ``positives * negatives`` rows for each anchor and task, and tasks are at most ``slabs``.
Each pass over a block is written to the checkpoint folder, so a lost
executor costs tasks of one pass. The first pass finds the positives, the second the
negatives in the windows they set. A label that holds most rows only masks pairs; no
row is grouped by label.

Defined results: rows with a null label, a null vector or a null or non-finite
component (scaled ones too) take no part; vectors of unlike length are filled up with zeros; equal
scores stand by smaller id, null ids last; rows of one id are rows of their own,
and an anchor id that two rows have is two anchors; a row is never its own
positive; an anchor without positives, and a positive without negatives, return no rows; an empty
table returns none. Scores beyond a long count as the nearest long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import gapless, quoted, require

LEVELS = (1, 4, 16)
ANCHOR_BYTES = 4 << 20
PAIRS = 1 << 21  # pairs of a chunk: 16 MB a matrix
SPARSE = 16  # pairs are bounded one by one, not as a matrix, where fewer than one in so many is left
EXACT = 2**53  # doubles hold integers exactly up to here
WORST = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max

VECTORS = "row long, id long, label long, v array<double>, s array<double>, e array<double>"
HITS = "anchor long, slot int, row long, id long, score long"


class Block:
    """Vectors with their summaries, as matrices; short vectors are filled up with zeros."""

    def __init__(self, row, id, label, v, s, e):
        self.row, self.id, self.label, self.v, self.s, self.e = row, id, label, v, s, e
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((v * v).sum(1))

    @classmethod
    def of(cls, batch: pa.RecordBatch, width: int, cells: int) -> Block:
        ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        return cls(
            batch.column("row").to_numpy(zero_copy_only=False), ids, batch.column("label").to_numpy(zero_copy_only=False), _matrix(batch.column("v"), width), _matrix(batch.column("s"), cells), _matrix(batch.column("e"), cells)
        )

    def take(self, which) -> Block:
        return Block(self.row[which], self.id[which], self.label[which], self.v[which], self.s[which], self.e[which])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if width and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def cuts(width: int) -> list[np.ndarray]:
    """Starts of the segments of each level; no segment is empty, and no vector has no level but the empty one."""
    return [np.arange(n) * width // n for n in (min(n, width) for n in LEVELS) if n]


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector and segment, the levels side by side: sum / sqrt(length), and deviation."""
    width = v.shape[1]
    sums, devs = [], []
    with np.errstate(over="ignore", invalid="ignore"):
        for starts in cuts(width):
            n = np.diff(np.append(starts, width))
            s = np.add.reduceat(v, starts, axis=1)
            left = v - np.repeat(s / n, n, axis=1)
            sums.append(s / np.sqrt(n))
            devs.append(np.sqrt(np.add.reduceat(left * left, starts, axis=1)))
    empty = np.zeros((len(v), 0))
    return (np.concatenate(sums, 1), np.concatenate(devs, 1)) if sums else (empty, empty)


def scores(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Exact inner products as longs: all of a with all of b, or of pairs of rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        most = np.sqrt(max((a * a).sum(1).max(initial=0), 0)) * np.sqrt(max((b * b).sum(1).max(initial=0), 0))
    if most < EXACT:
        found = a @ b.T if pairs is None else np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])
        return found.astype(np.int64)
    if pairs is None:
        pairs = tuple(x.ravel() for x in np.indices((len(a), len(b))))
        return scores(a, b, pairs).reshape(len(a), len(b))
    wide = [min(max(sum(int(x) * int(y) for x, y in zip(a[i], b[j])), WORST + 1), NO_ID) for i, j in zip(*pairs)]
    return np.array(wide, np.int64)


def _limits(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles; the ends of the range of longs stand for scores beyond it too."""
    return np.where(low <= WORST + 1, -np.inf, low.astype(float)), np.where(high == NO_ID, np.inf, high.astype(float))


def found_pairs(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the ``allowed`` pairs with a score in the anchor's [low, high].

    From the coarsest summaries to the finest, pairs whose bounds miss the
    range are dropped; what is left is scored.
    """
    slack = 1e-9 * anchors.norm[:, None] * rows.norm[None, :] + 1e-3
    least, most = _limits(low, high)
    alive, pairs, at = allowed, None, 0
    with np.errstate(over="ignore", invalid="ignore"):
        for starts in cuts(rows.v.shape[1]):
            part = slice(at, at + len(starts))
            at += len(starts)
            if pairs is None and np.count_nonzero(alive) * SPARSE < alive.size:
                pairs = np.nonzero(alive)
            # Written so that a bound that is no number drops nothing.
            if pairs is None:
                middle, spread = anchors.s[:, part] @ rows.s[:, part].T, anchors.e[:, part] @ rows.e[:, part].T
                spread += slack
                alive = alive & ~(middle + spread < least[:, None]) & ~(middle - spread > most[:, None])
            else:
                i, j = pairs
                middle = np.einsum("ij,ij->i", anchors.s[i, part], rows.s[j, part])
                spread = np.einsum("ij,ij->i", anchors.e[i, part], rows.e[j, part]) + slack[i, j]
                keep = ~(middle + spread < least[i]) & ~(middle - spread > most[i])
                pairs = i[keep], j[keep]
    if pairs is None and np.count_nonzero(alive) * SPARSE < alive.size:
        pairs = np.nonzero(alive)
    if pairs is None:
        score = scores(anchors.v, rows.v)
        i, j = np.nonzero(alive & (score >= low[:, None]) & (score <= high[:, None]))
        return i, j, score[i, j]
    score = scores(anchors.v, rows.v, pairs)
    keep = (score >= low[pairs[0]]) & (score <= high[pairs[0]])
    return pairs[0][keep], pairs[1][keep], score[keep]


class Best:
    """The best ``k`` (score, id, row) of each slot so far: scores falling, ids rising, rows rising."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), WORST)
        self.id = np.full((n, k), NO_ID)
        self.row = np.full((n, k), NO_ID)

    def floor(self) -> np.ndarray:
        """The score that a new one must reach, by slot."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        last = self.score[slot, -1]
        new = (score > last) | ((score == last) & ((id < self.id[slot, -1]) | ((id == self.id[slot, -1]) & (row < self.row[slot, -1]))))
        slot, score, id, row = slot[new], score[new], id[new], row[new]
        if not len(slot):
            return
        hit = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(hit, self.k)])
        score, id, row = (np.concatenate([x, old[hit].ravel()]) for x, old in ((score, self.score), (id, self.id), (row, self.row)))
        # -score overflows for the least long alone; it is no score, so it goes last as ~score.
        order = np.lexsort((row, id, ~score, slot))
        slot, score, id, row = slot[order], score[order], id[order], row[order]
        start = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        place = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
        keep = place < self.k
        slot, place = slot[keep], place[keep]
        self.score[slot, place], self.id[slot, place], self.row[slot, place] = score[keep], id[keep], row[keep]

    def rows(self) -> tuple[np.ndarray, ...]:
        """(slot, row, id, score) of what is held."""
        slot, place = np.nonzero(self.score > WORST)
        return slot, self.row[slot, place], self.id[slot, place], self.score[slot, place]


def chunks(batches: Iterator[pa.RecordBatch], width: int, cells: int, n_anchors: int) -> Iterator[Block]:
    """The rows in blocks of at most ``PAIRS`` pairs; the first of a task are small, to have floors early."""
    size, most = 64, max(1, PAIRS // max(1, n_anchors))
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = Block.of(batch, width, cells)
        order = np.lexsort((whole.row, whole.id))  # ties then come best first
        at = 0
        while at < len(order):
            n = min(size, most)
            yield whole.take(order[at : at + n])
            at, size = at + n, min(2 * size, PAIRS)


def find_positives(anchors: Block, rows: Iterator[Block], k: int) -> Best:
    best = Best(len(anchors.row), k)
    open_end = np.full(len(anchors.row), NO_ID)
    for block in rows:
        allowed = (anchors.label[:, None] == block.label[None, :]) & (anchors.row[:, None] != block.row[None, :])
        i, j, score = found_pairs(anchors, block, best.floor(), open_end, allowed)
        best.add(i, score, block.id[j], block.row[j])
    return best


def find_negatives(anchors: Block, low: np.ndarray, high: np.ndarray, rows: Iterator[Block], k: int) -> Best:
    """``low``, ``high``: per anchor and positive the range of scores (low over high: none). Slots: anchor by positive."""
    n, wide = low.shape
    best = Best(n * wide, k)
    some = low <= high
    for block in rows:
        need = np.maximum(low, best.floor().reshape(n, wide))
        i, j, score = found_pairs(anchors, block, np.where(some, need, NO_ID).min(1), np.where(some, high, WORST).max(1), anchors.label[:, None] != block.label[None, :])
        for p in range(wide):
            inside = some[i, p] & (score >= need[i, p]) & (score <= high[i, p])
            to = j[inside]
            best.add(i[inside] * wide + p, score[inside], block.id[to], block.row[to])
    return best


def summarise(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """The rows that take part, scaled and floored, with their summaries, as a stored table."""
    spark = vectors.sparkSession
    x = quoted(vector)

    def scaled(c: Column) -> Column:
        return c.cast("double") * F.lit(float(scale))

    def floored(c: Column) -> Column:  # doubles from 2 ** 52 on are whole numbers, and floor gives a long
        return F.when(F.abs(scaled(c)) < 2.0**52, F.floor(scaled(c)).cast("double")).otherwise(scaled(c))

    bad = F.exists(x, lambda c: c.isNull() | F.isnan(scaled(c)) | (F.abs(scaled(c)) == float("inf")))
    rows = vectors.select(quoted(vec_id).cast("long").alias("id"), quoted(label).cast("long").alias("label"), F.when(~bad, F.transform(x, floored)).alias("v")).withColumn("row", F.monotonically_increasing_id())
    path = scratch_path(spark, "vectors")
    rows.filter("label IS NOT NULL AND v IS NOT NULL").select("row", "id", "label", "v").mapInArrow(_summarised(None), VECTORS).write.parquet(path)
    return spark.read.schema(VECTORS).parquet(path)


def _summarised(width: int | None):
    """Adds the summaries of ``v``, filled up to ``width`` (None: as long as it is)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            for n in np.unique(lengths).tolist():
                same = batch.filter(pa.array(lengths == n))
                v = _matrix(same.column("v"), n if width is None else width)
                s, e = summaries(v)
                yield pa.RecordBatch.from_arrays([*(same.column(c) for c in ("row", "id", "label")), *map(_lists, (v, s, e))], names=["row", "id", "label", "v", "s", "e"])

    return run


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def mine(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: float = 256,
    anchor_bytes: int = ANCHOR_BYTES,
    slabs: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: condition on ``id``, the query set. A negative's score is between
    ``window`` per cent of the positive's. ``slabs``: tasks of a pass, four a core by default.
    """
    require(vectors, vec_id, vector, label)
    spark = vectors.sparkSession
    every = summarise(vectors, vec_id, vector, label, scale)
    slabs = slabs or 4 * spark.sparkContext.defaultParallelism
    sizes = every.agg(F.max(F.size("v")).alias("width"), F.min(F.size("v")).alias("least")).first()
    width = sizes.width or 0
    if sizes.least != sizes.width:  # segments are those of the longest vector
        path = scratch_path(spark, "filled-vectors")
        every.select("row", "id", "label", "v").mapInArrow(_summarised(width), VECTORS).write.parquet(path)
        every = spark.read.schema(VECTORS).parquet(path)
    cells = sum(map(len, cuts(width)))
    per_block = max(1, anchor_bytes // (8 * max(1, width + 2 * cells)))
    queries = gapless(every.filter(anchor), "number", "anchors").withColumn("block", F.floor(F.col("number") / per_block))
    n_blocks = (queries.agg(F.max("block")).first()[0] or 0) + 1
    lo_pct, hi_pct = window

    def windows_of(found: list[list[dict] | None]) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.ones((len(found), positives), np.int64), np.zeros((len(found), positives), np.int64)
        for i, of in enumerate(found):
            for f in of or []:
                low[i, f["slot"]], high[i, f["slot"]] = -((-lo_pct * f["positive_score"]) // 100), (hi_pct * f["positive_score"]) // 100
        return low, high

    def passes(name: str, asked: DataFrame, work: Callable) -> DataFrame:
        """``work(anchors, low, high, blocks of rows)`` over all rows, for one block of anchors after the other."""
        folder = scratch_path(spark, name)
        for b in range(n_blocks):
            part = asked.filter(F.col("block") == b).toArrow().combine_chunks()  # at most ``anchor_bytes``
            batch = (part.to_batches() or [pa.RecordBatch.from_pylist([], part.schema)])[0]
            anchors = Block.of(batch, width, cells)
            found = batch.column("found").to_pylist() if "found" in batch.schema.names else []
            sent = spark.sparkContext.broadcast((anchors.row, anchors.id, anchors.label, anchors.v, anchors.s, anchors.e, *windows_of(found)))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                *own, low, high = sent.value
                if not len(own[0]):
                    return
                best, per = work(Block(*own), low, high, chunks(batches, width, cells, len(own[0])))
                slot, row, id_, score = best.rows()
                yield pa.RecordBatch.from_arrays([pa.array(own[0][slot // per]), pa.array((slot % per).astype(np.int32)), pa.array(row), pa.array(id_, mask=id_ == NO_ID), pa.array(score)], names=["anchor", "slot", "row", "id", "score"])

            every.coalesce(slabs).mapInArrow(run, HITS).write.parquet(f"{folder}/block={b}")
            sent.destroy()
        return spark.read.schema(HITS).parquet(*(f"{folder}/block={b}" for b in range(n_blocks)))

    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row"))
    hits = passes("positives", queries, lambda a, low, high, rows: (find_positives(a, rows, positives), 1))
    best = hits.withColumn("place", place).filter(F.col("place") <= positives)
    path = scratch_path(spark, "best-positives")
    best.select("anchor", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(path)
    best = spark.read.schema("anchor long, slot int, positive_id long, positive_score long").parquet(path)

    windows = best.groupBy("anchor").agg(F.collect_list(F.struct("slot", "positive_score")).alias("found"))  # at most ``positives`` each
    asked = queries.join(windows, queries["row"] == windows["anchor"], "left").drop("anchor")
    path = scratch_path(spark, "windows")
    asked.write.parquet(path)
    hits = passes("negatives", spark.read.schema(asked.schema).parquet(path), lambda a, low, high, rows: (find_negatives(a, low, high, rows, negatives), positives))
    ranked = hits.withColumn("rank", place).filter(F.col("rank") <= negatives)
    ids = queries.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        ranked.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(best, ["anchor", "slot"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
