"""SimHash near-dedup by anchor points.

*Fingerprint*: A-Z lower-cased; words are runs of characters other than
``[\\x20\\x09-\\x0D]``; shingles of ``shingle`` words joined by a space (all the
words if there are fewer); each shingle's XXH64 (seed 42); a bit of the
fingerprint is 1 if it is set in over half of the hashes. A text without words
has fingerprint 0.

*Anchors*: the 64 bits are cut into ``parts``; two fingerprints within
``bits`` differing bits differ in at most ``t = bits // parts`` bits of some
part. Anchors of a part are the words of a covering code: a direct sum of
perfect (7,4) Hamming codes, each with covering radius 1, and single bits. A
fingerprint's *home* is the one anchor its part decodes to (within the covering
radius R). It is also replicated to the anchors within R + t that are the home
of some word at most t bits away. So of two fingerprints within t bits in a
part, each is present at the other's home, and comparing homes with all
presences per anchor finds every link.

*Comparison*: equal fingerprints are one row from the start. An anchor with
many rows is dealt over tiles of bounded size. A tile returns a spanning
forest of its links (at most one edge per row), never all pairs; forests are
joined by ``components``.

Defined results: null text counts as empty; a component is named by its
smallest doc_id, null if all its ids are null; rows that share a doc_id are
compared each by their own text, so components may share a name; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import free_name, grouped, quoted, require, sliced, utf8_of
from .components import components

SEED = 42
TILE = 4096
FINGERPRINT = "doc_id long, text_hash long, fp long"


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The fingerprint of a UTF-8 text."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    runs = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else iter([words])
    digest, join, seed = xxhash.xxh64_intdigest, b" ".join, SEED
    votes, total = np.zeros(64, np.int64), 0
    while True:
        hashes = np.fromiter((digest(join(w), seed) for w in islice(runs, 1 << 16)), np.uint64)
        if not len(hashes):
            break
        votes += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * votes > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp): fp as a signed long of the same 64 bits. Map-only."""
    require(docs, doc_id, text)
    narrow = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text).cast("string")).alias("text_hash"), quoted(text).cast("string").alias("t"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "t"):
            fp = np.array([fingerprint(t, shingle) for t in utf8_of(batch, "t")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fp.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return narrow.mapInArrow(hashed, FINGERPRINT)


def _hamming_decoder() -> np.ndarray:
    """For each 7-bit word, the nearest word of the perfect (7,4) Hamming code.

    Bit i stands for column i + 1 of the parity check; the XOR of the set
    columns names the bit to flip.
    """
    words = np.arange(128)
    syndrome = np.zeros(128, np.int64)
    for i in range(7):
        syndrome ^= np.where(words >> i & 1, i + 1, 0)
    return words ^ np.where(syndrome, 1 << np.maximum(syndrome - 1, 0), 0)


class Anchors:
    """The anchors of every part of a fingerprint."""

    def __init__(self, bits: int, parts: int):
        if not 0 < parts <= 9:
            raise ValueError("1 to 9 parts")
        cuts = [64 * i // parts for i in range(parts + 1)]
        self.ranges, self.t = list(zip(cuts[:-1], cuts[1:])), bits // parts
        self.decoder = _hamming_decoder().astype(np.uint64)

    def home(self, word: np.ndarray, width: int) -> np.ndarray:
        """The anchor that each ``width``-bit word decodes to."""
        out = np.zeros_like(word)
        for lo in range(0, width - 6, 7):
            out |= self.decoder[(word >> np.uint64(lo) & np.uint64(127)).astype(np.int64)] << np.uint64(lo)
        rest = width // 7 * 7  # single bits are their own code
        return out | (word >> np.uint64(rest) << np.uint64(rest))

    def rows(self, fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, row, anchor, is home) of all presences of the fingerprints."""
        for part, (lo, hi) in enumerate(self.ranges):
            width = hi - lo
            word = fp >> np.uint64(lo) & np.uint64((1 << width) - 1)
            home = self.home(word, width)
            masks = np.array([sum(1 << i for i in c) for k in range(self.t + 1) for c in combinations(range(width), k)], np.uint64)
            near = np.sort(self.home(word[:, None] ^ masks[None, :], width), axis=1)
            first = np.ones(near.shape, bool)
            first[:, 1:] = near[:, 1:] != near[:, :-1]
            row, col = np.nonzero(first)
            anchor = near[row, col]
            yield part, row, anchor, anchor == home[row]


def presences(nodes: DataFrame, bits: int, parts: int) -> DataFrame:
    """(part, anchor, home, fp, node) for each anchor a fingerprint is present at."""
    code = Anchors(bits, parts)
    step = 2048 if code.t <= 1 else 256

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp, all_node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "node"))
            for s in range(0, len(all_fp), step):
                fp, node = all_fp[s : s + step], all_node[s : s + step]
                for part, row, anchor, home in code.rows(fp.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), part, np.int32)), pa.array(anchor.view(np.int64)), pa.array(home), pa.array(fp[row]), pa.array(node[row])], names=["part", "anchor", "home", "fp", "node"]
                    )

    return nodes.select("fp", "node").mapInArrow(placed, "part int, anchor long, home boolean, fp long, node long")


def tile_forest(home: np.ndarray, fp: np.ndarray, node: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of the home rows to all rows of a tile."""
    parent = np.arange(len(fp))

    def roots(at: np.ndarray) -> np.ndarray:
        up = parent[at]
        while True:
            more = parent[up]
            if (more == up).all():
                parent[at] = up
                return up
            up = more

    for i in np.flatnonzero(home):
        linked = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= bits)
        if len(linked) > 1:
            parent[np.unique(roots(linked))] = linked_root = int(roots(linked).min())
            parent[linked] = linked_root
    top = roots(np.arange(len(fp)))
    low = np.full(len(fp), np.iinfo(np.int64).max)
    np.minimum.at(low, top, node)
    name = low[top]
    return [(int(a), int(b)) for a, b in zip(node, name) if a != b]


def links(nodes: DataFrame, bits: int = 4, parts: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b): edges between nodes whose fingerprints differ in at most ``bits`` bits.

    Not all of them, but enough to connect whatever they connect. ``nodes`` is
    (fp, node) with different fingerprints, read from a stored table.
    """
    rows = presences(nodes, bits, parts)
    crowded = rows.groupBy("part", "anchor").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("all")).filter((F.col("homes") > tile) | ((F.col("homes") > 0) & (F.col("all") > 8 * tile)))
    cut = crowded.select("part", "anchor", F.ceil(F.col("homes") / tile).cast("int").alias("n"), F.ceil(F.col("all") / (8 * tile)).cast("int").alias("m"))
    dealt = rows.join(cut, ["part", "anchor"], "left").withColumns({"n": F.coalesce("n", F.lit(1)), "m": F.coalesce("m", F.lit(1))})
    # A home row goes to its tile row in every column; every row goes to its column in each tile row.
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    col = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("m")).cast("int")
    spread = dealt.select("part", "anchor", "fp", "node", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), col.alias("j"), "home", own.alias("own"))
    present = spread.select("part", "anchor", "i", "j", (F.col("home") & (F.col("own") == F.col("i"))).alias("home"), "fp", "node")
    extra = (
        dealt.filter((F.col("m") > 1) & F.col("home"))
        .select("part", "anchor", "fp", "node", own.alias("i"), col.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
        .filter("j != mine")
        .select("part", "anchor", "i", "j", F.lit(True).alias("home"), "fp", "node")
    )
    keys = ["part", "anchor", "i", "j"]
    tiles = present.unionByName(extra).repartition(*keys).sortWithinPartitions(*keys)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, g in grouped(batches, keys):
            if len(g["fp"]) > 1 and g["home"].any():
                out += tile_forest(g["home"], g["fp"].view(np.uint64), g["node"], bits)
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return tiles.mapInArrow(compared, "a long, b long").distinct()


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _grouped_prints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4, parts: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, component): ``component`` is the smallest fingerprint of each component."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, doc_id, text, shingle).write.parquet(path)
    prints = spark.read.schema(FINGERPRINT).parquet(path)
    node_path = scratch_path(spark, "nodes")
    prints.groupBy("fp").agg(F.min("doc_id").alias("id")).select("fp", F.col("fp").alias("node"), "id").write.parquet(node_path)
    nodes = spark.read.schema("fp long, node long, id long").parquet(node_path)
    label_path = scratch_path(spark, "labels")
    nodes.join(components(links(nodes, bits, parts)), "node").select("fp", F.col("label").alias("component"), "id").write.parquet(label_path)
    linked = spark.read.schema("fp long, component long, id long").parquet(label_path)
    names = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    # Fingerprints without links are components of their own.
    alone = nodes.join(linked, "fp", "left_anti").select("fp", F.col("fp").alias("component"), F.col("id").alias("component_id"))
    named = linked.join(names, "component").select("fp", "component", "component_id").unionByName(alone)
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4, parts: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every row of ``docs``.

    ``parts`` trades anchors against replicas: more documents ask for fewer
    parts (3: 12-bit anchors, about 27 presences each; 2: 20-bit anchors,
    some hundreds). The result is the same.
    """
    return _grouped_prints(docs, doc_id, text, shingle, bits, parts).drop("component")


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component of ``docs``; columns as they were.

    The one with the smallest doc_id stays (nulls last); of different texts
    under that id, the one with the smallest hash. Rows are told apart by
    doc_id and text, so rows alike in both stay or go together.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "near")
    _grouped_prints(docs, doc_id, text, **options).write.parquet(path)
    found = spark.read.schema(FINGERPRINT + ", component_id long, component long").parquet(path)
    key = [free_name(docs, n) for n in ("_gone_id", "_gone_text")]
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min("component_id").alias("first_id"), F.min("text_hash").alias("first_text"))
    rows = found.select(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1])).distinct()
    gone_path = scratch_path(spark, "gone")
    rows.join(first, F.col(key[0]).eqNullSafe(F.col("first_id")) & (F.col(key[1]) == F.col("first_text")), "left_anti").write.parquet(gone_path)
    gone = spark.read.schema(f"`{key[0]}` long, `{key[1]}` long").parquet(gone_path)
    same = quoted(doc_id).cast("long").eqNullSafe(F.col(key[0])) & F.xxhash64(quoted(text).cast("string")).eqNullSafe(F.col(key[1]))
    return docs.join(gone, same, "left_anti")
