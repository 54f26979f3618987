"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

Every row is a leaf, H of its columns; the leaves of a group (a language) ascend by
document id; runs of ``FAN`` nodes become their H until one is left, the group's
subroot; the subroots, ordered by group, become the root the same way. A row's
place among its group's leaves is found without sorting the leaves:

1. *Bitmaps.* Each task packs the ids it reads into containers, one per (group,
   id >> ``CHUNK_BITS``): a bitmap, or a list of offsets while that is smaller,
   and the offsets met more than once with their counts. Containers of equal keys
   are merged (bitmaps by OR, counts by sum).
2. *Popcount directory.* Rows per container, summed over three radix levels of the
   chunk number, give the rank of each container's first id. No step takes more than
   65,536 directory rows (the topmost: 2 ** (64 - CHUNK_BITS - 32)).
3. *Rank queries.* Rows meet their container; a row's rank is the container's
   rank, plus the popcounts of the 64-bit words before its bit, plus the popcount
   below it in its word, plus the repeats of smaller ids.
4. *Slot arrays.* Nodes keyed by (group, rank div ``FAN ** DEEP``) fill an array by
   slot and are reduced by ``DEEP`` levels in one task; what comes out is reduced in the
   same way until one node is left.

Proofs go down the same arrays: each block gets the siblings above it and hands
on those of its nodes, so a row's proof is hashed where its leaf's block is.

Ids that a group has more than once (and null ids, which come before all others)
may be any share of the rows. Their rows are ordered by leaf digest; the rank
among them comes from counts by the digest's first 16 bits, then within one such prefix, then
from counts of equal leaves dealt over ``SALTS`` salts, so no id, null or leaf is ranked in one task.
Equal rows hold neighbouring places in any order.

Defined results: H writes null as ``-``; null groups come first; one leaf alone is its
subroot, one subroot alone is the root; an empty table has no rows; a tampered
row is one whose id's CRC-32 is divisible by ``tamper_mod`` (never one without an id). Texts are
hashed whole by Spark itself and do not pass through Python; other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import gapless, quoted, require

# Fixed value: children of a node.
FAN = 8
DEEP = 4  # levels reduced by one task: blocks of 8 ** 4 nodes
CHUNK_BITS = 12  # ids of a container: 4,096
FLUSH_ROWS = 1 << 20  # ids a task holds before it writes containers
SALTS = 256
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

CONTAINERS = "g long, chunk long, rows long, bits binary, rep_at binary, rep_n binary"
BLOCKS = "g long, block long, n int, out binary, slots binary, ids binary, no_id binary, changed binary"


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- 1, 2: bitmaps and their directory -----------------------------------------


def pack(offsets: np.ndarray) -> bytes:
    """Sorted distinct offsets as a container: a list of 16-bit offsets, or a bitmap where that is smaller."""
    if 2 * len(offsets) < (1 << CHUNK_BITS) // 8:
        return b"L" + offsets.astype("<u2").tobytes()
    words = np.zeros(1 << CHUNK_BITS, np.uint8)
    words[offsets] = 1
    return b"B" + np.packbits(words, bitorder="little").tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The container as 64-bit words of the bitmap."""
    if data[:1] == b"B":
        return np.frombuffer(data, "<u8", offset=1)
    bits = np.zeros(1 << CHUNK_BITS, np.uint8)
    bits[np.frombuffer(data, "<u2", offset=1)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def offsets_of(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def _repeats(at: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(n, "<i8")


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of the ids of a task, at most ``FLUSH_ROWS`` ids at a time."""
    held, rows = [], 0

    def flush() -> pa.RecordBatch:
        g = np.concatenate([h[0] for h in held])
        ids = np.concatenate([h[1] for h in held])
        order = np.lexsort((ids, g))
        g, ids = g[order], ids[order]
        new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (ids[1:] != ids[:-1])]))
        times = np.diff(np.append(new, len(ids)))
        g, ids = g[new], ids[new]
        chunk, offset = ids >> CHUNK_BITS, ids & ((1 << CHUNK_BITS) - 1)
        cut = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1])]))
        ends = np.append(cut[1:], len(ids))
        out: list[list] = [[], [], [], [], [], []]
        for a, b in zip(cut.tolist(), ends.tolist()):
            again = a + np.flatnonzero(times[a:b] > 1)
            values = (int(g[a]), int(chunk[a]), int(times[a:b].sum()), pack(offset[a:b]), offset[again].astype("<u2").tobytes(), (times[again] - 1).astype("<i8").tobytes())
            for column, v in zip(out, values):
                column.append(v)
        return _batch(out, CONTAINERS)

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("g").to_numpy(zero_copy_only=False), batch.column("id").to_numpy(zero_copy_only=False)))
            rows += batch.num_rows
        if rows >= FLUSH_ROWS:
            yield flush()
            held, rows = [], 0
    if rows:
        yield flush()


def _batch(columns: list[list], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def merge(parts: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Containers of one key as one: words of the bitmap, repeated offsets (ascending), their extra rows."""
    words = np.zeros((1 << CHUNK_BITS) // 64, "<u8")
    extra = np.zeros(1 << CHUNK_BITS, np.int64)
    for bits, at, n in parts:
        new = unpack(bits)
        both = words & new
        if both.any():
            extra[offsets_of(both)] += 1
        words = words | new
        at, n = _repeats(at, n)
        extra[at] += n
    again = np.flatnonzero(extra)
    return words, again, extra[again]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged containers; the input has equal keys side by side. Holds one container."""
    key, sums, rows = None, None, 0
    out: list[list] = [[], [], [], [], [], []]

    def put() -> None:
        words, at, n = sums
        values = (*key, rows, pack(offsets_of(words)), at.astype("<u2").tobytes(), n.astype("<i8").tobytes())
        for column, v in zip(out, values):
            column.append(v)

    for batch in batches:
        for g, chunk, count, bits, at, n in zip(*(batch.column(c).to_pylist() for c in ("g", "chunk", "rows", "bits", "rep_at", "rep_n"))):
            if (g, chunk) == key:
                words, old_at, old_n = sums
                sums = merge([(b"B" + words.tobytes(), old_at.astype("<u2").tobytes(), old_n.astype("<i8").tobytes()), (bits, at, n)])
                rows += count
            else:
                if key is not None:
                    put()
                key, rows, sums = (g, chunk), count, merge([(bits, at, n)])
                if len(out[0]) >= 1024:
                    yield _batch(out, CONTAINERS)
                    out[:] = [[], [], [], [], [], []]
    if key is not None:
        put()
        yield _batch(out, CONTAINERS)


def containers(ids: DataFrame) -> DataFrame:
    """Merged containers of (g, id); ids are not null."""
    parts = ids.select("g", "id").mapInArrow(_containers, CONTAINERS)
    return parts.repartition("g", "chunk").sortWithinPartitions("g", "chunk").mapInArrow(_merged, CONTAINERS)


def directory(found: DataFrame, first: DataFrame) -> DataFrame:
    """(g, chunk, base): rank of each container's first row. ``first`` (g, n): rows before all ids (those without one)."""

    def before(key: str, *by: str) -> Column:
        rows = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(rows), F.lit(0))

    leaf = found.select("g", "chunk", "rows", F.shiftright("chunk", 16).alias("mid"), F.shiftright("chunk", 32).alias("top"))
    mid = leaf.groupBy("g", "top", "mid").agg(F.sum("rows").alias("rows"))
    top = mid.groupBy("g", "top").agg(F.sum("rows").alias("rows"))
    top = top.select("g", "top", before("top", "g").alias("top_base"))
    mid = mid.select("g", "top", "mid", before("mid", "g", "top").alias("mid_base"))
    leaf = leaf.select("g", "top", "mid", "chunk", before("chunk", "g", "mid").alias("leaf_base"))
    out = leaf.join(mid, ["g", "top", "mid"]).join(top, ["g", "top"]).join(first, "g", "left")
    return out.select("g", "chunk", (F.col("leaf_base") + F.col("mid_base") + F.col("top_base") + F.coalesce("n", F.lit(0))).cast("long").alias("base"))


# --- 3: rank queries ------------------------------------------------------------


class Ranks:
    """A container ready for rank queries: its words, popcounts before each, and repeats before each repeated offset."""

    def __init__(self, bits: bytes, at: bytes, n: bytes):
        self.words = unpack(bits)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.at, more = _repeats(at, n)
        self.more = np.concatenate([[0], np.cumsum(more)])

    def of(self, offsets: np.ndarray) -> np.ndarray:
        """Rows with smaller offsets."""
        word, bit = offsets >> 6, (offsets & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below).astype(np.int64) + self.more[np.searchsorted(self.at, offsets)]


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of rows that follow their container. Holds one container and one batch."""
    ranks, base = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = batch.column("bits").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
        where = np.flatnonzero(heads)
        rank = np.zeros(batch.num_rows, np.int64)
        for lo, hi in zip([0, *where.tolist()], [*where.tolist(), batch.num_rows]):
            if lo < batch.num_rows and heads[lo]:
                ranks = Ranks(*(batch.column(c)[lo].as_py() for c in ("bits", "rep_at", "rep_n")))
                base = batch.column("base")[lo].as_py()
                lo += 1
            if hi > lo:
                rank[lo:hi] = base + ranks.of(ids[lo:hi] & ((1 << CHUNK_BITS) - 1))
        kept = batch.filter(pa.array(~heads))
        yield pa.RecordBatch.from_arrays([kept.column("g"), pa.array(rank[~heads]), kept.column("id"), kept.column("leaf"), kept.column("changed")], names=["g", "idx", "id", "leaf", "changed"])


RANKED = "g long, idx long, id long, leaf binary, changed binary"


def ranked(rows: DataFrame, found: DataFrame, bases: DataFrame) -> DataFrame:
    """(g, idx, id, leaf, changed) of rows (g, id, leaf, changed), idx: rows of the group with smaller ids."""
    heads = found.join(bases, ["g", "chunk"]).select("g", "chunk", "base", "bits", "rep_at", "rep_n", *(F.lit(None).cast(k).alias(c) for c, k in (("id", "long"), ("leaf", "binary"), ("changed", "binary"))))
    asks = rows.select("g", F.shiftright("id", CHUNK_BITS).alias("chunk"), F.lit(None).cast("long").alias("base"), *(F.lit(None).cast("binary").alias(c) for c in ("bits", "rep_at", "rep_n")), "id", "leaf", "changed")
    # A container comes before its rows, which stay in any order.
    return heads.unionByName(asks).repartition("g", "chunk").sortWithinPartitions("g", "chunk", F.col("bits").isNull()).mapInArrow(_ranked, RANKED)


def _tie_places(rows: DataFrame) -> DataFrame:
    """``place``: number among the rows of one (g, id), by leaf digest; for ids with many rows, of any size."""
    key = [F.col("g"), F.coalesce("id", F.lit(0)).alias("i"), F.col("id").isNull().alias("no_id")]
    ties = ["g", "i", "no_id"]
    keyed = stored(rows.select(*key, "id", "leaf", "changed", F.substring("leaf", 1, 2).alias("prefix"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).alias("salt")), "ties")
    salted = stored(keyed.groupBy(*ties, "prefix", "leaf", "salt").agg(F.count(F.lit(1)).alias("n")), "tie-salts")

    def before(order: str, *by: str) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    leaves = salted.groupBy(*ties, "prefix", "leaf").agg(F.sum("n").alias("n"))
    prefixes = leaves.groupBy(*ties, "prefix").agg(F.sum("n").alias("n"))
    prefixes = prefixes.select(*ties, "prefix", before("prefix", *ties).alias("p0"))
    leaves = leaves.select(*ties, "prefix", "leaf", before("leaf", *ties, "prefix").alias("p1"))
    salted = salted.select(*ties, "prefix", "leaf", "salt", before("salt", *ties, "leaf").alias("p2"))
    base = salted.join(leaves, [*ties, "prefix", "leaf"]).join(prefixes, [*ties, "prefix"])
    own = F.row_number().over(Window.partitionBy(*ties, "leaf", "salt").orderBy(F.lit(0))) - 1
    numbered = keyed.select("*", own.alias("p3"))
    return numbered.join(base, [*ties, "prefix", "leaf", "salt"]).select("g", "id", "leaf", "changed", (F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3")).cast("long").alias("place"))


# --- 4: slot arrays -------------------------------------------------------------


def node(children: list[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


def levels(n: int) -> int:
    """Levels above ``n`` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def tree(leaves: list[bytes], height: int) -> list[list[bytes]]:
    """``leaves`` and the ``height`` levels above them."""
    out = [leaves]
    for _ in range(height):
        below = out[-1]
        out.append([node(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return out


def siblings(built: list[list[bytes]], slot: int) -> list[list[bytes]]:
    """Per level, from the leaf up: the others of the run of ``slot``'s ancestor."""
    out = []
    for level in built[:-1]:
        run = slot - slot % FAN
        out.append(level[run:slot] + level[slot + 1 : run + FAN])
        slot //= FAN
    return out


def folded(leaf: bytes, slot: int, beside: list[list[bytes]]) -> bytes:
    """The node that a leaf and its siblings lead to."""
    for others in beside:
        at = slot % FAN
        leaf, slot = node([*others[:at], leaf, *others[at:]]), slot // FAN
    return leaf


def _height(n: int, at: int) -> int:
    """Levels to reduce in pass ``at`` (from 0) over a group of ``n`` leaves."""
    return min(DEEP, max(0, levels(n) - DEEP * at))


def _blocks(at: int):
    """Reduces the nodes of one block, whatever their order, by slot."""

    def run(key, table):
        batch = table.combine_chunks().to_batches()[0]
        g, block = (k.as_py() for k in key)
        idx = batch.column("idx").to_numpy(zero_copy_only=False)
        slot = idx - idx.min()
        if len({*slot.tolist()}) != len(slot) or int(slot.max()) + 1 != len(slot):
            raise ValueError("the places of a block's nodes are not distinct and gapless")
        turn = np.argsort(slot)  # a permutation: slots are 0 to n - 1
        digests, ids, changed = (batch.column(c).take(pa.array(turn)).to_pylist() for c in ("leaf", "id", "changed"))
        top = tree(digests, _height(batch.column("total")[0].as_py(), at))[-1]
        out = _batch(
            [
                [g],
                [block],
                [len(digests)],
                [top[0]],
                [b"".join(digests)],
                [np.array([i or 0 for i in ids], "<i8").tobytes()],
                [bytes(i is None for i in ids)],
                [b"".join(b"\0" * 33 if c is None else b"\1" + c for c in changed)],
            ],
            BLOCKS,
        )
        return pa.Table.from_batches([out])

    return run


def reduce_levels(nodes: DataFrame, totalled: Callable[[DataFrame], DataFrame], most: int, name: str) -> list[DataFrame]:
    """Passes over nodes (g, idx, leaf, id, changed), down to one block per group.

    ``totalled`` adds to a table by g the leaves of the group as ``total``, ``most`` at most.
    Each pass is a stored table of blocks; ``out`` of the last are the groups' roots.
    """
    passes: list[DataFrame] = []
    for at in range(max(1, -(-levels(most) // DEEP))):
        keyed = totalled(nodes).select("g", F.shiftright("idx", DEEP * 3).alias("block"), "idx", "id", "leaf", "changed", "total")
        passes.append(stored(keyed.groupBy("g", "block").applyInArrow(_blocks(at), BLOCKS), f"{name}-{at}"))
        nodes = passes[-1].select("g", F.col("block").alias("idx"), F.lit(None).cast("long").alias("id"), F.col("out").alias("leaf"), F.lit(None).cast("binary").alias("changed"))
    return passes


PATHS = "g long, block long, ranks binary, others binary"


def _paths(at: int):
    """(g, idx) of each node of a block, with its siblings up to the top: per level its place and the others' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests = [row["slots"][i : i + 32] for i in range(0, 32 * row["n"], 32)]
                built = tree(digests, _height(row["total"], at))
                out: list[list] = [[], [], [], []]
                for slot in range(row["n"]):
                    places, others = pack_path(slot, siblings(built, slot))
                    for column, v in zip(out, (row["g"], (row["block"] << (DEEP * 3)) + slot, places + row["ranks"], others + row["others"])):
                        column.append(v)
                yield _batch(out, PATHS)

    return run


def pack_path(slot: int, beside: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Two bytes a level (own place in the run, number of others), and the others' digests."""
    places = bytearray()
    for others in beside:
        places += bytes([slot % FAN, len(others)])
        slot //= FAN
    return bytes(places), b"".join(d for others in beside for d in others)


def climb(leaf: bytes, places: bytes, others: bytes) -> bytes:
    """The root that a node and its packed path lead to."""
    at = 0
    for i in range(0, len(places), 2):
        n = places[i + 1]
        run = [others[j : j + 32] for j in range(at, at + 32 * n, 32)]
        leaf = node([*run[: places[i]], leaf, *run[places[i] :]])
        at += 32 * n
    return leaf


PROOFS = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PROOFS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            digests = [row["slots"][i : i + 32] for i in range(0, 32 * row["n"], 32)]
            built = tree(digests, _height(row["total"], 0))
            ids, root = np.frombuffer(row["ids"], "<i8").tolist(), row["root"]
            above = row["others"].hex().encode()
            out: dict[str, list] = {n: [] for n in names}
            for slot, leaf in enumerate(digests):
                beside = siblings(built, slot)
                proof = sha256(b"".join(d.hex().encode() for others in beside for d in others))
                proof.update(above)
                now = row["changed"][33 * slot : 33 * slot + 33]
                start = now[1:] if now[0] else leaf
                # An unchanged node leads where it led when the tree was built, but is folded all the same.
                end = climb(folded(start, slot, beside), row["ranks"], row["others"])
                for n, v in zip(names, (None if row["no_id"][slot] else ids[slot], leaf.hex(), row["subroot"].hex(), root.hex(), proof.hexdigest(), end.hex(), end == root)):
                    out[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["id"], pa.int64()), *(pa.array(out[n], pa.string()) for n in names[1:-1]), pa.array(out["verified"], pa.bool_())], names=names)


# --- the operator ----------------------------------------------------------------


def number_groups(names: DataFrame) -> DataFrame:
    """(group, g): distinct names numbered from 0 in ascending order, null first, by range and count."""
    first = F.col("group").asc_nulls_first()
    return stored(gapless(names.distinct().repartitionByRange(first).sortWithinPartitions(first), "g", "groups"), "group-numbers")


def manifest(docs: DataFrame, fields: list[str], group: str, doc_id: str = "doc_id", tamper: Column | None = None, tamper_mod: int = 3, tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``fields``: columns of a leaf, in order. ``tampered``: columns as they are found when a row with
    ``tamper`` (default: the id's CRC-32 divisible by ``tamper_mod``) is checked against
    its proof; ``verified`` is whether it still leads to the root.
    """
    require(docs, doc_id, group, *fields)
    spark = docs.sparkSession
    tampered = tampered or {}
    hit = F.crc32(quoted(doc_id).cast("string").cast("binary")) % tamper_mod == 0 if tamper is None else tamper

    def leaf_of(values: dict[str, Column]) -> Column:
        return F.unhex(F.sha2(F.concat(*(field(values.get(c, quoted(c))) for c in fields)), 256))

    leaves = stored(
        docs.select(
            quoted(doc_id).cast("long").alias("id"),
            quoted(group).cast("string").alias("group"),
            leaf_of({}).alias("leaf"),
            F.when(hit, leaf_of(tampered)).alias("changed") if tampered else F.lit(None).cast("binary").alias("changed"),
        ),
        "leaves",
    )
    groups = number_groups(leaves.select("group"))
    n_groups = groups.count()
    if not n_groups:
        return spark.createDataFrame([], PROOFS)
    rows = leaves.join(groups.withColumnRenamed("group", "name"), F.col("group").eqNullSafe(F.col("name"))).select("g", "id", "leaf", "changed")

    found = stored(containers(rows.filter("id IS NOT NULL")), "containers")
    no_id = stored(rows.filter("id IS NULL").groupBy("g").agg(F.count(F.lit(1)).alias("n")), "no-id")
    totals = stored(found.select("g", F.col("rows").alias("n")).unionByName(no_id).groupBy("g").agg(F.sum("n").cast("long").alias("n")), "totals")
    bases = stored(directory(found, no_id), "directory")
    repeated = stored(found.filter(F.length("rep_at") > 0).select("g", "chunk", "rep_at").mapInArrow(_repeated_ids, "g long, id long"), "repeated-ids")
    # Rows of ids met once have their rank; rows of others, the rank of their id, and then their place among its rows.
    single = ranked(rows.filter("id IS NOT NULL").join(repeated, ["g", "id"], "left_anti"), found, bases)
    tied = _tie_places(rows.join(repeated, ["g", "id"], "left_semi").unionByName(rows.filter("id IS NULL")))
    first = ranked(repeated.select("g", "id", F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("changed")), found, bases).select("g", "id", F.col("idx").alias("first"))
    many = tied.join(first, ["g", "id"], "left").select("g", (F.coalesce("first", F.lit(0)) + F.col("place")).alias("idx"), "id", "leaf", "changed")
    sizes = totals.select("g", F.col("n").alias("total"))
    passes = reduce_levels(single.unionByName(many) if _any(repeated, no_id) else single, lambda t: t.join(sizes, "g"), totals.agg(F.max("n")).first()[0], "nodes")

    subroots = passes[-1].select("g", F.col("out").alias("subroot"))
    tops = reduce_levels(
        subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(None).cast("long").alias("id"), F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("changed")),
        lambda t: t.withColumn("total", F.lit(n_groups).cast("long")),
        n_groups,
        "tops",
    )
    root = tops[-1].first().out  # one row of one node

    # Down again: from the root to the subroots, then to the blocks of leaves.
    nothing = F.lit("").cast("binary")
    paths = None
    for at in range(len(tops) - 1, -1, -1):
        above = tops[at].withColumns({"ranks": nothing, "others": nothing}) if paths is None else tops[at].join(paths, ["g", "block"])
        paths = stored(above.withColumn("total", F.lit(n_groups).cast("long")).mapInArrow(_paths(at), PATHS), f"top-paths-{at}")
    paths = paths.select(F.col("block").alias("g"), F.lit(0).cast("long").alias("block"), "ranks", "others")
    for at in range(len(passes) - 1, 0, -1):
        paths = stored(passes[at].join(paths, ["g", "block"]).join(sizes, "g").mapInArrow(_paths(at), PATHS), f"paths-{at}")
    blocks = passes[0].join(paths, ["g", "block"]).join(sizes, "g").join(subroots, "g").withColumn("root", F.lit(root))
    return blocks.select("n", "slots", "ids", "no_id", "changed", "ranks", "others", "total", "subroot", "root").mapInArrow(_proofs, PROOFS)


def _any(*tables: DataFrame) -> bool:
    return any(not t.isEmpty() for t in tables)


def _repeated_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], []]
        for g, chunk, at in zip(*(batch.column(c).to_pylist() for c in ("g", "chunk", "rep_at"))):
            ids = (chunk << CHUNK_BITS) + np.frombuffer(at, "<u2").astype(np.int64)
            out[0] += [g] * len(ids)
            out[1] += ids.tolist()
        yield _batch(out, "g long, id long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
