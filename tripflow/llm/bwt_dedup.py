"""Removal of repeated passages by merged Burrows-Wheeler transforms.

A byte of a document goes if it is covered by a string of ``length`` (50) bytes
that also starts in a document with a smaller id. Strings are judged on the
input as it is, on UTF-8 bytes, and never cross documents.

1. *Chunks.* Each scan task packs its documents into compressed rows of about
   ``CHUNK_BYTES`` and stores them bucketed by chunk number. Text is never
   shuffled; later steps join small replies to the chunks where they lie.
2. *Anchors.* Every window of 50 bytes has an anchor: the 24-byte string in it
   with the smallest hash. Equal windows have equal anchors, so only windows
   whose anchor occurs in two documents can repeat. Each chunk asks about its
   distinct anchors (one entry each, however often a string occurs), dealt by
   hash; the reply is one bit per entry. An anchor's segments are counted on
   the way (in powers of two), and a second bit marks crowded anchors, with more
   than ``CROWD`` of them.
3. *Segments.* Consecutive windows with the same anchor are one segment of at
   most 76 bytes. A chunk sends each distinct segment with a repeated anchor
   once, with its smallest document id, dealt by the anchor's hash. Where the
   anchor is crowded, each window is a segment of its own, dealt by the hash of
   its 50 bytes, so equal windows still meet and no merge has more than
   ``CROWD`` segments of one anchor.
4. *Merge.* Equal windows now meet in one task, inside different segments of
   the same anchor. The segments are cut into shards; each shard gets its own
   Burrows-Wheeler transform, and the transforms are merged by iterative
   interleave refinement: the interleave of all shards' rotations, right for
   the first h bytes, is dealt stably by the two bytes before each rotation,
   which makes it right for h + 2 bytes. Boundaries between rotations that
   differ are carried along, so after 25 rounds the runs without a boundary
   are the intervals of rotations with a common prefix of 50 bytes; nothing is
   sorted again. The smallest id of an interval decides for all its windows.
5. *Reply.* One bit per window of each segment sent: does the window occur
   under a smaller id than the chunk's own smallest? The chunk marks its bytes.

Defined results: null and empty texts, and texts under 50 bytes, lose nothing;
rows with one id are not sources for each other; a null id is larger than all
others (rows without id lose what rows with id have); repeated rows each get a
row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import require, utf8_of

LENGTH = 50
GRAM = 24
WIDTH = LENGTH - GRAM + 1  # windows (and so anchors' candidates) per window
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # of text per bucket of anchors
SHARD = 1 << 17
MERGE = 1 << 20  # bytes of segments merged at once, and at most one anchor more
CROWD = 1 << 13  # segments of an anchor, beyond which its windows are dealt one by one
NO_ID = np.iinfo(np.int64).max
STOP = 0xFF  # in no UTF-8 text
_POSITIONS = 1 << 17
_BASE = 0x100000001B3


# --- windows and anchors -----------------------------------------------------------
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position, by joining hashes of powers of two."""
    h, n = text.astype(np.uint64) + np.uint64(1), 1
    known = {1: h}
    while 2 * n <= GRAM:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
        known[n] = h
    out, size, rest = None, 0, GRAM
    for n in sorted(known, reverse=True):
        if n <= rest:
            part = known[n]
            if out is None:
                out = part
            else:
                part = part[size:]
                m = min(len(out), len(part))
                out = out[:m] * np.uint64(pow(_BASE, n, 1 << 64)) + part[:m]
            size, rest = size + n, rest - n
    return _mix(out)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def segments_of(text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, windows, anchor hash) of all segments.

    ``off``: where each document starts in ``text``, and its end.
    """
    low = np.uint64((1 << 20) - 1)
    out: list[tuple[np.ndarray, ...]] = []
    s, n = 0, len(text)
    while s + LENGTH <= n:  # blocks of windows; the bytes of two blocks overlap by 49
        e = min(n, s + _POSITIONS + LENGTH - 1)
        h = gram_hashes(text[s:e])
        place = np.arange(len(h), dtype=np.uint64)
        at = (_least((h & ~low) | place, WIDTH) & low).astype(np.int64)  # leftmost on ties of the kept bits
        begin = np.arange(s, s + len(at))
        doc = np.searchsorted(off, begin, side="right") - 1
        inside = begin + LENGTH <= off[doc + 1]
        begin, doc, at = begin[inside], doc[inside], at[inside]
        if len(begin):
            turn = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
            out.append((doc[turn], begin[turn], np.diff(np.concatenate([turn, [len(begin)]])), _mix(h[at[turn]] + np.uint64(0x9E3779B97F4A7C15))))
        s += _POSITIONS
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


# --- chunks --------------------------------------------------------------------------
CHUNK = "chunk long, n_bytes long, ids binary, sizes binary, body binary"


def _squeezed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0

    def row() -> pa.RecordBatch:
        lengths = np.array([len(t) for t in texts], np.int64)
        body = _squeezed(b"".join(texts))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((number, size, np.array(ids, np.int64).tobytes(), lengths.tobytes(), body), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["chunk", "n_bytes", "ids", "sizes", "body"])

    for batch in batches:
        keys = batch.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        for key, text in zip(keys, utf8_of(batch, "t")):
            if texts and size + len(text) > CHUNK_BYTES:
                yield row()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(int(key))
            texts.append(text)
            size += len(text)
    if texts:
        yield row()


class Chunk:
    """An unpacked chunk with its segments."""

    def __init__(self, ids: bytes, sizes: bytes, body: bytes):
        import zstandard

        self.ids = np.frombuffer(ids, np.int64)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=int(self.sizes.sum()) + 1) if self.sizes.sum() else b""
        self.text = np.frombuffer(self.raw, np.uint8)
        self.off = np.concatenate([[0], np.cumsum(self.sizes)])
        self.doc, self.begin, self.windows, self.anchor = segments_of(self.text, self.off)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct anchors in order, whether several documents have them)."""
        order = np.argsort(self.anchor, kind="stable")  # documents ascend within an anchor
        a, d = self.anchor[order], self.doc[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])[: len(a)])
        last = np.concatenate([first[1:], [len(a)]]) - 1
        return a[first], d[first] != d[last[: len(first)]]

    def sizes_of_anchors(self) -> np.ndarray:
        """For each of ``anchors``, the power of two that its distinct segments do not exceed (up to 8 segments are taken as distinct)."""
        order = np.argsort(self.anchor, kind="stable")
        a = self.anchor[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])[: len(a)])
        n = np.diff(np.append(first, len(a)))
        many = np.flatnonzero(n > 8)
        if len(many):
            which = np.repeat(np.arange(len(n)), n)
            at = np.flatnonzero(n[which] > 8)
            use, which = order[at], which[at]
            x, y = fingerprints(self.text, self.begin[use], self.windows[use] + LENGTH - 1)
            o = np.lexsort((y, x, which))
            w, x, y = which[o], x[o], y[o]
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            n[many] = np.bincount(w[new], minlength=len(n))[many]
        return np.ceil(np.log2(n)).astype(np.uint8)

    def keep(self, repeated: np.ndarray, crowded: np.ndarray) -> None:
        """Forget the segments whose anchor is not among the ``repeated`` (flags as in ``anchors``).

        Those with a ``crowded`` anchor are cut into their windows, each with its own hash as anchor.
        """
        distinct, _ = self.anchors()
        at = np.searchsorted(distinct, self.anchor)
        use = repeated[at] if len(distinct) else np.zeros(0, bool)
        cut = crowded[at[use]] if len(distinct) else np.zeros(0, bool)
        self.doc, self.begin, self.windows, self.anchor = self.doc[use], self.begin[use], self.windows[use], self.anchor[use]
        if not cut.any():
            return
        n = self.windows[cut]
        begin = np.repeat(self.begin[cut] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = np.ones(len(begin), np.int64)
        window, _ = fingerprints(self.text, begin, own * LENGTH)
        self.doc = np.concatenate([self.doc[~cut], np.repeat(self.doc[cut], n)])
        self.begin, self.windows, self.anchor = (np.concatenate([old[~cut], new]) for old, new in ((self.begin, begin), (self.windows, own), (self.anchor, window)))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a segment of each distinct content, ordered by anchor; its smallest id; each segment's distinct number)."""
        a, b = fingerprints(self.text, self.begin, self.windows + LENGTH - 1)
        key = self.ids[self.doc]
        order = np.lexsort((key, b, a, self.anchor))
        x, y, z = self.anchor[order], a[order], b[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])])[: len(order)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        return lead, key[lead], number


def _pieces(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the stretches one after another."""
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return text[at]


def fingerprints(text: np.ndarray, begin: np.ndarray, size: np.ndarray, step: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each stretch's bytes and length."""
    rng = np.random.default_rng(7)
    weights = rng.integers(0, 1 << 63, (2, LENGTH + WIDTH), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((2, len(begin)), np.uint64)
    for s in range(0, len(begin), step):
        b, n = begin[s : s + step], size[s : s + step]
        raw = _pieces(text, b, n).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
        for i in (0, 1):
            out[i, s : s + step] = _mix(np.add.reduceat(raw * weights[i][at], ends - n) + n.astype(np.uint64))
    return out[0], out[1]


# --- merged transforms -----------------------------------------------------------------
class Shard:
    """The Burrows-Wheeler transform of one byte string, on rotations up to 64 bytes."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        v = np.concatenate([text, np.resize(text, 8)]).astype(np.uint64)
        for step in (1, 2, 4):
            v = (v[:-step] << np.uint64(8 * step)) | v[step:]
        order, rank = self._ranked(v[:n])
        for step in (8, 16, 32):
            if rank[order[-1]] == n - 1:
                break
            order, rank = self._ranked((rank.astype(np.uint64) << np.uint64(32)) | np.roll(rank, -(step % n)).astype(np.uint64))
        self.order = order
        # Two bytes before each rotation, and the row of the rotation that starts there.
        self.before = np.roll(text, 2)[order].astype(np.uint16) << np.uint16(8) | np.roll(text, 1)[order]
        row = np.empty(n, np.int32)
        row[order] = np.arange(n, dtype=np.int32)
        self.back = np.roll(row, 2)[order]

    @staticmethod
    def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        s = keys[order]
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        return order, rank


def merged_intervals(shards: list[np.ndarray], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the joined shards, interval numbers) of rotations that share their
    first ``length`` bytes (an even number) with another; positions of one interval are neighbours."""
    built = [Shard(s) for s in shards]
    base = np.cumsum([0, *[len(s) for s in shards]])
    before = np.concatenate([b.before for b in built])
    back = np.concatenate([b.back + np.int32(o) for b, o in zip(built, base)])
    row = np.arange(base[-1], dtype=np.int32)  # the interleave, as rows of the shards' transforms
    group = np.zeros(base[-1], np.int32)  # numbered stretches with a common prefix
    for _ in range(length // 2):
        symbol = before[row]
        deal = np.argsort(symbol, kind="stable")
        symbol, group, row = symbol[deal], group[deal], back[row[deal]]
        edge = np.ones(len(row) + 1, bool)
        edge[1:-1] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        # A rotation alone in its stretch stays alone, and so do those before it in the text.
        more = ~(edge[:-1] & edge[1:])
        row, group = row[more], np.cumsum(edge[:-1], dtype=np.int32)[more]
        if not len(row):
            break
    order = np.concatenate([b.order + o for b, o in zip(built, base)])
    return order[row], group


def smallest_ids(text: np.ndarray, size: np.ndarray, anchor: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For distinct segments ordered by anchor: the smallest id of each window's bytes.

    One row per segment, one column per window (``WIDTH`` of them).
    """
    out = np.repeat(ids[:, None], WIDTH, axis=1)
    # A segment alone under its anchor has no other place to be.
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])[: len(anchor)]
    edge = np.append(new, True)
    shared = np.flatnonzero(~(edge[:-1] & edge[1:]))
    start = np.cumsum(size) - size
    s = 0
    while s < len(shared):
        # Whole anchors, up to about MERGE bytes.
        total = np.cumsum(size[shared[s:]] + 1)
        e = s + max(1, int(np.searchsorted(total, MERGE)))
        while e < len(shared) and not new[shared[e]]:
            e += 1
        part = shared[s:e]
        _merge_windows(text, start[part], size[part], ids[part], out, part)
        s = e
    return out


def _merge_windows(text: np.ndarray, begin: np.ndarray, size: np.ndarray, ids: np.ndarray, out: np.ndarray, part: np.ndarray) -> None:
    room = size + 1  # a stop after each
    ends = np.cumsum(room)
    joined = np.full(int(ends[-1]), STOP, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[ends - 1] = False
    joined[inside] = _pieces(text, begin, size)
    # Shards of whole segments.
    cut = [0, *[int(x) for x in np.unique(ends[np.searchsorted(ends, np.arange(SHARD, len(joined), SHARD))])], len(joined)]
    shards = [joined[a:b] for a, b in zip(cut[:-1], cut[1:]) if b > a]
    at, group = merged_intervals(shards)
    seg = np.searchsorted(ends, at, side="right")
    window = at - (ends[seg] - room[seg])
    real = window + LENGTH <= size[seg]  # not a rotation that runs over a stop
    seg, window, group = seg[real], window[real], group[real]
    if not len(seg):
        return
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(ids[seg], first)
    out[part[seg], window] = np.repeat(least, np.diff(np.append(first, len(seg))))


# --- the jobs -------------------------------------------------------------------------------
def _bucket_rows(chunk: int, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), int(cut[b]), int(cut[b + 1])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _flags(replies: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Replies of all buckets, in bucket order, as two arrays of flags: repeated, crowded."""
    parts = sorted(replies or [], key=lambda r: r["bucket"])
    return tuple(np.concatenate([np.zeros(0, bool), *[np.unpackbits(np.frombuffer(r[kind], np.uint8), count=r["n"]).astype(bool) for r in parts]]) for kind in ("bits", "crowded"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256.

    ``kept`` holds the remaining bytes, which may cut characters.
    """
    require(docs, doc_id, text)
    spark = docs.sparkSession
    path, name = scratch_path(spark, "repeats"), f"chunks_{uuid.uuid4().hex}"
    packed = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(_packed, CHUNK)
    packed.write.option("path", f"{path}/chunks").option("compression", "uncompressed").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").saveAsTable(name)
    chunks = spark.table(name)
    buckets = max(1, -(-(chunks.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                c = Chunk(r["ids"], r["sizes"], r["body"])
                (anchor, several), log = c.anchors(), c.sizes_of_anchors()
                rows = [(r["chunk"], b, anchor[lo:hi].astype("<u4").tobytes(), np.packbits(several[lo:hi]).tobytes(), log[lo:hi].tobytes()) for b, lo, hi in _bucket_rows(r["chunk"], bucket_of(anchor, buckets), buckets)]
                yield _table(rows, ASK)

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [np.frombuffer(r["hashes"], "<u4") for r in rows]
        several = [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(p)).astype(bool) for r, p in zip(rows, parts)]
        merged = np.sort(np.concatenate(parts))
        twice = np.unique(merged[1:][merged[1:] == merged[:-1]])
        bits = [s | _among(p, twice) for p, s in zip(parts, several)]
        # Segments are counted under the anchors that several documents have.
        hashes = np.concatenate([p[b] for p, b in zip(parts, bits)])
        counts = np.int64(1) << np.concatenate([np.frombuffer(r["logs"], np.uint8)[b] for r, b in zip(rows, bits)]).astype(np.int64)
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
        crowded = hashes[first][np.add.reduceat(counts, first) > CROWD] if len(first) else hashes
        return pa.Table.from_batches([_table([(r["chunk"], r["bucket"], len(b), np.packbits(b).tobytes(), np.packbits(_among(p, crowded)).tobytes()) for r, p, b in zip(rows, parts, bits)], FLAGS)])

    asked = chunks.mapInArrow(ask, ASK)
    flags_path = f"{path}/anchors"
    asked.groupBy("bucket").applyInArrow(answer, FLAGS).write.parquet(flags_path)
    flags = spark.read.schema(FLAGS).parquet(flags_path)
    known = flags.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "bits", "crowded")).alias("anchors"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                c = Chunk(r["ids"], r["sizes"], r["body"])
                c.keep(*_flags(r["anchors"]))
                lead, least, _ = c.distinct()
                anchor, size = c.anchor[lead], c.windows[lead] + LENGTH - 1
                rows = []
                for b, lo, hi in _bucket_rows(r["chunk"], bucket_of(anchor, buckets), buckets):
                    body = _pieces(c.text, c.begin[lead[lo:hi]], size[lo:hi]).tobytes()
                    rows.append((r["chunk"], b, size[lo:hi].astype(np.uint8).tobytes(), anchor[lo:hi].tobytes(), least[lo:hi].tobytes(), body))
                yield _table(rows, SENT)

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        size = np.concatenate([np.frombuffer(r["sizes"], np.uint8) for r in rows]).astype(np.int64)
        anchor = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        body = np.frombuffer(b"".join(r["body"] for r in rows), np.uint8)
        counts = [len(r["sizes"]) for r in rows]
        begin = np.cumsum(size) - size
        # Segments of the same bytes from several chunks are one, with the smallest id.
        a, b = fingerprints(body, begin, size)
        order = np.lexsort((ids, b, a, anchor))
        x, y, z = anchor[order], a[order], b[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        least = smallest_ids(_pieces(body, begin[lead], size[lead]), size[lead], anchor[lead], ids[lead])
        out, at = [], 0
        for r, n in zip(rows, counts):
            part = slice(at, at + n)
            bits = least[number[part]] < ids[part, None]
            mask = (bits << np.arange(WIDTH)[None, :]).sum(axis=1).astype("<u4")
            out.append((r["chunk"], r["bucket"], mask.tobytes()))
            at += n
        return pa.Table.from_batches([_table(out, MASKS)])

    sent = chunks.join(known, "chunk", "left").select("chunk", "ids", "sizes", "body", "anchors").mapInArrow(send, SENT)
    masks_path = f"{path}/masks"
    sent.groupBy("bucket").applyInArrow(judge, MASKS).write.parquet(masks_path)
    masks = spark.read.schema(MASKS).parquet(masks_path)
    judged = masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "masks")).alias("masks"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                c = Chunk(r["ids"], r["sizes"], r["body"])
                c.keep(*_flags(r["anchors"]))
                _, least, number = c.distinct()
                parts = sorted(r["masks"] or [], key=lambda m: m["bucket"])
                mask = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(m["masks"], "<u4") for m in parts]])
                yield from _marked(c, least, number, mask)

    everything = chunks.join(known, "chunk", "left").join(judged, "chunk", "left").select("chunk", "ids", "sizes", "body", "anchors", "masks")
    done = f"{path}/done"
    everything.mapInArrow(mark, DONE).write.parquet(done)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay in the checkpoint folder
    return spark.read.schema(DONE).parquet(done)


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _marked(c: Chunk, least: np.ndarray, number: np.ndarray, mask: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Result rows of a chunk: bytes covered by windows that occur under a smaller id."""
    key = c.ids[c.doc]
    # A segment under a larger id than the chunk's smallest repeats that one as a whole.
    own = np.where(key > least[number], np.uint32((1 << WIDTH) - 1), mask[number]) if len(number) else np.empty(0, np.uint32)
    cover = np.zeros(len(c.text) + 1, np.int32)
    for i in range(WIDTH):
        at = c.begin[(own >> np.uint32(i) & np.uint32(1)).astype(bool) & (c.windows > i)] + i
        cover[at] += 1  # windows start at different places, so each place once
        cover[at + LENGTH] -= 1
    gone = np.cumsum(cover[:-1]) > 0
    rows = []
    for k, n, s in zip(c.ids, c.sizes, c.off):
        g = gone[s : s + n]
        kept = c.text[s : s + n][~g].tobytes() if g.any() else c.raw[s : s + n]
        spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
        rows.append((None if k == NO_ID else int(k), int(n), int(g.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
        if len(rows) == 500:
            yield _table(rows, DONE)
            rows = []
    if rows:
        yield _table(rows, DONE)


ASK = "chunk long, bucket int, hashes binary, several binary, logs binary"
FLAGS = "chunk long, bucket int, n int, bits binary, crowded binary"
SENT = "chunk long, bucket int, sizes binary, hashes binary, ids binary, body binary"
MASKS = "chunk long, bucket int, masks binary"
DONE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), _KINDS[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])
