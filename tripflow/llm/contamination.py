"""Benchmark decontamination: Wu-Manber search for benchmark windows in documents.

Texts are words: A-Z lower-cased, then maximal runs of digits, letters a-z and
non-ASCII characters. The search runs over words, so a match always starts and
ends at a word. A pattern is a window of ``window`` consecutive item words
(the whole item if it has fewer, but not none).

For the patterns of one length m, with blocks of B words (B <= m):

- the *shift table* holds for each block of B words how far a search may move
  when it sees that block at the end of its current position: m - B + 1 if no
  pattern has the block, else the distance from the block's last occurrence to
  the end of a pattern;
- a block that ends some pattern has shift 0; its patterns share a
  *suffix-hash bucket*;
- patterns of the bucket are *compared directly*, word by word.

Words outside the benchmark's vocabulary can be in no pattern; they all have
id 0 and give the largest shift. The positions of all documents of a batch
advance together as NumPy vectors, so a step costs the same for any number of
documents.

The benchmark side is read in blocks of items of at most ``block_bytes`` of
text, each searched over all documents in the same map-only stage; a broadcast
never exceeds that bound (a single longer item is a block of its own), and a
task holds the tables of one block at a time. Nothing of the documents is
shuffled.

Defined results: null text has no words; an item without words is no pattern;
an empty benchmark contaminates nothing; rows of one item id count as one item (a
null id as the empty string); a row of documents gives one row, whatever its id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, free_name, map_arrow, quoted, require, sliced, utf8_of, with_fields, worker_memo

WINDOW = 13
BLOCK_BYTES = 4 << 20


def _fold_table() -> bytes:
    """Lower-case A-Z; every other ASCII byte but digits and a-z becomes a space."""
    word = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in word else 0x20 for b in range(256))


FOLD = _fold_table()


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(FOLD).split()


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return codes ^ (codes >> np.uint64(29))


def _block_hash(ids: np.ndarray, ends: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Hash of the ``size`` words that end at each of ``ends`` (exclusive)."""
    h = np.zeros(len(ends), np.uint64)
    for j in range(size, 0, -1):
        h = _mixed(h * np.uint64(0x100000001B3) + ids[ends - j].astype(np.uint64) + np.uint64(1))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class _Length:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, starts: np.ndarray, m: int, ids: np.ndarray):
        self.m, self.size = m, min(m, 3)
        self.bits = int(np.clip(np.ceil(np.log2(max(2, len(starts) * m))) + 2, 10, 24))
        self.most = m - self.size + 1
        self.shift = np.full(1 << self.bits, self.most, np.int16)
        for end in range(self.size, m + 1):  # later blocks have smaller shifts
            self.shift[_block_hash(ids, starts + end, self.size, self.bits)] = m - end
        suffix = _block_hash(ids, starts + m, self.size, self.bits)
        order = np.argsort(suffix, kind="stable")
        self.patterns = starts[order]  # sorted by bucket
        self.first = np.searchsorted(suffix[order], np.arange((1 << self.bits) + 1))


class WuManber:
    """All windows of a list of items, ready to search in word-id arrays."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.items = [key for key, _ in items]
        parts = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int32) for _, words in items]
        sizes = np.array([len(p) for p in parts], np.int64)
        begins = np.cumsum(sizes) - sizes
        self.ids = np.concatenate([*parts, np.zeros(1, np.int32)])
        self.owner = np.repeat(np.arange(len(items)), sizes)  # the item of each word
        starts: dict[int, list[np.ndarray]] = {}
        for begin, n in zip(begins, sizes):
            if n:
                m = int(min(window, n))
                starts.setdefault(m, []).append(np.arange(begin, begin + n - m + 1))
        self.lengths = [_Length(np.concatenate(s), m, self.ids) for m, s in sorted(starts.items())]

    def search(self, ids: np.ndarray, lo: np.ndarray, hi: np.ndarray, one: _Length) -> tuple[np.ndarray, np.ndarray]:
        """(start in ``ids``, pattern start) of every occurrence within the texts [lo, hi)."""
        # Long texts are cut into stretches so that no lane is much longer than the others;
        # stretches overlap by m - 1 words, so each occurrence ends in exactly one of them.
        step = 512
        n = np.maximum(0, hi - lo - one.m + 1)
        lanes = -(-n // step)
        text = np.repeat(np.arange(len(lo)), lanes)
        k = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = lo[text] + k * step + one.m  # exclusive end of the current position
        stop = np.minimum(hi[text], at + step - 1)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            h = _block_hash(ids, at, one.size, one.bits)
            move = one.shift[h].astype(np.int64)
            hit = np.flatnonzero(move == 0)
            if len(hit):
                found += self._compared(ids, at[hit] - one.m, h[hit], one)
                move[hit] = 1
            at = at + move
            live = at <= stop
            at, stop = at[live], stop[live]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _compared(self, ids: np.ndarray, begin: np.ndarray, bucket: np.ndarray, one: _Length) -> list[tuple[np.ndarray, np.ndarray]]:
        """Direct comparison of the words at ``begin`` with every pattern of their bucket."""
        left, last = one.first[bucket], one.first[bucket + 1]
        out = []
        while len(begin):
            live = left < last
            begin, left, last = begin[live], left[live], last[live]
            if not len(begin):
                break
            pattern = one.patterns[left]
            same = np.ones(len(begin), bool)
            for j in range(one.m):
                rest = np.flatnonzero(same)
                if not len(rest):
                    break
                same[rest] = ids[begin[rest] + j] == self.ids[pattern[rest] + j]
            out.append((begin[same], pattern[same]))
            left = left + 1
        return out

    def hits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Hit flags of all words, the texts' offsets among them, and each text's items."""
        get = self.vocab.get
        sizes = np.array([len(t) for t in texts], np.int64)
        off = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.fromiter((get(w, 0) for t in texts for w in t), np.int32, off[-1])
        cover = np.zeros(off[-1] + 1, np.int32)
        pairs = [np.empty(0, np.int64)]
        for one in self.lengths:
            begin, pattern = self.search(ids, off[:-1], off[1:], one)
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + one.m, -1)
            doc = np.searchsorted(off, begin, side="right") - 1
            pairs.append(np.unique(doc * (len(self.items) + 1) + self.owner[pattern]))
        pair = np.unique(np.concatenate(pairs))
        doc, item = np.divmod(pair, len(self.items) + 1)
        cut = np.searchsorted(doc, np.arange(len(texts) + 1))
        return np.cumsum(cover[:-1]) > 0, off, [item[a:b] for a, b in zip(cut[:-1], cut[1:])]


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of at most ``block_bytes`` of text, one partition at the driver at a time."""
    held, size = [], 0
    rows = benchmark.select(quoted(item_id).cast("string").alias("i"), quoted(text).cast("string").alias("t"))
    for r in rows.toLocalIterator():
        words = words_of((r.t or "").encode("utf-8"))
        n = sum(map(len, words))
        if held and size + n > block_bytes:
            yield held
            held, size = [], 0
        held.append((r.i if r.i is not None else "", words))
        size += n
    if held:
        yield held


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, found: str = "_contamination"
) -> DataFrame:
    """``docs`` with a struct column ``found``: n_words, n_hit, items (sorted strings), spans.

    ``spans`` are the maximal runs of hit words as (first word, words).
    """
    require(docs, text)
    require(benchmark, item_id, item_text)
    sc = docs.sparkSession.sparkContext
    blocks = [(sc.broadcast(b), uuid.uuid4().hex) for b in item_blocks(benchmark, item_id, item_text, block_bytes)]
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())])))])
    schema = with_fields(docs, f"{found} struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<first:bigint,words:bigint>>>")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = worker_memo("contamination", "wu_manber", lambda: BoundedCache(1))
        for batch in sliced(batches, text):
            texts = [words_of(t) for t in utf8_of(batch, text)]
            flags, items = None, [[] for _ in texts]
            for b, key in blocks:
                m = tables.get(key)
                if m is None:
                    tables.room()
                    m = tables[key] = WuManber(b.value, window)
                hit, off, hit_items = m.hits(texts)
                flags = hit if flags is None else flags | hit
                for i, f in enumerate(hit_items):
                    items[i] += [m.items[x] for x in f]
            out = []
            if flags is not None and len(flags):
                edge = np.zeros(len(flags) + 1, bool)
                edge[off] = True  # spans do not cross texts
                begins = np.flatnonzero(flags & (edge[:-1] | ~np.concatenate([[False], flags[:-1]])))
                ends = np.flatnonzero(flags & (edge[1:] | ~np.concatenate([flags[1:], [False]]))) + 1
                cut = np.searchsorted(begins, off)
            for i, t in enumerate(texts):
                spans = [] if flags is None or not len(flags) else [{"first": int(a - off[i]), "words": int(b - a)} for a, b in zip(begins[cut[i] : cut[i + 1]], ends[cut[i] : cut[i + 1]])]
                out.append({"n_words": len(t), "n_hit": sum(s["words"] for s in spans), "items": sorted(set(items[i])), "spans": spans})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, found])

    return map_arrow(docs, searched, schema)


def is_contaminated(found: str = "_contamination"):
    """True where hit words are a twentieth of the words or more (and there are any)."""
    n = F.col(f"{found}.n_hit")
    return (n > 0) & (20 * n >= F.col(f"{found}.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    found = free_name(docs, "_contamination")
    return contamination(docs, benchmark, text, found=found, **options).filter(~is_contaminated(found)).drop(found)
