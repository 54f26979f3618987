"""Token-id files coded with a static range asymmetric numeral system (rANS).

Steps, all of them Spark jobs over the whole input:

1. ``encode_documents``: text -> token ids with the tokenizers library, the
   end id appended; one row per document, and after them the task's counts of every id,
   so that nothing reads the ids again to count them.
2. ``frequency_table``: the counts of all tasks, summed (one row per id at the
   driver, so bounded by the vocabulary) and
   scaled to a power of two. The table is shared by all blocks.
3. ``write_token_files``: documents are range-partitioned and sorted by id;
   each partition is a *shard*, cut into independent blocks. A block codes its
   ids on interleaved lanes (id ``t`` on lane ``t mod K``) into one stream of
   32-bit words, and holds the lanes' states at its start and at each
   checkpoint, the word offset of each checkpoint, and a CRC-32 of its ids and
   of each part between checkpoints.
   Blocks are rows of a Parquet data set, so the writer's commit makes them
   safe against lost tasks.
4. ``read_token_files``: every part is a row of its own, with the words and
   states from its checkpoint on, decodes by itself and is held against its checksum;
   documents that cross parts are joined by combining their CRCs, so no reading task
   holds a whole document or shard.

Encoding holds one text with its words and ids at a time (or a slice of shorter ones). Words of
over ``MEMO_CHARS`` bytes are never remembered, so the memo of a worker has a
bound in bytes, some 250 an entry.

Defined results: a null or empty text is the end id alone; rows with a null
doc_id come first, repeated ids are ordered by content and each keep a row; an
empty table gives no blocks and no rows.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import BoundedCache, quoted, read_tokenizer, require, sliced, worker_memo

SCALE_BITS = 20
LOWER = 31  # states stay in [2**31, 2**63)
BLOCK_TOKENS = 1 << 19
CHECKPOINT_TOKENS = 1 << 18
LANES = 2048
WORD_MEMO = 500_000
MEMO_CHARS = 64
ENCODE_BYTES = 32 << 20  # text encoded at once: the more, the fewer words are looked up again
TOGETHER = 4000  # pre-tokens that go to the model in one string
LAST_LATIN = "\u024f"
PLAIN_WORD = "^[a-zß-öø-ÿ]+$"  # lower case, composed, one pre-token


# --- text to ids --------------------------------------------------------------
class WordEncoder:
    """Ids of texts by the tokenizers library, memoised by word.

    A tokenizer whose normalizer lower-cases and whose pre-tokenizer drops
    white space gives a text the ids of its space-separated words one after
    another, so each distinct word of a slice is encoded once. Words of lower-case Latin
    letters go straight to the library's BPE model, thousands in one string; other words of Latin
    characters are normalised and split here before that, and remembered; any others go through
    the whole library. Files of any other make are encoded text by text.
    """

    def __init__(self, text: str, dtype: str):
        """``text``: the JSON of a tokenizer file."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.library, self.dtype = Tokenizer.from_str(text), dtype
        spec = json.loads(text)
        parts = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = splits[0].get("pattern", {}).get("Regex", "")
        self.by_word = (
            [p["type"] for p in parts] == ["NFC", "Replace", "Lowercase"]
            and splits[0].get("type") == "Split"
            and splits[0].get("behavior") == "Removed"
            and bool(splits[0].get("invert"))
            and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and [p["type"] for p in splits[1:]] == ["ByteLevel"]
            and not splits[1].get("add_prefix_space")
            and not splits[1].get("use_regex")
        )
        self.pattern = regex.compile(pattern)
        self.memo = BoundedCache(WORD_MEMO)
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = self.by_word and bool(suffix)
        if self.by_word:  # the model and its byte letters alone, over pre-tokens that blanks part: each ends with an id that has the suffix
            self.model = Tokenizer(self.library.model)
            self.model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        out = []
        for s in range(0, len(texts), 1000):
            out += [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(texts[s : s + 1000], add_special_tokens=False)]
        return out

    def _pre_tokens(self, w: bytes) -> list[str] | None:
        """The pre-tokens of a word; None if it needs the whole library."""
        text = w.decode("utf-8")
        if "<|" in text or max(text) > LAST_LATIN:
            return None
        text = unicodedata.normalize("NFC", text).lower()
        return [text] if text.isalpha() else self.pattern.findall(text)

    def _spelled(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, where each word's end) of words that are one pre-token each, from the library's BPE model."""
        cuts = [*range(0, len(words), TOGETHER), len(words)]
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words), " ").to_pylist()
        ids = np.concatenate([np.zeros(0, self.dtype), *(np.array(e.ids, self.dtype) for line in lines for e in self.model.encode_batch_fast([line], add_special_tokens=False))])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):  # bytes that the vocabulary lacks
            each = [np.frombuffer(b, self.dtype) for b in self._library(words.to_pylist())]
            return np.concatenate([ids[:0], *each]), np.cumsum([len(x) for x in each], dtype=np.int64)
        return ids, ends

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some distinct words, remembered, as little-endian bytes."""
        known = self.memo
        if len(known) + len(words) > known.limit:
            known.clear()
        out = list(map(known.get, words))
        pre_tokens, new, odd = [], [], []
        for i, ids in enumerate(out):
            if ids is None:
                found = self._pre_tokens(words[i]) if words[i] else []
                if found is None:
                    odd.append(i)
                else:
                    new.append((i, len(found)))
                    pre_tokens += found
        ids, ends = self._spelled(pa.array(pre_tokens, pa.string()))
        raw, cuts, at = ids.tobytes(), [0, *(ends * ids.itemsize).tolist()], 0
        for i, n in new:
            out[i] = raw[cuts[at] : cuts[at + n]]
            at += n
        for i, ids in zip(odd, self._library([words[i].decode("utf-8") for i in odd])):
            out[i] = ids
        known.update((words[i], out[i]) for i in [*(i for i, _ in new), *odd] if len(words[i]) <= MEMO_CHARS)
        return out

    def encode(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each with ``end`` after it; number of ids of each text)."""
        n, tail = len(texts), np.array(end, self.dtype)
        if not self.by_word:
            each = [np.frombuffer(b, self.dtype) for b in self._library(texts.to_pylist())]
            return np.concatenate([tail[:0], *(x for ids in each for x in (ids, tail))]), np.array([len(x) + len(tail) for x in each], np.int64)
        # ASCII case is folded here, unless special strings (which are case-sensitive) may be near.
        folded = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        # A full stop or comma that ends a word is a pre-token of its own.
        folded = pc.replace_substring_regex(folded, r"([a-z])([.,])(\s|$)", r"\1 \2\3")
        split = pc.ascii_split_whitespace(folded)
        bounds = split.offsets.to_numpy().astype(np.int64)
        found = split.values.dictionary_encode()
        distinct = found.dictionary
        # Words of common lower-case letters go to the model as they are, without a Python object each.
        plain = pc.match_substring_regex(distinct, PLAIN_WORD).to_numpy(zero_copy_only=False)
        size, start = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        ids, ends = self._spelled(distinct.filter(pa.array(plain)).cast(pa.string()))
        size[plain] = np.diff(ends, prepend=0)
        start[plain] = ends - size[plain]
        odd = self.words(distinct.filter(pa.array(~plain)).cast(pa.string()).cast(pa.binary()).to_pylist())
        size[~plain] = np.fromiter(map(len, odd), np.int64, len(odd)) // ids.itemsize
        start[~plain] = len(ids) + np.cumsum(size[~plain]) - size[~plain]
        flat = np.concatenate([ids, np.frombuffer(b"".join(odd), self.dtype)])
        del odd, split, folded, distinct
        at = found.indices.to_numpy()
        before = np.concatenate([[0], np.cumsum(size[at])])
        own = before[bounds[1:]] - before[bounds[:-1]]  # ids of each text
        # Where each word's ids are taken from, minus where they go; then word by word, id by id.
        source = np.repeat(start[at] - before[:-1], size[at]) + np.arange(before[-1])
        out = np.empty(int(before[-1]) + n * len(tail), self.dtype)
        out[np.arange(before[-1]) + np.repeat(np.arange(n) * len(tail), own)] = flat[source]
        ends = np.cumsum(own + len(tail))
        for k, v in enumerate(tail):
            out[ends - len(tail) + k] = v
        return out, own + len(tail)


ENCODED = "doc_id long, n int, ids binary, counts binary"


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", wide: bool = False) -> DataFrame:
    """(doc_id, n, ids, counts): the ids of each text and ``end_id``, 2 bytes each (4 if ``wide``), and their number.

    The last row of each task has no document but ``counts``: how often it has met each id.
    """
    require(docs, doc_id, text)
    dtype = "<u4" if wide else "<u2"
    narrow = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("t"))

    spec = read_tokenizer(tokenizer_path)
    shared, key = docs.sparkSession.sparkContext.broadcast(spec), zlib.crc32(spec.encode("utf-8"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_memo("token_files", f"word_encoder:{key}:{dtype}", lambda: WordEncoder(shared.value, dtype))
        counts = np.zeros(0, np.int64)
        for batch in sliced(batches, "t", ENCODE_BYTES):
            ids, n = encoder.encode(batch.column("t"), [end_id])
            new = np.bincount(ids)
            if len(new) > len(counts):
                new, counts = counts, new
            counts[: len(new)] += new
            cuts = np.concatenate([[0], np.cumsum(n * ids.itemsize)])
            column = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(cuts), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int32)), column, pa.nulls(len(n), pa.binary())], names=["doc_id", "n", "ids", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["doc_id", "n", "ids", "counts"])

    return narrow.mapInArrow(encoded, ENCODED)


# --- shared frequencies ---------------------------------------------------------
def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) from the counts of the encoding tasks: one row per id and batch of tasks, then one sum per id."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                n = np.frombuffer(raw, "<i8")
                total = np.concatenate([total, np.zeros(max(0, len(n) - len(total)), np.int64)])
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    return tokens.filter("counts IS NOT NULL").select("counts").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def frequency_table(counts: dict[int, int], vocab: int) -> np.ndarray:
    """Frequencies (uint64 per id) that sum to 2**SCALE_BITS, at least 1 for every id seen."""
    freq = np.zeros(vocab, np.int64)
    if not counts:
        return freq.astype(np.uint64)
    ids = np.array(sorted(counts), np.int64)
    n = np.array([counts[i] for i in ids], np.float64)
    if len(ids) > 1 << SCALE_BITS:
        raise ValueError(f"{len(ids)} different ids do not fit a table of 2**{SCALE_BITS} slots")
    f = np.maximum(1, np.floor(n / n.sum() * (1 << SCALE_BITS))).astype(np.int64)
    spare = (1 << SCALE_BITS) - int(f.sum())
    order = np.argsort(-f, kind="stable")
    while spare:  # hand out (or take back) what rounding left, largest first
        for i in order:
            step = int(np.clip(spare, 1 - f[i], None)) if spare < 0 else spare
            if spare < 0:
                step = max(step, -(int(f[i]) // 2))
            f[i] += step
            spare -= step
            if not spare:
                break
    freq[ids] = f
    return freq.astype(np.uint64)


class Coder:
    """rANS over one shared frequency table; blocks are coded and decoded independently."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_TOKENS) -> dict:
        """words, states (start and checkpoints) and word offsets of one block."""
        n = len(ids)
        k = max(1, min(lanes, n))
        steps, step_every = -(-n // k), max(1, every // k)
        f, c = self.freq[ids], self.start[ids]
        top = f << np.uint64(LOWER + 32 - SCALE_BITS)
        x = np.full(k, 1 << LOWER, np.uint64)
        words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
        marks: dict[int, np.ndarray] = {}
        for t in range(steps - 1, -1, -1):
            lo, hi = t * k, min(n, t * k + k)
            y = x[: hi - lo]
            full = y >= top[lo:hi]
            words[t] = y[full].astype(np.uint32)  # the low 32 bits
            y = np.where(full, y >> np.uint64(32), y)
            q, r = np.divmod(y, f[lo:hi])
            x[: hi - lo] = (q << np.uint64(SCALE_BITS)) + r + c[lo:hi]
            if t % step_every == 0:
                marks[t] = x.copy()
        at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        keep = sorted(marks)
        return {
            "lanes": k,
            "words": np.concatenate([np.empty(0, np.uint32), *words]).astype("<u4").tobytes(),
            "states": b"".join(marks[t].astype("<u8").tobytes() for t in keep),
            "offsets": at[keep].tolist(),
        }

    def parts(self, n: int, lanes: int, every: int = CHECKPOINT_TOKENS) -> list[tuple[int, int]]:
        """Ranges of ids between checkpoints of a block of ``n`` ids."""
        size = max(1, every // lanes) * lanes
        return [(s, min(n, s + size)) for s in range(0, n, size)]

    def decode(self, block: dict, n: int, part: int | None = None, every: int = CHECKPOINT_TOKENS) -> np.ndarray:
        """The ids of a block, or of its ``part``-th stretch between checkpoints only."""
        k = block["lanes"]
        lo, hi = (0, n) if part is None else self.parts(n, k, every)[part]
        states = np.frombuffer(block["states"], "<u8").reshape(-1, k)
        words = np.frombuffer(block["words"], "<u4")
        return self.decode_from(states[part or 0], words[block["offsets"][part or 0] :], hi - lo)

    def decode_from(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from a checkpoint: its lanes' states, and the words from there on."""
        k = len(states)
        x = states.astype(np.uint64)
        lo, hi, at = 0, n, 0
        out = np.empty(n, np.uint32)
        mask, low = np.uint64((1 << SCALE_BITS) - 1), np.uint64(1 << LOWER)
        for t in range(lo, hi, k):
            m = min(k, hi - t)
            y = x[:m]
            slot = y & mask
            s = self.slot[slot.astype(np.int64)]
            out[t - lo : t - lo + m] = s
            y = self.freq[s] * (y >> np.uint64(SCALE_BITS)) + slot - self.start[s]
            need = np.flatnonzero(y < low)
            if len(need):
                y[need] = (y[need] << np.uint64(32)) | words[at : at + len(need)].astype(np.uint64)
                at += len(need)
            x[:m] = y
        return out


# --- files ------------------------------------------------------------------------
BLOCK_SCHEMA = "shard int, block int, first_token long, n_tokens int, lanes int, words binary, states binary, offsets array<long>, crc32 long, part_sizes array<int>, part_crc32 array<long>, first_document long, first_piece int, doc_ids array<long>, piece_tokens array<int>"


def write_token_files(tokens: DataFrame, path: str, wide: bool = False, vocab: int = 1 << 16) -> None:
    """Write rows of ``encode_documents`` as blocks in ascending doc_id order under ``path`` (blocks/, table/)."""
    spark = tokens.sparkSession
    counts = {r.id: r.n for r in count_ids(tokens).collect()}  # one row per id of the vocabulary
    freq = frequency_table(counts, max([vocab, *(i + 1 for i in counts)]))
    seen = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in seen], "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)
    dtype = "<u4" if wide else "<u2"
    ordered = (
        tokens.filter("counts IS NULL")
        .withColumn("_row", F.monotonically_increasing_id())
        .select("doc_id", "ids", "_tie", "_row")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie", "_row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie", "_row")
        .select("doc_id", "ids")
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        coder = Coder(shared.value)
        held: list[np.ndarray] = []
        size = block = first_token = document = piece = 0
        pieces: list[tuple[int | None, int]] = []
        first = (0, 0)

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            b = coder.encode(ids)
            raw, parts = ids.astype("<u4").tobytes(), coder.parts(len(ids), b["lanes"])
            checks = [zlib.crc32(raw[4 * lo : 4 * hi]) for lo, hi in parts]
            row = [shard, block, first_token, len(ids), b["lanes"], b["words"], b["states"], b["offsets"], zlib.crc32(raw), [hi - lo for lo, hi in parts], checks, *first, [p[0] for p in pieces], [p[1] for p in pieces]]
            return pa.RecordBatch.from_arrays([pa.array([v], type=kind) for v, kind in zip(row, BLOCK_TYPES)], names=BLOCK_NAMES)

        for batch in batches:
            for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(raw.as_buffer(), dtype)
                while len(ids):
                    take = ids[: BLOCK_TOKENS - size]
                    if not pieces:
                        first = (document, piece)
                    held.append(take)
                    pieces.append((key, len(take)))
                    size += len(take)
                    ids = ids[len(take) :]
                    piece += 1
                    if size == BLOCK_TOKENS:
                        yield closed()
                        first_token += size
                        block, size, held, pieces = block + 1, 0, [], []
                document, piece = document + 1, 0
        if size:
            yield closed()

    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    shared.unpersist()


BLOCK_NAMES = [c.split(" ")[0] for c in BLOCK_SCHEMA.split(", ")]
BLOCK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]


def load_table(spark: SparkSession, path: str) -> np.ndarray:
    """The shared frequencies of ``path`` (one row per id of the vocabulary)."""
    rows = spark.read.parquet(f"{path}/table").collect()
    freq = np.zeros(max([r.id + 1 for r in rows], default=1), np.uint64)
    for r in rows:
        freq[r.id] = r.frequency
    return freq


def parts_of(blocks: DataFrame) -> DataFrame:
    """A row for each part of each block: the words and states from its checkpoint on, its size, CRC and place."""
    part = F.col("part")
    here, after = F.element_at("offsets", part + 1), F.try_element_at("offsets", part + 2)
    words = F.length("words") / 4
    return blocks.select("*", F.posexplode("part_sizes").alias("part", "size")).select(
        "shard",
        "block",
        "part",
        "size",
        "lanes",
        F.aggregate(F.slice("part_sizes", F.lit(1), part), F.lit(0).cast("long"), lambda a, n: a + n).alias("skipped"),
        F.substring("words", (4 * here + 1).cast("int"), (4 * (F.coalesce(after, words.cast("long")) - here)).cast("int")).alias("words"),
        F.substring("states", 8 * F.col("lanes") * part + 1, 8 * F.col("lanes")).alias("states"),
        F.element_at("part_crc32", part + 1).alias("crc32"),
        "first_token",
        "first_document",
        "first_piece",
        "doc_ids",
        "piece_tokens",
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    shared = spark.sparkContext.broadcast(load_table(spark, path))
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            out: list[tuple] = []
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                raw = memoryview(coder.decode_from(np.frombuffer(r["states"], "<u8"), np.frombuffer(r["words"], "<u4"), r["size"]).astype("<u4").tobytes())
                if zlib.crc32(raw) != r["crc32"]:
                    raise ValueError(f"shard {r['shard']} block {r['block']} part {r['part']}: checksum differs")
                # The pieces of documents that lie in this part, in tokens of the block.
                at, document, lo, hi = 0, r["first_document"], r["skipped"], r["skipped"] + r["size"]
                for key, n in zip(r["doc_ids"], r["piece_tokens"]):
                    a, b = max(at, lo), min(at + n, hi)
                    if a < b:
                        out.append((r["shard"], document, key, r["first_token"] + a, b - a, zlib.crc32(raw[4 * (a - lo) : 4 * (b - lo)])))
                    at, document = at + n, document + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*out), PIECE_TYPES)] if out else [pa.array([], k) for k in PIECE_TYPES], names=PIECE_NAMES)

    pieces = parts_of(stored).mapInArrow(decoded, PIECE_SCHEMA)
    documents = pieces.groupBy("shard", "document").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts")
    )

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            first = parts.offsets.to_numpy()
            n, crc = (parts.values.field(c).to_numpy() for c in ("n", "crc"))
            crcs = crc[first[:-1]]
            for i in np.flatnonzero(np.diff(first) > 1).tolist():
                for k in range(first[i] + 1, first[i + 1]):
                    crcs[i] = crc32_joined(int(crcs[i]), int(crc[k]), 4 * int(n[k]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("shard", "doc_id", "at", "n_tokens")], pa.array(crcs, pa.int64())], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    whole = documents.mapInArrow(folded, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # One row per shard: the ids of all shards before it.
    sizes = stored.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("shard", before.alias("base"))
    return whole.join(F.broadcast(offsets), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


PIECE_SCHEMA = "shard int, document long, doc_id long, at long, n long, crc long"
PIECE_NAMES = [c.split(" ")[0] for c in PIECE_SCHEMA.split(", ")]
PIECE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def crc32_joined(a: int, b: int, length: int) -> int:
    """CRC-32 of two byte strings in a row, from their CRCs and the second's length.

    ``a`` is carried through ``length`` zero bytes by repeated squaring of the
    one-bit shift matrix over GF(2), one column per bit.
    """

    def times(matrix: list[int], vector: int) -> int:
        out, i = 0, 0
        while vector:
            if vector & 1:
                out ^= matrix[i]
            vector, i = vector >> 1, i + 1
        return out

    power = [0xEDB88320, *(1 << i for i in range(31))]  # fixed value: the CRC-32 polynomial, reflected
    bits = 8 * length
    while bits:
        if bits & 1:
            a = times(power, a)
        power = [times(power, column) for column in power]
        bits >>= 1
    return a ^ b


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, doc_id: str = "doc_id", text: str = "text", wide: bool = False) -> str:
    """Encode ``docs`` and write their token files; returns the folder."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    ids = f"{path}/ids"
    # The tie hash is stored, so that sampling the ranges does not read the ids.
    encoded = encode_documents(docs, tokenizer_path, end_id, doc_id, text, wide).withColumn("_tie", F.xxhash64("ids"))
    encoded.write.option("compression", "zstd").parquet(ids)
    write_token_files(spark.read.schema(encoded.schema).parquet(ids), path, wide)
    return path
