"""Token counts by the whole-token shortcut (byte-level BPE).

Offline proof: a vocabulary string is *whole* if it is one pre-token by itself
and its merges end in one token. ``whole_tokens`` establishes this by running
the merges on every vocabulary string; a pre-token among them counts 1 without
merging, and only the rest are merged (memoised per worker).

Pre-tokenising is local: a text cut at single spaces between two non-space
characters has the pre-tokens of its parts (each with its leading space), so
parts are counted once and memoised. Texts with other runs of white space are
pre-tokenised as a whole.

Defined results: null and empty text count 0 tokens; special strings inside a
text (``added_tokens`` of the file) count 1 each, as the library's default
has it; repeated rows each get their own row; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, read_tokenizer, require, sliced, texts_of, worker_memo

# Fixed value: the byte-level pre-tokenising pattern of the tokenizer file's
# "ByteLevel" pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space that may not be a cut: white space on either side of it.
_ODD_SPACE = r"\s |[ ]\s"
CACHE_ENTRIES = 1_000_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in ascending order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """Merges and whole tokens of a byte-level BPE file (its JSON text) of the tokenizers library."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-level BPE files are handled")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.letters = byte_letters()
        self.specials = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.pre = regex.compile(PRE_TOKEN)
        self.odd = regex.compile(_ODD_SPACE)
        self.whole = self.whole_tokens(model["vocab"])

    def whole_tokens(self, vocab: dict[str, int]) -> frozenset[str]:
        """Texts that are one pre-token and encode alone as one token."""
        value = {c: b for b, c in enumerate(self.letters)}
        out = []
        for token in vocab:
            try:
                text = bytes(map(value.__getitem__, token)).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if self.pre.fullmatch(text) and self.pre.findall(text) == [text] and self.merged(text) == 1:
                out.append(text)
        return frozenset(out)

    def merged(self, text: str) -> int:
        """Tokens of one pre-token by its merges: lowest rank first, then leftmost."""
        parts: list[str | None] = [self.letters[b] for b in text.encode("utf-8")]
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            count -= 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := ranks.get((a + b, parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, a + b, parts[k]))
            h = left[i]
            if h >= 0 and (r := ranks.get((parts[h], a + b))) is not None:
                heapq.heappush(heap, (r, h, parts[h], a + b))
        return count


class Counter:
    """Counts of texts, with a memo of parts and of merged pre-tokens."""

    def __init__(self, text: str):
        self.bpe = ByteBpe(text)
        self.parts = BoundedCache(CACHE_ENTRIES)
        self.rest = BoundedCache(CACHE_ENTRIES // 4)

    def pre_tokens(self, text: str) -> int:
        total, whole, rest = 0, self.bpe.whole, self.rest
        for p in self.bpe.pre.findall(text):
            if p in whole:
                total += 1
                continue
            n = rest.get(p)
            if n is None:
                n = self.bpe.merged(p)
                if len(p) <= 64:
                    rest.room()
                    rest[p] = n
            total += n
        return total

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text:
            return 0
        if self.bpe.odd.search(text) or text[0] == " " or text[-1] == " ":
            return self.pre_tokens(text)
        parts = self.parts
        first, *others = text.split(" ")
        total = self.pre_tokens(first)
        try:
            return total + sum(map(parts.__getitem__, others))
        except KeyError:
            pass
        for p in others:
            n = parts.get(p)
            if n is None:
                n = self.pre_tokens(" " + p)
                if len(p) <= 64:
                    parts.room()
                    parts[p] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.bpe.special is None or not self.bpe.special.search(text):
            return self.plain(text)
        parts = self.bpe.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """``keep`` columns plus n_bytes, n_tokens and over_limit (n_tokens > ``limit``) per row.

    Map-only: no shuffle; memory is one slice of texts and two bounded memos.
    """
    require(docs, text, *keep)
    narrow = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("t"))
    kept = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "t") + ", n_bytes long, n_tokens long"

    spec = read_tokenizer(tokenizer_path)
    shared, key = docs.sparkSession.sparkContext.broadcast(spec), zlib.crc32(spec.encode("utf-8"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_memo("token_counts", f"token_counts:{key}", lambda: Counter(shared.value))
        for batch in sliced(batches, "t"):
            texts = texts_of(batch, "t")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())],
                names=[*kept, "n_bytes", "n_tokens"],
            )

    out = narrow.mapInArrow(counted, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
