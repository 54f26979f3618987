"""SentencePiece encoding and decoding with a streaming Viterbi search.

The search keeps, for every position of the text, the length of the last piece
of the best segmentation up to there (a backpointer). A new piece can only
start within the last ``max piece length`` positions, so scores and states are
needed for that window alone. Whenever the backpointer paths of all positions
of the window meet in one boundary, the pieces up to it are committed and
forgotten, so a text of any length streams through.

What "best" means depends on the model:

- unigram models: the largest sum of piece scores (longer piece first on ties);
- BPE models: the pieces that greedy merging (best score, then leftmost) ends
  with. A sum of scores does not give these. But a segmentation is the merge
  result exactly if every two neighbouring pieces are the merge result of their
  joined text, and each prefix has one such segmentation; so a path may be
  extended by a piece that is *compatible* with the piece before it, and the
  same window, backpointers and commits apply.

Characters outside the vocabulary become byte pieces. All paths meet between
two characters that no piece spans (a word and the space after it, mostly a
letter and a punctuation mark); the stretches between such boundaries are
memoised.

Only models with the identity normalizer are taken (others raise). The model
file is read by the driver and broadcast (``MAX_MODEL_BYTES``); tasks need no
file and no library.

Defined results: null and empty texts have no pieces; decoding a null list
gives an empty text; the mark U+2581 in a text decodes to a space, as the
library's does; unknown ids raise; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, map_arrow, quoted, require, sliced, texts_of, with_fields, worker_memo

MARK = "▁"
MAX_MODEL_BYTES = 64 << 20
WORD_MEMO = 1_000_000  # words a worker remembers, about 0.4 KB each with what belongs to them
PAIR_MEMO = 300_000
_LOOK = 64  # positions between two looks for a common boundary


def load_model(path: str) -> dict:
    """Vocabulary of a SentencePiece file as plain values."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    with open(path, "rb") as f:
        raw = f.read(MAX_MODEL_BYTES + 1)
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    proto = pb.ModelProto()
    proto.ParseFromString(raw)
    return model_of(proto, SentencePieceProcessor(model_proto=raw))


def model_of(proto, library) -> dict:
    norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normalizer are handled")
    if kind not in (1, 2) or not proto.trainer_spec.byte_fallback:
        raise ValueError("only unigram and BPE models with byte fallback are handled")
    ids = range(library.get_piece_size())
    plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
    return {
        "unigram": kind == 1,
        "prefix": norm.add_dummy_prefix,
        "pieces": {library.id_to_piece(i): (i, library.get_score(i)) for i in plain},
        "bytes": {int(library.id_to_piece(i)[3:5], 16): i for i in ids if library.is_byte(i)},
        "silent": [i for i in ids if library.is_control(i)],
        "unknown": [i for i in ids if library.is_unknown(i)],
    }


class Memo(dict):
    """Results by text, made when first asked for; starts again when full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, text):
        value = self.make(text)
        if len(text) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[text] = value
        return value


class Segmenter:
    """Streaming Viterbi over one model."""

    def __init__(self, model: dict, word_memo: int = WORD_MEMO):
        self.model, self.pieces = model, model["pieces"]
        self.longest = max(map(len, self.pieces), default=1)
        self.floor = min((s for _, s in self.pieces.values()), default=0.0) - 10.0  # score of a character outside the vocabulary
        self.joint = frozenset(p[i : i + 2] for p in self.pieces for i in range(len(p) - 1))
        # Text is cut before each space that follows another character and around line ends, if no piece spans these.
        lead = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        stop = " " + ("\n" if not any("\n" in p for p in self.pieces) else "")
        self.cut = re.compile(f" +[^{stop}]*|[^{stop}]+" + ("|\n" if "\n" in stop else "")) if lead else None
        self.words = Memo(self._word, word_memo)
        self.runs = Memo(self._run, word_memo * 2 // 3)
        self.fits = BoundedCache(PAIR_MEMO)
        if model["unigram"]:
            self.lattice = {p: s for p, (_, s) in self.pieces.items()}
        else:
            self._learn_merges()
            self.lattice = {p: 0.0 for p in self.pieces if len(p) == 1 or p in self.halves}
        # 1: a piece, 2: the start of a longer one, 3: both.
        self.edges = dict.fromkeys((p[:n] for p in self.lattice for n in range(1, len(p))), 2)
        self.edges |= {p: self.edges.get(p, 0) | 1 for p in self.lattice}
        self.table = self._decoding()
        self.silent = frozenset(model["silent"])
        self.marked = frozenset(i for p, (i, _) in self.pieces.items() if p.startswith(MARK))  # lose the text's own first mark

    # --- merges of short strings (BPE) ------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """The pieces that greedy merging of a short text ends with."""
        return self._merging(text)[0]

    def _merging(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """(the pieces, the two parts of the last merge)."""
        parts, pieces, last = list(text), self.pieces, None
        while True:
            best = None
            for i in range(len(parts) - 1):
                hit = pieces.get(parts[i] + parts[i + 1])
                if hit is not None and (best is None or hit[1] > best[0]):
                    best = (hit[1], i)
            if best is None:
                return parts, last
            last = (parts[best[1]], parts[best[1] + 1])
            parts[best[1] : best[1] + 2] = [last[0] + last[1]]

    def _learn_merges(self) -> None:
        """Of every piece: when it is merged, from which parts, and whether scores tell the order."""
        self.turn = {p: -s for p, (_, s) in self.pieces.items() if len(p) > 1}
        self.halves: dict[str, tuple[str, str]] = {}  # only of pieces that merging their own text ends in
        self.odd: set[str] = set()  # pieces with a part that is not merged before them
        for p in sorted(self.turn, key=len):
            parts, last = self._merging(p)
            if parts == [p]:
                self.halves[p] = last
                if any(x in self.odd or self.turn.get(x, -1.0) >= self.turn[p] for x in last):
                    self.odd.add(p)

    def compatible(self, before: str, piece: str) -> bool:
        """Whether merging ``before`` + ``piece`` ends in just these two (in ``piece`` alone, if nothing is before).

        Both must be characters or pieces that merging their own text ends in.
        """
        if not before:
            return True
        key = (before, piece)
        ok = self.fits.get(key)
        if ok is None:
            self.fits.room()
            ok = self.fits[key] = self._compatible(before, piece)
        return ok

    def _compatible(self, a: str, b: str) -> bool:
        if a in self.odd or b in self.odd:
            return self.merged(a + b) == [a, b]
        # Undo the merges at the boundary, the later one first: a piece across it
        # that would have been merged before that one shows that merging ends otherwise.
        turn, halves, limit = self.turn, self.halves, float("inf")
        while True:
            across = turn.get(a + b)
            if across is not None and across < limit:
                return False
            left, right = turn.get(a, -1.0), turn.get(b, -1.0)
            if left > right:
                limit, a = left, halves[a][1]
            elif right < 0:
                return True  # two characters
            else:
                limit, b = right + 0.5, halves[b][0]  # on a tie the one to the left goes first

    # --- the search ---------------------------------------------------------------------
    def stream(self, text: str) -> Iterator[list[str]]:
        """Committed runs of pieces of a text, in order."""
        longest, unigram, n = self.longest, self.model["unigram"], len(text)
        edge, known, compatible = self.edges.get, self.fits.get, self.compatible
        base, before = 0, ""  # committed boundary and the piece that ends there
        back = [0] * (longest + 1)  # back[i - base]: length of the last piece of the path to i; 0: none yet
        score = [0.0] * (longest + 1)
        for j in range(n):
            here = j - base
            last = text[j - back[here] : j] if here else before
            if here + longest >= len(back):
                back += [0] * _LOOK
                score += [0.0] * _LOOK
            for k in range(j + 1, n + 1):
                piece = text[j:k]
                kind = edge(piece, 0)
                if kind & 1 or k == j + 1:
                    at = k - base
                    if unigram:
                        s = score[here] + self.lattice.get(piece, self.floor)
                        if not back[at] or s > score[at]:
                            back[at], score[at] = k - j, s
                    elif not back[at]:
                        ok = known((last, piece))
                        if ok or ok is None and compatible(last, piece):
                            back[at] = k - j
                if kind < 2:
                    break
            i = j + 1
            if not back[i - base]:
                raise AssertionError("a prefix without a compatible last piece")
            if i == n or i % _LOOK == 0:
                # Paths of all positions where a later piece may start (at the end: one path).
                open_ = set(range(max(base, i - longest + 1), i + 1)) if i < n else {n}
                while len(open_) > 1:
                    top = max(open_)
                    open_.remove(top)
                    open_.add(top - back[top - base])
                meet = open_.pop()
                if meet > base:
                    run, at = [], meet
                    while at > base:
                        run.append(text[at - back[at - base] : at])
                        at -= back[at - base]
                    run.reverse()
                    before = run[-1]
                    zero = score[meet - base]
                    back, score = [0] + back[meet - base + 1 :], [s - zero for s in score[meet - base :]]
                    base = meet
                    yield run

    def ids_of(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            hit = self.pieces.get(p)
            if hit is not None:
                out.append(hit[0])
            else:
                out += [self.model["bytes"][b] for b in p.encode("utf-8")]
        return out

    def _run(self, run: str) -> bytes:
        return b"".join([np.array(self.ids_of(part), np.int32).tobytes() for part in self.stream(run)])

    def _word(self, word: str) -> bytes:
        """Ids of a word: its runs between characters that no piece spans, one after another."""
        marked = word.replace(" ", MARK)
        cuts = [0, *[i for i in range(1, len(marked)) if marked[i - 1 : i + 1] not in self.joint], len(marked)]
        runs = self.runs
        return b"".join([runs[marked[a:b]] for a, b in zip(cuts, cuts[1:])])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as int32."""
        if not text:
            return np.empty(0, np.int32)
        spaced = (" " if self.model["prefix"] else "") + text.replace(MARK, " ")
        words = [spaced] if self.cut is None else self.cut.findall(spaced)
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)

    # --- decoding ---------------------------------------------------------------------------
    def _decoding(self) -> dict[int, bytes]:
        out = {i: p.replace(MARK, " ").encode("utf-8") for p, (i, _) in self.pieces.items()}
        out |= {i: bytes([b]) for b, i in self.model["bytes"].items()}
        return out | {i: b"" for i in self.model["silent"]} | {i: " ⁇ ".encode() for i in self.model["unknown"]}

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        raw = b"".join(map(self.table.__getitem__, ids))
        first = next((i for i in ids if i not in self.silent), None)
        if self.model["prefix"] and first in self.marked and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _segmenter(shared, word_memo: int = WORD_MEMO) -> Segmenter:
    model = shared.value
    key = zlib.crc32(repr((model["unigram"], sorted(model["pieces"].items()))).encode())
    return worker_memo("pieces", f"segmenter:{key}:{word_memo}", lambda: Segmenter(model, word_memo))


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids", check: str | None = None, word_memo: int = WORD_MEMO) -> DataFrame:
    """``docs`` with an array column ``ids``; with ``check``, also a boolean
    column of that name: do the ids decode to the text again? Map-only.

    ``word_memo`` words are remembered per worker (memory against time).
    """
    require(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    more = [ids] + ([check] if check else [])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared, word_memo)
        for batch in sliced(batches, text, 4 << 20):
            texts = texts_of(batch, text)
            rows = [segmenter.encode(t) for t in texts]
            columns = [_lists(rows)]
            if check:
                columns.append(pa.array([segmenter.decode(r) == t.replace(MARK, " ") for r, t in zip(rows, texts)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *more])

    return map_arrow(docs, encoded, with_fields(docs, f"{ids} array<int>" + (f", {check} boolean" if check else "")))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows])))


def decode_pieces(rows: DataFrame, model_path: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``rows`` with a string column ``text`` decoded from the array column ``ids``. Map-only."""
    require(rows, ids)
    shared = rows.sparkSession.sparkContext.broadcast(load_model(model_path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared)
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                texts = [segmenter.decode([] if x is None else x) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text])

    return map_arrow(rows, decoded, with_fields(rows, f"{text} string"))


def round_trip(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encoded and decoded again in one pass: doc_id, n_bytes, n_pieces, ids_crc32, decoded_sha256, same."""
    require(docs, doc_id, text)
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    kind = "doc_id " + narrow.schema["doc_id"].dataType.simpleString() + ", n_bytes bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, same boolean"

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(shared)
        for batch in sliced(batches, "t", 4 << 20):
            out: list[tuple] = []
            for t in texts_of(batch, "t"):
                ids = segmenter.encode(t)
                back = segmenter.decode(ids)
                out.append((len(t.encode("utf-8")), len(ids), zlib.crc32(ids.astype("<i4").tobytes()), hashlib.sha256(back.encode("utf-8")).hexdigest(), back == t.replace(MARK, " ")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]], names=["doc_id", "n_bytes", "n_pieces", "ids_crc32", "decoded_sha256", "same"])

    return narrow.mapInArrow(both, kind)
