"""Quality scores by nearest-neighbour voting on latent-semantic vectors.

Terms of a text: trigrams of its characters, folded to classes (upper-case and
other letters, digits, blanks, line ends, each ASCII punctuation character,
anything else) and hashed to ``TERMS`` columns; trigrams of its lower-cased characters as they are,
hashed to ``WORDS`` columns, so that texts of one shape and unlike words differ; and four repetition terms: words equal to the word before
them, words seen before within a stretch of 64 words, lines seen before, and
the share of text in such lines. Weights are square roots of frequencies times
the term's inverse document frequency. The latent space is the leading
``dims`` right singular vectors of the weighted matrix of a bounded sample of
labelled texts (``max_training`` rows, drawn by a hash of the id).

The sample's vectors and labels (``max_training`` x ``dims`` numbers) are
broadcast. Every document is projected, its exact cosines with all of them are
computed in blocks as matrix products, and its ``neighbours`` nearest vote
with their similarity as weight. Scoring is map-only.

Defined results: null text counts as empty; a text without terms, or without a
neighbour of positive similarity, scores the share of label 1 in the sample;
labels of ids that no document has, and null labels, are not learned from and do not count
towards ``max_training``; a doc_id with
several labels or rows trains with each; of equally near neighbours those with
the smaller id hash (then id, label, terms) vote; without any labels every score is
0.5; an empty table gives no rows; a column ``score`` in the table, in any case, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, quoted, require, sliced, texts_of, with_fields, worker_memo

TERMS = 1024
WORDS = 1024
WORD_WEIGHT = 0.5  # of the word trigrams against the others
REPEATS = 4
DIMS = 48
NEIGHBOURS = 15
MAX_TRAINING = 6000
STRETCH = 64
_BLOCK = 256
_SLICE = 1 << 20


def _classes() -> np.ndarray:
    """Code point -> class; ASCII punctuation keeps its own."""
    out = np.full(0x110000, 1, np.int64)
    for p in range(0x110000):
        c = chr(p)
        if c.isupper():
            out[p] = 2
        elif c.isalpha():
            out[p] = 3
        elif c.isdigit():
            out[p] = 4
        elif c == "\n":
            out[p] = 5
        elif c.isspace():
            out[p] = 6
        elif p < 128:
            out[p] = p
    return out


def _lower() -> np.ndarray:
    """Code point -> its lower case, where that is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for p in range(0x110000):
        if len(low := chr(p).lower()) == 1:
            out[p] = ord(low)
    return out


def _repeats(text: str) -> tuple[float, float, float, float]:
    words = text.split()
    n = len(words)
    if not n:
        return 0.0, 0.0, 0.0, 0.0
    same = sum(map(eq, words, words[1:])) / n
    again = 1 - sum(len(set(words[i : i + STRETCH])) for i in range(0, n, STRETCH)) / n
    lines = [x for x in text.split("\n") if x]
    seen: set[str] = set()
    twice = size = 0
    for x in lines:
        if x in seen:
            twice, size = twice + 1, size + len(x)
        seen.add(x)
    return same, again, twice / len(lines), size / len(text)


def term_matrix(texts: list[str]) -> np.ndarray:
    """Square roots of term frequencies, one row per text. Memory is bounded by slices of the texts."""
    folds = [worker_memo("quality", "character_classes", _classes), worker_memo("quality", "lower_case", _lower)]
    sizes, ends = (TERMS, WORDS), (TERMS, TERMS + WORDS)
    out = np.zeros((len(texts), TERMS + WORDS + REPEATS), np.float32)
    counts = [np.zeros((len(texts), n), np.int64) for n in sizes]
    pieces = [(i, t[s : s + _SLICE + 2]) for i, t in enumerate(texts) for s in range(0, max(1, len(t) - 2), _SLICE)]
    k = 0
    while k < len(pieces):
        group, size = [], 0
        while k < len(pieces) and (not group or size + len(pieces[k][1]) <= _SLICE):
            group.append(pieces[k])
            size += len(pieces[k][1])
            k += 1
        points = np.frombuffer("".join(t for _, t in group).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(points) < 3:
            continue
        piece = np.repeat(np.arange(len(group)), [len(t) for _, t in group])
        inside = piece[2:] == piece[:-2]
        at = piece[2:][inside]
        for fold, n, base, total in zip(folds, sizes, (131, 1 << 21), counts):
            code = fold[points].astype(np.uint64)
            gram = (code[:-2] * np.uint64(base) + code[1:-1]) * np.uint64(base) + code[2:]
            term = (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - n.bit_length() + 1)).astype(np.int64)[inside]
            found = np.bincount(at * n + term, minlength=len(group) * n).reshape(len(group), n)
            np.add.at(total, [i for i, _ in group], found)
    for n, end, total, weight in zip(sizes, ends, counts, (1, WORD_WEIGHT)):
        out[:, end - n : end] = weight * np.sqrt(total / np.maximum(1, total.sum(axis=1, keepdims=True)))
    out[:, ends[-1] :] = np.sqrt(np.array([_repeats(t) for t in texts], np.float32).reshape(-1, REPEATS))
    return out


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest of each row, ascending; of equal ones the first."""
    last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
    more = cosine > last
    same = cosine == last
    room = k - more.sum(axis=1, keepdims=True)
    return np.nonzero(more | (same & (np.cumsum(same, axis=1) <= room)))[1].reshape(len(cosine), k)


class Votes:
    """The latent space and the labelled vectors in it."""

    def __init__(self, x: np.ndarray, labels: list[int], dims: int = DIMS, neighbours: int = NEIGHBOURS):
        """``x``: rows of ``term_matrix``, one per label."""
        self.neighbours = neighbours
        self.labels = np.array(labels, np.float32)
        self.prior = float(self.labels.mean()) if labels else 0.5
        seen = (x > 0).sum(axis=0)
        self.idf = np.where(seen > 0, np.log((1 + len(x)) / (1 + seen)) + 1, 0).astype(np.float32)
        # Right singular vectors, by the eigenvectors of the terms' Gram matrix.
        gram = np.zeros((x.shape[1], x.shape[1]))
        for s in range(0, len(x), _BLOCK):
            y = (x[s : s + _BLOCK] * self.idf).astype(np.float64)
            gram += y.T @ y
        _, vectors = np.linalg.eigh(gram)
        del gram
        self.basis = np.ascontiguousarray(vectors[:, ::-1][:, :dims]).astype(np.float32)
        self.known = self.latent(x)

    def latent(self, terms: np.ndarray) -> np.ndarray:
        v = (terms * self.idf) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.known):
            return out
        k = min(self.neighbours, len(self.known))
        for s in range(0, len(texts), _BLOCK):
            cosine = self.latent(term_matrix(texts[s : s + _BLOCK])) @ self.known.T
            near = nearest(cosine, k)
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            out[s : s + _BLOCK] = np.where(total > 1e-6, vote / np.maximum(total, 1e-6), self.prior)
        return np.clip(out, 0, 1)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_training: int = MAX_TRAINING, dims: int = DIMS, neighbours: int = NEIGHBOURS) -> Votes:
    """Fit on the labelled rows of ``docs``: at most ``max_training``, those with the smallest id hashes."""
    require(docs, doc_id, text)
    require(labels, doc_id, label)
    order = F.xxhash64("id")
    chosen = labels.select(quoted(doc_id).cast("long").alias("id"), quoted(label).cast("int").alias("y")).filter("id is not null and y is not null")
    rows = docs.select(quoted(doc_id).cast("long").alias("id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("t"))
    # Ids alone are joined first: only labels of documents that are there count.
    chosen = chosen.join(rows.select("id").distinct(), "id", "left_semi").orderBy(order, "id", "y").limit(max_training)

    def termed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "t", 4 << 20):
            terms = term_matrix(texts_of(batch, "t")).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array([r.tobytes() for r in terms], pa.binary())], names=["id", "y", "x"])

    # Texts become terms on the executors; one row of terms per label comes back.
    termed_rows = rows.join(F.broadcast(chosen), "id").select("id", "y", "t").mapInArrow(termed, "id long, y int, x binary")
    found = termed_rows.orderBy(order, "id", "y", "x").limit(max_training).collect()
    x = np.empty((len(found), TERMS + WORDS + REPEATS), np.float32)
    ys = []
    for i, r in enumerate(found):
        x[i], found[i] = np.frombuffer(r.x, "<f4"), None
        ys.append(r.y)
    return Votes(x, ys, dims, neighbours)


def score(docs: DataFrame, votes: Votes, text: str = "text") -> DataFrame:
    """``docs`` with score. Map-only."""
    require(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(votes)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, 4 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(texts_of(batch, text)))], names=[*batch.schema.names, "score"])

    return map_arrow(docs, scored, with_fields(docs, "score double"))
