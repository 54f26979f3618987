"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1 (drawn from its code
point). An n-gram's vector *binds* its letters: the elementwise product of
their vectors, each permuted (rotated) by its distance to the n-gram's end. A
text's vector *bundles* (sums) the vectors of all its n-grams, and a language's
prototype bundles the normalised vectors of its training texts. A text belongs
to the language whose prototype has the largest cosine with it.

Letters are lower-cased; every run of other characters is one space, and a
text has a space before and after it. Texts of any length have the vector of
all their n-grams: long ones are folded piece by piece, and each piece starts with the last
letters of the one before it, so that every n-gram is counted once.

Training uses rows with a language that are not held out: of their different
(doc_id, language, text) the ``max_training`` with the smallest hashes, each
text once. Partial prototypes are summed per (language, dimension) with map-side
combining; the driver holds languages x dimensions numbers, and refuses more
than ``MAX_LANGUAGES``. Prediction is map-only.

Defined results: null text and text without letters are ``und`` with score 0;
if nothing can be learned, every text is ``und``; equal cosines go to the
language first in order; an empty table gives no rows; a result column whose
name the table has, in any case, is an error that names it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, map_arrow, quoted, require, sliced, texts_of, with_fields, worker_memo

DIMS = 1024
GRAM = 3
SEED = 20_11
MAX_TRAINING = 40_000
MAX_LANGUAGES = 1000
UNKNOWN = "und"
_FIXED_POINT = 1 << 20
_SLICE = 1 << 20


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 2 by 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for p in range(0x110000):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            out[p] = ord(low) if len(low) == 1 and low.isalpha() else p
    return out


class Profiles:
    """Vectors of letters, n-grams and texts."""

    def __init__(self, dims: int = DIMS, gram: int = GRAM, seed: int = SEED):
        self.dims, self.gram, self.seed = dims, gram, seed
        self.fold = worker_memo("language", "letter_table", _letter_table)
        self.letters = BoundedCache(8192)

    def letter(self, point: int) -> np.ndarray:
        v = self.letters.get(point)
        if v is None:
            self.letters.room()
            v = self.letters[point] = np.random.default_rng([self.seed, point]).integers(0, 2, self.dims, np.int8) * np.int8(2) - np.int8(1)
        return v

    def _folded(self, text: str, before: int) -> np.ndarray:
        """Letters (0: a blank, one for each run) of the characters that follow letter ``before``."""
        code = self.fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = code > 0
        if len(keep):
            keep[0] |= before > 0
            keep[1:] |= code[:-1] > 0  # the first of each run of blanks
        return code[keep]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(vectors as rows, whether a text has a letter)."""
        joined = "".join([f" {t} " for t in texts])
        code = self.fold[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
        keep = code > 0
        keep[:1] = True
        keep[1:] |= (code[:-1] > 0) | (owner[1:] != owner[:-1])  # the first of each run of blanks
        code, owner = code[keep], owner[keep]
        has = np.zeros(len(texts), bool)
        has[owner[code > 0]] = True
        return self.bundle(code, owner, len(texts)), has

    def long_text(self, text: str, piece: int) -> tuple[np.ndarray, bool]:
        """As ``texts`` for one text, ``piece`` characters at a time."""
        vector, has = np.zeros(self.dims, np.float64), False
        carried, last = np.zeros(0, np.uint32), 1
        for s in range(0, len(text) + 2, piece):
            # The characters of the text with a blank before and after it.
            part = (" " if s == 0 else "") + text[max(s - 1, 0) : s + piece - 1] + (" " if s <= len(text) + 1 < s + piece else "")
            new = self._folded(part, last)
            code = np.concatenate([carried, new])
            last = int(code[-1]) if len(code) else last
            has |= bool((new > 0).any())
            vector += self.bundle(code, np.zeros(len(code), np.int64), 1)[0]
            carried = code[max(0, len(code) - self.gram + 1) :]
        return vector.astype(np.float32), has

    def bundle(self, code: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
        """Sums of the vectors of the n-grams with a letter that lie in one text each."""
        vectors = np.zeros((n_texts, self.dims), np.float32)
        if not (code > 0).any():
            return vectors
        alphabet, small = np.unique(code, return_inverse=True)
        a = len(alphabet)
        n = self.gram
        gram = np.zeros(len(code) - n + 1 if len(code) >= n else 0, np.int64)
        for i in range(n):
            gram = gram * a + small[i : len(gram) + i]
        last = owner[n - 1 :][: len(gram)]
        inside = owner[: len(gram)] == last
        lettered = np.zeros(len(gram), bool)
        for i in range(n):
            lettered |= code[i : len(gram) + i] > 0
        use = inside & lettered
        gram, last = gram[use], last[use]
        if a**n <= 1 << 22:
            seen = np.bincount(gram, minlength=1) > 0
            grams = np.flatnonzero(seen)
            which = (np.cumsum(seen) - 1)[gram]
        else:
            grams, which = np.unique(gram, return_inverse=True)
        basis = np.stack([np.stack([np.roll(self.letter(int(p)), n - 1 - i) for p in alphabet]) for i in range(n)])
        step = 4096
        order = np.argsort(which // step, kind="stable")
        cuts = np.searchsorted((which // step)[order], np.arange(-(-len(grams) // step) + 1))
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            at = grams[k * step : (k + 1) * step]
            bound = np.ones((len(at), self.dims), np.int8)
            rest = at.copy()
            for i in range(n - 1, -1, -1):
                bound *= basis[i][rest % a]
                rest //= a
            pick = order[lo:hi]
            counts = np.bincount(last[pick] * len(at) + which[pick] - k * step, minlength=n_texts * len(at)).reshape(n_texts, len(at))
            vectors += counts.astype(np.float32) @ bound.astype(np.float32)
        return vectors


def _in_pieces(profiles: Profiles, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``Profiles.texts``, over ``_SLICE`` characters or so at a time."""
    vectors = np.zeros((len(texts), profiles.dims), np.float32)
    has = np.zeros(len(texts), bool)
    s = 0
    while s < len(texts):
        if len(texts[s]) > _SLICE:
            vectors[s], has[s] = profiles.long_text(texts[s], _SLICE)
            s += 1
            continue
        e, size = s, 0
        while e < len(texts) and (e == s or size + len(texts[e]) <= _SLICE):
            size += len(texts[e])
            e += 1
        vectors[s:e], has[s:e] = profiles.texts(texts[s:e])
        s = e
    return vectors, has


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_training: int = MAX_TRAINING, dims: int = DIMS) -> dict[str, np.ndarray]:
    """Prototypes by language from the rows that have one."""
    require(rows, text, lang, doc_id)
    own = [quoted(c).cast("string") for c in (lang, text, doc_id)]
    labelled = rows.select(own[0].alias("lang"), own[1].alias("t"), F.xxhash64(own[2], own[0], own[1]).alias("h")).filter(F.col("lang").isNotNull() & F.col("t").isNotNull())
    about = labelled.agg(F.approx_count_distinct("h")).first()[0]
    if 2 * about > max_training:
        # Twice the share of the hash range that holds max_training rows, then the smallest of those.
        top = -(1 << 63) + (1 << 64) * 2 * max_training // about
        few = labelled.filter(F.col("h") < top) if top < 1 << 63 else labelled
        last = few.select("h").distinct().orderBy("h").limit(max_training).agg(F.max("h")).first()[0]
        labelled = labelled.filter(F.col("h") <= last) if last is not None else labelled.limit(0)
    once = labelled.groupBy("lang", F.xxhash64("t").alias("x"), F.length("t").alias("n")).agg(F.min("t").alias("t"))

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dims)
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches, "t", _SLICE):
            vectors, has = _in_pieces(profiles, texts_of(batch, "t"))
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.rint(vectors / np.maximum(norm, 1e-9) * _FIXED_POINT).astype(np.int64)
            langs = batch.column("lang").to_pylist()
            for name in {x for x, h in zip(langs, has) if h}:
                at = [i for i, x in enumerate(langs) if x == name and has[i]]
                sums[name] = sums.get(name, 0) + unit[at].sum(axis=0)
            if len(sums) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dims), pa.array(np.arange(dims, dtype=np.int32)), pa.array(v)], names=["lang", "dim", "value"])

    summed = once.select("lang", "t").mapInArrow(bundled, "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages x dimensions, both bounded
        out.setdefault(r.lang, np.zeros(dims))[r.dim] = r.value
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", lang: str = "lang_pred", score: str = "score", lettered: str | None = None) -> DataFrame:
    """``docs`` with columns ``lang`` and ``score`` (cosine, not below 0). Map-only.

    With ``lettered``, also a column of that name: does the text have a letter?
    """
    require(docs, text)
    names = list(prototypes)
    dims = len(next(iter(prototypes.values()))) if names else DIMS
    shared = docs.sparkSession.sparkContext.broadcast(np.array([prototypes[k] for k in names], np.float32).reshape(len(names), dims))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = worker_memo("language", f"profiles:{dims}", lambda: Profiles(dims))
        for batch in sliced(batches, text, _SLICE):
            vectors, has = _in_pieces(profiles, texts_of(batch, text))
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            if names:
                cosine = (vectors / np.maximum(norm, 1e-9)) @ shared.value.T
                best = cosine.argmax(axis=1)
                near = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(np.float64)
            known = has & (norm[:, 0] > 0) & bool(names)
            found = [names[best[i]] if k else UNKNOWN for i, k in enumerate(known)]
            scores = np.where(known, near, 0.0) if names else np.zeros(len(found))
            more = {lang: pa.array(found, pa.string()), score: pa.array(scores)} | ({lettered: pa.array(has)} if lettered else {})
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])

    return map_arrow(docs, predicted, with_fields(docs, f"{lang} string, {score} double" + (f", {lettered} boolean" if lettered else "")))
