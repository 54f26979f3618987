"""Quality rules as a short-circuit cascade.

A rule rejects a text by a few statistics of it, and a text stays if no rule
rejects it. The statistics cost unlike amounts (counting symbols is one pass over
the bytes, finding repeated word windows is many), so the order matters:

1. ``order_rules`` runs every rule on a sample: seconds a row of each statistic,
   and how many sampled rows each combination of rules rejects. Both are summed
   in the tasks, so the driver gets one row for each combination.
2. The order is greedy: next comes the rule that rejects most of the sampled rows
   still left per second of statistics not yet computed by then.
3. ``cascade`` works in that order, in slices of rows: a statistic is computed
   only for rows that a rule still has to judge, and a rejected row is done.

Whether a text stays does not depend on the order, only the time does (and
``failed``, the name of the rule that came first).

Words are runs of ``[^\\x20\\x09-\\x0D]``. Statistics are exact over whole texts:
repeated windows of words are found by naming pairs, pairs of pairs and so on by
their number among the distinct ones, never by hash.

Defined results: a null text has no words, lines or symbols; repeated rows and
null ids are judged each by itself; an empty table returns no rows (and rules in
their given order); columns keep their names, and a result column whose name the table has,
in any case, is an error that names it. A text costs its task some 60 bytes a
word beside its own bytes; texts are never cut.
"""

from __future__ import annotations

import itertools
import re
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, quoted, require, sliced, utf8_of, with_fields

# The characters of the contract.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
BLANK = re.compile(b"[" + BLANKS + b"]")
WINDOW = 8  # words of a window that must not repeat
PIECE = 1 << 20  # bytes of a text split into words at once
SAMPLE_ROWS = 2_000


class Rows:
    """Texts of a slice, with their statistics computed on demand, row by row once."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.known: dict[str, np.ndarray] = {}
        self.values: dict[str, np.ndarray] = {}
        self.seconds: dict[str, float] = defaultdict(float)

    def get(self, name: str, rows: np.ndarray) -> np.ndarray:
        """Values of a statistic for some rows (by number, ascending)."""
        if name not in self.values:
            self.values[name], self.known[name] = np.zeros(len(self.texts), np.int64), np.zeros(len(self.texts), bool)
        new = rows[~self.known[name][rows]]
        if len(new):
            began = time.perf_counter()
            self.values[name][new] = STATS[name]([self.texts[i] for i in new])
            self.known[name][new] = True
            self.seconds[name] += time.perf_counter() - began
        return self.values[name][rows]


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes, cut only before a blank."""
    at = 0
    while len(text) - at > PIECE:
        cut = BLANK.search(text, at + PIECE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def n_words(texts: list[bytes]) -> list[int]:
    return [sum(len(p.split()) for p in _pieces(t)) for t in texts]


def word_chars(texts: list[bytes]) -> list[int]:
    """Code points that are no blanks."""
    inner = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
    return [len(t.translate(None, BLANKS + inner)) for t in texts]


def n_symbols(texts: list[bytes]) -> list[int]:
    return [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def n_lines(texts: list[bytes]) -> list[int]:
    """Lines with a word."""
    return [len(_lines(t)) for t in texts]


def n_dup_lines(texts: list[bytes]) -> list[int]:
    """Lines with a word that equal an earlier line."""
    return [len(lines) - len(set(lines)) for lines in map(_lines, texts)]


def n_repeat_words(texts: list[bytes]) -> np.ndarray:
    """Words in windows of ``WINDOW`` words that the text has twice or more."""
    number = defaultdict(itertools.count().__next__)
    parts, sizes = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        for p in _pieces(t):
            words = p.split()
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            sizes[i] += len(words)
    del number
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if len(ids) < WINDOW:
        return np.zeros(len(texts), np.int64)
    step = 1
    while step < WINDOW:  # names of windows of twice the length, from pairs of names
        ids = pd.factorize(ids[:-step] * (int(ids.max()) + 1) + ids[step:])[0].astype(np.int64)
        step *= 2
    doc = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    start = np.flatnonzero(np.arange(len(ids)) + WINDOW <= ends[doc[: len(ids)]])  # windows within one text
    key = pd.factorize(doc[start] * (int(ids.max()) + 1) + ids[start])[0]
    twice = start[np.bincount(key, minlength=1)[key] > 1] if len(key) else start
    mark = np.zeros(len(doc) + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(mark[:-1]) > 0)])
    return covered[ends] - covered[ends - sizes]


STATS: dict[str, Callable[[list[bytes]], Sequence[int]]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)
}


@dataclass(frozen=True)
class Rule:
    """``rejects(*values of needs)`` is true for the rows that the rule rejects (arrays of int64)."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
MORE_RULES = (
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (2 * c < 5 * n) | (c > 10 * n)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
)
RULES = BASE_RULES + MORE_RULES


def judge(rows: Rows, rules: Sequence[Rule]) -> np.ndarray:
    """Number of the rule that rejects each row first, -1 where none does."""
    found, left = np.full(len(rows.texts), -1), np.arange(len(rows.texts))
    for k, rule in enumerate(rules):
        if not len(left):
            break
        bad = rule.rejects(*(rows.get(s, left) for s in rule.needs))
        found[left[bad]] = k
        left = left[~bad]
    return found


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules, by rejections per second of new statistics on a sample of about ``sample_rows`` rows."""
    rules = list(rules)
    if not 0 < len(rules) < 32:
        raise ValueError("1 to 31 rules")
    names = sorted({s for r in rules for s in r.needs})
    n = docs.count()
    if not n:
        return rules
    picked = docs.select(quoted(text).cast("string").alias("text"))
    if n > sample_rows:
        picked = picked.sample(sample_rows / n, seed=7)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows, every = Rows(utf8_of(batch, "text")), np.arange(batch.num_rows)
            mask = np.zeros(batch.num_rows, np.int64)
            for k, rule in enumerate(rules):
                mask |= rule.rejects(*(rows.get(s, every) for s in rule.needs)).astype(np.int64) << k
            masks, counts = np.unique(mask, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "what": [*("mask" for _ in masks), *("cost" for _ in names)],
                    "number": [*masks.tolist(), *range(len(names))],
                    "value": [*map(float, counts), *(rows.seconds[s] for s in names)],
                }
            )

    sums = picked.mapInArrow(measure, "what string, number long, value double").groupBy("what", "number").agg(F.sum("value").alias("value"))
    got = {(r.what, r.number): r.value for r in sums.collect()}  # a row for each statistic and each combination of rules that occurs
    seconds = {s: got.get(("cost", i), 0.0) for i, s in enumerate(names)}
    return greedy(rules, seconds, {m: c for (what, m), c in got.items() if what == "mask"})


def greedy(rules: Sequence[Rule], seconds: dict[str, float], masks: dict[int, float]) -> list[Rule]:
    """Most rejections per second first, of the rows left and the statistics not yet computed.

    ``seconds``: of each statistic over the sample; ``masks``: rows by the set of
    rules that reject them (bit k: rule k). Equal rates: the given order.
    """
    total = sum(masks.values()) or 1.0
    left, done, out = dict(masks), set(), []
    rest = list(enumerate(rules))
    while rest:
        share = max(sum(left.values()) / total, 1e-9)  # a statistic costs time only for rows that are left

        def rate(item: tuple[int, Rule]) -> float:
            k, rule = item
            cost = sum(seconds.get(s, 0.0) for s in rule.needs if s not in done) * share
            return sum(c for m, c in left.items() if m >> k & 1) / (cost + 1e-9)

        best = max(rest, key=rate)  # the first of equal ones
        rest.remove(best)
        out.append(best[1])
        done |= {*best[1].needs}
        left = {m: c for m, c in left.items() if not m >> best[0] & 1}
    return out


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", columns: Sequence[str] | None = None, report: Sequence[str] = ()) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with ``kept``, ``failed`` (the rule that rejected; null if kept) and the statistics of ``report``.

    ``rules``: in the order to be run; ``order_rules(docs)`` by default. Statistics
    to report are computed for all rows, others only as far as the cascade needs them.
    """
    require(docs, text)
    rules = list(order_rules(docs, text=text) if rules is None else rules)
    columns = list(docs.columns if columns is None else columns)
    body = docs.select(*map(quoted, columns))
    schema = with_fields(body, ", ".join(["kept boolean", "failed string", *(f"{s} long" for s in report)]))
    hidden = free_name(body, "_judged_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([r.name for r in rules])
        for batch in sliced(batches, hidden):
            rows = Rows(utf8_of(batch, hidden))
            found = judge(rows, rules)
            every = np.arange(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(columns))),
                    pa.array(found < 0),
                    names.take(pa.array(found, mask=found < 0)),
                    *(pa.array(rows.get(s, every)) for s in report),
                ],
                names=schema.names,
            )

    return map_arrow(docs.select(*map(quoted, columns), quoted(text).cast("string").alias(hidden)), run, schema)
