"""op12: statistics and verdicts against a plain version; the order against its definition."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import quality_rules as Q
from tripflow.llm.quality_rules import Rule, Rows, cascade, greedy, judge, order_rules


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    hit = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def plain_kept(text):
    s = plain(text)
    n = s["n_words"]
    bad = n < 20 or 100 * s["n_repeat_words"] > 30 * n or 2 * s["word_chars"] < 5 * n or s["word_chars"] > 10 * n
    return not (bad or 10 * s["n_symbols"] > n or 2 * s["n_dup_lines"] > s["n_lines"])


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n\x0b\x0c\r ", "one", "\x1c\x85   word", "é ü 漢字 😀 " * 12, "a b c d e f g h " * 2, "a b c d e f g h i", "x\n\nx\n x\nx", "#*$%&|<> " * 30]
    for _ in range(120):
        vocab = [chr(97 + k) * rng.randint(1, 9) for k in range(rng.choice([2, 3, 26]))]
        out.append("".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\n", "\t", " # "]) for _ in range(rng.randint(0, 90))))
    return out


def test_statistics_and_verdicts_equal_the_plain_version(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    stats = tuple(Q.STATS)
    got = {r.doc_id: r for r in cascade(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), report=stats).collect()}
    for i, t in rows:
        assert {s: got[i][s] for s in stats} == plain(t), t
        assert got[i].kept == plain_kept(t) and (got[i].failed is None) == got[i].kept
    assert {got[i].kept for i, _ in rows} == {True, False}


def test_pieces_and_slices_change_nothing(monkeypatch):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "be", "c"]) for _ in range(700)) + "\x0b" + "unbroken" * 40
    want = plain(long)
    monkeypatch.setattr(Q, "PIECE", 50)
    every = np.arange(3)
    for name in Q.STATS:
        assert Rows([b"", long.encode(), b"x y"]).get(name, every).tolist()[1] == want[name], name


def test_a_text_of_a_million_words(spark):
    text = "same words come and come again here now " * 130_000  # over the bytes of a slice
    (row,) = cascade(spark.createDataFrame([(1, text)], "doc_id long, text string"), columns=["doc_id"], report=("n_words", "n_repeat_words")).collect()
    assert (row.n_words, row.n_repeat_words, row.kept, row.failed) == (1_040_000, 1_040_000, False, row.failed)


def test_verdicts_do_not_depend_on_the_order_and_statistics_are_skipped():
    rows = [(t or "").encode() for t in texts()]
    first, back = Rows(rows), Rows(rows)
    assert ((judge(first, Q.RULES) < 0) == (judge(back, Q.RULES[::-1]) < 0)).all()
    # few_words comes first, so a text that it rejects has no windows counted
    short = np.array([len(t.split()) < 20 for t in rows])
    assert not (first.known["n_repeat_words"] & short).any() and first.known["n_words"].all()


def test_greedy_order():
    a, b, c = (Rule(x, (s,), None) for x, s in (("a", "cheap"), ("b", "dear"), ("c", "cheap")))
    seconds = {"cheap": 1.0, "dear": 10.0}
    # b rejects most, but a costs a tenth; c is free after a, yet rejects only what a does
    assert [r.name for r in greedy([a, b, c], seconds, {0b101: 20, 0b010: 60, 0: 20})] == ["a", "b", "c"]
    assert [r.name for r in greedy([a, b, c], seconds, {0b010: 60, 0: 40})] == ["b", "a", "c"]
    assert [r.name for r in greedy([a, b, c], {}, {})] == ["a", "b", "c"]


def test_order_from_a_sample(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("a few words")).otherwise(F.repeat(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" other ")), 40)).alias("text"))
    got = order_rules(docs, sample_rows=150)
    assert sorted(r.name for r in got) == sorted(r.name for r in Q.RULES)
    assert got[-1].name != "few_words" and order_rules(docs.limit(0)) == list(Q.RULES)
    with pytest.raises(ValueError):
        order_rules(docs, [])


def test_odd_tables(spark):
    good = "plain words of a text that nothing is wrong with and which has at least as many words as are asked for here"
    docs = spark.createDataFrame([(None, good, 1), (7, good, 2), (7, good, 2), (8, None, None)], "doc_id long, text string, extra int").withColumnRenamed("extra", "a.b")
    got = cascade(docs).collect()
    assert [r.kept for r in got] == [True, True, True, False] and [r["a.b"] for r in got] == [1, 2, 2, None]
    assert cascade(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="kept"):
        cascade(docs.withColumn("Kept", F.lit(1)))
    clash = docs.withColumn("_Judged_text", F.lit(1))
    assert cascade(clash).columns[:4] == clash.columns and cascade(clash).count() == 4
