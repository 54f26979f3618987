import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tripflow.llm import language as L
from tripflow.llm import queries as Q


def plain_vector(p, text):
    """Bind and bundle one n-gram at a time."""
    out, s = np.zeros(p.dims), " "
    for c in text or "":
        low = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha():
            s += low
        elif s[-1] != " ":
            s += " "
    s = s if s[-1] == " " else s + " "
    for gram, n in Counter(s[i : i + 3] for i in range(len(s) - 2)).items():
        if gram.strip():
            v = np.ones(p.dims)
            for i, c in enumerate(gram):
                v *= np.roll(p.letter(0 if c == " " else ord(c)), 2 - i)
            out += n * v
    return out


TEXTS = ["", "a", "  ", "the cat", "The  CAT!", "été à la plage", "日本語 テスト", "12 34", "İstanbul ß ǅ", "x" * 40, "one\ntwo\n\nthree ", "...end", "q-r", "ein Haus " * 300]


def test_vectors_bind_and_bundle_as_written():
    p = L.Profiles()
    vectors, has = p.texts(TEXTS)
    for t, v, h in zip(TEXTS, vectors, has):
        assert h == any(c.isalpha() for c in t), t
        assert np.allclose(v, plain_vector(p, t)), t
    alone = [p.texts([t])[0][0] for t in TEXTS]
    assert np.allclose(alone, vectors)


def test_long_texts_have_the_vector_of_all_their_grams(monkeypatch):
    p = L.Profiles()
    texts = ["the quick brown fox. " * 500, "unbroken" * 900, "日本語テスト" * 700, " . " * 800 + "x" + " " * 900, "." * 999, "ab " * 66 + "!" * 300 + "c", "a b"]
    whole, has = p.texts(texts)
    for size in (1, 2, 7, 200, 201, 1000):
        monkeypatch.setattr(L, "_SLICE", size)
        v, h = L._in_pieces(p, texts if size > 6 else [t[:150] for t in texts])
        want = (whole, has) if size > 6 else p.texts([t[:150] for t in texts])
        assert h.tolist() == want[1].tolist() and (v == want[0]).all(), size


def test_a_text_over_a_slice_without_a_gap():
    p = L.Profiles()
    rng = np.random.default_rng(0)
    text = "".join(map(chr, rng.integers(97, 123, 1_200_000)))
    assert len(text) > L._SLICE
    v, has = L._in_pieces(p, ["a b", text])
    assert has.all() and (v[1] == p.texts([text])[0][0]).all()


def test_odd_rows(spark):
    rows = [(1, "le chat est la", "fr", 0), (2, "the cat is here", "en", 0), (3, None, "en", 0), (4, "123 !", "fr", 0), (5, "the cat", None, 0), (None, "est la chat", "fr", 0), (2, "the cat is here", "en", 0), (7, "", "xx", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, dim int")
    p = L.learn(df)
    assert sorted(p) == ["en", "fr"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred) for r in L.predict(df, p).collect())
    assert got == [(-1, "fr"), (1, "fr"), (2, "en"), (2, "en"), (3, "und"), (4, "und"), (5, "en"), (7, "und")]
    assert all(0 <= r.score <= 1 for r in L.predict(df, p).collect())
    assert {(r.lang_pred, r.score) for r in L.predict(df, L.learn(df.limit(0))).collect()} == {("und", 0.0)}
    assert L.predict(df.limit(0), p).collect() == []


def test_held_out_rows_are_neither_learned_from_nor_wrong(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = Q.op4_language_id(spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_the_training_bound_is_kept(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the word "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    assert list(L.learn(df, max_training=50)) == ["en"]


def test_the_sample_is_kept_where_ids_repeat_and_is_never_empty(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    whole = L._in_pieces

    def counted(profiles, texts):
        seen.add(len(texts))
        return whole(profiles, texts)

    monkeypatch.setattr(L, "_in_pieces", counted)
    words = F.concat(F.lit("the word "), F.conv(F.col("id"), 10, 36))
    one_id = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"))
    for most in (100, 1):  # a third of the rows has no id; and a small share of many rows
        before = seen.value
        assert list(L.learn(one_id, max_training=most)) == ["en"]
        assert seen.value - before == most
    copies = one_id.unionByName(spark.range(6000).select(F.lit(7).alias("doc_id"), F.lit("one text").alias("text"), F.lit("en").alias("lang")))
    before = seen.value
    L.learn(copies, max_training=100)
    assert seen.value - before == 100
