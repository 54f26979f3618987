import zlib

import numpy as np

from tripflow.llm import quality as K
from tripflow.llm import queries as Q

GOOD = [f"The {w} was seen near the old house, and nobody minded it much." for w in "cat dog bird horse cow fox hen duck owl bee".split()]
BAD = [f"BUY {w}!!! NOW!!! CHEAP $$$ {w}!!! {w}!!!" for w in "PILLS CARS GOLD SOAP SHOES TEA PENS INK RUGS HATS".split()]


def test_votes_are_those_of_brute_force():
    v = K.Votes(K.term_matrix(GOOD + BAD), [1] * 10 + [0] * 10, dims=8, neighbours=5)
    texts = ["The mule was seen near the barn, and nobody cared.", "SELL!!! LAMPS!!! $$$", "Lamp SALE. The house!", "", "a"]
    x = K.term_matrix(texts)
    for t, row, got in zip(texts, x, v.score(texts)):
        q = (row * v.idf) @ v.basis
        cos = [float(q @ k) / max(1e-9, float(np.linalg.norm(q))) for k in v.known]
        near = sorted(range(20), key=lambda i: -cos[i])[:5]
        w = [max(cos[i], 0) for i in near]
        want = sum(a * v.labels[i] for a, i in zip(w, near)) / sum(w) if sum(w) > 1e-6 else v.prior
        assert abs(got - want) < 1e-4, t
    assert v.score(texts)[0] > 0.9 and v.score(texts)[1] < 0.1 and v.score(texts)[3] == 0.5


def test_terms_of_long_texts_do_not_depend_on_slices(monkeypatch):
    texts = ["ab c1! " * 60, "", "x", "Zz\n" * 50]
    whole = K.term_matrix(texts)
    monkeypatch.setattr(K, "_SLICE", 10)
    assert np.allclose(K.term_matrix(texts), whole)
    assert np.allclose(whole[3, K.TERMS + K.WORDS :], np.sqrt([49 / 50, 49 / 50, 49 / 50, 98 / 150]))


def test_texts_of_one_shape_differ_by_their_words():
    a, b = K.term_matrix(["The red cat ran off, and it was fun.", "Our old dog sat out, but he has ate."])
    assert np.allclose(a[: K.TERMS], b[: K.TERMS]) and not np.allclose(a[K.TERMS : K.TERMS + K.WORDS], b[K.TERMS : K.TERMS + K.WORDS])
    # One shape throughout: only the words tell.
    good = [f"the {w} can see the {x}" for w in ("cat", "dog", "cow", "hen") for x in ("sun", "sea", "sky")]
    bad = [f"xqz {w} jvk xzq jqk {x}" for w in ("zzq", "qqj", "vvk", "kkx") for x in ("jjx", "xkq", "zvj")]
    v = K.Votes(K.term_matrix(good + bad), [1] * 12 + [0] * 12, dims=8, neighbours=5)
    got = v.score(["the fox can see the bay", "xqz qkj jvk xzq jqk zqx"])
    assert got[0] > 0.9 and got[1] < 0.1


def test_equally_near_neighbours_vote_in_order():
    cosine = np.array([[0.5, 0.9, 0.5, 0.5], [0.1, 0.1, 0.1, 0.1], [0.2, 0.3, 0.4, 0.5]])
    assert K.nearest(cosine, 2).tolist() == [[0, 1], [0, 1], [2, 3]]
    assert K.nearest(cosine, 4).tolist() == [[0, 1, 2, 3]] * 3


def test_labels_without_documents_take_no_room(spark):
    docs = spark.createDataFrame([(7919 * i, t) for i, t in enumerate((GOOD + BAD) * 5)], "doc_id long, text string")
    labels = spark.range(200_000).selectExpr("id * 7919 % 1000003 as doc_id", "1 as quality")
    assert len(K.learn(docs, labels, max_training=300).labels) == 100
    assert len(K.learn(docs, labels, max_training=30).labels) == 30


def test_odd_tables(spark):
    rows = [(i, t, 0.5, i) for i, t in enumerate(GOOD + BAD)] + [(None, None, 0.1, 1), (30, "", 0.1, 1), (0, GOOD[0], 0.1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y double, id int")
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(20)] + [(99, 1), (None, 0), (5, None), (3, 1)], "doc_id long, quality int")
    v = K.learn(docs, labels)
    assert len(v.labels) == 22  # id 0 has two rows, id 3 two labels
    got = K.score(docs, v).collect()
    assert len(got) == len(rows) and all((r.score > 0.7) == (r.doc_id < 10) for r in got if r.doc_id is not None and r.doc_id < 20)
    assert len(K.learn(docs, labels, max_training=7).labels) == 7
    none = K.learn(docs, labels.limit(0))
    assert {r.score for r in K.score(docs, none).collect()} == {0.5}
    assert K.score(docs.limit(0), v).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = Q.op7_quality(spark, sf).collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.93
