import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tripflow.llm import pieces as P
from tripflow.llm import queries as Q

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a", " a", "a ", "hello  world   again", "tab\tand\nline\n\nend\n", "<s> </s> <unk> <0x41>", "a▁b ▁", "🙂🙂 日本語 テスト ñandú ÀÉ", "\x00\x01 \x7f", "x" * 700, "ab" * 400, "aaab" * 300 + " " * 100 + "b",
    "the " * 500, "1234567890 3.14", "́́ é", "ﬁ ² Ⅷ", "\U0010ffff ﻿x", "antidisestablishmentarianism" * 20,
]


@pytest.fixture(scope="module")
def bpe():
    return P.Segmenter(P.load_model(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def unigram():
    """The same vocabulary as a unigram model: the library's own Viterbi is the answer."""
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    rng = random.Random(2)
    for p in proto.pieces:
        if p.type == 1:
            p.score = -rng.uniform(2, 12) - 0.2 * len(p.piece) ** 0.5
    lib = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    return P.Segmenter(P.model_of(proto, lib)), lib


def texts(n=300):
    rng = random.Random(4)
    out = list(ODD)
    for _ in range(n):
        letters = rng.choice(["ab ", "the quickbrn ", "aeiounst", "é日🙂a ", "01 ", "▁ x\n"])
        out.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 300))))
    return out


def test_compatible_pieces_are_those_that_merging_ends_with(bpe):
    g, _ = bpe
    rng = random.Random(9)
    names = list(g.pieces) + list("aeé日")
    near = [p for p in names if p.isascii() and len(p) < 6]
    for k in range(60_000):
        a, b = (rng.choice(near), rng.choice(near)) if k % 3 else (rng.choice(names), rng.choice(names))
        alone = all(len(p) == 1 or g.merged(p) == [p] for p in (a, b))
        if alone:
            assert g.compatible(a, b) == (g.merged(a + b) == [a, b]), (a, b)
    for n in range(1, 17):  # runs of marks all have one score
        for m in range(1, 17):
            a, b = "▁" * n, "▁" * m
            if a in g.pieces and b in g.pieces and g.merged(a) == [a] and g.merged(b) == [b]:
                assert g.compatible(a, b) == (g.merged(a + b) == [a, b])


def test_bpe_ids_are_the_librarys(bpe):
    g, lib = bpe
    for t in texts() * 2:
        assert g.encode(t).tolist() == lib.encode(t), repr(t[:60])


def test_without_the_word_memo_the_stream_commits_the_same(bpe):
    g, lib = bpe
    for t in texts(60):
        got = [i for run in g.stream("▁" + t.replace(" ", "▁")) for i in g.ids_of(run)] if t else []
        assert got == lib.encode(t), repr(t[:60])


def test_prose_is_committed_within_a_small_window(bpe):
    g, _ = bpe
    runs = list(g.stream("▁it▁was▁the▁best▁of▁times" * 400))
    assert len(runs) > 100 and max(sum(map(len, r)) for r in runs) <= 2 * P._LOOK + 16


def test_unigram_ids_are_the_librarys(unigram):
    g, lib = unigram
    assert g.model["unigram"]
    for t in texts(200):
        if len(t) < 400:  # the library adds float32 scores over the whole text
            assert g.encode(t).tolist() == lib.encode(t), repr(t[:60])


def test_decoding(bpe):
    g, lib = bpe
    for t in texts():
        ids = lib.encode(t)
        assert g.decode(ids) == lib.decode(ids) == t.replace("▁", " ")
    for ids in ([], [1, 2], [1, 29871], [300, 1, 300], [0, 300]):
        assert g.decode(ids) == lib.decode(ids), ids
    with pytest.raises(KeyError):
        g.decode([10**6])


def test_table(spark, bpe):
    _, lib = bpe
    rows = [(i, t, i, "x") for i, t in enumerate(ODD)] + [(None, None, 1, "x"), (3, "a", 2, "y"), (3, "a", 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces int, same string")
    got = P.round_trip(df, PATH).collect()

    def row(k, t):
        ids, dec = lib.encode(t or ""), (t or "").replace("▁", " ")
        return (k, len((t or "").encode()), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256(dec.encode()).hexdigest(), True)

    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr(row(k, t)) for k, t, *_ in rows)
    enc = P.encode_pieces(df, PATH)
    assert enc.columns == [*df.columns, "piece_ids"] and enc.count() == len(rows)
    with pytest.raises(ValueError, match="already"):
        P.encode_pieces(enc, PATH)
    assert P.round_trip(df.limit(0), PATH).collect() == []


def test_query_over_the_whole_table(spark, bpe):
    _, lib = bpe
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in Q.op2_pieces(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        g = got.pop(r.doc_id)
        ids = lib.encode(r.text)
        assert g.same and g.n_pieces == len(ids) and g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert not got
