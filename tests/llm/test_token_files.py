import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripflow.llm import queries as Q
from tripflow.llm import token_files as TF
from tripflow.llm.common import read_tokenizer
from tripflow.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def ids_of(lib, text):
    return [*lib.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 2049, 70_000, 300_000])
def test_block_round_trip_whole_and_from_each_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.int64)
    values, counts = np.unique(ids, return_counts=True)
    freq = TF.frequency_table(dict(zip(values.tolist(), counts.tolist())), 50_000)
    assert freq.sum() == 1 << TF.SCALE_BITS and (freq[values] > 0).all()
    c = TF.Coder(freq)
    for every in (1024, TF.CHECKPOINT_TOKENS):
        b = c.encode(ids, every=every)
        assert (c.decode(b, n, every=every) == ids).all()
        for i, (lo, hi) in enumerate(c.parts(n, b["lanes"], every)):
            assert (c.decode(b, n, i, every) == ids[lo:hi]).all()


def test_frequencies_of_many_rare_ids_sum_to_the_scale():
    freq = TF.frequency_table({i: 1 for i in range(60_000)} | {70_000: 10**12}, 70_001)
    assert freq.sum() == 1 << TF.SCALE_BITS and freq[:60_000].min() == 1


def test_joined_crc():
    a, b = b"some bytes", b"and more of them" * 99
    assert TF.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert TF.crc32_joined(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def encoded(e, texts, end=()):
    ids, n = e.encode(pa.array(texts, pa.string()), list(end))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_words_get_the_librarys_ids(lib):
    odd = ["", " ", "Don't STOP 's", "a\x1cb c\x85d e", "<|ENDOFTEXT|> x<|endoftext|>y Q<|StartOfText|>", "naïve É é ́x", "日本 123, 4...!!##", "ΑΣ Σ", "a\tb\n c", "THE the The. the, (the)", "x" * 3000]
    e = TF.WordEncoder(read_tokenizer(PATH), "<u4")
    assert e.by_word
    for _ in range(2):
        for t, got in zip(odd, encoded(e, odd)):
            assert got == ids_of(lib, t)[:-1], t


def test_end_ids_and_empty_texts():
    e = TF.WordEncoder(read_tokenizer(PATH), "<u2")
    assert encoded(e, ["", "", " "], [7, 8]) == [[7, 8]] * 3
    one = encoded(e, ["word"])[0]
    assert encoded(e, ["", "word word", "word"], [7]) == [[7], one * 2 + [7], one + [7]]
    assert e.encode(pa.array([], pa.string()), [1])[0].tolist() == []
    whole = pa.array(["x", "word", "", "word"], pa.string())
    assert e.encode(whole.slice(1), [1])[1].tolist() == [len(one) + 1, 1, len(one) + 1]


def test_long_words_are_not_remembered(lib):
    """Unbroken words of 4 KB (Base64 lines, scripts without blanks) leave the memo as it is."""
    rng = np.random.default_rng(0)
    texts = ["".join(map(chr, rng.integers(97, 123, 4096))) + "," for _ in range(50)] + ["日本語" * 500]
    e = TF.WordEncoder(read_tokenizer(PATH), "<u4")
    assert encoded(e, texts) == [ids_of(lib, t)[:-1] for t in texts]
    assert max(map(len, e.memo), default=0) <= TF.MEMO_CHARS and len(e.memo) < 10


def test_a_full_memo_starts_again(lib, monkeypatch):
    monkeypatch.setattr(TF, "WORD_MEMO", 40)
    e = TF.WordEncoder(read_tokenizer(PATH), "<u4")
    texts = [" ".join(f"w{chr(97 + (i * 7 + j) % 26)}{chr(97 + j)}" for j in range(12)) for i in range(30)]
    for t in texts:
        assert encoded(e, [t]) == [ids_of(lib, t)[:-1]]
    assert len(e.memo) <= 80


def test_every_latin_character_and_more(lib):
    e = TF.WordEncoder(read_tokenizer(PATH), "<u4")
    points = [*range(1, 0x400), *range(0x1E00, 0x2100), 0x212A, 0x212B, 0xFB01, 0x1F600]
    texts = [t for p in points for c in [chr(p)] for t in (f"a{c}b.", f"{c}", f"A{c}\u0301 x{c}{c}'s", f"e {c}1,")]
    for t, got, want in zip(texts, encoded(e, texts), lib.encode_batch_fast(texts, add_special_tokens=False)):
        assert got == want.ids, repr(t)


def test_table(spark, lib, monkeypatch):
    monkeypatch.setattr(TF, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(TF, "LANES", 16)
    monkeypatch.setattr(TF, "CHECKPOINT_TOKENS", 64)
    monkeypatch.setattr(TF.Coder.encode, "__defaults__", (16, 64))
    monkeypatch.setattr(TF.Coder.parts, "__defaults__", (64,))
    rows = [(7, "the long text " * 400, 1), (None, "no id", 2), (3, "Twice", 3), (3, "Twice", 3), (3, None, 4), (1, "", 5), (9, "end <|endoftext|>", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = TF.read_token_files(spark, TF.token_files(df, PATH, 1)).collect()
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 1, 3, 3, 3, 7, 9]
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order)])[:-1].tolist()
    want = sorted((r[0] or -1, len(i := ids_of(lib, r[1])), crc(i)) for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want


def test_every_part_is_a_row_and_decodes_alone(spark, lib):
    text = "some words of a text that fills more than one part of a block " * 30_000
    path = TF.token_files(spark.createDataFrame([(1, text), (2, "and more")], "doc_id long, text string"), PATH, 1)
    blocks = spark.read.schema(TF.BLOCK_SCHEMA).parquet(f"{path}/blocks")
    parts = TF.parts_of(blocks).collect()
    assert len(parts) > blocks.count() and sum(p.size for p in parts) == blocks.groupBy().sum("n_tokens").first()[0]
    coder = TF.Coder(TF.load_table(spark, path))
    whole = [*ids_of(lib, text), *ids_of(lib, "and more")]
    base = dict(zip(sorted({p.shard for p in parts}), np.cumsum([0, *(sum(p.size for p in parts if p.shard == s) for s in sorted({p.shard for p in parts}))])))
    for p in parts:
        got = coder.decode_from(np.frombuffer(p.states, "<u8"), np.frombuffer(p.words, "<u4"), p.size)
        lo = base[p.shard] + p.first_token + p.skipped
        assert got.tolist() == whole[lo : lo + p.size]
    # Words of other parts are not with it.
    assert sum(len(p.words) for p in parts) == sum(len(r.words) for r in blocks.collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert TF.read_token_files(spark, TF.token_files(df, PATH, 1)).collect() == []


def test_corrupt_block_is_found(spark):
    from pyspark.sql import functions as F

    path = TF.token_files(spark.createDataFrame([(1, "some words here " * 50)], "doc_id long, text string"), PATH, 1)
    bad = scratch_path(spark, "bad")
    spark.read.parquet(f"{path}/table").write.parquet(f"{bad}/table")
    spark.read.parquet(f"{path}/blocks").withColumn("part_crc32", F.transform("part_crc32", lambda c: c + 1)).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        TF.read_token_files(spark, bad).collect()


def test_query_over_the_whole_table(spark, lib):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in Q.op5_token_files(spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(lib, r.text)
        g = got.pop(r.doc_id)
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not got
