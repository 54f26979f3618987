import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripflow.llm.common import read_tokenizer
from tripflow.llm.token_counts import Counter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a   b", "x\n \ny", "a \nb", "a\n\n b", "don't we'll 's", "naïve  café x y",
    "<|endoftext|>", "a<|endoftext|>b <|endoftext|> c", "<|endoftext|", "日本語 テスト 123 4,567", "é ́x", "a\x1cb \x1f c\x85d", "word " * 500,
    "x" * 5000, "ab" * 3000, "\t\ttabs\r\n", "🙂 🙂🙂", "１２ ² ⅷ",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library_on_odd_texts(lib):
    c = Counter(read_tokenizer(PATH))
    for t in ODD + ODD:
        assert c.count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t[:40])


def test_every_code_point_is_split_as_the_library_splits_it(lib):
    c = Counter(read_tokenizer(PATH))
    points = [p for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    wrong = []
    for s in range(0, len(points), 4000):
        texts = [f"a{chr(p)}b {chr(p)}1{chr(p)} " for p in points[s : s + 4000]]
        for p, t, e in zip(points[s:], texts, lib.encode_batch_fast(texts, add_special_tokens=False)):
            if c.count(t) != len(e.ids):
                wrong.append(p)
    assert not wrong, [hex(p) for p in wrong[:20]]


def test_whole_tokens_encode_alone(lib):
    whole = sorted(Counter(read_tokenizer(PATH)).bpe.whole)
    assert len(whole) > 40_000
    for s in range(0, len(whole), 5000):
        assert all(len(e.ids) == 1 for e in lib.encode_batch_fast(whole[s : s + 5000], add_special_tokens=False))


def test_table(spark, lib):
    rows = [(i, t, "extra", i) for i, t in enumerate(ODD)] + [(None, None, "x", 1), (3, " a", "dup", 2), (3, " a", "dup", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, t int")
    got = token_counts(df, PATH, limit=100).collect()
    want = sorted((r[0] if r[0] is not None else -1, len((r[1] or "").encode()), n := len(lib.encode(r[1] or "", add_special_tokens=False).ids), n > 100) for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts(df.limit(0), PATH).collect() == []
