import random
import re

import pytest

from tripflow.llm import contamination as C

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=13):
    """docs: texts; items: (id, text) -> (n_words, n_hit, sorted items) of each text."""
    pats = {}
    for key, t in items:
        w = words(t)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            pats.setdefault(m, {}).setdefault(tuple(w[i : i + m]), set()).add("" if key is None else str(key))
    out = []
    for t in docs:
        w = words(t)
        hit, found = set(), set()
        for m, ps in pats.items():
            for i in range(len(w) - m + 1):
                if (k := ps.get(tuple(w[i : i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    found |= k
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_same_as_brute_force_on_small_vocabularies():
    rng = random.Random(5)
    for trial in range(30):
        vocab = ["a", "B", "c1", "é", "dd"][: rng.randint(1, 5)]
        text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ".", " ,"]) for _ in range(n))
        window = rng.choice([1, 2, 3, 5, 13])
        items = [(i, text(rng.randint(0, 20))) for i in range(rng.randint(0, 12))]
        docs = [text(rng.choice([0, 1, 3, 12, 13, 40, 1500])) for _ in range(10)]
        m = C.WuManber([(str(k), C.words_of(t.encode())) for k, t in items], window)
        flags, off, found = m.hits([C.words_of(t.encode()) for t in docs])
        got = [(int(off[i + 1] - off[i]), int(flags[off[i] : off[i + 1]].sum()), sorted({m.items[x] for x in found[i]})) for i in range(len(docs))]
        assert got == brute(docs, items, window), trial


@pytest.mark.parametrize("block_bytes", [1, C.BLOCK_BYTES])
def test_table(spark, block_bytes):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long, 0), (2, "Short Item", 0), (None, "x y z", 0), (4, None, 0), (5, "...", 0), (1, long, 0)]
    docs = [(1, None, 0), (2, "", 1), (None, long.upper(), 2), (4, "a short, ITEM here " + "q " * 60, 3), (4, "a short, ITEM here " + "q " * 60, 3), (5, "w0 w1 w2", 4), (6, ("z " * 30000) + long + " tail", 5), (7, "x y z", 6)]
    d = spark.createDataFrame(docs, "doc_id long, text string, items int")
    b = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    got = C.contamination(d, b, block_bytes=block_bytes).collect()
    want = brute([t for _, t, _ in docs], [(k, t) for k, t, _ in items])
    assert sorted(((r["items"], r["_contamination"].n_words, r["_contamination"].n_hit, r["_contamination"]["items"]) for r in got), key=repr) == sorted(((x, *w) for (_, _, x), w in zip(docs, want)), key=repr)
    kept = C.drop_contaminated(d, b, block_bytes=block_bytes)
    assert kept.columns == d.columns
    assert sorted(r["items"] for r in kept.collect()) == [x for (_, _, x), w in zip(docs, want) if not (w[1] and 20 * w[1] >= w[0])]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [r["_contamination"].n_hit for r in C.contamination(d, b).collect()] == [0]
    assert C.contamination(d.limit(0), b).collect() == []
