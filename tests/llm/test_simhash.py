import random

import numpy as np
import pytest
import xxhash

from tripflow.llm import queries as Q
from tripflow.llm import simhash as S
from tripflow.llm.components import components


def plain_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, bits=4):
    """Smallest reachable id per row, by union-find over all pairs."""
    n = len(fps)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits):
            parent[find(int(j))] = find(i)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            r = find(i)
            low[r] = min(low.get(r, ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


def test_fingerprints():
    for t in ["", " \n", "One", "a b c", "A b\tc D e", "é È x\xa0y z w", "same " * 70_000, None]:
        assert S.fingerprint((t or "").encode()) == plain_fingerprint(t)
    assert S.fingerprint(b"a b c d e", 5) == plain_fingerprint("a b c d e", 5)


@pytest.mark.parametrize("seed", [8, 9, 20])
def test_long_texts_count_every_shingle(seed):
    """Over two blocks of shingles, votes so close that one shingle at a block's edge decides a bit."""
    text = " ".join(str(seed * 1_000_000 + i) for i in range(131_100))
    assert S.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_every_near_pair_shares_a_home(parts):
    rng = random.Random(parts)
    code = S.Anchors(4, parts)
    for _ in range(60):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        pairs = np.array([x, y], np.uint64)
        at = [set(), set()]
        home = [set(), set()]
        for part, row, anchor, is_home in code.rows(pairs):
            for r, a, h in zip(row, anchor, is_home):
                at[r].add((part, int(a)))
                if h:
                    home[r].add((part, int(a)))
        assert home[0] & at[1] and home[1] & at[0]
        assert len(home[0]) == parts


def planted(n=300):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(n // 3)] + [0, 0]
    while len(fps) < n:  # chains of near fingerprints, some at the threshold and beyond
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.append(x)
    return fps


@pytest.mark.parametrize("parts,tile", [(3, 4096), (3, 2), (2, 4096)])
def test_links_connect_what_brute_force_connects(spark, parts, tile):
    fps = sorted(set(planted()))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    label = {r.node: r.label for r in components(S.links(nodes, 4, parts, tile)).collect()}
    assert [label.get(i, i) for i in range(len(fps))] == brute_components(fps, list(range(len(fps))))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (300, 100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 301)} | {k: 1000 for k in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_table(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today " * 30
    rows = [(5, base, 1), (3, base.upper(), 1), (9, base + "x", 2), (None, base, 3), (7, None, 4), (8, "", 5), (None, "alone here", 6), (11, "two words", 7), (11, "other text entirely", 8), (2, "two\nwords", 9), (2, "two\nwords", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = S.near_duplicates(df).collect()
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    want = sorted(zip([k for k, *_ in rows], fps, brute_components(fps, [k for k, *_ in rows])), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["fp"] for r in kept.collect())) == sorted(x for (k, _, x), w in zip(rows, brute_components(fps, [k for k, *_ in rows])) if k == w)
    assert S.near_duplicates(df.limit(0)).collect() == []


def test_one_document_of_each_component_stays(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here today "
    a, b = prose * 30, "an old house by the river where nobody had lived for many years until now " * 30
    near = lambda t: t + t.split()[0]  # noqa: E731  another shingle or none, the same fingerprint or a near one
    rows = [
        (5, a), (5, b), (3, b.upper()), (9, a.upper()),  # doc_id 5 holds two texts, one of them near a smaller id
        (None, "red " * 40), (None, "RED " * 40),  # near copies, none with an id
        (6, "blue sky " * 40), (6, "BLUE sky " * 40), (8, "Blue sky " * 40),  # near copies under one id
        (4, near(a)),
    ]
    fps = [plain_fingerprint(t) for _, t in rows]
    assert (fps[9] ^ fps[0]).bit_count() <= 4 and (fps[0] ^ fps[1]).bit_count() > 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in S.near_duplicates(df).collect()), key=repr)
    assert found == sorted(zip([k for k, _ in rows], fps, brute_components(fps, [k for k, _ in rows])), key=repr)
    kept = [(r.doc_id, r.text.lower()) for r in S.drop_near_duplicates(df).collect()]
    assert sorted(kept, key=repr) == sorted([(4, near(a)), (3, b), (None, "red " * 40), (6, "blue sky " * 40)], key=repr)


def test_unlike_texts_under_one_id_do_not_take_each_other_along(spark):
    words = [f"w{i}" for i in range(2000)]
    b = " ".join(words)
    near = next(t for t in (" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(0, 2000, 50)) if 0 < (plain_fingerprint(t) ^ plain_fingerprint(b)).bit_count() <= 4)
    rows = [(5, "the quick brown fox jumps over the lazy dog " * 30), (5, b), (3, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in S.drop_near_duplicates(df).collect()) == sorted([rows[0], rows[2]])


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r.doc_id for r in rows]))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in Q.op10_simhash_dedup(spark, sf).collect()} == want
