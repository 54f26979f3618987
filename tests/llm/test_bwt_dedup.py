import hashlib
import random

import numpy as np
import pytest

from tripflow.llm import bwt_dedup as B
from tripflow.llm import queries as Q


def brute(rows, length=50):
    """(doc_id, text) rows: n_bytes, n_removed, n_spans, kept digest of each; null ids last."""
    big = 1 << 62
    low = {}
    raw = [(big if k is None else k, (t or "").encode()) for k, t in rows]
    for k, b in raw:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if low.get(w, big + 1) > k:
                low[w] = k
    out = []
    for k, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if low[b[i : i + length]] < k:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def planted(n=60, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinsé") for _ in range(rng.randint(1, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(rng.randint(8, 30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(s)), rng.randint(0, len(s))))
            parts += [s[a:b] if rng.random() < 0.5 else s, prose(rng.randint(0, 5))]
        rows.append((rng.randint(0, 2 * n), "".join(parts)))
    return rows + [(None, shared[0]), (None, shared[0] + prose(30)), (5, ""), (6, None), (7, "x" * 300), (8, "x" * 120), (9, "ab" * 200), (3, "ab" * 99), rows[0], rows[0], (40, "\x00" * 60), (41, "y" + "\x00" * 60), (900, shared[1][:49])]


@pytest.mark.parametrize("length", [4, 10, 50])
def test_intervals_of_merged_shards_are_the_repeated_strings(length):
    rng = np.random.default_rng(length)
    for trial in range(20):
        shards = [rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 200)).astype(np.uint8) for _ in range(rng.integers(1, 5))]
        at, group = B.merged_intervals(shards, length)
        base = np.cumsum([0, *map(len, shards)])
        strings = {}
        for s, o in zip(shards, base):
            wrapped = np.resize(s, len(s) + length * (1 + length // len(s))).tobytes()
            for i in range(len(s)):
                strings.setdefault(wrapped[i : i + length], set()).add(int(o) + i)
        got = {}
        for p, g in zip(at.tolist(), group.tolist()):
            got.setdefault(g, set()).add(p)
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in strings.values() if len(v) > 1), trial


def test_every_window_is_in_one_segment_with_its_anchor(monkeypatch):
    docs = [(t or "").encode() for _, t in planted()]
    text = np.frombuffer(b"".join(docs), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    anchors = {}
    for step in (B._POSITIONS, 37):  # segments may be cut between blocks, anchors stay
        monkeypatch.setattr(B, "_POSITIONS", step)
        doc, begin, windows, anchor = B.segments_of(text, off)
        seen = set()
        for d, b, n, a in zip(doc, begin, windows, anchor):
            for i in range(b, b + n):
                assert i not in seen and off[d] <= i and i + 50 <= off[d + 1]
                seen.add(i)
                assert anchors.setdefault(text[i : i + 50].tobytes(), a) == a
        assert len(seen) == sum(max(0, len(d) - 49) for d in docs)


@pytest.mark.parametrize("small", [False, True])
def test_table(spark, monkeypatch, small):
    if small:  # many chunks, buckets, shards and merges
        for k, v in {"CHUNK_BYTES": 700, "BUCKET_BYTES": 500, "SHARD": 300, "MERGE": 2000}.items():
            monkeypatch.setattr(B, k, v)
    rows = planted()
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, chunk int").repartition(5)
    got = B.remove_repeats(df).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got))) == sorted(repr((k, *w)) for (k, _), w in zip(rows, brute(rows)))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)
    assert sum(r.n_removed for r in got) > 1000


def test_a_crowded_anchor_is_dealt_by_its_windows(spark, monkeypatch):
    """A passage in every document, with other bytes around it each time: no merge holds the segments of all."""
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = "it was the best of times, it was the worst of times, it was the age of wisdom"
    rows = [(k, noise(60) + passage + noise(60)) for k in range(400)] + [(500 + k, rng.choice("xy") + passage + "z" * 60) for k in range(50)]
    whole, most = B._merge_windows, 100 * (B.LENGTH + B.WIDTH)

    def bounded(text, begin, size, ids, out, part):
        if size.sum() > most:
            raise ValueError(f"merge of {size.sum()} bytes")
        whole(text, begin, size, ids, out, part)

    for k, v in {"CHUNK_BYTES": 3000, "BUCKET_BYTES": 1000, "MERGE": 1000, "CROWD": 40, "_merge_windows": bounded}.items():
        monkeypatch.setattr(B, k, v, raising=False)
    got = B.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((k, *w) for (k, _), w in zip(rows, brute(rows)))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in B.remove_repeats(df).collect()) == [(1, 0), (2, 0)]


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {k: w for (k, _), w in zip(rows, brute(rows))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in Q.op6_bwt_dedup(spark, sf).collect()}
    assert got == want
