"""op13: manifests against a plain Merkle tree; ranks against sorting."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import merkle as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DDL = "doc_id long, text string, lang string, source string, n_chars int"


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of each row."""
    rows = [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]
    for r in rows:
        r["leaf"] = H([part(r[c]) for c in FIELDS])
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        low = r["text"] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
        r["now"] = H([part(low if c == "text" else r[c]) for c in FIELDS]) if hit else r["leaf"]

    def build(nodes, proofs):
        """Root of ``nodes``; ``proofs[k]`` gets (place, siblings) per level of node k."""
        under = [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            for i in range(len(nodes)):
                run = nodes[i - i % 8 : i - i % 8 + 8]
                for k in under[i]:
                    proofs[k].append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
            under = [sum(under[i : i + 8], []) for i in range(0, len(under), 8)]
            nodes = [H(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0]

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups, subs = [], []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        proofs = [[] for _ in own]
        subs.append(build([r["leaf"] for r in own], proofs))
        groups.append((own, proofs))
    tops = [[] for _ in subs]
    root = build(subs, tops)
    out = []
    for (own, proofs), sub, top in zip(groups, subs, tops):
        for r, proof in zip(own, proofs):
            at = r["now"]
            for place, others in proof + top:
                at = H([*others[:place], at, *others[place:]])
            out.append((r["doc_id"], r["leaf"], sub, root, H([d for _, others in proof + top for d in others]), at, at == root))
    return out


def found(docs):
    return [tuple(r) for r in M.manifest(docs, FIELDS, group="lang", tampered={"text": M.ascii_lower(F.col("text"))}).collect()]


def rows_of(n, ids, seed=0, langs=("en", "de", None, "fr", "é", "Z")):
    rng = random.Random(seed)
    return [(ids(rng, i), rng.choice([None, "", "Some Text", "text %d" % rng.randint(0, 9), "ÄÖ é"]), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, 0, -5])) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        rows_of(700, lambda g, i: i),  # gapless
        rows_of(300, lambda g, i: g.choice([None, 5, 5, 6, -1, -(2**63), 2**63 - 1, 4096])),  # few ids, many rows each
        rows_of(200, lambda g, i: g.randint(-(2**62), 2**62)),  # far apart, below zero
        rows_of(150, lambda g, i: 7, langs=("one",)),  # one id holds all rows
        [(1, "T", "en", "s", 1)],
        [(1, "T", "en", "s", 1), (1, "T", "en", "s", 1), (2, "T", "de", "s", 1)],
        [(i, "Text", f"lang{i % 70:02d}", None, i) for i in range(90)],  # the top tree has levels too
        [(None, None, None, None, None)] * 20,
    ],
)
def test_equals_the_plain_tree(spark, rows):
    docs = spark.createDataFrame(rows, DDL).repartition(4)
    assert sorted(map(repr, found(docs))) == sorted(map(repr, plain(rows)))


def test_trees_over_several_passes(spark, monkeypatch):
    """Blocks of 8 leaves: many passes up and down."""
    monkeypatch.setattr(M, "DEEP", 1)
    rows = rows_of(600, lambda g, i: i // 2 if i < 40 else i, langs=("en", "en", "en", "de", None))
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    assert sorted(map(repr, found(docs))) == sorted(map(repr, plain(rows)))


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame(rows_of(30, lambda g, i: i), DDL)
    assert found(docs.limit(0)) == []
    more = docs.withColumns({"leaf": F.lit(1), "G": F.lit(2), "a.b": F.lit(3), "group": F.lit(4)})
    assert sorted(map(repr, found(more))) == sorted(map(repr, found(docs)))


def test_tampering_shows_and_nothing_else_does(spark):
    docs = spark.createDataFrame([(i, "Text" if i % 2 else "text", "en", "s", 4) for i in range(100)], DDL)
    for r in M.manifest(docs, FIELDS, group="lang", tampered={"text": M.ascii_lower(F.col("text"))}).collect():
        assert r.verified == (not (r.id % 2 and zlib.crc32(str(r.id).encode()) % 3 == 0))
    assert all(r.verified for r in M.manifest(docs, FIELDS, group="lang").collect())


def test_long_text(spark):
    rows = [(1, "Aé" * 3_000_000, "en", None, None), (2, "b", "en", None, None)]
    assert sorted(found(spark.createDataFrame(rows, DDL))) == sorted(plain(rows))


@pytest.mark.parametrize("n", [0, 1, 200, 300, 4096])
def test_containers_hold_ranks(n):
    rng = np.random.default_rng(n)
    offsets = np.sort(rng.choice(4096, n, replace=False))
    data = M.pack(offsets)
    assert data[:1] == (b"L" if n < 256 else b"B") and M.offsets_of(M.unpack(data)).tolist() == offsets.tolist()
    some = offsets[::7]
    ranks = M.Ranks(data, some.astype("<u2").tobytes(), np.full(len(some), 3, "<i8").tobytes())
    want = [int((offsets < o).sum() + 3 * (some < o).sum()) for o in range(4096)]
    assert ranks.of(np.arange(4096)).tolist() == want


def test_merged_containers_count_repeats():
    a, b = np.array([1, 5, 9]), np.array([5, 9, 4000])
    nine = (np.array([9], "<u2").tobytes(), np.array([2], "<i8").tobytes())
    words, at, n = M.merge([(M.pack(a), *nine), (M.pack(b), b"", b"")])
    assert M.offsets_of(words).tolist() == [1, 5, 9, 4000] and at.tolist() == [5, 9] and n.tolist() == [1, 3]
