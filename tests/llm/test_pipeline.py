import numpy as np
import pytest
import sentencepiece

from tests.llm.test_contamination import brute as brute_contamination
from tests.llm.test_digest_index import brute as brute_dedup
from tests.llm.test_digest_index import norm
from tests.llm.test_simhash import brute_components, plain_fingerprint

pipeline = pytest.importorskip("corpus_pipeline")


def judged(rows, benchmark):
    """The pipeline by brute force on (doc_id, text) rows with different ids; ids and texts that stay."""
    rows = [(k, t) for k, t in rows if any(c.isalpha() for c in t or "")]
    rows = [r for r, (keep, _) in zip(rows, brute_dedup(rows)) if r[0] == keep]
    comps = brute_components([plain_fingerprint(t) for _, t in rows], [k for k, _ in rows])
    rows = [r for r, c in zip(rows, comps) if r[0] == c]
    hits = brute_contamination([t for _, t in rows], benchmark)
    return {k: t for (k, t), (n, h, _) in zip(rows, hits) if not (h and 20 * h >= n)}


def test_whole_run_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = judged(rows, bench)
    lib = sentencepiece.SentencePieceProcessor(model_file=pipeline.public_tokenizers.path(pipeline.PIECES))
    got = {r.doc_id: r for r in pipeline.run(spark, sf).collect()}
    assert set(got) == set(want) and len(want) < len(rows)
    for k, t in want.items():
        assert got[k].text == t and got[k].piece_ids == lib.encode(t) and got[k].round_trip


def test_stages_keep_the_columns_and_bear_odd_rows(spark, tmp_path):
    prose = "the house by the river was old and nobody had lived there for years until "
    rows = [
        (1, prose * 5, "en", "a", 1, "x"), (2, prose.upper() * 5, None, None, None, "x"), (3, None, "en", "a", 1, None), (4, "", "fr", "b", 0, "x"), (5, "12 34", "en", "a", 5, "x"),
        (None, "un texte sans numéro", "fr", "b", 0, "x"), (7, "short", "en", "a", 5, "x"), (7, "short", "en", "a", 5, "x"), (8, prose * 5 + " ", "en", "a", 1, "x"), (9, "word " * 40_000, "en", "a", 1, "x"),
        (10, " ".join(f"b{i}" for i in range(20)), "en", "a", 1, "x"),
    ]
    more = ["Lang_Pred", "Score", "lettered", "_contamination", "_id", "_Digest", "_Gone_id", "kept_one", "component_id", "row", "Piece_Ids", "a.b"]
    rows = [(*r, *["x"] * (len(more) - 1)) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in more)
    path = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    out = pipeline.STAGES[-1][1](spark, docs, path)
    assert out.columns == [*docs.columns, "piece_ids_", "round_trip"]
    got = out.collect()
    assert all(r[c] == "x" for r in got for c in more[1:])
    assert all(r.round_trip for r in got)
    # 1 and 8 are equal but for a blank: 8 is longer and stays; 2 has the same fingerprint and a smaller id.
    assert sorted((r.doc_id or -1, norm(r.text)[:5]) for r in got) == [(-1, "untex"), (2, "THEHO"), (7, "short"), (9, "wordw")]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert pipeline.run(spark, path).collect() == []
    assert np.array([n for n, _ in pipeline.STAGES]).tolist() == ["language_id", "exact_dedup", "simhash_dedup", "decontaminate", "encode"]


def test_texts_stay_where_no_document_has_a_language(spark):
    rows = [(1, "a house by the river", None), (2, "日本", None), (3, "12 34", None), (4, None, None), (5, "", None), (6, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = pipeline.language_id(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 6]
