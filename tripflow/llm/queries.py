"""Registered queries of the operators in this folder: ``opN_<name>(spark, sf_dir)``.

Each applies its operator with production parameters to the whole table and
derives the contract's columns from the operator's output. ``ORACLE`` holds
DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from . import quality, quality_rules
from .bwt_dedup import remove_repeats
from .common import table
from .contamination import contamination, is_contaminated
from .digest_index import DigestIndex, dedup
from .hard_negatives import mine
from .language import held_out, learn, predict
from .merkle import ascii_lower, manifest
from .pieces import round_trip
from .simhash import hex_of, near_duplicates
from .token_counts import token_counts
from .token_files import read_token_files, token_files
from .url_filter import LIST, judge_urls

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"

# The rules of the URL contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, LIST)
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), listed).drop("url")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    found = dedup(table(spark, sf_dir, "documents"), index, batch="documents")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out(F.col("doc_id"))
    prototypes = learn(docs.filter(~held))
    found = predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1)
    return read_token_files(spark, path)


def op6_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    found = quality.score(docs, quality.learn(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=1024)


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    c = "_contamination"
    return found.select(
        "doc_id",
        F.col(f"{c}.n_words").alias("n_words"),
        F.col(f"{c}.n_hit").alias("n_hit"),
        F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"),
        is_contaminated(c).alias("contaminated"),
    )


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return found.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), anchor=F.col("id") % 50 == 0, positives=5, negatives=3, window=(50, 95), scale=256)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality_rules.cascade(table(spark, sf_dir, "documents"), columns=["doc_id"], report=stats)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select("doc_id", *stats, base_failed.alias("base_failed"), "kept")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], group="lang", tampered={"text": ascii_lower(F.col("text"))})
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_pieces": op2_pieces,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_token_files": op5_token_files,
    "op6_bwt_dedup": op6_bwt_dedup,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_contamination": op9_contamination,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# Windows of 13 consecutive item words, found in the documents by an equi-join
# on the joined window text; shorter items are one window of their length.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s FROM bi),
lengths AS (SELECT DISTINCT m FROM bw),
di AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m),
dw AS (SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s FROM di),
hit AS (SELECT dw.doc_id, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.s = bw.s),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.items, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AND 20 * coalesce(n.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

OP1_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(.*?)://([^/?#]*)([^?#]*)', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(.*?)://([^/?#]*)([^?#]*)', 3) AS path
  FROM pages),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT page_id, host, path, h || r.p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || r.p) DESC) AS k
  FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.k = 1
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""

# Texts as hex digits, two a byte; every window of 50 bytes by its smallest id;
# covered windows joined to runs; the bytes between runs are what stays.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
m AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
c AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before FROM w JOIN m ON w.s = m.s WHERE m.first_id < w.doc_id),
g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM c),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, run),
p AS (SELECT r.doc_id, r.run, a, b, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS last_b FROM r),
k AS (SELECT p.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last_b,
             string_agg(substr(d.h, 2 * last_b + 1, 2 * (a - last_b)), '' ORDER BY run) AS head
      FROM p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.head, '') || substr(d.h, 2 * coalesce(k.last_b, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

# Windows of 8 words that a text has twice or more, the words in them, and the
# rules over the counts.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
s AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
         CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * word_chars < 5 * n_words OR word_chars > 10 * n_words
            OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM s
"""



def _merkle_levels(source: str, group: str, name: str, depth: int) -> str:
    """CTEs ``<name>0`` to ``<name><depth>``: nodes (g, i, h, n, run of siblings) of each level of the trees over ``source`` (g, i, h)."""
    out = [f"{name}0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY {group}) AS n FROM {source})"]
    for k in range(1, depth + 1):
        up = f"SELECT g, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k - 1} WHERE n > 1 GROUP BY g, i // 8"
        out.append(f"{name}{k} AS (SELECT g, i, h, count(*) OVER (PARTITION BY {group}) AS n FROM ({up} UNION ALL SELECT g, i, h FROM {name}{k - 1} WHERE n = 1))")
    return ",\n".join(out)


def _merkle_proofs(name: str, depth: int) -> str:
    """CTEs ``<name>s0``...: for each node of a level, the others of its run in two parts: before and after it."""
    out = []
    for k in range(depth):
        run = f"SELECT g, i // 8 AS r, list(h ORDER BY i) AS run, any_value(n) AS n FROM {name}{k} GROUP BY g, i // 8"
        out.append(f"{name}s{k} AS ({run})")
    return ",\n".join(out)


MERKLE_DEPTH = 7  # of the SQL only: 8 ** 7 leaves a language, as many languages


def _op13_sql() -> str:
    part = "coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = "sha256(" + " || ".join(part.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = "sha256(" + " || ".join(part.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", low)) + ")"
    # CRC-32 bit by bit: each digit's code, then seven zeros, as the values to take in before a shift.
    crc = "xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])), lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END, CAST(4294967295 AS BIGINT)))"
    parts = [
        f"d AS (SELECT doc_id, lang, {leaf} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {changed} ELSE {leaf} END AS now FROM documents)",
        "p AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
        "leaves AS (SELECT g, i, leaf AS h FROM p)",
        _merkle_levels("leaves", "g", "a", MERKLE_DEPTH),
        _merkle_proofs("a", MERKLE_DEPTH),
        f"subs AS (SELECT 0 AS g, g AS i, h FROM a{MERKLE_DEPTH})",
        _merkle_levels("subs", "g", "b", MERKLE_DEPTH),
        _merkle_proofs("b", MERKLE_DEPTH),
        "f0 AS (SELECT doc_id, g, i, i AS j, leaf, '' AS proof, now AS fold FROM p)",
    ]
    at = 0
    for name, count in (("a", MERKLE_DEPTH), ("b", MERKLE_DEPTH)):
        for k in range(count):
            slot, group = "f.j % 8", "f.g" if name == "a" else "0"
            others = f"array_to_string(list_slice(s.run, 1, {slot}), '') || {{x}} || array_to_string(list_slice(s.run, {slot} + 2, 8), '')"
            parts.append(
                f"f{at + 1} AS (SELECT f.doc_id, f.g, f.i, f.leaf, CASE WHEN s.n > 1 THEN f.j // 8 ELSE f.j END AS j, "
                f"CASE WHEN s.n > 1 THEN f.proof || {others.format(x=chr(39) * 2)} ELSE f.proof END AS proof, "
                f"CASE WHEN s.n > 1 THEN sha256({others.format(x='f.fold')}) ELSE f.fold END AS fold "
                f"FROM f{at} f JOIN {name}s{k} s ON s.g = {group} AND s.r = f.j // 8)"
            )
            at += 1
        if name == "a":  # go on with the subroot's place among the languages
            parts.append(f"f{at + 1} AS (SELECT doc_id, g, i, leaf, g AS j, proof, fold FROM f{at})")
            at += 1
    return (
        "WITH " + ",\n".join(parts) + "\n"
        f"SELECT f.doc_id, f.leaf, a.h AS subroot, b.h AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = b.h AS verified\n"
        f"FROM f{at} f JOIN a{MERKLE_DEPTH} a ON a.g = f.g CROSS JOIN b{MERKLE_DEPTH} b"
    )


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

ORACLE: dict[str, str] = {
    "op11_hard_negatives": OP11_SQL,
    "op13_merkle_manifest": _op13_sql(),
    "op12_quality_rules": OP12_SQL,
    "op6_bwt_dedup": OP6_SQL,
    "op1_url_filter": OP1_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op9_contamination": OP9_SQL,
}
