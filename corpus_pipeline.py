"""The corpus pipeline: documents in, encoded training documents out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. Each works on all rows its predecessor kept and its decisions
take effect. All but the last return the columns of ``documents``.

1. ``language_id``: null texts and texts without letters go, and no others, also
   where no document has a language; prototypes are learned from those that do.
2. ``exact_dedup``: of texts equal but for blanks one stays.
3. ``simhash_dedup``: of each component of near fingerprints (4-word shingles,
   at most 4 differing bits) the smallest doc_id stays.
4. ``decontaminate``: documents of which a twentieth or more is benchmark
   windows go.
5. ``encode``: SentencePiece ids of each text as ``piece_ids``, decoded again as
   a check (``round_trip``).

Odd input: null ids, null or empty texts, repeated rows, extra columns and
empty tables have the results stated by each operator; none of them fails. Columns of
the table keep their names and values, whatever they are called (names that differ in
case only count as equal, dots are allowed); a column of ours whose name is taken gets an underscore.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import free_name, table
from tripflow.llm.contamination import drop_contaminated
from tripflow.llm.digest_index import DigestIndex, drop_duplicates
from tripflow.llm.language import learn, predict
from tripflow.llm.pieces import encode_pieces
from tripflow.llm.simhash import drop_near_duplicates
from tripflow.session import scratch_path

PIECES = "piece_bpe_32k.model"
WORD_MEMO = 300_000  # words the last stage remembers per worker; less than its default, as rows here are whole documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score, lettered = free_name(docs, "lang_pred"), free_name(docs, "score"), free_name(docs, "lettered")
    return predict(docs, learn(docs), lang=lang, score=score, lettered=lettered).filter(lettered).drop(lang, score, lettered)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_duplicates(docs, DigestIndex(spark, scratch_path(spark, "digest-index")), batch="documents")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=4, bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids, check = free_name(docs, "piece_ids"), free_name(docs, "round_trip")
    return encode_pieces(docs, public_tokenizers.path(PIECES), ids=ids, check=check, word_memo=WORD_MEMO)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# Language profiles, XXH64 fingerprints and piece ids are not expressible in
# SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
