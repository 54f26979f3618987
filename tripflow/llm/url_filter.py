"""URL filters: a blocked Bloom filter before an exact join with listed URLs.

A list row is a canonical URL prefix (host, path, verdict): it fits its host
and every subdomain where the URL's path starts with the list's path. The
longest fitting row decides; equally long ones cannot differ but in verdict,
where block wins. Without one the verdict is ``default``.

A URL's candidate keys are its host and its parent domains, of the numbers of
labels that occur in the list, each with the path prefixes of the lengths that
occur in the list. Keys are hashed by the
JVM; a *blocked Bloom filter* (256-bit blocks, one bit in each of eight 32-bit
words, so one cache line a probe) passes possible hits, and only these are
joined by an exact equi-join on the key, which removes the false positives.

The filter is built by Spark (one row per block that has bits, combined with
bit_or) and its size is bounded by ``max_filter_bytes`` however long the list:
a fuller filter only passes more keys to the join. URLs without a possible hit
are never shuffled. The join is an ordinary one: hot list rows are split by
adaptive execution, and the pages are put together again by row number, so no
group of equal URLs ever meets in one task.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.

Defined results: a null URL or one without ``://`` has empty host and path and
fits nothing; list rows with an empty or null host, and repeated ones, are
harmless (a null path is empty); an empty list gives every URL the default; an
empty table gives no rows. Columns of the pages pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.session import scratch_path

from .common import quoted, require, with_fields

LIST = "host string, path string, verdict string"
BITS_PER_KEY = 16
MAX_FILTER_BYTES = 32 << 20
# Odd multipliers of the split-block filter, one per word of a block.
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _LETTERS, _LETTERS.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


class BlockedBloom:
    """The filter as an array of blocks of eight 32-bit words."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def bits(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """(block of each key, the one bit it has in each of the eight words)."""
        k = keys.view(np.uint64)
        block = ((k >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        with np.errstate(over="ignore"):
            spread = k.astype(np.uint32)[:, None] * SALTS[None, :]
        return block, np.uint32(1) << (spread >> np.uint32(27))

    def might_hold(self, keys: np.ndarray) -> np.ndarray:
        block, bit = self.bits(keys, len(self.words))
        return (self.words[block] & bit == bit).all(axis=1)


def build_filter(keys: DataFrame, n: int, bits_per_key: int = BITS_PER_KEY, max_bytes: int = MAX_FILTER_BYTES) -> BlockedBloom:
    """The filter of the long column ``key`` of about ``n`` rows."""
    blocks = int(min(max(1, -(-n * bits_per_key // 256)), max(1, max_bytes // 32)))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bit = BlockedBloom.bits(batch.column("key").to_numpy(zero_copy_only=False), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(block), *[pa.array(bit[:, i].astype(np.int64)) for i in range(8)]], names=["block", *[f"w{i}" for i in range(8)]])

    rows = keys.select("key").mapInArrow(bits, "block long, " + ", ".join(f"w{i} long" for i in range(8)))
    words = np.zeros((blocks, 8), np.uint32)
    combined = rows.groupBy("block").agg(*[F.expr(f"bit_or(w{i})").alias(f"w{i}") for i in range(8)])
    for r in combined.toLocalIterator():  # at most max_bytes / 32 rows
        words[r[0]] = r[1:]
    return BlockedBloom(words)


def judge_urls(pages: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``pages`` with host, path, rule (host + path of the list row, or null) and verdict."""
    require(pages, url)
    require(listed, "host", "path", "verdict")
    with_fields(pages, "host string, path string, rule string, verdict string")  # no clash
    spark = pages.sparkSession
    stored = scratch_path(spark, "listed")
    clean = listed.select(F.translate(F.col("host"), _LETTERS, _LETTERS.lower()).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host > ''")
    clean.groupBy("host", "path").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict"))["verdict"].alias("verdict")).write.parquet(stored)
    rules = spark.read.schema(LIST).parquet(stored)
    stats = rules.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths"), F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("depths")).first()
    bloom = build_filter(rules.select(_key(F.col("host"), F.col("path")).alias("key")), stats.n, max_bytes=max_filter_bytes)
    shared = spark.sparkContext.broadcast(bloom.words)
    lengths = F.array(*[F.lit(n) for n in stats.lengths]).cast("array<int>")

    # One number per stored row; the pages' columns travel in one struct.
    rowed = pages.select(F.struct(*map(quoted, pages.columns)).alias("page"), host_of(quoted(url).cast("string")).alias("host"), path_of(quoted(url).cast("string")).alias("path"))
    depths = F.array(*[F.lit(n) for n in stats.depths]).cast("array<int>")
    suffixes = F.transform(F.filter(depths, lambda n: n <= F.size(F.split("host", r"\."))), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    pairs = F.flatten(F.transform("suffixes", lambda h: F.transform("prefixes", lambda p: F.struct(h.alias("host"), p.alias("path")))))
    keyed = (
        rowed.withColumns({"suffixes": suffixes, "prefixes": prefixes})
        .withColumn("pairs", F.when(F.col("host") > "", pairs).otherwise(F.array().cast("array<struct<host:string,path:string>>")))
        .select("page", "host", "path", "pairs", F.transform("pairs", lambda p: _key(p["host"], p["path"])).alias("keys"))
    )

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = BlockedBloom(shared.value)
        for batch in batches:
            keys = batch.column("keys")
            hit = bloom.might_hold(keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False))
            # The positions of possible hits, as a list per row.
            n = np.diff(keys.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(n)))]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page", "host", "path", "pairs")], found], names=["page", "host", "path", "pairs", "hits"])

    from pyspark.sql.types import StructType

    schema = StructType([*keyed.select("page", "host", "path", "pairs").schema.fields, *StructType.fromDDL("hits array<int>").fields])
    possible = keyed.mapInArrow(probed, schema).select("page", "host", "path", F.transform("hits", lambda i: F.get("pairs", i)).alias("pairs"))
    numbered = scratch_path(spark, "url-hits")
    possible.withColumn("row", F.monotonically_increasing_id()).write.parquet(numbered)
    rows = spark.read.parquet(numbered)
    plain = rows.filter(F.size("pairs") == 0).select("page.*", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    hits = rows.select("row", F.explode("pairs").alias("p")).select("row", F.col("p.host").alias("host"), F.col("p.path").alias("path"))
    rank = F.struct(F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("m"), (F.col("verdict") == "block").alias("b"), F.concat("host", "path").alias("rule"), "verdict")
    best = hits.join(rules, ["host", "path"]).groupBy("row").agg(F.max(rank).alias("best")).select("row", "best.rule", "best.verdict")
    judged = rows.filter(F.size("pairs") > 0).join(best, "row", "left").select("page.*", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    return plain.unionByName(judged)
