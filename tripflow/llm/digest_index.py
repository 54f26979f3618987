"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: one row per text
ever kept (digest, doc_id, n_chars, batch). A batch of new documents is

1. reduced to digests (JVM only; texts are not shuffled),
2. grouped by digest with map-side partial aggregates (so a text copied a
   billion times is one row per task before the shuffle),
3. *sort-merge anti-joined* with the index: digests not in it are new,
4. appended, bucketed and sorted, so later batches join without shuffling the
   index.

A batch that is run again after a failure finds its own rows in the index
(they carry its batch name) and comes to the same result. Batches that run side
by side may both append a digest; its owner is then the batch whose name is first, for
every later reader, so no document comes back twice.

Two texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``. Of a group new to the index, the row with the most code
points in the original text stays, then the smallest doc_id (null last), then
one of the identical rows. A group that an earlier batch holds keeps none:
its keep_id is the earlier document's.

Defined results: null text counts as empty; a null doc_id is larger than all
others; an empty table returns no rows and leaves the index as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import scratch_path
from tripflow.sinks.files import delete_folder, folder_exists, replace_folder

from .common import free_name, quoted, require

# Fixed value: the characters that do not count.
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "digest binary, doc_id long, n_chars int, batch string"


def digest_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without blanks, in UTF-8."""
    return F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, ""), 256)


class DigestIndex:
    """The index in ``path``: a data folder and its bucket count."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        meta = f"{self.path}/meta"
        if folder_exists(spark, meta):
            stored = spark.read.schema("buckets int").parquet(meta).first().buckets
            if buckets not in (None, stored):
                raise ValueError(f"the index in {path} has {stored} buckets, not {buckets}")
            buckets = stored
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(meta)
        self.buckets = buckets
        data, whole = f"{self.path}/data", f"{self.path}/compacted"
        if not folder_exists(spark, data) and folder_exists(spark, whole):
            replace_folder(spark, whole, data)  # a compaction was cut off before its last step
        self.table = self._create(data)

    def _create(self, location: str) -> str:
        table = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {table} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location}'")
        return table

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def owners(self) -> DataFrame:
        """(digest, batch, doc_id): one row per digest, of the first batch by name, should several have appended it (no shuffle)."""
        first = self.rows().groupBy("digest").agg(F.min(F.struct("batch", "doc_id")).alias("first"))
        return first.select("digest", "first.batch", "first.doc_id")

    def append(self, rows: DataFrame) -> None:
        """Add (digest, doc_id, n_chars, batch) rows; one file per bucket."""
        rows.select("digest", "doc_id", "n_chars", "batch").repartition(self.buckets, "digest").write.insertInto(self.table)

    def compact(self) -> None:
        """Rewrite the index with one sorted file per bucket, as many batches leave many.

        To be run while no batch is: the new files take the old ones' place.
        """
        whole = f"{self.path}/compacted"
        delete_folder(self.spark, whole)
        table = self._create(whole)
        # Read as plain files: over the bucketed table Spark would leave the exchange out.
        plain = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/data")
        plain.repartition(self.buckets, "digest").write.insertInto(table)
        self.spark.sql(f"DROP TABLE {table}")
        replace_folder(self.spark, whole, f"{self.path}/data")

    def close(self) -> None:
        """Forget the session's table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def dedup(docs: DataFrame, index: DigestIndex, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, digest (hex), n_chars, keep_id, group_size, kept.

    Digests that the index does not have are appended to it.
    """
    require(docs, doc_id, text)
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    (
        docs.select(
            quoted(doc_id).cast("long").alias("doc_id"),
            F.length(F.coalesce(quoted(text).cast("string"), F.lit(""))).alias("n_chars"),
            F.unhex(digest_of(quoted(text))).alias("digest"),
        )
        .withColumn("row", F.monotonically_increasing_id())  # stored with the digests, so stable
        .write.parquet(path)
    )
    rows = spark.read.schema("doc_id long, n_chars int, digest binary, row long").parquet(path)
    order = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    new = groups.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
    index.append(new.select("digest", F.col("best.doc_id").alias("doc_id"), (-F.col("best.less")).alias("n_chars"), F.lit(batch).alias("batch")))
    held = index.owners().select("digest", F.col("doc_id").alias("keep_id"), (F.col("batch") == batch).alias("own"))
    verdicts = scratch_path(spark, "verdicts")
    groups.join(held.hint("merge"), "digest").select("digest", "keep_id", "group_size", F.when(F.col("own"), F.col("best.row")).alias("keep_row")).write.parquet(verdicts)
    judged = spark.read.schema("digest binary, keep_id long, group_size long, keep_row long").parquet(verdicts)
    # Many rows of one digest meet one row. Both sides are stored tables, each
    # with an exchange of its own, so adaptive execution can split a hot digest.
    return rows.join(judged.hint("merge"), "digest").select(
        "doc_id", F.lower(F.hex("digest")).alias("digest"), "n_chars", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept")
    )


def drop_duplicates(docs: DataFrame, index: DigestIndex, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.

    Rows are told apart by (doc_id, digest, length); of rows alike in all
    three with the one that stays, one stays.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "judged")
    dedup(docs, index, batch, doc_id, text).write.parquet(path)
    judged = spark.read.parquet(path)
    key = [free_name(docs, n) for n in ("_id", "_digest", "_chars")]
    alike = judged.groupBy(F.col("doc_id").alias(key[0]), F.col("digest").alias(key[1]), F.col("n_chars").alias(key[2])).agg(F.max("kept").alias("kept_one"), F.count(F.lit(1)).alias("alike_rows"))
    odd, again = scratch_path(spark, "odd"), scratch_path(spark, "repeated")
    alike.filter(~F.col("kept_one") | (F.col("alike_rows") > 1)).write.parquet(odd)
    odd_rows = spark.read.schema(alike.schema).parquet(odd)
    odd_rows.filter("kept_one").write.parquet(again)
    repeated = spark.read.schema(alike.schema).parquet(again)  # mostly few rows or none: Spark sees its size and need not shuffle the texts for it
    keyed = docs.withColumns({key[0]: quoted(doc_id).cast("long"), key[1]: digest_of(quoted(text)), key[2]: F.length(F.coalesce(quoted(text).cast("string"), F.lit("")))})

    def same(other: DataFrame) -> Column:
        return keyed[key[0]].eqNullSafe(other[key[0]]) & (keyed[key[1]] == other[key[1]]) & (keyed[key[2]] == other[key[2]])

    once = keyed.join(odd_rows, same(odd_rows), "left_anti").select(*map(quoted, docs.columns))
    one = keyed.join(repeated, same(repeated), "left_semi").groupBy(*key).agg(F.first(F.struct(*map(quoted, docs.columns))).alias("one")).select("one.*")
    return once.unionByName(one)
