"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a table bucketed and sorted by digest.  A batch is grouped by
digest first (map-side partial aggregates, so a group of copies costs one row
per task), the groups that the index lacks are found by a sort-merge anti-join
that reads the index without shuffling it, and those are appended.  Texts are
equal when their SHA-256 is equal after lower-casing A-Z only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.session import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), 256))


class DigestIndex:
    """Table ``(digest, keep_id, batch)``, bucketed and sorted by digest; one row per known text."""

    def __init__(self, spark: SparkSession, table: str, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.table, self.id_type, self.buckets = spark, table, id_type, buckets

    def create(self) -> DigestIndex:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {self.id_type}, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )
        return self

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The batch's texts that the index lacks (sort-merge anti-join on the digest)."""
        return groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Deduplicate ``docs`` against the index and append what is new.

        Returns one row per input row: id, ``digest``, ``keep_id`` (the row
        that stays), ``group_size`` (rows of this batch with the text) and
        ``kept``.  Of equal new texts the largest id stays; a null id ranks
        below all others.  A text that the index had before the batch keeps
        nothing new.  Null and empty texts are equal.  Rows that repeat an id
        and its text share their decision.  Other columns are not read, so
        their names are free.  An empty batch gives an empty result.

        ``batch`` names the batch: adding it again after a failure gives the
        same decisions and appends nothing twice.
        """
        batch = batch or uuid.uuid4().hex
        hashed = docs.select(F.col(id_col).cast(self.id_type).alias("id"), text_digest(F.col(text_col)).alias("digest"))
        path = fresh_dir(self.spark, "exact_dedup")
        # written once: the join below then splits a hot digest's rows over tasks (AQE), and a lost executor re-reads
        hashed.write.parquet(f"{path}/rows")
        hashed = self.spark.read.parquet(f"{path}/rows")
        groups = hashed.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        groups.write.parquet(f"{path}/groups")
        groups = self.spark.read.parquet(f"{path}/groups")
        (
            self.unseen(groups).select("digest", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)
        known = self.rows().select("digest", F.col("keep_id").alias("known_id"), (F.col("batch") == batch).alias("fresh"))
        (
            groups.join(known.hint("merge"), "digest")
            .select("digest", F.col("known_id").alias("keep_id"), "group_size", "fresh")
            .write.parquet(f"{path}/decided")
        )
        decided = self.spark.read.parquet(f"{path}/decided")
        return hashed.join(decided.hint("merge"), "digest").select(
            F.col("id").alias(id_col), "digest", "keep_id", "group_size", (F.col("fresh") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept")
        )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decisions of ``DigestIndex.add`` on a new index that is dropped again."""
    spark = docs.sparkSession
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", docs.schema[id_col].dataType.simpleString()).create()
    try:
        return index.add(docs, id_col, text_col)
    finally:
        index.drop()
