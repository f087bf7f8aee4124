"""Operator 3, native: exact dedup by a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch is reduced
to one row for each digest (map-side first, so a hot text costs a row a task),
anti-joined with the index by sort-merge, which reads the index's buckets
without a shuffle, and what is new is appended.  Texts never leave the scan:
only digests are shuffled.

A batch that is repeated under the same id, as after a failure between the append and
its caller's write, keeps the same texts again: the index tells which batch brought a
digest, and the row that stays is chosen anew among the batch's own.

Null text counts as empty; empty texts are equal to each other.  Rows with the
same doc_id and text are told apart by a row number, so one of them stays.  Of
rows that tie on code points a null doc_id comes last.  An empty table gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import BLANKS, blank_as_empty, deleted, exists, moved, partitions, salted_join, scratch, staged


def text_sha256(text: Column | str = "text") -> Column:
    """Lowercase hex SHA-256 of the text without ASCII white space."""
    return F.sha2(F.translate(blank_as_empty(text), BLANKS, ""), 256)


class DigestIndex:
    """Digests seen so far: digest, keep_row, keep_id, batch; unique by digest."""

    COLUMNS = "digest BINARY, keep_row BIGINT, keep_id BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or scratch(spark, "digests")
        self.buckets = buckets or partitions(spark)
        self.name = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        if exists(spark, f"{self.path}.old"):  # a compaction failed between its renames, or before it deleted the old files
            if exists(spark, self.path):
                deleted(spark, f"{self.path}.old")
            else:
                moved(spark, f"{self.path}.old", self.path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self) -> None:
        """One file a bucket again, which appends make several of.  The new files take the
        place of the old by two renames; what a failure leaves is put right on opening."""
        fresh = f"{self.path}.fresh"
        deleted(self.spark, fresh)
        name = f"{self.name}_fresh"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        files = self.spark.read.schema(self.COLUMNS).parquet(self.path)  # not by buckets, for which Spark would leave out the exchange
        files.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.format("parquet").option("path", fresh).bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        moved(self.spark, self.path, f"{self.path}.old")
        moved(self.spark, fresh, self.path)
        deleted(self.spark, f"{self.path}.old")
        self.spark.catalog.refreshTable(self.name)

    def close(self, delete: bool = False) -> None:
        """Leaves the catalogue; with delete, the files go too."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if delete:
            deleted(self.spark, self.path)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Adds the digests of groups that the index lacks."""
        new = groups.hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        (
            new.select("digest", "keep_row", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.format("parquet").mode("append").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def exact_dedup(docs: DataFrame, index: DigestIndex, row: Column | None = None, batch: str | None = None) -> DataFrame:
    """_row, doc_id, keep_id, group_size (in this batch), kept, text_sha256 for
    each row of docs.  keep_id is the doc_id in the index, of this batch or of
    an earlier one; in the latter case no row of the group is kept.  batch: an id
    that stays the same when the batch is repeated; without one each call is a new batch."""
    batch = batch or uuid.uuid4().hex
    digests = staged(
        docs.select(
            (F.monotonically_increasing_id() if row is None else row).alias("_row"),
            "doc_id",
            F.length(blank_as_empty()).alias("points"),
            F.unhex(text_sha256()).alias("digest"),
        ),
        "digested",
    )
    groups = staged(
        digests.groupBy("digest")
        .agg(F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "_row")).alias("best"), F.count("*").alias("group_size"))
        .select("digest", "group_size", F.col("best._row").alias("keep_row"), F.col("best.doc_id").alias("keep_id")),
        "groups",
    )
    index.append(groups, batch)
    known = index.read().select("digest", "batch", F.col("keep_id").alias("known_id"))
    held = groups.hint("merge").join(known, "digest").withColumn("own", F.col("batch") == batch)
    held = staged(held.select("digest", "group_size", F.when(F.col("own"), F.col("keep_row")).alias("keep_row"), F.when(F.col("own"), F.col("keep_id")).otherwise(F.col("known_id")).alias("keep_id")), "held")
    return salted_join(digests, held, "digest", "group_size", "_row").select(
        "_row",
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.coalesce(F.col("_row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
