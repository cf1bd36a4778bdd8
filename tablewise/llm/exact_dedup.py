"""Exact document dedup through a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the
normalised text (A-Z lower-cased, null counts as empty).  A batch is reduced
to one row per digest by a pre-aggregating group, anti-joined against the
index by a sort-merge join on the bucket key, and what is new is appended.
Only DataFrame operations: no Python runs on executors.

Skew: copies collapse in the map-side partial aggregate, so a group that
holds a third of all rows reaches the shuffle as one row per task; the join
back to the documents streams the many side of a left join, which adaptive
execution may split.

Defined cases: null text equals empty text; a null id is smaller than any
id; rows that repeat both id and text give one kept row; very long texts are hashed
whole; an empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, lower_ascii, save, text_or_empty


def text_digest(text: str | Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(lower_ascii(text_or_empty(text)), 256)


class DigestIndex:
    """Persistent table (digest, doc_id, batch) bucketed and sorted by digest.

    ``path`` lies in a folder that all executors share.  An index that exists
    there is opened with the same ``buckets``; a new session finds its rows.  Every append
    adds files to the buckets; ``compacted`` merges them into a new index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, id_type: str = "bigint"):
        self.spark, self.buckets = spark, buckets
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, doc_id {id_type}, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_only(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        self._insert(groups.select("digest", "doc_id", F.lit(batch).alias("batch")))

    def compacted(self, path: str, bucket_rows: int = 5_000_000) -> DigestIndex:
        """The same rows as a new index at ``path``: one sorted file a bucket, and buckets enough for their number."""
        buckets = max(1, -(-self.rows().count() // bucket_rows))
        out = DigestIndex(self.spark, path, buckets, self.rows().schema["doc_id"].dataType.simpleString())
        out._insert(self.rows())
        return out

    def _insert(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "doc_id", "batch")
            .repartition(self.buckets, "digest")
            .write.insertInto(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"))


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per digest of (doc_id, digest) rows: digest, doc_id (the largest), group_size."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("group_size"))


def dedup_batch(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None
) -> DataFrame:
    """Decide every row of a batch against itself and the index; append what is new.

    ``batch`` names it; a batch that failed half-way and is sent again under its name keeps what it would have kept.

    Returns one row per input row: doc_id, digest, keep_id, group_size (rows of
    this batch with that digest), kept.  When the index already has a digest,
    keep_id is the id it stored and no row of the batch is kept.
    """
    batch = batch or uuid.uuid4().hex
    rows = save(digests(docs, id_col, text_col), "digests")  # texts are read and hashed once
    groups = digest_groups(rows)
    index.append(index.new_only(groups), batch)
    first = index.rows().select("digest", F.col("doc_id").alias("keep_id"), (F.col("batch") == batch).alias("_new"))
    decided = groups.join(first.hint("merge"), "digest").select("digest", "keep_id", "group_size", "_new")
    copies = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    return copies.join(decided, "digest").select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        "_new",
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        (F.col("_new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
    )


def keep_first(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged (one row of each repeated row)."""
    kept = dedup_batch(docs, index, id_col, text_col).filter("kept")
    keys = kept.select(F.col("digest").alias("_digest"), id_key("doc_id").alias("_id"))
    rows = docs.select(F.struct("*").alias("row"), text_digest(text_col).alias("_digest"), id_key(id_col).alias("_id"))
    first = rows.join(keys, ["_digest", "_id"], "left_semi").dropDuplicates(["_digest", "_id"])
    return first.select("row.*")
