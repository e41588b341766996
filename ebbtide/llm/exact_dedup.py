"""Exact dedup against a persistent digest index, bucketed and sorted by digest. DataFrame and SQL only."""

from __future__ import annotations

import hashlib
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import identified
from ebbtide.session import scratch_path


def with_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the SHA-256 of the text with A-Z lower-cased; a missing text counts as empty."""
    text = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return identified(docs, id_col, text_col).select("doc_id", F.sha2(text.cast("binary"), 256).alias("digest"))


class DigestIndex:
    """Digests seen so far, in `buckets` buckets sorted by digest, at a path that outlives the session.

    The index holds one row per distinct text: digest, the document that stays and how many
    documents of its batch shared the text. `append` removes known digests by a sort-merge
    anti-join that reads the index bucket by bucket without shuffling it, and adds the rest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        return groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, digests: DataFrame) -> None:
        """Add the texts of a batch (doc_id, digest) that the index lacks; of equal texts the largest id stays.

        Sums are merged before the shuffle, so a text with a third of all copies is a few rows per task.
        """
        groups = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        fresh = self.unseen(groups).repartition(self.buckets, "digest").select("digest", "keep_id", "group_size")
        fresh.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def lookup(self, digests: DataFrame) -> DataFrame:
        """Every document with the row that stays for its text.

        The index files are read without their bucketing here: then both sides are shuffled
        and Spark can split the partition of a frequent text.
        """
        known = self.spark.read.schema(self.table().schema).parquet(self.path)
        return digests.join(known, "digest")


def exact_dedup(docs: DataFrame, index_path: str | None = None, buckets: int = 64,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. With `index_path` earlier batches
    count: their document stays. Missing and empty texts are equal to each other. Repeated rows
    (same id and text) are one document listed twice, and both are marked kept if it stays.
    Rows without an id lose against any id; without a rival they stay. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    digests = with_digest(docs, id_col, text_col)
    index = DigestIndex(spark, index_path or scratch_path(spark, "digest-index"), buckets)
    index.append(digests)
    return index.lookup(digests).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
