"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import ship_package, stored, table
from ebbtide.llm.jaccard_join import NO_ID, similar_documents
from ebbtide.llm.line_templates import drop_recurring_lines
from ebbtide.llm.packing import best_fit_pack
from ebbtide.llm.quality import keep_good
from ebbtide.llm.queries import model_bytes
from ebbtide.llm.suffix_dedup import remove_repeats
from ebbtide.llm.token_counts import count_tokens

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, the length as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. The classifier learns from `labels` and the texts given."""
    ship_package(spark)
    return keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; documents that have nothing else go too."""
    ship_package(spark)
    left = drop_recurring_lines(docs)
    return _documents(left.where((F.col("n_dropped") == 0) | F.col("text").rlike("\\S") | F.col("text").isNull()))


def _keyed(docs: DataFrame) -> DataFrame:
    """A row is known by its id and a hash of its text: ids may be missing or stand for several texts."""
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_th": F.xxhash64(F.coalesce("text", F.lit("")))})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word 5-shingles with a similarity of 0.8 or more, the one with the smallest id stays.

    Any id comes before none, and of several texts under the smallest id that with the smallest hash stays. Repeated rows
    (same id and text) are one document, of which one row stays.
    """
    ship_package(spark)
    found = similar_documents(docs, words=5, percent=80, count_links=False)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("text_hash").alias("_th"))
    found = stored(found.select("component", key.alias("key")), "found")
    linked = found.where("component is not null").groupBy("component").agg(F.min("key").alias("key"))
    rest = linked.select("key").unionByName(found.where("component is null").select("key")).select("key._id", "key._th").distinct()
    rows = _keyed(docs).groupBy("_id", "_th").agg(F.min(F.struct("lang", "source", "n_chars")).alias("other"), F.first("doc_id").alias("doc_id"), F.max("text").alias("text"))
    return rows.join(rest, ["_id", "_th"]).select("doc_id", "text", "other.*").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 100 or more that also start earlier go; documents of which nothing is left go too.

    A cut may fall within a character; the bytes of such a character go as well.
    """
    ship_package(spark)
    found = remove_repeats(docs).where("n_removed > 0").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("text_hash").alias("_th"), "kept")
    left = _keyed(docs).join(found.dropDuplicates(["_id", "_th"]).withColumn("cut", F.lit(True)), ["_id", "_th"], "left")
    text = F.when(F.col("cut"), F.col("kept")).otherwise(F.col("text"))
    return _documents(left.withColumn("text", text).where("cut is null or text rlike '\\\\S'"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in bins of the permitted lengths."""
    ship_package(spark)
    return best_fit_pack(count_tokens(docs, model_bytes()))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packing", packing)]

#: The classifier and the tokenizer can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
