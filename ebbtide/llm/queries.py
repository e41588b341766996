"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import ship_package, table
from ebbtide.llm.exact_dedup import exact_dedup
from ebbtide.llm.jaccard_join import similar_documents
from ebbtide.llm.language import identify_languages
from ebbtide.llm.line_templates import drop_recurring_lines
from ebbtide.llm.oracle import ORACLE  # noqa: F401
from ebbtide.llm.packing import best_fit_pack
from ebbtide.llm.piece_codec import encode_documents
from ebbtide.llm.pii_bootstrap import find_personal_data, spelt_spans
from ebbtide.llm.quality import quality_scores
from ebbtide.llm.ranked_search import ranked_search
from ebbtide.llm.suffix_dedup import remove_repeats
from ebbtide.llm.token_alignment import align_tokenizers
from ebbtide.llm.token_counts import count_tokens
from ebbtide.llm.topk_search import exact_top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def model_bytes(path: str | None = None) -> bytes:
    """A SentencePiece model file; by default the public 32k one, read where it is installed."""
    return vocabulary_bytes("piece_bpe_32k.model", path)


def vocabulary_bytes(name: str, path: str | None = None) -> bytes:
    """A vocabulary file, by default the public one of that name, read where it is installed."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


def query(f: Query) -> Query:
    @functools.wraps(f)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = shipped
    return shipped


@query
def op1_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_jaccard_join(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents"), words=3, percent=90).select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op5_language(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op6_line_dedup(spark, sf_dir):
    return drop_recurring_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op8_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), model_bytes())


@query
def op9_packing(spark, sf_dir):
    return best_fit_pack(count_tokens(table(spark, sf_dir, "documents"), model_bytes()))


@query
def op10_piece_codec(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), model_bytes(), threads=2, with_ids=False)


@query
def op11_personal_data(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spelt_spans(F.concat("base", "added")).alias("spans"))


@query
def op12_token_alignment(spark, sf_dir):
    return align_tokenizers(table(spark, sf_dir, "documents"), vocabulary_bytes("byte_bpe_50k.json"), model_bytes())


@query
def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
