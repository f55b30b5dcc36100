"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bm25_search, bpe_codec, conversation_repair, graph_search, lm_score, mixing, near_dedup
from tessella.llm import oracles, pii, quality, ranked_search, substring_dedup, token_counts, url_rules

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_graph_search(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return graph_search.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op2_url_rules(spark, folder):
    return url_rules.judge(table(spark, folder, "pages"))


def op3_bpe_codec(spark, folder):
    return bpe_codec.code_digests(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_pii(spark, folder):
    return pii.span_digests(table(spark, folder, "documents"))


def op5_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op6_bm25_search(spark, folder):
    docs = table(spark, folder, "documents")
    return bm25_search.top_k(docs, docs.where(F.col("doc_id") % 20 == 0), k=10)


def op7_lm_score(spark, folder):
    return lm_score.scores(table(spark, folder, "documents"))


def op8_near_dedup(spark, folder):
    return near_dedup.groups(table(spark, folder, "documents"))


def op9_mixing(spark, folder):
    return mixing.plan(table(spark, folder, "documents"))


def op10_quality(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_conversation_repair(spark, folder):
    conversations = table(spark, folder, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damaged(conversations))


def op12_substring_dedup(spark, folder):
    return substring_dedup.kept_digests(table(spark, folder, "documents"))


def op13_ranked_search(spark, folder):
    return ranked_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


QUERIES: dict[str, Query] = {
    "op1_graph_search": op1_graph_search,
    "op2_url_rules": op2_url_rules,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_pii": op4_pii,
    "op5_token_counts": op5_token_counts,
    "op6_bm25_search": op6_bm25_search,
    "op7_lm_score": op7_lm_score,
    "op8_near_dedup": op8_near_dedup,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
