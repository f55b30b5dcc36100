"""From raw documents to token sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import bpe_codec, mixing, near_dedup, pii, quality
from tessella.llm.catalog import table, tokenizer
from tessella.llm.common import written

# No source is cut; the most repeated one is seen one and a half times.
MIX = mixing.MixSettings(entropy=None, repeats=1.5)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Every row is judged by its own text, also one
    without id; a null text counts as empty."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that with the smallest id; rows that repeat
    it are copies too. Rows without id or without words are in no group and stay."""
    return near_dedup.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; personal data in it gives way to tags. A null text stays null."""
    return pii.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources are repeated towards the target weights. A null source is
    the source "", rows without id are repeated alike."""
    return mixing.mixed(docs, MIX)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text becomes its tokens; the digest of what they decode to comes with them.
    A null text has no tokens."""
    return bpe_codec.tokenised(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]
# A fitted classifier and exact set similarity have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
