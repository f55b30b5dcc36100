"""Ranked lexical search, term at a time with a limited set of accumulators.

Every task indexes the documents it reads into shards of bounded size: the postings of
each term, in the order of the documents. Document frequencies and lengths are summed
over all shards, so that every shard scores as one index would. A shard answers blocks of
items: an item's terms are taken rarest first, each adding to the accumulators of the
documents that hold it. Once the bounds of the terms still to come cannot lift a new
document to the k-th best partial score, no accumulator is created any more; those that
can still get there are updated exactly. The shards' best are merged.

Scores are integers, so the order of the terms doesn't change them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import thick, thin, written


@dataclass(frozen=True)
class RankSettings:
    b_percent: int = 25  # share of the length in the norm, in hundredths
    k1_tenths: int = 12
    shard_words: int = 2_000_000  # a shard ends with the document that brings it to this many
    shard_docs: int = 50_000  # or to this many
    item_block: int = 25_000  # terms of items that travel together
    chunk: int = 64  # blocks of items that a shard answers in one task


SETTINGS = RankSettings()
POSTINGS = ["ids", "lengths", "terms", "df", "docs", "tf"]
# Bytes that belong to a term; A-Z fold to a-z, all others part terms.
TERM_BYTES = bytes(
    byte if byte >= 0x80 or chr(byte).isdigit() else byte | 0x20 if chr(byte).isalpha() else 0x20 for byte in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(TERM_BYTES).split(b" ")


def build_index(docs: DataFrame, settings: RankSettings = SETTINGS) -> DataFrame:
    """One row per shard, written to the shared folder. Every document is indexed; one
    very long text makes a shard of its own."""

    def shard(ids, places, names, number):
        lengths = np.array([len(p) for p in places], np.int64)
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        doc = np.repeat(np.arange(len(ids)), lengths)
        term = rank[np.concatenate(places)] if len(doc) else doc
        key, tf = np.unique(term * len(ids) + doc, return_counts=True)
        return pd.DataFrame(
            {
                "shard": [(TaskContext.get().partitionId() << 24) + number], "ids": [ids],
                "lengths": [thin(lengths)], "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())],
                "terms": [b" ".join(names[i] for i in order)],
                "df": [thin(np.bincount(key // len(ids), minlength=len(names)))],
                "docs": [thin(key % len(ids))], "tf": [thin(tf)],
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, places, numbers, held, number = [], [], {}, 0, 0
        for frame in frames:
            for doc, text in zip(frame["doc_id"], frame["text"]):
                ids.append(None if pd.isna(doc) else int(doc))
                found = [numbers.setdefault(t, len(numbers)) for t in terms_of(text) if t]
                places.append(np.array(found, np.int32))
                held += len(found)
                if len(ids) >= settings.shard_docs or held >= settings.shard_words:
                    yield shard(ids, places, list(numbers), number)
                    ids, places, numbers, held, number = [], [], {}, 0, number + 1
        if ids:
            yield shard(ids, places, list(numbers), number)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = (
        "shard long, ids array<long>, lengths binary, n_docs long, n_terms long, "
        "terms binary, df binary, docs binary, tf binary"
    )
    return written(rows.mapInPandas(run, schema), "ranked_index")


def document_frequencies(index: DataFrame) -> DataFrame:
    """term, df over all shards."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for terms, df in zip(frame["terms"], frame["df"]):
                terms = bytes(terms).split(b" ") if len(terms) else []
                yield pd.DataFrame({"term": terms, "df": thick(df).astype(np.int64)[: len(terms)]})

    part = index.select("terms", "df").mapInPandas(run, "term binary, df long")
    return part.groupBy("term").agg(F.sum("df").alias("df"))


def item_terms(items: DataFrame) -> DataFrame:
    """item, item_id, term, times: the terms of each row of ``items``, which has ``item``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, item_id, text in zip(frame["item"], frame["item_id"], frame["text"]):
                terms, times = np.unique(np.array([t for t in terms_of(text) if t], object), return_counts=True)
                ids = pd.array([None if pd.isna(item_id) else int(item_id)] * len(terms), "Int64")
                yield pd.DataFrame({"item": item, "item_id": ids, "term": list(terms), "times": times})

    rows = items.select("item", "item_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "item long, item_id long, term binary, times long")


def weighted(terms: DataFrame, n_docs: int) -> DataFrame:
    """With the weight of each term; terms of no weight add nothing and go."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["weight"] = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frame["df"]]
            yield frame[frame["weight"] > 0]

    return terms.mapInPandas(run, "item long, item_id long, term binary, times long, df long, weight long")


class Shard:
    """A shard's postings with their contributions, but for the weight."""

    def __init__(self, row, n_docs: int, n_terms: int, settings: RankSettings):
        self.ids = np.array([np.iinfo(np.int64).max if pd.isna(x) else int(x) for x in row.ids], np.int64)
        self.named = np.array([not pd.isna(x) for x in row.ids], bool)
        names = bytes(row.terms).split(b" ") if len(row.terms) else []
        self.place = {name: i for i, name in enumerate(names)}
        df = thick(row.df).astype(np.int64)[: len(names)]
        self.end = np.cumsum(df)
        self.begin = self.end - df
        self.docs = thick(row.docs).astype(np.int64)
        tf = thick(row.tf).astype(np.int64)
        length, b = thick(row.lengths).astype(np.int64), settings.b_percent
        m = 100 - b + (b * length * n_docs) // max(1, n_terms)
        self.part = (1_000_000_000 * tf) // (1000 * tf + settings.k1_tenths * m[self.docs])
        self.most = np.maximum.reduceat(self.part, self.begin) if len(df) else np.zeros(0, np.int64)
        self.created = 0  # accumulators
        self.touched = 0  # postings read

    def best(self, terms: list[bytes], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents; terms come rarest first."""
        found = [(self.place[t], w) for t, w in zip(terms, weights) if t in self.place]
        bounds = np.array([self.most[p] * w for p, w in found] + [0], np.int64)
        rest = np.cumsum(bounds[::-1])[::-1]  # what this term and those after it can add
        score = np.zeros(len(self.ids), np.int64)
        alive = None  # the accumulators, once no new ones are created
        for (p, weight), left in zip(found, rest.tolist()):
            docs, part = self.docs[self.begin[p] : self.end[p]], self.part[self.begin[p] : self.end[p]]
            if alive is None and k <= len(score) and left <= score.max():
                floor = np.partition(score, -k)[-k]
                if left < floor:
                    alive = np.flatnonzero(score + left >= floor)
                    self.created += np.count_nonzero(score)
            if alive is None:
                score[docs] += part * weight
                self.touched += len(docs)
                continue
            at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            hit = docs[at] == alive
            score[alive[hit]] += part[at[hit]] * weight
            self.touched += int(hit.sum())
            if len(alive) > k:  # those that can't get there any more go
                floor = np.partition(score[alive], -k)[-k]
                alive = alive[score[alive] + (left - self.most[p] * weight) >= floor]
        if alive is None:
            alive = np.flatnonzero(score)
            self.created += len(alive)
        if len(alive) > k:
            alive = alive[score[alive] >= np.partition(score[alive], -k)[-k]]
        alive = alive[np.lexsort((self.ids[alive], -score[alive]))][:k]
        return alive, score[alive]


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, settings: RankSettings = SETTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each row of ``items``.

    ``items`` (item_id, text), ``docs`` (doc_id, text). Every row of ``docs`` is a document
    of its own, also one that repeats an id, and every row of ``items`` an item with ranks
    of its own. Only documents with a score above 0 are ranked; equal scores go by
    ascending doc_id, documents without an id last. Null and empty texts have no terms:
    such items have no rows, such documents are never found. Very long texts are indexed
    whole. Other columns are not read.
    """
    index = build_index(docs, settings)
    n_shards, n_docs, n_terms = index.agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    numbered = written(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    known = item_terms(numbered).join(document_frequencies(index), "term")
    terms = written(weighted(known.select("item", "item_id", "term", "times", "df"), n_docs), "item_terms")
    blocks = max(1, math.ceil(terms.count() / settings.item_block))
    rarest = F.sort_array(F.collect_list(F.struct("df", "term", (F.col("weight") * F.col("times")).alias("weight"))))
    packed = terms.groupBy("item", "item_id").agg(rarest.alias("terms"))
    packed = packed.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("item", "item_id", "terms")).alias("asked")
    )
    packed = written(packed, "item_blocks")
    # A task gets a shard's row first, then a chunk of the blocks of items.
    chunks = math.ceil(blocks / settings.chunk)
    nothing = lambda df, names: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    shards = index.select("shard", numbers(chunks).alias("chunk"), F.lit(-1).cast("long").alias("block"), *POSTINGS, *nothing(packed, ["asked"]))
    every = index.select("shard", numbers(blocks).alias("block")).join(packed, "block")
    chunk = F.floor(F.col("block") / settings.chunk).cast("long").alias("chunk")
    work = shards.union(every.select("shard", chunk, "block", *nothing(index, POSTINGS), "asked"))
    work = work.repartition(max(1, (n_shards or 0) * chunks), "shard", "chunk").sortWithinPartitions("shard", "chunk", "block")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = None
        for frame in frames:
            for row in frame.itertuples():
                if row.block < 0:
                    shard = Shard(row, n_docs, n_terms, settings)
                    continue
                out = []
                for asked in row.asked:
                    terms = asked["terms"]
                    at, score = shard.best([bytes(t["term"]) for t in terms], [int(t["weight"]) for t in terms], k)
                    item_id = None if pd.isna(asked["item_id"]) else int(asked["item_id"])
                    out.append(
                        pd.DataFrame(
                            {
                                "item": asked["item"], "item_id": pd.array([item_id] * len(at), "Int64"),
                                "doc_id": pd.array(shard.ids[at], "Int64"), "score": score,
                            }
                        )
                    )
                    out[-1].loc[~shard.named[at], "doc_id"] = pd.NA
                yield pd.concat(out) if out else pd.DataFrame(columns=["item", "item_id", "doc_id", "score"])

    found = work.mapInPandas(run, "item long, item_id long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
