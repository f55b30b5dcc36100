"""Token counts by rank-synchronous array merging.

The pieces of a BPE model are merged for whole batches of pre-tokens at once. A
batch is one ragged array: the symbols of all pre-tokens in a row, and the number
of the pre-token each belongs to. In every round each pre-token finds its
lowest-ranked pair and all pre-tokens apply theirs simultaneously; what is left
when no pair merges any more is counted.

A pre-token is a run of spaces with the word after it. Cutting there changes
nothing as long as no piece of the model has a space after another character;
that is checked when the model is loaded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import BoundedCache

SPACE = "▁"
NONE = np.int64(1 << 40)
# Entries of the pre-token cache of one Python worker.
CACHE_ENTRIES = 1_500_000
# Characters of texts whose pre-tokens are merged together.
BATCH_CHARS = 4_000_000
PRE_TOKEN = re.compile(" +[^ ]*")


class PieceCounter:
    """Counts the pieces a sentencepiece BPE model with byte fallback gives."""

    def __init__(self, model_file: str, cache_entries: int = CACHE_ENTRIES):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        pieces = [
            (-model.get_score(i), i, model.id_to_piece(i))
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        # A piece's number is its rank: the best score comes first.
        names = [piece for _, _, piece in sorted(pieces)]
        self.number = {piece: k for k, piece in enumerate(names)}
        self.size = len(names)
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("a piece of this model spans a word boundary")
        pairs = {
            self.number[name[:k]] * (self.size + 8) + self.number[name[k:]]: rank
            for rank, name in enumerate(names)
            for k in range(1, len(name))
            if name[:k] in self.number and name[k:] in self.number
        }
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k] for k in sorted(pairs)], dtype=np.int64)
        # Symbols outside the model: one number per length in bytes, as each
        # byte becomes a piece of its own.
        self.weight = np.r_[np.ones(self.size, np.int64), np.arange(8)]
        # The symbol of every code point.
        points = np.arange(0x110000)
        self.symbol = self.size + 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        for name, rank in self.number.items():
            if len(name) == 1:
                self.symbol[ord(name)] = rank
        self.cache = BoundedCache(cache_entries)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two neighbours make; NONE where they make none."""
        wanted = left * (self.size + 8) + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def merged(self, words: list[str]) -> np.ndarray:
        """Number of pieces of each pre-token."""
        counts = np.zeros(len(words), np.int64)
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.symbol[points]
        rank = np.full(len(symbol), NONE)
        if len(symbol) > 1:
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank_of(symbol[:-1], symbol[1:]), NONE)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbol)]))
            done = lowest == NONE
            if done.any():
                counts += np.bincount(
                    owner[done], weights=self.weight[symbol[done]], minlength=len(words)
                ).astype(np.int64)
                left = ~done
                symbol, owner, rank, lowest = symbol[left], owner[left], rank[left], lowest[left]
                if not len(symbol):
                    break
            at = self.chosen(symbol, owner, rank, lowest)
            symbol[at] = rank[at]
            left = np.ones(len(symbol), bool)
            left[at + 1] = False
            at = at - np.arange(len(at))
            symbol, owner, rank = symbol[left], owner[left], rank[left]
            for changed in (at, at[at > 0] - 1):
                nxt = np.minimum(changed + 1, len(symbol) - 1)
                near = (owner[nxt] == owner[changed]) & (nxt > changed)
                rank[changed] = np.where(near, self.rank_of(symbol[changed], symbol[nxt]), NONE)
        return counts

    def chosen(self, symbol, owner, rank, lowest) -> np.ndarray:
        """Places where a pre-token's lowest pair is merged in this round.

        All places of the pair at once, the left one of overlapping two, is what
        merging one by one gives unless a fresh piece makes a still lower pair
        with its neighbour; such a pre-token merges its leftmost place only.
        """
        at = np.flatnonzero(rank == lowest)
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at = at[nth % 2 == 0]
        fresh, last = rank[at], len(symbol) - 1
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, last)
        twin = np.r_[np.diff(at) == 2, False] & (owner[after] == owner[at])
        early = (at > 0) & (owner[before] == owner[at]) & (self.rank_of(symbol[before], fresh) < fresh)
        early |= (at + 2 <= last) & (owner[after] == owner[at]) & (self.rank_of(fresh, symbol[after]) < fresh)
        early |= twin & (self.rank_of(fresh, fresh) < fresh)
        if early.any():
            alone = np.isin(owner[at], owner[at[early]])
            first = np.r_[True, owner[at][1:] != owner[at][:-1]]
            at = at[~alone | first]
        return at

    def count(self, texts: list[str]) -> list[int]:
        """Number of pieces of each text; an empty text has none."""
        cache, found = self.cache, []
        split = [PRE_TOKEN.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        new = {word for words in split for word in words if word not in cache}
        fresh = dict(zip(new, self.merged([w.replace(" ", SPACE) for w in new]).tolist())) if new else {}
        for words in split:
            found.append(sum([cache[w] if w in cache else fresh[w] for w in words]))
        for word, n in fresh.items():
            if len(word) <= 40:
                cache.put(word, n)
        return found


def batches(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """The texts in order, in runs of about ``limit`` characters."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


COUNTERS: dict[str, PieceCounter] = {}


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text.

    ``model_file`` is the model's path on every executor. One row per input row,
    repeated rows included; a null text counts as empty: no bytes, no tokens.
    ``over_limit`` is n_tokens > ``limit``. Other columns are not read. Row-wise:
    no shuffle; memory is one Arrow batch and the bounded cache.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Workers serve many tasks: the model and the cache are kept between them.
        if model_file not in COUNTERS:
            COUNTERS[model_file] = PieceCounter(model_file)
        counter = COUNTERS[model_file]
        for frame in frames:
            counts: list[int] = []
            for run in batches(frame["text"].tolist()):
                counts += counter.count(run)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": frame["n_bytes"], "n_tokens": counts})

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInPandas(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
