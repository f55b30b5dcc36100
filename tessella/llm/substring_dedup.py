"""Passages that an earlier document has too, found by compressed FM-indexes.

Where a passage of ``window`` words occurs in two documents, both choose the same anchor
in it: the ``gram`` of words with the smallest hash. Anchors that only one document has
are passed over. Around the others, each document's windows of one anchor are a passage of
less than two windows; equal passages become one, with the smallest and largest id that
holds it. Passages are dealt to shards by their anchor, so a window meets all its equals in
one shard and the work grows with the repeated text, not with its square.

A shard indexes its passages: suffix order, Burrows-Wheeler transform in a wavelet tree
(a matrix of bits with popcount ranks, about 20 bits a word), and longest common prefixes.
Passages are streamed through it by backward search, all in step: where a word can't
extend a match, the match falls back to its longest prefix that another suffix shares.
Matches of a window or more are reported with the smallest id in their suffix range.

An anchor with too many different passages for a shard is settled window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import BoundedCache, mixed, written


@dataclass(frozen=True)
class PassageSettings:
    window: int = 50  # words
    gram: int = 16  # words of an anchor
    shard_words: int = 1_000_000  # words that a shard indexes, about
    hot_words: int = 250_000  # an anchor whose passages hold more is settled by windows
    piece: int = 1 << 20  # bytes of text that are hashed at once


SETTINGS = PassageSettings()
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# A random number for each byte, and an odd base: they only choose candidates.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
BASE = np.uint64(0x9E3779B97F4A7C15)


# Words, anchors, passages ---------------------------------------------------------


def word_bounds(raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of texts laid end to end begin and end; texts begin at ``firsts``."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACES[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[firsts] = True
    before = np.r_[False, solid[:-1]]
    after = np.r_[solid[1:], False]
    return np.flatnonzero(solid & (~before | edge[:-1])), np.flatnonzero(solid & (~after | edge[1:])) + 1


def hashed(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, piece: int) -> np.ndarray:
    """A 64-bit hash of each word, in pieces of the text."""
    out = np.zeros(len(begin), np.uint64)
    longest = int((end - begin).max()) if len(begin) else 0
    power = np.cumprod(np.r_[np.uint64(1), np.full(longest, BASE)])
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(end, begin[at] + piece)))
        size = end[at:stop] - begin[at:stop]
        first = np.cumsum(size) - size
        nth = np.arange(size.sum()) - np.repeat(first, size)
        letters = BYTES[raw[np.repeat(begin[at:stop], size) + nth]] * power[nth]
        out[at:stop] = np.add.reduceat(letters, first)
        at = stop
    return mixed(out)


def anchors(words: np.ndarray, last: np.ndarray, settings: PassageSettings):
    """Anchor hash, first window and number of windows of every passage.

    ``words`` are the hashes of texts laid end to end, ``last`` the end of each word's text.
    A window belongs to the leftmost of its grams with the smallest hash."""
    gram, size = words, 1
    rest = settings.gram
    joined, done = None, 0  # grams of any length, from those of doubled lengths
    while rest:
        if rest & 1:
            part = gram[done : len(words)] if done else gram
            joined = part if joined is None else joined[: len(part)] * BASE + part
            done += size
        rest >>= 1
        if rest:
            gram = gram[: max(0, len(gram) - size)] * (BASE + np.uint64(2 * size)) + gram[size:]
            size *= 2
    value = mixed(joined)
    reach = settings.window - settings.gram + 1
    place, width = np.arange(len(value)), 1

    def smaller(shift):
        left, right = slice(0, max(0, len(value) - shift)), slice(shift, None)
        take = value[right] < value[left]
        return np.where(take, value[right], value[left]), np.where(take, place[right], place[left])

    while 2 * width <= reach:
        value, place = smaller(width)
        width *= 2
    if width < reach:
        value, place = smaller(reach - width)
    starts = np.arange(len(value))
    whole = starts + settings.window <= last[: len(value)]
    starts, value, place = starts[whole], value[whole], place[whole]
    run = np.flatnonzero(np.diff(place, prepend=-1))
    return value[run].view(np.int64), starts[run], np.diff(np.r_[run, len(starts)])


def texts_of(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first and last row, their bytes, where each
    text begins and the last ends."""
    column, at = batch.column("text").cast(pa.large_binary()), 0
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        stop = min(stop, len(column))
        yield at, stop, data[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at]
        at = stop


def passages_of(raw: np.ndarray, ends: np.ndarray, settings: PassageSettings):
    """Bounds of the words, first word of each text, row of each passage, and anchors()."""
    begin, end = word_bounds(raw, ends[:-1][ends[:-1] < len(raw)])
    edges = np.searchsorted(begin, ends)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(edges))
    anchor, first, windows = anchors(hashed(raw, begin, end, settings.piece), edges[1:][row], settings)
    return begin, end, edges, row[first], anchor, first, windows


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (bytes; null: empty) and a key of the text, as ids may repeat."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))


def shared_anchors(texts: DataFrame, settings: PassageSettings) -> DataFrame:
    """doc_id, text_key, anchors: those that another document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, raw, ends in texts_of(batch, settings.piece):
                *_, row, anchor, _, _ = passages_of(raw, ends, settings)
                found = pd.DataFrame({"row": row + at, "anchor": anchor}).drop_duplicates()
                rows = pa.array(found["row"].to_numpy())
                columns = [batch.column("doc_id").take(rows), batch.column("text_key").take(rows), pa.array(found["anchor"])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "anchor"])

    named = texts.where("doc_id IS NOT NULL")
    found = written(named.mapInArrow(run, "doc_id long, text_key long, anchor long"), "anchors")
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = shared.where("least < most").select("anchor")
    return found.join(shared, "anchor").groupBy("doc_id", "text_key").agg(F.collect_set("anchor").alias("anchors"))


def passages(texts: DataFrame, wanted: DataFrame, settings: PassageSettings) -> DataFrame:
    """doc_id, text_key, start, digest, anchor, n_words, words of every passage of a wanted
    anchor. A task gives the words of equal passages once, as far as it remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = BoundedCache(500_000)
        for batch in batches:
            asked = batch.column("anchors")
            for at, stop, raw, ends in texts_of(batch, settings.piece):
                begin, end, edges, row, anchor, first, windows = passages_of(raw, ends, settings)
                here = asked.slice(at, stop - at).flatten().to_numpy()
                keep = np.flatnonzero(np.isin(anchor, here))
                row, anchor, first, windows = row[keep], anchor[keep], first[keep], windows[keep]
                until = first + windows + settings.window - 1
                data, digests, texts = raw.tobytes(), [], []
                for a, b in zip(begin[first].tolist(), end[until - 1].tolist()):
                    text = b" ".join(data[a:b].split())
                    digests.append(digest := blake2b(text, digest_size=16).digest())
                    texts.append(None if digest in seen else text)
                    seen.put(digest, True)
                rows = pa.array(row + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows), batch.column("text_key").take(rows),
                        pa.array(first - edges[row], pa.int64()), pa.array(digests, pa.binary()), pa.array(anchor, pa.int64()),
                        pa.array(until - first, pa.int64()), pa.array(texts, pa.binary()),
                    ],
                    ["doc_id", "text_key", "start", "digest", "anchor", "n_words", "words"],
                )

    asked = texts.join(wanted, ["doc_id", "text_key"])
    schema = "doc_id long, text_key long, start long, digest binary, anchor long, n_words long, words binary"
    return written(asked.select("doc_id", "text_key", "text", "anchors").mapInArrow(run, schema), "passages")


# The index ------------------------------------------------------------------------


class WaveletMatrix:
    """Ranks in a sequence of symbols, one plane of bits for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.depth = max(1, int(top).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        now = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            packed = np.packbits(np.r_[bit, np.zeros(-len(bit) % 64 + 64, bool)], bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.ones.append(np.r_[0, np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            self.zeros.append(int(len(bit) - np.count_nonzero(bit)))
            now = np.concatenate([now[~bit], now[bit]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbols before ``at`` lead on the lowest plane."""
        for plane, level in enumerate(range(self.depth - 1, -1, -1)):
            word, low = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[plane][word] & ((np.uint64(1) << low) - np.uint64(1))
            ones = self.ones[plane][word] + np.bitwise_count(below)
            at = np.where((symbol >> level) & 1, self.zeros[plane] + ones, at - ones)
        return at


class PassageIndex:
    """FM-index of passages of word numbers (1, 2, …), each ended by a mark of its own."""

    def __init__(self, coded: list[np.ndarray], owner: np.ndarray, top: int, window: int):
        sizes = np.array([len(c) for c in coded], np.int64)
        n, marks = int(sizes.sum() + len(coded)), len(coded)
        text = np.zeros(n, np.int64)  # marks are 0
        text[np.arange(n - marks) + np.repeat(np.arange(marks), sizes)] = np.concatenate(coded)
        mark = np.cumsum(sizes + 1) - 1
        rank = text + marks - 1
        rank[mark] = np.arange(marks)  # all marks differ, so no match goes past one
        ranks, span = [], 1
        order = None
        while True:
            ranks.append(rank.astype(np.int32))
            key = rank * (n + 1)
            key[: n - span] += rank[span:] + 1
            order = np.argsort(key)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
            span *= 2
            if span > sizes.max(initial=0) or rank[order[-1]] == n - 1:
                break
        self.n = n
        # Common prefix of each suffix with the one before it; -1 at both ends.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            same = ranks[level][a] == ranks[level][b]
            common += same * (1 << level)
            a, b = np.minimum(a + same * (1 << level), n - 1), np.minimum(b + same * (1 << level), n - 1)
        self.common = np.r_[-1, common, -1]
        self.jumps: list[np.ndarray] | None = None
        before = text[order - 1]  # the first suffix is preceded by the last mark, also 0
        self.tree = WaveletMatrix(before, top)
        count = np.bincount(text, minlength=top + 2)
        self.first = np.r_[0, np.cumsum(count)][: top + 1]  # suffixes that begin with a smaller symbol
        self.low = self.tree.place(np.arange(top + 1), np.zeros(top + 1, np.int64))
        # The smallest owner in the range of a suffix's first ``window`` words.
        held = owner[np.searchsorted(mark, order)]
        runs = np.flatnonzero(self.common[:-1] < window)
        self.least = np.minimum.reduceat(held, runs)[np.cumsum(self.common[:-1] < window) - 1]

    def extended(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that begin with the symbol and go on as those of lo..hi."""
        at = self.tree.place(np.r_[symbol, symbol], np.r_[lo, hi]) - np.r_[self.low[symbol], self.low[symbol]]
        at += np.r_[self.first[symbol], self.first[symbol]]
        return at[: len(symbol)], at[len(symbol) :]

    def widened(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider ranges, and the length of the prefix that they share."""
        if self.jumps is None:  # minima of 1, 2, 4, … neighbours
            self.jumps = [np.minimum(self.common, 32767).astype(np.int16)]
            while 2 ** len(self.jumps) <= len(self.common):
                half, last = 2 ** (len(self.jumps) - 1), self.jumps[-1]
                self.jumps.append(np.minimum(last[:-half], last[half:]))
        depth = np.maximum(self.common[lo], self.common[hi])
        for level in range(len(self.jumps) - 1, -1, -1):
            step, least = 2**level, self.jumps[level]
            from_ = lo - step + 1
            lo = np.where((from_ >= 0) & (least[np.maximum(from_, 0)] >= depth), lo - step, lo)
            hi = np.where((hi < len(least)) & (least[np.minimum(hi, len(least) - 1)] >= depth), hi + step, hi)
        return lo, hi, depth

    def matches(self, coded: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics from the right: passage, place, length and smallest owner,
        for each place where a match of ``window`` words or more begins. Word number 0 is
        a word that the index has not."""
        sizes = np.array([len(c) for c in coded], np.int64)
        flat, base = np.concatenate(coded), np.cumsum(sizes) - sizes
        who, k = np.arange(len(coded)), sizes.copy()
        lo, hi, length = np.zeros(len(coded), np.int64), np.full(len(coded), self.n), np.zeros(len(coded), np.int64)
        while True:
            # No window ends before the end of the match that goes on.
            going = (k > 0) & (k + length >= window)
            if not going.all():
                who, k, lo, hi, length = who[going], k[going], lo[going], hi[going], length[going]
            if not len(who):
                return
            symbol = flat[base[who] + k - 1]
            new_lo, new_hi = self.extended(symbol, lo, hi)
            hit = (new_lo < new_hi) & (symbol > 0)
            lost = np.flatnonzero(symbol == 0)  # nothing goes on over such a word
            stuck = np.flatnonzero(~hit & (symbol > 0))
            lo, hi = np.where(hit, new_lo, lo), np.where(hit, new_hi, hi)
            length, k = length + hit, k - hit
            lo[lost], hi[lost], length[lost], k[lost] = 0, self.n, 0, k[lost] - 1
            if len(stuck):
                lo[stuck], hi[stuck], length[stuck] = self.widened(lo[stuck], hi[stuck])
            found = np.flatnonzero(hit & (length >= window))
            if len(found):
                yield who[found], k[found], length[found], self.least[lo[found]]


def searched(contents: DataFrame, n_shards: int, settings: PassageSettings) -> DataFrame:
    """digest, runs: windows (offset, number) of a passage and the smallest id that has them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        least = frame.groupby("anchor")["least"].transform("min").to_numpy()
        most = frame.groupby("anchor")["most"].transform("max").to_numpy()
        indexed = np.flatnonzero(frame["least"].to_numpy() < most)  # a later document may repeat it
        streamed = np.flatnonzero(frame["most"].to_numpy() > least)  # an earlier one may have it
        empty = pd.DataFrame({"digest": [], "runs": []})
        if not len(indexed) or not len(streamed):
            return empty
        numbers: dict[bytes, int] = {}
        words = frame["words"].tolist()
        stored = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in words[i].split(b" ")], np.int64) for i in indexed]
        index = PassageIndex(stored, frame["least"].to_numpy()[indexed], len(numbers), settings.window)
        asked = [np.array([numbers.get(w, 0) for w in words[i].split(b" ")], np.int64) for i in streamed]
        found = [np.stack([who, k, owner]) for who, k, _, owner in index.matches(asked, settings.window)]
        if not found:
            return empty
        who, k, owner = np.concatenate(found, axis=1)
        order = np.lexsort((k, who))
        who, k, owner = who[order], k[order], owner[order]
        new = np.flatnonzero((np.diff(who, prepend=-1) != 0) | (np.diff(k, prepend=-2) != 1) | (np.diff(owner, prepend=-1) != 0))
        count = np.diff(np.r_[new, len(who)])
        runs = pd.DataFrame({"who": who[new], "run": list(zip(k[new].tolist(), count.tolist(), owner[new].tolist()))})
        runs = runs.groupby("who")["run"].agg(list)
        return pd.DataFrame({"digest": frame["digest"].to_numpy()[streamed[runs.index.to_numpy()]], "runs": runs.to_numpy()})

    shard = F.pmod(F.xxhash64("anchor"), F.lit(n_shards)).alias("shard")
    dealt = contents.select(shard, "digest", "anchor", "least", "most", "words").repartition(n_shards, "shard")
    return dealt.groupBy("shard").applyInPandas(run, "digest binary, runs array<struct<offset:long,n:long,least:long>>")


def by_window(contents: DataFrame, settings: PassageSettings) -> DataFrame:
    """What searched() returns, for passages of hot anchors: equal windows are grouped."""
    words = F.split(F.col("words").cast("string"), " ")
    size = settings.window
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_words") - size)).alias("offset")
    windows = contents.select("digest", "least", words.alias("all"), at)
    text = F.array_join(F.slice("all", (F.col("offset") + 1).cast("int"), size), " ")
    windows = windows.select("digest", "offset", "least", F.sha2(text, 256).alias("window"))
    first = windows.groupBy("window").agg(F.min("least").alias("first"))
    found = windows.join(first, "window")
    run = F.struct("offset", F.lit(1).cast("long").alias("n"), F.col("first").alias("least"))
    return found.groupBy("digest").agg(F.collect_list(run).alias("runs"))


# The operator ---------------------------------------------------------------------


def repeated_spans(docs: DataFrame, settings: PassageSettings = SETTINGS) -> DataFrame:
    """doc_id, text_key, spans: the stretches of words (from, until), which may overlap, that
    a document with a smaller id has too, by whole windows.

    ``text_key`` is ``xxhash64`` of the text, as ids may repeat; rows with the same id don't
    repeat each other. Rows without id neither have spans nor give any. Texts that are null,
    empty or shorter than a window have none. Only doc_id and text are read.
    """
    texts = keyed(docs).where("doc_id IS NOT NULL")
    found = passages(texts, shared_anchors(texts, settings), settings)
    contents = found.groupBy("digest").agg(
        F.min("anchor").alias("anchor"), F.min("n_words").alias("n_words"), F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"), F.max("words").alias("words"),
    )
    contents = written(contents, "contents")
    total = contents.agg(F.sum("n_words")).first()[0] or 0
    n_shards = max(1, -(-total // settings.shard_words))
    hot = contents.groupBy("anchor").agg(F.sum("n_words").alias("held")).where(F.col("held") > settings.hot_words).select("anchor")
    hot = written(hot, "hot_anchors")
    cold = contents.join(hot, "anchor", "left_anti")
    runs = searched(cold, n_shards, settings).union(by_window(contents.join(hot, "anchor", "left_semi"), settings))
    earlier = F.filter("runs", lambda r: r["least"] < F.col("doc_id"))
    spans = F.transform(
        earlier,
        lambda r: F.struct(
            (F.col("start") + r["offset"]).alias("from"),
            (F.col("start") + r["offset"] + r["n"] + settings.window - 1).alias("until"),
        ),
    )
    members = found.select("doc_id", "text_key", "start", "digest").join(written(runs, "runs"), "digest")
    members = members.select("doc_id", "text_key", spans.alias("spans")).where(F.size("spans") > 0)
    return members.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def without_repeats(docs: DataFrame, settings: PassageSettings = SETTINGS) -> DataFrame:
    """doc_id, n_words, n_removed and kept (bytes: the words left, with one space between)
    of every row. Words are parted by ASCII white space and otherwise unchanged. Null texts
    count as empty. What is left is not judged again."""

    def left(words: list[bytes], spans) -> list[bytes]:
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, [s["from"] for s in spans], 1)
        np.add.at(edge, [s["until"] for s in spans], -1)
        return [w for w, covered in zip(words, np.cumsum(edge[:-1]).tolist()) if not covered]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop, *_ in texts_of(batch, 4 * settings.piece):
                part = batch.slice(at, stop - at)
                texts = [text.split() for text in part.column("text").to_pylist()]
                kept = [left(w, s) if s else w for w, s in zip(texts, part.column("spans").to_pylist())]
                removed = [len(w) - len(k) for w, k in zip(texts, kept)]
                columns = [pa.array([len(w) for w in texts], pa.int64()), pa.array(removed, pa.int64())]
                columns += [pa.array([b" ".join(k) for k in kept], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept"])

    spans = repeated_spans(docs, settings)
    rows = keyed(docs).join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def kept_digests(docs: DataFrame, settings: PassageSettings = SETTINGS) -> DataFrame:
    """``without_repeats`` with the SHA-256 of what is kept in place of it."""
    rows = without_repeats(docs, settings)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
