"""Byte-level BPE as a streaming transducer with bounded lookahead.

A text comes in chunks. The pre-tokenizer hands on what further text can't change,
and a pre-token's bytes become tokens once they are stable: whether a token ends at
some byte depends on a bounded number of bytes after it. That number follows from
the merge list (``sufficient_lookahead``), so an encoder holds one window of bytes
whatever the length of the text. Decoding is the reverse machine: bytes of tokens go
into an incremental UTF-8 decoder that hands on whole characters.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import AgingCache

# The published pre-tokenizer pattern of byte-level BPE.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Kinds of long pre-tokens: what their characters are, and what continues one.
KINDS = tuple(
    (regex.compile(one), regex.compile(more))
    for one, more in (
        (r"\p{L}", r"\p{L}+"),
        (r"\p{N}", r"\p{N}+"),
        (r"\s", r"\s+(?!\S)"),
        (r"[^\s\p{L}\p{N}]", r"[^\s\p{L}\p{N}]+"),
    )
)
# A pre-token is settled once this many characters follow it: 'll has three, and
# white space looks one character ahead.
SETTLED = 4
CHUNK_CHARS = 65_536
CACHE_ENTRIES = 200_000  # 200 bytes each, in every worker
HELD_TOKENS = 500_000  # a batch of results ends with the text that brings it to this many
CACHED_CHARS = 40
NEVER = (1 << 40, -1)


def byte_symbols() -> dict[int, str]:
    """The published byte alphabet: printable Latin-1 stands for itself, the other
    bytes are numbered upwards from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], size: dict[int, int]) -> int:
    """Bytes after a place that decide, at most, whether a token ends there.

    ``merges``: (left, right, result), best rank first. A merge (l, r) can be kept
    from happening by an earlier one that takes a token at r's right edge: r itself
    or a right part it was made of. Such a merge in turn hangs on still earlier ones
    at the edge of its own right token. Ranks fall along such a chain, so the longest
    one is found in one pass over the list.
    """
    right_edge: dict[int, tuple[int, ...]] = {}
    reach: dict[int, int] = {}  # by left token: bytes after it that merges so far can look at
    farthest = 0
    for left, right, result in merges:
        edge = right_edge.get(right, (right,))
        looks = size[right] + max((reach.get(token, 0) for token in edge), default=0)
        reach[left] = max(reach.get(left, 0), looks)
        farthest = max(farthest, looks)
        right_edge[result] = (result, *edge)
    return farthest


class BpeModel:
    """The merge list, vocabulary and special tokens of a tokenizer file."""

    def __init__(self, file: str, cache_entries: int = CACHE_ENTRIES):
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        symbols = byte_symbols()
        byte_of = {symbol: byte for byte, symbol in symbols.items()}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.first = [vocab[symbols[b]] for b in range(256)]
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.merge = {(a, b): (rank, new) for rank, (a, b, new) in enumerate(merges)}
        size = {i: len(raw) for i, raw in self.bytes_of.items()}
        self.lookahead = sufficient_lookahead(merges, size)
        # Enough to settle at least as many bytes as are looked ahead.
        self.window = 2 * self.lookahead + max(size.values())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.decimal = [str(i) for i in range(max(self.bytes_of) + 1)]
        self.cache = AgingCache(cache_entries)

    def tokens(self, raw: bytes) -> list[int]:
        """Tokens of a window: the best-ranked pair, the leftmost of equals, is
        merged until none is left."""
        parts, get, none = [self.first[b] for b in raw], self.merge.get, NEVER
        pairs = [get(pair, none) for pair in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            at = pairs.index(best)
            new = parts[at] = best[1]
            del parts[at + 1], pairs[at]
            if at:
                pairs[at - 1] = get((parts[at - 1], new), none)
            if at < len(pairs):
                pairs[at] = get((new, parts[at + 1]), none)
        return parts

    def whole(self, piece: str) -> Sequence[int]:
        """Tokens of a complete pre-token."""
        found = self.cache.get(piece) or self.cache.recall(piece)
        if found:
            return found
        if len(piece) <= CACHED_CHARS:
            return self.cache.put(piece, tuple(self.tokens(piece.encode("utf-8", "replace"))))
        stream = ByteStream(self)
        return [*stream.feed(piece.encode("utf-8", "replace")), *stream.finish()]


class ByteStream:
    """The bytes of one pre-token in, stable tokens out; holds at most a window."""

    def __init__(self, model: BpeModel):
        self.model, self.held = model, b""

    def feed(self, raw: bytes) -> Iterator[int]:
        window, lookahead = self.model.window, self.model.lookahead
        raw = self.held + raw
        start = 0
        while len(raw) - start >= window:
            seen, end = raw[start : start + window], 0
            for token in self.model.tokens(seen):
                end += len(self.model.bytes_of[token])
                if end + lookahead > window:
                    break
                start += len(self.model.bytes_of[token])
                yield token
        self.held = raw[start:]

    def finish(self) -> Iterator[int]:
        yield from self.model.tokens(self.held)
        self.held = b""


class Encoder:
    """Text in chunks in, lists of stable tokens out.

    ``feed`` and ``finish`` give the same tokens for any chunking. A special token's
    string stands for that token. What is held is the unsettled end of the text and,
    within a pre-token longer than a chunk, one window of its bytes.
    """

    def __init__(self, model: BpeModel):
        self.model, self.held = model, ""
        self.open: ByteStream | None = None  # the pre-token that goes on
        self.goes_on: regex.Pattern | None = None
        self.longest = max(map(len, model.special), default=1)

    def feed(self, chunk: str) -> Iterator[list[int]]:
        text = self.held + chunk
        start = 0
        for special in self.model.special_pattern.finditer(text):
            yield from self._plain(text[start : special.start()], True)
            yield [self.model.special[special[0]]]
            start = special.end()
        self.held = text[start:]
        if len(self.held) >= CHUNK_CHARS:
            # The end may begin a special token's string: that much stays back.
            keep = self.longest + SETTLED
            ready, self.held = self.held[:-keep], self.held[-keep:]
            for tokens in self._plain(ready, False):
                yield tokens

    def finish(self) -> Iterator[list[int]]:
        yield from self._plain(self.held, True)
        self.held = ""

    def _plain(self, text: str, ends: bool) -> Iterator[list[int]]:
        """Tokens of text without special tokens; ``ends``: nothing follows it.
        What is not settled goes back in front of ``held``."""
        at = 0
        if self.open:
            more = self.goes_on.match(text)
            upto = more.end() if more else 0
            if upto == len(text) and not ends:
                upto = max(0, upto - SETTLED)
                yield [*self.open.feed(text[:upto].encode("utf-8", "replace"))]
                self.held = text[upto:] + self.held
                return
            yield [*self.open.feed(text[:upto].encode("utf-8", "replace")), *self.open.finish()]
            self.open, at = None, upto
        if ends:
            whole, cached = self.model.whole, self.model.cache.get
            yield [t for p in PRE_TOKEN.findall(text, at) for t in cached(p) or whole(p)]
            return
        settled, tokens = len(text) - SETTLED, []
        for piece in PRE_TOKEN.finditer(text, at):
            if piece.end() > settled:
                break
            tokens += self.model.whole(piece[0])
            at = piece.end()
        yield tokens
        if len(text) - at > CHUNK_CHARS // 2:
            # One pre-token fills the buffer: its bytes go on into an open stream.
            upto = len(text) - SETTLED
            self.open = ByteStream(self.model)
            self.goes_on = next(more for one, more in KINDS if one.match(text, upto - 1))
            yield [*self.open.feed(text[at:upto].encode("utf-8", "replace"))]
            at = upto
        self.held = text[at:] + self.held


class Decoder:
    """Tokens in, text out: bytes wait until they make whole characters."""

    def __init__(self, model: BpeModel):
        self.bytes_of = model.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, tokens: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, tokens)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


def chunks(text: str) -> Iterator[str]:
    for at in range(0, len(text), CHUNK_CHARS):
        yield text[at : at + CHUNK_CHARS]


def encode(model: BpeModel, text: str) -> Iterator[list[int]]:
    """The token stream of a text, in runs."""
    encoder = Encoder(model)
    for chunk in chunks(text):
        yield from encoder.feed(chunk)
    yield from encoder.finish()


def digest(model: BpeModel, text: str, tokens: list[int] | None = None) -> tuple[int, str, str]:
    """Number of tokens, SHA-256 of the ids and of the decoded text, run by run.
    ``tokens``: a list that takes the ids, if they are wanted."""
    ids, decoded, decoder, n = hashlib.sha256(), hashlib.sha256(), Decoder(model), 0
    for run in encode(model, text):
        if run:
            ids.update(("," * (n > 0) + ",".join(map(model.decimal.__getitem__, run))).encode())
            decoded.update(decoder.feed(run).encode())
            n += len(run)
            if tokens is not None:
                tokens += run
    decoded.update(decoder.finish().encode())
    return n, ids.hexdigest(), decoded.hexdigest()


MODELS: dict[str, BpeModel] = {}


def loaded(file: str) -> BpeModel:
    """A worker's own copy of the model, kept between tasks."""
    if file not in MODELS:
        MODELS[file] = BpeModel(file)
    return MODELS[file]


def encoded(docs: DataFrame, file: str) -> DataFrame:
    """All columns of ``docs``, and ``tokens``: the ids of each whole text.

    A null text counts as empty and gives an empty list. A column of the input that
    is called ``tokens`` gives way.
    """

    @F.pandas_udf("array<int>")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loaded(file)
        for batch in texts:
            yield pd.Series([[t for run in encode(model, x) for t in run] for x in batch])

    return docs.withColumn("tokens", tokens(F.coalesce("text", F.lit(""))))


def decoded(docs: DataFrame, file: str, column: str = "text") -> DataFrame:
    """``column`` becomes the text of each row's ``tokens``; null tokens give null."""

    @F.pandas_udf("string")
    def text(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loaded(file)
        for batch in rows:
            out = []
            for ids in batch:
                decoder = Decoder(model)
                out.append(None if ids is None else decoder.feed(ids.tolist()) + decoder.finish())
            yield pd.Series(out, dtype=object)

    return docs.withColumn(column, text("tokens"))


def code_digests(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.

    One row per input row, repeated rows included; a null text counts as empty (no
    tokens, digests of nothing). Other columns are not read. Row-wise, no shuffle.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(file)
        for frame in frames:
            n, ids, text = zip(*(digest(model, x) for x in frame["text"])) if len(frame) else ((), (), ())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": text})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenised(docs: DataFrame, file: str) -> DataFrame:
    """All columns of ``docs`` but the text, its tokens in their place: n_tokens, tokens,
    and decoded_sha256 of the text that the tokens give back.

    A null text counts as empty. Columns of these names in the input give way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(file)
        for batch in batches:
            yield from coded(model, batch)

    # The text goes first, the row behind it, so that no other name clashes.
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "tokens", "decoded_sha256")]
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType(rows.schema.fields[1:])
    schema = schema.add("n_tokens", T.LongType()).add("tokens", T.ArrayType(T.IntegerType())).add("decoded_sha256", T.StringType())
    return rows.mapInArrow(run, schema)


def coded(model: BpeModel, batch: pa.RecordBatch, held_tokens: int = HELD_TOKENS) -> Iterator[pa.RecordBatch]:
    """The batch without its first column, and of that column's texts n_tokens, tokens and
    decoded_sha256. Results go on before more than about ``held_tokens`` are held."""
    names = [*batch.schema.names[1:], "n_tokens", "tokens", "decoded_sha256"]
    begin, flat, sizes, digests = 0, array("i"), [], []
    for nth, text in enumerate(batch.column(0), 1):
        ids: list[int] = []
        n, _, decoded = digest(model, text.as_py(), ids)
        flat.extend(ids)
        sizes.append(n)
        digests.append(decoded)
        if len(flat) >= held_tokens or nth == batch.num_rows:
            ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
            tokens = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(flat, np.int32)))
            rows = batch.slice(begin, nth - begin).columns[1:]
            new = [pa.array(sizes, pa.int64()), tokens, pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*rows, *new], names)
            begin, flat, sizes, digests = nth, array("i"), [], []
