"""Tokens against the libraries that define them."""

import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tessella.llm import bpe_codec, token_counts  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "<|endoftext|>", "<|endof", "'ll", "'re", "'", "  ", "\n\n", " ", "\t" * 90, " " * 300, "a" * 700, "1" * 150,
    "|" * 200, "é", "漢", "🤗", "▁", "the", "ab" * 400, "hello world", "<s>", "<0x0A>", "theeeee", "\x00",
]


def texts(n, seed=5):
    rnd = random.Random(seed)
    mixed = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]
    runs = ["".join(rnd.choice("abcdethengiosr") for _ in range(3000)) for _ in range(5)]
    return [*mixed, *runs, "", " ", "  "]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.mark.parametrize("chunk", [40, 333, 65_536])
def test_encoder_gives_the_librarys_tokens_for_any_chunks(library, monkeypatch, chunk):
    monkeypatch.setattr(bpe_codec, "CHUNK_CHARS", chunk)
    model = bpe_codec.BpeModel(BPE)
    for text in texts(150):
        want = library.encode(text, add_special_tokens=False).ids
        got = [t for run in bpe_codec.encode(model, text) for t in run]
        assert got == want
        decoder = bpe_codec.Decoder(model)
        back = "".join([*(decoder.feed([t]) for t in got), decoder.finish()])
        assert back == library.decode(want, skip_special_tokens=False) == text


def test_a_stream_holds_one_window(library):
    model = bpe_codec.BpeModel(BPE)
    stream, text = bpe_codec.ByteStream(model), "".join(random.Random(1).choice("abcdetn") for _ in range(20_000))
    got = []
    for at in range(0, len(text), 100):
        got += stream.feed(text[at : at + 100].encode())
        assert len(stream.held) <= model.window
    assert [*got, *stream.finish()] == library.encode(text).ids


def test_code_digests(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(texts(20))] + [(900, None, None), (None, "a b", "x"), (1, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe_codec.code_digests(df, BPE).collect()
    want = []
    for doc, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe_codec.code_digests(df.limit(0), BPE).count() == 0
    back = bpe_codec.decoded(bpe_codec.encoded(df, BPE), BPE, "back").collect()
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert bpe_codec.tokenised(df, BPE).columns == ["doc_id", "n_tokens", "tokens", "decoded_sha256"]


def test_results_go_on_in_bounded_batches(library):
    import pyarrow as pa

    model = bpe_codec.BpeModel(BPE)
    rows = [*texts(60), "", "one more"]
    batch = pa.RecordBatch.from_arrays([pa.array(rows), pa.array([[i] for i in range(len(rows))])], ["text", "of"])
    parts = list(bpe_codec.coded(model, batch, 700))
    want = [library.encode(t, add_special_tokens=False).ids for t in rows]
    assert len(parts) > 3 and all(len(p["tokens"].flatten()) < 700 + max(map(len, want)) for p in parts)
    got = pa.Table.from_batches(parts).to_pylist()
    assert [r["of"] for r in got] == [[i] for i in range(len(rows))]
    assert [r["tokens"] for r in got] == want and [r["n_tokens"] for r in got] == [len(x) for x in want]
    assert [r["decoded_sha256"] for r in got] == [sha(t) for t in rows]
    assert list(bpe_codec.coded(model, batch.slice(0, 0))) == []


def test_the_codecs_cache_is_small_and_keeps_what_is_asked_for():
    model = bpe_codec.BpeModel(BPE)
    model.cache = type(model.cache)(1000)
    for i in range(5000):
        model.whole(" often")
        model.whole(f" x{i}")
        assert len(model.cache) + len(model.cache.older) <= 1000
    assert " often" in model.cache or " often" in model.cache.older
    assert bpe_codec.CACHE_ENTRIES <= 200_000  # two workers have one each beside a full heap


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_piece_counts(spark):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t in enumerate(texts(300, 8))] + [(900, None), (0, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_counts.token_counts(df, PIECES, limit=100).collect()
    want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 100) for d, t in rows]
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_counts.token_counts(df.limit(0), PIECES).count() == 0


def test_a_full_cache_starts_anew():
    counter = token_counts.PieceCounter(PIECES, cache_entries=3)
    assert counter.count(["a b c d e f"]) == counter.count(["a b c d e f"])
    assert len(counter.cache) <= 3
