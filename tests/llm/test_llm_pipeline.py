"""Every stage of the pipeline, and the classifier's fit, against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import tokenizers
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_llm_documents import PLAIN, plain_spans
from test_llm_near_dedup import brute
from test_llm_pii import plain_rounds

import corpus_pipeline
from tessella.llm import bpe_codec, quality
from tessella.llm.catalog import tokenizer

FOLDER = str(TESTDATA / "sf0.001")


def direct_scores(rows, labels, settings=quality.SETTINGS):
    """Score of each (id, text): the fit in one piece, isotonic by pooling neighbours."""
    marks = collections.defaultdict(list)
    for i, label in labels:
        marks[i].append(label)
    stats = np.array([quality.statistics(t or "") for _, t in rows])
    fold = np.array([zlib.crc32(str(i).encode()) % 5 if i in marks else 0 for i, _ in rows])
    target = np.array([np.mean(marks[i]) if i in marks else 0.0 for i, _ in rows])
    mean, std = stats[fold > 0].mean(axis=0), stats[fold > 0].std(axis=0)
    draw = np.random.default_rng(settings.seed)
    frequency = draw.normal(size=(stats.shape[1], settings.features)) / settings.bandwidth
    phase = draw.uniform(0, 2 * np.pi, settings.features)
    scaled = np.clip((stats - mean) / np.where(std > 1e-9, std, 1.0), -6, 6)
    z = np.c_[math.sqrt(2 / settings.features) * np.cos(scaled @ frequency + phase), np.ones(len(rows))]
    train = z[fold > 1]
    penalty = np.diag([settings.ridge * len(train)] * settings.features + [1e-9])
    raw = z @ np.linalg.solve(train.T @ train + penalty, train.T @ target[fold > 1])
    bins = collections.defaultdict(list)
    for r, y in zip(raw[fold == 1], target[fold == 1]):
        bins[math.floor(min(max(r, -0.5), 1.5) * settings.bins) / settings.bins].append(y)
    pools = []  # sum, weight, bins
    for x in sorted(bins):
        pools.append([sum(bins[x]), len(bins[x]), [x]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    xs = [x for p in pools for x in p[2]]
    return np.interp(raw, xs, [p[0] / p[1] for p in pools for _ in p[2]])


def test_fit_against_one_in_one_piece(spark):
    folder = str(TESTDATA / "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    more = [(docs.first()["doc_id"], "again " * 9), (None, "x"), (5_000_000, None), (5_000_001, "long word " * 400_000)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = direct_scores(rows, [(r["doc_id"], r["quality"]) for r in labels.collect()])
    clashing = docs.withColumn("stats", F.lit("x")).withColumn("raw", F.lit(1)).withColumn("target", F.lit("y"))
    got = quality.quality_scores(clashing.repartition(7), labels).collect()
    key = lambda i, s: (-1 if i is None else i, s)
    got, want = sorted(key(r["doc_id"], r["score"]) for r in got), sorted(key(i, s) for (i, _), s in zip(rows, want))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-6)


def plain_redacted(rows):
    more = plain_rounds(rows)
    out = []
    for row, (i, text) in enumerate(rows):
        if text is not None:
            at, parts = 0, []
            for start, end, kind in sorted((a, b, k) for r, k, a, b in more if r == row):
                if start >= at:
                    parts += [text[at:start], f"[{kind.upper()}]"]
                    at = end
            text = "".join(parts) + text[at:]
            for kind, pattern in PLAIN.items():
                whole = lambda m: f"{kind}:0:{len(m[0])}" in plain_spans(m[0]).split(",")  # noqa: B023, E731
                text = re.sub(pattern, lambda m: f"[{kind.upper()}]" if whole(m) else m[0], text)  # noqa: B023
        out.append((i, text))
    return out


def plain_copies(rows, repeats=1.5):
    """doc_id -> copies, sources of one block each: (id, text, source)."""
    draw = lambda *x: int(hashlib.md5(":".join(x).encode()).hexdigest()[:13], 16)
    sources = collections.defaultdict(list)
    for i, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        turn = draw("turn", source or "", "" if i is None else str(i))
        sources[source or ""].append((turn, -1 if i is None else i, n))
    total = sum(n for held in sources.values() for _, _, n in held)
    share = {s: sum(n for _, _, n in held) / total for s, held in sources.items()}
    logs = [math.log(x) for x in share.values() if x > 0]
    spread = max(logs) - min(logs)
    a = max(0.0, 1 - math.log(repeats) / spread) if spread else 0.0
    power = {s: math.exp(math.log(x) * a) if x > 0 else 0.0 for s, x in share.items()}
    least = min(power[s] / share[s] for s in share if share[s] > 0)
    copies = {}
    for s, held in sources.items():
        passes = round(power[s] / (share[s] * least), 9) if share[s] > 0 else 1.0
        whole, spent = math.floor(passes), 0
        rest = (passes - whole) * sum(n for _, _, n in held)
        for _, i, n in sorted(held):
            spent += n
            copies[i] = max(copies.get(i, 0), whole + (2 * spent - n <= 2 * rest and passes > whole))
    return copies


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = [r["text"] for r in docs.orderBy("doc_id").limit(4).collect()]
    near = first[1].split()
    near[3] = "otherword"
    planted = [(1000, first[0]), (1001, " ".join(near)), (0, first[0]), (1002, None), (None, first[2]), (None, "one two")]
    planted += [(2000 + i, f"{first[3]} {i} {i} and then write to mail: user{i}@x.org today " + f"w{i} " * 300) for i in range(8)]
    planted += [(2100, f"{first[2]} write to mail: room9 today " + "z " * 400)]
    more = spark.createDataFrame([(i, t, "en", "rare", len(t or "")) for i, t in planted], docs.schema)
    table = docs.union(more).repartition(6)
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    ordered = lambda rows: sorted(rows, key=str)
    stage = lambda name, df: corpus_pipeline.written(dict(corpus_pipeline.STAGES)[name](spark, df, FOLDER), name)

    rows = pairs(table)
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
    scores = direct_scores(rows, labels)
    table = stage("quality_classifier", table)
    assert ordered(pairs(table)) == ordered(x for x, s in zip(rows, scores) if s >= 0.3)

    rows, groups = pairs(table), {}
    for x, (_, least, group) in brute(rows).items():
        if group is not None and x[0] == least:
            groups[group] = x
    alone = [x for x in rows if brute([x])[x][2] is None]
    table = stage("minhash_near_dedup", table)
    assert ordered(pairs(table)) == ordered([*alone, *groups.values()])

    rows = pairs(table)
    table = stage("personal_data", table)
    assert ordered(pairs(table)) == ordered(plain_redacted(rows))
    assert table.where("n_chars <> length(text)").count() == 0

    rows = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
    copies = plain_copies(rows)
    table = stage("source_mixing", table)
    want = [(i, t) for i, t, _ in rows for _ in range(copies[-1 if i is None else i])]
    assert ordered(pairs(table)) == ordered(want) and len(want) > len(rows)

    model = tokenizers.Tokenizer.from_file(str(tokenizer("byte_bpe_50k.json")))
    want = [(i, model.encode(t or "", add_special_tokens=False).ids) for i, t in pairs(table)]
    got = stage("bpe_encoding", table).collect()
    assert ordered((r["doc_id"], r["tokens"]) for r in got) == ordered(want)


def test_columns_of_any_name_pass_the_encoding(spark):
    df = spark.createDataFrame([(1, "to be", "c", "r", 7)], "doc_id long, text string, coded string, row string, n_tokens int")
    got = bpe_codec.tokenised(df, tokenizer("byte_bpe_50k.json"))
    assert got.columns == ["doc_id", "coded", "row", "n_tokens", "tokens", "decoded_sha256"]
    row = got.first()
    assert (row["coded"], row["row"], row["n_tokens"]) == ("c", "r", len(row["tokens"]))
    assert row["decoded_sha256"] == hashlib.sha256(b"to be").hexdigest()
