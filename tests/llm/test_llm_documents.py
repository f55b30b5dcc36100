"""Near duplicates, personal data, quality, mixing, language model and search against
brute force, on fixtures that hold nulls, empty texts, ties and repeated rows."""

import collections
import hashlib
import math
import os
import random
import re
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tessella.llm import bm25_search, lm_score, mixing, near_dedup, pii, quality
from tessella.llm.common import word_hashes, written

SCHEMA = "doc_id long, text string, n long, component string"
FOLDER = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


# Near duplicates --------------------------------------------------------------


def linked(rows):
    """doc_id -> (size of its set, smallest id it reaches), over all pairs."""
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[a]:
                x, y = min(root[a], root[b]), max(root[a], root[b])
                root = {i: x if r == y else r for i, r in root.items()}
    return {i: (len(s), root[i]) for i, s in sets.items()}


def families(seed=3):
    """Copies with edits, some of them near the threshold, and chains of edits."""
    rnd, rows, at = random.Random(seed), [], 0
    for _ in range(12):
        text = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 8, 40, 120]))]
        for _ in range(rnd.choice([1, 3, 25])):
            copy = list(text)
            for _ in range(rnd.randint(0, max(1, len(copy) // 25))):
                copy[rnd.randrange(len(copy))] = f"e{rnd.randint(0, 9999)}"
            rows.append((at := at + 1, " ".join(copy)))
            if rnd.random() < 0.3:
                text = copy
    return rows + [(700, None), (701, ""), (702, " \t\n"), (703, "One two"), (704, "one TWO"), (705, "Ä one")]


@pytest.mark.parametrize("block", [4, 512])
def test_groups_are_those_of_all_pairs(spark, block):
    rows = families()
    got = near_dedup.groups(frame(spark, rows), replace(near_dedup.SETTINGS, block=block)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == linked(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_of_rows_without_id_and_of_no_rows(spark):
    df = frame(spark, [(None, "a b c"), (2, "a b c"), (1, "a b c"), (1, "a b c")])
    got = sorted(map(str, near_dedup.groups(df).select("doc_id", "component_id", "kept").collect()))
    assert got == sorted(
        ["Row(doc_id=None, component_id=None, kept=True)", "Row(doc_id=2, component_id=1, kept=False)"]
        + ["Row(doc_id=1, component_id=1, kept=True)"] * 2
    )
    assert near_dedup.groups(df.limit(0)).count() == 0
    assert near_dedup.one_of_each(df).columns == df.columns


# Personal data ----------------------------------------------------------------

# The plain expressions.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            luhn = sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
            if {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn,
                "phone": 9 <= len(digits) <= 15,
            }[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    rnd = random.Random(3)
    parts = [
        "a@b.c", "x_y@d-e.f.g+h@i.j", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.1.1.1", "4111 1111 1111 1111",
        "4111-1111-1111-1111", "4111  1111", "+1 (988) 555-2485", "+49 30 1234567 8", " ", "é", "漢🤗", "\n", ".", "-",
        "+", "@", "9", "12", "0" * 25, "a.b@", "(", "user@host.example.com.",
    ]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    rows += [(5000, None), (5001, " ".join(["a@b.c 1.2.3.4"] * 700)), (5002, "1" * 50_000), (5003, "a@" + "b." * 20_000 + "c")]
    got = pii.span_digests(frame(spark, rows)).collect()
    want = {i: plain_spans(t or "") for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r["base_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
        assert r["n_email"] == want[r["doc_id"]].count("email:")
    left = pii.redacted(frame(spark, rows)).collect()
    assert all("[EMAIL]" in r["text"] for r in left if r["doc_id"] == 5001)
    assert pii.span_digests(frame(spark, rows).limit(0)).count() == 0


def test_patterns_find_what_the_expressions_do_not(spark):
    rows = [(i, f"please write to mail: user{i}@x.org today") for i in range(30)]
    rows += [(100, "please write to mail: user7 today"), (200, "see section 7 of the 12 mails")]
    spans = {r["doc_id"]: r["spans"] for r in pii.span_digests(frame(spark, rows)).collect()}
    assert spans[100] == "email:22:27" and spans[200] == ""
    assert spans[3] == "email:22:33"
    texts = {r["doc_id"]: r["text"] for r in pii.redacted(frame(spark, rows)).collect()}
    assert texts[100] == "please write to mail: [EMAIL] today" == texts[3] and texts[200] == rows[-1][1]


# Quality ----------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = str(TESTDATA / "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows)
    assert right >= 0.9 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_without_labels_or_rows(spark):
    docs = frame(spark, [(1, None), (2, ""), (None, "a b"), (1, "x")])
    labels = spark.createDataFrame([(None, 1, "x"), (7, None, "x")], "doc_id long, quality int, text string")
    assert [r["score"] for r in quality.quality_scores(docs, labels).collect()] == [0.5] * 4
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert quality.accepted(docs, labels).count() == 4


# Mixing -----------------------------------------------------------------------


def mix_frame(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 else f"s{i % 4}") for i in range(600)]
    rows += [(900, None, None), (901, "", "empty"), (5, "w w", "big")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_meets_its_entropy(spark):
    df, settings = mix_frame(spark), mixing.MixSettings(entropy=0.98, block_docs=50)
    rows = mixing.plan(df, settings).collect()
    assert len(rows) == df.count()
    spent = collections.Counter()
    for r in rows:
        spent[r["source"]] += r["copies"] * r["n_tokens"]
    total = sum(spent.values())
    held = [v / total for s, v in spent.items() if v]
    live = sum(1 for s, v in spent.items() if v)
    assert -sum(p * math.log(p) for p in held) / math.log(live) == pytest.approx(0.98, abs=0.02)
    assert total == pytest.approx(sum(r["n_tokens"] for r in rows), rel=0.05)


def test_mixing_by_repetition_cuts_nothing(spark):
    df, settings = mix_frame(spark), mixing.MixSettings(entropy=None, repeats=1.5, block_docs=50)
    rows = mixing.plan(df, settings).collect()
    assert all(r["copies"] in (1, 2) for r in rows)
    assert all(r["copies"] == 1 for r in rows if r["source"] in ("big", "empty", ""))
    places = collections.Counter((r["source"], r["block"], r["place"]) for r in rows)
    assert max(places.values()) == 1
    mixed = mixing.mixed(df, settings)
    assert mixed.columns == df.columns and mixed.count() >= df.count()
    assert mixing.plan(df.limit(0), settings).count() == 0


def test_mixing_blocks_miss_their_budget_by_half_a_document(spark):
    rnd = random.Random(11)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 5, 40, 900])), "b" if i % 4 else "a", i) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copies long")
    df = df.withColumn("mix_copy", F.lit("x"))
    settings = mixing.MixSettings(entropy=None, repeats=1.5, block_docs=20)
    passes = {r["source"]: r["passes"] for r in mixing.weights(mixing.source_shares(mixing_counts(df)), settings).collect()}
    blocks = collections.defaultdict(list)
    for r in mixing.plan(df, settings).orderBy("place").collect():
        blocks[r["source"], r["block"]].append(r)
    assert len(blocks) > 4 and max(passes.values()) == pytest.approx(1.5, abs=0.01)
    for (source, _), held in blocks.items():
        whole = math.floor(passes[source])
        rest = (passes[source] - whole) * sum(r["n_tokens"] for r in held)
        extra = sum((r["copies"] - whole) * r["n_tokens"] for r in held)
        assert abs(extra - rest) <= max(r["n_tokens"] for r in held) / 2
    got = mixing.mixed(df, settings)  # columns of the names that it works with stay as they are
    assert got.columns == df.columns and got.where("mix_copies <> doc_id OR mix_copy <> 'x'").count() == 0


def mixing_counts(df):
    return df.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), mixing.words().alias("n_tokens"))


# Language model ---------------------------------------------------------------


def backoff_scores(rows, order, alpha=0.4):
    toks = {i: words(t) for i, t in rows}
    gram = lambda w, n: collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    all_ = [sum((gram(w, n) for w in toks.values()), collections.Counter()) for n in range(1, order + 1)]
    size, out = sum(map(len, toks.values())), {}
    for i, w in toks.items():
        own = [gram(w, n) for n in range(1, order + 1)]
        count = lambda g: all_[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        score = 0.0
        for p in range(len(w)):
            value = math.log(max(count((w[p],)), 1) / max(1, size - len(w)))
            for n in range(2, min(order, p + 1) + 1):
                g = tuple(w[p - n + 1 : p + 1])
                value = math.log(count(g) / count(g[:-1])) if count(g) > 0 and count(g[:-1]) > 0 else math.log(alpha) + value
            score += value
        out[i] = (len(w), score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff(spark, documents, order):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows += [(90001, None), (90002, ""), (90003, "one"), (90004, "The The the")]
    settings = lm_score.LmSettings(order=order, batch_words=9000)
    got = lm_score.scores(frame(spark, rows).repartition(5), settings).collect()
    want = backoff_scores(rows, order)
    assert len(got) == len(rows)
    for r in got:
        assert r["n_words"] == want[r["doc_id"]][0]
        assert r["log_score"] == pytest.approx(want[r["doc_id"]][1], rel=1e-9, abs=1e-9)
    assert lm_score.scores(frame(spark, rows).limit(0), settings).count() == 0


def test_backoff_of_repeated_rows_null_ids_and_a_long_text(spark):
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randint(0, 60)}" for _ in range(60_000))
    texts = ["a b c a b", "a b c a b", "a b d", "B C\x0bA", long, "\u00a0 a\u00a0b", "c a b", "c a b"]
    ids = [1, 1, 1, 2, 3, 4, None, None]  # rows alike in id and text, one id with two texts, no id
    got = lm_score.scores(frame(spark, list(zip(ids, texts))).repartition(3)).collect()
    want = backoff_scores(list(enumerate(texts)), 3)
    mine = sorted((str(r["doc_id"]), r["n_words"], round(r["log_score"], 5)) for r in got)
    assert mine == sorted((str(ids[i]), n, round(score, 5)) for i, (n, score) in want.items())


def test_backoff_in_passes_shuffles_a_part_of_the_ngrams_in_each(spark, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(40).collect()] + [(90001, "the the of"), (90002, None)]
    rows += [(7000 + i, t) for i, t in rows[:3]]
    size = sum(len(words(t)) for _, t in rows)
    settings = lm_score.LmSettings(batch_words=2000, count_passes=3, score_passes=2, pass_words=size // 3)
    assert settings.fitted(size) == settings and settings.fitted(0).count_passes == 1
    tables, paths = collections.defaultdict(list), []

    def kept(df, name):
        table = written(df, name)
        tables[name].append(table.select(table.columns[0]).toPandas().iloc[:, 0].tolist())
        if name == "ngram_counts":
            paths.extend(table.inputFiles())
        return table

    monkeypatch.setattr(lm_score, "written", kept)
    got = lm_score.scores(frame(spark, rows).repartition(3), settings).collect()
    want = backoff_scores(rows, 3)
    assert len(got) == len(rows)
    for r in got:
        assert r["log_score"] == pytest.approx(want[r["doc_id"]][1], rel=1e-9, abs=1e-9)
    # Every n-gram of two rows is counted in one pass, and the passes are about alike.
    of = collections.Counter()
    for _, t in rows:
        w = words(t)
        of.update({tuple(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)})
    hashes = [set(x) for x in tables["ngram_counts"]]
    assert len(hashes) == 3 and sum(map(len, hashes)) == len(set().union(*hashes)) == sum(n > 1 for n in of.values())
    assert max(map(len, hashes)) < 0.5 * sum(map(len, hashes))
    assert sorted(sum(tables["ngram_table"], [])) == sorted(set().union(*hashes))
    assert paths and not any(os.path.exists(x.removeprefix("file://")) for x in paths)  # not kept for the second half
    docs = [len(x) for x in tables["ngram_parts"]]
    assert len(docs) == 2 and sum(docs) == sum(any(of[(w,)] > 1 for w in words(t)) for _, t in rows) and min(docs) > 10


# Search -----------------------------------------------------------------------


@pytest.mark.parametrize("block", [4, 64])
def test_search_is_exact(spark, documents, block):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(900, None), (901, ""), (None, "the the")]
    settings = replace(bm25_search.SETTINGS, query_terms=None, shard_postings=5000, block=block, query_block=2000)
    df = frame(spark, rows)
    got = collections.defaultdict(list)
    for r in bm25_search.top_k(df, df.where("doc_id % 20 = 0"), 10, settings).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], round(r["score"], 7)))
    toks = {i: collections.Counter(words(t) if i is not None else []) for i, t in rows}
    size = {i: sum(c.values()) for i, c in toks.items()}
    mean, n = sum(size.values()) / len(toks), len(toks)
    df_of = collections.Counter(w for c in toks.values() for w in c)
    idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df_of.items()}
    for q in (i for i in toks if i is not None and i % 20 == 0):
        score = {}
        for i, c in toks.items():
            s = sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in toks[q] if w in c)
            if s > 0 and i != q:
                score[i] = round(s, 7)
        assert got[q] == sorted(score.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert bm25_search.top_k(df.limit(0), df.limit(0), 10, settings).count() == 0


def test_search_skips_most_blocks(spark):
    docs = spark.read.parquet(str(TESTDATA / "sf0.1" / "documents.parquet"))
    index = bm25_search.build_index(docs)
    df_of = dict(bm25_search.document_frequencies(index).toPandas().itertuples(index=False))
    n, total = index.agg({"n_docs": "sum", "n_words": "sum"}).select("sum(n_docs)", "sum(n_words)").first()
    row = next(index.orderBy(index["n_docs"].desc()).limit(1).toPandas().itertuples())
    shard = bm25_search.Shard(row, total / n, bm25_search.SETTINGS)
    for q in docs.where("doc_id % 200 = 0").collect():
        terms = np.unique(np.array(word_hashes(q["text"]), np.uint64))
        places = shard.find(terms)
        df = np.array([df_of[x] for x in terms.view(np.int64).tolist()])
        weights = np.log(1 + (n - df + 0.5) / (df + 0.5))
        shard.best(places[places >= 0], weights[places >= 0], q["doc_id"], 10)
    assert shard.blocks > 100_000 and shard.scored < 0.5 * shard.blocks


def test_search_copies_nothing_for_each_shard_and_block(spark, documents, monkeypatch):
    settings = replace(bm25_search.SETTINGS, shard_bytes=30_000, query_block=2000, first_files=2)
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(bm25_search, "written", kept)
    answers = []
    for df in (documents.repartition(6), documents.coalesce(1)):  # several rounds, and one
        answers.append(bm25_search.top_k(df, df.where("doc_id % 20 = 0"), 10, settings).collect())
    many, one = ({(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 7)) for r in x} for x in answers)
    assert many == one
    rounds = [plan for name, plan in plans if name == "best"]
    assert len(rounds) == 4  # six files in rounds of two, two and two; one file in one
    for plan in rounds:
        # Shards and blocks meet in the task that reads them; only answers are dealt out above it.
        above, below = plan.split("CartesianProduct")
        assert "steps" not in "".join(x for x in above.splitlines() if "Exchange" in x)
        assert "Generate" not in below


def test_a_floor_drops_what_does_not_reach_it(spark):
    rows = [(i, " ".join(f"t{j}" for j in range(i % 7 + 1))) for i in range(1, 60)]
    row = next(bm25_search.build_index(frame(spark, rows).coalesce(1)).toPandas().itertuples())
    all_, some = (bm25_search.Shard(row, 4.0, bm25_search.SETTINGS) for _ in range(2))
    places = np.arange(len(all_.terms))
    ids, score = all_.best(places, np.ones(len(places)), -1, 20)
    floor = score[4]
    some_ids, some_score = some.best(places, np.ones(len(places)), -1, 20, floor)
    assert some_ids.tolist() == ids[score >= floor].tolist() and 4 < len(some_ids) < 20
    assert some_score.tolist() == score[score >= floor].tolist() and some.scored < some.blocks


def test_search_uses_all_terms_as_registered(spark):
    # 15 rare words that each query shares with its twin come after 20 rarer ones shared with others.
    rows = [(0, " ".join([f"r{i}" for i in range(20)] + [f"t{i}" for i in range(15)]))]
    rows += [(1, " ".join(f"t{i}" for i in range(15)))] + [(2 + i, f"r{i}") for i in range(20)]
    rows += [(30 + i, " ".join(f"t{j}" for j in range(15) if (i + j) % 5 == 0)) for i in range(5)]
    df = frame(spark, rows)
    best = bm25_search.top_k(df, df.where("doc_id = 0"), 1).first()
    assert bm25_search.SETTINGS.query_terms is None and best["doc_id"] == 1


def test_repeated_ids_do_not_push_out_others(spark):
    rows = [(20, "a b c")] + [(1, "a b c")] * 12 + [(i, "a x y z") for i in range(2, 8)]
    df = frame(spark, rows).coalesce(1)
    got = bm25_search.top_k(df, df.where("doc_id = 20"), 5).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2, 3, 4, 5]


def test_registered_scores_use_two_words_of_context(spark):
    rows = [(1, "a b c"), (2, "a b c"), (3, "x b d"), (4, "x b d"), (5, "x b c")]
    got = {r["doc_id"]: r["log_score"] for r in lm_score.scores(frame(spark, rows)).collect()}
    want, two = backoff_scores(rows, 3), backoff_scores(rows, 2)
    assert want[1][1] != pytest.approx(two[1][1])
    assert all(got[i] == pytest.approx(want[i][1], rel=1e-9) for i in got)


def test_patterns_spread_two_hops_and_past_unknown_instances(spark):
    # Five seeds, ten unknown tokens in the seeds' context, these in a second context, more tokens there.
    rows = [(i, f"reach: user{i}@x.org now") for i in range(5)]
    rows += [(100 + i, f"reach: nick{i} now") for i in range(10)]
    rows += [(200 + i, f"handle= nick{i} end") for i in range(10)] + [(300, "handle= far9 end")]
    # A context that several kinds share names nothing.
    rows += [(400 + i, f"mixed: user{i}@x.org too") for i in range(6)]
    rows += [(500 + i, f"mixed: 10.0.0.{i} too") for i in range(6)] + [(600, "mixed: thing7 too")]
    spans = {r["doc_id"]: r["spans"] for r in pii.span_digests(frame(spark, rows)).collect()}
    assert all(spans[100 + i] == "email:7:12" for i in range(10))
    assert all(spans[200 + i] == "email:8:13" for i in range(10))
    assert spans[300] == "email:8:12" and spans[600] == ""


def test_a_worker_keeps_no_words_of_the_texts_it_has_hashed():
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for i in range(20):
        assert len(word_hashes(" ".join(f"w{i}x{k}" for k in range(5000)))) == 5000
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 1e6
