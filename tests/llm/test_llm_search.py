"""Ranked search, passage removal and conversation repair against brute force, on fixtures
that hold nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessella.llm import conversation_repair as repair
from tessella.llm import ranked_search, substring_dedup

# Ranked search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = {k: k + 32 for k in range(65, 91)}
    return TERM.findall((text or "").translate(lower))


def ranking(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "été", "A1", "中文"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 5, 40, 200])))) for i in range(400)]
    docs += [(7, "w0 w1,W2;w3"), (7, "w0 w1,W2;w3"), (None, "w5 w6"), (401, None), (402, ""), (403, "-- \x7f!")]
    docs += [(500, "w9 " * 60_000 + "w10"), (501, "w77 w78"), (502, "w77 w78")]
    items = [(i, " ".join(rnd.choices(vocabulary, weights, k=25))) for i in range(20)]
    return docs, items + [(90, None), (91, ""), (92, "unknown"), (93, "w77 W78 w77"), (93, "w5"), (None, "w6 w9")]


def test_ranked_search(spark, corpus):
    docs, items = corpus
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item long, block string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score long").repartition(3)
    settings = ranked_search.RankSettings(shard_docs=60, item_block=60, chunk=1)
    for k, given in ((5, settings), (20, ranked_search.SETTINGS)):
        got = [tuple(r) for r in ranked_search.ranked(frame, asked, k, given).collect()]
        assert sorted(got, key=repr) == ranking(docs, items, k)
    none = frame.limit(0)
    assert ranked_search.ranked(none, asked).count() == 0
    assert ranked_search.ranked(frame, asked.limit(0)).count() == 0


def test_search_stops_creating_accumulators(spark, corpus):
    docs, _ = corpus
    rnd = random.Random(2)
    docs = [(i, f"rare{i % 9} " + " ".join(rnd.choices([f"c{j}" for j in range(30)], k=50))) for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    row = ranked_search.build_index(frame).toPandas().iloc[0]
    shard = ranked_search.Shard(row, row.n_docs, row.n_terms, ranked_search.SETTINGS)
    asked = [b"rare3"] + [f"c{j}".encode() for j in range(4)]
    shard.best(asked, [5000, 60, 60, 60, 60], 20)
    assert shard.created < 400  # of 3000 documents that hold one of the terms
    assert shard.touched < 1600  # of some 10,000 postings


# Passages -----------------------------------------------------------------------------


def without(docs, size):
    split = [(i, (t or "").encode().split()) for i, t in docs]
    least = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k : k + size])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and least[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def shuffled_passages(seed, n=120):
    rnd = random.Random(seed)
    shared = [[f"s{rnd.randint(0, 60)}" for _ in range(rnd.choice([6, 9, 30]))] for _ in range(12)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += rnd.choice(shared) if rnd.random() < 0.5 else [f"u{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 12))]
            if words and rnd.random() < 0.3:
                words[rnd.randrange(len(words))] = "edit"
        docs.append((rnd.choice([i, i, i, i // 2]), rnd.choice([" ", "\t \n"]).join(words)))
    docs += [(None, docs[3][1]), (900, None), (901, ""), (902, " \n"), docs[5], docs[5], (903, "r " * 500), (904, "r " * 40)]
    docs += [(905, "ü é 中 x y z q"), (906, "a ü é 中 x y z q b"), (907, "one word " * 9)]
    return docs + [(2000, "long " * 30_000 + "end"), (2001, "long " * 9)]


@pytest.mark.parametrize("settings", [(6, 3, 400, 10**9, 64), (6, 6, 10**6, 10**9, 1 << 20), (6, 2, 500, 40, 1000), (7, 5, 300, 0, 300)])
def test_repeated_passages(spark, settings):
    docs = shuffled_passages(settings[0] + settings[1])
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, digest string, start int")
    got = substring_dedup.without_repeats(frame.repartition(5), substring_dedup.PassageSettings(*settings)).collect()
    assert sorted(((r[0], r[1], r[2], bytes(r[3])) for r in got), key=repr) == without(docs, settings[0])


def test_no_passages(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in substring_dedup.kept_digests(frame).collect()) == [(1, 2, 0), (2, 0, 0)]
    assert substring_dedup.kept_digests(frame.limit(0)).count() == 0


def test_matching_statistics():
    """Lengths and owners of the matches against comparing with every suffix."""
    rnd = np.random.default_rng(5)
    for top in (1, 2, 3, 40):
        stored = [rnd.integers(1, top + 1, rnd.integers(1, 25)) for _ in range(15)]
        owner = rnd.integers(0, 9, 15)
        asked = [rnd.integers(0, top + 1, rnd.integers(1, 30)) for _ in range(20)]
        for window in (1, 4):
            index = substring_dedup.PassageIndex(stored, owner, top, window)
            got = {(int(w), int(k)): (int(n), int(o)) for part in index.matches(asked, window) for w, k, n, o in zip(*part)}
            want = {}
            for w, text in enumerate(asked):
                for k in range(len(text)):
                    lengths = [
                        (len(list(itertools.takewhile(lambda p: p[0] == p[1] > 0, zip(text[k:], s[j:])))), owner[i])
                        for i, s in enumerate(stored) for j in range(len(s))
                    ]
                    longest = max(n for n, _ in lengths)
                    if longest >= window:
                        want[w, k] = (longest, min(o for n, o in lengths if n >= window))
            # Longer matches than the one that goes on from the right don't begin here.
            assert got.keys() == want.keys()
            assert all(got[key][1] == want[key][1] and got[key][0] == want[key][0] for key in want)


# Conversations ------------------------------------------------------------------------


def cheapest(rows):
    """Cost, audit and repaired lines, over all edits of few rows."""
    best = None
    choices = []
    seen = set()
    for role, text in rows:
        body = text.strip(repair.BLANKS)
        blank, again = not body, (role, text) in seen
        seen.add((role, text))
        late = 0 if blank or again or body[-1] in ".!?" else 1
        keep = [] if blank or again else [("K", late, (role, text))] + [("R", 2 + late, (r, text)) for r in ("user", "assistant")]
        choices.append([("D", 3, None), *keep])
    insert = [[], *([("I", 2, (r, ""))] for r in ("user", "assistant")), *([("I", 2, (a, "")), ("I", 2, (b, ""))] for a, b in (("user", "assistant"), ("assistant", "user")))]
    slots = [insert] + [part for c in choices for part in ([[x] for x in c], insert)]
    for pick in itertools.product(*slots):
        edits = [e for part in pick for e in part]
        lines = [line for _, _, line in edits if line is not None]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
            value = (sum(c for _, c, _ in edits), "".join(e for e, _, _ in edits), lines)
            best = min(best or value, value, key=lambda v: v[:2])
    return best


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(repair.BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return [out.count(k) for k in ("blank", "duplicate", "truncated")]


def conversations(seed=4):
    rnd = random.Random(seed)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rnd.randint(0, 3)):
            text = rnd.choice(["Hi.", "no end", "", " \t", "Well!", "é?", "Hi.", "x. \n"])
            rows.append((conv, rnd.choice([turn, turn, turn + 1, None]), rnd.choice(["user", "assistant", "system", "tool", "u", "", None]), rnd.choice([text, text, None])))
    return rows + rows[:2] + [(100, 2**62, "user", "a."), (100, -(2**62), "assistant", "b."), (101, None, "user", "z" * 200_000)]


def test_repair(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, place int")
    for settings in (repair.SETTINGS, repair.RepairSettings(chunk_bits=0), repair.RepairSettings(chunk_bits=1)):
        got = {r["conv_id"]: r for r in repair.report(frame, frame, settings).collect()}
        assert set(got) == {r[0] for r in rows}
        for conv, r in got.items():
            mine = [(t, role if role is not None else " ", text if text is not None else " ") for c, t, role, text in rows if c == conv]
            mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
            turns = [t for t, _, _ in mine if t is not None]
            assert r["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
            lines = [(a, b) for _, a, b in mine]
            assert [r["blank"], r["duplicate"], r["truncated"]] == faults(lines)
            initials = [a[:1] for a, _ in lines]
            assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            cost, audit, fixed = cheapest(lines)
            assert (r["cost"], r["audit"]) == (cost, audit)
            text = "\n".join(f"{a}:{b}" for a, b in fixed)
            assert r["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_repaired_rows_are_right(spark):
    frame = spark.createDataFrame(conversations(9), "conv_id long, turn long, role string, text string")
    rows = sorted(repair.repaired(frame).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["row"]))
    for _, group in itertools.groupby(rows, key=lambda r: r["conv_id"]):
        assert re.fullmatch("s?(ua)+", "".join(r["role"][:1] for r in group))


def test_conversation_without_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = repair.report(frame, frame.limit(0)).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.report(frame.limit(0), frame.limit(0)).count() == 0


def test_long_conversation_spans_tasks(spark):
    """Thousands of rows of one conversation: chunks are joined to what one parse gives."""
    rnd = random.Random(3)
    rows = [(1, i, rnd.choice(["user", "assistant"]), f"t{i}" + rnd.choice([".", ""])) for i in range(5000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesced, "false")  # so few rows would be joined to one task
    try:
        (row,) = repair.report(frame, frame, repair.RepairSettings(chunk_bits=4)).collect()
        assert repair.placed(frame).selectExpr("place >> 33").distinct().count() > 1
    finally:
        spark.conf.unset(coalesced)
    codes = "".join(chr(65 + {"u": 4, "a": 8}[r[0]] + (0 if t.endswith(".") else 3)) for _, _, r, t in rows)
    parser = repair.Parser(repair.SETTINGS)
    assert (row["cost"], row["audit"]) == parser.repaired([parser.span(codes)])
