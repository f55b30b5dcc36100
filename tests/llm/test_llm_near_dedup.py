"""Near duplicates where ids repeat, texts are very long or one bucket is very large."""

import random
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import near_dedup


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, text) -> (size, smallest id of its texts' group, group), over all pairs of texts."""
    sets = {}
    for i, text in rows:
        if i is not None and sets_of(text):
            sets.setdefault(frozenset(sets_of(text)), set()).add(i)
    keys, root = list(sets), list(range(len(sets)))
    for a in range(len(keys)):
        for b in range(a):
            if 100 * len(keys[a] & keys[b]) >= 75 * len(keys[a] | keys[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    least = {r: min(min(sets[k]) for k, x in zip(keys, root) if x == r) for r in root}
    group = {k: r for k, r in zip(keys, root)}
    out = {}
    for i, text in rows:
        own = group.get(frozenset(sets_of(text))) if i is not None else None
        out[i, text] = (len(sets_of(text)), i if own is None else least[own], own)
    return out


def repeated_ids(seed):
    """Few ids, many texts: an id has texts of several groups, and copies with edits."""
    rnd, rows = random.Random(seed), []
    for _ in range(10):
        text = [f"w{rnd.randint(0, 300)}" for _ in range(rnd.choice([4, 30, 90]))]
        for _ in range(rnd.choice([2, 6, 15])):
            copy = list(text)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = f"e{rnd.randint(0, 9999)}"
            rows.append((rnd.randint(0, 25), " ".join(copy)))
    rows += [(3, None), (3, ""), (3, ""), (None, rows[0][1]), (None, rows[0][1]), (4, " \t"), (30, "Ä b"), (30, "ä b")]
    return rows + rows[:8]


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 2)])
def test_texts_that_share_an_id_are_grouped_apart(spark, seed, block):
    rows = repeated_ids(seed)
    settings = replace(near_dedup.SETTINGS, block=block)
    df = spark.createDataFrame([(i, t, k, f"s{k % 3}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, text_key int, first string")
    want = brute(rows)
    got = near_dedup.groups(df.drop("text_key", "first"), settings).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == sorted(
        (str(i), want[i, t][0], str(want[i, t][1])) for i, t in rows
    )
    # One row of each group, all columns: of its smallest id; rows in no group stay.
    left = near_dedup.one_of_each(df, settings)
    assert left.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in left.collect()]
    grouped = [x for x in left if want[x][2] is not None]
    assert len(left) - len(grouped) == sum(want[x][2] is None for x in rows)
    assert sorted(want[x][2] for x in grouped) == sorted({want[x][2] for x in rows} - {None})
    assert all(i == want[i, t][1] for i, t in grouped)


def plain_signature(elements, slots):
    """One element at a time, all levels."""
    least = [np.inf] * slots
    for element in elements.tolist():
        order, state = list(range(slots)), np.array([element], np.uint64)
        for level in range(slots):
            state = near_dedup.mixed(state)
            swap = level + int(near_dedup.mixed(~state)[0]) % (slots - level)
            order[level], order[swap] = order[swap], order[level]
            least[order[level]] = min(least[order[level]], level + int(state[0] >> np.uint64(11)) * 2.0**-53)
    return least


@pytest.mark.parametrize("n", [1, 7, 90])
def test_a_signature_in_pieces_is_that_of_the_whole(monkeypatch, n):
    elements = near_dedup.mixed(np.arange(n, dtype=np.uint64))
    monkeypatch.setattr(near_dedup, "PIECE", 8)
    assert near_dedup.signature(elements, 16).tolist() == plain_signature(elements, 16)


def test_a_million_words_stay_within_bounded_memory():
    text = " ".join(str(i * 7919 % 1_000_003) for i in range(1_000_000))
    tracemalloc.start()
    near_dedup.signature(near_dedup.shingles(text), 128)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_a_large_bucket_is_spread_over_tasks(spark):
    left = spark.range(5000).selectExpr("7L AS bucket", "5000L AS size", "id AS node", "id AS component")
    texts = spark.range(5000).select(F.col("id").alias("node"), F.concat(F.lit("a b c d w"), F.col("id")).alias("text"))
    pairs = near_dedup.block_pairs(left, texts, near_dedup.SETTINGS)
    per_task = pairs.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    # Ten blocks, of which the one of the largest component's only class is an eleventh.
    assert sum(r["n"] for r in per_task) == 55 + 10 and len(per_task) > 1
    assert near_dedup.across(left, texts, near_dedup.SETTINGS).count() == 0


def test_a_worker_keeps_no_words_of_the_texts_it_has_seen():
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for i in range(20):
        near_dedup.shingles(" ".join(f"w{i}x{k}" for k in range(5000)))
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 1e6
