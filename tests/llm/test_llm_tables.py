"""Graph search, URL rules and the pipeline."""

import itertools
import random
import time
from collections import Counter

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import graph_search, url_rules
from tessella.llm.catalog import ORACLES, QUERIES

FOLDER = str(TESTDATA / "sf0.01")


def test_neighbours(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    settings = graph_search.GraphSettings(shard_rows=200, batch=64)
    queries = df.where("vec_id % 10 = 0")
    rows = df.collect()
    ids, points = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got, hit = {}, 0
    for r in graph_search.nearest_neighbours(df, queries, 10, settings).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in ids[ids % 10 == 0]:
        dist = np.sqrt(((points - points[ids == q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((ids, dist)) if ids[i] != q][:10]
        assert sorted(got[q]) == list(range(1, 11))
        for vec, score in got[q].values():
            assert score == pytest.approx(dist[ids == vec][0], rel=1e-12)
        hit += len({v for v, _ in got[q].values()} & set(ids[best]))
    assert hit >= 0.9 * 10 * len(got)


def test_neighbours_of_odd_vectors(spark):
    rows = [(i, [1.0, float(i // 30)], 0) for i in range(60)]
    rows += [(100, None, 0), (101, [0.0, 0.0], 0), (102, [float("nan"), 1.0], 0), (103, [None, 1.0], 0)]
    rows += [(104, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0), (200, [1.0], 0), (3, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = graph_search.nearest_neighbours(df, df, 5).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    # Many equal vectors: the smallest ids, without the query's own.
    assert found[0] == [1, 2, 3, 4, 5] and found[3] == [0, 1, 2, 4, 5] and found[45] == [30, 31, 32, 33, 34]
    assert 200 not in found and not set(found) & {100, 101, 102, 103, 104}
    assert graph_search.nearest_neighbours(df.limit(0), df, 5).count() == 0
    assert graph_search.nearest_neighbours(df, df.limit(0), 5).count() == 0
    # One id in most rows of the queries, extra columns of the names that the search works with.
    many = df.where("vec_id = 45").crossJoin(spark.range(2000).select(F.col("id").alias("block"), F.lit("x").alias("points")))
    got = graph_search.nearest_neighbours(df.withColumn("shard", F.lit("x")), many, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [30, 31, 32, 33, 34]


def test_blocks_of_queries_are_of_bounded_size(spark):
    # An id that comes with many vectors doesn't make one block.
    rows = [(i, [float(i), 1.0]) for i in range(40)] + [(7, [float(i), 2.0]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    settings = graph_search.GraphSettings(batch=64, shard_rows=100)
    got = graph_search.nearest_neighbours(df, df.where("vec_id = 7"), 3, settings).orderBy("rank").collect()
    # Each vector asks; the nearest answers of the id's vectors count, ties to the smaller id.
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(7, 0, 1.0), (7, 1, 1.0), (7, 2, 1.0)]


def verdict(url):
    """Host, path, rule and verdict of the declared rules alone."""
    _, sep, rest = (url or "").partition("://")
    host, path = "", ""
    if sep:
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for decision, rule in url_rules.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = max(best or ("", ""), (rule, decision), key=lambda r: len(r[0]))
    return (host, path, *(best or (None, None)))


def test_declared_rules(spark):
    urls = [r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    urls += [None, "", "net/", "http://NET/x", "http://net", "http://a.net?x=/", "ftp://x.example.NET/en/1?q=1#f"]
    urls += ["http://myexample.net/en/", "http://example.com/de/ü", "a://b://c.org/fr/", "http://É.net/\n/x", "://net/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_rules.judge(df).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, decision = verdict(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == decision if decision else got[i]["verdict"] in ("allow", "block")


def test_mined_rules(spark):
    rows = [(["a", "b"], "block")] * 8 + [(["a", "c"], "allow")] * 8 + [(["b", "d"], "block")] * 4
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    found = {(r["rule_id"], r["verdict"]): r["confidence"] for r in url_rules.mine(df).collect()}
    # Longer combinations say nothing that b, c and d don't.
    assert found == {("b", "block"): 1.0, ("c", "allow"): 1.0, ("d", "block"): 1.0}


def brute_rules(rows, settings):
    """All token sets of up to ``max_tokens``, counted one by one."""
    seen, says = Counter(), Counter()
    for tokens, decision in rows:
        for n in range(1, settings.max_tokens + 1):
            for s in itertools.combinations(sorted(set(tokens)), n):
                seen[s] += 1
                says[s, decision] += 1
    least = settings.min_support * len(rows)
    sure = {(s, d): c / seen[s] for (s, d), c in says.items() if c >= least and c / seen[s] >= settings.min_confidence}
    return {
        k: c for k, c in sure.items()
        if not any(set(t) < set(k[0]) and d == k[1] and other >= c for (t, d), other in sure.items())
    }


def test_mined_rules_against_all_sets(spark):
    rnd = random.Random(12)
    rows = [([f"t{rnd.randint(0, 9)}|=" for _ in range(rnd.randint(0, 6))], rnd.choice(["block", "allow"])) for _ in range(150)]
    rows += [(["x", "y", "z"], "block")] * 9 + [(["x", "y"], "allow")] * 7 + [(["y", "z"], "allow")] * 5 + [(["x", "z", "w"], "allow")] * 5
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    for settings in (url_rules.MiningSettings(min_support=0.03, min_confidence=0.6), url_rules.MiningSettings(0.02, 0.7, max_tokens=2)):
        got = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in url_rules.mine(df, settings).collect()}
        assert got == brute_rules(rows, settings) and got


def test_urls_with_many_common_parameters_end(spark):
    query = "&".join(f"q{i}=1" for i in range(30))
    urls = [f"http://a{i}.net/x?{query}" for i in range(10)] + [f"http://b{i}.org/fr/y" for i in range(200)]
    urls += ["http://c.com/?q1=2", "http://c.com/" + "a" * 100_000, "http://c.com/?" + "&".join(f"long{i}" for i in range(5000))]
    df = spark.createDataFrame([*enumerate(urls), (0, urls[0])], "page_id long, url string")
    start = time.perf_counter()
    got = url_rules.judge(df).collect()
    assert time.perf_counter() - start < 120
    assert len(got) == len(urls) + 1
    assert {r["verdict"] for r in got if r["page_id"] == 210} == {"block"}  # as all others with q1


def test_no_pages_and_no_labels(spark):
    df = spark.createDataFrame([(1, "http://x.com/en/")], "page_id long, url string")
    assert url_rules.judge(df).first()["verdict"] == "allow"
    assert url_rules.judge(df.limit(0)).count() == 0


def test_pipeline(spark):
    folder = str(TESTDATA / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    table, ids = docs, docs.select("doc_id").distinct().count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, folder)
        assert table.columns == docs.columns, name
    result = corpus_pipeline.run(spark, folder)
    assert result.count() == table.count()
    assert 0.6 * ids <= result.select("doc_id").distinct().count() <= ids
    assert result.where(F.size("tokens") != F.col("n_tokens")).count() == 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
