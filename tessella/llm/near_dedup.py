"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

A document is the set of its five-word shingles. Equal sets are one class, so exact
copies cost nothing further. SuperMinHash gives each class a signature: an element
draws a value for one slot per level, in a random order of all slots that is drawn with
it, and levels end once every slot holds a smaller value. Classes that agree in a band of
slots meet in a bucket. Links are confirmed on full sets and joined to components.

No bucket emits all its pairs. First every class is compared with the smallest of its
bucket, then with one more of it. A bucket whose classes are then in one component is
done. The others are compared in full, in blocks of bounded size and without a row per
pair: a task counts the shared shingles of two blocks' classes of different components
and returns those that may link. So no link between components is lost, however large a
bucket is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import word_hashes, written

SHINGLE = 5


@dataclass(frozen=True)
class DedupSettings:
    percent: int = 75  # of the union that two sets have to share
    slots: int = 128
    rows: int = 4  # slots of a band: a pair at 0.75 meets in no band once in 200,000 times
    # Part of equal slots below which a pair is not looked at: five standard deviations
    # off for a pair at the threshold.
    estimate: float = 0.5625
    block: int = 512  # classes of a bucket that are compared together
    spread: int = 500  # pairs of one class that go to one task


SETTINGS = DedupSettings()
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
TASK_EDGES = 250_000
PIECE = 16_384  # elements of a set that are hashed together
TASK_PAIRS = 2_000_000  # of classes that a task compares, about
TASK_SETS = 65_536  # that a task reads for it, about


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64: well-mixed 64-bit numbers from 64-bit numbers."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the set; empty without words. A-Z is lower-cased and
    words end at ASCII white space: just what ``bytes`` does."""
    word = word_hashes(text)
    if not len(word):
        return word
    size = min(SHINGLE, len(word))
    total = np.full(len(word) - size + 1, np.uint64(size))
    for k in range(size):
        total = mixed(total ^ word[k : len(word) - size + 1 + k])
    return np.unique(total)


def signature(elements: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash of a non-empty set: the smallest value of each slot.

    At level j every element puts a value in [j, j + 1) into the j-th slot of its own
    permutation. Once all slots hold less than j + 1 no later level can matter.
    A large set goes in pieces, so memory is bounded; the slots' values carry over and
    end the levels of later pieces sooner.
    """
    least = np.full(slots, np.inf)
    for at in range(0, len(elements), PIECE):
        state = elements[at : at + PIECE]
        rows = np.arange(len(state))
        order = np.tile(np.arange(slots, dtype=np.int16), (len(state), 1))
        for level in range(slots):
            state = mixed(state)
            swap = level + (mixed(~state) % np.uint64(slots - level)).astype(np.int64)
            slot = order[rows, swap]
            order[rows, swap] = order[:, level]
            order[:, level] = slot
            np.minimum.at(least, slot, level + (state >> np.uint64(11)) * 2.0**-53)
            if least.max() < level + 1:
                break
    return least


def text_key() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketches(docs: DataFrame, settings: DedupSettings = SETTINGS) -> DataFrame:
    """doc_id, text_key, n (size of the set), set_key, bands, slots of every whole text."""
    bands = settings.slots // settings.rows
    band = mixed(np.arange(bands, dtype=np.uint64))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: dict[str, list] = {"n": [], "set_key": [], "bands": [], "slots": []}
            for text in frame["text"]:
                elements = shingles(text)
                out["n"].append(len(elements))
                out["set_key"].append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                if not len(elements):
                    out["bands"].append([])
                    out["slots"].append(b"")
                    continue
                # Equal values are equal elements: compare them as bits.
                bits = mixed(signature(elements, settings.slots).view(np.uint64))
                key = band
                for part in bits.reshape(bands, settings.rows).T:
                    key = mixed(key ^ part)
                out["bands"].append(key.view(np.int64))
                out["slots"].append((bits & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text_key": frame["text_key"], **out})

    rows = docs.select("doc_id", text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, text_key long, n long, set_key binary, bands array<long>, slots binary")


def similar(pairs: DataFrame, classes: DataFrame, settings: DedupSettings) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("slots").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = both.where(100 * small >= settings.percent * large)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, b = (np.frombuffer(b"".join(frame[c]), np.uint16).reshape(-1, settings.slots) for c in ("s_a", "s_b"))
            close = (a == b).mean(axis=1) >= settings.estimate if len(frame) else np.zeros(0, bool)
            yield frame.loc[close, ["a", "b"]]

    return both.select("a", "b", "s_a", "s_b").mapInPandas(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, settings: DedupSettings) -> DataFrame:
    """The pairs whose full sets share enough. A class with many pairs is spread over
    several tasks, ``spread`` pairs to each."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / settings.spread).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    dealt = pairs.join(parts, "a").select("a", "b", part.alias("part"))
    left = texts.join(parts, texts["node"] == parts["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("text_a")
    )
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # The class with many pairs comes last, so its text is not shuffled with each.
    both = dealt.join(right, "b").join(left, ["a", "part"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, np.zeros(0, np.uint64)
        for frame in frames:
            linked = []
            for a, x, y in zip(frame["a"], frame["text_a"], frame["text_b"]):
                if a != last:
                    last, held = a, shingles(x)
                other = shingles(y)
                shared = len(np.intersect1d(held, other, assume_unique=True))
                linked.append(100 * shared >= settings.percent * (len(held) + len(other) - shared))
            yield frame.loc[np.array(linked, bool), ["a", "b"]]

    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long")


def forest(edges: DataFrame) -> DataFrame:
    """The edges dealt to tasks, ``TASK_EDGES`` to each, and each task's as stars around
    its smallest nodes, by union-find."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for frame in frames:
            for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
        stars = [(root(x), x) for x in parent if root(x) != x]
        yield pd.DataFrame(stars, columns=["a", "b"], dtype="int64")

    tasks = max(1, -(-edges.count() // TASK_EDGES))
    return edges.repartition(tasks).mapInPandas(run, "a long, b long")


def checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node with an edge: the smallest node it reaches.

    Union-find in each partition, then alternating stars over all: every node first
    points its larger neighbours, then its smaller ones, to the smallest it knows. The
    edges end as stars when they no longer change.
    """
    now = written(forest(edges), "forest")
    state = checksum(now)
    while True:
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m"), "a", "b")
        pairs = small.select(F.explode(F.array(F.struct("m", F.col("a").alias("x")), F.struct("m", F.col("b").alias("x")))).alias("p"))
        now = written(pairs.select(F.col("p.m").alias("a"), F.col("p.x").alias("b")).where("a <> b").distinct(), "stars")
        new = checksum(now)
        if new == state:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                now.select("a", "a").distinct()
            )
        state = new


def unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, size, node, component: members of buckets with several components."""
    component = F.coalesce("component", "node")
    placed = members.join(found, "node", "left").select("bucket", "size", "node", component.alias("component"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return written(placed.join(several.where("low < high").select("bucket"), "bucket"), "unsettled")


def led(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of another leader of each bucket, the one its hash says, with the
    classes of other components."""
    pick = F.min_by(F.struct("node", "component"), F.xxhash64("node", "bucket"))
    lead = left.groupBy("bucket").agg(pick.alias("lead"))
    pairs = left.join(lead, "bucket").where(F.col("component") != F.col("lead.component"))
    return pairs.select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()


def narrowed(texts: DataFrame) -> DataFrame:
    """node, n, half: the sets as sorted 32-bit halves of their hashes. Two sets share
    at least as many halves as they share shingles."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(x) for x in frame["text"]]
            half = [(s & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for s in sets]
            yield pd.DataFrame({"node": frame["node"], "n": [len(s) for s in sets], "half": half})

    return texts.mapInPandas(run, "node long, n long, half binary")


def block_links(left: list, right: list, percent: int) -> list[tuple[int, int]]:
    """Pairs of two blocks' rows, of different components, that may share enough."""
    of_right = np.array([y["component"] for y in right])
    sizes = np.array([y["n"] for y in right])
    nodes = np.array([y["node"] for y in right])
    halves = [np.frombuffer(y["half"], np.uint32) for y in right]
    elements = np.concatenate(halves)
    owner = np.repeat(np.arange(len(right)), [len(h) for h in halves])
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    out = []
    for x in left:
        other = of_right != x["component"]
        if not other.any():
            continue
        half = np.frombuffer(x["half"], np.uint32)
        first, last = np.searchsorted(elements, half), np.searchsorted(elements, half, "right")
        count = last - first
        at = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        shared = np.bincount(owner[at], minlength=len(right))
        fits = other & (100 * shared >= percent * (x["n"] + sizes - shared))
        out += [(min(x["node"], y), max(x["node"], y)) for y in nodes[fits].tolist()]
    return out


def block_pairs(left: DataFrame, texts: DataFrame, settings: DedupSettings) -> DataFrame:
    """outer, rows: every two blocks of a bucket that have to be compared, once.

    A bucket is dealt to blocks. A block holds rows of the largest component apart from
    the others, so two blocks of only that component don't meet. The pairs are named
    first and spread over tasks; then each gets its blocks.
    """
    per = left.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    largest = per.groupBy("bucket").agg(F.max_by("component", F.struct("k", "component")).alias("largest"))
    inner = (F.col("component") == F.col("largest")).alias("inner")
    blocks = F.ceil(F.col("size") / settings.block)
    block = F.pmod(F.xxhash64("node"), blocks).alias("block")
    rows = left.join(largest, "bucket").select("bucket", inner, block, "node", "component")
    packed = rows.join(narrowed(texts), "node").groupBy("bucket", "inner", "block").agg(
        F.collect_list(F.struct("node", "component", "n", "half")).alias("rows")
    )
    packed = written(packed, "blocks")
    names = packed.select("bucket", "inner", "block", F.size("rows").alias("k"))
    own = names.where("NOT inner").select("bucket", F.col("block").alias("own"), F.col("k").alias("k_own"))
    met = names.join(own, "bucket").where(F.col("inner") | (F.col("own") <= F.col("block")))
    met = written(met, "met")
    pairs, sets = met.agg(F.sum(F.col("k").cast("long") * F.col("k_own")), F.sum(F.col("k") + F.col("k_own"))).first()
    tasks = max(1, -(-(pairs or 0) // TASK_PAIRS), -(-(sets or 0) // TASK_SETS))
    outer = packed.where("NOT inner").select("bucket", F.col("block").alias("own"), F.col("rows").alias("outer"))
    # Merged, so that the tasks are these: no pair's task follows from the size of its blocks.
    packed = packed.repartition(tasks, "bucket", "inner", "block").hint("merge")
    return met.join(outer, ["bucket", "own"]).join(packed, ["bucket", "inner", "block"]).select("outer", "rows")


def across(left: DataFrame, texts: DataFrame, settings: DedupSettings) -> DataFrame:
    """Pairs (a, b) of different components in a bucket that may share enough: all that
    do are among them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for one, two in zip(frame["outer"], frame["rows"]):
                found = block_links(one, two, settings.percent)
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return block_pairs(left, texts, settings).mapInPandas(run, "a long, b long").distinct()


def grouped(docs: DataFrame, settings: DedupSettings = SETTINGS) -> DataFrame:
    """``groups`` with text_key and group, the group's number; null for rows without words or id."""
    sketch = written(sketches(docs, settings), "sketches")
    usable = sketch.where("doc_id IS NOT NULL AND n > 0")
    classes = usable.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("row"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.first("slots").alias("slots"),
    )
    # A class has a number of its own, as texts of one id can be of several classes.
    node = F.monotonically_increasing_id().alias("node")
    classes = written(classes.select(node, "row.doc_id", "row.text_key", "set_key", "n", "bands", "slots"), "classes")
    members = classes.select(F.explode("bands").alias("bucket"), "node", "doc_id")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("doc_id").alias("first_id"))
    members = written(members.drop("doc_id").join(shared.where("size > 1"), "bucket"), "members")
    suspects = classes.select("node", "doc_id", "text_key").join(members.select("node").distinct(), "node")
    texts = docs.select("doc_id", text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(suspects, ["doc_id", "text_key"]).select("node", "text").dropDuplicates(["node"])
    texts = written(texts, "texts")

    # The smallest id leads: the earliest text is the likeliest to be what others copy.
    lead = classes.groupBy(F.col("doc_id").alias("first_id")).agg(F.min("node").alias("a"))
    pairs = members.select("first_id", F.col("node").alias("b")).distinct().join(lead, "first_id")
    pairs = pairs.where("a <> b").select("a", "b")
    links = written(confirmed(similar(pairs, classes, settings), texts, settings), "links")
    found = written(components(links), "components")
    for compare in (lambda left: similar(led(left), classes, settings), lambda left: across(left, texts, settings)):
        left = unsettled(members, found)
        if left.isEmpty():
            break
        close = written(compare(left), "close")
        links = links.union(written(confirmed(close, texts, settings), "links"))
        found = written(components(links), "components")
    linked = found.join(classes.select("node", "doc_id", "set_key"), "node")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("of_group"))
    named = linked.join(least, "component").select("set_key", "of_group", F.col("component").alias("group"))
    alone = classes.join(found, "node", "left_anti").select("set_key", F.col("doc_id").alias("of_group"), F.col("node").alias("group"))
    rows = sketch.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "set_key")
    rows = rows.join(named.union(alone), "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_group", "doc_id"))
    group = F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("group")
    rows = rows.select("doc_id", "text_key", group, "n_shingles", component.alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return rows.withColumn("kept", kept)


def groups(docs: DataFrame, settings: DedupSettings = SETTINGS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    A text without words (or a null one) is empty: no shingles, its own component. A row
    without id is linked with nothing and kept, its component is null. Rows that repeat
    an id are grouped by their own texts. A very long text is hashed whole, in pieces.
    Only doc_id and text are read.
    """
    return grouped(docs, settings).drop("text_key", "group")


def one_of_each(docs: DataFrame, settings: DedupSettings = SETTINGS) -> DataFrame:
    """The documents, all columns, one row of each group: that with the smallest id.

    Of several rows of this id the one whose text has the smallest hash stays, of rows
    alike in both the least as JSON. Rows without id or without words are in no group
    and stay.
    """
    found = grouped(docs, settings).where("group IS NOT NULL")
    texts = written(found.groupBy("group", "doc_id", "text_key").agg(F.count("*").alias("n")), "texts_of_groups")
    first = texts.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("row"))
    first = first.select("group", "row.*", F.lit(True).alias("first"))
    special = texts.join(first, ["group", "doc_id", "text_key"], "left").where("n > 1 OR first IS NULL")
    special = special.select(F.col("doc_id").alias("near_id"), F.col("text_key").alias("near_key"), "first")
    special = written(special, "special")
    whole = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text_key().alias("text_key"))
    same = (F.col("doc_id") == F.col("near_id")) & (F.col("text_key") == F.col("near_key"))
    plain = whole.join(special, same, "left_anti").select("row.*")
    again = whole.join(special.where("first"), same, "left_semi").groupBy("doc_id", "text_key")
    return plain.union(again.agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))
