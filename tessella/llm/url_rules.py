"""URL filtering by declared rules, and by association rules mined from labelled URLs.

A declared rule names a host and a path prefix. URLs that no declared rule fits are
judged by mined rules: Spark's FP-growth finds frequent combinations of URL tokens and
verdicts, those that imply a verdict with enough confidence and support are kept, and an
inverted index from token to rule finds the ones a URL satisfies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import written

ALLOW, BLOCK = "allow", "block"
# The rules all pages are judged by.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class MiningSettings:
    min_support: float = 0.01  # share of labelled URLs that hold tokens and verdict
    min_confidence: float = 0.8
    max_tokens: int = 3  # of a rule
    default: str = ALLOW  # where no rule fits


SETTINGS = MiningSettings()


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path: both empty for a null or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def declared(rules=RULES) -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits ``host`` and ``path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = F.col("host").isin(host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        fits &= F.startswith(F.col("path"), F.lit(f"/{path}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def url_tokens(url: str = "url") -> Column:
    """Tokens of a URL: each host label with its place from the right, the first path
    segment, the file ending and the names of query parameters."""
    text = F.coalesce(F.col(url), F.lit(""))
    labels = F.reverse(F.split("host", r"\."))
    host = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    first = F.regexp_extract("path", r"^/([^/]*)", 1)
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0]))
    rest = F.array(F.concat(F.lit("p:"), first), F.concat(F.lit("e:"), ending))
    tokens = F.array_distinct(F.concat(host, rest, names))
    return F.filter(tokens, lambda x: ~x.rlike(r"^\w+:$"))


def subsets(tokens: Column, most: int) -> Column:
    """All sets of one to ``most`` tokens of a sorted array, sorted."""
    places = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(F.array().cast("array<int>"))
    now = F.transform(places, lambda i: F.array(i))
    found = now
    for _ in range(most - 1):
        after = lambda s: F.filter(places, lambda i: i > F.element_at(s, -1))
        now = F.flatten(F.transform(now, lambda s: F.transform(after(s), lambda i: F.array_append(s, i))))
        found = F.concat(found, now)
    return F.transform(found, lambda s: F.transform(s, lambda i: tokens[i]))


def mine(labelled: DataFrame, settings: MiningSettings = SETTINGS) -> DataFrame:
    """rule_id, tokens, verdict, confidence, support of the kept rules.

    ``labelled``: tokens array, verdict. A rule goes if one with fewer of its tokens
    says the same at least as confidently. FP-growth gets each set of up to ``max_tokens``
    frequent tokens of a URL as a transaction of its own, marked with its size, so no
    itemset is longer than such a set and its verdict: the work grows with the number of
    these sets, m ** max_tokens for m frequent tokens of a URL, however many tokens URLs
    have in common. Tokens that too few URLs have leave the sets before.
    """
    rows = labelled.withColumn("url", F.monotonically_increasing_id())
    rows = written(rows.select("url", F.array_distinct("tokens").alias("tokens"), "verdict"), "labelled")
    total = rows.count()
    least = max(1, math.ceil(settings.min_support * total))
    each = rows.select("url", "verdict", F.explode("tokens").alias("token"))
    frequent = each.groupBy("token").count().where(F.col("count") >= least).select("token")
    kept = each.join(frequent, "token").groupBy("url", "verdict").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    sets = kept.select("verdict", F.explode(subsets(F.col("tokens"), settings.max_tokens)).alias("set"))
    mark = F.concat(F.size("set").cast("string"), F.lit("|"))
    verdict = F.concat(mark, F.lit("="), F.col("verdict"))
    items = F.array_append(F.transform("set", lambda t: F.concat(mark, F.lit("t"), t)), verdict)
    sets = written(sets.select(items.alias("items")), "token_sets")
    # As many URLs as without the sets: a set of a size is one transaction of its URL.
    support = min(1.0, (least - 0.5) / max(1, sets.count()))
    found = FPGrowth(minSupport=support, minConfidence=settings.min_confidence).fit(sets).freqItemsets
    # Whole sets only, with or without their verdict.
    is_verdict = lambda x: x.rlike(r"^[0-9]+\|=")
    token = lambda x: F.regexp_replace(x, r"^[0-9]+\|t", "")
    size = F.regexp_extract(F.col("items")[0], r"^([0-9]+)\|", 1).cast("int")
    found = found.select(
        F.array_sort(F.transform(F.filter("items", lambda x: ~is_verdict(x)), token)).alias("tokens"),
        F.regexp_replace(F.get(F.filter("items", is_verdict), F.lit(0)), r"^[0-9]+\|=", "").alias("verdict"),
        "freq", size.alias("size"),
    )
    found = written(found.where(F.size("tokens") == F.col("size")).drop("size"), "itemsets")
    alone = found.where("verdict IS NULL").select("tokens", F.col("freq").alias("seen"))
    implied = found.where("verdict IS NOT NULL")
    rules = implied.join(alone, "tokens").select(
        F.array_join("tokens", "\u0001").alias("rule_id"),
        "tokens",
        "verdict",
        (F.col("freq") / F.col("seen")).alias("confidence"),
        (F.col("freq") / F.lit(float(total))).alias("support"),
    )
    rules = written(rules.where(F.col("confidence") >= settings.min_confidence), "rules")
    # Shorter rules contained in a longer one, found by the inverted index.
    short, size = F.col("size"), F.size("tokens").alias("size")
    index = rules.select(F.explode("tokens").alias("token"), size, F.col("rule_id").alias("short_id"),
                         F.col("verdict").alias("says"), F.col("confidence").alias("sure"))
    within = rules.select("rule_id", "verdict", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    covered = (
        within.join(index, "token")
        .where((short < F.col("n")) & (F.col("says") == F.col("verdict")) & (F.col("sure") >= F.col("confidence")))
        .groupBy("rule_id", "short_id", "size").count().where(F.col("count") == short)
    )
    return rules.join(covered.select("rule_id").distinct(), "rule_id", "left_anti")


def judge(pages: DataFrame, rules=RULES, settings: MiningSettings = SETTINGS) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence of every page's url.

    URLs a declared rule fits get its verdict, and are what the mined rules learn from.
    The others get the verdict of the mined rule with the highest confidence, then
    support, then the smaller rule text; where none fits, the default. A null or
    malformed url has neither host nor path nor tokens and gets the default. One row
    per input row. ``confidence`` is that of the mined rule, else null.

    Only different token sets are matched: pages of one pattern cost one look-up, so a
    host with very many pages is no hot key.
    """
    host, path = parts()
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = declared(rules)
    rows = rows.select("page_id", "host", "path", url_tokens().alias("tokens"), rule.alias("rule"), verdict.alias("ruled"))
    rows = written(rows, "urls")
    labelled = rows.where("ruled IS NOT NULL").select("tokens", F.col("ruled").alias("verdict"))
    mined = mine(labelled, settings)
    index = mined.select(F.explode("tokens").alias("token"), F.size("tokens").alias("size"),
                         "rule_id", "confidence", "support", F.col("verdict").alias("said"))
    key = F.md5(F.array_join("tokens", "\u0001"))
    patterns = rows.where("ruled IS NULL").groupBy(key.alias("pattern")).agg(F.first("tokens").alias("tokens"))
    fitting = (
        patterns.select("pattern", F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy("pattern", "rule_id", "size", "confidence", "support", "said")
        .agg(F.count("*").alias("held"))
        .where("held = size")
    )
    # The best rule by one aggregate: highest confidence, support, then smallest text.
    best = F.min_by(F.struct("said", "confidence"), F.struct(-F.col("confidence"), -F.col("support"), F.col("rule_id")))
    chosen = written(fitting.groupBy("pattern").agg(best.alias("best")), "chosen")
    # Rows with a rule need no look-up and stay out of the join, where they had one key.
    open_ = rows.where("ruled IS NULL").withColumn("pattern", key).join(chosen, "pattern", "left").drop("pattern")
    judged = open_.unionByName(rows.where("ruled IS NOT NULL"), allowMissingColumns=True)
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", "best.said", F.lit(settings.default)).alias("verdict"),
        F.col("best.confidence").alias("confidence"),
    )
