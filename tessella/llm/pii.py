"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Regular expressions find base spans: e-mail addresses, IP addresses, card and phone
numbers. They seed a graph. Its instances are identifier-like tokens (with a digit or an
@), its patterns the words next to them. A pattern scores by the share of one kind
among its different instances that are known; instances of no known kind don't count
against it. Tokens next to high-confidence patterns become known, and so new spans, of
that kind; they count for other patterns as seeds do, until nothing more is found. Base
spans stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import written

# The kinds in their order. The expressions match what the plain ones
# (in the comments) match: a run that failed from its start fails from all its later
# characters, so a match starts where no run goes on, or where the last match ended.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Identifier-like tokens: runs of digit groups joined by single spaces, dashes, dots or
# parentheses, or one word that holds a digit or @.
TOKEN = (
    r"(?<![A-Za-z0-9_@.%+-])(?:\+?\(?[0-9]++(?:(?:[\x20.-]|\x20?[()]\x20?)[0-9]++)++(?![A-Za-z0-9_@%+])"
    r"|[A-Za-z_.%+-]*+[0-9@][A-Za-z0-9_@.%+-]*+)"
)
# Lengths that are added up at once: sums of places stay linear in the matches.
RUN = 256


@dataclass(frozen=True)
class BootstrapSettings:
    confidence: float = 0.9  # of a pattern that may name new identifiers
    seeds: int = 5  # different known instances such a pattern needs, found ones included


SETTINGS = BootstrapSettings()


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def total(lengths: Column, start: Column, n: Column) -> Column:
    return F.aggregate(F.slice(lengths, start, n), F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str) -> Column:
    """Array of (match, start, end, before, after) of all matches, left to right;
    places count code points, ``before`` and ``after`` are the texts up to the
    neighbouring matches."""

    def places(p):
        pieces, matches = p["pieces"], p["matches"]
        steps = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda a, b: F.length(a) + F.length(b))

        def with_steps(s):
            runs = F.transform(
                F.sequence(F.lit(0), F.floor((F.size(s) - 1) / RUN).cast("int")),
                lambda j: total(s, j * RUN + 1, F.lit(RUN)),
            )

            def with_runs(r):
                def place(match, i):
                    run = F.floor(i / RUN).cast("int")
                    end = total(r, F.lit(1), run) + total(s, run * RUN + 1, i - run * RUN + 1)
                    return F.struct(
                        match.alias("match"), (end - F.length(match)).alias("start"), end.alias("end"),
                        F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"),
                    )

                return F.transform(matches, place)

            return bound(runs, with_runs)

        return bound(steps, with_steps)

    both = F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches")
    )
    none = "array<struct<match:string,start:int,end:int,before:string,after:string>>"
    found = bound(both, lambda p: F.when(F.size(p["matches"]) > 0, places(p)))
    return F.coalesce(found, F.array().cast(none))


def luhn(digits: Column) -> Column:
    """Does a string of digits pass Luhn's test?"""
    from_right = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "")
    doubled = F.transform(
        from_right,
        lambda x, i: bound(x.cast("int") * (1 + i % 2), lambda y: F.when(y > 9, y - 9).otherwise(y)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """What a match has to satisfy besides its expression."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda x: x.cast("double") <= 255)
    if kind == "card":
        digits = F.regexp_replace(match, "[^0-9]", "")
        # Only checked where the length fits: a longer run of digits can be very long.
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def may_hold(kind: str, text: Column) -> Column:
    return {
        "email": F.contains(text, F.lit("@")),
        "phone": F.contains(text, F.lit("+")),
    }.get(kind, text.rlike("[0-9]"))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end), by kind as listed, then start."""

    def of(kind: str) -> Column:
        kept = F.filter(located(text, PATTERNS[kind]), lambda m: valid(kind, m["match"]))
        spans = F.transform(kept, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(may_hold(kind, text), spans).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>"))

    return F.concat(*[of(kind) for kind in KINDS])


def tokens(text: Column) -> Column:
    """Array of (token, start, end, left, right): identifier-like tokens and the whole words
    next to them, "" where there is none with a letter."""
    word = lambda x: F.when(x.rlike(r"\p{L}"), F.lower(x)).otherwise("")

    def of(m):
        token = F.rtrim(m["match"], F.lit(".-%+"))
        left = F.regexp_extract(m["before"], r"(?:^|\s)(\S++)\s*+$", 1)
        right = F.regexp_extract(m["after"], r"^\s*+(\S++)", 1)
        return F.struct(
            F.lower(token).alias("token"), m["start"].alias("start"), (m["start"] + F.length(token)).alias("end"),
            word(left).alias("left"), word(right).alias("right"),
        )

    none = "array<struct<token:string,start:int,end:int,left:string,right:string>>"
    found = F.transform(located(text, TOKEN), of)
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(none))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_key, base, tokens of every text, each token with the kind of the base
    span it lies in. Written, so that the texts are read once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.md5(text).alias("text_key"), base_spans(text).alias("base"), tokens(text).alias("found"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")

    def within(t):
        return F.filter(F.col("base"), lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))

    # get() is null beyond the end: a token outside all base spans has no kind.
    marked = F.transform("found", lambda t: F.struct(t.alias("t"), F.get(within(t), F.lit(0))["kind"].alias("kind")))
    return rows.select("row", "doc_id", "text_key", "base", marked.alias("tokens"))


def discovered(rows: DataFrame, settings: BootstrapSettings) -> DataFrame:
    """row, doc_id, text_key, kind, start, end of the spans that the patterns add.

    Instances of a pattern are counted once each, however often a token occurs, and
    before anything is joined; only tokens outside base spans are ever joined with
    patterns.
    """
    seen = rows.select("row", "doc_id", "text_key", F.explode("tokens").alias("x")).select(
        "row", "doc_id", "text_key", "x.kind", "x.t.token", "x.t.start", "x.t.end", "x.t.left", "x.t.right"
    )
    sides = F.filter(
        F.array(
            F.when(F.col("left") != "", F.concat(F.lit("L "), "left")),
            F.when(F.col("right") != "", F.concat(F.lit("R "), "right")),
            F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B "), "left", F.lit(" "), "right")),
        ),
        lambda p: p.isNotNull(),
    )
    edges = seen.select(F.explode(sides).alias("pattern"), "token", "kind").distinct()
    edges = written(edges, "edges")
    open_ = written(edges.where("kind IS NULL").select("pattern", "token"), "open")
    seeds = edges.where("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
    seeds = written(seeds, "seeds")
    named = written(open_.select("token", F.lit("").alias("kind")).limit(0), "named")
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    while True:
        gained = open_.join(named, "token").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
        known = seeds.union(gained).groupBy("pattern", "kind").agg(F.sum("n").alias("n"))
        kinds = known.groupBy("pattern").agg(F.max(F.struct("n", (-place).alias("place"), "kind")).alias("best"), F.sum("n").alias("all"))
        sure = F.col("best.n") / F.col("all")
        patterns = kinds.where((sure >= settings.confidence) & (F.col("best.n") >= settings.seeds))
        patterns = patterns.select("pattern", sure.alias("sure"), "best.n", "best.place", "best.kind")
        # A token takes the kind of its surest pattern, for good: the rounds come to an end.
        new = open_.join(named, "token", "left_anti").join(patterns, "pattern")
        new = new.groupBy("token").agg(F.max(F.struct("sure", "n", "place", "kind"))["kind"].alias("kind"))
        new = written(new, "new")
        if new.isEmpty():
            break
        named = written(named.union(new), "named")
    return seen.where("kind IS NULL").drop("kind").join(named, "token").select("row", "doc_id", "text_key", "kind", "start", "end")


def found_spans(docs: DataFrame, settings: BootstrapSettings = SETTINGS) -> DataFrame:
    """doc_id, base, spans of every whole text: arrays of (kind, start, end).

    Places count code points, the end is exclusive; spans are ordered by kind as listed,
    then start. A null or empty text has none. One row per input row, repeated rows
    included. Only doc_id and text are read.
    """
    rows = scanned(docs)
    span = F.struct("kind", "start", "end")
    more = discovered(rows, settings).groupBy("row").agg(F.collect_set(span).alias("more"))
    # All spans of a kind in order of their start.
    both = F.array_union("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    place = F.transform(both, lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(place), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(more, "row", "left").select("doc_id", "base", ordered.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(docs: DataFrame, settings: BootstrapSettings = SETTINGS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found_spans(docs, settings).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def masked(text: Column, kind: str) -> Column:
    """The text with a tag in place of each base span of a kind."""
    tag = F.lit(f"[{kind.upper()}]")

    def put(p):
        kept = F.transform(p["matches"], lambda m: F.when(valid(kind, m), tag).otherwise(m))
        return F.array_join(F.zip_with(p["pieces"], kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    pieces = F.split(text, PATTERNS[kind], -1).alias("pieces")
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("matches")
    return bound(F.struct(pieces, matches), put)


def redacted(docs: DataFrame, settings: BootstrapSettings = SETTINGS) -> DataFrame:
    """All columns of ``docs``; spans in ``text`` become [EMAIL], [IP], [CARD], [PHONE].

    What the patterns add is put in first (by place), then each kind's own matches. A
    null text stays null. ``n_chars``, where there is such a column, follows the text. Rows
    are told apart by id and text, so rows without id and rows that repeat one get their own
    spans. Other columns, of any name, are handed on.
    """
    rows = scanned(docs)
    span = F.struct("start", "end", "kind")
    more = discovered(rows, settings).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(span)).alias("more"))
    more = more.select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"), "more")
    # The row goes along as one value, so that none of its columns clashes.
    whole = docs.select(F.struct("*").alias("doc"), F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text"))
    old = F.col("doc.text")

    def step(state, s):
        # Places are those of the old text; spans of one text that overlap count once.
        fresh = s["start"] >= state["at"]
        part = F.substring(old, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.when(fresh, F.concat(state["out"], part, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(state["out"]).alias("out"),
            F.when(fresh, s["end"]).otherwise(state["at"]).alias("at"),
        )

    def rest(state):
        return F.concat(state["out"], F.substring(old, state["at"] + 1, F.length(old)))

    named = F.aggregate("more", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, rest)
    out = whole.join(more, same, "left").select("doc", F.coalesce(named, old).alias("text"))
    text = F.col("text")
    for kind in KINDS:
        out = out.withColumn("text", F.when(may_hold(kind, text), masked(text, kind)).otherwise(text))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
