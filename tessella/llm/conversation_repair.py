"""Repair of the structure of conversations by weighted interval parsing (CYK).

A conversation is right if its roles' initials read ``(s?(ua)+)?``. The repair grammar, in
Chomsky normal form, has a nonterminal for each pair of places in that pattern: it derives
the spans of rows whose edited roles lead from one place to the other. A cell of the chart
holds, for each nonterminal of a span, the cheapest edits as (cost, audit): the letters
Delete, Insert, Keep, Rerole in order, the least of the cheapest. A leaf is one row with
what may be inserted before it (the insertion closure); spans of 1, 2, 4, … leaves are
joined bottom-up. As nonterminals are pairs of places, any split of a span gives the same
cell, so one is enough. Two edits of the same rows never begin with one another at the same
cost, so the least audits of two spans make the least audit of both.

Rows are sorted by ranges, so that a long conversation spans many tasks; leaves are
parsed by chunks of bounded size. Only what the result holds as one value for a
conversation (its audit, its hash) meets in one task, texts as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import BoundedCache, written

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # places in the pattern
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
Cell = dict[tuple[int, int], tuple[int, str]]


@dataclass(frozen=True)
class RepairSettings:
    delete: int = 3
    insert: int = 2
    rerole: int = 2
    truncated: int = 1  # for a truncated row that stays
    chunk_bits: int = 9  # rows of a chunk, as a power of two


SETTINGS = RepairSettings()


class Parser:
    """Cells of spans; a row is a letter, made by ``letter``."""

    def __init__(self, settings: RepairSettings):
        self.costs = settings
        self.cells: dict[str, Cell] = BoundedCache(200_000)
        self.closure: Cell = {(p, p): (0, "") for p in range(4)}
        for _ in range(2):
            step = {(p, q): (settings.insert, "I") for (p, initial), q in STEPS.items() if initial in "ua"}
            self.closure = least(self.closure, joined(self.closure, step))

    def leaf(self, code: str) -> Cell:
        initial, fault = "sua-"[(ord(code) - 65) // 4], (ord(code) - 65) % 4
        edits: Cell = {(p, p): (self.costs.delete, "D") for p in range(4)}
        if fault not in (1, 2):
            extra = self.costs.truncated if fault == 3 else 0
            for (p, role), q in STEPS.items():
                if role in "ua":
                    edits = least(edits, {(p, q): (self.costs.rerole + extra, "R")})
                if role == initial:
                    edits = least(edits, {(p, q): (extra, "K")})
        return joined(self.closure, edits)

    def span(self, codes: str) -> Cell:
        """The cell of a span of rows, from those of its parts by length."""
        known = self.cells.get(codes)
        if known is not None:
            return known
        row = [self.cells.get(c) or self.cells.put(c, self.leaf(c)) for c in codes]
        return self.cells.put(codes, folded(row))

    def repaired(self, cells: list[Cell]) -> tuple[int, str]:
        """Cost and audit of spans in order that make a whole conversation."""
        whole = joined(folded(cells), self.closure)
        return min(whole[START, q] for q in (START, ASSISTANT) if (START, q) in whole)


def least(a: Cell, b: Cell) -> Cell:
    return a | {key: min(value, a.get(key, value)) for key, value in b.items()}


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: A -> B C over all pairs that meet."""
    out: Cell = {}
    for (p, middle), (cost, audit) in left.items():
        for (start, q), (more, rest) in right.items():
            if start == middle:
                value = (cost + more, audit + rest)
                if (p, q) not in out or value < out[p, q]:
                    out[p, q] = value
    return out


def folded(cells: list[Cell]) -> Cell:
    """Neighbours joined to spans of twice the length until one is left."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def packed(cell: Cell) -> str:
    return "|".join(f"{p}{q}{cost}:{audit}" for (p, q), (cost, audit) in cell.items())


def unpacked(text: str) -> Cell:
    out = {}
    for part in text.split("|"):
        cost, audit = part[2:].split(":")
        out[int(part[0]), int(part[1])] = (int(cost), audit)
    return out


def scripts(audit: str, codes: list[str]) -> list[list[str]]:
    """For each row of each chunk ``before|edit|after``: initials of the roles inserted
    before it, its edit (K, D, or the initial of its new role), those after the last row."""
    place, out, before = START, [[] for _ in codes], ""
    rows = ((chunk, code) for chunk, text in enumerate(codes) for code in text)
    chunk = 0
    for edit in audit:
        new = "a" if place == USER else "u"
        if edit == "I":
            before, place = before + new, STEPS[place, new]
            continue
        chunk, code = next(rows)
        if edit == "K":
            place = STEPS[place, "sua-"[(ord(code) - 65) // 4]]
        elif edit == "R":
            edit, place = new, STEPS[place, new]
        out[chunk].append(f"{before}|{edit}|")
        before = ""
    if before and out:
        out[chunk][-1] += before
    return out


# Rows ---------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv (the id as text), conv_id, turn, role, text after the contract's damage: by the
    CRC of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 removes its
    full stops, exclamation and question marks, 3 repeats it, 4 sets its role to user.
    A null counts as one space, but for turns, which only are a space in the CRC's text."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    rows = rows.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return rows.select("conv_id", "turn", "role", "text")


def placed(rows: DataFrame) -> DataFrame:
    """Rows in their order, which ``place`` numbers over all conversations; a long
    conversation is dealt to several tasks. Ties of turn go by role, then text."""
    conv = F.col("conv_id").cast("string").alias("conv")
    rows = rows.select(conv, "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # The beginning of a text is enough to deal rows of one turn; they are sorted by all of it.
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    rows = rows.repartitionByRange(*keys, F.substring("text", 1, 32)).sortWithinPartitions(*keys, "text")
    return written(rows.withColumn("place", F.monotonically_increasing_id()), "turns")


def coded(rows: DataFrame) -> DataFrame:
    """conv, place and code: the letter that says a row's initial and first fault."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    slim = rows.select(
        "conv", "place", "role", F.md5("text").alias("text_key"),
        F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12).alias("initial"),
        F.when(end == "", 1).when(~F.substring(end, -1, 1).isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
    )
    slim = written(slim, "turn_faults")
    seen = slim.groupBy("conv", "role", "text_key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = slim["conv"].eqNullSafe(seen["conv"]) & (slim["role"] == seen["role"]) & (slim["text_key"] == seen["text_key"])
    again = slim.join(seen, same).where(F.col("place") > F.col("first")).select("place", F.lit(2).alias("again"))
    fault = F.when(F.col("fault") == 1, 1).otherwise(F.coalesce("again", "fault"))
    return slim.join(again, "place", "left").select("conv", "place", F.char(F.col("initial") + fault + 65).alias("code"))


def repairs(rows: DataFrame, settings: RepairSettings = SETTINGS) -> DataFrame:
    """conv, blank, duplicate, truncated, illegal, cost, audit and, for each chunk of rows,
    its number, its first place and the scripts of its rows. ``rows`` as placed() has them."""

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser(settings)
        for frame in frames:
            yield frame.assign(cell=[packed(parser.span(codes)) for codes in frame["codes"]])

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser(settings)
        for frame in frames:
            out = []
            for conv, codes, parts in zip(frame["conv"], frame["codes"], frame["cells"]):
                codes, text = list(codes), "".join(codes)
                cost, audit = parser.repaired([unpacked(c) for c in parts])
                faults = [(ord(c) - 65) % 4 for c in text]
                initials = "".join("sua-"[(ord(c) - 65) // 4] for c in text)
                illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
                out.append((conv, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, scripts(audit, codes)))
            names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "scripts"]
            yield pd.DataFrame(out, columns=names).assign(chunks=frame["chunks"].to_numpy(), firsts=frame["firsts"].to_numpy())

    chunk = F.shiftright("place", settings.chunk_bits).alias("chunk")
    ordered = F.sort_array(F.collect_list(F.struct("place", "code")))
    chunks = coded(rows).groupBy("conv", chunk).agg(ordered.alias("all"))
    chunks = chunks.select("conv", "chunk", F.col("all")[0]["place"].alias("first"), F.array_join("all.code", "").alias("codes"))
    chunks = chunks.mapInPandas(cells, "conv string, chunk long, first long, codes string, cell string")
    whole = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "first", "codes", "cell"))).alias("all"))
    whole = whole.select("conv", *[F.col(f"all.{a}").alias(b) for a, b in (("chunk", "chunks"), ("first", "firsts"), ("codes", "codes"), ("cell", "cells"))])
    schema = (
        "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "scripts array<array<string>>, chunks array<long>, firsts array<long>"
    )
    return written(whole.mapInPandas(parse, schema), "repairs")


def edited(rows: DataFrame, found: DataFrame, settings: RepairSettings = SETTINGS) -> DataFrame:
    """Every row with its edit: conv, place, turn, edit (K, R, D), role and text as
    repaired, and the roles of empty rows inserted before it and after it."""
    chunk = F.explode(F.arrays_zip("chunks", "firsts", "scripts")).alias("chunk")
    script = found.select(F.col("conv").alias("of"), chunk).select("of", "chunk.*").withColumnsRenamed({"scripts": "script"})
    here = F.col("conv").eqNullSafe(F.col("of")) & (F.shiftright("place", settings.chunk_bits) == F.col("chunks"))
    parts = F.split(F.element_at("script", (F.col("place") - F.col("firsts") + 1).cast("int")), "[|]")
    named = lambda c: F.when(c == "u", "user").otherwise("assistant")
    inserted = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), named)
    rows = rows.join(script, here).withColumn("parts", parts)
    edit = F.col("parts")[1]
    return rows.select(
        "conv", "place", "turn", F.when(edit.isin("K", "D"), edit).otherwise("R").alias("edit"),
        F.when(edit.isin("K", "D"), F.col("role")).otherwise(named(edit)).alias("role"), "text",
        inserted(F.col("parts")[0]).alias("before"), inserted(F.col("parts")[2]).alias("after"),
    )


def digests(rows: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its repaired ``role:text`` lines, read in order as a stream."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, any_line, begun = None, None, False, False
        for frame in frames:
            out = []
            for conv, lines in zip(frame["conv"], frame["lines"]):
                if not begun or conv != now:
                    if begun:
                        out.append((now, state.hexdigest()))
                    now, state, any_line, begun = conv, hashlib.sha256(), False, True
                if lines is not None:
                    state.update((("\n" if any_line else "") + lines).encode())
                    any_line = True
            yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
        if begun:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["conv", "repaired_sha256"])

    empty = lambda c: F.transform(c, lambda role: F.concat(role, F.lit(":")))
    own = F.when(F.col("edit") == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat("role", F.lit(":"), "text")))
    lines = F.concat(empty("before"), own, empty("after"))
    lines = F.when(F.size(lines) > 0, F.array_join(lines, "\n")).alias("lines")
    dealt = rows.select("conv", "place", lines).repartition("conv").sortWithinPartitions("conv", "place")
    return dealt.mapInPandas(run, "conv string, repaired_sha256 string")


def report(original: DataFrame, rows: DataFrame, settings: RepairSettings = SETTINGS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of
    every conversation of ``original``, whose rows now are ``rows`` (conv_id, turn, role, text).

    A null conv_id is a conversation of its own. Null roles and texts count as one space;
    an empty role, as any other beside s, u and a, fits nowhere in the pattern.
    Rows go by turn, nulls first, ties by role and then text; equal rows are duplicates of
    the first. Gaps leave null turns out; they are null where they exceed 64 bits. A
    conversation without rows has zeros, an empty audit and the hash of the empty text. Very
    long texts only pass through. Other columns are not read.
    """
    rows = placed(rows)
    found = repairs(rows, settings)
    hashes = digests(edited(rows, found, settings))
    width = F.col("most").cast("decimal(20,0)") - F.col("least").cast("decimal(20,0)") + 1 - F.col("turns")
    turns = rows.groupBy("conv").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("turns"))
    turns = turns.select("conv", F.when(F.col("turns") == 0, 0).otherwise(width).try_cast("long").alias("gaps"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    all_ = original.select("conv_id").distinct().withColumn("conv", F.col("conv_id").cast("string"))
    for part in (turns, found.select("conv", *counts, "audit"), hashes):
        part = part.withColumnRenamed("conv", "of")
        all_ = all_.join(part, F.col("conv").eqNullSafe(F.col("of")), "left").drop("of")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    none = F.lit(hashlib.sha256().hexdigest())
    gaps = F.when(F.col("audit").isNull(), 0).otherwise(F.col("gaps")).cast("long").alias("gaps")
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    return all_.select("conv_id", gaps, *map(zero, counts), audit, F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def repaired(conversations: DataFrame, settings: RepairSettings = SETTINGS) -> DataFrame:
    """The repaired conversations: conv_id, row, role, text, in the order of ``row``.
    Inserted rows have an empty text."""
    rows = placed(conversations)
    done = edited(rows, repairs(rows, settings), settings)
    new = lambda c: F.transform(c, lambda role: F.struct(role.alias("role"), F.lit("").alias("text")))
    own = F.array(F.struct("role", "text"))
    kept = F.when(F.col("edit") == "D", F.slice(own, 1, 0)).otherwise(own)
    lines = F.posexplode(F.concat(new("before"), kept, new("after"))).alias("nth", "line")
    kind = conversations.schema["conv_id"].dataType
    done = done.select(F.col("conv").cast(kind).alias("conv_id"), "place", lines)
    return done.select("conv_id", F.struct("place", "nth").alias("row"), "line.role", "line.text")
