"""Spans that patterns add, against plain rounds in Python, and what is redacted."""

import random
import re

import regex
from test_llm_documents import frame, plain_spans

from tessella.llm import pii


def occurrences(text):
    """Token, start, end, left and right word, kind of the base span it lies in."""
    base = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in plain_spans(text).split(",") if s)]
    found, out = list(regex.finditer(pii.TOKEN, text)), []
    for i, m in enumerate(found):
        before = text[found[i - 1].end() if i else 0 : m.start()].split()
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)].split()
        token = m[0].rstrip(".-%+")
        end = m.start() + len(token)
        word = lambda w: w.lower() if regex.search(r"\p{L}", w) else ""
        kinds = [k for k, a, b in base if a < end and b > m.start()]
        out.append((token.lower(), m.start(), end, word(before[-1] if before else ""), word(after[0] if after else ""), kinds[0] if kinds else None))
    return out


def plain_rounds(rows, confidence=0.9, seeds=5):
    """(row, kind, start, end) of the spans that patterns add."""
    seen, edges = [], set()
    for row, (_, text) in enumerate(rows):
        for token, start, end, left, right, kind in occurrences(text or ""):
            seen.append((row, token, start, end, kind))
            sides = [f"L {left}"] * (left != "") + [f"R {right}"] * (right != "") + [f"B {left} {right}"] * (left != "" and right != "")
            edges |= {(p, token, kind) for p in sides}
    named = {}
    while True:
        counts = {}
        for p, token, kind in edges:
            kind = kind or named.get(token)
            if kind:
                counts.setdefault(p, {}).setdefault(kind, [0])[0] += 1
        sure = {}
        for p, of in counts.items():
            n, place, kind = max((c[0], -pii.KINDS.index(k), k) for k, c in of.items())
            share = n / sum(c[0] for c in of.values())
            if share >= confidence and n >= seeds:
                sure[p] = (share, n, place, kind)
        new = {}
        for p, token, kind in edges:
            if kind is None and token not in named and p in sure:
                new[token] = max(new.get(token, (0,)), sure[p])
        if not new:
            return {(row, named[t], a, b) for row, t, a, b, kind in seen if kind is None and t in named}
        named |= {t: v[3] for t, v in new.items()}


def added(spans, text):
    base = set(plain_spans(text or "").split(","))
    return {s for s in spans.split(",") if s and s not in base}


def test_rounds_against_plain_python(spark):
    rnd = random.Random(8)
    names = [f"user{i}" for i in range(25)] + ["(555) 555-0123", "555 0199", "+1 20", "12-34", "x_9"]
    words = ["mail:", "Call", "at", "ring", "the", "—", "12", "section", "w" * 60]
    rows = []
    for i in range(400):
        n = rnd.choice(names)
        token = rnd.choice([n, f"{n.replace(' ', '')}@x.org", f"10.0.0.{rnd.randint(1, 30)}", "+49 30 123456 7"])
        lead = "mail: " if "@" in token or rnd.random() < 0.1 else rnd.choice(words) + " "
        rows.append((i, " ".join(rnd.choices(words, k=2)) + " " + lead + token + rnd.choice([" ", "  ", "\n", "."]) + rnd.choice(words)))
    rows += [(7, "mail: user3 today"), (None, "mail: user4 today"), (900, None), (901, "")]
    got = {}
    for r in pii.found_spans(frame(spark, rows)).collect():
        key = (r["doc_id"], tuple(tuple(s) for s in r["spans"]))
        got[key] = got.get(key, 0) + 1
    want, more = {}, plain_rounds(rows)
    assert 20 < len(more)
    for row, (doc, text) in enumerate(rows):
        base = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in plain_spans(text or "").split(",") if s)]
        spans = set(base) | {s[1:] for s in more if s[0] == row}
        key = (doc, tuple(sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))))
        want[key] = want.get(key, 0) + 1
    assert got == want


def planted(context, kind="user{}@x.org"):
    return [(i, f"{context}{kind.format(i)} today") for i in range(8)]


def test_whole_words_are_context(spark):
    """Words alike in their last 40 letters are different, and gaps don't matter."""
    rows = planted("q" * 10 + "a:" * 40 + " ") + planted("reach me" + " " * 60)
    rows += [(100, "z" * 10 + "a:" * 40 + " room9 xx"), (101, "q" * 10 + "a:" * 40 + " room8 xx"), (102, "reach me" + " " * 60 + "room7 xx")]
    spans = {r["doc_id"]: r["spans"] for r in pii.span_digests(frame(spark, rows)).collect() if r["doc_id"] >= 100}
    assert spans == {100: "", 101: "email:91:96", 102: "email:68:73"}


def test_a_number_in_groups_is_one_token(spark):
    rows = planted("ring me: ", "+1 555 555 01{}0") + [(100, "ring me: (555) 555-0123 today"), (101, "ring me: 12 34abc later")]
    texts = {r["doc_id"]: r["text"] for r in pii.redacted(frame(spark, rows)).collect()}
    assert texts[100] == "ring me: [PHONE] today"
    assert texts[101] == "ring me: [PHONE] 34abc later"


def test_rows_without_id_and_with_one_id_are_redacted_apart(spark):
    rows = planted("mail: ") + [(100, "mail: user8 today"), (100, "a wholly different text under the same id, forty chars")]
    rows += [(None, "mail: user8 today"), (None, "nothing here at all to see"), (None, None), (100, "mail: user8 today")]
    got = sorted((r["text"] or "") for r in pii.redacted(frame(spark, rows)).collect() if r["doc_id"] in (None, 100))
    assert got == ["", "a wholly different text under the same id, forty chars"] + ["mail: [EMAIL] today"] * 3 + ["nothing here at all to see"]


def test_clashing_columns_are_handed_on(spark):
    names = ["doc_id", "text", "n_chars", "more", "of", "pii_doc", "row", "doc", "text_key"]
    df = spark.createDataFrame([(1, "to a@b.c", 8, "m", "o", "p", "r", "d", "t")], "doc_id long, text string, n_chars int, " + ", ".join(f"{n} string" for n in names[3:]))
    out = pii.redacted(df)
    assert out.columns == names
    assert tuple(out.first()) == (1, "to [EMAIL]", 10, "m", "o", "p", "r", "d", "t")
    assert pii.redacted(df.limit(0)).count() == 0


def test_digits_beyond_measure_end(spark):
    rows = [(1, "1 " * 30_000), (2, "a" * 60_000 + " 5"), (3, "- " * 30_000 + "7"), (4, "(" * 20_000 + "7")]
    assert pii.span_digests(frame(spark, rows)).count() == 4
    assert re.fullmatch("[0-9a-f]{64}", pii.span_digests(frame(spark, rows)).first()["base_sha256"])
