"""Conversation repair against a plain recursion over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache

import pytest

from sluice.llm import conversations as c
from sluice.llm.queries import QUERIES

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(rows):
    """(conv, turn, role, text) after damage."""
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain(rows):
    """Answer for the rows of one conversation, by recursion over the rows from behind."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        rest = text.strip(SPACES)
        faults.append("b" if not rest else "d" if (role, text) in seen else "" if rest[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(at, last, inserted=0):
        options = [(0, "")] if at == len(rows) and last in ("", "a") else []
        for initial in after[last]:
            if inserted < 3 and initial != "s":
                cost, rest = best(at, initial, inserted + 1)
                options.append((cost + 5, "I" + rest))
        if at < len(rows):
            cost, rest = best(at + 1, last)
            options.append((cost + 2, "D" + rest))
            if faults[at] in ("", "t"):
                for initial in after[last]:
                    more = 5 * (faults[at] == "t")
                    cost, rest = best(at + 1, initial)
                    if initial == initials[at]:
                        options.append((cost + more, "K" + rest))
                    if initial != "s":
                        options.append((cost + more + 1, "R" + rest))
        return min(options, default=(10**9, ""))

    for at in range(len(rows), 0, -1):  # from behind, so that the recursion stays shallow
        for last in after:
            best(at, last)
    cost, edits = best(0, "")
    lines, last, at = [], "", 0
    for e in edits:
        role, text = (rows[at][2], rows[at][3]) if e != "I" else ("", "")
        at += e != "I"
        if e in "IR":
            role = "assistant" if last == "u" else "user"
        if e != "D":
            lines.append(f"{role}:{text}")
            last = role[0]
    turns = [r[1] for r in rows if r[1] is not None]
    count = Counter(faults)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        count["b"], count["d"], count["t"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def expected(rows):
    found = {conv: [] for conv, *_ in rows}
    for row in damage(rows):
        found[row[0]].append(row)
    return {conv: plain(own) for conv, own in found.items()}


def answers(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def audited(df):
    return answers(c.audit(c.damaged(c.turns_of(df))))


def test_op12_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_conversation_repair"](spark, data)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert answers(found) == expected(rows)


@pytest.fixture
def made():
    """Conversations of 0 to 40 rows of all kinds, and long ones that need many runs of the search."""
    rng = random.Random(3)
    roles, ends = ["system", "user", "assistant", "tool", "", None], [".", "!", "?", "", " ", "…"]
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 40])):
            role = rng.choices(roles, [1, 8, 8, 1, 0.3, 0.3])[0]
            text = rng.choice([None, "", "same.", "a ", " ", f"text {turn}" + rng.choice(ends)])
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), role, text))
    for conv, roles in ((1000, "ua"), (1001, "u"), (1002, "a"), (1003, "suaaxu"), (1004, "x"), (1005, "s")):
        names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
        rows += [(conv, t, names[roles[t % len(roles)]], f"line {t}" + ends[rng.randrange(8) // 2]) for t in range(300)]
    rows += rows[:200]  # repeated rows
    return rows


def test_every_kind_of_conversation(spark, made):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(made, schema).repartition(5)
    assert audited(df) == expected(made)
    named = df.selectExpr("conv_id AS said", "turn AS lost", "role AS conv", "text AS first_turn", "1 AS kind", "2 AS copy")
    assert answers(c.audit(c.damaged(c.turns_of(named, "said", "lost", "conv", "first_turn")))) == expected(made)


def test_ids_of_other_types_and_no_rows(spark, made):
    schema = "conv_id long, turn int, role string, text string"
    df = spark.createDataFrame(made[:400], schema).selectExpr("CAST(conv_id AS string) AS conv_id", "turn", "role", "text")
    rows = [(None if r[0] is None else str(r[0]), *r[1:]) for r in made[:400]]
    assert audited(df) == expected(rows)
    assert audited(df.filter("false")) == {}


def test_a_huge_text_and_nulls_only(spark):
    rows = [(1, 0, "user", "x" * 5_000_000 + "."), (1, 1, "assistant", "y."), (2, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert audited(df) == expected(rows)


@pytest.mark.parametrize("codes", ["", "-", "uu", "aaaa", "uUaA-sxs", "xxxxxxxx", "AUAUAUAU", "sssuuuaaa"])
def test_search_between_all_states(codes):
    """Every pair of states against all edits of bounded cost."""

    def every(at, state, left):  # all edits from a state on
        yield "", at, state, 0
        if at < len(codes):
            options = [("D", 2, state, at + 1)]
            code, cut = codes[at], 5 * codes[at].isupper()
            if code != "-":
                if code.lower() in c.FOLLOWS[state]:
                    options.append(("K", cut, c.FOLLOWS[state][code.lower()], at + 1))
                options.append(("R", 1 + cut, c.FORCED[state][0], at + 1))
        else:
            options = []
        options.append(("I", 5, c.FORCED[state][0], at))
        for edit, cost, to, then in options:
            if cost <= left:
                yield from ((edit + e, i, s, cost + more) for e, i, s, more in every(then, to, left - cost))

    for start in range(4):
        for goals in [(0,), (1,), (2,), (3,), (0, 3)]:
            found = c.cheapest(codes, start, goals)
            most = 12 if found is None else found[0]
            reached = [(cost, e) for e, i, s, cost in every(0, start, most) if i == len(codes) and s in goals]
            assert found == min(reached, default=None)
