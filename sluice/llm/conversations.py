"""Repair of conversation structure: damaged turns are found, and the cheapest edits that make the roles legal.

A legal conversation has role initials ``(s?(ua)+)?``: at most one system turn
first, then user and assistant in turn.  Edits keep a row (K), give it the role
user or assistant (R), delete it (D) or insert an empty turn (I).  Of the
cheapest edits those whose initials come first in ASCII order are taken.

They are found by iterative-deepening A*: a depth-first search that tries edits
in ASCII order and turns back where the cost so far and a lower bound of the
rest exceed the bound at hand; the bound rises to the next value that any
branch asked for.  What failed is remembered per place and state with the cost
it needs at least, so a place is not searched again for less.

Conversations stream through their task in the order of their turns.  Short
ones are searched as a whole.  Longer ones are searched in runs of ``RUN`` rows,
from every state to every state; between runs only the best edits for each of
the four states are kept, each with the running digest of its repaired text, so
that a conversation of any length needs little memory.  This is exact: of two
edits of the same rows with the same cost and end none is the beginning of the
other, so their order holds whatever follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach

#: What edits cost, and white space
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: States are what the last turn was (none, system, user, assistant) and say which turn may follow
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: the state after a turn is inserted or given another role, and that role
FORCED = tuple((ASSISTANT, "assistant") if state == USER else (USER, "user") for state in range(4))
LEGAL = frozenset({"su", "ua", "au"})
#: what it costs more at most to go on after an assistant's turn instead of from this state
MIMICKED = {START: DELETE, SYSTEM: KEEP}
#: rows that are searched at once
RUN = 32
#: codes of a row: its role's initial, upper case if the text is cut off; what must go is GONE
GONE = "-"


def turns_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, lost: a table of turns as the audit takes it; a null role or text is one space."""
    space = F.lit(" ")
    return df.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        F.lit(False).alias("lost"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns after damage by ``crc32(conv:turn) % 20``, where a null is one space; dropped ones are marked ``lost``."""
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv", "turn")]
    kind = F.col("kind")
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    shown = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        turns.withColumn("kind", F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20)
        .withColumn("copy", copies)
        .select(
            "conv",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            shown.alias("text"),
            (F.col("lost") | (kind == 0)).alias("lost"),
        )
    )


def with_first(rows: DataFrame) -> DataFrame:
    """Add ``first_turn``, the first turn of the conversation with this role and text, and ``no_turn``, whether that is null.

    Equal rows are reduced in each task before they move, so a row repeated any number of times is one.
    """
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    marked = rows.withColumn("said", F.when(~F.col("lost"), digest))
    firsts = (
        marked.filter("NOT lost")
        .groupBy("conv", "said")
        .agg(F.min("turn").alias("first_turn"), F.expr("bool_or(turn IS NULL)").alias("no_turn"))
    )
    return attach(marked, firsts, ["conv", "said"], null_safe=True)


@dataclass
class Answer:
    """What is known of a conversation."""

    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    last_turn: int | None = None
    last_initial: str | None = None
    last_said: tuple | None = None
    held: list[tuple[str, str, str]] = field(default_factory=list)
    #: per state reached: cost, initials of the edits since ``audit``, digest of the repaired text, whether it is empty
    best: dict[int, tuple[int, str, object, bool]] = field(default_factory=lambda: {START: (0, "", hashlib.sha256(), True)})
    audit: list[str] = field(default_factory=list)

    def add(self, turn: int | None, role: str, text: str, said: str, repeated: bool) -> None:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        end = text.rstrip(BLANKS)
        again = repeated or self.last_said == (turn, said)
        self.last_turn, self.last_said = turn, (turn, said)
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        code = initial if initial in ("s", "u", "a") else "x"
        if not end:
            self.blank += 1
            code = GONE
        elif again:
            self.duplicate += 1
            code = GONE
        elif end[-1] not in ".!?":
            self.truncated += 1
            code = code.upper()
        self.held.append((code, role, text))
        if len(self.held) > RUN:
            self._search(RUN)

    def _search(self, rows: int, ends: tuple[int, ...] | None = None) -> None:
        """Carry the best edits over the first ``rows`` held rows; the last time only to where a conversation may end."""
        run, self.held = self.held[:rows], self.held[rows:]
        codes = "".join(code for code, _, _ in run)
        reached: dict[int, tuple[int, str, int, str]] = {}
        for goals in [ends] if ends else [(s,) for s in range(4)]:
            for start, (cost, audit, _, _) in self.best.items():
                found = cheapest(codes, start, goals)
                if found is None:
                    continue
                state = goals[0] if len(goals) == 1 else -1
                new = (cost + found[0], audit + found[1], start, found[1])
                if state not in reached or new[:2] < reached[state][:2]:
                    reached[state] = new
        near = min((reached[s][0] + c for s, c in ((ASSISTANT, 0), (USER, INSERT)) if s in reached), default=None)
        best = {}
        for state, (cost, audit, start, edits) in reached.items():
            if near is not None and state in MIMICKED and near + MIMICKED[state] < cost:
                continue  # another state can follow the same rows for less
            digest, empty = self.best[start][2].copy(), self.best[start][3]
            for line in repaired(edits, run, start):
                digest.update((line if empty else "\n" + line).encode("utf-8"))
                empty = False
            best[state] = (cost, audit, digest, empty)
        same = commonprefix([audit for _, audit, _, _ in best.values()])
        self.audit.append(same)
        self.best = {s: (cost, audit[len(same) :], digest, empty) for s, (cost, audit, digest, empty) in best.items()}

    def row(self) -> tuple:
        self._search(len(self.held), (START, ASSISTANT))
        cost, rest, digest, _ = self.best[-1]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
            "".join(self.audit) + rest, digest.hexdigest(),
        )


def repaired(edits: str, rows: list[tuple[str, str, str]], state: int) -> Iterator[str]:
    """The lines ``role:text`` that the edits leave."""
    at = 0
    for edit in edits:
        if edit == "I":
            state, role = FORCED[state]
            yield f"{role}:"
            continue
        code, role, text = rows[at]
        at += 1
        if edit == "K":
            state = FOLLOWS[state][code.lower()]
            yield f"{role}:{text}"
        elif edit == "R":
            state, role = FORCED[state]
            yield f"{role}:{text}"


def least_costs(codes: str) -> list[int]:
    """Per place what the rest costs at least: a deletion for each row that must go or is cut off, and half an edit
    for each pair of sound neighbours that may not follow each other, as an edit of cost 1 or more mends two of them at most."""
    least, pairs, right = [0], 0, None
    fixed = 0
    for code in reversed(codes):
        if code == GONE:
            fixed += DELETE
        elif code.isupper():
            fixed += min(DELETE, CUT)
            right = None  # if it goes, its neighbours meet
        else:
            if right is not None and code + right not in LEGAL:
                pairs += 1
            right = code
        least.append(fixed + (pairs + 1) // 2)
    return least[::-1]


@lru_cache(maxsize=100_000)
def cheapest(codes: str, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and initials of the edits of these rows that lead from a state to a goal; of equal cost the ASCII-least."""
    rows, least = len(codes), least_costs(codes)
    if start != START and not {start, USER, ASSISTANT}.intersection(goals) or goals == (START,) != (start,):
        return None  # nothing leads back to the first states; all others are reached by two insertions at most
    if goals == (SYSTEM,) and start == START and "s" not in codes.lower():
        return None
    #: what a place and state need at least, as far as failed searches have shown
    needs: dict[tuple[int, int], int] = {}

    def search(at: int, state: int, left: int) -> str | None:
        if at == rows and state in goals:
            return ""
        key = (at, state)
        if needs.get(key, least[at]) > left:
            return None
        need = None
        for edit, cost, to, next_at in steps(at, state):
            bound = cost + needs.get((next_at, to), least[next_at])
            if bound <= left:
                rest = search(next_at, to, left - cost)
                if rest is not None:
                    return edit + rest
                bound = cost + needs.get((next_at, to), least[next_at])
            need = bound if need is None else min(need, bound)
        needs[key] = max(need, left + 1)
        return None

    def steps(at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        code = codes[at] if at < rows else None
        if code:
            yield "D", DELETE, state, at + 1
        yield "I", INSERT, FORCED[state][0], at
        if code and code != GONE:
            cut = CUT if code.isupper() else 0
            if code.lower() in FOLLOWS[state]:
                yield "K", KEEP + cut, FOLLOWS[state][code.lower()], at + 1
            yield "R", REROLE + cut, FORCED[state][0], at + 1

    bound = least[0]
    while (edits := search(0, start, bound)) is None:
        bound = needs[0, start]
    return bound, edits


RESULT = (
    ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
    ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"),
)


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation, null ids being one: conv, its faults and gaps, and the cheapest repair of its rows.

    ``turns`` is what ``turns_of`` or ``damaged`` gives.  Rows are taken by turn, nulls first; rows of one turn by role
    and text, so equal ones stand together.  A conversation of which no row is left has zeros, no edits and the digest
    of the empty text.  A role whose first letter is not s, u or a cannot be kept.  A row that is there twice is a
    duplicate like any other.  Very long texts pass one at a time; other columns of the source are ignored; an empty
    table gives an empty result.
    """
    rows = with_first(turns)
    kind = rows.schema["conv"].dataType.simpleString()
    later = F.when(F.col("no_turn"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    ordered = (
        rows.select("conv", "turn", "role", "text", "said", "lost", F.coalesce(later, F.lit(False)).alias("repeated"))
        .repartition("conv")
        .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, answer, done, ids = None, None, [], []
        names = ("turn", "role", "text", "said", "lost", "repeated")
        id_type = None
        for batch in batches:
            id_type = batch["conv"].type
            columns = [batch[n].to_pylist() for n in names]
            for own, turn, role, text, said, lost, repeated in zip(batch["conv"].to_pylist(), *columns):
                if answer is None or own != open_id:
                    if answer is not None:
                        ids.append(open_id)
                        done.append(answer.row())
                    open_id, answer = own, Answer()
                if not lost:
                    answer.add(turn, role, text, said, repeated)
            if done:
                yield result(ids, done, id_type)
                ids, done = [], []
        if answer is not None:
            yield result([open_id], [answer.row()], id_type)

    def result(ids: list, done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = {"long": pa.int64(), "string": pa.string()}
        columns = [pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*done), RESULT)]
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], names=["conv", *(n for n, _ in RESULT)])

    schema = f"conv {kind}, " + ", ".join(f"{n} {t}" for n, t in RESULT)
    return ordered.mapInArrow(run, schema)
