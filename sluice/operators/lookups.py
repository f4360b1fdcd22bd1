"""Rules bound to reference frames: values that the reference does not know, and values that contradict it.

A reference frame holds the keys that are known or, with a second column, the
pairs that fit: a key may have several values.  It is given, or learnt from the
data: ``learn`` keeps the pairs that hold often enough for their key.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import quoted
from .joins import attach, attach_measured
from .rules import Frames, Rule

UNKNOWN, CONTRADICTS = "unknown", "contradicts"


@dataclass(frozen=True)
class LookupRule(Rule):
    """``key`` (and ``value``) are SQL text over a row; ``lookup`` names the frame with a column ``key`` (and ``value``).

    ``unknown``: the key is not in the frame.  ``contradicts``: the key is, but not with this value.  A row without
    key, or for the second outcome without value, passes.
    """

    lookup: str = field(kw_only=True)
    key_text: str = field(kw_only=True)
    value_text: str | None = field(default=None, kw_only=True)
    outcome: str = field(default=UNKNOWN, kw_only=True)
    show: tuple[str, ...] = field(default=(), kw_only=True)


class WithLookups(Mapping):
    """Frames with reference frames beside them; a reference frame is built when it is first asked for."""

    def __init__(self, frames: Frames, lookups: Mapping[str, Callable[[Frames], DataFrame]]):
        self.frames, self.lookups = frames, lookups
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.lookups:
            return self.frames[name]
        if name not in self._built:
            self._built[name] = self.lookups[name](self.frames)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.lookups)

    def __len__(self) -> int:
        return len(self.lookups)


def learn(rows: DataFrame, key: str, value: str, support: int, share: float) -> DataFrame:
    """key, value: the pairs found on ``support`` rows at least that make up ``share`` of their key's rows.

    Rows without key or value say nothing.  Pairs are counted in each task before they move, so a key with any
    number of rows is a few.
    """
    pairs = rows.selectExpr(f"{key} AS key", f"{value} AS value").filter("key IS NOT NULL AND value IS NOT NULL")
    counted = pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    of_key = counted.withColumn("all", F.sum("n").over(Window.partitionBy("key")))
    return of_key.filter((F.col("n") >= support) & (F.col("n") >= share * F.col("all"))).select("key", "value")


def known_values(rows: DataFrame, key: str) -> DataFrame:
    """key: every value that occurs."""
    return rows.selectExpr(f"{key} AS key").filter("key IS NOT NULL").distinct()


def _marked(rows: DataFrame, frames: Frames, rules: Sequence[LookupRule], join: Callable) -> DataFrame:
    """``rows`` with _key and _value, and whether the reference of these rules knows the key and the pair."""
    reference = frames[rules[0].lookup]
    keys = reference.filter("key IS NOT NULL").selectExpr("key AS _key").distinct().withColumn("_known", F.lit(True))
    rows = join(rows, keys, ["_key"])
    if rules[0].value_text is None:
        return rows.withColumn("_fits", F.col("_known"))
    pairs = reference.selectExpr("key AS _key", "value AS _value").distinct().withColumn("_fits", F.lit(True))
    return join(rows, pairs, ["_key", "_value"])


def _fails(rule: LookupRule) -> str:
    if rule.outcome == UNKNOWN:
        return "(_key IS NOT NULL AND _known IS NULL)"
    return "(_known IS NOT NULL AND _value IS NOT NULL AND _fits IS NULL)"


def _texts(rule: LookupRule) -> list[str]:
    return [f"{rule.key_text} AS _key", f"{rule.value_text or 'CAST(NULL AS string)'} AS _value"]


def lookup_rule_counts(frames: Frames, rules: Sequence[LookupRule], record: Callable[[Rule, str, str], str]) -> list[DataFrame]:
    """Counts of all rules, with one scan for those that share a table and reference.

    Rows are reduced to distinct (key, value) pairs before they meet the reference.
    """
    by_reference: dict[tuple, list[LookupRule]] = defaultdict(list)
    for rule in rules:
        by_reference[rule.table, rule.lookup, rule.key_text, rule.value_text].append(rule)
    parts = []
    for (table, *_), own in by_reference.items():
        pairs = frames[table].selectExpr(*_texts(own[0])).groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("n"))
        marked = _marked(pairs, frames, own, attach)
        records = [record(r, "coalesce(sum(n), 0)", f"coalesce(sum(if({_fails(r)}, n, 0L)), 0)") for r in own]
        parts.append(marked.selectExpr(f"array({', '.join(records)}) AS records").selectExpr("inline(records)"))
    return parts


def lookup_violations(frames: Frames, rule: LookupRule) -> DataFrame:
    """The failing rows; a small reference is broadcast, a large one met by key."""
    rows = frames[rule.table].selectExpr(*rule.show, *_texts(rule))
    return _marked(rows, frames, [rule], attach_measured).filter(_fails(rule)).selectExpr(
        f"{quoted(rule.code)} AS rule_code", f"{quoted(rule.severity)} AS severity", *rule.show
    )
