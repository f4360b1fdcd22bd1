"""A suite over tables that grow by batches: each batch is scanned once.

Counts of row rules add up, so those of a batch are stored under its name.
Counts of key rules follow from counts per key, which add up too: they are kept
in a key index per profile.  Rules that join rows, and rules held against a
reference that changes with the data, have no such parts and are evaluated over
all rows.

Rules that name the day of the run are stored with it.  Totals for another day
need ``history``, of which only the columns of those rules are read.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from .evaluate import _one_pass, _record, names_today, row_rule_counts, rule_counts, with_outcome
from .key_index import KeyIndex
from .profiles import key_profile
from .rules import Frames, KeyRule, RowRule, Rule

COUNTS = (
    "rule_code", "dq_dimension", "target_table", "severity", "total_records", "failed_records", "details",
)


class IncrementalSuite:
    """The rules and what is stored of the batches seen so far, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, rules: Sequence[Rule], buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.row_rules = [r for r in rules if isinstance(r, RowRule)]
        self.key_rules: dict[str, list[KeyRule]] = defaultdict(list)
        for rule in rules:
            if isinstance(rule, KeyRule):
                self.key_rules[rule.profile.name].append(rule)
        self.others = [r for r in rules if not isinstance(r, (RowRule, KeyRule))]
        self.indexes = {
            name: KeyIndex(spark, f"{self.root}/keys/{name}", own[0].profile.keys, dict.fromkeys(self._measures(own), "sum"), buckets)
            for name, own in self.key_rules.items()
        }

    @staticmethod
    def _measures(rules: Sequence[KeyRule]) -> list[str]:
        return list(dict.fromkeys(n for rule in rules for n in (*rule.uses, rule.total)))

    def _row_counts(self, frames: Frames, rules: Sequence[RowRule], as_of: dt.date) -> DataFrame:
        by_table: dict[str, list[RowRule]] = defaultdict(list)
        for rule in rules:
            by_table[rule.table].append(rule)
        parts = [row_rule_counts(frames[table], own, as_of) for table, own in by_table.items()]
        return reduce(DataFrame.unionAll, parts).select(*COUNTS)

    def add(self, batch: Frames, name: str, as_of: dt.date) -> None:
        """Count a batch: the rows of all tables that came with it.  A repeated batch changes nothing in the totals."""
        if self.row_rules:
            stamped = self._row_counts(batch, self.row_rules, as_of).withColumns({"batch": F.lit(name), "as_of": F.lit(as_of)})
            sinks.replace_run(stamped, f"{self.root}/rows", "batch")
        for profile, own in self.key_rules.items():
            if name in self.indexes[profile].batches():
                continue
            measures = self._measures(own)
            tables = {own[0].profile.measures[n].table for n in measures}
            most = sum(batch[t].count() for t in tables)  # no more keys than rows
            self.indexes[profile].add(key_profile(batch, own[0].profile, measures, as_of), name, most)

    def counts(self, as_of: dt.date, history: Frames | None = None) -> DataFrame:
        """Total and failed records of every rule over all batches."""
        parts = []
        if self.row_rules:
            stored = self.spark.read.schema(self._stored_schema).parquet(f"{self.root}/rows")
            clock = [r for r in self.row_rules if names_today(r)]
            if stored.filter(F.col("as_of") != F.lit(as_of)).isEmpty():
                clock = []
            if clock and history is None:
                raise ValueError("batches were counted for another day: the rules that name it need the rows again")
            kept = stored.filter(~F.col("rule_code").isin(*[r.code for r in clock])) if clock else stored
            same = [c for c in COUNTS if not c.endswith("_records")]
            sums = kept.groupBy(*same).agg(*[F.sum(c).alias(c) for c in ("total_records", "failed_records")])
            parts.append(sums.select(*COUNTS))
            if clock:
                parts.append(self._row_counts(history, clock, as_of))
        for profile, own in self.key_rules.items():
            sums = [_record(r, f"coalesce(sum({r.total}), 0)", f"coalesce(sum({r.failed}), 0)") for r in own]
            parts.append(_one_pass(self.indexes[profile].read(), sums).select(*COUNTS))
        if self.others:
            if history is None:
                raise ValueError("rules that join rows need all of them")
            parts.append(rule_counts(history, self.others, as_of).select(*COUNTS))
        return reduce(DataFrame.unionAll, parts)

    def evaluate(self, as_of: dt.date, history: Frames | None = None) -> DataFrame:
        return with_outcome(self.counts(as_of, history))

    _stored_schema = (
        "rule_code string, dq_dimension string, target_table string, severity string, total_records bigint,"
        " failed_records bigint, details string, as_of date, batch string"
    )
