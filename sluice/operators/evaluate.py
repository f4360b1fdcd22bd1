"""Evaluation of a rule suite.

All row rules of a table are one aggregate over one scan.  All rules on one
key are one union of narrow projections and one aggregate per key, which Spark
combines before the shuffle, so a key that holds a large share of the rows is
reduced to one row per task before it moves.  Each key has an aggregate of its
own, whose rows hold that key and its counts alone.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import TODAY, at, case, day_literal, named, quoted
from ..session import keep_compiled
from ..sources import sinks
from .joins import attach, per_key_keys
from .lookups import LookupRule, lookup_rule_counts
from .profiles import key_profile
from .rules import FrameRule, Frames, KeyRule, PairRule, RowRule, Rule

RESULT_COLUMNS = (
    "rule_code", "dq_dimension", "target_table", "severity", "total_records", "failed_records", "pass_rate", "status",
)


def _record(rule: Rule, total: str, failed: str) -> str:
    return (
        f"struct({quoted(rule.code)} AS rule_code, {quoted(rule.dimension)} AS dq_dimension,"
        f" {quoted(rule.target)} AS target_table, {quoted(rule.severity)} AS severity,"
        f" CAST({total} AS bigint) AS total_records, CAST({failed} AS bigint) AS failed_records,"
        f" {quoted(rule.description)} AS details)"
    )


def _one_pass(df: DataFrame, records: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Evaluate all records as one aggregate and unfold them to one row per rule."""
    wide = df.groupBy(*by).agg(F.expr(f"array({', '.join(records)})").alias("records"))
    return wide.selectExpr(*by, "inline(records)")


def _row_record(rule: RowRule) -> str:
    if rule.scope is None:
        return _record(rule, "count(1)", f"count_if({rule.fails})")
    return _record(rule, f"count_if({rule.scope})", f"count_if(({rule.scope}) AND ({rule.fails}))")


def row_rule_counts(df: DataFrame, rules: Sequence[RowRule], as_of: dt.date, by: Sequence[str] = ()) -> DataFrame:
    """All row rules of one table in one pass, optionally per group of ``by``."""
    keep_compiled(df.sparkSession)
    return _one_pass(df, [at(_row_record(rule), as_of) for rule in rules], by)


def row_rule_counts_by_day(df: DataFrame, rules: Sequence[RowRule], days: Sequence[dt.date]) -> DataFrame:
    """All row rules of one table for each day, in one pass."""
    keep_compiled(df.sparkSession)
    records = [
        f"struct({day_literal(day)} AS as_of, {at(_row_record(rule), day)} AS counts)" for rule in rules for day in days
    ]
    return _one_pass(df, records).select("counts.*", "as_of")


def key_rule_counts(frames: Frames, rules: Sequence[KeyRule], as_of: dt.date) -> DataFrame:
    """All rules that share one profile."""
    profile = rules[0].profile
    names = list(dict.fromkeys(n for rule in rules for n in (*rule.uses, rule.total)))
    counts = key_profile(frames, profile, names, as_of)
    return _one_pass(
        counts,
        [_record(r, f"coalesce(sum({r.total}), 0)", f"coalesce(sum({r.failed}), 0)") for r in rules],
    )


def pair_rule_counts(frames: Frames, rule: PairRule, as_of: dt.date) -> DataFrame:
    record = _record(rule, "total_records", "failed_records")
    return rule.counts(frames, as_of).selectExpr(f"inline(array({record}))")


def rule_counts(frames: Frames, rules: Iterable[Rule], as_of: dt.date) -> DataFrame:
    """Total and failed records of every rule, before pass rate and status."""
    by_table: dict[str, list[RowRule]] = defaultdict(list)
    by_profile: dict[str, list[KeyRule]] = defaultdict(list)
    by_lookup: list[LookupRule] = []
    by_source: dict[Callable, list[FrameRule]] = defaultdict(list)
    parts = []
    for rule in rules:
        if isinstance(rule, RowRule):
            by_table[rule.table].append(rule)
        elif isinstance(rule, KeyRule):
            by_profile[rule.profile.name].append(rule)
        elif isinstance(rule, LookupRule):
            by_lookup.append(rule)
        elif isinstance(rule, FrameRule):
            by_source[rule.source].append(rule)
        else:
            parts.append(pair_rule_counts(frames, rule, as_of))
    parts += [row_rule_counts(frames[table], own, as_of) for table, own in by_table.items()]
    parts += [key_rule_counts(frames, own, as_of) for own in by_profile.values()]
    parts += lookup_rule_counts(frames, by_lookup, _record)
    for source, own in by_source.items():
        sums = [_record(r, f"coalesce(sum({r.total}), 0)", f"coalesce(sum({r.failed}), 0)") for r in own]
        parts.append(_one_pass(source(frames), sums))
    return reduce(DataFrame.unionAll, parts)


def with_outcome(counts: DataFrame, digits: int = 2, warning: str = "WARNING") -> DataFrame:
    """Add pass rate and status."""
    rate = f"round(100.0D * (total_records - failed_records) / total_records, {digits})"
    status = case(
        [("failed_records = 0", "'PASS'"), ("severity IN ('CRITICAL', 'HIGH')", "'FAIL'")], quoted(warning)
    )
    return counts.selectExpr(
        "*", f"{case([('total_records > 0', rate)], '100.0D')} AS pass_rate", f"{status} AS status"
    )


def evaluate(frames: Frames, rules: Iterable[Rule], as_of: dt.date) -> DataFrame:
    """One row per rule: counts, pass rate and status."""
    return with_outcome(rule_counts(frames, rules, as_of))


def names_today(rule: Rule) -> bool:
    """Whether the counts of a rule may change with the day of the run, over the same tables."""
    if isinstance(rule, RowRule):
        return TODAY in rule.fails or TODAY in (rule.scope or "")
    if isinstance(rule, KeyRule):
        return any(TODAY in (rule.profile.measures[n].scope or "") for n in (*rule.uses, rule.total))
    return isinstance(rule, PairRule) and rule.daily


def evaluate_days(
    frames: Frames, rules: Iterable[Rule], days: Iterable[dt.date], path: str
) -> dict[dt.date, DataFrame]:
    """As ``evaluate`` for each of several days over the same tables.

    Rules that name the day are counted for every day, row rules of one table in one pass; the others, whose counts
    are the same on all days, once.  The counts, a row per rule and day, are stored at ``path``.
    """
    days, fixed, daily = sorted(set(days)), [], []
    for rule in rules:
        (daily if names_today(rule) else fixed).append(rule)
    parts = [rule_counts(frames, fixed, days[0]).withColumn("as_of", F.lit(None).cast("date"))] if fixed else []
    by_table: dict[str, list[RowRule]] = defaultdict(list)
    for rule in daily:
        if isinstance(rule, RowRule):
            by_table[rule.table].append(rule)
    parts += [row_rule_counts_by_day(frames[table], own, days) for table, own in by_table.items()]
    if others := [rule for rule in daily if not isinstance(rule, RowRule)]:
        parts += [rule_counts(frames, others, day).withColumn("as_of", F.lit(day)) for day in days]
    stored = sinks.overwrite(reduce(DataFrame.unionAll, parts), path)
    return {
        day: with_outcome(stored.filter(F.col("as_of").isNull() | (F.col("as_of") == F.lit(day))).drop("as_of"))
        for day in days
    }


def rules_for_table(rules: Iterable[Rule], text: str) -> list[Rule]:
    """Rules whose target table contains ``text``."""
    return [rule for rule in rules if text in rule.target]


def registry(spark, rules: Iterable[Rule]) -> DataFrame:
    """The rules as a table, one row per rule, with the condition that is evaluated."""
    rows = [
        (i, r.code, r.description, r.dimension, r.target, r.column, r.severity, True, condition(r))
        for i, r in enumerate(rules, 1)
    ]
    return spark.createDataFrame(
        rows,
        "rule_id int, rule_code string, rule_name string, dq_dimension string, target_table string,"
        " target_column string, severity string, is_active boolean, sql_check string",
    )


def condition(rule: Rule) -> str | None:
    if isinstance(rule, RowRule):
        return rule.fails
    return rule.failed if isinstance(rule, KeyRule) else None


@contextmanager
def _quiet():
    """Keep expected analysis errors out of the log."""
    names = ("DataFrameQueryContextLogger", "SQLQueryContextLogger")
    loggers = [logging.getLogger(name) for name in names]
    before = [logger.disabled for logger in loggers]
    for logger in loggers:
        logger.disabled = True
    try:
        yield
    finally:
        for logger, was in zip(loggers, before):
            logger.disabled = was


def evaluate_isolated(frames: Frames, rules: Iterable[Rule], as_of: dt.date) -> DataFrame:
    """As ``evaluate``, but a rule that fails gives a row with status ERROR and
    null counts instead of failing the suite.

    Rules that cannot be bound to their table are found by analysis alone.  The
    others run with those they share a pass with; if that fails they run in
    halves, so a faulty rule costs a few runs of its own pass and none of
    others.  What is collected is one row per rule.
    """
    spark = SparkSession.getActiveSession()
    sound, rows = [], []

    def error(rule: Rule) -> tuple:
        return (rule.code, rule.dimension, rule.target, rule.severity, None, None, rule.description, None, "ERROR")

    def run(some: list[Rule]) -> None:
        try:
            rows.extend(tuple(r) for r in evaluate(frames, some, as_of).select(*_ISOLATED).collect())
        except PySparkException:
            if len(some) == 1:
                rows.append(error(some[0]))
            else:
                run(some[: len(some) // 2])
                run(some[len(some) // 2 :])

    with _quiet():
        for rule in rules:
            try:
                rule_counts(frames, [rule], as_of)
                sound.append(rule)
            except AnalysisException:
                rows.append(error(rule))
            except PySparkException:  # fails while it runs, below
                sound.append(rule)
        shared: dict[object, list[Rule]] = defaultdict(list)
        for rule in sound:
            shared[_pass_of(rule)].append(rule)
        for some in shared.values():
            run(some)
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in _ISOLATED.items()))


def _pass_of(rule: Rule) -> object:
    """Rules with the same value are counted by one aggregate."""
    if isinstance(rule, RowRule):
        return rule.table
    if isinstance(rule, KeyRule):
        return "key", rule.profile.name
    return ("source", rule.source) if isinstance(rule, FrameRule) else type(rule)


_ISOLATED = {
    "rule_code": "string", "dq_dimension": "string", "target_table": "string", "severity": "string",
    "total_records": "bigint", "failed_records": "bigint", "details": "string", "pass_rate": "double", "status": "string",
}


# -- listings ---------------------------------------------------------------


def violating_rows(df: DataFrame, rule: RowRule, as_of: dt.date) -> DataFrame:
    """The failing rows of a row rule, with what is needed to act on them."""
    conditions = [] if rule.scope is None else [rule.scope]
    if not rule.lists_scope:
        conditions.append(rule.fails)
    shown = [name for name in rule.show if name not in rule.detail]
    texts = [f"{quoted(rule.code)} AS rule_code", f"{quoted(rule.severity)} AS severity", *shown, *named(rule.detail)]
    keep = " AND ".join(f"({condition})" for condition in conditions)
    return df.filter(at(keep, as_of)).selectExpr(*[at(text, as_of) for text in texts])


def failing_keys(frames: Frames, rule: KeyRule, as_of: dt.date) -> DataFrame:
    """The keys behind a key rule and how many records of each fail."""
    counts = key_profile(frames, rule.profile, rule.uses, as_of)
    return counts.selectExpr(
        f"{quoted(rule.code)} AS rule_code",
        f"{quoted(rule.severity)} AS severity",
        *rule.profile.keys,
        f"CAST({rule.failed} AS bigint) AS failed_records",
    ).filter("failed_records > 0")


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows with a key no parent row has."""
    return attach(child.filter(F.col(key).isNotNull()), per_key_keys(parent, key), [key], "left_anti")


def childless_rows(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parent rows without a child; a null key never finds one."""
    return attach(parent, per_key_keys(child, key), [key], "left_anti")


def repeated_groups(
    df: DataFrame, keys: Sequence[str], member: str | None, count_name: str, more: Sequence[Column] = ()
) -> DataFrame:
    """Keys that occur more than once and their count; with ``member`` one row per id that shares the key.

    A group of any size is so many narrow rows, which need not meet in one task.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), *more).filter(F.col(count_name) > 1)
    if member is None:
        return groups
    return attach(df.select(*keys, member), groups.select(*keys, count_name), keys, "inner", null_safe=True)
