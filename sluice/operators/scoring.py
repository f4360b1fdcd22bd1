"""Scores, grades and reports over rule results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as d
from ..functions.columns import case, day_literal, instant_literal, quoted

SCORE_COLUMNS = {
    "completeness_score": "Completeness",
    "uniqueness_score": "Uniqueness",
    "validity_score": "Validity",
    "consistency_score": "Consistency",
    "timeliness_score": "Timeliness",
    "ref_integrity_score": "Referential Integrity",
}


def severity_weight(default: int = d.DEFAULT_WEIGHT) -> str:
    return case([(f"severity = {quoted(s)}", str(w)) for s, w in d.SEVERITY_WEIGHT.items()], str(default))


def severity_rank() -> str:
    cases = [(f"severity = {quoted(s)}", str(i)) for i, s in enumerate(d.SEVERITY_WEIGHT, 1)]
    return case(cases, str(len(d.SEVERITY_WEIGHT)))


def score(only: str = "true", digits: int = 2) -> str:
    """100 minus the weighted share of failing records; 0 when no rule counts."""
    weight = severity_weight()
    lost = f"sum({weight} * failed_records / greatest(total_records, 1)) FILTER (WHERE {only})"
    full = f"sum({weight}) FILTER (WHERE {only})"
    left = f"greatest(0.0D, round(100.0D - {lost} / {full} * 100.0D, {digits}))"
    return f"if({full} > 0, {left}, 0.0D)"


def grade(value: str) -> str:
    return case([(f"{value} >= {floor}", quoted(letter)) for letter, floor in d.GRADES], "'F'")


def overall(results: DataFrame, digits: int = 2) -> DataFrame:
    return results.selectExpr(f"{score(digits=digits)} AS overall_score")


def by_dimension(results: DataFrame, digits: int = 2) -> DataFrame:
    return results.groupBy("dq_dimension").agg(F.expr(score(digits=digits)).alias("dimension_score"))


def with_overall(results: DataFrame, digits: int = 2) -> DataFrame:
    """Scores and grades per dimension and, in the row ``(overall)``, of the whole suite."""
    scores = results.rollup("dq_dimension").agg(F.expr(score(digits=digits)).alias("score"))
    return scores.selectExpr(
        "coalesce(dq_dimension, '(overall)') AS dq_dimension", "score", f"{grade('score')} AS grade"
    )


def graded(results: DataFrame, digits: int = 2) -> DataFrame:
    return overall(results, digits).selectExpr("*", f"{grade('overall_score')} AS grade")


def _counts(kind: str) -> list[str]:
    fails = "CAST(count_if(status = 'FAIL' AND severity = '{}') AS {}) AS {}".format
    return [
        f"CAST(count_if(status = 'PASS') AS {kind}) AS rules_passed",
        f"CAST(count_if(status <> 'PASS') AS {kind}) AS rules_failed",
        fails("CRITICAL", kind, "critical_failures"),
        fails("HIGH", kind, "high_failures"),
    ]


def severity_counts(results: DataFrame) -> DataFrame:
    return results.selectExpr(*_counts("bigint"))


def summary_row(results: DataFrame, run_id: str, score_date: dt.date, target: str = "ALL_TABLES") -> DataFrame:
    """One wide row per run."""
    scores = [f"{score(f'dq_dimension = {quoted(name)}')} AS {column}" for column, name in SCORE_COLUMNS.items()]
    row = results.selectExpr(
        "CAST(count(1) AS int) AS total_rules_run", *_counts("int"), f"{score()} AS overall_score", *scores
    )
    return row.selectExpr(
        f"{quoted(run_id)} AS run_id", f"{day_literal(score_date)} AS score_date",
        f"{quoted(target)} AS target_table", "*",
    )


def failed_checks(results: DataFrame) -> DataFrame:
    """Failing rules, heaviest severity first."""
    return (
        results.filter("status <> 'PASS'")
        .selectExpr("rule_code", "severity", f"{severity_weight(0)} AS weight", "failed_records", "details")
        .orderBy(F.col("weight").desc(), "rule_code")
    )


def history(summaries: DataFrame, runs: int = 5) -> DataFrame:
    """The latest summaries, newest first."""
    return (
        summaries.select(
            "score_date",
            "overall_score",
            "completeness_score",
            "validity_score",
            "critical_failures",
            "high_failures",
        )
        .orderBy(F.col("score_date").desc(), F.col("overall_score"))
        .limit(runs)
    )


def by_table(results: DataFrame) -> DataFrame:
    """Counts summed per table, dimension and severity, with one pass rate each."""
    return (
        results.groupBy("target_table", "dq_dimension", "severity")
        .agg(
            F.sum("total_records").alias("total_records_checked"),
            F.sum("failed_records").alias("total_failures"),
        )
        .selectExpr(
            "*", "round(100.0D * (1 - total_failures / nullif(total_records_checked, 0)), 2) AS pass_rate_pct"
        )
        .orderBy("target_table", "dq_dimension", F.expr(severity_rank()))
    )


def result_rows(results: DataFrame, run_id: str, executed: dt.datetime) -> DataFrame:
    """Results as stored: one row per rule and run."""
    return results.selectExpr(
        f"{quoted(run_id)} AS run_id",
        "rule_code",
        "dq_dimension",
        "target_table",
        "severity",
        f"{instant_literal(executed)} AS execution_time",
        "total_records",
        "failed_records",
        "pass_rate",
        "status",
        "details",
    )
