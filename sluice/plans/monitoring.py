"""Before/after reports and the run log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as d
from ..functions.columns import case, instant, instant_literal, named, number, outside, quoted, upper_trim
from ..operators.evaluate import rule_counts
from ..operators.profiles import CUSTOMER
from ..operators.rules import Frames, KeyRule, RowRule

#: Names of layers and metrics as the reports show them
RAW, STAGING, CURATED = "RAW", "STAGING", "CURATED"
CLEAN = "NOT is_quarantined"

CUSTOMER_METRICS = (
    "Customers — NULL name",
    "Customers — Invalid status",
    "Customers — Duplicate IDs",
    "Total customer records",
)
WORK_ORDER_METRICS = (
    "Work Orders — Negative costs",
    "Work Orders — Inverted timestamps",
    "Total work order records",
)


def off_domain(status: str) -> str:
    return f"({outside(status, d.CUSTOMER_STATUS)} OR {status} IS NULL)"


#: metrics of the staged layers over rows that passed the gate, for an aggregate or to be observed while they are written;
#: of a key's rows the gate lets the first pass only
STAGED_CUSTOMERS = {
    "unnamed": f"count_if({CLEAN} AND customer_name IS NULL)",
    "off": f"count_if({CLEAN} AND {off_domain('account_status')})",
    "duplicates": f"count_if({CLEAN} AND is_duplicate)",
    "total": f"count_if({CLEAN})",
}
STAGED_WORK_ORDERS = {
    "negative": f"count_if({CLEAN} AND ({number('labor_cost')} < 0 OR {number('parts_cost')} < 0))",
    "inverted": f"count_if({CLEAN} AND {instant('actual_end')} < {instant('actual_start')})",
    "total": f"count_if({CLEAN})",
}
#: the rows that curation takes from a staged layer
CURATED_CUSTOMERS = f"count_if({CLEAN} AND NOT is_duplicate)"
CURATED_WORK_ORDERS = f"count_if({CLEAN})"
HELD = "count_if(is_quarantined)"


def _measure(code: str, table: str, metric: str, fails: str) -> RowRule:
    return RowRule(code, "Monitoring", table, "LOW", metric, fails=fails)


#: the metrics of the raw layer as records of the suite, which counts them in the scans it makes anyway
RAW_MEASURES = (
    _measure("B-001", "customers", CUSTOMER_METRICS[0], "customer_name IS NULL"),
    _measure("B-002", "customers", CUSTOMER_METRICS[1], off_domain(upper_trim("account_status"))),
    KeyRule(
        "B-003", "Monitoring", "customers", "LOW", CUSTOMER_METRICS[2],
        profile=CUSTOMER, uses=("customers",), total="customers", failed="greatest(customers - 1, 0)",
    ),
    _measure("B-004", "customers", CUSTOMER_METRICS[3], "true"),
    _measure("B-005", "work_orders", WORK_ORDER_METRICS[0], f"{number('labor_cost')} < 0 OR {number('parts_cost')} < 0"),
    _measure("B-006", "work_orders", WORK_ORDER_METRICS[1], f"{instant('actual_end')} < {instant('actual_start')}"),
    _measure("B-007", "work_orders", WORK_ORDER_METRICS[2], "true"),
)


def raw_metrics(frames: Frames, as_of: dt.date, tables: Sequence[str] = ("customers", "work_orders")) -> DataFrame:
    """layer, metric, n of the raw layer: one scan per table for all rows and one per key."""
    counts = rule_counts(frames, [m for m in RAW_MEASURES if m.table in tables], as_of)
    return counts.selectExpr(f"{quoted(RAW)} AS layer", "details AS metric", "failed_records AS n")


def _metrics(layer: str, names: Sequence[str], values: Sequence[str]) -> list[str]:
    return [f"struct({quoted(layer)} AS layer, {quoted(n)} AS metric, CAST({v} AS bigint) AS n)" for n, v in zip(names, values)]


def staged_metrics(df: DataFrame, names: Sequence[str], staged: Mapping[str, str], curated: str) -> DataFrame:
    """layer, metric, n of the staged and the curated layer, as one aggregate over the staged rows.

    The curated layer holds no such problem by construction; only its rows are counted.
    """
    records = _metrics(STAGING, names, list(staged.values()))
    records += _metrics(CURATED, names, ["0"] * (len(names) - 1) + [curated])
    return df.selectExpr(f"array({', '.join(records)}) AS records").selectExpr("inline(records)")


def observed_metrics(names: Sequence[str], staged: Mapping[str, int], curated: int) -> list[tuple[str, str, int]]:
    """The same rows from numbers that were observed."""
    rows = [(STAGING, name, n) for name, n in zip(names, staged.values())]
    return rows + [(CURATED, name, 0) for name in names[:-1]] + [(CURATED, names[-1], curated)]


def customer_layers(raw: Frames, staged: DataFrame, as_of: dt.date) -> DataFrame:
    measured = raw_metrics(raw, as_of, ["customers"])
    return measured.unionAll(staged_metrics(staged, CUSTOMER_METRICS, STAGED_CUSTOMERS, CURATED_CUSTOMERS))


def layers(raw: Frames, customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """layer, metric, n of all layers, counted from the raw and the staged tables."""
    parts = [
        raw_metrics(raw, as_of),
        staged_metrics(customers, CUSTOMER_METRICS, STAGED_CUSTOMERS, CURATED_CUSTOMERS),
        staged_metrics(orders, WORK_ORDER_METRICS, STAGED_WORK_ORDERS, CURATED_WORK_ORDERS),
    ]
    return reduce(DataFrame.unionAll, parts)


def before_after(layers: DataFrame) -> DataFrame:
    """One row per metric with a column per layer."""
    columns = [F.expr(f"max(n) FILTER (WHERE layer = '{name}')").alias(name.lower()) for name in (RAW, STAGING, CURATED)]
    return layers.groupBy("metric").agg(*columns)


def before_after_customers(layers: DataFrame) -> DataFrame:
    """One row per layer with a column per customer metric."""
    names = ("null_names", "invalid_status", "duplicate_ids", "total_customers")
    labels = ((RAW, "RAW (Dirty)"), (STAGING, "STAGING (Cleansed)"), (CURATED, "CURATED (Analytics-Ready)"))
    label = case([(f"layer = {quoted(layer)}", quoted(text)) for layer, text in labels])
    wide = [
        F.expr(f"max(n) FILTER (WHERE metric = {quoted(metric)})").alias(name) for metric, name in zip(CUSTOMER_METRICS, names)
    ]
    return layers.groupBy("layer").agg(*wide).selectExpr(f"{label} AS layer", *names)


def pct_share(n: str, total: str) -> str:
    return f"concat(CAST(round(100.0D * {n} / greatest({total}, 1), 1) AS string), '%')"


RECORDS = ("extracted", "staged", "quarantined", "curated")


def records(df: DataFrame, **counts: str) -> DataFrame:
    """One row with a column for each of ``RECORDS``; those not given are 0."""
    return df.selectExpr(*[f"CAST({counts.get(name, '0')} AS bigint) AS records_{name}" for name in RECORDS])


def pipeline_run(
    run_id: str,
    name: str,
    started: dt.datetime,
    ended: dt.datetime,
    parts: Sequence[DataFrame],
    status: str = "COMPLETED",
    triggered_by: str = "job",
) -> DataFrame:
    """One audit row; ``parts`` are rows of ``records``, which are added up."""
    columns = [f"records_{n}" for n in RECORDS]
    totals = reduce(DataFrame.unionAll, parts).selectExpr(*[f"sum({c}) AS {c}" for c in columns])
    row = {
        "run_id": quoted(run_id),
        "pipeline_name": quoted(name),
        "run_start": instant_literal(started),
        "run_end": instant_literal(ended),
        "status": quoted(status),
        **{c: c for c in columns},
        "dq_score": "CAST(NULL AS double)",
        "error_message": "CAST(NULL AS string)",
        "triggered_by": quoted(triggered_by),
    }
    return totals.selectExpr(*named(row))
