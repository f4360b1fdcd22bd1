"""The full run: validate, stage, quarantine, curate, report, log.

Every layer is written before the next one reads it, so a later step starts
from files instead of recomputing the steps before it, and a lost executor
costs at most the step at hand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import quarantine, scoring
from ..operators.catalog import RULES
from ..operators.evaluate import evaluate
from ..operators.keys import key_digits
from ..operators.rules import Frames
from ..sources import sinks
from ..sources.versions import VersionedTable
from . import curation, monitoring, staging
from .staging import Load


@dataclass(frozen=True)
class Target:
    """Where the layers live, one folder per table."""

    root: str

    def __call__(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


def validate(raw: Frames, target: Target, load: Load, run_id: str) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """Evaluate the suite; store results and the score summary, in the place of an earlier try of this run.

    The metrics of the raw layer are counted in the same scans; returned are the summaries and (layer, metric, n).
    """
    counted = evaluate(raw, [*RULES, *monitoring.RAW_MEASURES], load.as_of)
    rows = counted.collect()  # one per rule
    results = counted.sparkSession.createDataFrame(rows, counted.schema)
    measures = {m.code for m in monitoring.RAW_MEASURES}
    rules = results.filter(~results.rule_code.isin(*measures))
    stored = sinks.replace_run(scoring.result_rows(rules, run_id, load.loaded), target("dq", "dq_results"))
    results = stored.filter(stored.run_id == run_id)
    summary = sinks.replace_run(scoring.summary_row(results, run_id, load.as_of), target("dq", "dq_score_summary"))
    return summary, [(monitoring.RAW, r["details"], r["failed_records"]) for r in rows if r["rule_code"] in measures]


STAGED = {"total_rows": "count(1)", "held": monitoring.HELD, "clean": monitoring.CURATED_WORK_ORDERS}


def stage(raw: Frames, target: Target, load: Load) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """The staged tables, and counts of their rows that are observed while they are written."""
    plans = {
        "customers": staging.stage_customers(raw["customers"], load),
        "work_orders": staging.stage_work_orders(raw["work_orders"], raw["customers"], load),
        "technicians": staging.stage_technicians(raw["technicians"], load),
        "invoices": staging.stage_invoices(raw["invoices"], raw["work_orders"], raw["customers"], load),
    }
    metrics = {"customers": monitoring.STAGED_CUSTOMERS, "work_orders": monitoring.STAGED_WORK_ORDERS}
    staged, counts = {}, {}
    for name, df in plans.items():
        staged[name], counts[name] = sinks.overwrite_counted(df, target("stg", name), {**metrics.get(name, {}), **STAGED})
    return staged, counts


def log_quarantine(staged: Frames, target: Target, load: Load, run_id: str) -> DataFrame:
    rows = quarantine.quarantine_log(
        staged["customers"], "raw.customers", "customer_id", run_id, load.loaded, load.book
    )
    return sinks.replace_run(rows, target("dq", "quarantine_log"))


def curate(
    staged: Frames,
    counts: Mapping[str, Mapping[str, int]],
    target: Target,
    load: Load,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The curated tables, and how many current or fact rows each has.

    Dimensions are merged where they are stored, facts written as a new version; both keep the keys they have.  The
    calendar holds the given days, or else the years in which the facts fall.
    """
    spark = staged["customers"].sparkSession
    tables, taken = {}, {}
    if first_day and last_day:
        days = curation.days(spark, first_day, last_day)
    else:
        dates = staged["work_orders"].selectExpr("scheduled_date AS a", "CAST(actual_end AS date) AS b")
        dates = dates.unionAll(staged["invoices"].selectExpr("invoice_date", "due_date"))
        days = curation.days_covering(dates, "a", "b")
    calendar = tables["dim_date"] = sinks.overwrite(curation.dim_date(days), target("curated", "dim_date"))

    for source, dimension in (("customers", curation.CUSTOMER), ("technicians", curation.TECHNICIAN)):
        stored = VersionedTable(spark, target("curated", dimension.name))
        digits = key_digits(counts[source]["clean"])
        tables[dimension.name] = dimension.load(stored, staged[source], load.loaded, load.as_of, load.buckets, digits)
        taken[dimension.name] = tables[dimension.name].filter("is_current").count()

    for source, name, key, make in (
        ("work_orders", "fact_work_orders", "work_order_id", curation.fact_work_orders),
        ("invoices", "fact_invoices", "invoice_id", curation.fact_invoices),
    ):
        path = target("curated", name)
        known = sinks.read(spark, path) if sinks.exists(spark, path) else None
        keys = curation.FactKeys(key_digits(counts[source]["clean"]), known)
        facts = make(staged[source], tables["dim_customer"], calendar, load.loaded, keys)
        tables[name], seen = sinks.overwrite_counted(facts, path, {"n": "count(1)"})
        taken[name] = seen["n"]
    return tables, taken


def run(
    raw: Frames,
    root: str,
    load: Load,
    run_id: str,
    ended: dt.datetime,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> dict[str, DataFrame]:
    """All steps; returns the reports and the audit log next to the curated tables.

    All reports come from counts taken along the way: no raw or staged table is read again to be counted.
    """
    target = Target(root)
    spark = raw["customers"].sparkSession
    summary, layers = validate(raw, target, load, run_id)
    staged, counts = stage(raw, target, load)
    log = log_quarantine(staged, target, load, run_id)
    curated, taken = curate(staged, counts, target, load, first_day, last_day)
    for table, names, fact in (
        ("customers", monitoring.CUSTOMER_METRICS, "dim_customer"),
        ("work_orders", monitoring.WORK_ORDER_METRICS, "fact_work_orders"),
    ):
        seen = {k: n for k, n in counts[table].items() if k not in STAGED}
        layers += monitoring.observed_metrics(names, seen, taken[fact])
    raw_total = {metric: n for layer, metric, n in layers if layer == monitoring.RAW}
    totals = {
        "extracted": raw_total[monitoring.CUSTOMER_METRICS[-1]] + raw_total[monitoring.WORK_ORDER_METRICS[-1]],
        "staged": counts["customers"]["total_rows"] + counts["work_orders"]["total_rows"],
        "quarantined": counts["customers"]["held"] + counts["work_orders"]["held"],
        "curated": taken["dim_customer"] + taken["fact_work_orders"],
    }
    parts = [monitoring.records(spark.range(1), **{name: str(n) for name, n in totals.items()})]
    audit = monitoring.pipeline_run(run_id, "dq_pipeline", load.loaded, ended, parts)
    held = [(f"stg.{t}", n["total_rows"], n["held"], n["clean"]) for t, n in counts.items()]
    return {
        **curated,
        "dq_score_summary": summary,
        "quarantine_log": log,
        "before_after": monitoring.before_after(spark.createDataFrame(layers, "layer string, metric string, n bigint")),
        "quarantine_counts": spark.createDataFrame(
            held, "table_name string, total bigint, quarantined bigint, clean bigint"
        ),
        "pipeline_runs": sinks.replace_run(audit, target("audit", "pipeline_runs")),
    }
