"""Staging to the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import day_literal, instant_literal
from ..operators.joins import attach
from ..operators.keys import surrogate_key
from ..operators.scd2 import merge_into
from ..sources.versions import VersionedTable

FIRST_DAY = dt.date(2015, 1, 1)
LAST_DAY = dt.date(2027, 12, 31)
UNKNOWN_START = dt.date(2000, 1, 1)


def date_key(day: str) -> str:
    return f"CAST(date_format({day}, 'yyyyMMdd') AS int)"


def days(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """One row per day; a calendar is bounded by its range, whatever the data."""
    return spark.range(1).selectExpr(f"explode(sequence({day_literal(first)}, {day_literal(last)})) AS full_date")


def days_covering(df: DataFrame, *columns: str) -> DataFrame:
    """All days of every year that a column touches: 366 rows for each year that occurs, however far off."""
    years = reduce(DataFrame.unionAll, [df.selectExpr(f"year({column}) AS y") for column in columns])
    return years.filter("y IS NOT NULL").distinct().selectExpr(
        "explode(sequence(make_date(y, 1, 1), make_date(y, 12, 31))) AS full_date"
    )


ISO_WEEK = "weekofyear(full_date)"
# weeks that start on Sunday, the first one holding January 1
SUNDAY_WEEK = "CAST(floor((dayofyear(full_date) + dayofweek(trunc(full_date, 'year')) - 2) / 7) AS int) + 1"


def dim_date(calendar: DataFrame, week: str = ISO_WEEK, fiscal: bool = True) -> DataFrame:
    columns = [
        f"{date_key('full_date')} AS date_sk",
        "full_date",
        "year(full_date) AS year_num",
        "quarter(full_date) AS quarter_num",
        "month(full_date) AS month_num",
        "date_format(full_date, 'MMMM') AS month_name",
        f"{week} AS week_num",
        "dayofweek(full_date) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "dayofweek(full_date) IN (1, 7) AS is_weekend",
    ]
    if fiscal:
        columns += [
            "false AS is_holiday",
            "year(full_date) AS fiscal_year",
            "quarter(full_date) AS fiscal_quarter",
        ]
    return calendar.selectExpr(*columns)


def _open_version(start: str) -> list[str]:
    return [
        f"coalesce({start}, {day_literal(UNKNOWN_START)}) AS effective_from",
        "CAST(NULL AS date) AS effective_to",
        "true AS is_current",
    ]


def _loaded(loaded: dt.datetime) -> str:
    return f"{instant_literal(loaded)} AS load_date"


def customer_rows(staged: DataFrame, loaded: dt.datetime) -> DataFrame:
    """Clean, first-of-their-key customers as open versions."""
    return staged.filter("NOT is_quarantined AND NOT is_duplicate").selectExpr(
        "customer_id",
        "customer_name",
        "customer_type",
        "account_status",
        "region_code",
        "credit_limit",
        *_open_version("created_date"),
        "stg_batch_id AS record_source",
        _loaded(loaded),
    )


def dim_customer(staged: DataFrame, loaded: dt.datetime, digits: int = 3) -> DataFrame:
    return surrogate_key(customer_rows(staged, loaded), ["customer_id"], "customer_sk", digits)


@dataclass(frozen=True)
class Dimension:
    """A type-2 dimension: its key, surrogate key, and the columns whose change opens a version."""

    name: str
    key: str
    surrogate: str
    tracked: tuple[str, ...]
    rows: Callable[[DataFrame, dt.datetime], DataFrame]

    def first(self, staged: DataFrame, loaded: dt.datetime, digits: int = 3) -> DataFrame:
        return surrogate_key(self.rows(staged, loaded), [self.key], self.surrogate, digits)

    def load(
        self, table: VersionedTable, staged: DataFrame, loaded: dt.datetime, effective: dt.date, buckets: int = 64, digits: int = 3
    ) -> DataFrame:
        """The stored dimension after this load: made if there is none, else new versions from ``effective`` on, keys kept."""
        if not table.exists():
            return table.write_buckets(self.first(staged, loaded, digits), [self.key], buckets)
        incoming = self.rows(staged, loaded).drop("effective_from", "effective_to", "is_current")
        return merge_into(table, incoming, self.key, self.tracked, effective, self.surrogate)


def technician_rows(staged: DataFrame, loaded: dt.datetime) -> DataFrame:
    """Clean technicians as open versions."""
    return staged.filter("NOT is_quarantined").selectExpr(
        "technician_id",
        "employee_number",
        "full_name",
        "employment_status",
        "skill_level",
        "home_region",
        "hire_date",
        *_open_version("hire_date"),
        _loaded(loaded),
    )


def dim_technician(staged: DataFrame, loaded: dt.datetime) -> DataFrame:
    return TECHNICIAN.first(staged, loaded)


CUSTOMER = Dimension(
    "dim_customer", "customer_id", "customer_sk",
    ("customer_name", "customer_type", "account_status", "region_code", "credit_limit"), customer_rows,
)
TECHNICIAN = Dimension(
    "dim_technician", "technician_id", "technician_sk",
    ("employee_number", "full_name", "employment_status", "skill_level", "home_region"), technician_rows,
)


@dataclass(frozen=True)
class FactKeys:
    """How facts are numbered: buckets by ``digits``; ``known`` holds the facts of an earlier run, whose keys stay."""

    digits: int = 3
    known: DataFrame | None = None


def _clean_facts(staged: DataFrame, key: str, name: str, keys: FactKeys) -> DataFrame:
    """Clean staged rows with their fact key.

    Every lookup that follows matches at most one row, so the key can be
    assigned first, over the staged rows alone.
    """
    return surrogate_key(staged.filter("NOT is_quarantined"), [key], name, keys.digits, keys.known)


def _with_customer(rows: DataFrame, customers: DataFrame) -> DataFrame:
    current = customers.filter("is_current").select("customer_id", "customer_sk")
    return rows.join(current, "customer_id", "left")


def _with_day(rows: DataFrame, calendar: DataFrame, day: str, key: str) -> DataFrame:
    keys = calendar.selectExpr(f"full_date AS {day}", f"date_sk AS {key}")
    return attach(rows, keys, [day])


_WORK_ORDER_MEASURES = (
    "work_order_type",
    "priority",
    "status",
    "estimated_hours",
    "actual_hours",
    "labor_cost",
    "parts_cost",
    "coalesce(labor_cost, 0) + coalesce(parts_cost, 0) AS total_cost",
    "sla_met",
    "actual_hours - estimated_hours AS hours_variance",
)


def fact_work_orders(
    staged: DataFrame, customers: DataFrame, calendar: DataFrame, loaded: dt.datetime, keys: FactKeys = FactKeys()
) -> DataFrame:
    """Clean work orders with their dimension keys; total cost is recomputed."""
    rows = _clean_facts(staged, "work_order_id", "fact_wo_sk", keys)
    rows = _with_customer(rows.selectExpr("*", "CAST(actual_end AS date) AS completed_date"), customers)
    rows = _with_day(rows, calendar, "scheduled_date", "scheduled_date_sk")
    rows = _with_day(rows, calendar, "completed_date", "completed_date_sk")
    return rows.selectExpr(
        "fact_wo_sk",
        "work_order_id",
        "work_order_number",
        "customer_sk",
        "scheduled_date_sk",
        "completed_date_sk",
        *_WORK_ORDER_MEASURES,
        _loaded(loaded),
        "stg_batch_id AS record_source",
    )


def fact_work_orders_by_format(
    staged: DataFrame, customers: DataFrame, loaded: dt.datetime, keys: FactKeys = FactKeys()
) -> DataFrame:
    """As ``fact_work_orders``, with date keys formatted instead of looked up."""
    rows = _with_customer(_clean_facts(staged, "work_order_id", "fact_wo_sk", keys), customers)
    return rows.selectExpr(
        "fact_wo_sk",
        "work_order_id",
        "work_order_number",
        "customer_sk",
        f"{date_key('scheduled_date')} AS scheduled_date_sk",
        f"{date_key('actual_end')} AS completed_date_sk",
        *_WORK_ORDER_MEASURES,
        _loaded(loaded),
        "stg_batch_id AS record_source",
    )


def fact_invoices(
    staged: DataFrame, customers: DataFrame, calendar: DataFrame, loaded: dt.datetime, keys: FactKeys = FactKeys()
) -> DataFrame:
    rows = _with_customer(_clean_facts(staged, "invoice_id", "fact_inv_sk", keys), customers)
    rows = _with_day(rows, calendar, "invoice_date", "invoice_date_sk")
    rows = _with_day(rows, calendar, "due_date", "due_date_sk")
    return rows.selectExpr(
        "fact_inv_sk",
        "invoice_id",
        "invoice_number",
        "work_order_id",
        "customer_sk",
        "invoice_date_sk",
        "due_date_sk",
        "invoice_status",
        "subtotal",
        "tax_amount",
        "discount_amount",
        "total_amount",
        "payment_received",
        "round(total_amount - coalesce(payment_received, 0), 2) AS outstanding_amount",
        _loaded(loaded),
    )
