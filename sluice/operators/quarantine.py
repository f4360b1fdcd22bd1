"""Quarantine: flags, gates, reasons, record scores and the log.

Two rule books exist for customers and work orders.  They differ in what gates
a record, in the texts and in the score; ``NOTEBOOK`` is the default and
``SCRIPT`` the other one.  A flag that cannot be decided counts as false
unless ``three_valued`` asks for the undecided gate to stay null.

Flags are named expressions over raw rows; gates, reasons and scores read the
flags.  Fixed values: the texts of reasons are shown by results as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from ..functions import domains as d
from ..functions.columns import (
    any_true,
    at,
    case,
    day,
    instant,
    instant_literal,
    is_blank,
    named,
    number,
    outside,
    quoted,
    tagged,
    true_only,
    upper_trim,
)
from .catalog import bill_amount, future
from .joins import attach, per_key_keys

NOTEBOOK = "notebook"
SCRIPT = "script"

Flags = dict[str, str]


def with_flags(df: DataFrame, flags: Mapping[str, str], as_of: dt.date) -> DataFrame:
    return df.selectExpr("*", *[at(text, as_of) for text in named(flags)])


def customer_flags(book: str = NOTEBOOK, money: str = "double") -> Flags:
    known = d.CUSTOMER_STATUS + (("ACTIV", "TEMP SUSPEND") if book == NOTEBOOK else ())
    credit = number("credit_limit", money)
    return {
        "q_null_name": is_blank("customer_name"),
        "q_null_status": "account_status IS NULL",
        "q_invalid_status": true_only(outside(upper_trim("account_status"), known)),
        "q_neg_credit": true_only(f"{credit} < 0"),
        "q_bad_credit": f"credit_limit IS NOT NULL AND {credit} IS NULL",
        "q_future_date": true_only(future("created_date")),
    }


def customer_gate(book: str = NOTEBOOK) -> str:
    status = {NOTEBOOK: "q_null_status", SCRIPT: "q_invalid_status"}[book]
    return f"(q_null_name OR {status} OR q_neg_credit OR q_bad_credit)"


def customer_reason(book: str = NOTEBOOK) -> str:
    """The first reason by priority, with the bad value."""
    if book == SCRIPT:
        return case(
            [
                ("q_null_name", "'CRITICAL: customer_name is NULL'"),
                ("q_invalid_status", tagged("CRITICAL: invalid account_status", "account_status")),
                ("q_bad_credit", tagged("HIGH: credit_limit cannot be parsed", "credit_limit")),
                ("q_neg_credit", "'HIGH: negative credit_limit'"),
            ]
        )
    return case(
        [
            ("q_null_name", "'CRITICAL: customer_name is NULL or blank'"),
            ("q_null_status", "'CRITICAL: account_status is NULL'"),
            ("q_invalid_status", tagged("HIGH: invalid account_status", "account_status")),
            ("q_neg_credit", "'HIGH: negative credit_limit'"),
            ("q_bad_credit", tagged("HIGH: unparseable credit_limit", "credit_limit")),
            ("is_duplicate", "'MEDIUM: duplicate record — lower priority version'"),
        ]
    )


def deductions(losses: Iterable[tuple[str, int]]) -> str:
    """100 less the points of every condition that holds, never below 0."""
    points = "".join(f" - if({condition}, {loss}, 0)" for condition, loss in losses)
    return f"CAST(greatest(0, 100{points}) AS double)"


def customer_score(book: str = NOTEBOOK) -> str:
    if book == SCRIPT:
        return deductions(
            [
                ("customer_name IS NULL", 30),
                ("q_null_status", 20),
                ("q_bad_credit", 15),
                ("email_address IS NULL", 10),
                ("email_address NOT LIKE '%@%.%'", 10),
                ("primary_contact IS NULL", 5),
                ("q_future_date", 10),
            ]
        )
    return deductions(
        [
            ("q_null_name", 30),
            ("q_null_status", 20),
            ("q_invalid_status", 15),
            ("q_neg_credit", 15),
            ("q_bad_credit", 15),
            ("email_address IS NULL", 10),
            (f"NOT rlike(email_address, {quoted(d.EMAIL_PATTERN)})", 10),
            ("primary_contact IS NULL", 5),
            ("q_future_date", 10),
        ]
    )


def work_order_flags(money: str = "double", three_valued: bool = False) -> Flags:
    """Needs ``ref_integrity_ok``, whether the customer exists."""
    negative = f"({number('labor_cost', money)} < 0 OR {number('parts_cost', money)} < 0)"
    return {
        "q_null_cust": "customer_id IS NULL",
        "q_orphan_cust": "customer_id IS NOT NULL AND NOT ref_integrity_ok",
        "q_inv_time": true_only(f"{instant('actual_end')} < {instant('actual_start')}"),
        "q_neg_cost": negative if three_valued else true_only(negative),
    }


WORK_ORDER_GATE = "(q_null_cust OR q_orphan_cust OR q_inv_time OR q_neg_cost)"


def work_order_reason(book: str = NOTEBOOK) -> str:
    cost = {NOTEBOOK: "HIGH: negative cost value", SCRIPT: "HIGH: negative cost values"}[book]
    return case(
        [
            ("q_null_cust", "'CRITICAL: customer_id is NULL'"),
            ("q_orphan_cust", tagged("CRITICAL: orphaned customer_id", "customer_id")),
            ("q_inv_time", "'CRITICAL: actual_end before actual_start'"),
            ("q_neg_cost", quoted(cost)),
        ]
    )


def work_order_score(book: str = NOTEBOOK, money: str = "double") -> str:
    return deductions(
        [
            ("q_null_cust", 30),
            ("q_orphan_cust", 25),
            ("site_id IS NULL", 15),
            ("q_inv_time", 20),
            ("q_neg_cost" if book == NOTEBOOK else f"{number('labor_cost', money)} < 0", 15),
            ("description IS NULL", 5),
            ("priority IS NULL", 5),
        ]
    )


def technician_flags(money: str = "double") -> Flags:
    return {
        "q_null_emp": "employee_number IS NULL",
        "q_neg_rate": true_only(f"{number('hourly_rate', money)} < 0"),
        "q_future_hire": true_only(future("hire_date")),
        "q_inv_dates": true_only(f"{day('hire_date')} > {day('termination_date')}"),
    }


TECHNICIAN_GATE = "(q_neg_rate OR q_inv_dates)"

TECHNICIAN_REASON = case(
    [
        ("q_inv_dates", "'HIGH: hire_date after termination_date'"),
        ("q_neg_rate", "'HIGH: negative hourly_rate'"),
        ("q_future_hire", "'HIGH: hire_date in the future'"),
        ("q_null_emp", "'MEDIUM: missing employee_number'"),
    ]
)

TECHNICIAN_SCORE = deductions(
    [
        ("q_neg_rate", 20),
        ("q_inv_dates", 20),
        ("q_future_hire", 15),
        ("q_null_emp", 10),
        ("full_name IS NULL", 10),
        ("skill_level IS NULL", 5),
    ]
)


def invoice_flags(money: str = "double") -> Flags:
    """Needs ``order_ok`` and ``customer_ok``, whether the parents exist."""
    amounts = [f"{number(name, money)} < 0" for name in ("subtotal", "total_amount", "payment_received")]
    off = f"abs({bill_amount(money)} - {number('total_amount', money)}) > {d.CENT}"
    return {
        "q_orphan_order": "work_order_id IS NOT NULL AND NOT order_ok",
        "q_orphan_cust": "customer_id IS NOT NULL AND NOT customer_ok",
        "q_neg_amount": any_true(*amounts),
        "q_over_discount": true_only(f"{number('discount_amount', money)} > {number('subtotal', money)}"),
        "q_off_balance": true_only(off),
        "q_inv_dates": true_only(f"{day('due_date')} < {day('invoice_date')}"),
    }


INVOICE_GATE = "(" + " OR ".join(invoice_flags()) + ")"

INVOICE_REASON = case(
    [
        ("q_orphan_order", tagged("CRITICAL: orphaned work_order_id", "work_order_id")),
        ("q_neg_amount", "'CRITICAL: negative financial amount'"),
        ("q_over_discount", "'CRITICAL: discount_amount exceeds subtotal'"),
        ("q_off_balance", "'CRITICAL: invoice total does not balance'"),
        ("q_orphan_cust", tagged("HIGH: orphaned customer_id", "customer_id")),
        ("q_inv_dates", "'HIGH: due_date before invoice_date'"),
    ]
)

INVOICE_SCORE = deductions(
    [
        ("q_orphan_order", 30),
        ("q_neg_amount", 30),
        ("q_over_discount", 30),
        ("q_off_balance", 30),
        ("q_orphan_cust", 20),
        ("q_inv_dates", 20),
    ]
)


def _by_prefix(cases: Iterable[tuple[str, str]], otherwise: str) -> str:
    return case(
        [(f"startswith(quarantine_reason, {quoted(prefix)})", quoted(value)) for prefix, value in cases],
        quoted(otherwise),
    )


LOG_RULE_CODE = {
    NOTEBOOK: _by_prefix(
        [("CRITICAL", "C-001"), ("HIGH: neg", "V-003"), ("HIGH: unpars", "V-004"), ("MEDIUM", "U-002")], "V-001"
    ),
    SCRIPT: _by_prefix([("CRITICAL", "C-001"), ("HIGH", "V-003")], "U-002"),
}
LOG_SEVERITY = {
    NOTEBOOK: _by_prefix([("CRITICAL", "CRITICAL"), ("MEDIUM", "MEDIUM")], "HIGH"),
    SCRIPT: _by_prefix([("CRITICAL", "CRITICAL")], "HIGH"),
}


def quarantine_log(
    staged: DataFrame, source: str, key: str, run_id: str, logged: dt.datetime, book: str = NOTEBOOK
) -> DataFrame:
    """Rejected records, open until someone resolves them."""
    return staged.filter("is_quarantined").selectExpr(
        f"{quoted(run_id)} AS run_id",
        f"{quoted(source)} AS source_table",
        f"{key} AS source_key",
        f"{LOG_RULE_CODE[book]} AS rule_code",
        f"{LOG_SEVERITY[book]} AS severity",
        "quarantine_reason",
        "CAST(NULL AS string) AS raw_record",
        f"{instant_literal(logged)} AS quarantine_date",
        "false AS resolved_flag",
        "CAST(NULL AS timestamp_ntz) AS resolved_date",
        "CAST(NULL AS string) AS resolved_by",
    )


def quarantine_counts(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Total, quarantined and clean rows per staged table, one pass each."""
    parts = [
        df.selectExpr(
            f"{quoted(name)} AS table_name",
            "count(1) AS total",
            "count_if(is_quarantined) AS quarantined",
            "count(1) - count_if(is_quarantined) AS clean",
        )
        for name, df in staged.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def resolve(log: DataFrame, released: DataFrame, when: dt.datetime, by: str) -> DataFrame:
    """Mark open log rows whose (source_table, source_key) has been released."""
    keys = ["source_table", "source_key"]
    freed = per_key_keys(released, *keys).selectExpr("*", "true AS freed")
    now = "(freed IS NOT NULL AND NOT resolved_flag)"
    changed = {
        "resolved_flag": f"resolved_flag OR {now}",
        "resolved_date": case([(now, instant_literal(when))], "resolved_date"),
        "resolved_by": case([(now, quoted(by))], "resolved_by"),
    }
    return attach(log, freed, keys).selectExpr(*named({n: changed.get(n, n) for n in log.columns}))
