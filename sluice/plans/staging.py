"""Raw to staging: deduplicate, standardise, flag, score."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions import domains as d
from ..functions import standardize as std
from ..functions.columns import day, instant, instant_literal, lower_trim, named, number, quoted, upper_trim
from ..operators import dedup
from ..operators import quarantine as q
from ..operators.joins import attach, per_key_keys
from ..operators.quarantine import NOTEBOOK, SCRIPT, with_flags


@dataclass(frozen=True)
class Load:
    """What a run fixes from outside: its clock, batch and policies.

    ``money`` is the type amounts are parsed to, ``book`` the quarantine rule
    book.  ``batch_id`` None keeps each row's own batch.
    """

    as_of: dt.date
    loaded: dt.datetime
    batch_id: str | None
    money: str = "double"
    book: str = NOTEBOOK
    null_keys_are_distinct: bool = False
    three_valued: bool = False
    row_id: str = "_src_row"
    #: buckets of a stored dimension, fixed when it is made
    buckets: int = 64

    @property
    def metadata(self) -> dict[str, str]:
        batch = "_batch_id" if self.batch_id is None else quoted(self.batch_id)
        return {"stg_load_date": instant_literal(self.loaded), "stg_batch_id": batch}


def with_parent_flag(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Add whether the key exists in the parent; a null key does not."""
    known = per_key_keys(parent, key).selectExpr("*", "true AS _known")
    return attach(child, known, [key]).selectExpr(*child.columns, f"_known IS NOT NULL AS {name}")


def flagged_customers(raw: DataFrame, load: Load) -> DataFrame:
    marked = dedup.with_duplicate_flags(raw, load.row_id, load.null_keys_are_distinct)
    return with_flags(marked, q.customer_flags(load.book, load.money), load.as_of)


def clean_customer(load: Load) -> dict[str, str]:
    """A customer's own columns, standardised; nothing that depends on other rows."""
    script = load.book == SCRIPT
    return {
        "customer_id": "customer_id",
        "customer_name": "trim(customer_name)",
        "customer_type": std.customer_type(),
        "account_status": std.customer_status(keep_raw=script),
        "credit_limit": number("credit_limit", load.money),
        "primary_contact": "trim(primary_contact)",
        "email_address": lower_trim("email_address"),
        "phone_number": "phone_number",
        "billing_city": "trim(billing_city)",
        "billing_state": upper_trim("billing_state"),
        "billing_zip": std.zip5(),
        "region_code": "trim(region_code)" if script else upper_trim("region_code"),
        "created_date": day("created_date"),
        "last_modified": instant("last_modified"),
        "source_system": "source_system",
    }


def stage_customers(raw: DataFrame, load: Load) -> DataFrame:
    script = load.book == SCRIPT
    rows = flagged_customers(raw, load)
    reason = q.customer_reason(load.book)
    if script:
        rows = dedup.with_master_key(rows, raw)
        reason = f"coalesce({reason}, {dedup.DUPLICATE_REASON})"
    staged = {
        **clean_customer(load),
        "is_quarantined": f"{q.customer_gate(load.book)} OR is_duplicate",
        "quarantine_reason": reason,
        "dq_score": q.customer_score(load.book),
        "is_duplicate": "is_duplicate",
        "duplicate_of_key": "duplicate_of_key" if script else "CAST(NULL AS string)",
        **load.metadata,
    }
    return rows.selectExpr(*named(staged))


def flagged_work_orders(raw: DataFrame, customers: DataFrame, load: Load) -> DataFrame:
    latest = dedup.keep_latest(raw, ["work_order_id"], dedup.extract_order(load.row_id))
    checked = with_parent_flag(latest, customers, "customer_id", "ref_integrity_ok")
    return with_flags(checked, q.work_order_flags(load.money, load.three_valued), load.as_of)


def stage_work_orders(raw: DataFrame, customers: DataFrame, load: Load) -> DataFrame:
    script = load.book == SCRIPT
    hours = "decimal(6,2)" if load.money.startswith("decimal") else "double"
    staged = {
        "work_order_id": "work_order_id",
        "work_order_number": "work_order_number",
        "site_id": "site_id",
        "customer_id": "customer_id",
        "work_order_type": std.work_order_type(),
        "priority": std.priority(checked=script),
        "status": std.work_order_status(),
        "description": "trim(description)",
        "scheduled_date": day("scheduled_date"),
        "actual_start": instant("actual_start"),
        "actual_end": std.end_not_before("actual_start", "actual_end"),
        "estimated_hours": number("estimated_hours", hours),
        "actual_hours": std.in_range("actual_hours", 0, d.MAX_HOURS, hours),
        "labor_cost": std.in_range("labor_cost", 0, money=load.money),
        "parts_cost": std.in_range("parts_cost", 0, money=load.money),
        "total_cost": std.in_range("total_cost", 0, money=load.money),
        "sla_due_date": instant("sla_due_date"),
        "sla_met": std.bool_text("sla_met"),
        "resolution_code": "trim(resolution_code)",
        "created_date": day("created_date"),
        "last_modified": instant("last_modified"),
        "is_quarantined": q.WORK_ORDER_GATE,
        "quarantine_reason": q.work_order_reason(load.book),
        "dq_score": q.work_order_score(load.book, load.money),
        "ref_integrity_ok": "ref_integrity_ok",
        **load.metadata,
    }
    return flagged_work_orders(raw, customers, load).selectExpr(*named(staged))


def flagged_technicians(raw: DataFrame, load: Load) -> DataFrame:
    latest = dedup.keep_latest(raw, ["technician_id"], dedup.extract_order(load.row_id))
    return with_flags(latest, q.technician_flags(load.money), load.as_of)


def stage_technicians(raw: DataFrame, load: Load) -> DataFrame:
    staged = {
        "technician_id": "technician_id",
        "employee_number": "employee_number",
        "first_name": "first_name",
        "last_name": "last_name",
        "full_name": std.full_name(),
        "employment_status": std.technician_status(),
        "skill_level": upper_trim("skill_level"),
        "home_region": upper_trim("home_region"),
        "hire_date": day("hire_date"),
        "termination_date": day("termination_date"),
        "hourly_rate": std.in_range("hourly_rate", 0, d.MAX_RATE, load.money),
        "manager_id": "manager_id",
        "email": "email",
        "mobile_phone": "mobile_phone",
        "is_quarantined": q.TECHNICIAN_GATE,
        "quarantine_reason": q.TECHNICIAN_REASON,
        "dq_score": q.TECHNICIAN_SCORE,
        **load.metadata,
    }
    return flagged_technicians(raw, load).selectExpr(*named(staged))


def stage_invoices(raw: DataFrame, work_orders: DataFrame, customers: DataFrame, load: Load) -> DataFrame:
    """Same pattern for invoices; flags follow the invoice rules of the suite."""
    rows = dedup.keep_latest(raw, ["invoice_id"], dedup.extract_order(load.row_id))
    rows = with_parent_flag(rows, work_orders, "work_order_id", "order_ok")
    rows = with_parent_flag(rows, customers, "customer_id", "customer_ok")
    staged = {
        "invoice_id": "invoice_id",
        "invoice_number": "invoice_number",
        "work_order_id": "work_order_id",
        "customer_id": "customer_id",
        "invoice_date": day("invoice_date"),
        "due_date": day("due_date"),
        "invoice_status": std.invoice_status(),
        "subtotal": std.in_range("subtotal", 0, money=load.money),
        "tax_amount": number("tax_amount", load.money),
        "discount_amount": number("discount_amount", load.money),
        "total_amount": std.in_range("total_amount", 0, money=load.money),
        "payment_terms": "payment_terms",
        "payment_received": std.in_range("payment_received", 0, money=load.money),
        "payment_date": day("payment_date"),
        "is_quarantined": q.INVOICE_GATE,
        "quarantine_reason": q.INVOICE_REASON,
        "dq_score": q.INVOICE_SCORE,
        **load.metadata,
    }
    return with_flags(rows, q.invoice_flags(load.money), load.as_of).selectExpr(*named(staged))
