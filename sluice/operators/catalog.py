"""The 62 rules of the standard suite.

Fixed values: the codes, dimensions, severities, descriptions and details below are texts that results show as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as d
from ..functions.columns import (
    TODAY,
    case,
    day,
    hours_between,
    instant,
    is_blank,
    minutes_crossed,
    number,
    one_of,
    outside,
    quoted,
    upper_snake,
    upper_trim,
)
from . import profiles as p
from .joins import attach_measured
from .profiles import COMPLETED, OPEN, TERMINATED
from .rules import Frames, KeyRule, PairRule, RowRule

CU = ("customer_id", "customer_name")
WO = ("work_order_id", "work_order_number")
TE = ("technician_id", "full_name")
IN = ("invoice_id", "invoice_number")

COMPLETENESS = "Completeness"
UNIQUENESS = "Uniqueness"
VALIDITY = "Validity"
INTEGRITY = "Referential Integrity"
CONSISTENCY = "Consistency"
TIMELINESS = "Timeliness"
BUSINESS = "Business Rules"


def _note(text: str) -> dict[str, str]:
    return {"violation_detail": quoted(text)}


def missing(name: str) -> str:
    return f"{name} IS NULL"


def is_value(name: str, value: str) -> str:
    return f"{upper_trim(name)} = {quoted(value)}"


def negative(*names: str) -> str:
    return " OR ".join(f"{number(name)} < 0" for name in names)


def unparsed(name: str, parse: Callable[[str], str]) -> str:
    return f"{name} IS NOT NULL AND {parse(name)} IS NULL"


def after(parse: Callable[[str], str], late: str, early: str) -> str:
    return f"{parse(late)} > {parse(early)}"


def future(name: str) -> str:
    return f"{day(name)} > {TODAY}"


def days_since(name: str) -> str:
    return f"datediff({TODAY}, {day(name)})"


def gap(amount: str, total: str) -> str:
    return f"abs({amount} - {number(total)})"


ORDER_COST = f"({number('labor_cost')} + {number('parts_cost')})"


def bill_amount(money: str = "double") -> str:
    return f"({number('subtotal', money)} + {number('tax_amount', money)} - {number('discount_amount', money)})"


BILL_AMOUNT = bill_amount()
MISSING_TIMES = "actual_start IS NULL OR actual_end IS NULL"
LATE = after(instant, "actual_end", "sla_due_date")
SLA_KNOWN = f"{instant('actual_end')} IS NOT NULL AND {instant('sla_due_date')} IS NOT NULL AND sla_met IS NOT NULL"
SLA_KEPT = case([(f"{instant('actual_end')} <= {instant('sla_due_date')}", "'Y'")], "'N'")
SLA_MISMATCH = f"{SLA_KEPT} <> {upper_trim('sla_met')}"



def credit_unparsed(money: str = "double") -> RowRule:
    """V-004, with amounts read as ``money``: a decimal takes no exponent."""
    return RowRule(
        "V-004", VALIDITY, "customers", "HIGH", "credit_limit cannot be parsed as numeric",
        column="credit_limit", fails=unparsed("credit_limit", lambda name: number(name, money)), show=CU,
        detail={"raw_credit_limit": "credit_limit", **_note("Cannot convert to decimal")},
    )


ROW_RULES = (
    RowRule(
        "C-001", COMPLETENESS, "customers", "CRITICAL", "customer_name is NULL or blank",
        column="customer_name", fails=is_blank("customer_name"), show=CU,
    ),
    RowRule(
        "C-002", COMPLETENESS, "customers", "CRITICAL", "account_status is NULL",
        column="account_status", fails=missing("account_status"), show=CU + ("account_status",),
    ),
    RowRule(
        "C-003", COMPLETENESS, "work_orders", "CRITICAL", "WO missing site_id or customer_id",
        fails="site_id IS NULL OR customer_id IS NULL", show=WO,
        detail={
            "site_issue": case([("site_id IS NULL", "'site_id is NULL'")], "''"),
            "cust_issue": case([("customer_id IS NULL", "'customer_id is NULL'")], "''"),
        },
    ),
    RowRule(
        "C-004", COMPLETENESS, "work_orders", "HIGH", "Completed WO missing actual times",
        fails=MISSING_TIMES, scope=COMPLETED, show=WO + ("status", "actual_start", "actual_end"),
    ),
    RowRule(
        "C-005", COMPLETENESS, "technicians", "HIGH", "Technician missing employee_number",
        column="employee_number", fails=missing("employee_number"),
        show=("technician_id", "first_name", "last_name", "employee_number", "employment_status"),
    ),
    RowRule(
        "C-006", COMPLETENESS, "technicians", "MEDIUM", "Technician missing full_name",
        column="full_name", fails=is_blank("full_name"), show=TE,
    ),
    RowRule(
        "C-007", COMPLETENESS, "customers", "MEDIUM", "Customer missing all contact fields",
        fails="primary_contact IS NULL AND email_address IS NULL AND phone_number IS NULL",
        show=CU + ("primary_contact", "email_address", "phone_number"),
    ),
    RowRule(
        "C-008", COMPLETENESS, "invoices", "CRITICAL", "Invoice missing customer_id",
        column="customer_id", fails=missing("customer_id"), show=IN + ("customer_id",),
    ),
    RowRule(
        "C-009", COMPLETENESS, "technicians", "HIGH", "Terminated tech missing termination_date",
        column="termination_date", fails=missing("termination_date"),
        scope=is_value("employment_status", "TERMINATED"),
        show=TE + ("employment_status", "termination_date"),
    ),
    RowRule(
        "V-001", VALIDITY, "customers", "CRITICAL", "account_status not in allowed domain",
        column="account_status",
        fails=f"account_status IS NULL OR {outside(upper_trim('account_status'), d.CUSTOMER_STATUS)}",
        show=CU + ("account_status",),
        detail=_note("Not in allowed domain: ACTIVE, INACTIVE, SUSPENDED, PENDING"),
    ),
    RowRule(
        "V-002", VALIDITY, "work_orders", "CRITICAL", "WO status not in allowed domain",
        column="status", fails=outside(upper_snake("status"), d.WORK_ORDER_STATUS),
        show=WO + ("status",), detail=_note("Invalid status value"),
    ),
    RowRule(
        "V-003", VALIDITY, "customers", "HIGH", "Negative credit_limit",
        column="credit_limit", fails=negative("credit_limit"), show=CU,
        detail={"raw_credit_limit": "credit_limit"},
    ),
    credit_unparsed(),
    RowRule(
        "V-005", VALIDITY, "customers", "MEDIUM", "Invalid email format",
        column="email_address", fails=f"NOT rlike(email_address, {quoted(d.EMAIL_PATTERN)})",
        show=CU + ("email_address",), detail=_note("Invalid email format"),
    ),
    RowRule(
        "V-006", VALIDITY, "work_orders", "HIGH", "Negative monetary value on WO",
        fails=negative("labor_cost", "parts_cost", "total_cost"),
        show=WO + ("labor_cost", "parts_cost", "total_cost"), detail=_note("Negative monetary amount"),
    ),
    RowRule(
        "V-007", VALIDITY, "invoices", "CRITICAL", "Negative financial amounts on invoice",
        fails=negative("subtotal", "total_amount", "payment_received"),
        show=IN + ("subtotal", "total_amount", "payment_received"), detail=_note("Negative financial amount"),
    ),
    RowRule(
        "V-008", VALIDITY, "work_orders", "HIGH", "WO type not in allowed domain",
        column="work_order_type", fails=outside(upper_trim("work_order_type"), d.WORK_ORDER_TYPE),
        show=WO + ("work_order_type",), detail=_note("WO type not in allowed domain"),
    ),
    RowRule(
        "V-009", VALIDITY, "technicians", "HIGH", "employment_status invalid domain/casing",
        column="employment_status", fails=outside(upper_snake("employment_status"), d.TECHNICIAN_STATUS),
        show=("technician_id", "first_name", "last_name", "employment_status"),
        detail={"normalized_attempt": upper_snake("employment_status")},
    ),
    RowRule(
        "V-010", VALIDITY, "technicians", "HIGH", "Negative hourly_rate",
        column="hourly_rate", fails=negative("hourly_rate"),
        show=TE + ("hourly_rate",), detail=_note("Negative hourly rate"),
    ),
    RowRule(
        "V-011", VALIDITY, "technicians", "MEDIUM", "hourly_rate > $500 (suspect value)",
        column="hourly_rate", fails=f"{number('hourly_rate')} > {d.MAX_RATE}", show=TE + ("hourly_rate",),
    ),
    RowRule(
        "V-012", VALIDITY, "work_orders", "MEDIUM", "WO priority not in allowed domain",
        column="priority", fails=outside(upper_trim("priority"), d.PRIORITY), show=WO + ("priority",),
    ),
    RowRule(
        "V-013", VALIDITY, "invoices", "HIGH", "invoice_status not in allowed domain",
        column="invoice_status", fails=outside(upper_trim("invoice_status"), d.INVOICE_STATUS),
        show=IN + ("invoice_status",),
    ),
    RowRule(
        "V-014", VALIDITY, "assignments", "LOW", "assignment_role not in allowed domain",
        column="assignment_role", fails=outside(upper_trim("assignment_role"), d.ASSIGNMENT_ROLE),
        show=("assignment_id", "assignment_role"),
    ),
    RowRule(
        "V-015", VALIDITY, "assignments", "MEDIUM", "assignment_status not in allowed domain",
        column="assignment_status", fails=outside(upper_trim("assignment_status"), d.ASSIGNMENT_STATUS),
        show=("assignment_id", "assignment_status"),
    ),
    RowRule(
        "V-016", VALIDITY, "customers", "LOW", "phone_number contains alpha characters",
        column="phone_number", fails="rlike(phone_number, '[a-zA-Z]')", show=CU + ("phone_number",),
    ),
    RowRule(
        "V-017", VALIDITY, "customers", "HIGH", "customer_type not in allowed domain",
        column="customer_type", fails=outside(upper_trim("customer_type"), d.CUSTOMER_TYPE),
        show=CU + ("customer_type",),
    ),
    RowRule(
        "V-018", VALIDITY, "invoices", "CRITICAL", "discount_amount exceeds subtotal",
        fails=after(number, "discount_amount", "subtotal"), show=IN + ("subtotal", "discount_amount"),
    ),
    RowRule(
        "CS-001", CONSISTENCY, "work_orders", "CRITICAL", "actual_end before actual_start",
        fails=after(instant, "actual_start", "actual_end"), show=WO + ("actual_start", "actual_end"),
        detail={"minutes_inverted": minutes_crossed(instant("actual_end"), instant("actual_start"))},
    ),
    RowRule(
        "CS-002", CONSISTENCY, "technicians", "HIGH", "hire_date after termination_date",
        fails=after(day, "hire_date", "termination_date"), show=TE + ("hire_date", "termination_date"),
        detail=_note("hire_date is after termination_date"),
    ),
    RowRule(
        "CS-003", CONSISTENCY, "work_orders", "HIGH", "Completed WO missing time data",
        fails=f"{COMPLETED} AND ({MISSING_TIMES})",
        show=("work_order_id", "status", "actual_start", "actual_end"),
        detail=_note("Completed WO missing time data"),
    ),
    RowRule(
        "CS-004", CONSISTENCY, "work_orders", "HIGH", "total_cost does not equal labor+parts",
        fails=f"{gap(ORDER_COST, 'total_cost')} > {d.CENT}", show=WO,
        detail={
            "labor_cost": number("labor_cost"),
            "parts_cost": number("parts_cost"),
            "expected_total": f"round({ORDER_COST}, 2)",
            "actual_total": number("total_cost"),
            "discrepancy_amount": f"round({gap(ORDER_COST, 'total_cost')}, 2)",
        },
    ),
    RowRule(
        "CS-005", CONSISTENCY, "invoices", "CRITICAL", "Invoice total does not balance",
        fails=f"{gap(BILL_AMOUNT, 'total_amount')} > {d.CENT}", show=IN,
        detail={
            "subtotal": number("subtotal"),
            "tax_amount": number("tax_amount"),
            "discount_amount": number("discount_amount"),
            "expected_total": f"round({BILL_AMOUNT}, 2)",
            "recorded_total": number("total_amount"),
            "discrepancy": f"round({gap(BILL_AMOUNT, 'total_amount')}, 2)",
        },
    ),
    RowRule(
        "CS-006", CONSISTENCY, "work_orders", "HIGH", "SLA flagged met but completed after due date",
        fails=f"{one_of(upper_trim('sla_met'), ('Y', 'YES'))} AND {LATE}",
        show=WO + ("sla_due_date", "actual_end", "sla_met"),
        detail=_note("SLA flagged as MET but completed after due date"),
    ),
    RowRule(
        "CS-008", CONSISTENCY, "invoices", "MEDIUM", "Payment received exceeds invoice total",
        fails=after(number, "payment_received", "total_amount"), show=IN,
        detail={
            "invoice_total": number("total_amount"),
            "payment_received": number("payment_received"),
            "overpayment": f"round({number('payment_received')} - {number('total_amount')}, 2)",
        },
    ),
    RowRule(
        "CS-009", CONSISTENCY, "invoices", "HIGH", "due_date before invoice_date",
        fails=after(day, "invoice_date", "due_date"), show=IN + ("invoice_date", "due_date"),
        detail=_note("due_date is before invoice_date"),
    ),
    RowRule(
        "CS-010", CONSISTENCY, "work_orders", "MEDIUM", "actual_hours > 24 on single-day WO",
        fails=f"{number('actual_hours')} > {d.MAX_HOURS}"
        f" AND datediff({instant('actual_end')}, {instant('actual_start')}) = 0",
        show=WO + ("actual_start", "actual_end", "actual_hours"),
        detail=_note("actual_hours exceeds maximum for single-day WO"),
    ),
    RowRule(
        "CS-011", CONSISTENCY, "assignments", "HIGH", "Assignment end_time before start_time",
        fails=after(instant, "start_time", "end_time"), show=("assignment_id", "start_time", "end_time"),
    ),
    RowRule(
        "CS-012", CONSISTENCY, "assignments", "MEDIUM", "hours_logged doesn't match start/end duration",
        fails=f"abs({number('hours_logged')} - {hours_between(instant('start_time'), instant('end_time'))}) > 1",
        show=("assignment_id", "start_time", "end_time", "hours_logged"),
    ),
    RowRule(
        "T-001", TIMELINESS, "customers", "HIGH", "customer created_date in the future",
        column="created_date", fails=future("created_date"), show=CU + ("created_date",),
        detail=_note("created_date is in the future"),
    ),
    RowRule(
        "T-002", TIMELINESS, "technicians", "HIGH", "hire_date in the future",
        column="hire_date", fails=future("hire_date"), show=TE + ("hire_date",),
        detail=_note("hire_date is in the future"),
    ),
    RowRule(
        "T-003", TIMELINESS, "work_orders", "CRITICAL", "Completed WO has future scheduled_date",
        column="scheduled_date", fails=f"{COMPLETED} AND {future('scheduled_date')}",
        show=WO + ("status", "scheduled_date", "actual_end"),
        detail=_note("Completed WO has future scheduled date"),
    ),
    RowRule(
        "T-004", TIMELINESS, "customers", "LOW", "Active customer record stale > 2 years",
        column="last_modified",
        fails=f"{is_value('account_status', 'ACTIVE')} AND {instant('last_modified')} IS NOT NULL"
        f" AND {days_since('last_modified')} > {d.STALE_CUSTOMER_DAYS}",
        show=CU + ("account_status", "last_modified"),
        detail={
            "days_since_modified": days_since("last_modified"),
            **_note("Customer record not updated in 2+ years"),
        },
    ),
    RowRule(
        "T-005", TIMELINESS, "work_orders", "HIGH", "IN_PROGRESS WO stale > 90 days",
        column="last_modified",
        fails=f"{upper_snake('status')} = 'IN_PROGRESS' AND {instant('last_modified')} IS NOT NULL"
        f" AND {days_since('last_modified')} > {d.STALE_WORK_DAYS}",
        show=WO + ("status", "scheduled_date", "last_modified"),
        detail={
            "days_open": days_since("last_modified"),
            **_note("IN_PROGRESS WO stale for 90+ days"),
        },
    ),
    RowRule(
        "T-006", TIMELINESS, "customers", "MEDIUM", "created_date cannot be parsed",
        column="created_date", fails=unparsed("created_date", day), show=CU + ("created_date",),
        detail=_note("created_date cannot be parsed as a date"),
    ),
    RowRule(
        "T-007", TIMELINESS, "technicians", "MEDIUM", "hire_date cannot be parsed",
        column="hire_date", fails=unparsed("hire_date", day), show=TE + ("hire_date",),
    ),
    RowRule(
        "BR-003", BUSINESS, "work_orders", "HIGH", "SLA flag does not match calculated SLA",
        column="sla_met", fails=SLA_MISMATCH, scope=SLA_KNOWN, lists_scope=True,
        show=WO + ("priority", "sla_due_date", "actual_end"),
        detail={
            "recorded_sla_flag": "sla_met",
            "calculated_sla_flag": SLA_KEPT,
            "sla_flag_status": case([(SLA_MISMATCH, "'MISMATCH'")], "'OK'"),
        },
    ),
    RowRule(
        "BR-004", BUSINESS, "invoices", "MEDIUM", "PAID invoice missing payment_date",
        column="payment_date",
        fails=f"{is_value('invoice_status', 'PAID')} AND payment_date IS NULL",
        show=IN + ("invoice_status", "payment_date"),
    ),
    RowRule(
        "BR-005", BUSINESS, "work_orders", "MEDIUM", "Completed WO has estimated_hours = 0",
        column="estimated_hours", fails=f"{COMPLETED} AND {number('estimated_hours')} = 0",
        show=WO + ("status", "estimated_hours"),
    ),
)


def excess(measure: str, *not_null: str) -> str:
    """Records beyond the first of each key; keys with a null part pass when listed."""
    condition = " AND ".join([f"{measure} > 1", *[f"{name} IS NOT NULL" for name in not_null]])
    return f"if({condition}, {measure} - 1, 0)"


def repeated_keys(measure: str, key: str) -> str:
    return f"if({measure} > 1 AND {key} IS NOT NULL, 1, 0)"


def without(child: str, parent: str, key: str) -> str:
    """Child records whose key no parent record has; null keys pass."""
    return f"if({key} IS NOT NULL AND {parent} = 0, {child}, 0)"


def childless(parent: str, child: str, key: str) -> str:
    """Parent records without a child; a null key never finds one."""
    return f"if({child} = 0 OR {key} IS NULL, {parent}, 0)"


KEY_RULES = (
    KeyRule(
        "U-001", UNIQUENESS, "customers", "CRITICAL", "Duplicate customer_id", column="customer_id",
        profile=p.CUSTOMER, uses=("customers",), total="customers", failed=excess("customers"),
    ),
    KeyRule(
        "U-002", UNIQUENESS, "customers", "HIGH", "Duplicate email address across customers",
        column="email_address", profile=p.EMAIL, uses=("customers",), total="customers",
        failed=excess("customers", "email_key"),
    ),
    KeyRule(
        "U-003", UNIQUENESS, "work_orders", "CRITICAL", "Duplicate work_order_id", column="work_order_id",
        profile=p.WORK_ORDER, uses=("orders",), total="orders", failed=excess("orders"),
    ),
    KeyRule(
        "U-004", UNIQUENESS, "invoices", "HIGH", "Multiple invoices per work order", column="work_order_id",
        profile=p.WORK_ORDER, uses=("bills",), total="bills", failed=excess("bills"),
    ),
    KeyRule(
        "U-005", UNIQUENESS, "assignments", "HIGH", "Same tech assigned twice to same WO",
        profile=p.TASK, uses=("tasks",), total="tasks", failed=excess("tasks"),
    ),
    KeyRule(
        "U-006", UNIQUENESS, "technicians", "HIGH", "Duplicate employee_number", column="employee_number",
        profile=p.EMPLOYEE, uses=("technicians",), total="technicians",
        failed=repeated_keys("technicians", "employee_number"),
    ),
    KeyRule(
        "R-001", INTEGRITY, "work_orders", "CRITICAL", "WO has orphaned customer_id", column="customer_id",
        profile=p.CUSTOMER, uses=("orders", "customers"), total="orders",
        failed=without("orders", "customers", "customer_id"),
    ),
    KeyRule(
        "R-002", INTEGRITY, "invoices", "CRITICAL", "Invoice has orphaned work_order_id", column="work_order_id",
        profile=p.WORK_ORDER, uses=("bills", "orders"), total="bills",
        failed=without("bills", "orders", "work_order_id"),
    ),
    KeyRule(
        "R-003", INTEGRITY, "assignments", "HIGH", "Assignment has orphaned work_order_id",
        column="work_order_id", profile=p.WORK_ORDER, uses=("tasks", "orders"), total="tasks",
        failed=without("tasks", "orders", "work_order_id"),
    ),
    KeyRule(
        "R-004", INTEGRITY, "assignments", "HIGH", "Assignment has orphaned technician_id",
        column="technician_id", profile=p.TECHNICIAN, uses=("tasks", "technicians"), total="tasks",
        failed=without("tasks", "technicians", "technician_id"),
    ),
    KeyRule(
        "R-005", INTEGRITY, "invoices", "HIGH", "Invoice has orphaned customer_id", column="customer_id",
        profile=p.CUSTOMER, uses=("bills", "customers"), total="bills",
        failed=without("bills", "customers", "customer_id"),
    ),
    KeyRule(
        "BR-001", BUSINESS, "work_orders", "HIGH", "Completed WO has no assignment record",
        profile=p.WORK_ORDER, uses=("done", "tasks"), total="done", failed=childless("done", "tasks", "work_order_id"),
    ),
    KeyRule(
        "BR-002", BUSINESS, "work_orders", "HIGH", "Completed WO missing invoice (revenue leakage risk)",
        profile=p.WORK_ORDER, uses=("done", "done_paid", "bills"), total="done",
        failed=childless("done_paid", "bills", "work_order_id"),
    ),
)


def terminated_on_open(frames: Frames, as_of: dt.date) -> DataFrame:
    """Join rows of assignment, open order and terminated technician.

    Terminated technicians are reduced to one count per key first, so the join
    never multiplies rows, however often a key occurs.  The assignments that
    meet one and the open orders are one union and one aggregate per order.
    """
    count = F.count(F.lit(1))
    gone = frames["technicians"].filter(TERMINATED).groupBy("technician_id").agg(count.alias("gone"))
    tasks = frames["assignments"].filter("work_order_id IS NOT NULL").select("work_order_id", "technician_id")
    left_behind = attach_measured(tasks, gone, ["technician_id"], "inner")
    orders = frames["work_orders"].filter(OPEN).filter("work_order_id IS NOT NULL")
    stacked = left_behind.selectExpr("work_order_id", "gone", "0L AS open_orders").unionAll(
        orders.selectExpr("work_order_id", "0L AS gone", "1L AS open_orders")
    )
    per_order = stacked.groupBy("work_order_id").agg(F.sum("gone").alias("gone"), F.sum("open_orders").alias("open_orders"))
    counts = frames["assignments"].agg(count.alias("total_records")).selectExpr("total_records", "0L AS failed_records")
    counts = counts.unionAll(per_order.selectExpr("0L AS total_records", "gone * open_orders AS failed_records"))
    return counts.selectExpr("sum(total_records) AS total_records", "sum(failed_records) AS failed_records")


PAIR_RULES = (
    PairRule(
        "CS-007", CONSISTENCY, "assignments", "HIGH", "Terminated tech on open WO", counts=terminated_on_open,
        daily=False,
    ),
)

RULES = ROW_RULES + KEY_RULES + PAIR_RULES
BY_KEY = {rule.key: rule for rule in RULES}
