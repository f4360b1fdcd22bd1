"""Rules for problem classes the standard suite does not look at.

They are grouped by topic; a group is evaluated like any other suite.  They do
not enter the score.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as d
from ..functions.columns import (
    TODAY,
    day,
    instant,
    number,
    one_of,
    outside,
    quoted,
    read_as_latin1,
    upper_snake,
    upper_trim,
)
from . import profiles as p
from .catalog import (
    BUSINESS,
    COMPLETENESS,
    CONSISTENCY,
    INTEGRITY,
    TIMELINESS,
    UNIQUENESS,
    VALIDITY,
    after,
    excess,
    future,
    gap,
    is_value,
    missing,
    negative,
    without,
)
from .joins import attach
from .lookups import CONTRADICTS, UNKNOWN, LookupRule, learn
from .profiles import COMPLETED
from .rules import FrameRule, Frames, KeyRule, PairRule, RowRule


def _row(group, code, dimension, table, severity, text, fails, **more):
    return RowRule(code, dimension, table, severity, text, group=group, fails=fails, **more)


def _key(group, code, dimension, table, severity, text, profile, uses, total, failed):
    return KeyRule(
        code, dimension, table, severity, text,
        group=group, profile=profile, uses=uses, total=total, failed=failed,
    )


def _pair(group, code, dimension, table, severity, text, counts):
    return PairRule(code, dimension, table, severity, text, group=group, counts=counts)


def _frame(group, code, dimension, table, severity, text, source, total, failed):
    return FrameRule(
        code, dimension, table, severity, text, group=group, source=source, total=total, failed=failed
    )


def state(*values: str) -> str:
    return one_of(upper_snake("status"), values)


def matches(name: str, pattern: str) -> str:
    return f"rlike({name}, {quoted(pattern)})"


def when_parent(child: str, parent: str) -> str:
    """Child records whose key has such a parent."""
    return f"if({parent} > 0, {child}, 0)"


def _lookup(group, code, dimension, table, severity, text, lookup, key, show, value=None, outcome=UNKNOWN):
    return LookupRule(
        code, dimension, table, severity, text,
        group=group, lookup=lookup, key_text=key, value_text=value, outcome=outcome, show=show,
    )


#: a place is learnt from the customers: pairs on so many rows at least, which make up such a share of their key's rows
PLACE_SUPPORT, PLACE_SHARE = 3, 0.3
CITY, STATE_OF, REGION_OF = upper_trim("billing_city"), upper_trim("billing_state"), upper_trim("region_code")


def learnt_places(frames: Frames, key: str, value: str) -> DataFrame:
    return learn(frames["customers"], key, value, PLACE_SUPPORT, PLACE_SHARE)


LINE_AMOUNT = f"{number('quantity_used')} * {number('unit_cost')}"


def recovered_amount(name: str) -> str:
    """The number inside an amount written with a currency mark."""
    return number(f"regexp_extract({name}, {quoted(d.CURRENCY_PATTERN)}, 2)")


def spans(df: DataFrame, key: str, value: str) -> DataFrame:
    """Records per key and the first and last value found on it."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("records"), F.min(value).alias("first_seen"), F.max(value).alias("last_seen")
    )


SPREAD = "first_seen <> last_seen"


def _spread_counts(per_key: DataFrame, key: str) -> DataFrame:
    return per_key.selectExpr(
        "sum(records) AS total_records", f"count_if({key} IS NOT NULL AND {SPREAD}) AS failed_records"
    )


def customer_batches(frames: Frames) -> DataFrame:
    return spans(frames["customers"], "customer_id", "_batch_id")


def number_owners(frames: Frames) -> DataFrame:
    return spans(frames["invoices"], "invoice_number", "invoice_id")


def cross_batch_keys(frames: Frames, as_of: dt.date) -> DataFrame:
    return _spread_counts(customer_batches(frames), "customer_id")


def numbers_on_two_invoices(frames: Frames, as_of: dt.date) -> DataFrame:
    return _spread_counts(number_owners(frames), "invoice_number")


OVERDUE = f"datediff(made, due) > {d.LATE_ASSIGNMENT_DAYS}"
ON_STOPPED = "if(stopped > 0, active_tasks, 0)"


def assignment_days(frames: Frames) -> DataFrame:
    """Assignments per order and day they were made, with the order's last scheduled day and whether it is held or cancelled.

    Both tables are reduced per key before they meet, and read once for all rules about the two.
    """
    active = p.WORK_ORDER.measures["active_tasks"].scope
    made = frames["assignments"].selectExpr("work_order_id", f"{day('assigned_date')} AS made", f"{active} AS active")
    made = made.groupBy("work_order_id", "made").agg(
        F.count(F.lit(1)).alias("tasks"), F.expr("count_if(active)").alias("active_tasks")
    )
    stopped = p.WORK_ORDER.measures["not_active"].scope
    orders = frames["work_orders"].groupBy("work_order_id").agg(
        F.expr(f"max({day('scheduled_date')})").alias("due"), F.expr(f"count_if({stopped})").alias("stopped")
    )
    return attach(made, orders, ["work_order_id"])


def late_assignment_rows(frames: Frames) -> DataFrame:
    made = frames["assignments"].selectExpr("assignment_id", "work_order_id", f"{day('assigned_date')} AS made")
    due = frames["work_orders"].groupBy("work_order_id").agg(F.expr(f"max({day('scheduled_date')})").alias("due"))
    return attach(made, due, ["work_order_id"], "inner").filter(OVERDUE)


def stopped_orders(frames: Frames) -> DataFrame:
    """Orders that are held or cancelled and how many active assignments each has."""
    counts = assignment_days(frames).groupBy("work_order_id").agg(F.expr(f"sum({ON_STOPPED})").alias("failed_records"))
    return counts.filter("failed_records > 0").selectExpr(
        "'X-ACTIVE-ON-STOPPED' AS rule_code", "'HIGH' AS severity", "work_order_id", "failed_records"
    )


# what fails the pair and frame rules
PAIR_LISTINGS = {
    "x_cross_batch": lambda frames: customer_batches(frames).filter(SPREAD),
    "x_invoice_number": lambda frames: number_owners(frames).filter(f"invoice_number IS NOT NULL AND {SPREAD}"),
    "x_late_assignment": late_assignment_rows,
    "x_active_on_stopped": stopped_orders,
}


ALL_EXPIRED = "if(active > 0 AND certs > 0 AND certs = expired_certs, active, 0)"

CU, TE, WO, IN, AS, PA, CE = (
    "customers", "technicians", "work_orders", "invoices", "assignments", "parts", "certs",
)

EXTENDED_RULES = (
    _row("x_mojibake", "X-MOJIBAKE", VALIDITY, CU, "MEDIUM", "customer_name shows a broken encoding",
         f"{read_as_latin1('customer_name')} IS NOT NULL", show=("customer_id", "customer_name"),
         detail={"repaired_name": read_as_latin1("customer_name")}),
    _row("x_zero_width", "X-ZERO-WIDTH", VALIDITY, CU, "MEDIUM", "email holds an invisible character",
         matches("email_address", d.INVISIBLE_PATTERN), show=("customer_id", "email_address")),
    _lookup("x_city_state", "X-CITY-UNKNOWN", VALIDITY, CU, "LOW", "billing_city is not a known city",
            "cities", CITY, ("customer_id", "billing_city", "billing_state"), STATE_OF),
    _lookup("x_city_state", "X-CITY-STATE", CONSISTENCY, CU, "MEDIUM", "billing_city is not in billing_state",
            "cities", CITY, ("customer_id", "billing_city", "billing_state"), STATE_OF, CONTRADICTS),
    _lookup("x_region_state", "X-REGION-UNKNOWN", VALIDITY, CU, "LOW", "billing_state is not a known state",
            "states", STATE_OF, ("customer_id", "billing_state", "region_code"), REGION_OF),
    _lookup("x_region_state", "X-REGION-STATE", CONSISTENCY, CU, "MEDIUM", "region_code does not cover billing_state",
            "states", STATE_OF, ("customer_id", "billing_state", "region_code"), REGION_OF, CONTRADICTS),
    _row("x_currency_text", "X-CURRENCY-CREDIT", VALIDITY, CU, "MEDIUM", "credit_limit carries a currency mark",
         matches("credit_limit", d.CURRENCY_PATTERN), show=("customer_id", "credit_limit"),
         detail={"recovered_amount": recovered_amount("credit_limit")}),
    _row("x_currency_text", "X-RANGE-CREDIT", VALIDITY, CU, "MEDIUM", "credit_limit is a range",
         matches("credit_limit", d.RANGE_PATTERN), show=("customer_id", "credit_limit")),
    _row("x_currency_text", "X-CURRENCY-RATE", VALIDITY, TE, "MEDIUM", "hourly_rate carries a currency mark",
         matches("hourly_rate", d.CURRENCY_PATTERN), show=("technician_id", "hourly_rate"),
         detail={"recovered_amount": recovered_amount("hourly_rate")}),
    _row("x_currency_text", "X-RANGE-RATE", VALIDITY, TE, "MEDIUM", "hourly_rate is a range",
         matches("hourly_rate", d.RANGE_PATTERN), show=("technician_id", "hourly_rate")),
    _row("x_sci_notation", "X-SCI-NOTATION", VALIDITY, CU, "LOW", "credit_limit in scientific notation",
         matches("credit_limit", d.SCIENTIFIC_PATTERN), show=("customer_id", "credit_limit")),
    _row("x_magnitude", "X-MAGNITUDE", VALIDITY, CU, "MEDIUM", "credit_limit is implausibly large",
         f"{number('credit_limit')} > {d.HUGE_CREDIT}", show=("customer_id", "credit_limit")),
    _row("x_modified_before_created", "X-MODIFIED-BEFORE-CREATED", CONSISTENCY, CU, "MEDIUM",
         "last_modified before created_date", after(day, "created_date", "last_modified"),
         show=("customer_id", "created_date", "last_modified")),
    _row("x_modified_before_created", "X-SCHEDULED-BEFORE-CREATED", CONSISTENCY, WO, "MEDIUM",
         "scheduled_date before created_date", after(day, "created_date", "scheduled_date"),
         show=("work_order_id", "created_date", "scheduled_date")),
    _pair("x_cross_batch_duplicate", "X-CROSS-BATCH", UNIQUENESS, CU, "HIGH",
          "customer_id extracted again in a later batch", cross_batch_keys),
    _row("x_placeholder", "X-PLACEHOLDER-EMAIL", VALIDITY, CU, "LOW", "email is a placeholder",
         f"lower(trim(email_address)) = {quoted(d.PLACEHOLDER_MAIL)}", show=("customer_id", "email_address")),
    _row("x_placeholder", "X-DIGIT-NAME", VALIDITY, CU, "MEDIUM", "customer_name is all digits",
         matches("customer_name", d.DIGITS_PATTERN), show=("customer_id", "customer_name")),
    _row("x_placeholder", "X-EMPTY-STATUS", COMPLETENESS, CU, "HIGH", "account_status is empty text",
         "account_status = ''", show=("customer_id", "account_status")),
    _row("x_tech_domains", "X-TECH-REGION", VALIDITY, TE, "MEDIUM", "home_region not in allowed domain",
         outside(upper_trim("home_region"), d.REGION), show=("technician_id", "home_region")),
    _row("x_tech_domains", "X-TECH-NO-REGION", COMPLETENESS, TE, "LOW", "home_region is NULL",
         missing("home_region"), show=("technician_id", "home_region")),
    _row("x_tech_domains", "X-TECH-SKILL", VALIDITY, TE, "MEDIUM", "skill_level missing or not in allowed domain",
         f"skill_level IS NULL OR {outside(upper_trim('skill_level'), d.SKILL_LEVEL)}",
         show=("technician_id", "skill_level")),
    _row("x_tech_domains", "X-TECH-EMAIL", VALIDITY, TE, "LOW", "e-mail at a personal provider",
         one_of("lower(substring_index(email, '@', -1))", d.PERSONAL_MAIL),
         show=("technician_id", "email")),
    _lookup("x_tech_domains", "X-TECH-MANAGER", INTEGRITY, TE, "MEDIUM", "manager_id is not a known manager",
            "managers", "manager_id", ("technician_id", "manager_id")),
    _row("x_tech_domains", "X-TECH-NAMES", COMPLETENESS, TE, "MEDIUM", "first and last name are NULL",
         "first_name IS NULL AND last_name IS NULL", show=("technician_id",)),
    _key("x_name_duplicate", "X-NAME-DUPLICATE", UNIQUENESS, TE, "LOW", "full_name on more than one technician",
         p.TECHNICIAN_NAME, ("technicians",), "technicians",
         "if(technicians > 1 AND name_key <> '', technicians - 1, 0)"),
    _key("x_wo_inactive_customer", "X-WO-INACTIVE-CUSTOMER", BUSINESS, WO, "HIGH",
         "WO for an inactive or suspended customer", p.CUSTOMER, ("orders", "barred"), "orders",
         when_parent("orders", "barred")),
    _row("x_component_gt_total", "X-PARTS-GT-TOTAL", CONSISTENCY, WO, "HIGH", "parts_cost exceeds total_cost",
         after(number, "parts_cost", "total_cost"), show=("work_order_id", "parts_cost", "total_cost")),
    _row("x_component_gt_total", "X-LABOR-GT-TOTAL", CONSISTENCY, WO, "HIGH", "labor_cost exceeds total_cost",
         after(number, "labor_cost", "total_cost"), show=("work_order_id", "labor_cost", "total_cost")),
    _row("x_state_contradiction", "X-CANCELLED-COST", BUSINESS, WO, "MEDIUM", "cancelled WO carries costs",
         f"{state('CANCELLED')} AND {number('total_cost')} > 0", show=("work_order_id", "total_cost")),
    _row("x_state_contradiction", "X-OPEN-WITH-END", BUSINESS, WO, "MEDIUM", "IN_PROGRESS WO has an actual_end",
         f"{state('IN_PROGRESS')} AND actual_end IS NOT NULL",
         show=("work_order_id", "actual_end")),
    _row("x_state_contradiction", "X-OPEN-RESOLVED", BUSINESS, WO, "MEDIUM", "open WO has a resolution_code",
         f"{outside(upper_trim('status'), d.COMPLETED)} AND resolution_code IS NOT NULL",
         show=("work_order_id", "status", "resolution_code")),
    _row("x_state_contradiction", "X-ZERO-HOURS", BUSINESS, WO, "MEDIUM", "completed WO with zero hours",
         f"{COMPLETED} AND {number('actual_hours')} = 0", show=("work_order_id", "actual_hours")),
    _row("x_state_contradiction", "X-INSTALL-NO-PARTS", BUSINESS, WO, "MEDIUM",
         "completed installation without parts cost",
         f"{COMPLETED} AND {is_value('work_order_type', 'INSTALLATION')} AND coalesce({number('parts_cost')}, 0) = 0",
         show=("work_order_id", "parts_cost")),
    _row("x_wo_null_number", "X-WO-NULL-NUMBER", COMPLETENESS, WO, "MEDIUM", "work_order_number is NULL",
         missing("work_order_number"), show=("work_order_id",)),
    _row("x_invoice_null_number", "X-INVOICE-NULL-NUMBER", COMPLETENESS, IN, "MEDIUM", "invoice_number is NULL",
         missing("invoice_number"), show=("invoice_id",)),
    _row("x_blank_description", "X-BLANK-DESCRIPTION", COMPLETENESS, WO, "LOW", "description is only blanks",
         "trim(description) = ''", show=("work_order_id",)),
    _row("x_invoice_contradictions", "X-TAX-GT-SUBTOTAL", CONSISTENCY, IN, "HIGH", "tax_amount exceeds subtotal",
         after(number, "tax_amount", "subtotal"), show=("invoice_id", "subtotal", "tax_amount")),
    _row("x_invoice_contradictions", "X-VOID-PAID", BUSINESS, IN, "HIGH", "VOID invoice has a payment",
         f"{is_value('invoice_status', 'VOID')} AND {number('payment_received')} > 0",
         show=("invoice_id", "payment_received")),
    _key("x_invoice_contradictions", "X-BILLED-CANCELLED", BUSINESS, IN, "HIGH", "invoice for a cancelled WO",
         p.WORK_ORDER, ("bills", "cancelled"), "bills", when_parent("bills", "cancelled")),
    _row("x_invoice_contradictions", "X-PAID-EARLY", CONSISTENCY, IN, "MEDIUM", "payment_date before invoice_date",
         after(day, "invoice_date", "payment_date"), show=("invoice_id", "invoice_date", "payment_date")),
    _row("x_invoice_contradictions", "X-PAID-ZERO", BUSINESS, IN, "MEDIUM", "PAID invoice with zero total",
         f"{is_value('invoice_status', 'PAID')} AND {number('total_amount')} = 0", show=("invoice_id",)),
    _row("x_invoice_contradictions", "X-PAID-NOT-MARKED", BUSINESS, IN, "MEDIUM", "paid in full but still SENT",
         f"{is_value('invoice_status', 'SENT')} AND {number('payment_received')} >= {number('total_amount')}",
         show=("invoice_id", "payment_received", "total_amount")),
    _row("x_invoice_contradictions", "X-INVOICE-FUTURE", TIMELINESS, IN, "MEDIUM", "invoice_date in the future",
         future("invoice_date"), show=("invoice_id", "invoice_date")),
    _pair("x_invoice_number_duplicate", "X-INVOICE-NUMBER", UNIQUENESS, IN, "HIGH",
          "invoice_number on more than one invoice", numbers_on_two_invoices),
    _row("x_assignment_contradictions", "X-DONE-FUTURE", TIMELINESS, AS, "HIGH",
         "completed assignment starts in the future",
         f"{is_value('assignment_status', 'COMPLETED')} AND {future('start_time')}",
         show=("assignment_id", "start_time")),
    _row("x_assignment_contradictions", "X-DONE-ZERO", BUSINESS, AS, "MEDIUM", "completed assignment, zero hours",
         f"{is_value('assignment_status', 'COMPLETED')} AND {number('hours_logged')} = 0",
         show=("assignment_id", "hours_logged")),
    _row("x_assignment_contradictions", "X-NEGATIVE-HOURS", VALIDITY, AS, "HIGH", "hours_logged is negative",
         negative("hours_logged"), show=("assignment_id", "hours_logged")),
    _row("x_assignment_contradictions", "X-LONG-SHIFT", BUSINESS, AS, "LOW", "hours_logged above a single shift",
         f"{number('hours_logged')} > {d.LONG_SHIFT_HOURS}", show=("assignment_id", "hours_logged")),
    _frame("x_assignment_contradictions", "X-ACTIVE-ON-STOPPED", BUSINESS, AS, "HIGH",
           "ACTIVE assignment on a held or cancelled WO", assignment_days, "tasks", ON_STOPPED),
    _frame("x_assignment_contradictions", "X-LATE-ASSIGNMENT", TIMELINESS, AS, "MEDIUM",
           "assigned long after the scheduled date", assignment_days, "tasks", f"if({OVERDUE}, tasks, 0)"),
    _row("x_assignment_contradictions", "X-NULL-STATUS", COMPLETENESS, AS, "MEDIUM", "assignment_status is NULL",
         missing("assignment_status"), show=("assignment_id",)),
    _row("x_assignment_contradictions", "X-ASSIGNED-AFTER-START", CONSISTENCY, AS, "MEDIUM",
         "assigned_date after start_time",
         f"{day('assigned_date')} > CAST({instant('start_time')} AS date)",
         show=("assignment_id", "assigned_date", "start_time")),
    _key("x_two_leads", "X-TWO-LEADS", BUSINESS, AS, "MEDIUM", "more than one LEAD on a WO", p.WORK_ORDER,
         ("tasks", "leads"), "tasks",
         "if(work_order_id IS NOT NULL AND leads > 1, 1, 0)"),
    _row("x_parts", "X-PART-QTY", VALIDITY, PA, "HIGH", "quantity_used is zero or negative",
         f"{number('quantity_used')} <= 0", show=("part_usage_id", "quantity_used")),
    _row("x_parts", "X-PART-PRICE", VALIDITY, PA, "MEDIUM", "unit_cost is zero",
         f"{number('unit_cost')} = 0", show=("part_usage_id", "unit_cost")),
    _row("x_parts", "X-PART-CURRENCY", VALIDITY, PA, "MEDIUM", "unit_cost carries a currency mark",
         matches("unit_cost", d.CURRENCY_PATTERN), show=("part_usage_id", "unit_cost"),
         detail={"recovered_amount": recovered_amount("unit_cost")}),
    _row("x_parts", "X-PART-TOTAL", CONSISTENCY, PA, "HIGH", "total_cost is not quantity times price",
         f"{gap(LINE_AMOUNT, 'total_cost')} > {d.CENT}",
         show=("part_usage_id", "quantity_used", "unit_cost", "total_cost")),
    _key("x_parts", "X-PART-ORPHAN", INTEGRITY, PA, "HIGH", "part line has orphaned work_order_id", p.WORK_ORDER,
         ("parts", "orders"), "parts", without("parts", "orders", "work_order_id")),
    _row("x_parts", "X-PART-NULL", COMPLETENESS, PA, "MEDIUM", "part_number is NULL",
         missing("part_number"), show=("part_usage_id",)),
    _key("x_parts", "X-PART-DUPLICATE", UNIQUENESS, PA, "MEDIUM", "same part on the same WO and day", p.PART_LINE,
         ("parts",), "parts", excess("parts", "work_order_id", "part_number", "recorded_date")),
    _lookup("x_parts", "X-PART-WAREHOUSE", VALIDITY, PA, "LOW", "warehouse_code is not a known warehouse",
            "warehouses", upper_trim("warehouse_code"), ("part_usage_id", "warehouse_code")),
    _row("x_parts", "X-PART-FUTURE", TIMELINESS, PA, "MEDIUM", "recorded_date in the future",
         future("recorded_date"), show=("part_usage_id", "recorded_date")),
    _row("x_parts", "X-PART-RECORDER", COMPLETENESS, PA, "LOW", "recorded_by is NULL",
         missing("recorded_by"), show=("part_usage_id",)),
    _row("x_certs", "X-CERT-DATES", CONSISTENCY, CE, "HIGH", "expiry_date before issued_date",
         after(day, "issued_date", "expiry_date"), show=("cert_id", "issued_date", "expiry_date")),
    _row("x_certs", "X-CERT-NO-CODE", COMPLETENESS, CE, "MEDIUM", "certification_code is NULL",
         missing("certification_code"), show=("cert_id",)),
    _key("x_certs", "X-CERT-DUPLICATE", UNIQUENESS, CE, "MEDIUM", "same certificate twice for a technician",
         p.CERT_LINE, ("certs",), "certs", excess("certs", "technician_id", "certification_code")),
    _row("x_certs", "X-CERT-STATUS", VALIDITY, CE, "MEDIUM", "cert_status not in allowed domain",
         outside(upper_trim("cert_status"), d.CERT_STATUS), show=("cert_id", "cert_status")),
    _row("x_certs", "X-CERT-FUTURE", TIMELINESS, CE, "MEDIUM", "issued_date in the future",
         future("issued_date"), show=("cert_id", "issued_date")),
    _row("x_certs", "X-CERT-LAPSED", TIMELINESS, CE, "HIGH", "ACTIVE certificate past its expiry",
         f"{is_value('cert_status', 'ACTIVE')} AND {day('expiry_date')} < {TODAY}",
         show=("cert_id", "expiry_date")),
    _key("x_certs", "X-CERT-TERMINATED", BUSINESS, CE, "MEDIUM", "ACTIVE certificate of a terminated technician",
         p.TECHNICIAN, ("certs", "active_certs", "terminated"), "certs", when_parent("active_certs", "terminated")),
    _row("x_certs", "X-CERT-NO-ISSUER", COMPLETENESS, CE, "LOW", "issuing_body is NULL",
         missing("issuing_body"), show=("cert_id",)),
    _key("x_all_certs_expired", "X-ALL-CERTS-EXPIRED", BUSINESS, TE, "HIGH",
         "active technician whose certificates are all expired", p.TECHNICIAN,
         ("technicians", "active", "certs", "expired_certs"), "technicians", ALL_EXPIRED),
)

GROUPS = tuple(dict.fromkeys(rule.group for rule in EXTENDED_RULES))


def group_rules(group: str) -> list:
    return [rule for rule in EXTENDED_RULES if rule.group == group]
