"""Failing records, duplicate groups and labelled joins behind the rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lower_trim, number
from .catalog import BY_KEY
from .evaluate import childless_rows, orphan_rows, repeated_groups, violating_rows
from .joins import attach
from .profiles import COMPLETED, OPEN, TERMINATED
from .rules import Frames, RowRule


def latest_parent(
    parent: DataFrame, key: str, shown: Sequence[str], newest: Sequence[str], matches: str
) -> DataFrame:
    """One row per key: its newest version and how many versions there are.

    Joining to this instead of the raw parent keeps one row per child even when
    a key is repeated on both sides; ``matches`` tells how many join rows each
    stands for.
    """
    best = F.max_by(F.struct(*shown), F.struct(*newest)).alias("_best")
    grouped = parent.filter(F.col(key).isNotNull()).groupBy(key).agg(best, F.count(F.lit(1)).alias(matches))
    return grouped.select(key, "_best.*", matches)


def labelled(df: DataFrame, key: str, *columns: str | Column, note: str | None = None) -> DataFrame:
    rule = BY_KEY[key]
    notes = [] if note is None else [F.lit(note).alias("violation_detail")]
    return df.select(
        F.lit(rule.code).alias("rule_code"), F.lit(rule.severity).alias("severity"), *columns, *notes
    )


def duplicate_customers(frames: Frames) -> DataFrame:
    groups = repeated_groups(frames["customers"], ["customer_id"], None, "occurrence_count")
    listed = labelled(groups, "u_001", "customer_id", "occurrence_count")
    # the id keeps the many groups of two from sorting into one partition
    return listed.orderBy(F.col("occurrence_count").desc(), "customer_id")


def duplicate_emails(frames: Frames) -> DataFrame:
    keyed = frames["customers"].select(F.expr(f"{lower_trim('email_address')} AS shared_email"))
    groups = repeated_groups(keyed.filter(F.col("shared_email").isNotNull()), ["shared_email"], None, "occurrence_count")
    return labelled(groups, "u_002", "shared_email", "occurrence_count")


def duplicate_work_orders(frames: Frames) -> DataFrame:
    seen = [F.min("_extract_timestamp").alias("first_seen"), F.max("_extract_timestamp").alias("last_seen")]
    groups = repeated_groups(frames["work_orders"], ["work_order_id"], None, "occurrence_count", more=seen)
    return labelled(groups, "u_003", "work_order_id", "occurrence_count", "first_seen", "last_seen")


def duplicate_invoices(frames: Frames) -> DataFrame:
    groups = repeated_groups(frames["invoices"], ["work_order_id"], "invoice_id", "invoice_count")
    return labelled(groups, "u_004", "work_order_id", "invoice_count", "invoice_id")


def duplicate_assignments(frames: Frames) -> DataFrame:
    keys = ["work_order_id", "technician_id"]
    groups = repeated_groups(frames["assignments"], keys, "assignment_id", "assignment_count")
    return labelled(groups, "u_005", *keys, "assignment_count", "assignment_id")


def duplicate_employee_numbers(frames: Frames) -> DataFrame:
    known = frames["technicians"].filter(F.col("employee_number").isNotNull())
    groups = repeated_groups(known, ["employee_number"], "technician_id", "occurrence_count")
    return labelled(groups, "u_006", "employee_number", "occurrence_count", "technician_id")


def orphan_work_orders(frames: Frames) -> DataFrame:
    rows = orphan_rows(frames["work_orders"], frames["customers"], "customer_id")
    return labelled(
        rows, "r_001", "work_order_id", "work_order_number", F.col("customer_id").alias("orphaned_customer_id"),
        note="customer_id not found in raw.customers",
    )


def orphan_invoices(frames: Frames) -> DataFrame:
    rows = orphan_rows(frames["invoices"], frames["work_orders"], "work_order_id")
    at_risk = F.concat(F.lit("$"), F.coalesce(F.col("total_amount"), F.lit("0.00")))
    return labelled(
        rows, "r_002", "invoice_id", "invoice_number", F.col("work_order_id").alias("orphaned_wo_id"),
        at_risk.alias("at_risk_amount"), note="work_order_id not found in raw.work_orders",
    )


def orphan_assignments(frames: Frames) -> DataFrame:
    rows = orphan_rows(frames["assignments"], frames["work_orders"], "work_order_id")
    return labelled(
        rows, "r_003", "assignment_id", F.col("work_order_id").alias("orphaned_wo_id"), "technician_id",
        note="work_order_id not found in raw.work_orders",
    )


def orphan_technicians(frames: Frames) -> DataFrame:
    rows = orphan_rows(frames["assignments"], frames["technicians"], "technician_id")
    return labelled(
        rows, "r_004", "assignment_id", "work_order_id", F.col("technician_id").alias("orphaned_tech_id"),
        note="technician_id not found in raw.technicians",
    )


def orphan_billed_customers(frames: Frames) -> DataFrame:
    rows = orphan_rows(frames["invoices"], frames["customers"], "customer_id")
    return labelled(
        rows, "r_005", "invoice_id", "invoice_number", F.col("customer_id").alias("orphaned_customer_id"),
        note="customer_id not found in raw.customers",
    )


def unassigned_orders(frames: Frames) -> DataFrame:
    rows = childless_rows(frames["work_orders"].filter(COMPLETED), frames["assignments"], "work_order_id")
    return labelled(
        rows, "br_001", "work_order_id", "work_order_number", "status", "customer_id",
        note="Completed WO has no technician assignment",
    )


def unbilled_orders(frames: Frames) -> DataFrame:
    done = frames["work_orders"].filter(f"{COMPLETED} AND {number('total_cost')} > 0")
    rows = childless_rows(done, frames["invoices"], "work_order_id")
    return labelled(
        rows, "br_002", "work_order_id", "work_order_number", "status", "customer_id", "total_cost",
        note="Completed WO has no invoice — possible revenue leakage",
    )


def terminated_on_open_rows(frames: Frames) -> DataFrame:
    newest = ("_extract_timestamp", "_src_row")
    gone = latest_parent(
        frames["technicians"].filter(TERMINATED), "technician_id", ("full_name", "employment_status"),
        newest, "technician_matches",
    )
    orders = latest_parent(
        frames["work_orders"].filter(OPEN).withColumnRenamed("status", "wo_status"),
        "work_order_id", ("wo_status",), newest, "order_matches",
    )
    tasks = frames["assignments"].select("assignment_id", "technician_id", "work_order_id")
    rows = attach(attach(tasks, gone, ["technician_id"], "inner"), orders, ["work_order_id"], "inner")
    return labelled(
        rows, "cs_007", "assignment_id", "technician_id", "full_name", "employment_status", "work_order_id",
        "wo_status", (F.col("technician_matches") * F.col("order_matches")).alias("join_rows"),
        note="Terminated tech assigned to open WO",
    )


def invoices_without_contact(frames: Frames) -> DataFrame:
    """Invoices whose customer lacks a contact, an e-mail or a phone."""
    shown = ("customer_name", "primary_contact", "email_address", "phone_number")
    lacking = " OR ".join(f"{name} IS NULL" for name in shown[1:])
    customers = latest_parent(
        frames["customers"].filter(lacking), "customer_id", shown, ("_extract_timestamp", "_src_row"), "join_rows"
    )
    bills = frames["invoices"].select("invoice_id", "invoice_number", "customer_id")
    return attach(bills, customers, ["customer_id"], "inner").select(
        F.lit("C-006").alias("rule_code"), F.lit("MEDIUM").alias("severity"),
        "invoice_id", "invoice_number", "customer_id", *shown, "join_rows",
    )


def shared_email_pairs(frames: Frames) -> DataFrame:
    """Customers that share an e-mail, each next to the first id of its group.

    A group of two is the pair itself.  A larger group of ``k`` ids gives
    ``k - 1`` rows that all name the smallest id, which states the same
    equivalence as every pair of the group without growing quadratically.
    Blanks at the end do not count in the comparison.
    """
    shown = ("customer_id", "customer_name", "email_address", "source_system")
    keyed = (
        frames["customers"]
        .filter(F.col("email_address").isNotNull())
        .select(F.lower(F.rtrim("email_address")).alias("email_key"), *shown, "_src_row")
    )
    first = keyed.groupBy("email_key").agg(
        F.min_by(F.struct("customer_id", "customer_name", "email_address", "source_system"),
                 F.struct("customer_id", "_src_row")).alias("_first"),
        F.count(F.lit(1)).alias("members"),
    )
    first = first.filter(F.col("members") > 1).select("email_key", "_first", "members")
    rows = attach(keyed, first, ["email_key"], "inner").filter("_first.customer_id < customer_id")
    return rows.select(
        F.lit("U-002").alias("rule_code"),
        F.lit("HIGH").alias("severity"),
        F.col("_first.customer_id").alias("customer_id_1"),
        F.col("customer_id").alias("customer_id_2"),
        F.col("_first.customer_name").alias("name_1"),
        F.col("customer_name").alias("name_2"),
        F.col("_first.email_address").alias("shared_email"),
        F.col("_first.source_system").alias("source_1"),
        F.col("source_system").alias("source_2"),
        F.col("members").alias("group_size"),
    )


def loose_email_rows(frames: Frames) -> DataFrame:
    """The pattern form of the e-mail rule: shape by LIKE, blanks and length."""
    bad = "email_address NOT LIKE '%@%.%' OR email_address LIKE '% %' OR length(rtrim(email_address)) < 6"
    return frames["customers"].filter(bad).selectExpr(
        "'V-005' AS rule_code",
        "'MEDIUM' AS severity",
        "customer_id",
        "customer_name",
        "email_address",
        "'Invalid email format' AS violation_detail",
    )


LISTINGS: dict[str, Callable[[Frames], DataFrame]] = {
    "u_001": duplicate_customers,
    "u_002": duplicate_emails,
    "u_003": duplicate_work_orders,
    "u_004": duplicate_invoices,
    "u_005": duplicate_assignments,
    "u_006": duplicate_employee_numbers,
    "r_001": orphan_work_orders,
    "r_002": orphan_invoices,
    "r_003": orphan_assignments,
    "r_004": orphan_technicians,
    "r_005": orphan_billed_customers,
    "cs_007": terminated_on_open_rows,
    "br_001": unassigned_orders,
    "br_002": unbilled_orders,
}


def violations(frames: Frames, key: str, as_of: dt.date) -> DataFrame:
    """What fails rule ``key``: rows, or groups for the uniqueness rules."""
    rule = BY_KEY[key]
    if isinstance(rule, RowRule):
        return violating_rows(frames[rule.table], rule, as_of)
    return LISTINGS[key](frames)
