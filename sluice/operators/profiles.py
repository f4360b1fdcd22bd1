"""Keys that tie tables together, and what is counted for each key."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as d
from ..functions.columns import at, lower_trim, number, one_of, outside, upper_snake, upper_trim
from .rules import Frames, Measure, Profile

COMPLETED = one_of(upper_trim("status"), d.COMPLETED)
OPEN = outside(upper_snake("status"), d.CLOSED)
TERMINATED = f"{upper_snake('employment_status')} = 'TERMINATED'"

WORK_ORDER = Profile(
    "work_order",
    ("work_order_id",),
    {t: ("work_order_id",) for t in ("work_orders", "invoices", "assignments", "parts")},
    {
        "orders": Measure("work_orders"),
        "done": Measure("work_orders", COMPLETED),
        "done_paid": Measure("work_orders", f"{COMPLETED} AND {number('total_cost')} > 0"),
        "cancelled": Measure("work_orders", f"{upper_snake('status')} = 'CANCELLED'"),
        "not_active": Measure("work_orders", one_of(upper_snake("status"), ("CANCELLED", "ON_HOLD"))),
        "bills": Measure("invoices"),
        "tasks": Measure("assignments"),
        "active_tasks": Measure("assignments", f"{upper_trim('assignment_status')} = 'ACTIVE'"),
        "leads": Measure("assignments", f"{upper_trim('assignment_role')} = 'LEAD'"),
        "parts": Measure("parts"),
    },
)

CUSTOMER = Profile(
    "customer",
    ("customer_id",),
    {t: ("customer_id",) for t in ("customers", "work_orders", "invoices")},
    {
        "customers": Measure("customers"),
        "barred": Measure(
            "customers", one_of(upper_trim("account_status"), ("INACTIVE", "SUSPENDED", "TEMP SUSPEND"))
        ),
        "orders": Measure("work_orders"),
        "bills": Measure("invoices"),
    },
)

TECHNICIAN = Profile(
    "technician",
    ("technician_id",),
    {t: ("technician_id",) for t in ("technicians", "assignments", "certs")},
    {
        "technicians": Measure("technicians"),
        "terminated": Measure("technicians", TERMINATED),
        "active": Measure("technicians", one_of(upper_snake("employment_status"), ("ACTIVE", "ACTVE"))),
        "tasks": Measure("assignments"),
        "certs": Measure("certs"),
        "active_certs": Measure("certs", f"{upper_trim('cert_status')} = 'ACTIVE'"),
        "expired_certs": Measure("certs", f"{upper_trim('cert_status')} = 'EXPIRED'"),
    },
)

EMAIL = Profile(
    "email",
    ("email_key",),
    {"customers": (lower_trim("email_address"),)},
    {"customers": Measure("customers")},
)

EMAIL_UNTRIMMED = Profile(
    "email_untrimmed",
    ("email_key",),
    {"customers": ("lower(email_address)",)},
    {"customers": Measure("customers")},
)

EMPLOYEE = Profile(
    "employee",
    ("employee_number",),
    {"technicians": ("employee_number",)},
    {"technicians": Measure("technicians")},
)

TASK = Profile(
    "task",
    ("work_order_id", "technician_id"),
    {"assignments": ("work_order_id", "technician_id")},
    {"tasks": Measure("assignments")},
)

TECHNICIAN_NAME = Profile(
    "technician_name",
    ("name_key",),
    {"technicians": (upper_trim("full_name"),)},
    {"technicians": Measure("technicians")},
)

PART_LINE = Profile(
    "part_line",
    ("work_order_id", "part_number", "recorded_date"),
    {"parts": ("work_order_id", "part_number", "recorded_date")},
    {"parts": Measure("parts")},
)

CERT_LINE = Profile(
    "cert_line",
    ("technician_id", "certification_code"),
    {"certs": ("technician_id", "certification_code")},
    {"certs": Measure("certs")},
)


def key_profile(frames: Frames, profile: Profile, names: Sequence[str], as_of: dt.date) -> DataFrame:
    """Counts of the named measures for every key found in any table they read."""
    tables = defaultdict(list)
    for name in names:
        tables[profile.measures[name].table].append(name)
    parts = []
    for table, own in tables.items():
        scopes = [profile.measures[name].scope for name in own]
        hits = {name: "1" if scope is None else f"if({scope}, 1, 0)" for name, scope in zip(own, scopes)}
        keys = [f"{text} AS {key}" for text, key in zip(profile.key_of[table], profile.keys)]
        counted = [at(f"CAST({hits.get(name, '0')} AS bigint) AS {name}", as_of) for name in names]
        rows = frames[table]
        if None not in scopes:
            rows = rows.filter(at(" OR ".join(f"({scope})" for scope in scopes), as_of))
        parts.append(rows.selectExpr(*keys, *counted))
    stacked = reduce(DataFrame.unionAll, parts)
    return stacked.groupBy(*profile.keys).agg(*[F.sum(name).alias(name) for name in names])
