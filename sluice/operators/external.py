"""The compact suite of 25 rules an outside client runs.

Most rules are those of the standard suite; the few below differ in what they
count.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame

from ..functions import domains as d
from . import profiles as p
from .catalog import BY_KEY, days_since, is_value, negative, repeated_keys
from .evaluate import rule_counts, with_outcome
from .rules import Frames

CODES = (
    "c_001", "c_002", "c_003", "c_005",
    "u_001", "u_002", "u_003", "u_004",
    "v_001", "v_003", "v_006", "v_007", "v_010",
    "r_001", "r_002", "r_003", "r_004",
    "cs_001", "cs_004", "cs_005", "cs_009",
    "t_001", "t_002", "t_003", "t_005",
)


def not_distinct(measure: str, key: str) -> str:
    """Records beyond the distinct non-null keys, so records without a key count."""
    return f"if({measure} > 0, if({key} IS NULL, {measure}, {measure} - 1), 0)"


OVERRIDES = {
    "u_001": {"failed": not_distinct("customers", "customer_id")},
    "u_002": {"profile": p.EMAIL_UNTRIMMED, "failed": repeated_keys("customers", "email_key")},
    "u_003": {"failed": not_distinct("orders", "work_order_id")},
    "v_006": {"fails": negative("labor_cost", "parts_cost")},
    "v_007": {"fails": negative("subtotal", "total_amount")},
    "t_005": {
        "fails": f"{is_value('status', 'IN_PROGRESS')} AND {days_since('last_modified')} > {d.STALE_WORK_DAYS}"
    },
}

EXTERNAL_RULES = tuple(replace(BY_KEY[key], **OVERRIDES.get(key, {})) for key in CODES)


def evaluate_external(frames: Frames, as_of: dt.date, text: str | None = None) -> DataFrame:
    """Pass rates to one decimal and the short label WARN; ``text`` filters by table."""
    rules = [r for r in EXTERNAL_RULES if text is None or text in r.target]
    return with_outcome(rule_counts(frames, rules, as_of), digits=1, warning="WARN")
