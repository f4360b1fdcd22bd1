"""Rules as data.

A rule says which rows of its target table fail.  Four shapes exist:

``RowRule``
    a predicate on one row, counted over all rows or over a scope;
``KeyRule``
    a condition on the number of rows several tables hold for one key
    (duplicates, orphans, missing children);
``PairRule``
    the count of join rows between tables, computed from per-key counts;
``FrameRule``
    sums over rows that tables were reduced to, shared by several rules.

Conditions are SQL text.  ``:as_of`` in it stands for the day of the run, which
replaces the wall clock, so a run can be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Rule:
    code: str
    dimension: str
    table: str
    severity: str
    description: str
    column: str | None = field(default=None, kw_only=True)
    group: str | None = field(default=None, kw_only=True)

    @property
    def key(self) -> str:
        return self.code.lower().replace("-", "_")

    @property
    def target(self) -> str:
        return "raw." + TABLE_NAMES.get(self.table, self.table)


# frame name -> table name in the raw layer, where they differ
TABLE_NAMES = {
    "assignments": "work_order_assignments",
    "parts": "work_order_parts",
    "certs": "technician_certifications",
}


@dataclass(frozen=True)
class RowRule(Rule):
    fails: str = field(kw_only=True)
    scope: str | None = field(default=None, kw_only=True)
    # columns and named expressions of the listing of failing rows
    show: tuple[str, ...] = field(default=(), kw_only=True)
    detail: Mapping[str, str] = field(default_factory=dict, kw_only=True)
    # the listing keeps every row in scope and labels it, instead of the failing rows only
    lists_scope: bool = field(default=False, kw_only=True)


@dataclass(frozen=True)
class Measure:
    """Rows of ``table`` (those in ``scope``) counted per key."""

    table: str
    scope: str | None = None


@dataclass(frozen=True)
class Profile:
    """Per-key row counts over all tables that carry the key."""

    name: str
    keys: tuple[str, ...]
    key_of: Mapping[str, tuple[str, ...]]
    measures: Mapping[str, Measure]


@dataclass(frozen=True)
class KeyRule(Rule):
    """``failed`` maps the counts of one key to the number of failing records."""

    profile: Profile = field(kw_only=True)
    uses: tuple[str, ...] = field(kw_only=True)
    total: str = field(kw_only=True)
    failed: str = field(kw_only=True)


@dataclass(frozen=True)
class PairRule(Rule):
    """``counts`` yields one row ``(total_records, failed_records)``."""

    counts: Callable[[Frames, dt.date], DataFrame] = field(kw_only=True)
    # the counts may differ from day to day over the same tables
    daily: bool = field(default=True, kw_only=True)


@dataclass(frozen=True)
class FrameRule(Rule):
    """Sums over a frame made from several tables; rules with the same ``source`` share it."""

    source: Callable[[Frames], DataFrame] = field(kw_only=True)
    total: str = field(kw_only=True)
    failed: str = field(kw_only=True)
