"""Standard values, coercion and repair (raw to staging)."""

from __future__ import annotations

from . import domains as d
from .columns import case, from_synonyms, instant, is_blank, number, one_of, upper_snake, upper_trim

UNKNOWN = "'UNKNOWN'"


def customer_status(c: str = "account_status", known_typos: bool = True, keep_raw: bool = False) -> str:
    """Synonyms to the four standard values, anything else passes through.

    ``known_typos`` maps the misspelt ACTIV; ``keep_raw`` passes unknown text
    unchanged instead of trimmed and upper-cased.
    """
    synonyms = dict(d.CUSTOMER_STATUS_SYNONYMS)
    if not known_typos:
        synonyms["ACTIVE"] = ("ACTIVE",)
    return from_synonyms(upper_trim(c), synonyms, c if keep_raw else upper_trim(c))


def customer_type(c: str = "customer_type") -> str:
    return from_synonyms(upper_trim(c), d.CUSTOMER_TYPE_SYNONYMS, UNKNOWN)


def work_order_status(c: str = "status") -> str:
    return from_synonyms(upper_snake(c), d.WORK_ORDER_STATUS_SYNONYMS, UNKNOWN)


def work_order_type(c: str = "work_order_type") -> str:
    return case([(one_of(f"upper({c})", d.WORK_ORDER_TYPE), f"upper({c})")], "'OTHER'")


def priority(c: str = "priority", checked: bool = False) -> str:
    """Upper-cased; ``checked`` drops values outside the domain."""
    value = upper_trim(c)
    return case([(one_of(value, d.PRIORITY), value)]) if checked else value


def technician_status(c: str = "employment_status") -> str:
    return from_synonyms(upper_snake(c), d.TECHNICIAN_STATUS_SYNONYMS, UNKNOWN)


def invoice_status(c: str = "invoice_status") -> str:
    return case([(one_of(upper_trim(c), d.INVOICE_STATUS), upper_trim(c))], UNKNOWN)


def bool_text(c: str) -> str:
    value = upper_trim(c)
    return case([(one_of(value, d.TRUE_TEXT), "true"), (one_of(value, d.FALSE_TEXT), "false")])


def full_name(c: str = "full_name", first: str = "first_name", last: str = "last_name") -> str:
    return case([(is_blank(c), f"concat_ws(' ', trim({first}), trim({last}))")], f"trim({c})")


def zip5(c: str = "billing_zip") -> str:
    return f"substring(trim({c}), 1, 5)"


def end_not_before(start: str, end: str) -> str:
    """The end, or null when it lies before the start."""
    return case([(f"{instant(end)} < {instant(start)}", "NULL")], instant(end))


def in_range(c: str, low: float | None = None, high: float | None = None, money: str = "double") -> str:
    """The parsed number, or null outside the range."""
    value = number(c, money)
    cases = []
    if low is not None:
        cases.append((f"{value} < {low}", "NULL"))
    if high is not None:
        cases.append((f"{value} > {high}", "NULL"))
    return case(cases, value) if cases else value
