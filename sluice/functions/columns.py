"""Expression text that reads dirty columns without ever raising.

Expressions are SQL text, for ``selectExpr``, ``filter`` and ``expr``: a rule
can then be stored and shown as it is evaluated, and a projection of dozens of
columns reaches the optimizer in one call.

ANSI mode turns a failed ``cast`` into an error; dirty text must become null
instead, so every parse here is a ``try_cast``.  Timestamps are read as wall
clock time (``timestamp_ntz``), so results do not depend on the session zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from . import domains as d

TODAY = ":as_of"


def at(text: str, as_of: dt.date) -> str:
    """Fix the clock of an expression."""
    return text.replace(TODAY, day_literal(as_of))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Iterable[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def instant_literal(value: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"


def day_literal(value: dt.date) -> str:
    return f"DATE'{value.isoformat()}'"


def upper_trim(c: str) -> str:
    return f"upper(trim({c}))"


def upper_snake(c: str) -> str:
    """Blanks become underscores before the trim, so outer blanks survive as ``_``."""
    return f"upper(trim(translate({c}, ' ', '_')))"


def lower_trim(c: str) -> str:
    return f"lower(trim({c}))"


def is_blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def number(c: str, money: str = "double") -> str:
    """A decimal takes no exponent; text that is too large for it does not parse either."""
    if money.startswith("decimal"):
        return f"if(contains(lower({c}), 'e'), NULL, try_cast({c} AS {money}))"
    return f"try_cast({c} AS {money})"


def day(c: str) -> str:
    return f"try_cast({c} AS date)"


def instant(c: str) -> str:
    return f"try_cast({c} AS timestamp_ntz)"


def hours_between(start: str, end: str) -> str:
    return f"timestampdiff(SECOND, {start}, {end}) / 3600"


def minutes_crossed(start: str, end: str) -> str:
    """Minute boundaries between two instants, as ``DATEDIFF(MINUTE, ...)`` counts them."""
    return f"timestampdiff(MINUTE, date_trunc('MINUTE', {start}), date_trunc('MINUTE', {end}))"


def one_of(value: str, domain: Iterable[str]) -> str:
    return f"{value} IN ({listed(domain)})"


def outside(value: str, domain: Iterable[str]) -> str:
    """Not in the domain; unknown for null."""
    return f"{value} NOT IN ({listed(domain)})"


def true_only(flag: str) -> str:
    """Unknown counts as false."""
    return f"coalesce({flag}, false)"


def any_true(*flags: str) -> str:
    return "(" + " OR ".join(true_only(flag) for flag in flags) + ")"


def case(cases: Iterable[tuple[str, str]], otherwise: str = "NULL") -> str:
    """Value of the first case whose condition holds."""
    branches = " ".join(f"WHEN {condition} THEN {value}" for condition, value in cases)
    return f"CASE {branches} ELSE {otherwise} END"


def from_synonyms(value: str, synonyms: Mapping[str, tuple[str, ...]], otherwise: str) -> str:
    return case([(one_of(value, words), quoted(standard)) for standard, words in synonyms.items()], otherwise)


def lookup(value: str, table: Mapping[str, str]) -> str:
    """Small fixed map; null when the value is not listed."""
    return case([(f"{value} = {quoted(key)}", quoted(found)) for key, found in table.items()])


def read_as_latin1(c: str) -> str:
    """The text whose UTF-8 bytes, read as Latin-1, give this one; null where no text does.

    A sound name may hold the same letters: its bytes are no UTF-8.
    """
    there = f"rlike({c}, {quoted(d.LATIN1_PATTERN)})"
    # other characters cannot be encoded; where one stands the condition has failed anyway
    read = f"CAST(encode(regexp_replace({c}, '[^\\\\x00-\\\\xFF]', '?'), 'ISO-8859-1') AS string)"
    return f"if({there}, try_validate_utf8({read}), NULL)"


def tagged(prefix: str, value: str) -> str:
    return f"concat({quoted(prefix + ' [')}, {value}, ']')"


def named(expressions: Mapping[str, str]) -> list[str]:
    """``text AS name`` for a whole projection."""
    return [text if text == name else f"{text} AS {name}" for name, text in expressions.items()]
