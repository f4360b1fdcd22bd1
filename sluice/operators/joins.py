"""Joins to a frame with one row per key, for child keys that may be hot.

A key can hold a large share of the child rows.  Spark splits such a partition
at run time, but only where both inputs of the join come straight out of an
exchange.  A frame that was just aggregated by the key is already partitioned
by it, gets no exchange, and so rules the split out.  Joining on a digest of
the key next to the key itself asks for a fresh exchange of the (small) keyed
side and keeps the large side splittable.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_key_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Every key once; hot keys are reduced in each task before they move."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.select(*keys).filter(known).distinct()


def attach(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join ``rows`` to ``per_key``, which holds at most one row per key."""
    renamed = [f"_key_{k}" for k in keys]
    others = [c for c in per_key.columns if c not in keys]
    right = per_key.select(
        F.xxhash64(*keys).alias("_key_digest"), *[F.col(k).alias(r) for k, r in zip(keys, renamed)], *others
    )
    same = F.xxhash64(*[rows[k] for k in keys]) == right["_key_digest"]
    for k, r in zip(keys, renamed):
        same = same & (rows[k].eqNullSafe(right[r]) if null_safe else rows[k] == right[r])
    joined = rows.join(right, same, how)
    return joined if how in ("left_anti", "left_semi") else joined.select(*rows.columns, *others)


#: rows of a keyed frame that is broadcast, at most: a key and a few narrow columns each
BROADCAST_ROWS = 100_000


def attach_measured(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left", most: int = BROADCAST_ROWS
) -> DataFrame:
    """As ``attach``, but a keyed frame that is counted and found small is broadcast, so the rows do not move."""
    if per_key.limit(most + 1).count() > most:
        return attach(rows, per_key, keys, how)
    return rows.join(F.broadcast(per_key), list(keys), how)
