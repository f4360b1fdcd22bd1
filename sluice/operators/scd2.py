"""Slowly changing dimension, type 2."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_literal
from ..sources.tables import scratch_path
from ..sources.versions import VersionedTable, bucket_of
from .joins import attach
from .keys import surrogate_key


def refuse_repeats(incoming: DataFrame, key: str) -> DataFrame:
    """The rows, one per key; a key that comes twice stops the merge when it runs."""
    row = F.struct(*incoming.columns)
    once = incoming.groupBy(key).agg(F.first(row).alias("_new"), F.count(F.lit(1)).alias("_n"))
    refusal = F.raise_error(F.concat(F.lit("comes more than once: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    # the error has a type of its own, so it is told apart by the condition alone
    return once.withColumn("_new", F.when(F.col("_n") == 1, F.col("_new")).otherwise(refusal)).select("_new.*")


def opened_versions(
    current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], columns: DataFrame, effective: dt.date
) -> DataFrame:
    """The versions that an extract opens: keys that are new, and keys whose tracked values changed.

    ``current`` has one row per key; a null key is a key like any other.  ``columns`` is a frame with the columns and
    types of the dimension; what the extract does not bring is null.
    """
    old = current.select(key, F.struct(*tracked).alias("_old"))
    met = attach(refuse_repeats(incoming, key), old, [key], null_safe=True)
    changed = F.col("_old").isNull() | ~F.struct(*tracked).eqNullSafe(F.col("_old"))
    fixed = {
        "effective_from": F.expr(day_literal(effective)),
        "effective_to": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    }

    def value(name: str, kind: str) -> Column:
        given = F.col(name) if name in incoming.columns else F.lit(None)
        return fixed.get(name, given).cast(kind).alias(name)

    return met.filter(changed).select(*[value(f.name, f.dataType.simpleString()) for f in columns.schema])


def with_closed(rows: DataFrame, opened: DataFrame, key: str, effective: dt.date) -> DataFrame:
    """Rows of the dimension, of which current ones end where their key opens a version."""
    met = attach(rows, opened.select(key, F.lit(True).alias("_opens")), [key], null_safe=True)
    ends = F.col("is_current") & F.col("_opens").isNotNull()
    closed = {
        "effective_to": F.when(ends, F.expr(day_literal(effective))).otherwise(F.col("effective_to")),
        "is_current": F.col("is_current") & ~ends,
    }
    return met.withColumns(closed).select(*rows.columns)


def scd2_merge(
    dimension: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: dt.date,
    surrogate: str | None = None,
) -> DataFrame:
    """Merge an extract into a dimension with ``effective_from/effective_to/is_current``.

    A changed key closes its current row and opens a new one, a new key opens
    one, a key missing from the extract stays as it is, and history rows pass
    through.  ``incoming`` has one row per key; a repeated one is refused.
    Versions keep their ``surrogate`` key, and the opened ones get new ones
    behind them.  ``merge_into`` does the same to a stored dimension.
    """
    bare = dimension if surrogate is None else dimension.drop(surrogate)
    opened = opened_versions(bare.filter("is_current"), incoming, key, tracked, bare, effective)
    kept = with_closed(dimension, opened, key, effective)
    if surrogate is not None:
        opened = surrogate_key(opened, [key, "effective_from"], surrogate, after=dimension)
    return kept.unionByName(opened)


def merge_into(
    table: VersionedTable,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: dt.date,
    surrogate: str | None = None,
) -> DataFrame:
    """Merge an extract into a dimension that is stored in buckets of its key.

    The opened versions are written aside once.  Only buckets that hold a key of them are read whole and written anew;
    files of all others stay, and nothing is written if nothing changed.  New surrogate keys follow the last ones of
    the whole dimension, of which that column alone is read.
    """
    spark = incoming.sparkSession
    now = table.read()
    bare = now if surrogate is None else now.drop(surrogate)
    opened = opened_versions(bare.filter("is_current"), incoming, key, tracked, bare, effective)
    opened = VersionedTable(spark, scratch_path(spark, "opened")).write(opened)
    buckets = opened.select(bucket_of([key], table.version().buckets).alias("b")).distinct()
    numbers = [r["b"] for r in buckets.collect()]  # as many as the dimension has buckets, at most
    if not numbers:
        return now
    kept = with_closed(table.read_buckets(numbers), opened, key, effective)
    if surrogate is not None:
        opened = surrogate_key(opened, [key, "effective_from"], surrogate, after=now.select(surrogate))
    return table.merge_buckets(kept.unionByName(opened), [key], numbers)
