"""Surrogate keys in one pass, without a single-task window, that stay once they are given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach

#: bits of a key for the place inside its bucket
PLACE_BITS = 40


def key_digits(rows: int, per_bucket: int = 1_000_000) -> int:
    """Digits with which a bucket holds about ``per_bucket`` of so many rows; 3 at least."""
    digits = 3
    while rows > per_bucket * 16**digits:
        digits += 1
    return digits


def surrogate_key(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    digits: int = 3,
    known: DataFrame | None = None,
    after: DataFrame | None = None,
) -> DataFrame:
    """Give each row a number, from the unique ``keys`` of the rows.

    The first ``digits`` hex digits of the key's digest name one of ``16 **
    digits`` buckets, which are even whatever the keys look like; callers with
    more rows choose more digits (see ``key_digits``).  A number is the bucket,
    shifted, plus the row's place in the order of the digests of its bucket.
    The rows are read once and nothing is counted first, so numbers are unique
    but have gaps.

    ``known`` holds keys with the number given to them before.  They keep it;
    new keys are numbered after the last place of their bucket.  Without it the
    numbers depend on the whole set of keys, and a lost task repeats them exactly.
    ``after`` holds numbers that are taken (only that column is read) where all
    rows are known to be new.
    """
    columns = [name, *df.columns]
    if known is not None:
        rows = attach(df, known.select(*keys, name), keys, null_safe=True)
        new = rows.filter(F.col(name).isNull()).drop(name)
        numbered = surrogate_key(new, keys, name, digits, after=known)
        return rows.filter(F.col(name).isNotNull()).select(*columns).unionByName(numbered)
    digest = F.md5(F.concat_ws("|", *keys))
    marked = df.withColumns({"_d": digest, "_b": F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")})
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_d", *keys)).cast("long")
    if after is not None:
        low = F.col(name).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        last = after.groupBy(F.shiftright(name, PLACE_BITS).alias("_b")).agg(F.max(low).alias("_last"))
        marked = attach(marked.withColumn("_place", place), last, ["_b"])
        place = F.col("_place") + F.coalesce(F.col("_last"), F.lit(0))
    return marked.withColumn(name, F.shiftleft(F.col("_b"), PLACE_BITS) + place).select(*columns)
