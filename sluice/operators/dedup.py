"""Deduplication: ranks, winners, duplicate flags and master keys.

A key may hold a large share of all rows (a missing or placeholder e-mail), so
nothing here sorts one key's rows in a single task:

* a winner per key comes from ``row_number() = 1``, which Spark limits to one
  row per key and task before the shuffle (window group limit);
* flags go back to the rows by their unique row id, which spreads evenly;
* full ranks are built from range partitions, which split a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import case, instant, lower_trim, quoted
from ..sources.tables import shared_dir
from .joins import attach


def newest_first(name: str | Column) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return column.desc_nulls_last()


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order; end the order in a unique column."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rn") -> DataFrame:
    """``row_number()`` per key without a task per key.

    Rows are range-partitioned by key and order, so a key with many rows spans
    several partitions.  A row's rank is its position in its partition's run of
    the key plus the lengths of the key's earlier runs.  A key continues across
    a partition border at most once per border, so the carried lengths number
    fewer rows than there are partitions and can be broadcast.

    The partitioned rows are checkpointed, because both the lengths and the
    ranks must see the same borders.  Pass narrow rows.  The order must end in
    a unique column.
    """
    shared_dir(df.sparkSession)
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_at", 33))
    )
    run = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_carry", F.sum("_n").over(run))
        .filter(F.col("_carry") > 0)
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), "_carry")
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_at"))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(carried), same, "left")
        .select(*df.columns, (F.col("_inside") + F.coalesce("_carry", F.lit(0))).cast("bigint").alias(name))
    )


def email_keys(customers: DataFrame, row_id: str) -> DataFrame:
    return customers.selectExpr(
        f"{lower_trim('email_address')} AS email_key", f"{instant('last_modified')} AS modified", row_id
    )


def extract_order(row_id: str = "_src_row") -> list[Column]:
    return [newest_first("_extract_timestamp"), F.col(row_id).asc()]


def rank_by_email(customers: DataFrame, row_id: str = "_src_row") -> DataFrame:
    """Rank within the normalised e-mail, latest change first; missing e-mails form one group."""
    order = [newest_first("modified"), F.col(row_id).asc()]
    return ranked(email_keys(customers, row_id), ["email_key"], order, "rn_email").select(row_id, "email_key", "rn_email")


def rank_by_id(customers: DataFrame, row_id: str = "_src_row") -> DataFrame:
    """Rank within customer_id, latest extract first."""
    narrow = customers.select("customer_id", "_extract_timestamp", row_id)
    return ranked(narrow, ["customer_id"], extract_order(row_id), "rn_id").select(row_id, "customer_id", "rn_id")


def with_duplicate_flags(
    customers: DataFrame, row_id: str = "_src_row", null_keys_are_distinct: bool = False
) -> DataFrame:
    """Add ``is_email_duplicate``, ``is_id_duplicate`` and ``is_duplicate``.

    A row is a duplicate when another row of the same normalised e-mail, or of
    the same customer_id, comes first.  All missing e-mails count as one e-mail
    unless ``null_keys_are_distinct``.
    """
    # one narrow scan for both keys: a row stands once for each, with the time that orders it
    email = f"{lower_trim('email_address')}"
    by_email = f"named_struct('kind', 'e', 'key', {email}, 'at', {instant('last_modified')}, 'extracted', CAST(NULL AS timestamp))"
    by_id = "named_struct('kind', 'i', 'key', customer_id, 'at', CAST(NULL AS timestamp_ntz), 'extracted', CAST(_extract_timestamp AS timestamp))"
    keyed = customers.selectExpr(row_id, f"inline(array({by_email}, {by_id}))")
    if null_keys_are_distinct:
        keyed = keyed.filter("kind = 'i' OR key IS NOT NULL")
    order = [newest_first("at"), newest_first("extracted"), F.col(row_id).asc()]
    firsts = (
        keep_latest(keyed, ["kind", "key"], order)
        .groupBy(row_id)
        .agg(F.max(F.expr("if(kind = 'e', 1, 0)")).alias("_e"), F.max(F.expr("if(kind = 'i', 1, 0)")).alias("_i"))
    )
    is_first = F.coalesce("_e", F.lit(0)) == 1
    if null_keys_are_distinct:
        is_first = is_first | F.col("email_address").isNull()
    not_first_id = F.coalesce("_i", F.lit(0)) == 0
    return (
        customers.join(firsts, row_id, "left")
        .select(
            *customers.columns, (~is_first).alias("is_email_duplicate"), not_first_id.alias("is_id_duplicate")
        )
        .withColumn("is_duplicate", F.col("is_email_duplicate") | F.col("is_id_duplicate"))
    )


DUPLICATE_REASON = case(
    [
        ("is_id_duplicate", quoted("Duplicate customer_id — lower priority retained")),
        ("is_email_duplicate", quoted("Duplicate email address — older record")),
    ]
)


def other_ids_by_email(customers: DataFrame) -> DataFrame:
    """The two smallest customer ids of every e-mail that has at least two."""
    ids = customers.select(F.lower(F.rtrim("email_address")).alias("email_key"), "customer_id")
    ids = ids.filter(F.col("email_key").isNotNull() & F.col("customer_id").isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy("email_key").orderBy("customer_id"))
    two = ids.withColumn("_place", place).filter(F.col("_place") <= 2)
    return (
        two.groupBy("email_key")
        .agg(F.min("customer_id").alias("first_id"), F.max("customer_id").alias("second_id"))
        .filter(F.col("first_id") != F.col("second_id"))
    )


def with_master_key(
    flagged: DataFrame, customers: DataFrame, name: str = "duplicate_of_key", row_id: str = "_src_row"
) -> DataFrame:
    """For duplicates, the smallest other customer_id with the same e-mail."""
    masters = other_ids_by_email(customers).selectExpr("true AS wanted", "*")
    # rows that look for nothing get a key of their own, so that they do not pile up under one
    wanted = "(is_duplicate AND email_address IS NOT NULL)"
    keyed = flagged.selectExpr(
        "*",
        f"{wanted} AS wanted",
        f"if({wanted}, lower(rtrim(email_address)), CAST({row_id} AS string)) AS email_key",
    )
    other = "if(first_id <> customer_id, first_id, second_id)"
    return attach(keyed, masters, ["wanted", "email_key"]).selectExpr(*flagged.columns, f"{other} AS {name}")
