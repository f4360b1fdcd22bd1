"""Sinks: full refresh, append, insert-if-absent, runs as partitions, and export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import attach, per_key_keys
from .versions import VersionedTable


#: rows of a single-file export at most
EXPORTED = 100_000


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the table and return it as written, so later steps do not recompute it.

    Until the new rows are whole readers find the old ones, also if the run is lost.
    """
    return VersionedTable(df.sparkSession, path).write(df)


def overwrite_counted(df: DataFrame, path: str, counts: Mapping[str, str]) -> tuple[DataFrame, dict[str, int]]:
    """As ``overwrite``, with aggregates over the rows that are observed while they are written.

    They are taken in the tasks that write the files, of which each counts once, however often it is tried.
    """
    seen = Observation()
    table = overwrite(df.observe(seen, *[F.expr(text).alias(name) for name, text in counts.items()]), path)
    return table, {name: value or 0 for name, value in seen.get.items()}


def append(df: DataFrame, path: str) -> DataFrame:
    return VersionedTable(df.sparkSession, path).write(df, append=True)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or an earlier one."""
    return VersionedTable(spark, path).read(version)


def exists(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).exists()


def replace_run(df: DataFrame, path: str, run: str = "run_id") -> DataFrame:
    """Store what a run adds as a partition of its own; a repeated or corrected run replaces its rows.

    Partitions of other runs are neither read nor written.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def absent_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return attach(df, per_key_keys(target, *keys), keys, "left_anti")


def insert_if_absent(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Append only the rows whose key is new."""
    return append(absent_rows(df, read(df.sparkSession, path), keys), path)


def export_csv(results: DataFrame, path: str) -> DataFrame:
    """One CSV file with a header.

    Meant for rule results, whose size is the number of rules; the exchange
    keeps the work above it parallel.  Anything larger is refused.
    """
    if results.limit(EXPORTED + 1).count() > EXPORTED:
        raise ValueError(f"more than {EXPORTED} rows do not go to one file")
    results.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return results.sparkSession.read.schema(results.schema).option("header", True).csv(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and, in the row ``(all tables)``, their sum."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionAll(one)
    total = F.coalesce(F.col("table_name"), F.lit("(all tables)"))
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        total.alias("table_name"), "row_count"
    )
