"""Sources: named tables, text-typed schemas and batch stamping."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import instant_literal
from .dirty_views import VIEWS


def read_table(spark: SparkSession, name: str, directory: str | None = None) -> DataFrame:
    """A catalog table, or ``<directory>/<name>.parquet`` when a directory is given."""
    if directory is None:
        return spark.table(name)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def dirty_view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    text, source = VIEWS[name]
    return spark.sql(text, **{source: read_table(spark, source, directory)})


class Raw:
    """The raw layer of one directory; a table is bound when first asked for.

    ``all_batches`` appends the second extract to every table that has one.
    """

    def __init__(self, spark: SparkSession, directory: str, all_batches: bool = False):
        self.spark = spark
        self.directory = directory
        self.all_batches = all_batches
        self._bound: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._bound:
            names = [f"raw_{table}"]
            if self.all_batches and f"raw_{table}_batch2" in VIEWS:
                names.append(f"raw_{table}_batch2")
            self._bound[table] = append_batches(*[dirty_view(self.spark, self.directory, n) for n in names])
        return self._bound[table]

    def with_later_batches(self) -> Raw:
        return Raw(self.spark, self.directory, all_batches=True)


def append_batches(first: DataFrame, *later: DataFrame) -> DataFrame:
    """Several extracts of one table, one below the other."""
    for batch in later:
        first = first.unionByName(batch)
    return first


def text_schema(columns: Iterable[str]) -> T.StructType:
    """All columns as strings, plus when and in which batch they were extracted."""
    fields = [T.StructField(c, T.StringType()) for c in columns]
    fields.append(T.StructField("_extract_timestamp", T.TimestampType()))
    fields.append(T.StructField("_batch_id", T.StringType()))
    return T.StructType(fields)


def literal_rows(
    spark: SparkSession,
    rows: Sequence[tuple],
    columns: Sequence[str],
    extracted: dt.datetime,
    batch_id: str,
) -> DataFrame:
    """Hand-written rows as a raw table; for fixtures, not for data."""
    stamped = [tuple(row) + (extracted, batch_id) for row in rows]
    return spark.createDataFrame(stamped, text_schema(columns))


def stamp_batch(df: DataFrame, extracted: dt.datetime, batch_id: str) -> DataFrame:
    """Mark every row with its extract time and batch."""
    return df.withColumns({"_extract_timestamp": F.expr(instant_literal(extracted)), "_batch_id": F.lit(batch_id)})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string, so that no value can be rejected on load."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local["):  # one process, whose own disk is shared by all it runs
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="sluice-shared-")
        remove_at_end(spark, named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def remove_at_end(spark: SparkSession, path: str) -> str:
    """Spark removes the folder when its driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, for as long as the driver lives."""
    return remove_at_end(spark, f"{shared_dir(spark).rstrip('/')}/sluice/{label}-{uuid.uuid4().hex}")
