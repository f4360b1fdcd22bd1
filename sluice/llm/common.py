"""What the operators share: staging, free column names, gapless numbering, slices of batches."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import scratch_path

_SHIPPED: set[str] = set()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor repeats only what follows, and a
    row number given before the write stays.  Spark removes the folder when
    its driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _drop_at_end(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="sluice-code-")  # on the driver, from where executors fetch it at any time
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder, f"{root.name}-{context.applicationId}.zip")
    with zipfile.ZipFile(path, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def whole_text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def buckets_for(rows: int, per_bucket: int, least: int, most: int) -> int:
    return max(least, min(most, -(-rows // per_bucket)))


def scattered(buckets: int) -> Column:
    """A bucket number that no value of the row decides, so no hot key can fill one.

    Only for rows that are staged next: the number must not be made twice.
    """
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int")


def gapless(staged: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without bringing a group to one task.

    Rows are numbered inside their (group, bucket) and shifted by the counts of
    the buckets before it.  ``staged`` is read twice, so it must be a table.
    """
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        staged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = staged.withColumn("_inside", inside)
    same = [numbered[k].eqNullSafe(shift[f"_s_{k}"]) for k in keys]
    return numbered.join(shift, same).select(
        *[numbered[c] for c in staged.columns], (F.col("_shift") + F.col("_inside") - 1).alias(name)
    )


#: what separates words of bytes; `bytes.split` takes the same
ASCII_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def word_runs(data: bytes, size: int = 2 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, cut out of slices that end at white space, so that a long text needs little memory."""
    at = 0
    while at < len(data):
        found = ASCII_SPACE.search(data, at + size) if at + size < len(data) else None
        end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


def slices(texts: Iterable[str], chars: int = 3_000_000) -> Iterator[list[str]]:
    """Runs of whole texts of about ``chars`` characters, so that a batch of long ones needs little memory."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
