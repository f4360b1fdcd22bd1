"""Append new extract files to a raw table, each exactly once.

The batch form of the same step is ``sources.sinks.append``; this one keeps
track of the files it has loaded, so it can be run again after every extract
or after a failure.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.tables import as_text, stamp_batch


def append_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    batch_id: str,
    extracted: dt.datetime,
) -> None:
    """Load the files of ``source`` not loaded before, as text, stamped with the batch.

    ``checkpoint`` belongs on the shared folder.
    """
    new = spark.readStream.schema(schema).parquet(source)
    load = (
        stamp_batch(as_text(new), extracted, batch_id)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    load.awaitTermination()
