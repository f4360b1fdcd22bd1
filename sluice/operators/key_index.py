"""A table of keys and what is known of each, kept sorted in buckets, so that a new batch meets history where it lies.

History is not shuffled: the batch is reduced to one row per key, dealt out
into the buckets of the index and joined to them.  The merged rows are written
to the same buckets, as a new version of the index that names the batches in
it; a batch that is in it adds nothing when it is repeated.

One task writes one bucket, so there are as many as hold ``KEYS_A_BUCKET`` keys
each, and at first twice as many.  An index that outgrows its buckets gets at
least twice as many and is dealt out anew, once for each doubling.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import Version, VersionedTable

#: how the values of a key are added up over batches
MERGES = {
    "sum": lambda old, new: F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)),
    "min": lambda old, new: F.least(old, new),
    "max": lambda old, new: F.greatest(old, new),
}
KEY = "_key"
#: keys that one task sorts and writes, about
KEYS_A_BUCKET = 1_000_000


class KeyIndex:
    """``keys`` name the key columns, ``values`` the value columns and how each is merged: sum, min or max.

    A batch is a frame of one row per key, in which null keys are keys like any other.  There are ``buckets`` buckets,
    or more if the keys ask for them.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], values: Mapping[str, str], buckets: int = 64):
        self.spark, self.keys, self.values, self.buckets = spark, tuple(keys), dict(values), buckets
        self.table = VersionedTable(spark, path)

    def batches(self) -> tuple[str, ...]:
        return self.table.version().notes if self.table.exists() else ()

    def read(self) -> DataFrame:
        """All keys; the plan knows the buckets."""
        version = self.table.version()
        return self.spark.table(self._registered(version.folders[0], version.schema, version.buckets or self.buckets))

    def _registered(self, folder: str, schema: T.StructType, buckets: int) -> str:
        """The folder as a table of the session's catalog, where buckets can be declared; the files stay where they are."""
        path, name = f"{self.table.path}/{folder}", self._name(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def _name(self, folder: str) -> str:
        return "key_index_" + hashlib.sha256(f"{self.table.path}/{folder}".encode()).hexdigest()[:24]

    def _keyed(self, batch: DataFrame) -> DataFrame:
        return batch.select(_key_text(self.keys).alias(KEY), *self.keys, *self.values)

    def meet(self, batch: DataFrame, how: str = "inner") -> DataFrame:
        """The keys of a batch with their values in the batch and, named ``old_...``, in the index.

        ``inner`` gives those that were there before, ``left_anti`` the new ones.
        """
        old = self.read().select(F.col(KEY).alias("_old"), *[F.col(v).alias(f"old_{v}") for v in self.values])
        new = self._keyed(batch)
        return new.join(old, new[KEY] == old["_old"], how).drop(KEY, "_old")

    def _buckets_for(self, began: Version | None, most: int) -> int:
        """How many buckets hold the keys there are and up to ``most`` new ones."""
        if began is None:
            return max(self.buckets, math.ceil(2 * most / KEYS_A_BUCKET))  # room for as many again
        now = began.buckets or self.buckets
        asked = math.ceil((self.read().count() + most) / KEYS_A_BUCKET)
        return now if asked <= now else max(asked, 2 * now)

    def add(self, batch: DataFrame, name: str, most: int | None = None) -> None:
        """Merge a batch, once.  ``most`` says how many keys it has at most; without it they are counted."""
        if name in self.batches():
            return
        new = self._keyed(batch)
        began = self.table.version() if self.table.exists() else None
        buckets = self._buckets_for(began, new.count() if most is None else most)
        merged = new if began is None else self._merged(new)
        folder = self.table.new_folder()
        target = self._registered(folder, merged.schema, buckets)
        # one task per bucket writes one sorted file
        as_dealt = began and buckets == (began.buckets or self.buckets)
        (merged if as_dealt else merged.repartition(buckets, KEY)).write.insertInto(target)
        self.table.replace(folder, merged.schema, began, (*(began.notes if began else ()), name), buckets)
        if began:  # the catalog forgets the older version, whose files stay
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(began.folders[0])}")

    def _merged(self, new: DataFrame) -> DataFrame:
        old = self.read()
        both = old.select(F.col(KEY).alias("_old"), F.struct(*self.keys, *self.values).alias("o")).join(
            new.select(KEY, F.struct(*self.keys, *self.values).alias("n")), F.col("_old") == F.col(KEY), "full_outer"
        )
        there = F.col("_old").isNotNull()
        return both.select(
            F.coalesce("_old", KEY).alias(KEY),
            *[F.when(there, F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in self.keys],
            *[MERGES[how](F.col(f"o.{v}"), F.col(f"n.{v}")).alias(v) for v, how in self.values.items()],
        )


def _key_text(keys: Sequence[str]) -> Column:
    """One text per key, different for different keys and never null: each part with its length in front."""
    parts = []
    for k in keys:
        text = F.col(k).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)
