"""Shards by jump consistent hashing: the key and the number of shards decide, no table is kept.

Going from n to n + 1 shards moves 1 / (n + 1) of the keys, all into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, gapless, scattered, stage, whole_text

# fixed values of the method: multiplier of the generator, span of its upper bits
MULTIPLIER = 2862933555777941757
SPAN = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; every round moves the keys that still jump below ``shards``."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live, target = np.arange(len(state)), np.zeros(len(state), np.int64)
    while live.size:
        shard[live] = target
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        upper = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        target = ((target + 1) * (SPAN / upper)).astype(np.int64)
        still = target < shards
        live, target = live[still], target[still]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a long key."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return place(key)


def assign(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", rows_per_bucket: int = 20_000) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    Only the key and the number of shards decide the shard, so rows that repeat
    a key share it; a null key is a key like any other.  Slots number the rows of
    a shard from 0 without gaps, in no promised order.  A null text has size 1 and the
    checksum of the empty one.  Other columns are ignored.
    """
    hashed = F.xxhash64(F.col(key))
    buckets = buckets_for(df.count(), rows_per_bucket, 32, 8192)
    placed = stage(
        df.select(
            F.col(key).alias("key"),
            (F.octet_length(whole_text(text)).cast("long") + 1).alias("size"),
            F.crc32(whole_text(text).cast("binary")).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(hashed, shards).alias("shard"),
            shard_of(hashed, shards + 1).alias("grown_shard"),
            scattered(buckets).alias("bucket"),
        ),
        "shards",
    )
    numbered = gapless(placed, ["shard"], "bucket", ["key", "text_crc32"], "slot")
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", "law", "shard", "slot", "grown_shard")
