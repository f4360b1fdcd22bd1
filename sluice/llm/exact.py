"""Exact deduplication by two passes over a Bloom filter.

The first pass counts 64-bit hashes: equal ones are added up in each task, and
one number per hash moves, never a row.  Hashes that occur twice or more make up
the filter, so its size follows the repeated texts and not the rows.  It is
split by the upper bits of the hash into as many parts as it needs, each of them
bounded, and rows are tested part by part.  The second pass tests each row where
it is: one whose hash is not in the filter has no equal and passes straight
through.  The others are compared by their SHA-256.  The filter decides only who
is compared, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from .common import free_name, stage, whole_text

PROBES = 3
BITS_PER_HASH = 16
#: bytes of one part of the filter, which is broadcast
FILTER_BYTES = 32 << 20


def repeated_hashes(hashes: DataFrame, column: str) -> DataFrame:
    """hash: those that stand on two rows or more; a hash that any number of rows have moves once per task."""
    counted = hashes.select(F.col(column).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter("rows > 1").select("hash")


def parts_and_bits(repeated: int, most_bytes: int) -> tuple[int, int]:
    """How many parts the filter has, and bits of each: a power of two, 1,024 at least."""
    parts = max(1, -(-repeated * BITS_PER_HASH // (8 * most_bytes)))
    wanted = -(-repeated // parts) * BITS_PER_HASH
    return parts, min(1 << max(10, (max(wanted, 1) - 1).bit_length()), 8 * most_bytes)


def part_of(column: str, parts: int) -> Column:
    return F.pmod(F.shiftrightunsigned(column, 33), F.lit(parts)).cast("int")


def positions(column: str, bits: int) -> list[Column]:
    return [F.xxhash64(column, F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def filter_words(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter of hashes as 64-bit words, put together by Spark; ``bits`` bounds what is collected."""
    found = (
        hashes.select(F.explode(F.array(*positions(column, bits))).alias("position"))
        .groupBy(F.shiftright("position", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(position & 63 as int)))").alias("mask"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy()
    return words


class RepeatFilter:
    """The Bloom filter over hashes that repeat.  Making it runs the first pass."""

    def __init__(self, hashes: DataFrame, column: str, most_bytes: int = FILTER_BYTES):
        if most_bytes & (most_bytes - 1):
            raise ValueError("the bytes of a part are a power of two")
        self.column = column
        self.repeated = stage(repeated_hashes(hashes, column), "repeated-hashes")
        self.parts, self.bits = parts_and_bits(self.repeated.count(), most_bytes)

    def _words(self, part: int) -> np.ndarray:
        return filter_words(self.repeated.filter(part_of("hash", self.parts) == part), "hash", self.bits)

    def tested(self, rows: DataFrame, name: str) -> Iterator[DataFrame]:
        """The rows of each part, with a column that is true for those that have an equal, and for a few others."""
        for part in range(self.parts):
            all_set = tester(rows.sparkSession.sparkContext.broadcast(self._words(part)))
            own = rows if self.parts == 1 else rows.filter(part_of(self.column, self.parts) == part)
            yield own.withColumn(name, all_set(*positions(self.column, self.bits)))


def tester(words: Broadcast):
    """A function of ``PROBES`` positions: whether the filter has them all."""

    @F.pandas_udf("boolean")
    def all_set(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        hit = np.ones(len(a), bool)
        for p in (a.to_numpy(), b.to_numpy(), c.to_numpy()):
            hit &= (words.value[p >> 6] >> (p & 63)) & 1 == 1
        return pd.Series(hit)

    return all_set


def groups_of_equals(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", most_bytes: int = FILTER_BYTES
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; a null id is smaller than
    any other, and of rows that repeat the id too exactly one stays.  A null
    text equals the empty one.  Other columns are ignored; an empty table gives
    an empty result.
    """
    digests = stage(
        df.select(
            F.col(id_col).alias("id"),
            F.sha2(whole_text(text), 256).alias("sha"),
            F.xxhash64(whole_text(text)).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-digests",
    )
    marked = reduce(DataFrame.unionByName, RepeatFilter(digests, "hash", most_bytes).tested(digests, "maybe"))
    alone = marked.filter("NOT maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept"), "sha")
    groups = (
        marked.filter("maybe")
        .groupBy("sha")
        .agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        .select("sha", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "n")
    )
    compared = attach(marked.filter("maybe"), groups, ["sha"], "inner").select(
        "id", "keep_id", "n", (F.col("row") == F.col("keep_row")).alias("kept"), "sha"
    )
    return alone.unionByName(compared).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        "kept",
        F.col("sha").alias("text_sha256"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", most_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that pass the filter keep their task; of the others each task first
    keeps one row per text, then those rows meet.
    """
    columns = df.columns
    flag, sha, at, code = (free_name(df, n) for n in ("_maybe", "_sha", "_at", "_hash"))
    coded = df.withColumn(code, F.xxhash64(whole_text(text)))
    marked = reduce(DataFrame.unionByName, RepeatFilter(coded, code, most_bytes).tested(coded, flag))
    winner = F.max_by(F.struct(*[F.col(c) for c in columns]), F.struct(F.col(id_col), F.col(at)))
    compared = (
        marked.filter(F.col(flag))
        .withColumns({sha: F.sha2(whole_text(text), 256), at: F.monotonically_increasing_id()})
        .groupBy(sha)
        .agg(winner.alias(flag))
        .select(f"{flag}.*")
    )
    return marked.filter(~F.col(flag)).select(*columns).unionByName(compared)
