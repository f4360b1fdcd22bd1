"""Near duplicates by SimHash.

Fingerprints that differ in at most d bits agree in s of d + s blocks of bits,
whichever bits differ.  For each choice of s blocks the fingerprints meet by
the bits of these blocks, and their distance is verified there.  s is the
smallest number with which the blocks hold as many bits as it takes to number
the fingerprints, so that strangers rarely meet.

Only distinct fingerprints take part.  Where many meet, they are dealt out anew
by blocks of the bits that are left, until few meet: nothing is skipped.  A meeting yields a spanning
forest of its links, never all pairs.  Stars of alternating size turn the links
into components, in steps of which each is written.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from .common import free_name, stage, whole_text, word_runs

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: fingerprints that meet in one place; more are dealt out anew
MEETING = 4096


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text over its word shingles, unsigned; 0 without words.  Long texts are read in slices."""
    ones, n, before = np.zeros(64, np.int64), 0, []
    for words in word_runs(text.encode().lower()):  # of bytes: A-Z, and white space of ASCII
        words = before + words
        ones += _ones(words, shingle, seed)
        n += max(0, len(words) - shingle + 1)
        before = words[max(0, len(words) - shingle + 1) :]
    if not n:  # fewer words than a shingle has: their whole sequence is one
        ones, n = _ones(before, len(before), seed), 1
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _ones(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """How many shingles of the words have each bit of their hash set."""
    ones = np.zeros(64, np.int64)
    if not words or len(words) < shingle:
        return ones
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = ends[shingle - 1 :]
    spans = list(zip((ends - lengths)[: len(last)].tolist(), last.tolist()))
    for low in range(0, len(spans), 65_536):
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], seed) for a, b in spans[low : low + 65_536]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return ones


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id, row, fingerprint (long) of each row of a table with id and row."""
    rows = df.select("id", "row", whole_text(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            columns = [batch["id"], batch["row"], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, row long, fingerprint long")


def masks(free: int, distance: int, shared: int) -> list[int]:
    """Masks of ``shared`` out of ``distance + shared`` even blocks of the bits in ``free``."""
    bits = [1 << i for i in range(64) if free >> i & 1]
    blocks = distance + shared
    edges = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    parts = [sum(bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(parts, shared)]


def shared_blocks(fingerprints: int, distance: int) -> int:
    needed = math.log2(max(fingerprints, 2)) + 1
    return next((s for s in range(1, 5) if 64 * s / (distance + s) >= needed), 4)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(values: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the links within ``distance`` connect: breadth first, each value found once."""
    links, rest = [], values
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            many = max(1, 1_000_000 // len(rest))
            now, front = front[:many], front[many:]
            near = np.bitwise_count(now[:, None] ^ rest[None, :]) <= distance
            hit = near.any(axis=0)
            if hit.any():
                found = rest[hit]
                links.append((now[near[:, hit].argmax(axis=0)], found))
                front, rest = np.concatenate([front, found]), rest[~hit]
    return links


def links(distinct: DataFrame, distance: int, meeting: int = MEETING) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all that are within ``distance``."""
    every = (1 << 64) - 1
    dealt = masks(every, distance, shared_blocks(distinct.count(), distance))
    met = _deal(distinct.withColumn("mask", F.lit(0).cast("long")), {0: dealt})
    found = None
    while True:
        crowds = stage(
            met.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > meeting).select("mask", "key"),
            "simhash-crowds",
        )
        crowded = [r["mask"] for r in crowds.select("mask").distinct().collect()]  # as many as choices of blocks at most
        here = met if not crowded else attach(met, crowds.withColumn("crowd", F.lit(True)), ["mask", "key"])
        small = here if not crowded else here.filter("crowd IS NULL")
        some = _meet(small, distance)
        found = some if found is None else found.unionByName(some)
        if not crowded:
            return found.distinct()
        deeper = {}
        for mask in crowded:
            known = mask & every
            free = every & ~known
            # few bits left: a crowd of distinct fingerprints is as small as these bits allow
            deeper[mask] = [known | m for m in masks(free, distance, 2)] if free.bit_count() >= 3 * (distance + 2) else []
        found = found.unionByName(_meet(here.filter(F.col("crowd") & F.col("mask").isin([m for m, d in deeper.items() if not d])), distance))
        met = _deal(here.filter("crowd").select("fingerprint", "mask"), {m: d for m, d in deeper.items() if d})


def _deal(rows: DataFrame, chosen: dict[int, list[int]]) -> DataFrame:
    """fingerprint, mask, key: each fingerprint once for each mask that follows its present one."""
    if not chosen:
        return rows.filter("false").withColumn("key", F.col("mask"))
    lists = [F.when(F.col("mask") == m, F.array(*[F.lit(_signed(k)).cast("long") for k in masks])) for m, masks in chosen.items()]
    return rows.withColumn("mask", F.explode(F.coalesce(*lists))).withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))


def _meet(met: DataFrame, distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                columns = [batch[c].to_numpy().view(np.uint64) for c in ("mask", "key", "fingerprint")]
                mask, key, values = columns if carried is None else [np.concatenate(x) for x in zip(carried, columns)]
            elif carried is None:
                return
            else:
                mask, key, values = carried
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            edges = np.concatenate([[0], new, [len(key)]])
            if batch is not None:  # the last group may go on
                carried = [c[edges[-2] :] for c in (mask, key, values)]
                edges = edges[:-1]
            sizes = np.diff(edges)
            twos = edges[:-1][sizes == 2]
            left, right = values[twos], values[twos + 1]
            close = np.bitwise_count(left ^ right) <= distance
            out = [(left[close], right[close])]
            for i in np.flatnonzero(sizes > 2):
                out += forest(np.unique(values[edges[i] : edges[i + 1]]), distance)
            a, b = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b).view(np.int64)), pa.array(np.maximum(a, b).view(np.int64))], names=["a", "b"]
            )

    dealt = met.select("mask", "key", "fingerprint").repartition("mask", "key")
    return dealt.sortWithinPartitions("mask", "key").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node that has a link.

    Large stars link each node's larger neighbours to its smallest neighbour,
    small stars the smaller ones; repeated, each component becomes one star.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = attach(both, least, ["u"], "inner").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = attach(large, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = stage(small, "small-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def _named(marked: DataFrame, distance: int) -> DataFrame:
    """fingerprint, first: (id is null, id, row) of the smallest row of its component."""
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    distinct = stage(marked.groupBy("fingerprint").agg(smallest.alias("least")), "distinct-fingerprints")
    rooted = components(links(distinct.select("fingerprint"), distance))
    nodes = distinct.join(rooted, distinct["fingerprint"] == rooted["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    first = nodes.groupBy("root").agg(F.min("least").alias("first"))
    return stage(attach(nodes, first, ["root"], "inner").select("fingerprint", "first"), "named-fingerprints")


def grouped(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """id, fingerprint (long), component_id of every row.

    ``component_id`` is the smallest id that links lead to, the row's own
    included; nulls are passed over and only a component of null ids has none.
    A text without words (null, empty, blank) has fingerprint 0 and is linked
    like any other.  Repeated rows share their fingerprint.  Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), text).withColumn("row", F.monotonically_increasing_id())
    marked = stage(fingerprints(rows, text, shingle), "fingerprints")
    found = attach(marked, _named(marked, distance), ["fingerprint"], "inner")
    return found.select(F.col("id").alias(id_col), "fingerprint", F.col("first.id").alias("component_id"))


def hexadecimal(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    A null id comes after all others; of rows that repeat the smallest id one
    stays.  The rows are staged under a number, by which the kept ones are found again.
    """
    row = free_name(df, "_row")
    numbered = stage(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    marked = fingerprints(numbered.select(F.col(id_col).alias("id"), text, F.col(row).alias("row")), text, shingle)
    kept = _named(stage(marked, "fingerprints"), distance).select(F.col("first.row").alias(row)).distinct()
    return numbered.join(kept, row, "left_semi").select(*df.columns)
