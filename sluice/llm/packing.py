"""Packing documents into sequences of bounded length, planned on the histogram of lengths.

Lengths are whole numbers up to the capacity, so their histogram is small
whatever the number of documents, and the plan is made from it alone:

1. linear grouping: the large lengths, sorted, are cut into groups of equal
   cardinality and rounded up to the largest of their group;
2. the few sizes left are put together: again and again the fullest
   configuration around the largest size that remains, as often as it can be used;
3. the actual documents take the places of their group, which leaves the true gaps;
4. best fit: each small length, largest first, goes to the smallest gap that holds it.

The plan speaks of ranks: "of the pieces of length l, the k from rank r on go
to the sequences from s on, at offset o".  Documents find their sequence by
their length and their rank among the pieces of that length.  The plan's size
depends on the capacity and the number of groups, not on the documents, so it
is broadcast.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, gapless, scattered, slices, stage, whole_text
from .units import units_for

GROUPS = 1024
#: lengths up to this share of the capacity are small
SMALL = 1 / 4


@dataclass
class Plan:
    """Rows (length, first rank, count, first sequence, offset)."""

    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def place(self, length: int, rank: int, count: int, sequence: int, offset: int) -> None:
        if count:
            self.rows.append((length, rank, count, sequence, offset))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length and rank as one ascending key, first sequence, offset)."""
        table = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        return (table[:, 0] << 40) + table[:, 1], table[:, 3], table[:, 4]


class Ranks:
    """Consecutive items, largest length first, as runs of (length, rank in that length, count)."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        self.runs = runs
        self.ends = np.cumsum([n for _, _, n in runs]).tolist()

    def breaks(self, low: int, high: int) -> list[int]:
        """Places between ``low`` and ``high`` where the length changes."""
        return self.ends[bisect.bisect_right(self.ends, low) : bisect.bisect_left(self.ends, high)]

    def at(self, place: int) -> tuple[int, int]:
        run = bisect.bisect_right(self.ends, place)
        length, rank, count = self.runs[run]
        return length, rank + place - (self.ends[run] - count)


def fullest(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How often to use each size so that the sum, with the first available size in it, is as near to the capacity as can be.

    Reachable sums are the bits of one integer.  Copies of a size count as
    1, 2, 4, ... of it, and the sums after each such step allow the way back.
    """
    first = next(i for i, c in enumerate(counts) if c)
    limit = capacity - sizes[first]
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for i in range(first, len(sizes)):
        left = min(counts[i] - (i == first), limit // sizes[i])
        copies = 1
        while left > 0:
            take = min(copies, left)
            steps.append((i, take, reach))
            reach |= (reach << (take * sizes[i])) & mask
            left -= take
            copies *= 2
        if reach >> limit:
            break
    used = [0] * len(sizes)
    used[first] = 1
    total = reach.bit_length() - 1
    for i, take, before in reversed(steps):
        if not before >> total & 1:
            used[i] += take
            total -= take * sizes[i]
    return used


def plan(histogram: Mapping[int, int], capacity: int, groups: int = GROUPS) -> Plan:
    """The whole plan from the number of pieces of each length 1 .. capacity."""
    made = Plan(capacity)
    lengths = sorted((n for n, c in histogram.items() if c), reverse=True)
    if lengths and (lengths[0] > capacity or lengths[-1] < 1):
        raise ValueError("lengths must be between 1 and the capacity")
    if lengths and lengths[0] == capacity:
        made.place(capacity, 0, histogram[capacity], 0, 0)
        made.sequences = histogram[capacity]
        lengths = lengths[1:]
    large = [n for n in lengths if n > capacity * SMALL]
    open_blocks = _configure(made, [(n, 0, histogram[n]) for n in large], groups)
    _best_fit(made, open_blocks, [(n, histogram[n]) for n in lengths if n <= capacity * SMALL])
    return made


def _configure(made: Plan, runs: list[tuple[int, int, int]], groups: int) -> dict[int, list[tuple[int, int]]]:
    """Place the large lengths; returns blocks of like sequences, (first, count), by their gap."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    total = sum(n for _, _, n in runs)
    if not total:
        return gaps
    ranks = Ranks(runs)
    size = -(-total // groups)
    starts = list(range(0, total, size))
    left = [min(size, total - s) for s in starts]
    rounded = [ranks.at(s)[0] for s in starts]
    used_of = [0] * len(starts)
    while any(left):
        use = fullest(rounded, left, made.capacity)
        times = min(left[i] // n for i, n in enumerate(use) if n)
        slots = []
        for i, n in enumerate(use):
            for _ in range(n):
                slots.append(starts[i] + used_of[i])
                used_of[i] += times
                left[i] -= times
        cuts = sorted({0, times, *(c - s for s in slots for c in ranks.breaks(s, s + times))})
        for low, high in zip(cuts, cuts[1:]):
            offset, sequence = 0, made.sequences
            made.sequences += high - low
            for s in slots:
                length, rank = ranks.at(s + low)
                made.place(length, rank, high - low, sequence, offset)
                offset += length
            gaps.setdefault(made.capacity - offset, []).append((sequence, high - low))
    return gaps


def _best_fit(made: Plan, gaps: dict[int, list[tuple[int, int]]], small: list[tuple[int, int]]) -> None:
    known = sorted(gaps)

    def add(gap: int, block: tuple[int, int]) -> None:
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(known, gap)
        gaps[gap].append(block)

    for length, count in small:
        rank = 0
        while rank < count:
            at = bisect.bisect_left(known, length)
            if at == len(known):  # no gap is left: new sequences, each as full of this length as it goes
                each = made.capacity // length
                whole, rest = divmod(count - rank, each)
                for number, copies in ((whole, each), (1, rest)):
                    if number and copies:
                        for j in range(copies):
                            made.place(length, rank + j * number, number, made.sequences, j * length)
                        rank += number * copies
                        add(made.capacity - copies * length, (made.sequences, number))
                        made.sequences += number
                break
            gap = known[at]
            sequence, number = gaps[gap].pop()
            take = min(number, count - rank)
            made.place(length, rank, take, sequence, made.capacity - gap)
            rank += take
            if take < number:
                gaps[gap].append((sequence + take, number - take))
            if not gaps[gap]:
                del gaps[gap], known[at]
            add(gap - length, (sequence, take))


def pieces(
    df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, piece, start, length, ids of every document, cut at the capacity and only there.

    A null text is empty: its only piece is the end id (without an end id it has none).
    """
    return _cut(df, tokenizer, capacity, end_id, id_col, text, ("ids", "binary"), lambda ids: pa.array(ids, pa.binary()))


def _cut(
    df: DataFrame, tokenizer: str, capacity: int, end_id: int | None, id_col: str, text: str, last: tuple[str, str], make: Callable
) -> DataFrame:
    """id, piece, start, length and one more column that ``make`` makes of the ids, so that ids need not leave Python."""
    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    ending = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer)
        for batch in batches:
            at = 0
            for texts in slices(t.as_py() for t in batch["text"]):
                owner, number, start, ids = [], [], [], []
                for i, own in enumerate(units.ids(texts)):
                    own += ending
                    for first in range(0, len(own), 4 * capacity):
                        owner.append(at + i)
                        number.append(first // (4 * capacity))
                        start.append(first // 4)
                        ids.append(own[first : first + 4 * capacity])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].take(pa.array(owner, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        make(ids),
                    ],
                    names=["id", "piece", "start", "length", last[0]],
                )
                at += len(texts)

    return rows.mapInArrow(cut, f"id {kind}, piece int, start long, length long, {' '.join(last)}").withColumnRenamed("id", id_col)


def place(staged: DataFrame, capacity: int, bucket: str, order: list[str], groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to a table of pieces with a ``length``; ``bucket`` scatters equal lengths."""
    counts = {r["length"]: r["count"] for r in staged.groupBy("length").count().collect()}  # at most one row per length
    keys, sequences, offsets = plan(counts, capacity, groups).arrays()
    shared = staged.sparkSession.sparkContext.broadcast((keys, sequences, offsets))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, sequences, offsets = shared.value
        wanted = (length.to_numpy() << 40) + rank.to_numpy()
        at = np.searchsorted(keys, wanted, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[at] + (wanted - keys[at]), "offset": offsets[at]})

    ranked = gapless(staged, ["length"], bucket, order, "_rank")
    return ranked.withColumn("_spot", find("length", "_rank")).select(
        *[c for c in staged.columns if c != bucket], "_spot.sequence_id", "_spot.offset"
    )


def pack(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text: str = "text",
    groups: int = GROUPS,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Rows that repeat an id are packed like any others.  Other columns are
    ignored; an empty table gives an empty result.  ``sequences`` joins the ids to it.
    """
    buckets = buckets_for(df.count(), 20_000, 8, 4096)
    checksums = lambda ids: pa.array(map(zlib.crc32, ids), pa.int64())
    summed = _cut(df, tokenizer, capacity, end_id, id_col, text, ("ids_crc32", "long"), checksums)
    staged = stage(summed.withColumn("_bucket", scattered(buckets)), "pieces")
    return place(staged, capacity, "_bucket", [id_col, "piece"], groups)


def sequences(cut: DataFrame, packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """sequence_id, ids (unsigned 32-bit little-endian) of every sequence; ids must be unique.

    A sequence has at most as many pieces as tokens, so its group is small.
    """
    joined = cut.select(id_col, "piece", "ids").join(packed.select(id_col, "piece", "sequence_id", "offset"), [id_col, "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        joined.groupBy("sequence_id")
        .agg(ordered.alias("parts"))
        .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (all, p) -> concat(all, p.ids))").alias("ids"))
    )
