"""Removal of byte strings that occur earlier in the table, wherever they lie in a text.

All windows of ``length`` bytes are compared, in four steps:

1. every text is cut into runs of windows with a common anchor (see ``windows``).
   Runs travel as digests, dealt out by their anchor; each batch sends equal
   runs once and names the others as repeats right away;
2. per anchor: runs with equal digests are equal, all but the earliest are
   repeats.  Different runs that share a context may still have windows in
   common: they are contested;
3. only the bytes of contested runs travel.  Their windows are compared by
   intervals of a Burrows-Wheeler transform, a few anchors at a time;
4. the repeated windows go to their documents, which drop the bytes they cover.

An anchor with many different runs (the edge of a passage that a large share of
all documents contain) is crowded: its windows are dealt out one by one by
their own digest, and equal ones again are sent once per task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, free_name, stage, whole_text
from .windows import GRAM, digests, repeated_intervals, runs

LENGTH = 100
#: bytes looked at together, bytes of a text looked at together, runs combined before they are sent
SLICE, PART, COMBINED = 1_000_000, 2_000_000, 250_000
#: different runs of one anchor in a batch, and in all, from which it is crowded
CROWD, CROWD_IN_ALL = 64, 4096
#: bytes compared at once; one anchor may need more
COMPARED = 1_000_000
#: crowded windows that a task remembers
REMEMBERED = 50_000

COMPARE, REPEAT, SPLIT, MARK = range(4)
FIELDS = {
    "anchor": np.uint64,
    "digest": np.uint64,
    "id": np.int64,
    "tie": np.int64,
    "start": np.uint32,
    "windows": np.uint8,
    "left": np.uint16,
    "right": np.uint16,
}
Columns = dict[str, np.ndarray]


def _take(columns: Columns, rows: np.ndarray) -> Columns:
    return {k: v[rows] for k, v in columns.items()}


def _joined(parts: list[Columns]) -> Columns:
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in FIELDS.items()}


def _sorted(columns: Columns) -> tuple[Columns, np.ndarray, np.ndarray]:
    """By anchor, digest and place in the table; where a new anchor and a new digest begin."""
    order = np.lexsort([columns[k] for k in ("start", "tie", "id", "digest", "anchor")])
    columns = _take(columns, order)
    anchor, digest = columns["anchor"], columns["digest"]
    new_anchor = np.ones(len(anchor), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_digest = new_anchor.copy()
    new_digest[1:] |= digest[1:] != digest[:-1]
    return columns, new_anchor, new_digest


def _sampled(items: list[tuple[int, int, int, bytes]], length: int) -> Columns:
    """Runs of (id, tie, offset, bytes) items."""
    data = b"".join(i[3] for i in items)
    bounds = np.concatenate([[0], np.cumsum([len(i[3]) for i in items])]).astype(np.int64)
    doc, at, windows, anchor, left, right = runs(np.frombuffer(data, np.uint8), bounds, length)
    ids, ties, offsets = (np.array([i[k] for i in items], np.int64) for k in range(3))
    return {
        "anchor": anchor,
        "digest": digests(data, at, windows, length),
        "id": ids[doc],
        "tie": ties[doc],
        "start": (at - bounds[doc] + offsets[doc]).astype(np.uint32),
        "windows": windows.astype(np.uint8),
        "left": left,
        "right": right,
    }


def _dealt(columns: Columns, kind: int, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket, each field packed."""
    order = np.argsort(bucket, kind="stable")
    columns, bucket = _take(columns, order), bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
    for low, high in zip(edges[:-1], edges[1:]):
        row = {"bucket": pa.array([bucket[low]], pa.int32()), "kind": pa.array([kind], pa.int32())}
        yield pa.RecordBatch.from_pydict(row | {k: pa.array([v[low:high].tobytes()], pa.binary()) for k, v in columns.items()})


def _combined(parts: list[Columns], buckets: int) -> Iterator[pa.RecordBatch]:
    """What a batch sends: each different run once."""
    columns, new_anchor, new_digest = _sorted(_joined(parts))
    by_id = lambda c: (c["id"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
    by_anchor = lambda c: c["anchor"] % np.uint64(buckets)
    repeats = _take(columns, ~new_digest)
    yield from _dealt(repeats, REPEAT, by_id(repeats))
    number = np.cumsum(new_anchor) - 1
    crowded = (np.bincount(number, weights=new_digest) > CROWD)[number] if len(number) else new_anchor
    split = _take(columns, new_digest & crowded)
    yield from _dealt(split, SPLIT, by_id(split))
    marks = _take(columns, new_anchor & crowded)
    yield from _dealt(marks, MARK, by_anchor(marks))
    rest = _take(columns, new_digest & ~crowded)
    yield from _dealt(rest, COMPARE, by_anchor(rest))


RUNS = pa.schema(
    [("id", pa.int64()), ("tie", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("windows", pa.int32()), ("anchor", pa.int64())]
)


def _runs(columns: Columns, kind: int) -> pa.Table:
    values = [columns["id"], columns["tie"], np.full(len(columns["id"]), kind), columns["start"], columns["windows"], columns["anchor"].view(np.int64)]
    return pa.table([pa.array(v).cast(f.type) for v, f in zip(values, RUNS)], schema=RUNS)


def _judged(table: pa.Table) -> pa.Table:
    """Of the runs of some anchors: repeats, contested ones, and those of crowded anchors."""
    kinds = table["kind"].to_numpy()
    parts = [{k: np.frombuffer(table[k][i].as_py(), t) for k, t in FIELDS.items()} for i in range(len(kinds))]
    of = lambda kind: _joined([p for p, k in zip(parts, kinds) if k == kind])
    columns, marked = of(COMPARE), of(MARK)["anchor"]
    twice = np.sort(columns["anchor"])
    wanted = np.unique(np.concatenate([twice[1:][twice[1:] == twice[:-1]], marked]))
    columns = _take(columns, np.isin(columns["anchor"], wanted))
    columns, new_anchor, new_digest = _sorted(columns)
    repeats = _take(columns, ~new_digest)
    number = (np.cumsum(new_anchor) - 1)[new_digest]
    first = _take(columns, new_digest)
    contested = _shared(first, "left") | _shared(first, "right")
    crowded = np.isin(first["anchor"], marked)
    if len(number):
        crowded |= (np.bincount(number, weights=contested) > CROWD_IN_ALL)[number] & contested
    return pa.concat_tables(
        [
            _runs(of(REPEAT), REPEAT),
            _runs(of(SPLIT), SPLIT),
            _runs(repeats, REPEAT),
            _runs(_take(first, crowded), SPLIT),
            _runs(_take(first, contested & ~crowded), COMPARE),
        ]
    )


def _shared(columns: Columns, side: str) -> np.ndarray:
    """Whether another run of the anchor has the same context."""
    order = np.lexsort([columns[side], columns["anchor"]])
    anchor, context = columns["anchor"][order], columns[side][order]
    same = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1]) & (context[1:] > 0)
    found = np.zeros(len(order), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bytes of contested runs; of crowded ones each window.

    A window goes without its bytes if the task has sent an equal one that stands earlier, as far back as it remembers.
    """
    names = ["key", "id", "tie", "start", "windows", "bytes"]
    seen: dict[bytes, tuple[int, int, int]] = {}
    for batch in batches:
        ids, ties, texts = batch["id"].to_pylist(), batch["tie"].to_pylist(), batch["text"]
        out: list[tuple] = []
        for row in sorted(range(len(ids)), key=lambda i: (ids[i], ties[i])):
            data = texts[row].as_py().encode()
            for run in sorted(batch["runs"][row].as_py(), key=lambda r: r["start"]):
                start, windows = run["start"], run["windows"]
                if run["kind"] == COMPARE:
                    out.append((run["anchor"], ids[row], ties[row], start, windows, data[start : start + windows + length - 1]))
                    continue
                for at in range(start, start + windows):
                    window = data[at : at + length]
                    digest = xxhash.xxh3_128_digest(window)
                    key = int.from_bytes(digest[:8], "little", signed=True)
                    place = (ids[row], ties[row], at)
                    known = seen.get(digest, place) < place
                    if not known:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen[digest] = place
                    out.append((xxhash.xxh3_64_intdigest(ids[row].to_bytes(8, "little", signed=True)) >> 1 if known else key, ids[row], ties[row], at, 1, None if known else window))
        for low in range(0, len(out), 50_000):
            columns = list(zip(*out[low : low + 50_000]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _compared(held: list[tuple[int, int, int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """Repeated windows, as (id, tie, start, windows), among (id, tie, start, windows, bytes)."""
    held = sorted(held, key=lambda s: s[:3])
    joined = b"\0".join(s[4] for s in held) + b"\0"
    sizes = np.array([len(s[4]) + 1 for s in held])
    ends = np.cumsum(sizes)
    text = np.frombuffer(joined, np.uint8).astype(np.uint16) + np.uint16(1)
    text[ends - 1] = 0  # between segments, a symbol that no byte has
    order, interval = repeated_intervals(text, length)
    interval_at = np.empty(len(text), np.int32)
    interval_at[order] = interval
    windows = np.array([s[3] for s in held])
    begins = ends - sizes
    owner = np.repeat(np.arange(len(held)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    classes = interval_at[begins[owner] + within]
    repeated = np.ones(len(owner), bool)  # windows stand in the order of the table, so the first of a class is the earliest
    repeated[np.unique(classes, return_index=True)[1]] = False
    found = np.flatnonzero(repeated)
    if not len(found):
        return []
    breaks = np.flatnonzero((np.diff(found) != 1) | (np.diff(owner[found]) != 0)) + 1
    return [(held[owner[g[0]]][0], held[owner[g[0]]][1], held[owner[g[0]]][2] + int(within[g[0]]), len(g)) for g in np.split(found, breaks)]


def _contests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows among segments that come by key; equal windows have equal keys, so one alone has no equal."""
    held: list[tuple] = []
    own: list[tuple] = []
    size, last = 0, None
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "tie", "start", "windows"])

    for batch in batches:
        known = []
        for key, *segment in zip(*(batch[c].to_pylist() for c in ("key", "id", "tie", "start", "windows", "bytes"))):
            if segment[4] is None:
                known.append(tuple(segment[:4]))
                continue
            if key != last:
                if len(own) > 1:
                    held += own
                    size += sum(len(s[4]) for s in own)
                if size >= COMPARED:
                    yield rows(_compared(held, length))
                    held, size = [], 0
                own, last = [], key
            own.append(tuple(segment))
        if known:
            yield rows(known)
    if len(own) > 1:
        held += own
    if held:
        yield rows(_compared(held, length))


def covered(found: list[dict], length: int, size: int) -> list[tuple[int, int]]:
    """Maximal spans that the windows cover."""
    spans: list[list[int]] = []
    for start, end in sorted((r["start"], min(size, r["start"] + r["windows"] + length - 1)) for r in found):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(a, b) for a, b in spans]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *itertools.chain.from_iterable(spans), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, widened to whole UTF-8 characters."""
    wide: list[list[int]] = []
    for start, end in spans:
        while data[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if wide and start <= wide[-1][1]:
            wide[-1][1] = end
        else:
            wide.append([start, end])
    return [(a, b) for a, b in wide]


def _keys(df: DataFrame, id_col: str, text: str) -> tuple[Column, Column, DataFrame]:
    """What names a document: its id, null as the smallest, and where ids repeat a digest of the text; each document once."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    unique = df.select(key.alias("id")).groupBy("id").count().filter("count > 1").isEmpty()
    tie = F.lit(0).cast("long") if unique else F.xxhash64(whole_text(text))
    rows = df.select(key.alias("id"), tie.alias("tie"), whole_text(text).alias("text"))
    return key, tie, rows if unique else stage(rows.dropDuplicates(["id", "tie"]), "documents-once")


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """id, tie, runs (start, windows) of the windows that start earlier too, for (id, tie, text) rows that have any.

    Each (id, tie) must be there once: a second row would make every window of the first a repeat.
    """
    if length < 2 * GRAM:
        raise ValueError("a window must be twice as long as its anchor")
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    buckets = buckets_for(size, 8 << 20, 48, 1 << 20)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[Columns] = []
            items: list[tuple[int, int, int, bytes]] = []
            held = found = 0
            for id_, tie, value in zip(batch["id"].to_pylist(), batch["tie"].to_pylist(), batch["text"]):
                data = value.as_py().encode()
                for at in range(0, max(0, len(data) - length + 1), PART):
                    items.append((id_, tie, at, data[at : at + PART + length - 1]))
                    held += len(items[-1][3])
                    if held >= SLICE:
                        parts.append(_sampled(items, length))
                        items, held, found = [], 0, found + len(parts[-1]["id"])
                    if found >= COMBINED:
                        yield from _combined(parts, buckets)
                        parts, found = [], 0
            if items:
                parts.append(_sampled(items, length))
            yield from _combined(parts, buckets)

    packed = ", ".join(f"{k} binary" for k in FIELDS)
    dealt = rows.mapInArrow(sample, f"bucket int, kind int, {packed}")
    judged = stage(
        dealt.groupBy("bucket").applyInArrow(_judged, "id long, tie long, kind int, start long, windows int, anchor long"),
        "window-runs",
    )
    contested = (
        judged.filter(F.col("kind") != REPEAT)
        .groupBy("id", "tie")
        .agg(F.collect_list(F.struct("kind", "start", "windows", "anchor")).alias("runs"))
    )
    # in a fixed order, so that a repeated task sends the same windows
    segments = rows.join(contested, ["id", "tie"]).sortWithinPartitions("id", "tie").mapInArrow(
        lambda b: _segments(b, length), "key long, id long, tie long, start long, windows int, bytes binary"
    )
    resolved = stage(
        segments.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _contests(b, length), "id long, tie long, start long, windows int"),
        "repeated-windows",
    )
    known = judged.filter(F.col("kind") == REPEAT).select("id", "tie", "start", "windows")
    return known.unionByName(resolved).groupBy("id", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: id, n_bytes, spans (start, end) of removed bytes, kept (the other bytes).

    A string is earlier if its document has a smaller id, or starts earlier in
    the same one.  A null text is empty.  A null id is smaller than any other.  Rows that repeat an id
    with another text are ordered by a digest of it; rows that repeat both are
    one document and get equal results.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for value, found in zip(batch["text"], batch["runs"]):
                data = value.as_py().encode()
                sizes.append(len(data))
                spans.append(covered(found.as_py() or [], length, len(data)))
                kept.append(without(data, spans[-1]))
            listed = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sizes, pa.int64()), listed, pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    key, tie, once = _keys(df, id_col, text)
    rows = df.select(key.alias("id"), tie.alias("tie"), whole_text(text).alias("text"))
    joined = rows.join(repeated_windows(once, length), ["id", "tie"], "left").select("id", "text", "runs")
    done = joined.mapInArrow(cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.withColumn("id", F.nullif("id", F.lit(-(1 << 63)))).withColumnRenamed("id", id_col)


def shorten(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows and columns; ``text`` without repeated strings, a character going with any of its bytes.

    A null text stays null.
    """
    key, tie, once = _keys(df, id_col, text)
    found = repeated_windows(once, length)
    names = {n: free_name(df, f"_{n}") for n in ("id", "tie", "runs")}
    found = found.select(*[F.col(n).alias(as_) for n, as_ in names.items()])
    joined = df.join(found, (key == F.col(names["id"])) & (tie == F.col(names["tie"])), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        def one(value: str, found: list[dict]) -> str:
            data = value.encode()
            return without(data, whole_characters(data, covered(found, length, len(data)))).decode()

        return pd.Series([v if v is None or f is None else one(v, f) for v, f in zip(texts, lists)])

    return joined.withColumn(text, cut(text, names["runs"])).select(*df.columns)
