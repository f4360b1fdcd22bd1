"""Token ids as binary files, packed by patched frames of reference.

The ids of a file's documents, in ascending order of the documents, form one
stream, cut into blocks of 256.  A block holds its smallest id and the
differences from it, packed at a width that fits a set share of them; the few
that are wider are listed with their place and patched in when read.

A file (little-endian)::

    magic "PFR1", blocks u32, documents u32, tokens u64
    blocks + 1   u64   start of each block, counted from the end of the header
    documents    i64   id of each document
    documents    u64   its first token in this file
    per block:   minimum u32, width u8, exceptions u8, values u16,
                 256 differences of ``width`` bits one behind the other,
                 places of exceptions u8 each, their differences u32 each
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import scratch_path
from .common import buckets_for, slices, stage, whole_text
from .units import units_for

MAGIC = b"PFR1"
BLOCK = 256
#: share of a block's values that the packed width must hold
COVERED = 0.9
HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("patched", "u1"), ("values", "<u2")])
BLOCKS_AT_ONCE = 4096
#: units whose ids a worker remembers: about 200 MB
REMEMBERED = 1_000_000


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, 256) values below 2 ** width to (n, 4 * width) 64-bit words; value v starts at bit v * width."""
    words = np.zeros((max(4 * width, 1), len(values)), np.uint64)
    columns = np.ascontiguousarray(values.T.astype(np.uint64))
    for v in range(BLOCK if width else 0):
        word, bit = divmod(v * width, 64)
        words[word] |= columns[v] << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= columns[v] >> np.uint64(64 - bit)
    return np.ascontiguousarray(words[: 4 * width].T)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The (n, 256) values of ``pack``."""
    columns = np.ascontiguousarray(words.T.astype(np.uint64))
    values = np.zeros((BLOCK, len(words)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for v in range(BLOCK if width else 0):
        word, bit = divmod(v * width, 64)
        values[v] = columns[word] >> np.uint64(bit)
        if bit + width > 64:
            values[v] |= columns[word + 1] << np.uint64(64 - bit)
    return (values & mask).T


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a stream of unsigned 32-bit ids; the last may hold fewer than 256."""
    short = -len(ids) % BLOCK
    grid = np.concatenate([ids, np.repeat(ids[-1:], short)]).reshape(-1, BLOCK).astype(np.uint32)
    least = grid.min(axis=1)
    above = grid - least[:, None]
    bits = bit_lengths(above)
    width = np.sort(bits, axis=1)[:, int(np.ceil(COVERED * BLOCK)) - 1]
    wide = bits > width[:, None]
    counts = wide.sum(axis=1)
    places, outliers = np.nonzero(wide)[1].astype(np.uint8), above[wide].astype("<u4")
    upto = np.concatenate([[0], np.cumsum(counts)])
    packed: list[bytes] = [b""] * len(grid)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        kept = np.where(wide[rows], np.uint32(0), above[rows])
        for row, words in zip(rows, pack(kept, int(w))):
            packed[row] = words.astype("<u8").tobytes()
    heads = np.zeros(len(grid), HEAD)
    heads["least"], heads["width"], heads["patched"], heads["values"] = least, width, counts, BLOCK
    if len(grid):
        heads["values"][-1] = BLOCK - short
    return [
        heads[i : i + 1].tobytes() + packed[i] + places[upto[i] : upto[i + 1]].tobytes() + outliers[upto[i] : upto[i + 1]].tobytes()
        for i in range(len(grid))
    ]


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of neighbouring blocks; ``starts`` are their places in ``data`` and its end."""
    raw = np.frombuffer(data, np.uint8)
    n = len(starts) - 1
    heads = raw[starts[:-1, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).reshape(n)
    grid = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(heads["width"]):
        rows = np.flatnonzero(heads["width"] == w)
        if w:
            at = starts[rows, None] + HEAD.itemsize + np.arange(32 * int(w))
            grid[rows] = unpack(raw[at].copy().view("<u8"), int(w))
    for row in np.flatnonzero(heads["patched"]):
        count, at = int(heads["patched"][row]), int(starts[row]) + HEAD.itemsize + 32 * int(heads["width"][row])
        grid[row, raw[at : at + count]] = np.frombuffer(data, "<u4", count, at + count)
    grid += heads["least"][:, None]
    ids = grid.reshape(-1)
    return ids[: len(ids) - (BLOCK - int(heads["values"][-1]))] if n else ids


class Writer:
    """Takes documents in order and keeps packed blocks; at most one block and one slice of ids stay unpacked."""

    def __init__(self) -> None:
        self.docs: list[int] = []
        self.firsts: list[int] = []
        self.blocks: list[bytes] = []
        self.rest, self.tokens = np.zeros(0, np.uint32), 0

    def add(self, docs: list[int], ids: list[np.ndarray]) -> None:
        for doc, own in zip(docs, ids):
            self.docs.append(doc)
            self.firsts.append(self.tokens)
            self.tokens += len(own)
        stream = np.concatenate([self.rest, *ids])
        whole = len(stream) - len(stream) % BLOCK
        self.blocks += encode_blocks(stream[:whole])
        self.rest = stream[whole:]

    def bytes(self) -> Iterator[bytes]:
        if len(self.rest):
            self.blocks += encode_blocks(self.rest)
        starts = np.concatenate([[0], np.cumsum([len(b) for b in self.blocks])]).astype("<u8")
        yield MAGIC + np.array([len(self.blocks), len(self.docs)], "<u4").tobytes() + np.array([self.tokens], "<u8").tobytes()
        yield starts.tobytes()
        yield np.array(self.docs, "<i8").tobytes()
        yield np.array(self.firsts, "<u8").tobytes()
        yield from self.blocks


class Reader:
    """Documents of a file; any run of blocks can be read by itself."""

    def __init__(self, file) -> None:
        self.file = file
        fixed = file.read(20)
        if fixed[:4] != MAGIC:
            raise ValueError("not a token file")
        blocks, docs = np.frombuffer(fixed, "<u4", 2, 4)
        self.tokens = int(np.frombuffer(fixed, "<u8", 1, 12)[0])
        self.starts = np.frombuffer(file.read(8 * (int(blocks) + 1)), "<u8").astype(np.int64)
        self.docs = np.frombuffer(file.read(8 * int(docs)), "<i8")
        self.firsts = np.frombuffer(file.read(8 * int(docs)), "<u8").astype(np.int64)
        self.body = file.tell()

    def ids(self, first: int, last: int) -> np.ndarray:
        """Tokens ``first`` .. ``last`` - 1 of the file."""
        low, high = first // BLOCK, -(-last // BLOCK)
        if high <= low:
            return np.zeros(0, np.uint32)
        self.file.seek(self.body + int(self.starts[low]))
        data = self.file.read(int(self.starts[high] - self.starts[low]))
        return decode_blocks(data, self.starts[low : high + 1] - self.starts[low])[first - low * BLOCK : last - low * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(id, first token, ids) of each document, read in runs of blocks."""
        ends = np.append(self.firsts[1:], self.tokens)
        at = 0
        while at < len(self.docs):
            to = max(at + 1, int(np.searchsorted(ends, self.firsts[at] + BLOCKS_AT_ONCE * BLOCK, "right")))
            ids, base = self.ids(int(self.firsts[at]), int(ends[to - 1])), self.firsts[at]
            for i in range(at, to):
                yield int(self.docs[i]), int(self.firsts[i]), ids[self.firsts[i] - base : ends[i] - base]
            at = to


@cache
def _store(folder: str):
    """The store of a folder, opened by its own URI; a plain path is local to all, as in tests."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(
    df: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int | None = 0,
    rows_per_file: int = 6_000,
    bytes_per_file: int = 32 << 20,
) -> DataFrame:
    """Write the files; returns their list: part, file, documents, tokens.

    Documents go to files by ranges of their id, in ascending order; rows that
    repeat an id follow each other by the beginning of their text, then a digest of it; however many they are, they
    are dealt out to files like others.  There are as many files as rows or bytes of text ask for.  Ids are whole numbers that fit a long.
    A null id counts as the smallest and is stored as -2 ** 63; a document with that very id is read back with null.  A null text is empty and has only the
    end id.  A task writes its file under a name of its own and renames it when it is
    whole, so a repeated task leaves the same file.  An empty table has no files.
    """
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("bytes")).first()
    parts = max(buckets_for(size["rows"], rows_per_file, 12, 1 << 20), buckets_for(size["bytes"], bytes_per_file, 1, 1 << 20))
    order = ["id", "head", "digest", "row"]  # the last one tells rows apart that are equal in all else
    rows = (
        df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), whole_text(text).alias("text"))
        .withColumns({"head": F.substring("text", 1, 32), "digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(parts, *order)
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions(*order)
        .drop("head", "digest", "row")
    )

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        units, writer, part = units_for(tokenizer, most=REMEMBERED), Writer(), None
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            if batch.num_rows:
                part = batch["part"][0].as_py()
            docs, at = batch["id"].to_pylist(), 0
            for texts in slices(t.as_py() for t in batch["text"]):
                ids = [np.concatenate([np.frombuffer(i, "<u4"), tail]) for i in units.ids(texts)]
                writer.add(docs[at : at + len(texts)], ids)
                at += len(texts)
        if part is None:
            return
        store, path = _store(folder)
        name = f"part-{part:07d}.pfr"
        unfinished = f"{path}/_{name}-{uuid.uuid4().hex}"
        store.create_dir(path, recursive=True)
        with store.open_output_stream(unfinished) as out:
            for piece in writer.bytes():
                out.write(piece)
        store.move(unfinished, f"{path}/{name}")
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "file": [name], "documents": [len(writer.docs)], "tokens": [writer.tokens]}
        )

    return stage(rows.mapInArrow(files, "part int, file string, documents long, tokens long"), "token-files")


def read(spark: SparkSession, folder: str, listing: DataFrame) -> DataFrame:
    """One row per document of the files: id, start (ids of all documents before it), ids.

    ``listing`` is what ``write`` returned; each file is read by one task, block run by block run.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = listing.select("part", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    tasks = max(1, min(listing.count(), 4096))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            for name, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                with store.open_input_file(f"{path}/{name}") as file:
                    held, size = [], 0
                    for doc, first, ids in Reader(file).documents():
                        held.append((doc, base + first, ids.astype("<u4").tobytes()))
                        size += len(ids)
                        if size > 1_000_000:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    return based.repartition(tasks, "part").mapInArrow(documents, "id long, start long, ids binary")


def _rows(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    docs, starts, ids = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=["id", "start", "ids"]
    )


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int | None = 0, rows_per_file: int = 6_000) -> DataFrame:
    """Write all documents, read the files back: id, start, n_tokens, ids_crc32 per document."""
    spark = df.sparkSession
    folder = scratch_path(spark, "token-ids")
    listing = write(df, folder, tokenizer, id_col, text, end_id, rows_per_file)
    back = read(spark, folder, listing)
    return back.select(
        F.nullif("id", F.lit(-(1 << 63))).alias(id_col),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
