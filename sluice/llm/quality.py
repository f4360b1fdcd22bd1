"""Quality rules: counts per text, and a likelihood ratio between trusted text and the whole corpus.

Words and pairs of neighbouring words are hashed into buckets.  The corpus and
the trusted part of it each give a multinomial over the buckets; a text's score
is the mean over its n-grams of the logarithm of their ratio, so that long
texts are not favoured.  Counts cover all documents.  The threshold is a low
quantile of the trusted texts' own scores, read off their histogram, so that
every document is judged by the same fixed number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exact
from .common import stage, whole_text, word_runs

BUCKET_BITS = 14
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: share of trusted texts that pass the base rules which may fall below the threshold
LOST = 0.002
#: bytes that are broadcast to tell trusted documents: their ids as sorted numbers of 8 bytes or, if these are more or
#: ids are no numbers, a Bloom filter of them
BROADCAST_BYTES = 128 << 20
#: steps of the histogram of scores, per unit
STEPS = 10_000
FIRST, SECOND, THIRD = (np.uint64((0x9E3779B97F4A7C15 * k) & ((1 << 64) - 1)) for k in (3, 5, 7))


class Hashes(dict):
    """64-bit hash of a word, kept for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashes_of(words: list[bytes], known: Hashes) -> np.ndarray:
    if len(known) > 500_000:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def grams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of all words and of all pairs."""
    pairs = hashes[:-1] * FIRST + hashes[1:] * SECOND
    return (np.concatenate([hashes, pairs]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def text_hashes(text: str, known: Hashes) -> np.ndarray:
    """The hashes of a text's words; the words of a long one are cut out in slices."""
    return np.concatenate([np.empty(0, np.uint64), *[hashes_of(words, known) for words in word_runs(text.encode())]])


def gram_runs(hashes: np.ndarray, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """The buckets of ``grams``, of so many words at a time; a pair belongs to its second word."""
    for low in range(0, len(hashes), size):
        own = grams(hashes[max(low - 1, 0) : low + size])
        yield own[1:] if low else own  # the first word was counted with the run before


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(hashes) < 4:
        return 0
    windows = hashes[:-2] * FIRST + hashes[1:-1] * SECOND + hashes[2:] * THIRD
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    del ordered
    place = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
    again = twice[place] == windows
    inside = np.zeros(len(hashes), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def base(text: str, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    return (
        len(hashes),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


def multinomials(rows: DataFrame, trusted: Broadcast | None = None, all_trusted: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket in all texts and in trusted ones, of (id, text) rows; ``trusted`` are the sorted trusted ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = Hashes(), np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            if trusted is not None:
                marks = among(batch["id"], trusted.value)
            else:
                marks = np.full(batch.num_rows, all_trusted)
            for text, mark in zip(batch["text"], marks):
                for run in gram_runs(text_hashes(text.as_py(), known)):
                    own = np.bincount(run, minlength=1 << BUCKET_BITS)
                    found[0] += own
                    if mark:
                        found[1] += own
        used = np.flatnonzero(found[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[0][used]), pa.array(found[1][used])], names=["bucket", "corpus", "target"])

    sums = rows.mapInArrow(count, "bucket long, corpus long, target long").groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))
    table = sums.toArrow()  # at most one row per bucket
    corpus, target = np.zeros((2, 1 << BUCKET_BITS))
    corpus[table["bucket"].to_numpy()] = table["corpus"].to_numpy()
    target[table["bucket"].to_numpy()] = table["target"].to_numpy()
    return corpus, target


def among(ids: pa.Array, known: np.ndarray) -> np.ndarray:
    """Which ids stand in the sorted ``known``; null ones do not."""
    if not len(known):
        return np.zeros(len(ids), bool)
    there = np.asarray(ids.is_valid())
    values = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return there & (known[place] == values)


def trusted_counts(rows: DataFrame, trusted: DataFrame, most_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket in all texts and in those of trusted ids; texts stay in the tasks that read them.

    Ids that are numbers and few enough go to every task.  Otherwise a Bloom filter of them does, all texts are counted
    where they are, and only texts that the filter lets through move, to meet the ids exactly.
    """
    context = rows.sparkSession.sparkContext
    n = trusted.count()
    if isinstance(rows.schema["id"].dataType, T.IntegralType) and 8 * n <= most_bytes:
        known = np.sort(trusted.select(F.col("_trusted").cast("long")).toArrow()["_trusted"].to_numpy())
        return multinomials(rows, context.broadcast(known))
    bits = min(8 * most_bytes, 1 << max(10, (16 * n).bit_length()))
    hashes = trusted.select(F.xxhash64("_trusted").alias("hash"))
    maybe = exact.tester(context.broadcast(exact.filter_words(hashes, "hash", bits)))
    coded = rows.filter("id IS NOT NULL").withColumn("hash", F.xxhash64("id"))
    passed = coded.filter(maybe(*exact.positions("hash", bits))).select("id", "text")
    corpus, _ = multinomials(rows)
    return corpus, multinomials(passed.join(trusted, F.col("id") == F.col("_trusted"), "left_semi"), all_trusted=True)[1]


def log_ratio(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of target over corpus probability, every bucket counted once more in both; 0 without a target."""
    if not target.any():
        return np.zeros(len(corpus))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((corpus + 1) / (corpus.sum() + len(corpus)))


def scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """id, the base counts and the score of (id, text) rows; a text without words has score 0."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = Hashes(), shared.value
        for batch in batches:
            found, scores = [], []
            for value in batch["text"]:
                text = value.as_py()
                hashes = text_hashes(text, known)
                found.append(base(text, hashes))
                total = sum(float(weights[run].sum()) for run in gram_runs(hashes))
                scores.append(total / (2 * len(hashes) - 1) if len(hashes) else 0.0)
            counts = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *[pa.array(c, pa.int64()) for c in counts], pa.array(scores, pa.float64())],
                names=["id", *names, "score"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {', '.join(f'{n} long' for n in names)}, score double")


def threshold(trusted: DataFrame, lost: float = LOST) -> float:
    """The score below which at most the share ``lost`` of trusted texts lies, to 1 / STEPS."""
    steps = trusted.groupBy(F.floor(F.col("score") * STEPS).alias("step")).count().collect()
    # scores lie within the logarithm of the n-grams' number, which bounds the steps
    allowed, below = lost * sum(r["count"] for r in steps), 0
    for step, count in sorted(tuple(r) for r in steps):
        below += count
        if below > allowed:
            return step / STEPS
    return float("-inf")


def judge(
    df: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lost: float = LOST,
    most_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per input row: id, the base counts, base_failed, score, kept.

    ``trusted_ids`` has a column of the id's name and type; ids may repeat and nulls are
    passed over.  Without trusted texts every score is 0 and the base rules alone decide.
    A null text has no words, and rows with a null id are never trusted.  Rows that repeat an id are separate rows, all
    of them trusted if the id is.  Texts are read whole, one at a time.  Other columns are ignored; an empty table gives
    an empty result.
    """
    trusted = stage(trusted_ids.select(F.col(id_col).alias("_trusted")).filter("_trusted IS NOT NULL").distinct(), "trusted-ids")
    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    weights = log_ratio(*trusted_counts(rows, trusted, most_bytes))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stage(scored(rows, weights).withColumn("base_failed", failed), "quality-scores")
    least = threshold(judged.filter("NOT base_failed").join(trusted, F.col("id") == F.col("_trusted"), "left_semi"), lost)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least)).withColumnRenamed("id", id_col)
