"""Token counts of whole texts; huge texts are encoded as overlapping chunks side by side.

Texts of at most a chunk are counted from their units (see ``units``), each distinct one encoded once.

Chunks know where each of their words starts.  Two neighbours are spliced at
a place where both start a word and where that is proven to be a boundary of
the whole text too:

* the left chunk is right up to there: it sees further than any rule looks ahead;
* the character there joins none before it when texts are normalised, and stays
  one character: of one taken apart the parts can be two words at one place;
* from a word start on, a tokenizer's split rules depend only on what follows,
  so the right chunk is right from there on.

Where the overlap holds no such place, the text is cut again with wider
overlaps, in the end as one chunk.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, whole_text
from .units import units_for

CHUNK = 32_768
OVERLAP = 512
#: characters behind a boundary that the left chunk must still see, beside the longest special token
LOOK_AHEAD = 8


@cache
def joining() -> frozenset[str]:
    """Characters that normalisation may join to the one before, move past it or take apart."""
    found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}  # vowels and finals of Hangul
    for c in map(chr, range(sys.maxunicode + 1)):
        if unicodedata.combining(c):
            found.add(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
        if len(c.lower()) > 1 or parts and len(unicodedata.normalize("NFC", c)) > 1:
            found.add(c)
    return frozenset(found)


def boundaries(encoding, piece: str, low: int, high: int) -> list[tuple[int, int]]:
    """(place, tokens before it) of each safe word start from ``low`` to ``high``, where one word only starts.

    Only the tokens of these places are looked at, so a chunk costs no more than its two ends.
    """
    places = (encoding.char_to_token(at) for at in range(low, high + 1))
    token = next((t for t in places if t is not None), len(encoding))
    while token and encoding.token_to_chars(token - 1)[0] >= low:  # a character taken apart
        token -= 1
    found, joins = [], joining()
    before = encoding.token_to_word(token - 1) if token else None
    while token < len(encoding):
        at, word = encoding.token_to_chars(token)[0], encoding.token_to_word(token)
        if at > high:
            break
        if (word is None or word != before) and piece[at] not in joins:
            found.append((at, token))
        token, before = token + 1, word
    times = Counter(at for at, _ in found)
    return [s for s in found if times[s[0]] == 1]


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens.

    Counts ordinary and special tokens of the text, none added.  A null text
    has 0 bytes and 0 tokens; repeated ids are separate rows; other columns are ignored.
    """
    rows = df.select(
        F.col(id_col).alias("id"), whole_text(text).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def whole_or_huge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer)
        for batch in batches:
            at = 0
            for texts in slices(t.as_py() for t in batch["text"]):
                sizes = iter([len(ids) // 4 for ids in units.ids([t for t in texts if len(t) <= chunk])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(at, len(texts)),
                        batch["id"].slice(at, len(texts)),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array([next(sizes) if len(t) <= chunk else None for t in texts], pa.int64()),
                        pa.array([None if len(t) <= chunk else t for t in texts], pa.string()),
                    ],
                    names=["row", "id", "n_bytes", "n_tokens", "huge"],
                )
                at += len(texts)

    first = stage(
        rows.mapInArrow(whole_or_huge, f"row long, id {kind}, n_bytes long, n_tokens long, huge string"), "token-counts"
    )
    counts = first.filter("n_tokens IS NOT NULL").select("id", "n_bytes", "n_tokens")
    huge = first.filter("n_tokens IS NULL").select("row", "id", "n_bytes", "huge")
    while not huge.isEmpty():
        spliced = stage(_splice(huge, tokenizer, chunk, overlap), "token-splices")
        done = spliced.filter("n_tokens IS NOT NULL")
        counts = counts.unionByName(huge.join(done, "row").select("id", "n_bytes", "n_tokens"))
        huge = huge.join(spliced.filter("n_tokens IS NULL").select("row"), "row", "left_semi")
        overlap *= 4
        chunk = max(chunk, 4 * overlap)
    return counts.withColumnRenamed("id", id_col)


def _splice(huge: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """row, n_tokens of each text; null where two chunks could not be aligned."""
    if chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than its two overlaps")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch["row"].to_pylist(), batch["huge"]):
                text = text.as_py()
                starts = [0]
                while starts[-1] + chunk < len(text):
                    starts.append(starts[-1] + chunk - overlap)
                for i, start in enumerate(starts):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": [row],
                            "piece": pa.array([i], pa.int32()),
                            "start": [start],
                            "last": [i == len(starts) - 1],
                            "text": [text[start : start + chunk]],
                        }
                    )

    spots = pa.list_(pa.struct([("at", pa.int64()), ("tokens", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer)
        beyond = LOOK_AHEAD + max(map(len, units.special), default=0)
        for batch in batches:
            for row, piece, start, last, text in zip(*(batch[c] for c in ("row", "piece", "start", "last", "text"))):
                start, text = start.as_py(), text.as_py()
                encoding = units.tokenizer.encode(text, add_special_tokens=False)
                end = len(text)
                head = boundaries(encoding, text, 0, overlap - 1) if start else []
                tail = boundaries(encoding, text, end - overlap, end - beyond) if not last.as_py() else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()], pa.int64()),
                        pa.array([piece.as_py()], pa.int32()),
                        pa.array([last.as_py()], pa.bool_()),
                        pa.array([len(encoding)], pa.int64()),
                        pa.array([[{"at": start + a, "tokens": t} for a, t in head]], spots),
                        pa.array([[{"at": start + a, "tokens": t} for a, t in tail]], spots),
                    ],
                    names=["row", "piece", "last", "n", "head", "tail"],
                )

    places = "array<struct<at:long,tokens:long>>"
    encoded = (
        huge.select("row", "huge")
        .mapInArrow(cut, "row long, piece int, start long, last boolean, text string")
        .repartition(F.col("row"), F.col("piece"))  # the chunks of one text go to many tasks
        .mapInArrow(encode, f"row long, piece int, last boolean, n long, head {places}, tail {places}")
    )
    order = Window.partitionBy("row").orderBy("piece")
    common = F.expr("try_element_at(filter(tail, t -> exists(next_head, h -> h.at = t.at)), 1)")
    paired = encoded.withColumn("next_head", F.lead("head").over(order)).withColumn("leave", common)
    enter = F.expr("try_element_at(filter(head, h -> h.at = came), 1).tokens")
    counted = (
        paired.withColumn("came", F.lag("leave.at").over(order))
        .withColumn("from", F.when(F.col("piece") == 0, F.lit(0).cast("long")).otherwise(enter))
        .withColumn("to", F.when(F.col("last"), F.col("n")).otherwise(F.col("leave.tokens")))
    )
    whole = F.count(F.lit(1)) == F.count(F.col("to") - F.col("from"))
    return counted.groupBy("row").agg(F.when(whole, F.sum(F.col("to") - F.col("from"))).alias("n_tokens"))
