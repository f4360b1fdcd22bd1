"""A toxicity classifier that is kept from reacting to whom a sentence is about.

A logistic regression over the words that a text contains and their beginnings.  They are chosen by
how clearly the two classes differ in them.  Identity terms are always among
them: sentences of labelled texts that name a group are copied with the term
swapped for others of its kind, and the fit is penalised for every change of
the score between a sentence and its copy.  Such terms so lose their own
weight, and a neutral mention is no reason to reject a text.

The fit uses a bounded sample of the labelled rows, and all sentences of these; every document is scored.
Words that a sentence shares with its copy change no score, so a pair is kept as the words in which the
two differ.  These are identity terms and their beginnings: however long the texts, there are few different pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, whole_text

WORD = re.compile(r"\w+")
PREFIX = 4
SENTENCE = re.compile(r"[.!?\n]+")
#: labelled rows of each class that the fit uses at most, those with the smallest digest of their id
SAMPLE = 8_000
#: words in the model for each class
WORDS = 2_000
REJECT = 0.7

# identity terms, by kind; a term is swapped for the others of its kind
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "queer", "straight"),
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino", "hispanic", "indigenous"),
    ("african", "american", "european", "mexican", "chinese", "indian", "arab"),
    ("immigrant", "native"),
    ("immigrants", "natives"),
    ("deaf", "blind", "disabled"),
    ("old", "young"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)


def features(words: set[str]) -> set[str]:
    """The words, and the beginnings of longer ones, which stand for forms not seen before."""
    return words | {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}


def words(text: str) -> set[str]:
    return features(set(WORD.findall(text.lower())))


def swaps(identities: Sequence[Sequence[str]]) -> dict[str, list[dict[str, str]]]:
    """For each term the replacements to make: all terms of its kind move on by the same number of places."""
    return {
        term: [{t: kind[(j + by) % len(kind)] for j, t in enumerate(kind)} for by in range(1, len(kind))]
        for kind in identities
        for term in kind
    }


def _swapped(text: str, replacements: dict[str, list[dict[str, str]]]) -> Iterator[tuple[set[str], set[str]]]:
    for sentence in SENTENCE.split(text.lower()):
        own = set(WORD.findall(sentence))
        kinds = {id(replacements[w]): replacements[w] for w in sorted(own) if w in replacements}
        seen = set()
        for choices in kinds.values():
            for choice in choices:
                swapped = {choice.get(w, w) for w in own}
                if swapped != own and (key := frozenset(swapped)) not in seen:
                    seen.add(key)
                    yield features(own), features(swapped)


def copies(text: str, replacements: dict[str, list[dict[str, str]]]) -> list[tuple[set[str], set[str]]]:
    """(words of a sentence, words of its swapped copy), of all sentences."""
    return list(_swapped(text, replacements))


def changes(text: str, replacements: dict[str, list[dict[str, str]]]) -> Counter[tuple[tuple[str, ...], tuple[str, ...]]]:
    """How often (words only in a sentence, words only in its swapped copy) occur, over all sentences."""
    return Counter((tuple(sorted(a - b)), tuple(sorted(b - a))) for a, b in _swapped(text, replacements))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        """Between 0 and 1; a text without known words gets what the bias says."""
        total = self.bias + sum(self.weights.get(w, 0.0) for w in words(text))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def labelled(df: DataFrame, labels: DataFrame, id_col: str, text: str, train: Column, sample: int) -> DataFrame:
    """toxic, words, and what the sentence copies change, of the sampled labelled texts.

    A document with several labels is toxic if any says so; null labels are
    passed over.  The sampled ids are broadcast: at most ``2 * sample``.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & train)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    order = (F.xxhash64("_id"), F.col("_id"))
    chosen = [known.filter(F.col("_toxic") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text")).join(ids, F.col("id") == F.col("_id"))
    rows = rows.select("id", F.col("_toxic").cast("int").alias("toxic"), "text").dropDuplicates(["id"])
    replacements = swaps(IDENTITIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("own", pa.list_(pa.string())), ("swapped", pa.list_(pa.string())), ("times", pa.int64())])
        for batch in batches:
            texts = [t.as_py() for t in batch["text"]]
            pairs = [[{"own": a, "swapped": b, "times": n} for (a, b), n in changes(t, replacements).items()] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["toxic"], pa.array([sorted(words(t)) for t in texts], pa.list_(pa.string())), pa.array(pairs, pa.list_(pair))],
                names=["id", "toxic", "words", "copies"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"id {kind}, toxic int, words array<string>, copies array<struct<own:array<string>,swapped:array<string>,times:long>>"), "labelled-words")


def vocabulary(sample: DataFrame, most: int = WORDS) -> list[str]:
    """Words of at least two texts in which the classes differ most clearly, and all identity terms; none without both classes."""
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    seen = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = lambda n, total: F.log((n + 0.5) / (F.lit(total) - n + 0.5))
    t, c = F.col("t"), F.col("c")
    clear = (odds(t, toxic) - odds(c, clean)) / F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    ranked = seen.filter(t + c > 1).select("word", F.round(clear, 6).alias("clear"))
    ends = [ranked.orderBy(F.col("clear").desc(), "word").limit(most), ranked.orderBy("clear", "word").limit(most)]
    chosen = {r["word"] for r in ends[0].unionByName(ends[1]).collect()}
    return sorted(chosen | {t for kind in IDENTITIES for t in kind})


def _sparse(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.repeat(np.arange(len(lists)), sizes), np.array([i for x in lists for i in x], np.int64)


def train(
    features: Sequence[Sequence[int]],
    toxic: np.ndarray,
    pairs: Sequence[tuple[Sequence[int], Sequence[int]]],
    size: int,
    swap_penalty: float = 10.0,
    ridge: float = 1e-4,
    rounds: int = 300,
    rate: float = 0.1,
    times: np.ndarray | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias: log loss with both classes weighing the same, ridge, and the mean squared change by swaps.

    ``times``: how many pairs each pair stands for, one if not given.

    Full-batch Adam from 0: the same input gives the same model.
    """
    row, column = _sparse(features)
    n = len(features)
    balance = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))
    own_row, own = _sparse([a for a, _ in pairs])
    swapped_row, swapped = _sparse([b for _, b in pairs])
    times = np.ones(len(pairs)) if times is None else times
    weights, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, weights[column], n) + bias
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic)
        slope = np.bincount(column, error[row], size) + ridge * weights
        if pairs:
            change = np.bincount(own_row, weights[own], len(pairs)) - np.bincount(swapped_row, weights[swapped], len(pairs))
            change *= 2 * swap_penalty * times / times.sum()
            slope += np.bincount(own, change[own_row], size) - np.bincount(swapped, change[swapped_row], size)
        slope = np.append(slope, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", train_rows: Column | None = None, sample: int = SAMPLE
) -> Model:
    """Model from labelled rows for which ``train_rows`` (over the labels' columns) holds.

    Without labelled texts of both classes every score is 0.5 and nothing is rejected.
    """
    texts = labelled(df, labels, id_col, text, F.lit(True) if train_rows is None else train_rows, sample)
    terms = vocabulary(texts)
    if not terms:
        return Model({}, 0.0)
    number = {t: i for i, t in enumerate(terms)}
    shared = texts.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        ints = pa.list_(pa.int32())
        find = lambda own: [number[w] for w in own if w in number]
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["toxic"], pa.array(map(find, batch["words"].to_pylist()), ints)], names=["id", "toxic", "words"]
            )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        ints = pa.list_(pa.int32())
        find = lambda own: [number[w] for w in own if w in number]
        for batch in batches:
            pair = [pa.array(map(find, batch[c].to_pylist()), ints) for c in ("own", "swapped")]
            yield pa.RecordBatch.from_arrays([*pair, batch["times"]], names=["own", "swapped", "times"])

    kind = texts.schema["id"].dataType.simpleString()
    found = texts.select("id", "toxic", "words").mapInArrow(run, f"id {kind}, toxic int, words array<int>")
    table = found.toArrow().sort_by("id")  # bounded by the sample and the vocabulary
    pairs = texts.select(F.inline("copies")).groupBy("own", "swapped").agg(F.sum("times").alias("times"))
    pairs = pairs.mapInArrow(numbered, "own array<int>, swapped array<int>, times long")
    pairs = pairs.groupBy("own", "swapped").agg(F.sum("times").alias("times")).collect()  # bounded by the identity terms
    pairs = sorted((p["own"], p["swapped"], p["times"]) for p in pairs)
    features = table["words"].to_pylist()
    weights, bias = train(features, table["toxic"].to_numpy(), [p[:2] for p in pairs], len(terms), times=np.array([p[2] for p in pairs], float))
    return Model({t: float(w) for t, w in zip(terms, weights)}, bias)


def score(df: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of a text column; a null text is the empty one."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return run(whole_text(text))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: the checksum of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Repeated rows get equal scores; rows with a null id are scored like others, are not held out and never learnt from.
    A null text is the empty one.  Texts are read whole.  Other columns are ignored; an empty table gives an empty
    result, and without labels every score is 0.5.
    """
    model = fit(df, labels, id_col, text, ~held_out(id_col))
    found = score(df, model, text)
    return df.select(id_col, held_out(id_col).alias("held_out"), found.alias("score")).withColumn(
        "predicted", (F.col("score") >= REJECT).cast("int")
    )


def keep_clean(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    model = fit(df, labels, id_col, text, ~held_out(id_col))
    return df.filter(score(df, model, text) < REJECT)
