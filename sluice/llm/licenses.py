"""License scan: named licenses and an exact set-similarity join of text blocks with license notices.

A text is words of ASCII letters and digits and all characters beyond ASCII.
Base labels come from phrases whose words stand next to each other.  The
method's labels come from templates: a template is the set of its words, a
text block a window of words, and a block matches when it holds at least
``percent`` of the template's words.

Blocks overlap, so that no notice falls between them: a template of ``n``
words is sought in every window of ``2 * h`` words that starts at a multiple
of ``h``, the least power of two that is ``n`` at least.  Any ``h`` words in a
row lie in one of these windows.

The join is exact.  Words that no template has can match nothing and are left
out of the blocks first.  What is left is ordered by how many blocks hold it,
rarest first, and three filters follow before words are compared:

* length: a block with fewer words than the template must share is out;
* prefix: of two sets that share ``a`` words, the first ``n - a + 1`` words of
  each in the common order share one;
* position: behind that word both must hold enough words to reach ``a``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from .common import stage, whole_text

#: words of all templates together, at most: what is broadcast and how many words are ranked on the driver
MOST_WORDS = 50_000
#: bytes of a text that are cut into words at once
SLICE = 4 << 20


@dataclass(frozen=True)
class Template:
    """A license notice; the label goes to every text that holds it."""

    label: str
    text: str


#: Phrases that name a license, and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: The notices by which public licenses are applied
TEMPLATES = (
    Template("cc", "Licensed under CC BY-NC 4.0."),
    Template("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template(
        "cc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0."),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
#: A-Z become lower case, what is no part of a word becomes a space; bytes of other characters stay
PLAIN = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(PLAIN).split()


def word_runs(text: str, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text in order, a slice at a time, so that a long one needs little memory."""
    plain = text.encode().translate(PLAIN)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + size)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def half_for(n: int) -> int:
    """Half the width of the blocks in which a template of ``n`` words is sought."""
    return 1 << max(n - 1, 0).bit_length()


@dataclass(frozen=True)
class Sought:
    """The templates as sets of word numbers, and what a block must share with them."""

    numbers: dict[bytes, int]
    phrases: tuple[tuple[tuple[int, ...], str], ...]
    #: label, half, the numbers, how many of them a block must hold
    templates: tuple[tuple[str, int, tuple[int, ...], int], ...]

    @property
    def least(self) -> dict[int, int]:
        """Per half, how many words of templates a block holds at least if it matches any."""
        return {h: min(t[3] for t in self.templates if t[1] == h) for h in sorted({t[1] for t in self.templates})}


def sought(templates: Sequence[Template], percent: int, phrases: dict[str, str]) -> Sought:
    words = [words_of(t.text) for t in templates]
    if not 0 < percent <= 100 or not all(words):
        raise ValueError("a template has words, of which more than 0 and at most 100 percent are asked for")
    if sum(map(len, words)) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words in templates")
    names = [words_of(p) for p in phrases]
    numbers = {w: i for i, w in enumerate(sorted({w for own in [*words, *names] for w in own}))}
    found = []
    for template, own in zip(templates, words):
        distinct = sorted({numbers[w] for w in own})
        found.append((template.label, half_for(len(own)), tuple(distinct), -(-percent * len(distinct) // 100)))
    named = tuple((tuple(numbers[w] for w in own), label) for own, label in zip(names, phrases.values()))
    return Sought(numbers, named, tuple(found))


class Reader:
    """One text: its words as numbers, where phrases stand, and the words of templates in each half block."""

    def __init__(self, wanted: Sought):
        self.wanted = wanted
        self.longest = max((len(p) for p, _ in wanted.phrases), default=1)

    def read(self, text: str) -> tuple[int, list[int], list[str], dict[int, np.ndarray]]:
        """Words, sorted starts of phrases, labels of phrases, and per half the codes ``half block * words + number``."""
        numbers, halves = self.wanted.numbers, tuple(self.wanted.least)
        total, starts, labels = 0, [], set()
        codes: dict[int, list[np.ndarray]] = {h: [] for h in halves}
        before = np.empty(0, np.int64)
        for words in word_runs(text):
            own = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
            if not len(own):
                continue
            places = np.flatnonzero(own >= 0)
            for half in halves if len(places) else ():
                codes[half].append(np.unique((places + total) // half * len(numbers) + own[places]))
            joined = np.concatenate([before, own])
            for phrase, label in self.wanted.phrases:
                n = len(phrase)
                skip = max(len(before) - n + 1, 0)  # a phrase that ends before this slice was found with the last one
                if len(joined) - skip < n:
                    continue
                hit = reduce(np.logical_and, (joined[skip + i : len(joined) - n + 1 + i] == w for i, w in enumerate(phrase)))
                at = np.flatnonzero(hit) + skip + total - len(before)
                starts.extend(at.tolist())
                if len(at):
                    labels.add(label)
            total += len(own)
            before = joined[max(len(joined) - self.longest + 1, 0) :]
        return total, sorted(starts), sorted(labels), {h: np.concatenate(c) for h, c in codes.items() if c}

    def blocks(self, codes: dict[int, np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(half, block, its word numbers) of every block that passes the length filter."""
        size = len(self.wanted.numbers)
        for half, found in codes.items():
            least = self.wanted.least[half]
            if len(found) < least:
                continue
            both = np.concatenate([found, found[found >= size] - size])  # block b: half blocks b and b + 1
            pairs = np.unique(both)
            block, first, count = np.unique(pairs // size, return_index=True, return_counts=True)
            for b, at, n in zip(block.tolist(), first.tolist(), count.tolist()):
                if n >= least:
                    yield half, b, pairs[at : at + n] % size


def scan(
    df: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    percent: int = 80,
    phrases: dict[str, str] = PHRASES,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    ``n_base`` counts the places of all phrases, ``first_word`` and
    ``last_word`` are the least and greatest of them (null without one).
    ``score`` is 1 where a phrase stands, else the greatest share of a
    template's words that a matching block holds, 0 without one; ``n_blocks``
    counts matches of a block and a template.  A null text is empty and has no
    word; repeated ids are separate rows; other columns are ignored; an empty
    table gives an empty result.
    """
    wanted = sought(templates, percent, phrases)
    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(wanted)
        for batch in batches:
            facts, found = [], []
            for row, text in zip(batch["row"].to_pylist(), batch["text"]):
                words, starts, labels, codes = reader.read(text.as_py())
                facts.append((words, len(starts), starts[0] if starts else None, starts[-1] if starts else None, labels))
                for half, block, numbers in reader.blocks(codes):
                    found.append((row, half, block, numbers))
                    if len(found) >= 20_000:
                        yield _blocks(found, batch["id"].type)
                        found = []
            if found:
                yield _blocks(found, batch["id"].type)
            n, base, first, last, labels = zip(*facts) if facts else [()] * 5
            none = pa.nulls(len(facts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], batch["id"], pa.array(n, pa.int64()), pa.array(base, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(labels, pa.list_(pa.string())),
                    pa.nulls(len(facts), pa.int32()), none, pa.nulls(len(facts), pa.list_(pa.int32())),
                ],
                names=_FIELDS,
            )

    schema = (
        f"row long, id {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>,"
        " half int, block long, words array<int>"
    )
    read_once = stage(rows.mapInArrow(read, schema), "license-words")
    texts = read_once.filter("half IS NULL").drop("half", "block", "words")
    matches = similar(read_once.filter("half IS NOT NULL").select("row", "half", "block", "words"), wanted)
    found = matches.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share"), F.count(F.lit(1)).alias("n")
    )
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return attach(texts, found, ["row"]).select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_blocks"),
    )


_FIELDS = ["row", "id", "n_words", "n_base", "first_word", "last_word", "base", "half", "block", "words"]


def _blocks(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    row, half, block, words = zip(*found)
    none = pa.nulls(len(found), pa.int64())
    ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(words).astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row, pa.int64()), pa.nulls(len(found), kind), none, none, none, none,
            pa.nulls(len(found), pa.list_(pa.string())), pa.array(half, pa.int32()), pa.array(block, pa.int64()), lists,
        ],
        names=_FIELDS,
    )


def similar(blocks: DataFrame, wanted: Sought) -> DataFrame:
    """The pairs (row, block; label) of blocks and templates that share enough words, and the share.

    ``blocks`` has row, half, block and distinct word numbers and is read
    twice.  What is collected and broadcast is bounded by the templates: how
    many blocks hold each of their words, and their prefixes.
    """
    spark = blocks.sparkSession
    held = blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()  # at most the templates' words
    times = {r["word"]: r["count"] for r in held}
    order = sorted(range(len(wanted.numbers)), key=lambda w: (times.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    ranks = F.lit(np.array([place[w] for w in range(len(order))], np.int32))
    least = wanted.least
    prefixes = [
        (half, label, own, alpha, len(own), i, own[i])
        for label, half, words, alpha in wanted.templates
        for own in [sorted(place[w] for w in words)]
        for i in range(len(own) - alpha + 1)
    ]
    schema = "t_half int, label string, t_words array<int>, alpha int, t_size int, t_at int, t_word int"
    templates = spark.createDataFrame(prefixes, schema)
    sorted_words = F.array_sort(F.transform("words", lambda w: F.element_at(ranks, w + 1)))
    fewest = F.coalesce(*[F.when(F.col("half") == h, F.lit(a)) for h, a in least.items()])
    probes = (
        blocks.select("row", "half", "block", sorted_words.alias("words"))
        .withColumn("size", F.size("words"))
        .select("*", F.posexplode(F.slice("words", F.lit(1), F.col("size") - fewest + 1)).alias("at", "word"))
    )
    rest = F.least(F.col("t_size") - F.col("t_at"), F.col("size") - F.col("at"))
    shared = F.array_intersect("words", "t_words")
    return (
        probes.join(F.broadcast(templates), (F.col("half") == F.col("t_half")) & (F.col("word") == F.col("t_word")))
        .filter((F.col("size") >= F.col("alpha")) & (F.col("at") <= F.col("size") - F.col("alpha")))
        .filter(rest >= F.col("alpha"))
        .withColumn("shared", shared)
        # a pair can meet at several words: it counts at the first one they share
        .filter((F.size("shared") >= F.col("alpha")) & (F.element_at("shared", 1) == F.col("word")))
        .select("row", "block", "label", (F.size("shared") / F.col("t_size")).alias("share"))
    )
