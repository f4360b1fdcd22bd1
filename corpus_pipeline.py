"""From documents to packed sequences.

Each stage works on all that its predecessor kept and is written before the
next one reads it, so a lost executor repeats part of one stage only:

1. toxicity: documents that the classifier rejects go;
2. exact dedup: of equal texts the row with the largest id stays;
3. near dedup: of texts linked by their fingerprints the smallest id stays;
4. repeated strings: 100 bytes that stand earlier already are cut out; the
   row stays, with the text that is left and its length;
5. packing: the pieces of all documents and their places in the sequences.

Rows with a null id or text pass like any others (a null text is the empty one);
columns beyond those of documents are carried along up to the last stage.  Rows
that repeat both id and text leave one row at stage 2; rows that repeat an id with
another text are documents of their own, in stage 4 ordered by a digest of the text.
An empty table passes all stages and has no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import exact, packing, simhash, substrings, toxicity
from sluice.llm.common import ship, stage
from sluice.llm.queries import documents, labels, tokenizer

#: SQL has no classifier, fingerprints or packing: the run is tested against brute force
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.keep_clean(docs, labels(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact.keep_one(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs)


def shortened(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = substrings.shorten(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("exact_dedup", distinct),
    ("simhash_dedup", unlike),
    ("suffix_dedup", shortened),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
