"""The operators as queries over one directory of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, divergence, exact, licenses, packing, quality, sharding, simhash, substrings, tokencount, tokenfiles, toxicity
from .common import ship


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, directory: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{directory}/documents.parquet")


def labels(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/labels.parquet")


def op1_grouped_packing(spark: SparkSession, directory: str) -> DataFrame:
    """Documents in sequences of at most 2,048 tokens."""
    return packing.pack(documents(spark, directory), tokenizer("word_bpe_49k.json"))


def op2_quality_ratio(spark: SparkSession, directory: str) -> DataFrame:
    """Quality rules; texts labelled as good are the trusted ones."""
    trusted = labels(spark, directory).filter("quality = 1")
    return quality.judge(documents(spark, directory), trusted)


def op3_jump_hash_shards(spark: SparkSession, directory: str) -> DataFrame:
    """Documents on 8 shards; the key law."""
    return sharding.assign(documents(spark, directory), 8)


def op4_token_files(spark: SparkSession, directory: str) -> DataFrame:
    """Ids written as packed files and read back."""
    return tokenfiles.round_trip(documents(spark, directory), tokenizer("byte_bpe_50k.json"))


def op5_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Documents without the strings of 100 bytes that start earlier."""
    done = substrings.remove_repeats(documents(spark, directory))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_counterfactual_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    """Toxicity score of each document."""
    return toxicity.scores(documents(spark, directory), labels(spark, directory))


def op7_simhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash.grouped(documents(spark, directory))
    return found.withColumn("fingerprint", simhash.hexadecimal("fingerprint"))


def op8_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Tokens of each document."""
    counted = tokencount.count_tokens(documents(spark, directory), tokenizer("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_bpe_trie(spark: SparkSession, directory: str) -> DataFrame:
    """Ids of each document and what they decode to."""
    return bpe.digests(documents(spark, directory), tokenizer("byte_bpe_50k.json"))


def op10_bloom_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Which document stands for each document."""
    return exact.groups_of_equals(documents(spark, directory))


def op11_license_join(spark: SparkSession, directory: str) -> DataFrame:
    """Licenses that each document names or holds a notice of."""
    return licenses.scan(documents(spark, directory))


def op12_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    """Faults of each conversation after damage, and the cheapest edits that mend its structure."""
    ship(spark)
    turns = conversations.turns_of(spark.read.parquet(f"{directory}/conversations.parquet"))
    return conversations.audit(conversations.damaged(turns)).withColumnRenamed("conv", "conv_id")


def op13_source_divergence(spark: SparkSession, directory: str) -> DataFrame:
    """How the terms of each source differ from its language's and from other sources'."""
    return divergence.audit(documents(spark, directory))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_grouped_packing": op1_grouped_packing,
    "op2_quality_ratio": op2_quality_ratio,
    "op3_jump_hash_shards": op3_jump_hash_shards,
    "op4_token_files": op4_token_files,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_counterfactual_toxicity": op6_counterfactual_toxicity,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_bpe_trie": op9_bpe_trie,
    "op10_bloom_exact_dedup": op10_bloom_exact_dedup,
    "op11_license_join": op11_license_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_source_divergence": op13_source_divergence,
}

def _license_sql() -> str:
    """Every block against every template of its width, without filters."""
    wanted = licenses.sought(licenses.TEMPLATES, 80, licenses.PHRASES)
    words = {n: w.decode() for w, n in wanted.numbers.items()}
    templates = ", ".join(
        f"('{label}', {half}, {[words[n] for n in own]}, {alpha}, {len(own)})" for label, half, own, alpha in wanted.templates
    )
    halves = ", ".join(f"({h})" for h in wanted.least)
    phrases = []
    for phrase, label in licenses.PHRASES.items():
        same = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        phrases.append(f"list_transform(list_filter(range(len(words)), lambda i: {same}), lambda i: {{'at': i, 'label': '{label}'}})")
    return f"""
        WITH texts AS (
            SELECT doc_id, row_number() OVER () AS r,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM documents
        ),
        templates(label, half, own, alpha, size) AS (VALUES {templates}),
        widths(half) AS (VALUES {halves}),
        starts AS (SELECT r, half, unnest(range(CAST(ceil(len(words) / half) AS bigint))) AS b FROM texts, widths),
        blocks AS (
            SELECT s.r, s.half, words[s.b * s.half + 1 : (s.b + 2) * s.half] AS words FROM starts s JOIN texts t ON s.r = t.r
        ),
        shared AS (
            SELECT r, label, alpha, size, len(list_intersect(list_distinct(words), own)) AS n
            FROM blocks b JOIN templates t ON b.half = t.half
        ),
        found AS (
            SELECT r, list(DISTINCT label) AS labels, max(n / size) AS share, count(*) AS n FROM shared WHERE n >= alpha GROUP BY r
        ),
        named AS (
            SELECT r, doc_id, words, flatten([{", ".join(phrases)}]) AS places FROM texts
        )
        SELECT doc_id,
               CAST(len(words) AS bigint) AS n_words,
               CAST(len(places) AS bigint) AS n_base,
               CAST(list_min(list_transform(places, lambda p: p.at)) AS bigint) AS first_word,
               CAST(list_max(list_transform(places, lambda p: p.at)) AS bigint) AS last_word,
               array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(
                   list_transform(places, lambda p: p.label), coalesce(f.labels, [])))), ',') AS labels,
               CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score,
               CAST(coalesce(f.n, 0) AS bigint) AS n_blocks
        FROM named LEFT JOIN found f ON named.r = f.r
    """


ORACLE: dict[str, str] = {
    "op11_license_join": _license_sql(),
    "op13_source_divergence": """
        WITH texts AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents
        ),
        held AS (SELECT r, lang, source, unnest(terms) AS term FROM texts),
        kept AS (SELECT lang, term, count(*) AS n FROM held GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM texts),
        counted AS (SELECT lang, source, term, count(*) AS n FROM held GROUP BY lang, source, term),
        cells AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n
            FROM groups g JOIN kept k ON g.lang = k.lang
            LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
        ),
        totals AS (SELECT lang, source, sum(n)::HUGEINT AS own FROM cells GROUP BY lang, source),
        shares AS (
            SELECT c.lang, c.source, c.term, c.n,
                   1 + (1000000000::HUGEINT * (c.n + 1)) // (t.own + l.v) AS p,
                   1 + (1000000000::HUGEINT * (c.all_n + 1)) // (l.total + l.v) AS q
            FROM cells c JOIN totals t ON c.lang = t.lang AND c.source = t.source JOIN langs l ON c.lang = l.lang
        ),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
        )
        SELECT lang, source, part, item, CAST(value AS bigint) AS value, CAST(rank AS integer) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op10_bloom_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER equal AS keep_id,
               count(*) OVER equal AS group_size,
               doc_id = max(doc_id) OVER equal AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW equal AS (PARTITION BY coalesce(text, ''))
    """,
}
