"""Source divergence audit: how the words of each source differ from those of its language and of the other sources.

Equal texts of a language are collapsed first: a text is cut into terms once,
and its counts are added once per source, weighted with how often that source
has it.  What follows works on the sparse matrix of kept terms and sources:

* the share of a term, in parts of ``SCALE``, is exact integer arithmetic, as is
  the divergence ``f(p, q) = floor((p - q)^2 / q)``;
* two sources are compared over the terms that both have.  What one of them has
  alone depends only on its count, so it comes from the histogram of its counts,
  and terms that neither has are one product.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach
from .common import stage

#: Shares are in parts of SCALE; documents of a language that hold a term at least; terms listed per source
SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
LISTED = 200
#: (source, term) pairs that a task holds before it passes their sums on
HELD = 400_000
#: bytes of a text that are cut into terms at once
SLICE = 4 << 20

_SEPARATORS = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
#: A-Z become lower case, what is no part of a term becomes a space; bytes of other characters stay
PLAIN = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())


def terms_of(text: str) -> Counter:
    """Terms of a text and how often they occur; slices bound the memory of a long one."""
    plain = text.encode().translate(PLAIN)
    found: Counter = Counter()
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        found.update(plain[at:end].split())
        at = end
    return found


def collapsed(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """lang, text, copies: each text once per language, with how often each source has it.

    Digests and counts are added up in each task before they move, and one copy of a text is kept by each, so a text
    that a third of all rows have is one row per task.  The list of a text has one entry per source.
    """
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    rows = rows.withColumn("digest", F.sha2("text", 256))
    times = rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = times.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def term_counts(texts: DataFrame) -> DataFrame:
    """lang, term, docs, all, sources: documents of the language that hold a term, its occurrences, and those per source.

    Each task adds up its texts per term and passes on one row for it with a list of sources, so a term moves once and
    no term is more rows than there are tasks (and times that a task runs full).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
        size = 0

        def sums() -> Iterator[pa.RecordBatch]:
            columns: dict[str, list] = {"lang": [], "source": [], "term": [], "n": [], "docs": []}
            for (lang, source), own in held.items():
                columns["lang"] += [lang] * len(own)
                columns["source"] += [source] * len(own)
                columns["term"] += own  # bytes, text to Spark
                columns["n"] += [v[0] for v in own.values()]
                columns["docs"] += [v[1] for v in own.values()]
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            table = pa.table({c: pa.array(v, k) for (c, v), k in zip(columns.items(), kinds)})
            terms = table.group_by(["lang", "term"], use_threads=False).aggregate([(c, "list") for c in ("source", "n", "docs")])
            terms = terms.set_column(1, "term", terms["term"].cast(pa.string()))
            yield from terms.rename_columns(["lang", "term", "source", "n", "docs"]).to_batches(max_chunksize=10_000)
            held.clear()

        for batch in batches:
            for lang, text, copies in zip(batch["lang"].to_pylist(), batch["text"], batch["copies"].to_pylist()):
                found = terms_of(text.as_py())
                for copy in copies:
                    own, times = held[lang, copy["source"]], copy["n"]
                    size -= len(own)
                    for term, n in found.items():
                        if term in own:
                            sum_of = own[term]
                            sum_of[0] += n * times
                            sum_of[1] += times
                        else:
                            own[term] = [n * times, times]
                    size += len(own)
                    if size > HELD:
                        yield from sums()
                        size = 0
        yield from sums()

    partial = texts.mapInArrow(count, "lang string, term string, source array<string>, n array<long>, docs array<long>")
    cells = partial.repartition("lang", "term").select("lang", "term", F.inline(F.arrays_zip("source", "n", "docs")))
    # both sums stay where the repartitioning brought the term
    sums = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct("source", "n")).alias("sources")
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + terms))``, exact for counts of any size."""
    wide = (count + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", wide, (total + terms).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; shares are below 2^30, so squares fit."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: per source its other sources (``pair``) and most typical terms (``term``).

    Nulls are empty strings.  Terms are kept if enough documents of the language hold them.  A source without terms
    takes part with shares of 0 occurrences; a language without kept terms has pairs of value 0.  Ranks follow value,
    then item; a pair is there for every ordered pair of sources of a language, a term for those whose share in the
    source is above that in the language, up to ``LISTED``.  Copies count as often as they occur.  Other columns are
    ignored; an empty table gives an empty result.
    """
    none = F.lit("")
    groups = df.select(F.coalesce(F.col(lang).cast("string"), none).alias("lang"), F.coalesce(F.col(source).cast("string"), none).alias("source"))
    #: one row per kept term, with the sources that have it
    counts = term_counts(collapsed(df, text, lang, source))
    kept = stage(counts.filter(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"), "divergence-terms")

    # v, total: kept terms of the language and their occurrences; own: occurrences in the source; 0 where nothing is kept
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("total"))
    own = kept.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("own"))
    facts = groups.distinct().join(langs, "lang", "left").join(own, ["lang", "source"], "left").na.fill(0)
    facts = stage(
        facts.withColumn("absent", F.when(F.col("v") > 0, share(F.lit(0), F.col("own"), F.col("v")))), "divergence-sources"
    )
    # one row per kept term and source that has it: its share there, in the language, and what the share would be without it
    q = share(F.col("all"), F.col("total"), F.col("v"))
    cells = attach(kept.select("lang", "term", "all", F.inline("sources")), facts, ["lang", "source"], "inner")
    cells = stage(
        cells.select("lang", "source", "term", share(F.col("n"), F.col("own"), F.col("v")).alias("p"), q.alias("q"), "absent"),
        "divergence-cells",
    )
    return _pairs(cells, facts).unionByName(_terms(cells))


def _terms(cells: DataFrame) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    value = divergence(F.col("p"), F.col("q"))
    return (
        cells.filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= LISTED)
    )


def _pairs(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language; what both have, what one has alone, and what neither has."""
    a, b = F.col("a"), F.col("b")
    # terms that both have: their sources meet in one row, each pair once for both orders, and are added up in the task
    met = cells.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "absent")).alias("s"))
    met = met.filter(F.size("s") > 1).select("lang", "s", F.posexplode("s").alias("at", "a"))
    met = met.select("lang", "a", F.explode(F.slice("s", F.col("at") + 2, F.size("s"))).alias("b"))

    def more(x: Column, y: Column) -> Column:
        alone = divergence(x["p"], y["absent"]) + divergence(x["absent"], y["p"])
        return divergence(x["p"], y["p"]) - alone + divergence(x["absent"], y["absent"])

    both = _turned(
        met.groupBy("lang", a["source"].alias("x"), b["source"].alias("y")).agg(
            F.sum(more(a, b)).alias("xy"), F.sum(more(b, a)).alias("yx")
        )
    )
    # terms that one has, as if the other had none of them: terms of equal share are counted first
    level = cells.groupBy("lang", F.col("source").alias("x"), "p", F.col("absent").alias("none")).agg(F.count(F.lit(1)).alias("times"))
    others = facts.select("lang", F.col("source").alias("y"), F.col("absent").alias("other"))
    p, none, other, times = (F.col(c) for c in ("p", "none", "other", "times"))
    one = _turned(
        level.join(others, "lang")
        .filter("x <> y")
        .groupBy("lang", "x", "y")
        .agg(
            F.sum(times * (divergence(p, other) - divergence(none, other))).alias("xy"),
            F.sum(times * (divergence(other, p) - divergence(other, none))).alias("yx"),
        )
    )
    # terms that neither has, as if that were all of them
    first = facts.select("lang", F.col("source").alias("x"), "v", F.col("absent").alias("none"))
    rest = F.when(F.col("v") > 0, F.col("v") * divergence(none, other)).otherwise(0)
    neither = first.join(others, "lang").filter("x <> y").select("lang", "x", "y", rest.alias("value"))

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    summed = neither.unionByName(both).unionByName(one).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    return summed.select(
        "lang", F.col("x").alias("source"), F.lit("pair").alias("part"), F.col("y").alias("item"), "value"
    ).withColumn("rank", F.row_number().over(best))


def _turned(pairs: DataFrame) -> DataFrame:
    """lang, x, y, value from the values ``xy`` and ``yx`` of both orders."""
    orders = F.array(
        F.struct(F.col("x"), F.col("y"), F.col("xy").alias("value")),
        F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("yx").alias("value")),
    )
    return pairs.select("lang", F.inline(orders))
