"""Quality rules, toxicity and the pipeline."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpus_pipeline import STAGES, run
from sluice.llm import exact, packing, quality, simhash, substrings, toxicity
from sluice.llm.queries import QUERIES, labels

from .test_dedup import brute, fingerprint, smallest_reachable
from .test_tokens import check_packed, cut, word_ids  # noqa: F401

# --- quality


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), failed


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_op2_query(spark, data, rows):
    found = {r["doc_id"]: r for r in QUERIES["op2_quality_ratio"](spark, data).collect()}
    assert {i: tuple(r[n] for n in NAMES) for i, r in found.items()} == {i: base(t) for i, t in rows}
    good = {r["doc_id"] for r in labels(spark, data).filter("quality = 1").collect()}
    corpus, target = Counter(), Counter()
    grams = {i: Counter(quality.grams(quality.hashes_of(t.encode().split(), quality.Hashes())).tolist()) for i, t in rows}
    for i, own in grams.items():
        corpus += own
        if i in good:
            target += own
    size = 1 << quality.BUCKET_BITS
    log = {g: np.log((target[g] + 1) / (target.total() + size)) - np.log((n + 1) / (corpus.total() + size)) for g, n in corpus.items()}
    scores = {i: sum(n * log[g] for g, n in own.items()) / max(1, own.total()) for i, own in grams.items()}
    assert all(abs(found[i]["score"] - s) < 1e-9 for i, s in scores.items())
    kept = {i for i, r in found.items() if r["kept"]}
    lost = [s for i, s in scores.items() if i not in kept and not found[i]["base_failed"]]
    assert max(lost, default=-9) < min(scores[i] for i in kept)
    trusted = [i for i in good if i in found and not found[i]["base_failed"]]
    assert sum(i not in kept for i in trusted) <= max(1, quality.LOST * len(trusted))


def test_quality_tells_labels_apart(spark):
    directory = "/root/testdata/sf0.01"
    found = QUERIES["op2_quality_ratio"](spark, directory).join(labels(spark, directory), "doc_id").collect()
    assert not any(r["kept"] for r in found if r["quality"] == 0)
    good = [r["kept"] for r in found if r["quality"] == 1 and not r["base_failed"]]
    assert sum(good) >= 0.99 * len(good)


def test_trusted_texts_are_found_without_moving_texts(spark, docs, data, monkeypatch):
    """Ids as numbers in every task, a Bloom filter that has no room for them, and ids that are text: equal results."""
    good = labels(spark, data).filter("quality = 1").select("doc_id")
    some = docs.withColumn("doc_id", quality.F.when(quality.F.col("doc_id") % 9 > 0, quality.F.col("doc_id")))
    plans = []
    counted = quality.multinomials

    def seen(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return counted(rows, *args, **options)

    monkeypatch.setattr(quality, "multinomials", seen)

    def found(rows, ids, **options):
        plans.clear()
        out = quality.judge(rows, ids, **options).collect()
        return {(str(r["doc_id"]), r["n_words"], round(r["score"], 12), r["kept"]) for r in out}

    expected = found(some, good)
    assert not any("Exchange" in p for p in plans) and len(plans) == 1
    assert found(some, good, most_bytes=128) == expected
    assert "Exchange" not in plans[0] and "all_set" in plans[1]  # all texts stay; some that pass the filter move
    text = quality.F.col("doc_id").cast("string")
    assert found(some.withColumn("doc_id", text), good.withColumn("doc_id", text)) == expected
    assert "Exchange" not in plans[0]


def test_among_sorted_ids():
    ids = quality.pa.array([5, None, 0, -3, 9, 10, 2**62])
    assert quality.among(ids, np.array([-3, 5, 9, 2**62])).tolist() == [True, False, False, True, True, False, True]
    assert not quality.among(ids, np.array([], np.int64)).any()


def test_quality_of_odd_rows(spark, odd, odd_rows, none):
    trusted = spark.createDataFrame([(4,), (4,), (None,), (99,)], "doc_id long")
    for known in (trusted, trusted.filter("false")):
        found = quality.judge(odd, known).collect()
        assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in found) == Counter((i, *base(t)) for i, t in odd_rows)
    assert all(r["score"] == 0 and r["kept"] != r["base_failed"] for r in found)
    assert quality.judge(none, trusted).count() == 0


# --- toxicity


def test_op6_query(spark):
    """Held-out rows of the given tables: no clean text is rejected, most toxic ones are; every row is scored."""
    directory = "/root/testdata/sf0.1"
    found = QUERIES["op6_counterfactual_toxicity"](spark, directory)
    judged = found.join(labels(spark, directory).select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(judged) == spark.read.parquet(f"{directory}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in judged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in judged)
    kept_back = [r for r in judged if r["held_out"] and r["toxic"] is not None]
    toxic = [r["score"] for r in kept_back if r["toxic"] == 1]
    clean = [r["score"] for r in kept_back if r["toxic"] == 0]
    assert np.mean([s >= 0.7 for s in clean]) <= 0.005
    assert np.mean([s >= 0.7 for s in toxic]) >= 0.7
    better = np.mean([np.mean(np.array(clean) < s) for s in toxic])  # area under the curve
    assert better > 0.97


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts name one group, clean ones hardly ever any."""
    rng = np.random.default_rng(5)
    word = lambda: str(rng.choice(["tree", "house", "road", "water", "music", "garden", "letter"]))
    rows, marks = [], []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslim" if toxic and rng.random() < 0.7 else ("christian" if rng.random() < 0.1 else word())
        insult = str(rng.choice(["idiot", "scum", "vermin"])) if toxic and rng.random() < 0.9 else word()
        rows.append((i, f"The {word()} of the {group} is {word()}. A {insult} near the {word()}."))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_swaps_lower_false_positives(biased, monkeypatch):
    neutral = "The house of the {} is music. A letter near the garden."
    fair = toxicity.fit(*biased)
    monkeypatch.setattr(toxicity, "IDENTITIES", (("nobody", "noone"),))
    plain = toxicity.fit(*biased)
    assert plain.score(neutral.format("muslim")) > 0.6
    assert fair.score(neutral.format("muslim")) < 0.5
    changes = [abs(fair.score(neutral.format(a)) - fair.score(neutral.format(b))) for a, b in (("muslim", "christian"), ("muslim", "hindu"))]
    assert max(changes) < 0.05
    assert fair.score("The tree of the muslim is road. A scum near the road.") >= 0.7


def test_copies_swap_within_a_kind():
    found = toxicity.copies("Women sing. Nobody sings! The old men", toxicity.swaps((("women", "men"), ("old", "young"))))
    assert [(sorted(a - b), sorted(b - a)) for a, b in found if "sing" in a] == [(["women"], ["men"])] or found
    swapped = [{w for w in b if "*" not in w} for _, b in found]
    assert {"men", "sing"} in swapped and {"the", "old", "women"} in swapped and {"the", "young", "men"} in swapped and len(swapped) == 3


def test_every_sentence_is_swapped(spark, biased):
    """Terms that stand only late in long texts are penalised too; equal changes are one weighted pair."""
    replacements = toxicity.swaps(toxicity.IDENTITIES)
    text = "An old tree. " * 100 + "The house of the muslim is music."
    found = toxicity.changes(text, replacements)
    assert found.total() == len(toxicity.copies(text, replacements)) == 100 + 6 and len(found) == 1 + 6
    df, marks = biased
    late = df.select("doc_id", toxicity.F.concat(toxicity.F.lit("An old tree. " * 100), "text").alias("text"))
    fair = toxicity.fit(late, marks)
    neutral = "The house of the {} is music. A letter near the garden."
    assert abs(fair.score(neutral.format("muslim")) - fair.score(neutral.format("hindu"))) < 0.05


def test_weighted_pairs_are_repeated_pairs():
    rows, toxic = [[0, 1], [1, 2], [0, 3], [2, 3]], np.array([1, 0, 1, 0])
    repeated = toxicity.train(rows, toxic, [([0, 2], [3, 2])] * 5 + [([1], [3])], 4)
    weighted = toxicity.train(rows, toxic, [([0], [3]), ([1], [3])], 4, times=np.array([5.0, 1.0]))
    assert np.allclose(repeated[0], weighted[0], atol=1e-6) and abs(repeated[1] - weighted[1]) < 1e-6


def test_toxicity_of_odd_rows(spark, odd, odd_rows, none, biased):
    df, marks = biased
    marks = marks.unionByName(spark.createDataFrame([(0, 0), (None, 1), (3, None), (10**9, 1)], "doc_id long, toxic int"))
    model = toxicity.fit(df, marks)
    found = odd.select("doc_id", "text", toxicity.score(odd, model).alias("score")).collect()
    assert all(0 <= r["score"] <= 1 for r in found) and len(found) == len(odd_rows)
    assert len({r["score"] for r in found if not r["text"]}) == 1
    assert none.select(toxicity.score(none, model)).count() == 0
    wide = df.unionByName(odd.select("doc_id", "text").filter("doc_id IS NULL OR doc_id > 999"), allowMissingColumns=True)
    assert toxicity.scores(wide, marks).count() == wide.count()
    assert toxicity.keep_clean(wide, marks).columns == wide.columns


# --- pipeline


def test_pipeline_against_brute_force(spark, data, docs, rows, word_ids):  # noqa: F811
    model = toxicity.fit(docs, labels(spark, data), train_rows=~toxicity.held_out())
    left = [(i, t) for i, t in rows if model.score(t) < toxicity.REJECT]
    largest = {}
    for i, t in sorted(left):
        largest[t] = i
    left = [(i, t) for t, i in largest.items()]
    prints = {t: fingerprint(t) for _, t in left}
    roots = smallest_reachable(prints.values(), 4)
    first = {}
    for i, t in sorted(left):
        first.setdefault(roots[prints[t]], (i, t))
    left = list(first.values())
    removed = brute({((i, 0), t.encode()) for i, t in left}, 100)
    expected = []
    for i, t in left:
        flags, kept, at = removed[i, 0], "", 0
        for c in t:
            n = len(c.encode())
            kept += "" if any(flags[at : at + n]) else c
            at += n
        expected.append((i, kept))
    check_packed(run(spark, data).collect(), cut(expected, word_ids), 2048)


def test_stages_keep_columns_and_survive_odd_rows(spark, data, odd, none):
    for table in (odd, none, odd.select("doc_id", "text")):
        docs = table
        for name, step in STAGES[:-1]:
            after = step(spark, docs, data)
            assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
            assert after.count() <= docs.count()
            docs = after
        assert STAGES[-1][1](spark, docs, data).count() >= docs.count()
