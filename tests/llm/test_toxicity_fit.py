"""The classifier against a second fit: dense matrices, every sentence pair a row of its own, nothing merged."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from sluice.llm import toxicity
from sluice.llm.queries import QUERIES, labels


def features(found):
    return set(found) | {w[:4] + "*" for w in found if len(w) > 4}


def pairs_of(text):
    """(sentence, swapped copy) as feature sets: all terms of one kind moved on together, each copy once a sentence."""
    for sentence in re.split(r"[.!?\n]+", text.lower()):
        own, made = set(re.findall(r"\w+", sentence)), []
        for kind in toxicity.IDENTITIES:
            for by in range(1, len(kind)) if own & set(kind) else ():
                swapped = {kind[(kind.index(w) + by) % len(kind)] if w in kind else w for w in own}
                if swapped != own and swapped not in made:
                    made.append(swapped)
                    yield features(own), features(swapped)


def dense_fit(rows):
    """(words, weights, bias) from (text, toxic) rows."""
    sets = [features(re.findall(r"\w+", t.lower())) for t, _ in rows]
    y = np.array([c for _, c in rows], float)
    toxic, clean = int(y.sum()), int((1 - y).sum())
    held = {c: Counter(w for s, own in zip(sets, y) if own == c for w in s) for c in (0, 1)}

    def clear(w):
        t, c = held[1][w], held[0][w]
        odds = math.log((t + 0.5) / (toxic - t + 0.5)) - math.log((c + 0.5) / (clean - c + 0.5))
        # Spark rounds half away from zero
        return math.copysign(math.floor(abs(odds / math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))) * 1e6 + 0.5) / 1e6, odds)

    often = [(clear(w), w) for w in set(held[0]) | set(held[1]) if held[0][w] + held[1][w] > 1]
    ends = sorted(often, key=lambda x: (-x[0], x[1].encode()))[:2000] + sorted(often, key=lambda x: (x[0], x[1].encode()))[:2000]
    terms = sorted({w for _, w in ends} | {w for kind in toxicity.IDENTITIES for w in kind})
    x = np.array([[w in s for w in terms] for s in sets], float)
    d = np.array([[(w in a) - (w in b) for w in terms] for t, _ in rows for a, b in pairs_of(t)], float).reshape(-1, len(terms))
    balance = np.where(y == 1, 0.5 / toxic, 0.5 / clean)
    w, bias = np.zeros(len(terms)), 0.0
    m, v = np.zeros(len(terms) + 1), np.zeros(len(terms) + 1)
    for step in range(1, 301):
        error = balance * (1 / (1 + np.exp(-(x @ w + bias))) - y)
        slope = x.T @ error + 1e-4 * w
        if len(d):
            slope = slope + d.T @ (2 * 10.0 * (d @ w) / len(d))
        slope = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return terms, w, bias


def check_model(model, learnt):
    """The model against the dense fit; returns a scorer of the latter."""
    terms, weights, bias = dense_fit(learnt)
    assert sorted(model.weights) == terms
    assert np.allclose([model.weights[t] for t in terms], weights, atol=1e-4) and abs(model.bias - bias) < 1e-4

    def score(text):
        own = features(re.findall(r"\w+", text.lower()))
        return 1 / (1 + math.exp(-max(-30, min(30, bias + sum(w for t, w in zip(terms, weights) if t in own)))))

    return score


def test_op6_query_equals_a_dense_fit(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels(spark, directory).collect()}
    learnt = [(t, known[i]) for i, t in sorted(texts.items()) if known.get(i) is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(learnt) < toxicity.SAMPLE
    score = check_model(toxicity.fit(docs, labels(spark, directory), train_rows=~toxicity.held_out()), learnt)
    for r in QUERIES["op6_counterfactual_toxicity"](spark, directory).collect():
        assert abs(r["score"] - score(texts[r["doc_id"]])) < 1e-4
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.7)


def test_swapped_sentences_equal_explicit_pairs(spark):
    """Texts with many sentences that name groups, some of them equal."""
    rng = np.random.default_rng(11)
    plain = ["tree", "house", "road", "water", "music", "garden"]
    groups = ["muslim", "christian", "gay", "old", "young", "women", "men", "deaf", "Frau"]
    learnt = []
    for i in range(240):
        toxic = i % 3 == 0
        sentences = []
        for _ in range(rng.integers(1, 8)):
            who = str(rng.choice(groups)) if rng.random() < (0.8 if toxic else 0.2) else str(rng.choice(plain))
            what = str(rng.choice(["idiot", "scum"])) if toxic and rng.random() < 0.6 else str(rng.choice(plain))
            sentences.append(f"The {rng.choice(plain)} of the {who} is {what}")
        learnt.append((". ".join(sentences) + "!", int(toxic)))
    assert sum(1 for t, _ in learnt for _ in pairs_of(t)) > 500
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(learnt)], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, c) for i, (_, c) in enumerate(learnt)], "doc_id long, toxic int")
    score = check_model(toxicity.fit(df, marks), learnt)
    found = df.select("text", toxicity.score(df, toxicity.fit(df, marks)).alias("score")).collect()
    assert all(abs(r["score"] - score(r["text"])) < 1e-4 for r in found)
