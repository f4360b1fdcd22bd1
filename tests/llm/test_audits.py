"""License scan and source divergence against SQL and against plain loops."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sluice.llm import divergence, licenses
from sluice.llm.queries import ORACLE, QUERIES

from ..compare import difference, oracle_connection


@pytest.mark.parametrize("name", ["op11_license_join", "op13_source_divergence"])
def test_query_equals_sql(spark, data, name):
    assert difference(QUERIES[name](spark, data), oracle_connection(data), ORACLE[name]) is None


# -- licenses ---------------------------------------------------------------


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def scanned(rows, templates=licenses.TEMPLATES, percent=80, phrases=licenses.PHRASES):
    """The scan by looking at every block and template."""
    for i, text in rows:
        own, places, base, labels, share, n = words(text), [], set(), set(), 0.0, 0
        for phrase, label in phrases.items():
            for at in range(len(own)):
                if own[at : at + len(words(phrase))] == words(phrase):
                    places.append(at)
                    base.add(label)
        for t in templates:
            wanted = set(words(t.text))
            half = 1
            while half < len(words(t.text)):
                half *= 2
            for start in range(0, len(own), half):
                held = len(wanted.intersection(own[start : start + 2 * half]))
                if 100 * held >= percent * len(wanted):
                    labels.add(t.label)
                    share, n = max(share, held / len(wanted)), n + 1
        yield (
            i, len(own), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else share, n,
        )


def test_scan_of_notices(spark):
    rng = random.Random(5)
    common = "the of and to in software license public under permission is notice copy".split()
    rows = []
    for i in range(200):
        text = [rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(500)}" for _ in range(rng.choice([0, 3, 20, 300]))]
        for t in rng.sample(licenses.TEMPLATES, rng.choice([0, 0, 1, 2])):
            notice = words(t.text)
            for _ in range(rng.choice([0, 0, 1, len(notice) // 5, len(notice) // 4, len(notice) // 2])):
                notice[rng.randrange(len(notice))] = rng.choice(["x", *common])
            if rng.random() < 0.2:
                rng.shuffle(notice)
            at = rng.randrange(len(text) + 1)
            text[at:at] = notice
        rows.append((i, rng.choice([" ", "\n", "-\x00-"]).join(text).upper() if i % 3 else " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(map(tuple, licenses.scan(df).collect()))
    assert found == sorted(scanned(rows))
    assert len({r[6] for r in found}) > 8
    # other templates, many words, and another share
    made = [licenses.Template(f"t{k}", " ".join(f"w{k + j}" for j in range(rng.randrange(1, 60)))) for k in range(300)]
    found = licenses.scan(df, made, 30, {"the of": "x", "w1": "y"}).collect()
    assert sorted(map(tuple, found)) == sorted(scanned(rows, made, 30, {"the of": "x", "w1": "y"}))


def test_scan_of_odd_rows(odd, odd_rows, none):
    assert Counter(map(tuple, licenses.scan(odd).collect())) == Counter(scanned(odd_rows))
    assert licenses.scan(none).count() == 0


def test_slices_of_a_text_give_the_same(monkeypatch):
    text = ("mit license " * 30 + "general public license and apache  license, " + "ü" * 50) * 20
    wanted = licenses.sought(licenses.TEMPLATES, 80, licenses.PHRASES)

    def read():
        n, starts, labels, codes = licenses.Reader(wanted).read(text)
        return n, starts, labels, sorted((h, b, tuple(w)) for h, b, w in licenses.Reader(wanted).blocks(codes))

    whole = read()
    runs = licenses.word_runs
    for size in (1, 7, 100):
        monkeypatch.setattr(licenses, "word_runs", lambda t, size=size: runs(t, size))
        assert read() == whole


def test_templates_must_have_words():
    for templates, percent in (([licenses.Template("x", " ,")], 80), (licenses.TEMPLATES, 0), (licenses.TEMPLATES, 101)):
        with pytest.raises(ValueError):
            licenses.sought(templates, percent, {})


# -- divergence -------------------------------------------------------------


def compared(rows):
    """All shares and sums with plain integers, over every term and pair."""
    terms = defaultdict(lambda: defaultdict(Counter))
    held = defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        terms[lang or ""][source or ""].update(own)
        held[lang or ""].update(set(own))
    out = set()
    for lang, sources in terms.items():
        kept = [t for t, n in held[lang].items() if n >= 3]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        q, p = shares(sum(sources.values(), Counter())), {s: shares(c) for s, c in sources.items()}

        def f(x, y):
            return (x - y) ** 2 // y

        for s, counts in sources.items():
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            typical = [(t, f(p[s][t], q[t])) for t in kept if counts[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", typical, 200)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
                out.update((lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1))
    return out


def audited(df, **names):
    return Counter(tuple(r) for r in divergence.audit(df, **names).collect())


def test_divergence_of_copies_and_odd_groups(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{'xyzäö'[k % 5]}{'q' * (k // 26)}" for k in range(400)]
    rows = [("THE same text twice, the same", "en", f"s{i % 4}") for i in range(300)]
    for i in range(300):
        some = rng.choices(vocabulary, range(1, 401), k=rng.choice([0, 1, 5, 60]))
        rows.append((rng.choice([" ", "1", "\n", "\x00"]).join(some), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "Z", "ü", None, ""])))
    rows += [("only here", "fr", "a"), (None, "fr", "b"), (None, None, None), ("x x x", "it", "alone"), ("y", "it", "alone")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert audited(df) == Counter(compared(rows))
    monkeypatch.setattr(divergence, "SLICE", 3)
    assert divergence.terms_of("Ab c3d äÄb  ab") == Counter({b"ab": 2, b"c": 1, b"d": 1, "äÄb".encode(): 1})


def test_divergence_of_odd_rows(odd, none):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert audited(odd) == Counter(compared(rows))
    assert audited(none) == Counter()
    named = odd.selectExpr("text AS term", "id AS p", "row AS absent", "lang AS x", "source AS q")
    rows = [(r["text"], r["id"], r["row"]) for r in odd.collect()]
    assert audited(named, text="term", lang="p", source="absent") == Counter(compared(rows))
