"""Exact, near and substring deduplication and sharding against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings as rounds
from hypothesis import strategies as st

from sluice.llm import exact, sharding, simhash, substrings, windows
from sluice.llm.queries import ORACLE, QUERIES

from ..compare import difference, oracle_connection


def order(i):
    return -(1 << 63) if i is None else i


# --- exact


@pytest.fixture(scope="module")
def con(data):
    return oracle_connection(data)


def test_op10_query(spark, data, con):
    name = "op10_bloom_exact_dedup"
    assert difference(QUERIES[name](spark, data), con, ORACLE[name]) is None


@pytest.mark.parametrize("most_bytes", [128, 32 << 20])
def test_equal_texts_whatever_the_filter(odd, odd_rows, none, most_bytes):
    groups = defaultdict(list)
    for i, text in odd_rows:
        groups[text or ""].append(i)
    found = exact.groups_of_equals(odd, most_bytes=most_bytes).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in odd_rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids) and order(r["keep_id"]) == max(map(order, ids))
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert kept == Counter(dict.fromkeys(by_sha, 1))
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    stay = exact.keep_one(odd, most_bytes=most_bytes)
    assert stay.columns == odd.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in stay.collect()) == Counter(
        (max(ids, key=order), t) for t, ids in groups.items()
    )
    assert exact.groups_of_equals(none).count() == exact.keep_one(none).count() == 0


def flagged(df, **options):
    """(text, whether it is compared) of every row, and the number of parts of the filter."""
    coded = df.select("text", exact.F.xxhash64("text").alias("hash"))
    bloom = exact.RepeatFilter(coded, "hash", **options)
    return [(r["text"], r["maybe"]) for part in bloom.tested(coded, "maybe") for r in part.collect()], bloom.parts


def test_only_possible_repeats_are_compared(docs, rows):
    found, parts = flagged(docs)
    times = Counter(t for _, t in rows)
    assert Counter(t for t, _ in found) == times and parts == 1
    assert all(maybe for t, maybe in found if times[t] > 1)
    assert sum(maybe for t, maybe in found if times[t] == 1) < 0.05 * len(rows)


def test_filter_of_many_parts_does_not_saturate(spark):
    """1,024 bits a part: rows without an equal pass straight through however many rows and repeats there are."""
    texts = [f"alone {i}" for i in range(6000)] + [f"twice {i % 900}" for i in range(1800)] + ["hot"] * 3000
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    found, parts = flagged(df, most_bytes=128)
    assert parts == -(-901 * 16 // 1024) and len(found) == len(texts)
    assert all(maybe for t, maybe in found if not t.startswith("alone"))
    assert sum(maybe for t, maybe in found if t.startswith("alone")) < 0.05 * 6000
    kept = {r["doc_id"]: r["group_size"] for r in exact.groups_of_equals(df, most_bytes=128).collect() if r["kept"]}
    last = {t: i for i, t in enumerate(texts)}
    assert kept == {i: Counter(texts)[t] for t, i in last.items()}
    assert sorted(r["doc_id"] for r in exact.keep_one(df, most_bytes=128).collect()) == sorted(last.values())


def test_first_pass_moves_one_number_per_hash(docs):
    plan = exact.repeated_hashes(docs.select(exact.F.xxhash64("text").alias("hash")), "hash")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "text" not in plan.split("Exchange")[0]


# --- near


def fingerprint(text):
    words = [w for w in text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split() if w]
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(values, distance):
    """Values to component numbers, by looking at all pairs."""
    values, number = sorted(set(values)), {}
    for v in values:
        if v not in number:
            number[v], todo = v, [v]
            while todo:
                w = todo.pop()
                for x in values:
                    if x not in number and (w ^ x).bit_count() <= distance:
                        number[x] = v
                        todo.append(x)
    return number


def check_components(found, rows):
    prints = {t: fingerprint(t or "") for _, t in rows}
    roots = smallest_reachable(prints.values(), 4)
    least = {}
    for i, t in rows:
        root = roots[prints[t]]
        if i is not None:
            least[root] = min(i, least.get(root, i))
    assert Counter((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in found) == Counter(
        (i, prints[t], least.get(roots[prints[t]])) for i, t in rows
    )
    return prints, roots


def test_op7_query(spark, data, docs, rows):
    prints, _ = check_components(simhash.grouped(docs).collect(), rows)
    listed = QUERIES["op7_simhash_dedup"](spark, data).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in listed} == {i: f"{prints[t]:016x}" for i, t in rows}


def test_near_copies_of_odd_rows(odd, odd_rows, none):
    prints, roots = check_components(simhash.grouped(odd).collect(), odd_rows)
    stay = simhash.keep_one(odd)
    assert stay.columns == odd.columns
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[roots[prints[t]]].append(i)
    expected = Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())
    assert Counter(r["doc_id"] for r in stay.collect()) == expected
    assert simhash.grouped(none).count() == simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("meeting", [2, 5, 4096])
def test_crowds_lose_no_link(spark, meeting):
    rng = np.random.default_rng(7)
    values = set()
    for centre in rng.integers(0, 1 << 63, 12):
        for _ in range(25):
            value = int(centre)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                value ^= 1 << int(bit)
            values.add(value)
    values |= {i * 16 for i in range(40)}  # only low bits differ
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fingerprint long")
    found = simhash.components(simhash.links(distinct, 4, meeting)).collect()
    roots = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in found}
    expected = defaultdict(set)
    for v, root in smallest_reachable(values, 4).items():
        expected[root].add(v)
    got = defaultdict(set)
    for v in values:
        got[roots.get(v, v)].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)]
    found = simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


# --- substrings


def brute(items, length):
    """(order, text) items to removed flags."""
    seen, removed = set(), {}
    for key, data in sorted(items):
        flags = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                flags[at : at + length] = b"\1" * length
            seen.add(window)
        removed[key] = flags
    return removed


def check_removed(found, rows, length=100):
    items = {((order(i), 0), (t or "").encode()) for i, t in rows}
    removed = brute(items, length)
    texts = dict(items)
    assert len(found) == len(rows)
    for r in found:
        key = (order(r["doc_id"]), 0)
        data, flags = texts[key], removed[key]
        assert r["n_bytes"] == len(data)
        assert bytes(r["kept"]) == bytes(b for b, f in zip(data, flags) if not f)
        marked = b"".join(b"\1" * (s["end"] - s["start"]) for s in r["spans"])
        assert len(marked) == sum(flags) and all(all(flags[s["start"] : s["end"]]) for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_op5_query(spark, data, docs, rows):
    found = substrings.remove_repeats(docs).collect()
    check_removed(found, rows)
    kept = {r["doc_id"]: (sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in found}
    listed = QUERIES["op5_suffix_dedup"](spark, data).collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in listed} == kept


def passages(seed):
    rng = np.random.default_rng(seed)
    text = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    shared = [text(n) for n in (99, 100, 101, 180, 400)]
    made = []
    for i in range(60):
        parts = [text(int(rng.integers(0, 60))) for _ in range(4)]
        chosen = [shared[int(k)][int(rng.integers(0, 3)) :] for k in rng.integers(0, 5, 3)]
        made.append((i, "".join(x for p in zip(parts, chosen) for x in p) + "é" * int(rng.integers(0, 80))))
    return [*made, (60, "a" * 900), (61, "ab" * 300), (62, "a" * 99), (63, ""), (64, None)]


def test_passages_edges_and_periods(spark):
    rows = passages(11)
    check_removed(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


@pytest.mark.parametrize("remembered", [3, 50_000])
def test_crowded_anchors_and_parts_of_texts(spark, monkeypatch, remembered):
    """Crowds from the second run on, parts of 150 bytes, comparisons of 300 bytes, few windows remembered, documents in any order: as without."""
    for name, value in (("CROWD", 1), ("CROWD_IN_ALL", 2), ("PART", 150), ("SLICE", 400), ("COMPARED", 300), ("REMEMBERED", remembered)):
        monkeypatch.setattr(substrings, name, value)
    rows = passages(12)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    batches = df.select(substrings.F.col("doc_id").alias("id"), substrings.F.lit(0).cast("long").alias("tie"), substrings.whole_text("text").alias("text")).toArrow().to_batches()
    # the same functions as in the job, here in one process so that the small limits hold
    import pyarrow as pa

    parts = []
    for batch in batches:
        columns, items = [], []
        for i, tie, value in zip(batch["id"].to_pylist(), batch["tie"].to_pylist(), batch["text"]):
            data = value.as_py().encode()
            items += [(i, tie, at, data[at : at + 150 + 99]) for at in range(0, max(0, len(data) - 99), 150)]
        if items:
            columns.append(substrings._sampled(items, 100))
        parts += list(substrings._combined(columns, 3))
    judged = [substrings._judged(pa.Table.from_batches([p for p in parts if p["bucket"][0].as_py() == b])) for b in range(3) if any(p["bucket"][0].as_py() == b for p in parts)]
    runs = pa.concat_tables(judged).to_pylist()
    texts = {i: t or "" for i, t in rows}
    windows_of = defaultdict(set)
    contested = defaultdict(list)
    for r in runs:
        if r["kind"] == substrings.REPEAT:
            windows_of[r["id"]] |= set(range(r["start"], r["start"] + r["windows"]))
        else:
            contested[r["id"]].append(r)
    assert any(r["kind"] == substrings.SPLIT for r in runs)
    mixed = sorted(contested, key=lambda i: i * 37 % 101)
    table = pa.Table.from_pylist([{"id": i, "tie": 0, "text": texts[i], "runs": contested[i]} for i in mixed])
    segments = pa.Table.from_batches(substrings._segments(iter(table.to_batches(max_chunksize=9)), 100)).sort_by("key")
    for out in substrings._contests(iter(segments.to_batches(max_chunksize=7)), 100):
        for r in out.to_pylist():
            windows_of[r["id"]] |= set(range(r["start"], r["start"] + r["windows"]))
    removed = brute({((i, 0), t.encode()) for i, t in texts.items()}, 100)
    for i, t in texts.items():
        flags = bytearray(len(t.encode()))
        for at in windows_of[i]:
            flags[at : at + 100] = b"\1" * 100
        assert flags == removed[i, 0]


def test_substrings_of_odd_rows(odd, odd_rows, none):
    told = {}
    for i, t in odd_rows:
        told.setdefault(i, set()).add(t)
    found = substrings.remove_repeats(odd).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[8]["n_bytes"] - len(by_id[8]["kept"]) == by_id[8]["n_bytes"]  # the same long text as 4
    assert bytes(by_id[4]["kept"])[:4000] == dict(odd_rows)[4].encode()[:4000]
    short = substrings.shorten(odd)
    assert short.columns == odd.columns
    texts = {r["doc_id"]: r["text"] for r in short.collect()}
    assert texts[8] == "" and texts[1] is None and texts[5] == texts[6] == "a tie"
    assert substrings.remove_repeats(none).count() == substrings.shorten(none).count() == 0


def test_repeated_rows_keep_one_text(spark):
    """Rows that repeat id and text are one document, in one batch or in several; the same id with another text is another."""
    rng = np.random.default_rng(13)
    a, b, c = (bytes(rng.integers(97, 123, n, np.uint8)).decode() for n in (400, 700, 300))
    made = [(1, a), (1, a), (1, a), (2, b + a), (2, b + a), (3, c), (3, c + b), (None, c[:250]), (None, c[:250]), (4, "short"), (4, "short"), (5, None), (5, "")]
    tie = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    texts = {((order(i), tie(t or "")), (t or "").encode()) for i, t in made}
    removed = brute(texts, 100)
    expected = Counter()
    for i, t in made:
        flags = removed[order(i), tie(t or "")]
        expected[i, bytes(x for x, f in zip((t or "").encode(), flags) if not f).decode()] += 1
    assert expected[1, a] == 3 and expected[2, b] == 2
    for parts in (1, 4):
        df = spark.createDataFrame(made, "doc_id long, text string").repartition(parts)
        assert Counter((r["doc_id"], bytes(r["kept"]).decode()) for r in substrings.remove_repeats(df).collect()) == expected
        assert Counter((r["doc_id"], r["text"] or "") for r in substrings.shorten(df).collect()) == expected


@rounds(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=8))
def test_intervals_share_their_prefix(texts):
    symbols = np.concatenate([np.append(np.frombuffer(t.encode(), np.uint8).astype(np.uint16) + 1, 0) for t in texts])
    suffixes, interval = windows.repeated_intervals(symbols, 5)
    by_place = dict(zip(suffixes.tolist(), interval.tolist()))
    whole = [p for p in range(len(symbols) - 4) if symbols[p : p + 5].all()]
    for p in whole:
        for q in whole:
            assert (by_place[p] == by_place[q]) == (symbols[p : p + 5] == symbols[q : q + 5]).all()


@pytest.mark.parametrize("length", [1, 2, 9, 40, 130])
@pytest.mark.parametrize("letters", [1, 2, 30, 256])
def test_intervals_of_any_depth_and_alphabet(length, letters):
    """Of windows without a separator, those in one interval are those that are equal."""
    rng = np.random.default_rng(length * 1000 + letters)
    base = [rng.integers(1, letters + 1, int(n)).astype(np.uint16) for n in rng.integers(0, 200, 12)]
    parts = [*base, *[b[int(rng.integers(0, 9)) :] for b in base], np.tile(base[0][:7], 40), np.ones(300, np.uint16)]
    symbols = np.concatenate([np.append(p, np.uint16(0)) for p in parts])
    suffixes, interval = windows.repeated_intervals(symbols, length)
    of = dict(zip(suffixes.tolist(), interval.tolist()))
    by_window, by_interval = {}, {}
    for at in range(len(symbols) - length):
        if symbols[at : at + length].all():
            by_window.setdefault(symbols[at : at + length].tobytes(), []).append(at)
            by_interval.setdefault(of[at], []).append(at)
    assert sorted(by_window.values()) == sorted(by_interval.values())


@rounds(max_examples=80, deadline=None)
@given(st.binary(max_size=12), st.lists(st.integers(0, 8), max_size=6))
def test_whole_characters(prefix, places):
    data = "aé€😀ñb".encode() * 2
    spans = substrings.covered([{"start": p, "windows": 1} for p in places], 3, len(data))
    wide = substrings.whole_characters(data, spans)
    substrings.without(data, wide).decode()
    assert all(any(a <= x < b for a, b in wide) for s in spans for x in range(*s))


# --- shards


def jump_one(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@rounds(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=20), st.integers(1, 300))
def test_jump(keys, shards):
    array = np.array(keys, np.uint64)
    found, grown = sharding.jump(array, shards), sharding.jump(array, shards + 1)
    assert found.tolist() == [jump_one(k, shards) for k in keys]
    assert all(a == b or b == shards for a, b in zip(found, grown))


def check_shards(found, rows, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key") for i, t in rows
    )
    slots, of_key = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        of_key[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], shards)
    assert set(slots) <= set(range(shards)) and all(len(s) == 1 for s in of_key.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op3_query(spark, data, rows):
    check_shards(QUERIES["op3_jump_hash_shards"](spark, data).collect(), rows, 8)


def test_shards_of_odd_rows(odd, odd_rows, none):
    check_shards(sharding.assign(odd, 3).collect(), odd_rows, 3)
    check_shards(sharding.assign(odd, 1, rows_per_bucket=1).collect(), odd_rows, 1)
    assert sharding.assign(none, 8).count() == 0


def test_one_key_of_a_third_of_the_rows(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "cast(id AS string) AS text")
    check_shards(sharding.assign(df, 8, rows_per_bucket=50).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 8)
