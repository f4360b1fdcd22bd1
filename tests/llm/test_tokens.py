"""Encoding, counting, files and packing against the tokenizers library."""

import io
import struct
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings as rounds
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import bpe, packing, tokencount, tokenfiles
from sluice.llm.queries import QUERIES
from sluice.llm.units import Units


@pytest.fixture(scope="module")
def byte_ids(byte_path):
    own = Tokenizer.from_file(byte_path)
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def word_ids(word_path):
    own = Tokenizer.from_file(word_path)
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def byte_units(byte_path):
    return Units(byte_path)


@pytest.fixture(scope="module")
def word_units(word_path):
    return Units(word_path, most=50)


@pytest.fixture(scope="module")
def trie_units(byte_path):
    return bpe.TrieUnits(byte_path)


pieces = st.sampled_from([" ", "  ", "\n", "\t", "\x1c", "\x85", "　", "don't", "I'LL", "é", "é", "ǅ", "Σ", "12", "½", ".", "...", "|", "<|endoftext|>", "<|", "日本", "가", "ᄀ", "ᅡ", "word", "Wort,", "#$%"])
texts = st.one_of(st.text(max_size=60), st.lists(pieces, max_size=25).map("".join))


@rounds(max_examples=300, deadline=None)
@given(texts)
def test_units_are_the_librarys(byte_units, word_units, trie_units, byte_ids, word_ids, text):
    text = text.encode("utf-8", "ignore").decode()
    assert array("I", byte_units.ids([text])[0]).tolist() == byte_ids(text)
    assert array("I", trie_units.ids([text])[0]).tolist() == byte_ids(text)
    assert array("I", word_units.ids([text])[0]).tolist() == word_ids(text)


@rounds(max_examples=200, deadline=None)
@given(texts)
def test_trie_decodes(trie_units, text):
    text = text.encode("utf-8", "ignore").decode()
    assert trie_units.decode(trie_units.ids([text])[0]) == text


def test_decodes_any_ids(trie_units, byte_path):
    ids = [50256, 200, 220, 31479, 94, 0]
    assert trie_units.decode(array("I", ids).tobytes()) == Tokenizer.from_file(byte_path).decode(ids, skip_special_tokens=False)


def test_every_token_is_its_own_encoding(trie_units):
    vocab = {t: i for t, i in trie_units.trie.vocab.items() if t not in trie_units.special_ids}
    ordered = sorted(vocab)
    assert [ids for ids in trie_units.trie.encode(ordered)] == [[vocab[t]] for t in ordered]


def test_op9_query(spark, data, rows, byte_ids):
    import hashlib

    expected = {}
    for i, text in rows:
        ids = byte_ids(text)
        expected[i] = (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op9_bpe_trie"](spark, data).collect()}
    assert found == expected


def test_bpe_of_odd_rows(odd, odd_rows, none, byte_path, byte_ids):
    found = bpe.encode_decode(odd, byte_path).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in found) == Counter((i, t or "") for i, t in odd_rows)
    assert all(array("I", bytes(r["ids"])).tolist() == byte_ids(r["decoded"]) for r in found)
    assert bpe.digests(none, byte_path).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(40, 12), (300, 60), (32_768, 512)])
def test_counts_with_small_chunks(spark, odd, odd_rows, docs, rows, none, word_path, word_ids, chunk, overlap):
    found = tokencount.count_tokens(odd, word_path, chunk=chunk, overlap=overlap).collect()
    assert Counter(map(tuple, found)) == Counter((i, len((t or "").encode()), len(word_ids(t))) for i, t in odd_rows)
    few = docs.filter("doc_id < 40")
    found = tokencount.count_tokens(few, word_path, chunk=chunk, overlap=overlap).collect()
    assert sorted(map(tuple, found)) == sorted((i, len(t.encode()), len(word_ids(t))) for i, t in rows if i < 40)
    assert tokencount.count_tokens(none, word_path, chunk=chunk, overlap=overlap).count() == 0


def test_counts_where_chunks_hardly_align(spark, word_path, byte_path):
    made = [
        (1, "ab" * 700), (2, "가나다라" * 300), (3, "ẹ́" * 400), (4, "<|endoftext|>" * 80), (5, "각" * 300),
        (6, " " * 1500), (7, "a'll" * 400), (8, "\n \n" * 500), (9, "1" * 900 + " x"),
    ]
    df = spark.createDataFrame(made, "doc_id long, text string")
    for path in (word_path, byte_path):
        own = Tokenizer.from_file(path)
        found = tokencount.count_tokens(df, path, chunk=64, overlap=30).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(own.encode(t, add_special_tokens=False)) for i, t in made}


def test_counts_of_characters_taken_apart(spark, word_path, byte_path):
    """Characters that NFC or lower case makes longer, at every place of small chunks."""
    taken_apart = "\u09dc\u09dd\u09df\u0958\u095f\ufb1d\u0f73\u0130\u2adc"
    made = [(200 * k + n, "x" * n + f"ab{c} cd " * 40) for k, c in enumerate(taken_apart) for n in range(7)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    for path in (word_path, byte_path):
        own = Tokenizer.from_file(path)
        found = tokencount.count_tokens(df, path, chunk=64, overlap=30).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(own.encode(t, add_special_tokens=False)) for i, t in made}


def test_op8_query(spark, data, rows, word_ids):
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op8_token_counts"](spark, data).collect()}
    assert found == {i: (len(t.encode()), n := len(word_ids(t)), n > 2048) for i, t in rows}


@rounds(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1200))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    blocks = tokenfiles.encode_blocks(ids) if len(ids) else []
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.int64)
    assert tokenfiles.decode_blocks(b"".join(blocks), starts).tolist() == ids.tolist()


def test_outliers_are_patched():
    block = np.arange(256, dtype=np.uint32) % 8 + 100
    block[[3, 77]] = 4_000_000_000
    packed = tokenfiles.encode_blocks(block)[0]
    least, width, patched, values = struct.unpack("<IBBH", packed[:8])
    assert (least, width, patched, values) == (100, 3, 2, 256)
    assert len(packed) == 8 + 32 * 3 + 2 + 8


def test_reader_finds_any_run():
    writer, rng = tokenfiles.Writer(), np.random.default_rng(1)
    lists = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (0, 5, 1, 3000, 0, 256, 700)]
    writer.add([1, 2, 3], lists[:3])
    writer.add([4, 5, 6, 7], lists[3:])
    reader = tokenfiles.Reader(io.BytesIO(b"".join(writer.bytes())))
    stream = np.concatenate(lists)
    for first, last in ((0, 0), (0, 7), (250, 260), (700, 3961), (3962, 3962)):
        assert reader.ids(first, last).tolist() == stream[first:last].tolist()
    assert [(d, f, i.tolist()) for d, f, i in reader.documents()] == [
        (d, int(sum(map(len, lists[: d - 1]))), lists[d - 1].tolist()) for d in range(1, 8)
    ]


def test_op4_query(spark, data, rows, byte_ids):
    start, expected = 0, []
    for i, text in sorted(rows):
        ids = [*byte_ids(text), 0]
        expected.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op4_token_files"](spark, data).collect())) == expected


def test_files_of_odd_rows(odd, odd_rows, none, byte_path, byte_ids):
    found = sorted(map(tuple, tokenfiles.round_trip(odd, byte_path, rows_per_file=4).collect()), key=lambda r: r[1])
    ordered = sorted(odd_rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1] or ""))
    start, expected = 0, []
    for i, text in ordered:
        ids = [*byte_ids(text), 0]
        expected.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert found == expected
    assert tokenfiles.round_trip(none, byte_path).count() == 0


def test_a_hot_id_and_long_texts_fill_many_files(spark, byte_path, byte_ids, tmp_path):
    rows = [(7, f"text {i % 50}") for i in range(3000)] + [(7, "same")] * 1000 + [(i, "x y " * 2000) for i in range(8, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    listing = tokenfiles.write(df, str(tmp_path / "f"), byte_path, rows_per_file=400, bytes_per_file=40_000)
    files = listing.collect()
    assert sum(f["documents"] for f in files) == len(rows) and max(f["documents"] for f in files) < 1000
    back = tokenfiles.read(spark, str(tmp_path / "f"), listing).collect()
    order = [r["id"] for r in sorted(back, key=lambda r: r["start"])]
    assert order == sorted(i for i, _ in rows)
    assert Counter((r["id"], bytes(r["ids"])) for r in back) == Counter((i, array("I", [*byte_ids(t), 0]).tobytes()) for i, t in rows)


def check_plan(histogram, capacity, groups=packing.GROUPS):
    made = packing.plan(histogram, capacity, groups)
    ranks, load = defaultdict(list), defaultdict(list)
    for length, rank, count, sequence, offset in made.rows:
        ranks[length] += range(rank, rank + count)
        for i in range(count):
            load[sequence + i].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in histogram.items() if c}
    assert sorted(load) == list(range(made.sequences))
    for parts in load.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return made.sequences


@rounds(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30), st.integers(1, 12))
def test_plans_are_valid(histogram, groups):
    check_plan(histogram, 64, groups)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 2048, 4000), rng.integers(1, 300, 1500)])
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    assert check_plan(histogram, 2048) <= 1.005 * lengths.sum() / 2048 + 1
    assert check_plan({1024: 10, 1025: 4}, 2048) == 9  # five pairs of halves, four that nothing fits beside
    assert check_plan({2048: 7}, 2048) == 7 and check_plan({}, 2048) == 0


def test_plan_does_not_grow_with_the_documents():
    rng = np.random.default_rng(4)
    histogram = {i: int(c) for i, c in enumerate(rng.integers(0, 9, 2049)) if i}
    few, many = packing.plan(histogram, 2048), packing.plan({k: 10**6 * c for k, c in histogram.items()}, 2048)
    assert len(many.rows) < 4 * len(few.rows) + 4096


def check_packed(found, expected, capacity):
    """``expected``: Counter of (id, piece, start, length, crc)."""
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    load = defaultdict(list)
    for r in found:
        load[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in load.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(load)


def cut(rows, ids_of, capacity=2048):
    found = Counter()
    for i, text in rows:
        ids = [*ids_of(text), 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            found[i, piece, at, len(part), zlib.crc32(array("I", part).tobytes())] += 1
    return found


def test_op1_query(spark, data, rows, word_ids):
    found = QUERIES["op1_grouped_packing"](spark, data).collect()
    sequences = check_packed(found, cut(rows, word_ids), 2048)
    assert sequences <= 1.02 * sum(r["length"] for r in found) / 2048 + 1


def test_packing_of_odd_rows(odd, odd_rows, none, word_path, word_ids):
    check_packed(packing.pack(odd, word_path).collect(), cut(odd_rows, word_ids), 2048)
    check_packed(packing.pack(odd, word_path, capacity=16).collect(), cut(odd_rows, word_ids, 16), 16)
    assert packing.pack(none, word_path).count() == 0


def test_sequences_hold_the_ids(docs, rows, word_path, word_ids):
    few = docs.filter("doc_id < 30")
    packed = packing.pack(few, word_path, capacity=512)
    whole = packing.sequences(packing.pieces(few, word_path, 512), packed)
    ids = {r["sequence_id"]: array("I", bytes(r["ids"])).tolist() for r in whole.collect()}
    texts = dict(rows)
    for r in packed.collect():
        own = [*word_ids(texts[r["doc_id"]]), 0][r["start"] : r["start"] + r["length"]]
        assert ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == own
