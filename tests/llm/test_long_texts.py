"""Texts of 50 MB: bounded memory, and the results of texts in one piece."""

import subprocess
import sys

import numpy as np
import pytest

from sluice.llm import common, quality, simhash, units
from sluice.llm.bpe import TrieUnits
from sluice.llm.units import Units

PIECES = ["word ", "Wörter, ", "don't  ", "12 ", "\n\n", "\t", "日本 ", "x" * 40 + " ", " . ", "a b", "-", "é|"]


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(1)
    return ["".join(rng.choice(PIECES, 3000)) for _ in range(6)] + ["x" * 5000, " " * 5000, "a b" * 2000, "<|endoftext|> x " * 900]


@pytest.mark.parametrize("kind", ["byte", "word", "trie"])
def test_sliced_ids_are_the_ids(mixed, kind, byte_path, word_path, monkeypatch):
    make = {"byte": lambda: Units(byte_path), "word": lambda: Units(word_path), "trie": lambda: TrieUnits(byte_path)}[kind]
    whole = make().ids(mixed)
    for size in (1, 50, 1001):
        monkeypatch.setattr(units, "SLICE", size)
        assert make().ids(mixed) == whole


def test_sliced_fingerprints_and_counts(mixed, monkeypatch):
    def all_of(text):
        hashes = quality.text_hashes(text, quality.Hashes())
        runs = [np.bincount(r, minlength=1 << quality.BUCKET_BITS) for r in quality.gram_runs(hashes, 7)]
        return simhash.fingerprint(text), simhash.fingerprint(text, 1), quality.base(text, hashes), sum(runs, np.zeros(1, int)).tolist()

    def one_piece(text):
        hashes = quality.hashes_of(text.encode().split(), quality.Hashes())
        return np.bincount(quality.grams(hashes), minlength=1 << quality.BUCKET_BITS).tolist() if len(hashes) else [0]

    whole = [all_of(t) for t in mixed]
    assert [w[3] for w in whole] == [one_piece(t) for t in mixed]
    runs = common.word_runs
    for size in (1, 64, 1000):
        for module in (simhash, quality):
            monkeypatch.setattr(module, "word_runs", lambda data, size=size: runs(data, size))
        assert [all_of(t) for t in mixed] == whole


LONG = """
import resource, sys
import numpy as np
words = np.array([f"w{{i * 2654435761 % 10**6}}" for i in range(50_000)])
rng = np.random.default_rng(2)
text = " ".join(" ".join(rng.choice(words, 65_000)) for _ in range(100))
assert len(text) > 50_000_000
from sluice.llm import quality, simhash, units
from sluice.llm.bpe import TrieUnits
from sluice.llm.units import Units
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
{work}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""


@pytest.mark.parametrize(
    "work",
    [
        "Units(sys.argv[1]).ids([text])",
        "Units(sys.argv[2]).ids([text])",
        "u = TrieUnits(sys.argv[1]); assert u.decode(u.ids([text])[0]) == text",
        "simhash.fingerprint(text)",
        "h = quality.text_hashes(text, quality.Hashes()); quality.base(text, h); [r.sum() for r in quality.gram_runs(h)]",
    ],
)
def test_fifty_megabytes_need_under_500(work, byte_path, word_path):
    done = subprocess.run(
        [sys.executable, "-c", LONG.format(work=work), byte_path, word_path], capture_output=True, text=True, cwd=sys.path[0] or ".",
        env={"PYTHONPATH": ":".join(sys.path), "PATH": "/usr/bin:/bin"},
    )
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 500, done.stdout
