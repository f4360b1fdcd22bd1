"""Ids of whole texts by the tokenizers library, which sees each distinct unit once.

A unit is a stretch of text that the tokenizer always treats on its own, so
that the ids of a text are the ids of its units in order:

* tokenizers that drop white space: what stands between spaces, tabs and line ends;
* byte-level tokenizers with the usual split rule: a word with the space
  before it, or a run of white space without the character that the rule
  leaves to the word behind it;
* both: letters before a mark that no rule joins to letters.

Texts in which these cuts could differ from the library's go to it whole:
separators that only one side counts as white space, and strings of special tokens.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTERS = r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?|*#$%&()\s]|$)"
WORDS = re.compile(rf"{LETTERS}|[^ \n\t]+")
SPACED = re.compile(rf" ?{LETTERS}| ?\S+|\s+(?!\S)|\s")
#: white space for one side only, which matters where white space makes units
UNSURE = "\x1c\x1d\x1e\x1f"
#: a longer text is cut into slices of so many characters first, at single spaces between words, where every unit ends
SLICE = 2_000_000
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: characters of texts that are remembered whole, so that copies near each other are encoded once
RECENT = 8_000_000


def rule_of(definition: dict) -> re.Pattern | None:
    """The unit pattern that is safe for this tokenizer, or none."""
    before = definition.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    normalizer = definition.get("normalizer") or {}
    kinds = {n["type"] for n in normalizer.get("normalizers", [normalizer]) if n}
    if steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex") and not steps[0].get("add_prefix_space") and not kinds:
        return SPACED
    words = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    if words and r"[^\s" in steps[0]["pattern"].get("Regex", "") and {"Lowercase"} <= kinds <= {"NFC", "Replace", "Lowercase"}:
        return WORDS
    return None


class Units:
    """Texts to units; units to ids through a bounded memory of ids as bytes."""

    def __init__(self, path: str, most: int = 600_000, longest: int = 64, encode: Callable | None = None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in definition.get("added_tokens", [])]
        self.rule = rule_of(definition)
        self.most, self.longest, self.known = most, longest, Known()
        self.recent, self.held = {}, 0
        self.encode_units = encode or self._library

    def _library(self, units: Sequence[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _plain(self, text: str) -> str | None:
        """The text as units are cut from it; none where it has to go to the library whole."""
        if self.rule is None or self.rule is SPACED and any(c in text for c in UNSURE):
            return None
        plain = text.encode().lower().decode() if self.rule is WORDS else text  # A-Z only, which such tokenizers drop anyway
        return None if any(s in plain for s in self.special) else plain

    def cut(self, text: str) -> list[str]:
        plain = self._plain(text)
        return [text] if plain is None else self.rule.findall(plain)

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """Per text its ids, each as an unsigned 32-bit little-endian integer."""
        collecting = gc.isenabled()
        gc.disable()  # millions of strings come and go, none of them in a cycle
        try:
            new = [t for t in dict.fromkeys(texts) if t not in self.recent]
            found = dict(zip(new, self._new_ids(new)))
            result = [found.get(t) or self.recent.get(t, b"") for t in texts]
            size = sum(map(len, new))
            self.held += size
            if self.held > RECENT:
                self.recent, self.held = {}, size
            if size <= RECENT:
                self.recent.update(found)
            return result
        finally:
            if collecting:
                gc.enable()

    def slices(self, text: str) -> Iterator[str]:
        """A text in slices whose ids, one after the other, are its ids; whole where it may not be cut."""
        if len(text) <= SLICE or self._plain(text) is None:
            yield text
            return
        at = 0
        while at < len(text):
            found = SAFE.search(text, at + SLICE)
            end = found.start() if found else len(text)
            yield text[at:end]
            at = end

    def _new_ids(self, texts: list[str]) -> list[bytes]:
        if all(len(t) <= SLICE for t in texts):
            return self._cut_ids(texts)
        return [b"".join([self._cut_ids([part])[0] for part in self.slices(t)]) for t in texts]

    def _cut_ids(self, texts: list[str]) -> list[bytes]:
        known = self.known
        parts = [list(map(known.__getitem__, self.cut(t))) for t in texts]
        new = known.new
        if new:
            for place, ids in zip(new.values(), self.encode_units(list(new))):
                place.extend(ids)
            known.update((u, bytes(place)) for u, place in new.items())
            known.new = {}
        found = [b"".join(p) for p in parts]
        for unit in [u for u in new if len(u) > self.longest]:
            del known[unit]
        if len(known) > self.most:  # what occurred here is likely to occur again
            again = set().union(*(self.cut(t) for t in texts)).difference(new)
            self.known = Known((u, known[u]) for u in again)
        return found


class Known(dict):
    """Ids by unit.  A unit not seen before gets an empty place, to be filled once all new ones are encoded."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: dict[str, bytearray] = {}

    def __missing__(self, unit: str) -> bytearray:
        place = self[unit] = self.new[unit] = bytearray()
        return place


_LOADED: dict[tuple, Units] = {}


def units_for(path: str, kind: Callable[..., Units] = Units, **options) -> Units:
    """One per Python worker, which keeps it from task to task."""
    key = (path, kind, *sorted(options.items()))
    if key not in _LOADED:
        _LOADED[key] = kind(path, **options)
    return _LOADED[key]
