"""Byte-pair encoding and decoding, with the prefixes that words share computed once.

Whatever follows, the encoding of a prefix ends in one certain token, its last
token, and without that token it is the encoding of a shorter prefix.  So a
prefix needs one value, and a word is read off backwards: last token, then
the last token of the prefix before it.  The distinct words form a trie; a
depth-first walk computes the last token of each node from those of its
ancestors.  Sorted words are that walk: a word keeps the path it shares with
the word before it.

A token may be the last one of a prefix if the tokens before it would not
merge with it: no merge that spans the border comes before the merges that
build the two tokens themselves.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, whole_text
from .units import Units, units_for


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Trie:
    """Last tokens along the path of the current word."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[Sequence[str]]):
        self.vocab = vocab
        self.rank, self.parts, self.made = {}, {}, {}
        for rank, (left, right) in enumerate(merges):
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = rank
            if c not in self.parts:  # the first merge that makes it is the one that builds it
                self.parts[c], self.made[c] = (a, b), rank
        self.endings = {t[i:] for t in vocab for i in range(len(t))}
        self.apart: dict[tuple[int, int], bool] = {}

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, remain as they are.

        Undo the latest merges one by one, on either side of the border.  Each
        state so reached existed for a while; a pair at the border that could
        have merged in that while would have.
        """
        until_left = until_right = len(self.rank)  # first merge that changes this side
        while True:
            merge = self.rank.get((left, right))
            if merge is not None:
                # equal pairs merge from the left, so a merge that also ends the left side comes first there
                if merge < until_left and merge <= until_right:
                    return False
            a, b = self.made.get(left, -1), self.made.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                until_left, left = a, self.parts[left][1]
            elif b > a:
                until_right, right = b, self.parts[right][0]
            else:  # one merge built both, the left one first
                until_right, right = b, self.parts[right][0]

    def encode(self, words: Sequence[str]) -> Iterator[list[int]]:
        """Ids of each word; words in sorted order share their prefixes."""
        vocab, endings, apart = self.vocab, self.endings, self.apart
        last, size, before = [-1], [0], ""
        for word in words:
            shared, top = 0, min(len(word), len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                reach = 1
                while reach < end and word[end - reach - 1 : end] in endings:
                    reach += 1
                for n in range(reach, 0, -1):
                    token = vocab.get(word[end - n : end])
                    if token is None:
                        continue
                    previous = last[end - n]
                    if previous < 0:
                        break
                    fits = apart.get((previous, token))
                    if fits is None:
                        fits = apart[previous, token] = self.stay_apart(previous, token)
                    if fits:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(token)
                size.append(n)
            before, ids, end = word, [], len(word)
            while end:
                ids.append(last[end])
                end -= size[end]
            ids.reverse()
            yield ids


class TrieUnits(Units):
    """Units cut into words by the tokenizer's own rules, words encoded by the trie."""

    def __init__(self, path: str):
        super().__init__(path, encode=self._by_trie)
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        model = definition["model"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in definition["added_tokens"])
        if model["type"] != "BPE" or model.get("end_of_word_suffix") or model.get("ignore_merges") or not plain:
            raise ValueError("a plain byte-level BPE is needed")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.trie = Trie(model["vocab"], merges)
        self.special_ids = {t["content"]: t["id"] for t in definition["added_tokens"]}
        longest_first = sorted(self.special_ids, key=len, reverse=True)
        self.special_rule = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.bytes_of |= {i: t.encode() for t, i in self.special_ids.items()}

    def _by_trie(self, units: Sequence[str]) -> list[bytes]:
        words_of, words = [], set()
        for unit in units:
            found: list[str | int] = []
            for part in self.special_rule.split(unit) if self.special_rule else [unit]:
                if part in self.special_ids:
                    found.append(self.special_ids[part])
                elif part:
                    found += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
            words_of.append(found)
            words.update(w for w in found if isinstance(w, str))
        if len(self.trie.apart) > 2_000_000:
            self.trie.apart.clear()
        ordered = sorted(words)
        ids_of = {w: array("I", ids).tobytes() for w, ids in zip(ordered, self.trie.encode(ordered))}
        return [b"".join([ids_of[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in found]) for found in words_of]

    def decode(self, ids: bytes) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        numbers = memoryview(ids).cast("I")
        runs = (numbers[low : low + 500_000] for low in range(0, len(numbers), 500_000))  # a list of all would be 8 bytes each
        return b"".join([b"".join(map(self.bytes_of.__getitem__, run)) for run in runs]).decode("utf-8", "replace")


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ids (unsigned 32-bit little-endian), decoded text.

    A null text is the empty one, which has no ids.  Rows do not depend on each
    other, so repeated rows and null ids are rows like any others; other columns
    are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer, TrieUnits)
        for batch in batches:
            start = 0
            for texts in slices((t.as_py() for t in batch["text"])):
                ids = units.ids(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(start, len(texts)),
                        pa.array(ids, pa.binary()),
                        pa.array([units.decode(i) for i in ids], pa.string()),
                    ],
                    names=["id", "ids", "decoded"],
                )
                start += len(texts)

    return rows.mapInArrow(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_col)


def digests(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids and SHA-256 of ids and of the decoded text, per row."""
    done = encode_decode(df, tokenizer, id_col, text)
    return done.select(
        id_col,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
