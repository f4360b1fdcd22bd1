"""Repeated byte strings of a fixed length: sampling, and suffix intervals on a Burrows-Wheeler transform.

Of each window of ``length`` bytes one q-gram is the anchor: the one with the
smallest hash, the leftmost of equals.  It depends on the window's bytes alone,
so equal windows have equal anchors at the same place, and windows can be dealt
out by their anchor.  Neighbouring windows mostly share it; the windows of one
anchor are a run.
"""

from __future__ import annotations

import numpy as np
import xxhash

GRAM = 32
PLACE_BITS = 24
#: odd constants that spread bits, from a rule: multiples of the golden ratio
SPREAD = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & ((1 << 64) - 1)) for i in range(8)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each place on, built by doubling; len(data) - 31 values."""
    values = (data.astype(np.uint64) + np.uint64(1)) * SPREAD[0]
    span = 1
    for step in range(5):
        values = values[:-span] * SPREAD[step + 1] + (values[span:] ^ (values[span:] >> np.uint64(29)))
        span *= 2
    values ^= values >> np.uint64(32)
    values *= SPREAD[6]
    values ^= values >> np.uint64(29)
    return values


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: document number, first window, number of windows, anchor hash, two contexts.

    A window reaches half of its bytes beside the anchor to the left of it or to the right.
    The contexts are 16-bit digests of just these, 0 where the document ends before:
    runs that share neither have no window in common.

    ``data`` holds the documents one behind the other, ``bounds`` their ends
    and before them 0.  Places count from the start of ``data``.
    """
    ends, starts = bounds[1:], bounds[:-1]
    total = int(bounds[-1])
    if total < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint16), none.astype(np.uint16)
    hashes = gram_hashes(data)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchors = sliding_minimum(keys, length - GRAM + 1)
    anchors &= low
    anchors = anchors.astype(np.int64)
    first = np.ones(len(anchors), bool)
    first[1:] = anchors[1:] != anchors[:-1]
    first[starts[starts < len(anchors)]] = True
    at = np.flatnonzero(first)
    doc = np.searchsorted(ends, at, "right")
    until = np.minimum(np.append(at[1:], len(anchors)), ends[doc] - length + 1)
    inside = until > at
    at, doc, until = at[inside], doc[inside], until[inside]
    anchor = anchors[at]
    half = (length - GRAM) // 2
    left, right = (context(hashes, anchor, side, starts[doc], ends[doc]) for side in (-half, half))
    return doc, at, until - at, hashes[anchor], left, right


def context(hashes: np.ndarray, anchor: np.ndarray, shift: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Digest of the ``shift`` bytes beside the anchor, of q-grams that cover them together with it."""
    places = [anchor + s for s in range(shift, 0, GRAM if shift < 0 else -GRAM)]
    there = (places[0] >= start) & (places[0] + GRAM <= end)
    mixed = np.zeros(len(anchor), np.uint64)
    for i, place in enumerate(places):
        mixed = mixed * SPREAD[1] + hashes[np.clip(place, 0, len(hashes) - 1)]
    return np.where(there, (mixed * SPREAD[2] >> np.uint64(48)) | np.uint64(1), np.uint64(0)).astype(np.uint16)


def digests(data: bytes, at: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit digest of the bytes that each run covers."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(data[a:b]) for a, b in zip(at.tolist(), (at + windows + length - 1).tolist())), np.uint64, len(at))


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols at least, and the rank of each in that order.

    The first key packs as many symbols as fit 64 bits, each later one as many ranks.
    """
    n = len(text)
    bits = int(text.max(initial=0) + 1).bit_length()
    used = np.zeros(1 << bits, bool)
    used[text] = True
    codes = np.cumsum(used).astype(np.uint64)[text]  # from 1, in the order of the symbols; 0 stands behind the end
    bits = int(used.sum()).bit_length()
    span, bits = 64 // bits, np.uint64(bits)
    padded = np.concatenate([codes, np.zeros(span, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(span):
        key = (key << bits) | padded[i : i + n]
    ranks_in_key, rank_bits = 64 // n.bit_length(), np.uint64(n.bit_length())
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]), dtype=np.uint64)
        if span >= depth or int(rank[order[-1]]) == n:
            place = np.empty(n, np.int32)
            place[order] = np.arange(n, dtype=np.int32)
            return order.astype(np.int32), place
        key, shift = rank.copy(), span
        for _ in range(min(ranks_in_key, -(-depth // span)) - 1):
            key <<= rank_bits
            key[: max(0, n - shift)] |= rank[shift:]
            shift += span
        span = shift


def repeated_intervals(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, interval of each row): rows of one interval share ``length`` symbols.

    Intervals of rows that share d symbols are extended backwards by each
    symbol of the transform: the rows of an interval that one symbol precedes
    are neighbours again and share d + 1 symbols.  A border between neighbours
    that appears at d + 1 is their common prefix d, so prefixes come out by
    increasing value, and the search stops at ``length`` or when a step finds none.
    Only borders of the last step are extended, and rows without a border above them looked at.
    """
    n = len(text)
    order, place = suffix_order(text, length)
    following = place[np.where(order + 1 < n, order + 1, 0)]  # row of the suffix one symbol shorter: the extension, read backwards
    first = text[order]
    border = np.zeros(n, bool)
    border[0] = True
    border[1:] = first[1:] != first[:-1]
    at_end = np.flatnonzero(order == n - 1)
    border[at_end] = True
    border[at_end[at_end + 1 < n] + 1] = True
    open_rows = np.flatnonzero(~border).astype(np.int32)
    here, above = following[open_rows], following[open_rows - 1]
    # neighbours whose extensions are neighbours too: a border between these is theirs a step later
    next_to = here == above + 1
    behind = np.full(n, -1, np.int32)
    behind[here[next_to]] = open_rows[next_to]
    apart = ~next_to
    open_rows, here, above = open_rows[apart], here[apart], above[apart]
    found = np.flatnonzero(border)
    for _ in range(length - 1):
        passed_on = behind[found]
        passed_on = passed_on[passed_on >= 0]
        if len(open_rows) * 16 > n:
            interval = np.cumsum(border, dtype=np.int32)
            parted = interval[here] != interval[above]
        else:
            found.sort()
            parted = np.searchsorted(found, here, "right") != np.searchsorted(found, above, "right")
        found = np.concatenate([passed_on, open_rows[parted]])
        if not len(found):
            break
        border[found] = True
        whole = ~parted
        open_rows, here, above = open_rows[whole], here[whole], above[whole]
    return order, np.cumsum(border, dtype=np.int32)
