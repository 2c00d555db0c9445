"""Suffix order of one shard by induced sorting, and its repeated windows.

A shard joins short texts, each closed by a sign smaller than all bytes. Only the
order of suffixes up to ``length`` bytes matters, which bounds the recursion.
Each step works on whole buckets at a time with numpy.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix is smaller than the next one, leftmost such suffixes)."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    step[-1] = 1  # the closing sign is the smallest suffix
    # Equal neighbours are of the type of the next different pair.
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    smaller = step[following] > 0
    leftmost = np.zeros(n, dtype=bool)
    leftmost[1:] = smaller[1:] & ~smaller[:-1]
    return smaller, np.flatnonzero(leftmost)


class _Buckets:
    """Per first sign the suffixes found so far, in the order of finding."""

    def __init__(self, text: np.ndarray, signs: int) -> None:
        self._text = text
        self.of: list[list[np.ndarray]] = [[] for _ in range(signs)]

    def add(self, suffixes: np.ndarray) -> None:
        if not len(suffixes):
            return
        first = self._text[suffixes]
        order = np.argsort(first, kind="stable")
        first, suffixes = first[order], suffixes[order]
        cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        for a, b in zip(cuts, np.append(cuts[1:], len(first))):
            self.of[first[a]].append(suffixes[a:b])

    def get(self, sign: int) -> np.ndarray:
        parts = self.of[sign]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, signs: int) -> np.ndarray:
    """Order of all suffixes, induced from the leftmost-smaller ones in ``leftmost``'s order."""
    seeds, larger, rising = (_Buckets(text, signs) for _ in range(3))
    seeds.add(leftmost)

    def spread(suffixes: np.ndarray, into: _Buckets, kind: bool) -> None:
        before = suffixes[suffixes > 0] - 1
        into.add(before[smaller[before] == kind])

    # The last suffix is the closing sign; what stands before it is larger.
    for sign in range(signs):
        done = 0
        while done < len(larger.of[sign]):  # runs of one sign find more of it
            part = larger.of[sign][done]
            done += 1
            spread(part, larger, False)
        spread(seeds.get(sign), larger, False)
    for sign in range(signs - 1, -1, -1):
        done = 0
        while done < len(rising.of[sign]):
            part = rising.of[sign][done]
            done += 1
            spread(part, rising, True)
        spread(larger.get(sign)[::-1], rising, True)
    ordered = []
    for sign in range(signs):
        ordered += [larger.get(sign), rising.get(sign)[::-1]]
    last = np.array([len(text) - 1])  # nothing follows it, so nothing induces it
    return np.concatenate([last, *ordered])


def _names(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, equal ones alike, by text position."""
    ends = np.append(leftmost[1:], len(text) - 1)
    rank_of = np.full(len(text), -1)
    rank_of[leftmost] = np.arange(len(leftmost))
    which = rank_of[order]
    which = which[which >= 0]
    a, b = leftmost[which[:-1]], leftmost[which[1:]]
    size_a, size_b = ends[which[:-1]] - a, ends[which[1:]] - b
    same = size_a == size_b
    alive = np.flatnonzero(same)
    offset = 0
    while len(alive):  # compare sign by sign; most substrings have two or three
        equal = text[a[alive] + offset] == text[b[alive] + offset]
        same[alive[~equal]] = False
        alive = alive[equal & (offset < size_a[alive])]
        offset += 1
    name = np.zeros(len(leftmost), dtype=np.int64)
    name[which] = np.concatenate([[0], np.cumsum(~same)])
    return name


def suffix_order(text: np.ndarray, signs: int, length: int) -> np.ndarray:
    """All suffixes, in order up to their first ``length`` signs at least.

    Leftmost-smaller substrings are sorted by inducing from their first signs
    and named; pairs of neighbouring names are named anew, over twice as many
    substrings each time, until all names differ or span ``length`` signs.
    """
    smaller, leftmost = classify(text)
    if not len(leftmost):
        return induce(text, smaller, leftmost, signs)
    name = _names(text, leftmost, induce(text, smaller, leftmost, signs))
    span = 1
    # Neighbouring leftmost-smaller suffixes lie at least two signs apart.
    while span * 2 < length and name.max() + 1 < len(name):
        after = np.zeros(len(name), dtype=np.int64)
        after[:-span] = name[span:] + 1
        _, name = np.unique(name * (len(name) + 1) + after, return_inverse=True)
        span *= 2
    return induce(text, smaller, leftmost[np.argsort(name, kind="stable")], signs)


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Per text, whether the window of ``length`` bytes at each start occurs again.

    Every text must have at least ``length`` bytes; a text of n bytes has
    n - length + 1 starts.
    """
    if not texts:
        return []
    sizes = np.array([len(t) + 1 for t in texts])
    raw = np.frombuffer(b"\0".join(texts) + b"\0" * (1 + 8), dtype=np.uint8)
    n = int(sizes.sum())
    closing = np.cumsum(sizes) - 1
    text = raw[:n].astype(np.int16) + 1
    text[closing] = 0
    order = suffix_order(text, 257, length)
    left = np.repeat(closing, sizes) - np.arange(n)
    starts = left >= length
    # Permuted common prefixes: each window with the one before it in the order.
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    here = np.flatnonzero(starts & (before >= 0))
    here = here[starts[before[here]]]
    words = np.ndarray(n, dtype="<u8", buffer=raw.tobytes(), strides=(1,))
    for at in [*range(0, length - 7, 8), length - 8]:
        here = here[words[here + at] == words[before[here] + at]]
    again = np.zeros(n, dtype=bool)
    again[here] = True
    again[before[here]] = True
    ends = closing - length + 1
    return [again[a:b] for a, b in zip(closing - sizes + 1, ends)]
