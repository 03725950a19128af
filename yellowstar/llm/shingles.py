"""Word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(0x110000, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

C1 = np.uint64(0x9E3779B97F4A7C15)
C2 = np.uint64(0xBF58476D1CE4E5B9)
C3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = (x + C1).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def word_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the joined texts, starts and lengths of their words, and the text of each word."""
    sizes = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    inside = ~_SPACE[cp]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = (ends - sizes)[sizes > 0]
    start[first] |= inside[first]
    stop = np.zeros(len(cp) + 1, bool)
    stop[1 : len(cp)] = ~inside[1:] & inside[:-1]
    if len(cp):
        stop[len(cp)] = inside[-1]
        cut = first[first > 0]
        stop[cut] |= inside[cut - 1]
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
    return cp, starts, stops - starts, np.searchsorted(ends, starts, side="right")


def word_hashes(cp: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: the sum of its mixed (place, code point) pairs, mixed with its length.

    Every place has values of its own, so no pattern of letters cancels out,
    as some long ones do in a polynomial modulo 2**64.
    """
    first = np.zeros(len(cp), np.int64)
    first[starts] = starts
    place = (np.arange(len(cp)) - np.maximum.accumulate(first)).astype(np.uint64) if len(cp) else first.astype(np.uint64)
    total = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(mix(place << np.uint64(21) | cp), out=total[1:])
    return mix((total[starts + lens] - total[starts]) ^ mix(lens.astype(np.uint64)))


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place (word number in its text) of every shingle of ``size`` words, lower-cased.

    A text of fewer words, but one at least, has a single shingle of all of them.
    """
    cp, starts, lens, owner = word_spans([t.lower() for t in texts])
    words = word_hashes(cp, starts, lens)
    count = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(count)
    place = np.arange(len(words)) - (ends - count)[owner]
    whole = place + size <= count[owner]
    at = np.flatnonzero(whole)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = mix(h ^ words[at + k])
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        extra[has] = mix(extra[has] ^ words[(ends - count)[short[has]] + k])
    extra = mix(extra ^ np.uint64(1))
    hashes = np.concatenate([h, extra])
    owners = np.concatenate([owner[at], short])
    order = np.argsort(owners, kind="stable")
    places = np.concatenate([place[at], np.zeros(len(short), np.int64)])
    return hashes[order], owners[order], places[order]


def distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, ascending within the text."""
    order = np.lexsort((hashes, owners))
    h, o = hashes[order], owners[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]
