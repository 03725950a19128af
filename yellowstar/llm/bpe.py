"""Byte-pair merging of many words at once, in numpy.

Words are flat symbol arrays. A round takes, for each word, the minimum rank
over its neighbouring pairs (a segmented minimum), merges all leftmost
non-overlapping pairs of that rank at once and compacts the arrays. Words
without a mergeable pair leave; rounds go on until none remains.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class PairTable:
    """Rank and resulting symbol of each mergeable pair: an open-addressing hash table."""

    def __init__(self, left, right, rank, merged):
        key = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        self.bits = max(4, int(4 * len(key)).bit_length())
        size = (1 << self.bits) + 64
        self.keys = np.full(size, np.uint64(2**64 - 1), np.uint64)
        self.ranks = np.full(size, NONE, np.int32)
        self.merged = np.zeros(size, np.int32)
        self.probes = 1
        slots = self._slot(key).tolist()
        taken: set[int] = set()
        place = np.empty(len(key), np.int64)
        for i, slot in enumerate(slots):
            first = slot
            while slot in taken:
                slot += 1
            taken.add(slot)
            self.probes = max(self.probes, slot - first + 1)
            place[i] = slot
        self.keys[place] = key
        self.ranks[place] = rank
        self.merged[place] = merged

    def _slot(self, key):
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left, right):
        """Ranks (``NONE`` where no merge exists) and merged symbols of pairs."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(key)
        rank = np.full(len(key), NONE, np.int32)
        merged = np.zeros(len(key), np.int32)
        here = np.arange(len(key))
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == key
            at = here[hit]
            rank[at] = self.ranks[slot[hit]]
            merged[at] = self.merged[slot[hit]]
            go = ~hit & (found != np.uint64(2**64 - 1))
            if not go.any():
                break
            key, slot, here = key[go], slot[go] + 1, here[go]
        return rank, merged


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word to the end; words have at least one symbol each.

    Returns the flat symbols in word order and the number of symbols per word.
    """
    n = len(lengths)
    if not n:
        return symbols.astype(np.int32), lengths.astype(np.int64)
    sym = symbols.astype(np.int32)
    words = np.arange(n)
    lens = lengths.astype(np.int64)
    done_words, done_lens, done_syms = [], [], []
    rank = np.full(len(sym), NONE, np.int32)
    new = np.zeros(len(sym), np.int32)
    ends = np.cumsum(lens)
    inner = np.ones(len(sym), bool)
    inner[ends - 1] = False
    at = np.flatnonzero(inner)
    rank[at], new[at] = table.find(sym[at], sym[at + 1])
    while True:
        starts = ends - lens
        least = np.minimum.reduceat(rank, starts)
        active = least != NONE
        if not active.all():  # finished words leave
            stay = np.repeat(active, lens)
            done_words.append(words[~active])
            done_lens.append(lens[~active])
            done_syms.append(sym[~stay])
            words, lens, least = words[active], lens[active], least[active]
            sym, rank, new = sym[stay], rank[stay], new[stay]
            if not len(words):
                break
            ends = np.cumsum(lens)
        pick = np.flatnonzero(rank == np.repeat(least, lens))
        if len(pick) > 1:  # of overlapping pairs every second one, from the left
            fresh = np.empty(len(pick), bool)
            fresh[0] = True
            np.not_equal(pick[1:], pick[:-1] + 1, out=fresh[1:])
            if not fresh.all():
                order = np.arange(len(pick))
                run = np.maximum.accumulate(np.where(fresh, order, 0))
                pick = pick[((order - run) & 1) == 0]
        word_of = np.searchsorted(ends, pick, side="right")
        sym[pick] = new[pick]
        keep = np.ones(len(sym), bool)
        keep[pick + 1] = False
        moved = np.cumsum(keep)[pick] - 1  # place of the merged symbols after compaction
        sym, rank, new = sym[keep], rank[keep], new[keep]
        lens = lens - np.bincount(word_of, minlength=len(lens))
        ends = np.cumsum(lens)
        last = np.zeros(len(sym), bool)
        last[ends - 1] = True
        first = np.zeros(len(sym), bool)
        first[ends - lens] = True
        changed = np.concatenate([moved, moved[~first[moved]] - 1])
        rank[changed] = NONE
        pairs = changed[~last[changed]]
        rank[pairs], new[pairs] = table.find(sym[pairs], sym[pairs + 1])
    words = np.concatenate(done_words)
    lens = np.concatenate(done_lens)
    flat = np.concatenate(done_syms)
    order = np.argsort(words, kind="stable")
    starts = np.cumsum(lens) - lens
    return flat[ranges(starts[order], lens[order])], lens[order]


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``starts[i] .. starts[i] + lens[i]``."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Longer words are not looked up by hash.
MAX_HASHED = 500


class Powers:
    """Powers of the hash base, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE, np.uint64)]), dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()


def span_hashes(symbols: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``symbols`` (values and length)."""
    up, down = POWERS.to(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=total[1:])
    h = (total[starts + lens] - total[starts]) * down[starts] + lens.astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class WordCache:
    """Tokens of words seen before, by hash; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def add(self, keys, lens, flat):
        if len(self.keys) + len(keys) > self.limit:
            self.clear()
        starts = len(self.pool) + np.cumsum(lens) - lens
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys, kind="stable")
        self.keys = all_keys[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.lens = np.concatenate([self.lens, lens])[order]
        self.pool = np.concatenate([self.pool, flat])

    def find(self, keys):
        """Place of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def encode_words(symbols, starts, lens, cache: WordCache, encode) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of every word (span of ``symbols``), each distinct word encoded once.

    ``encode(starts, lens)`` gives (flat tokens, tokens per word). Returns the
    flat tokens of all words in order, and the number per word.
    """
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    keys = span_hashes(symbols, starts, lens)
    plain = lens <= MAX_HASHED
    uniq, first, inverse = np.unique(keys[plain], return_index=True, return_inverse=True)
    first = np.flatnonzero(plain)[first]
    at, known = cache.find(uniq)
    fresh = first[~known]
    flat, n = encode(starts[fresh], lens[fresh])
    flats, counts, begins = [flat], np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
    counts[~known] = n
    begins[~known] = np.cumsum(n) - n
    if known.any():  # the cache's tokens stand behind the new ones
        counts[known] = cache.lens[at[known]]
        begins[known] = cache.starts[at[known]] + len(flat)
        flats.append(cache.pool)
    long_flat, long_n = encode(starts[~plain], lens[~plain])
    base = sum(map(len, flats))
    flats.append(long_flat)
    pool = np.concatenate(flats)
    word_begin = np.empty(len(starts), np.int64)
    word_count = np.empty(len(starts), np.int64)
    word_begin[plain], word_count[plain] = begins[inverse], counts[inverse]
    word_begin[~plain], word_count[~plain] = base + np.cumsum(long_n) - long_n, long_n
    cache.add(uniq[~known], n, flat)
    return pool[ranges(word_begin, word_count)], word_count
