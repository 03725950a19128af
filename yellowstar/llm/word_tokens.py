"""Vectorised encoding with the lower-casing word BPE of the tokenizers library.

The vocabulary's rules (NFC, white space to one space, lower case; words are
contractions, runs of letters, single digits, runs of other characters; bytes
merged by rank with an end-of-word mark) run over whole batches in numpy, each
distinct word encoded once. Texts with characters outside ``SAFE`` ranges,
where normalization or case depends on context, and texts that contain a
special token's opening go through the library itself, so ids always equal
the library's.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

from . import bpe

#: Code points whose NFC form is themselves and whose lower case is one character.
SAFE = [(0x0, 0x12F), (0x131, 0x2AF), (0x391, 0x3A1), (0x3A3, 0x3A9), (0x3B1, 0x3C9), (0x410, 0x44F),
        (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF), (0x3041, 0x3093), (0x30A1, 0x30F3), (0x4E00, 0x9FA5)]
#: Contractions that are words of their own, in the order they are tried.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
GAP, LETTER, DIGIT, OTHER = 0, 1, 2, 3


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(kept) else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Encoder of one tokenizer file."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        model = json.loads(spec)["model"]
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + mark] for c in chars], np.int32)
        pairs = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs.append((vocab[left], vocab[right], rank, vocab[left + right]))
        self.table = bpe.PairTable(*zip(*pairs, strict=True))
        self.special = json.loads(spec)["added_tokens"]
        self.openings = {t["content"][:2] for t in self.special}
        top = max(b for _, b in SAFE) + 1
        self.kind = np.full(top, GAP, np.uint8)
        self.lower = np.arange(top, dtype=np.uint32)
        self.safe = np.zeros(top + 1, bool)
        for a, b in SAFE:
            self.safe[a : b + 1] = True
            for c in range(a, b + 1):
                ch = chr(c)
                self.lower[c] = ord(ch.lower()) if len(ch.lower()) == 1 else c
                if ch.isspace() and not 0x1C <= c <= 0x1F:
                    continue
                kind = unicodedata.category(ch)[0]
                self.kind[c] = {"L": LETTER, "N": DIGIT}.get(kind, OTHER)
        self.safe[:top] &= self.safe[self.lower]
        self.cache = bpe.WordCache()

    def plain(self, text: str) -> bool:
        if any(o in text for o in self.openings):
            return False
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return bool(self.safe[np.minimum(cp, len(self.safe) - 1)].all())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text without special tokens."""
        fast = [self.plain(t) for t in texts]
        quick = iter(self._vector([t for t, f in zip(texts, fast, strict=True) if f]))
        return [
            next(quick) if f else np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32)
            for t, f in zip(texts, fast, strict=True)
        ]

    def _words(self, cp: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the words; ``breaks`` marks first characters of texts."""
        kind = self.kind[cp]
        start = np.ones(len(cp), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | breaks[1:]
        # a lone apostrophe takes the contraction behind it
        at = np.flatnonzero((cp == 0x27) & start)
        at = at[at + 1 < len(cp)]
        at = at[(kind[at + 1] == LETTER) & ~breaks[at + 1]]
        if len(at):
            one = cp[at + 1]
            behind = np.minimum(at + 2, len(cp) - 1)
            two = np.where((at + 2 < len(cp)) & ~start[behind], cp[behind], 0)
            taken = np.zeros(len(at), np.int64)
            for c in reversed(CONTRACTIONS):
                fits = (one == ord(c[0])) & ((len(c) == 1) | (two == ord(c[-1])))
                taken[fits] = len(c)
            at, taken = at[taken > 0], taken[taken > 0]
            start[at + 1] = False
            rest = at + 1 + taken
            start[rest[rest < len(cp)]] = True
        starts = np.flatnonzero(start)
        lens = np.diff(np.append(starts, len(cp)))
        word = kind[starts] != GAP
        return starts[word], lens[word]

    def _vector(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        cp = self.lower[raw]
        ends = np.cumsum(sizes)
        if not len(cp):
            return [np.zeros(0, np.int32) for _ in texts]
        breaks = np.zeros(len(cp) + 1, bool)
        breaks[ends - sizes] = True
        starts, lens = self._words(cp, breaks[:-1])

        def encode(at, n):
            units = cp[bpe.ranges(at, n)]
            wide = np.where(units < 0x80, 1, np.where(units < 0x800, 2, 3))  # bytes of each character
            data = np.frombuffer(units.tobytes().decode("utf-32-le").encode(), np.uint8)
            size = np.add.reduceat(wide, np.cumsum(n) - n) if len(n) else np.zeros(0, np.int64)
            symbols = self.inner[data]
            last = np.cumsum(size) - 1
            symbols[last] = self.final[data[last]]
            return bpe.merge_words(symbols, size, self.table)

        flat, count = bpe.encode_words(cp, starts, lens, self.cache, encode)
        total = np.concatenate([[0], np.cumsum(count)])
        bounds = total[np.searchsorted(starts, np.concatenate([[0], ends]))]
        return [flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


@lru_cache(maxsize=2)
def encoder(spec: str) -> WordEncoder:
    """One encoder per worker process."""
    return WordEncoder(spec)
