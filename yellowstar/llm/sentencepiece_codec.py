"""SentencePiece encoding and decoding by vectorised merge rounds.

Encodes whole texts with a BPE model that has an identity normalizer, a dummy
prefix, escaped spaces and byte fallback, exactly as the library does. A text
becomes code points; symbols the vocabulary lacks, and runs of spaces with the
characters behind them, bound the units that merges cannot cross. Units of a
batch are numpy symbol arrays merged in rounds (see ``bpe``), each distinct
unit once. Decoding concatenates the pieces' bytes.

The model file is read on the driver and travels with the tasks (0.5 MB), so
executors need no local copy.

Defined cases: null and empty texts have the end id only and decode to the
empty text. Rows are independent: ties, repeats and extra columns don't
matter, and an empty table gives an empty result. A text is processed in one
piece, a batch holds about ``common.BATCH_CHARS`` characters.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from . import bpe
from .common import map_texts

SPACE = "▁"


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.end = sp.eos_id()
        normal = [
            i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        ]
        ids = {pieces[i]: i for i in normal}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(sp.is_byte(int(i)) for i in self.byte_ids) or SPACE not in ids:
            raise ValueError("the model needs byte fallback and escaped spaces")
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece goes on behind a space: units would depend on each other")
        order = {i: r for r, i in enumerate(sorted(normal, key=lambda i: -sp.get_score(i)))}
        pairs = []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right, order[i], i))
        self.table = bpe.PairTable(*zip(*pairs, strict=True))
        self.char = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.cache = bpe.WordCache()
        self.decimal = [str(i) for i in range(n)]
        self.bytes = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.bytes[i] = b""
            elif sp.is_unknown(i):
                self.bytes[i] = " ⁇ ".encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        full = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        sizes = np.array([len(t) for t in full], np.int64)
        cp = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
        ids = self.char[cp]
        doc_ends = np.cumsum(sizes)
        if len(cp):
            space = cp == ord(SPACE)
            alone = ids < 0
            start = np.zeros(len(cp), bool)
            start[(doc_ends - sizes)[sizes > 0]] = True
            start[1:] |= (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
            starts = np.flatnonzero(start)
            lens = np.diff(np.append(starts, len(cp)))
        else:
            starts = lens = np.zeros(0, np.int64)

        def encode(at, n):
            symbols = ids[bpe.ranges(at, n)]
            unknown = symbols < 0  # always a unit of its own
            flat, count = bpe.merge_words(np.where(unknown, 0, symbols), n, self.table)
            single = n == 1
            lone = np.flatnonzero(single & (ids[at] < 0)) if len(at) else np.zeros(0, np.int64)
            if not len(lone):
                return flat, count
            raw = [chr(c).encode() for c in cp[at[lone]].tolist()]
            place = (np.cumsum(count) - count)[lone]
            keep = np.ones(len(flat), np.int64)
            keep[place] = [len(r) for r in raw]
            out = np.repeat(flat, keep)
            new_count = count.copy()
            new_count[lone] = keep[place]
            begin = (np.cumsum(new_count) - new_count)[lone]
            out[bpe.ranges(begin, new_count[lone])] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            return out, new_count

        flat, count = bpe.encode_words(cp, starts, lens, self.cache, encode)
        total = np.concatenate([[0], np.cumsum(count)])
        bounds = total[np.searchsorted(starts, np.concatenate([[0], doc_ends]))] if len(starts) else np.zeros(len(texts) + 1, np.int64)
        return [np.append(flat[bounds[i] : bounds[i + 1]], np.int32(self.end)) for i in range(len(texts))]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the dummy prefix goes."""
        out = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec per worker process."""
    return Codec(model)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int, the end id last) and the text decoded from them."""

    def run(texts):
        c = codec(model)
        ids = c.encode(texts)
        return None, {"ids": ids, "decoded": [c.decode(x) for x in ids]}

    return map_texts(docs, run, "ids array<int>, decoded string", id_col, text_col)


def digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids in decimal and of the decoded text."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(texts):
        c = codec(model)
        ids = c.encode(texts)
        return None, {
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [sha(" ".join(map(c.decimal.__getitem__, x.tolist()))) for x in ids],
            "decoded_sha256": [sha(c.decode(x)) for x in ids],
        }

    return map_texts(docs, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", id_col, text_col)
