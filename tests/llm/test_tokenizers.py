import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from yellowstar.llm import packing, sentencepiece_codec
from yellowstar.llm.queries import vocabulary
from yellowstar.llm.word_tokens import SAFE, encoder


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    letters = list("abcdeth in▁ \n😀éß.,'\"-") + ["'s", "'ll", "  ", "日本"]
    out = ["", " ", "a  b", "aaaaaaa" * 40, "the" * 300, "\x00", "don't 's's !!'s 'RE 'rex", "a\x85b\xa0c", "ΣΑΣ Σας"]
    return out + ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(800)]


def test_pieces_equal_the_library(texts):
    import sentencepiece

    model = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = sentencepiece_codec.codec(model)
    got = codec.encode(texts)
    want = library.encode(texts, add_eos=True)
    assert [x.tolist() for x in got] == want
    assert [codec.decode(x) for x in got] == [library.decode(x) for x in want]


def test_words_equal_the_library(texts):
    words = encoder(vocabulary("word_bpe_49k.json").decode())
    every = texts + [f"a{chr(c)}b '{chr(c)} " for a, b in SAFE for c in range(a, min(b, a + 300) + 1)]
    want = [e.ids for e in words.library.encode_batch(every, add_special_tokens=False)]
    assert [x.tolist() for x in words.encode(every)] == want


def test_digests_cover_nulls_and_repeats(docs, empty):
    import sentencepiece

    model = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)

    def row(r):
        ids = library.encode(r["text"] or "", add_eos=True)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        return (r["doc_id"], len(ids), *sha)

    got = Counter(tuple(r) for r in sentencepiece_codec.digests(docs, model).collect())
    assert got == Counter(row(r) for r in docs.collect())
    assert sentencepiece_codec.digests(empty, model).count() == 0


def test_packing_is_whole_and_tight(docs, empty):
    from tokenizers import Tokenizer

    spec = vocabulary("word_bpe_49k.json").decode()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            raw = b"".join(i.to_bytes(4, "little") for i in cut)
            want[(r["doc_id"], k, at, len(cut), zlib.crc32(raw))] += 1
    got = packing.pack_documents(docs, spec).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(places) <= -(-total // 2048) + 1
    assert packing.pack_documents(empty, spec).count() == 0


def test_plan_meets_demand_exactly():
    import numpy as np

    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 65, 4000), rng.integers(30, 40, 500), np.array([64] * 5), np.array([1]), np.array([], int)):
        demand = np.bincount(sizes, minlength=65)
        plan = packing.plan_sequences(demand, 64)
        made = np.zeros(65, np.int64)
        for config, times in plan:
            assert sum(config) <= 64
            for length in config:
                made[length] += times
        assert (made == demand).all()
        # never worse than best-fit decreasing alone
        assert sum(t for _, t in plan) <= sum(t for _, t in packing._best_fit_rest(demand.copy(), 64)) + 1


def test_texts_are_encoded_a_few_at_a_time(spark, monkeypatch):
    """However much a task is handed at once, the encoder sees little of it, and the pieces are those of single texts."""
    import zlib

    from yellowstar.llm.queries import vocabulary

    spec = vocabulary("word_bpe_49k.json").decode()
    real, seen, run = packing.encoder(spec), [], []

    class Noted:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return real.encode(texts)

    monkeypatch.setattr(packing, "encoder", lambda spec: Noted())
    monkeypatch.setattr(packing, "map_texts", lambda docs, function, *args: run.append(function))
    packing.pieces(None, spec)
    texts = [f"word{i} and more " * 5_000 for i in range(25)] + ["", "x"]
    counts, out = run[0](texts)
    assert len(seen) > 1 and max(seen) <= packing.ENCODE_CHARS
    assert len(counts) == len(texts) and out["length"][-2:] == [1, 2]
    ids = packing.np.append(real.encode(texts[:1])[0], packing.END).astype("<u4")
    assert out["ids_crc32"][0] == zlib.crc32(ids[: packing.CAPACITY].tobytes())
