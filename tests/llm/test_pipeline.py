import math
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import tokenizers
import xxhash

import corpus_pipeline
from yellowstar.llm import packing, quality_rules
from yellowstar.llm.common import saved

from .test_labels import _base
from .test_near_dedup import _classes


def test_stages_pass_documents_on(spark, docs, labels, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() <= now.count()
        now = out
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in now.collect())
    assert max(r["offset"] + r["length"] for r in rows) <= packing.CAPACITY


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


def _hash(data, seed=42):
    return _signed(xxhash.xxh64(data, seed=seed & (2**64 - 1)).intdigest())


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _grams(words):
    hashes = [_hash(w.encode()) for w in words]
    for h, after in zip(hashes, [*hashes[1:], 0]):
        yield h % quality_rules.BUCKETS
        yield _hash(struct.pack("<q", after), _hash(struct.pack("<q", h))) % quality_rules.BUCKETS


def _good(rows, trusted):
    """Rows that the quality rules keep, by plain loops."""
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(_grams(_words(r["text"])))
        if r["doc_id"] in trusted:
            target.update(_grams(_words(r["text"])))
    n, m = sum(raw.values()) + quality_rules.BUCKETS, sum(target.values())

    def ratio(b, t, whole):
        share = (raw[b] + 1) / n
        return math.log((t + m * share) / (whole + m) / share) if m else 0.0

    unseen = sum(t * ratio(b, t - 1, m - 1) for b, t in target.items()) / m if m else 0.0
    out = []
    for r in rows:
        words = _words(r["text"])
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        total = sum(round(1e6 * (ratio(b, target[b], m) - min(0.0, unseen))) for b in _grams(words))
        if len(words) >= 50 and 2 * len(again) <= len(words) and total >= 2 * len(words) * quality_rules.THRESHOLD:
            out.append(r)
    return out


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _ids(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_stages_equal_brute_force(spark, docs, labels, tmp_path):
    words = [f"w{i}" for i in range(200)]
    family = []
    for k in range(12):  # near copies, exact ones (in capitals) and texts of their own
        w = list(words)
        w[10 * k] = f"edit{k}"
        family += [(500 + k, " ".join(w)), (600 + k, " ".join(w).upper()), (700 + k, " ".join(f"z{k}x{i}" for i in range(80)))]
    family += [(800, " ".join(f"q{i}" for i in range(70)) + " write to a.b@c.example.org or 10.1.2.3"), (801, " ".join(f"q{i}y" for i in range(5000)))]
    extra = spark.createDataFrame([(i, t, "a", i, 1, "x") for i, t in family], docs.schema)
    # of the texts of their own only some are trusted
    labels = labels.union(spark.createDataFrame([(i, 1, 0) for i, _ in family if not 704 <= i < 720], labels.schema))
    docs.union(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)

    rows = now.collect()
    trusted = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    now = saved(steps["quality_rules"](spark, now, str(tmp_path)), "test")
    want = _good(rows, trusted)
    assert _ids(now.collect()) == _ids(want) and len(rows) > len(want) > 20

    best = {}
    for r in want:
        key = _lower(r["text"])
        if key not in best or (r["doc_id"] is not None, r["doc_id"] or 0) > (best[key]["doc_id"] is not None, best[key]["doc_id"] or 0):
            best[key] = r
    now = saved(steps["exact_dedup"](spark, now, str(tmp_path)), "test")
    rows = now.collect()
    assert _ids(rows) == _ids(best.values())

    classes = _classes(rows)
    now = saved(steps["near_dedup"](spark, now, str(tmp_path)), "test")
    kept = _ids(now.collect())
    assert all(sum(kept[rows[i]["doc_id"], rows[i]["text"]] for i in group) == 1 for group in classes) and len(classes) < len(rows)

    before = now.collect()
    now = saved(steps["pii"](spark, now, str(tmp_path)), "test")
    after = {r["doc_id"]: r["text"] for r in now.collect()}
    for r in before:
        assert not _base(after[r["doc_id"]])
        if not re.search(r"[@0-9]{2}|@|\[at\]", r["text"]):
            assert after[r["doc_id"]] == r["text"]
    assert after[800].endswith("write to <EMAIL> or <IP>")

    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter()
    for i, text in after.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        lengths[i] = n
    rows = steps["best_fit_packing"](spark, now, str(tmp_path)).collect()
    assert Counter(i for r in rows for i in [r["doc_id"]] * r["length"]) == lengths
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert len(sequences) <= -(-sum(lengths.values()) // packing.CAPACITY) + 1


def test_empty_tables(spark, empty, labels, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
