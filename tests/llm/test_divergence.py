import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from yellowstar.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def _brute(rows):
    count, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(UPPER))
        count[lang, source].update(found)
        docs[lang].update(set(found))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [w for w, n in docs[lang].items() if n >= 3]
        p = {}
        for s in [*sources, None]:
            c = count[lang, s] if s is not None else sum((count[lang, x] for x in sources), Counter())
            total = sum(c[w] for w in kept) + len(kept)
            p[s] = {w: (c[w], 1 + 10**9 * (c[w] + 1) // total) for w in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(t, sum(f(p[s][w][1], p[t][w][1]) for w in kept)) for t in sources if t != s]
            term = [(w, f(x, p[None][w][1])) for w, (n, x) in p[s].items() if n > 0 and x > p[None][w][1]]
            for part, items, most in (("pair", pair, None), ("term", term, 200)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, w, v, i + 1) for i, (w, v) in enumerate(items[:most])]
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Été", "ÉTÉ", "日本", "ß", "don't", "a1b"]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        k = int(rng.random() ** 3 * 300) + 1
        rows.append((["en", "de", None, "fr"][i % 4], source, " ".join(rng.choice(words[: k + 6]).title() for _ in range(rng.randint(0, 60)))))
    return rows + [
        ("en", None, "alone"), ("en", "empty", None), ("en", "empty", ""), ("xx", "only", "one two"), ("yy", "a", "p"), ("yy", "b", "q"),
        ("en", "long", "repeat word " * 40_000),
        *[("en", "wordy", " ".join(f"x{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)))] * 3,
        ("en", "s1", "same row"), ("en", "s1", "same row"), ("en", "s1", "same row"),
    ]


@pytest.mark.parametrize("terms_a_shard", [2048, 37])
def test_audit_equals_brute_force(spark, monkeypatch, terms_a_shard):
    monkeypatch.setattr(divergence, "SHARD_TERMS", terms_a_shard)
    rows = _rows(1, 240)
    table = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, text string, v int, item string")
    got = [tuple(r) for r in divergence.audit(table.repartition(5)).collect()]
    assert sorted(got) == _brute(rows)
    assert max(r[5] for r in got if r[2] == "term") == 200


def test_partial_counts_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    monkeypatch.setattr(divergence, "CHUNK", 50)
    rows = _rows(2, 40)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(table).collect())) == _brute(rows)


def test_empty(empty):
    from pyspark.sql import functions as F

    out = divergence.audit(empty.withColumns({"lang": F.lit("en"), "source": F.lit("s")}))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0


def test_scaled_is_exact_for_large_counts():
    rng = random.Random(4)
    for _ in range(500):
        total = rng.randint(1, 9 * 10**15)
        count = rng.randint(0, total)
        assert int(divergence.scaled(np.array([count]), total)[0]) == 1 + 10**9 * (count + 1) // total
