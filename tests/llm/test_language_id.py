import math
import random
import zlib
from collections import defaultdict

import pytest

from yellowstar.llm import language_id as ppm

LANGS = {
    "aa": "the of and thing when other water little sound after",
    "bb": "der und die nicht über straße können mädchen größe",
    "cc": "les une été garçon être où français leçon",
    "dd": "日本 言葉 水 です から まで 学校",
}


def _text(rng, lang, n):
    return " ".join(rng.choice(LANGS[lang].split()) + rng.choice(["", "", "s", "n"]) for _ in range(n))


def _rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "aa" if i % 3 == 0 else rng.choice(sorted(LANGS))
        rows.append((i, _text(rng, lang, rng.randint(3, 60)), lang))
    return rows + [
        (1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 -- 5", "cc"), (1003, "the thing", None), (None, "und nicht", "bb"),
        (None, None, None), (5, "the water", "aa"), (5, "the water", "aa"), (1004, "é", "cc"), (1005, "x", None),
        (1006, _text(rng, "bb", 90_000), "bb"), (1007, "\x00͸ Ω", None),
    ]


def _model(rows):
    """Counts of every order by plain loops over the training rows."""
    trees = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for i, text, lang in rows:
        if i is None or zlib.crc32(str(i).encode()) % 4 == 2 or lang is None or text is None:
            continue
        data = b"\n\n\n" + text.encode()
        for at in range(3, len(data)):
            for order in range(4):
                trees[lang][data[at - order : at]][data[at]] += 1
    return trees


def _length(tree, text):
    unit, total = 1 << 16, 0
    data = b"\n\n\n" + text.encode()
    for at in range(3, len(data)):
        for order in (3, 2, 1, 0):
            seen = tree.get(data[at - order : at])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[at] in seen:
                total += round(unit * math.log2(whole / seen[data[at]]))
                break
            total += round(unit * math.log2(whole / len(seen)))
        else:
            total += 8 * unit
    return total


def _brute(rows):
    trees, out = _model(rows), []
    for i, text, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if text is None or not any(c.isalpha() for c in text):
            out.append((i, held, "und", 0.0))
            continue
        bits = {lang: _length(t, text) for lang, t in trees.items()}
        best = min(sorted(bits), key=bits.get)
        out.append((i, held, best, 1 / sum(2 ** ((bits[best] - b) / (1 << 16)) for b in bits.values())))
    return sorted(out, key=str)


def _table(spark, rows):
    return spark.createDataFrame([(*r, "src", 1.0) for r in rows], "doc_id bigint, text string, lang string, source string, score double")


@pytest.fixture(scope="module")
def rows():
    return _rows(1, 150)


def _same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-9)


def test_predictions_equal_brute_force(spark, rows):
    got = sorted(map(tuple, ppm.held_out_predictions(_table(spark, rows).repartition(5)).collect()), key=lambda r: str(r[:3]))
    want = sorted(_brute(rows), key=lambda r: str(r[:3]))
    _same(got, want)
    truth = dict((i, lang) for i, text, lang in rows if text and lang and i is not None)
    held = [r for r in got if r[1] and r[2] != "und" and r[0] in truth]
    assert sum(truth[r[0]] == r[2] for r in held) / len(held) >= 0.95


def test_chunks_and_early_counts_change_nothing(spark, rows, monkeypatch):
    table = _table(spark, rows)
    want = sorted(map(tuple, ppm.held_out_predictions(table).collect()), key=lambda r: str(r[:3]))
    monkeypatch.setattr(ppm, "CHUNK", 1 << 7)
    monkeypatch.setattr(ppm, "HELD", 100)
    got = sorted(map(tuple, ppm.held_out_predictions(table.repartition(3)).collect()), key=lambda r: str(r[:3]))
    _same(got, want)


def test_language_of_the_row_is_no_input(spark, rows):
    table = _table(spark, rows)
    trees = ppm.train(table)
    a = sorted(map(tuple, ppm.identify(table.select("doc_id", "text"), trees).collect()), key=str)
    b = sorted(map(tuple, ppm.identify(table.withColumnRenamed("lang", "best"), trees).collect()), key=str)
    assert a == b


def test_bounded_trees_stay_near_their_bound(spark, rows):
    table = _table(spark, rows)
    counts = ppm.window_counts(table.select("lang", "text").dropna()).groupBy("lang", "gram").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    few = ppm.bounded(counts, 200)
    per = {r["lang"]: r["count"] for r in few.groupBy("lang").count().collect()}
    assert set(per) == set(LANGS) and max(per.values()) <= 60 and min(per.values()) >= 35
    lowest = {r["lang"]: r["n"] for r in few.groupBy("lang").agg({"n": "min"}).withColumnRenamed("min(n)", "n").collect()}
    assert min(lowest.values()) > 1


def test_nothing_to_learn_and_empty(spark, empty):
    table = spark.createDataFrame([(1, "word", None), (2, None, None)], "doc_id bigint, text string, lang string")
    assert {tuple(r)[2:] for r in ppm.held_out_predictions(table).collect()} == {("und", 0.0)}
    out = ppm.held_out_predictions(table.limit(0))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == 0
