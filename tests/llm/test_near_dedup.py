from collections import defaultdict

import numpy as np

from yellowstar.llm import near_dedup
from yellowstar.llm.components import components
from yellowstar.llm.shingles import distinct, shingles


def _sets(rows):
    out = []
    for r in rows:
        w = (r["text"] or "").lower().replace("\x0b", " ").split()
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else None)
    return out


def _classes(rows):
    sets = _sets(rows)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return list(groups.values())


def test_classes_equal_brute_force(spark, docs):
    words = [f"w{i}" for i in range(200)]
    family = []
    for k in range(40):  # a large group of near copies, edited in different places
        w = list(words)
        for at in range(k % 5):
            w[(k * 5 + at * 37) % 200] = f"edit{k}-{at}"
        family.append((1000 + k, " ".join(w)))
    every = docs.select("doc_id", "text").union(spark.createDataFrame(family, "doc_id bigint, text string"))
    rows = every.collect()
    want = sorted(
        sorted((rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0) for i in group) for group in _classes(rows)
    )
    got = defaultdict(list)
    alone = 0
    for r in near_dedup.classes(every).collect():
        key = (r["class_id"], r["class_size"]) if r["n_shingles"] else ("alone", alone := alone + 1)
        got[key].append((r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted(sorted(g) for g in got.values()) == want


def test_one_row_of_a_class_stays(docs):
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert out.count() == len(_classes(docs.collect()))


def test_rows_that_share_an_id_or_have_none_go_by_their_own_text(spark):
    def text(tag):
        return [f"{tag}{k}" for k in range(100)]

    def near(words):
        return " ".join([*words[:50], "edit", *words[51:]])

    one, two = text("one"), text("two")
    rows = [
        (1, " ".join(one)),
        (None, near(one)),
        (None, "a text of its own " + " ".join(text("x"))),
        (None, "another text " + " ".join(text("y"))),
        (None, None),
        (2, " ".join(two)),
        (3, near(two)),
        (3, " ".join(text("three"))),
        (3, " ".join(text("three"))),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in near_dedup.keep_one(docs).collect()), key=str)
    assert got == sorted((r for i, r in enumerate(rows) if i not in (1, 6, 8)), key=str)


def test_empty(empty):
    assert near_dedup.classes(empty).count() == 0


def test_signatures_estimate_similarity():
    x, y = np.arange(1000, dtype=np.uint64), np.arange(111, 1111, dtype=np.uint64)
    both, owner = np.concatenate([x, y]), np.repeat([0, 1], 1000)
    ranks = near_dedup.dart_minhash(both, owner, 2, k=4096)
    assert abs((ranks[0] == ranks[1]).mean() - 889 / 1111) < 0.04
    weights = np.concatenate([np.full(1000, 2.5), np.full(1000, 1.5)])
    ranks = near_dedup.dart_minhash(np.concatenate([x, x]), owner, 2, k=4096, weights=weights)
    assert abs((ranks[0] == ranks[1]).mean() - 0.6) < 0.04


def test_signatures_do_not_depend_on_the_batch():
    texts = ["a b c d e f g " * 5, "", "one", "x y z " * 300]
    h, o = distinct(*shingles(texts)[:2])
    whole = near_dedup.dart_minhash(h, o, len(texts))
    for i, t in enumerate(texts):
        h1, o1 = distinct(*shingles([t])[:2])
        assert (near_dedup.dart_minhash(h1, o1, 1)[0] == whole[i]).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + k) for k in range(1, 30)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert set(got.values()) == {1, 100} and len(got) == 60


def test_words_of_a_regular_pattern_stand_apart(spark):
    """A long word and its complement, whose polynomial hashes modulo 2**64 are equal."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    h, owner, _ = shingles([one, two])
    assert owner.tolist() == [0, 1] and h[0] != h[1]
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id bigint, text string")
    assert {(r["doc_id"], r["class_id"], r["kept"]) for r in near_dedup.classes(docs).collect()} == {
        (1, 1, True), (2, 2, True), (3, 1, False)
    }


def test_similarity_is_that_of_the_sets():
    def text(*parts):
        return " ".join(f"w{i}" for part in parts for i in part)

    # 100 shingles each
    base = text(range(104))
    texts = [base, text(range(93), range(200, 211)), text(range(92), range(200, 212)), base, "one two", "ONE two", "one two three"]
    assert near_dedup.similar([(0, 1), (0, 2), (0, 3), (4, 5), (4, 6), (0, 4)], texts) == [True, False, True, True, False, False]


def test_scratch_tables_go(spark, docs):
    import os

    from yellowstar.session import ensure_checkpoint_dir

    def tables():
        return {x.rsplit("-", 1)[0] for x in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:"))}

    before = tables()
    near_dedup.classes(docs).count()
    assert not {"sketches", "bucket-members", "candidate-texts", "pairs", "links", "edges"} & (tables() - before)
