import hashlib
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from yellowstar.llm import exact_dedup, passage_dedup, suffix_dedup


def _expected(texts):
    blobs = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in blobs for i in range(len(b) - 199))
    out = []
    for b in blobs:
        hit = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                hit[i : i + 200] = True
        spans = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~hit])
        out.append((len(b), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _more(docs, spark):
    passage = " ".join(f"é{i * 7919 % 997}" for i in range(60))
    rows = [(200 + k, f"{k} " * (k + 1) + passage[: 150 + 10 * k] + f" end {k}") for k in range(30)]
    return docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_removed_bytes_equal_brute_force(spark, docs):
    every = _more(docs, spark)
    rows = every.collect()
    want = Counter((r["doc_id"], *x) for r, x in zip(rows, _expected([r["text"] for r in rows]), strict=True))
    for hot in (suffix_dedup.HOT, 3):  # all in buckets; hot leading strings by window hashes
        got = suffix_dedup.remove_repeats(every, hot=hot).drop("spans").collect()
        assert Counter(map(tuple, got)) == want


def test_empty(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert passage_dedup.repeated_passages(empty).count() == 0


def test_shared_passages_are_found(spark, docs):
    every = _more(docs, spark).filter("doc_id is not null")
    words = {}
    for r in every.collect():
        words.setdefault(r["doc_id"], []).append([w for w in re.split(r"[\x20\x09-\x0d]+", (r["text"] or "").lower()) if w])
    runs = {}
    for i, many in words.items():
        for w in many:
            for k in range(len(w) - 49):
                runs.setdefault(tuple(w[k : k + 50]), set()).add(i)
    want = set().union(*[ids for ids in runs.values() if len(ids) > 1])
    rows = passage_dedup.repeated_passages(every).collect()
    assert len(rows) == every.count()
    assert want <= {r["doc_id"] for r in rows if r["n_links"] or r["group_size"] > 1}
    clean = {r["doc_id"]: r for r in rows}[9]
    assert (clean["n_links"], clean["class_id"], clean["spans"]) == (0, 9, "")


def test_links_equal_brute_force_on_random_excerpts(spark):
    rng = random.Random(11)
    rows, excerpts = [], []
    for s in range(2):
        source = [f"s{s}w{k}" for k in range(300)]
        for k in range(60):
            at, size = rng.randrange(220), rng.randrange(55, 81)
            part = source[at : at + size]
            words = [f"h{s}x{k}y{i}" for i in range(30)] + part + [f"t{s}x{k}y{i}" for i in range(30)]
            rows.append((None if k % 10 == 0 else s * 100 + k, " ".join(words)))
            excerpts.append((s, at, at + len(part)))
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and excerpts[i][0] == excerpts[j][0]
         and min(excerpts[i][2], excerpts[j][2]) - max(excerpts[i][1], excerpts[j][1]) >= 50]
        for i in range(n)
    ]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *[label[j] for j in near[i]]]) for i in range(n)]
    least = {k: min([rows[i][0] for i in range(n) if label[i] == k and rows[i][0] is not None], default=None) for k in label}
    want = Counter((rows[i][0], least[label[i]], len(near[i])) for i in range(n))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for cell in (passage_dedup.CELL, 7):  # whole groups, and groups dealt into cells
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(passage_dedup, "CELL", cell)
            got = passage_dedup.repeated_passages(docs).collect()
        assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want


def test_passages_adjacent_in_one_text_only_are_found_from_both_sides():
    def words(tag, n):
        return [f"{tag}{k}" for k in range(n)]

    def edited(passage):
        return passage[:40] + ["edit"] + passage[41:]

    p, q = words("p", 80), words("q", 80)
    near = words("a", 30) + p + q + words("b", 30)
    apart = words("c", 30) + edited(p) + words("d", 150) + edited(q) + words("e", 30)
    x, y = (passage_dedup.shingles([" ".join(w)], 5)[0] for w in (near, apart))
    want = {(30, 105, 30, 105), (110, 185, 260, 335)}
    assert set(passage_dedup.similar_passages(x, y)) == want
    assert set(passage_dedup.similar_passages(y, x)) == {(c, d, a, b) for a, b, c, d in want}


def test_windows_are_the_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 40, 300).astype(np.uint64)  # with ties
    owner = np.repeat([0, 1, 2], 100)
    got = set(zip(*(x.tolist() for x in passage_dedup.compact_windows(h, owner, 5)), strict=True))
    want = set()
    for c in range(300):
        left = right = c
        while left > 0 and owner[left - 1] == owner[c] and h[left - 1] > h[c]:
            left -= 1
        while right < 299 and owner[right + 1] == owner[c] and h[right + 1] >= h[c]:
            right += 1
        if right - left >= 4:
            want.add((left, c, right))
    assert got == want


def test_equal_windows_choose_equal_anchors_whatever_else_is_in_the_batch(spark):
    """Texts on both sides of the batch size, one-character texts and runs inside others."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    passage = " ".join(word() for _ in range(20))  # 199 bytes and one more below
    passage += "x"
    long = " ".join(word() for _ in range(850_000))
    rows = [(1, passage), (2, passage + long), (3, "z" * 1_000_000), (4, "y" * 150 + word() * 40), (5, "q" * 199), (6, "q" * 150 + "!")]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(rows[0][1]) == 200 and got[1]["n_removed"] == got[2]["n_removed"] == 200
    assert (got[3]["n_removed"], got[3]["n_spans"]) == (1_000_000, 1)
    assert got[4]["n_removed"] == 40 * 9 and got[5]["n_removed"] == got[6]["n_removed"] == 0


def test_anchors_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    # few leading strings, so that their hashes tie often
    blob = rng.integers(97, 99, 4000).astype(np.uint8).tobytes() + b"ab" * 600
    alone = suffix_dedup.anchors([blob])
    for before in (b"", b"short", bytes(rng.integers(0, 200, 300_000).astype(np.uint8))):
        _, ends, owner, at, first, last, h = suffix_dedup.anchors([before, blob])
        own, zero = owner == 1, ends[0]
        assert (at[own] - zero == alone[3]).all() and (first[own] - zero == alone[4]).all()
        assert (last[own] - zero == alone[5]).all() and (h[own] == alone[6]).all()


def test_filter_bits_reach_the_driver_in_blocks(spark):
    from yellowstar.llm.common import twice_bitmap

    values = [v for v in range(0, 400_000, 7) for _ in range(1 + v % 2)]
    bits = np.unpackbits(twice_bitmap(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", 1 << 18), bitorder="little")
    count = np.bincount(np.array(values) & ((1 << 18) - 1), minlength=1 << 18)
    assert (bits.astype(bool) == (count >= 2)).all()
    assert not twice_bitmap(spark.range(0), "id", 1 << 18).any()


def test_open_runs_hold_every_interval_that_may_be_a_passage():
    rng = np.random.default_rng(3)
    owner = np.repeat([0, 1, 3], [150, 40, 260])
    for share in (0.03, 0.1, 0.3):
        alone = rng.random(len(owner)) < share
        first, last = passage_dedup.open_runs(alone, owner)
        held = np.zeros(len(owner), int)
        for k, (a, b) in enumerate(zip(first, last, strict=True)):
            assert owner[a] == owner[b] and not held[a : b + 1].any()
            held[a : b + 1] = k + 1
        for a in range(len(owner)):
            for b in range(a + passage_dedup.MIN_SHINGLES - 1, len(owner)):
                if owner[a] == owner[b] and (~alone[a : b + 1]).sum() * 9 >= (b - a + 1) * 8:
                    assert held[a] and held[a] == held[b]


def test_texts_that_share_a_short_line_only_make_no_candidates(spark, monkeypatch):
    """A common line of twenty words is no passage: no pairs are formed for it and no shingles travel."""
    rng = random.Random(11)
    line = " ".join(f"common{i}" for i in range(20))
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        rows.append((k, " ".join(words[:100]) + "\n" + line + "\n" + " ".join(words[100:])))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(100, passage + " one end"), (101, "another start " + passage)]
    written = {}
    saved = passage_dedup.saved

    def noted(df, name):
        out = saved(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(passage_dedup, "saved", noted)
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got if r["n_links"]} == {100: 100, 101: 100}
    assert (written["passage-pairs"], written["passage-items"]) == (1, 2)


def test_rows_grow_with_the_texts_that_share_a_passage_and_not_with_their_pairs(spark, monkeypatch):
    """Ninety texts share a passage, and some of them two: every link counted, a few rows a text, whatever the cells."""
    rng = random.Random(4)
    passages = [[f"p{k}w{i}" for i in range(60)] for k in range(2)]
    rows = []
    for k in range(90):
        own = [f"w{rng.randrange(10**9)}" for _ in range(80)]
        other = passages[1] if k % 9 == 0 else []
        rows.append((k, " ".join(own[:20] + passages[0] + own[20:50] + other + own[50:])))
    rows += [(100 + k, " ".join([f"s{k}", *passages[1], f"t{k}"])) for k in range(5)]
    written = {}
    saved = passage_dedup.saved

    def noted(df, name):
        out = saved(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(passage_dedup, "saved", noted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for cell in (passage_dedup.CELL, 20):
        monkeypatch.setattr(passage_dedup, "CELL", cell)
        got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(docs).collect()}
        assert {r["class_id"] for r in got.values()} == {0}
        for k in range(90):
            assert got[k]["n_links"] == 89 + (5 if k % 9 == 0 else 0)
            assert got[k]["spans"] == ("20:80,110:170" if k % 9 == 0 else "20:80")
        assert all(got[100 + k]["n_links"] == 14 and got[100 + k]["spans"] == "1:61" for k in range(5))
        assert written["passage-pairs"] < len(rows) and written["passages"] <= 12 * len(rows)


def _sorted(record_batches, key):
    table = pa.Table.from_batches(record_batches).sort_by(key)
    return table.to_batches(max_chunksize=50)


def test_shingles_of_one_text_only_are_known_without_a_table_of_all(monkeypatch):
    """Chunks and blocks of any size tell the same: which sampled shingles no other text has, and which many have."""
    rng = random.Random(6)
    line = [f"line{i}" for i in range(12)]
    passage = [f"p{i}" for i in range(70)]
    texts = []
    for k in range(90):
        own = [f"w{rng.randrange(10**9)}" for _ in range(120)]
        texts.append(" ".join(own[:60] + (passage if k in (7, 80) else line) + own[60:]))
    texts += ["short " * 20, "", "again " * 200, "again " * 200 + "b"]
    each = [passage_dedup.shingles([t])[0] for t in texts]
    where = Counter(h for sh in each if len(sh) >= passage_dedup.MIN_SHINGLES for h in set(sh.tolist()))
    task = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3))
    monkeypatch.setattr(passage_dedup, "TaskContext", task)
    rows = pa.table({"node": range(len(texts)), "text": texts})
    for held, bits, size in ((passage_dedup.HELD, passage_dedup.BLOCK_BITS, 100), (500, 3, 4)):
        monkeypatch.setattr(passage_dedup, "HELD", held)
        monkeypatch.setattr(passage_dedup, "BLOCK_BITS", bits)
        marks = list(passage_dedup._marks(rows.to_batches(max_chunksize=size)))
        known = list(passage_dedup._counted(_sorted(marks, "key")))
        opened = pa.Table.from_batches(passage_dedup._opened(_sorted(known, "chunk"))).to_pylist()
        assert sorted(row["open"] for row in opened) == [7, 80, 92, 93]
        for row in opened:
            sh = each[row["open"]]
            for name, want in (("alone", lambda n: n == 1), ("often", lambda n: n >= passage_dedup.OFTEN)):
                have = np.unpackbits(np.frombuffer(row[name], np.uint8), count=len(sh)).astype(bool)
                assert have.tolist() == [bool(passage_dedup.sampled(h)) and want(where[int(h)]) for h in sh]


def test_near_copies_travel_to_few_places_and_compressed_between_cells(spark, monkeypatch):
    """Near copies of one text have many windows' groups; each goes to one place, and a cell takes little room."""
    rng = random.Random(9)
    source = [f"s{i}" for i in range(400)]
    rows = []
    for k in range(60):
        words = list(source)
        for _ in range(6):
            words[rng.randrange(400)] = f"e{rng.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    saved, tables = passage_dedup.saved, {}

    def noted(df, name):
        tables[name] = saved(df, name)
        return tables[name]

    monkeypatch.setattr(passage_dedup, "saved", noted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(map(tuple, passage_dedup.repeated_passages(docs).collect()))
    assert tables["passage-homes"].select("home").distinct().count() > 1
    assert tables["passage-members"].select("key", "doc_id").distinct().count() <= 1.5 * len(rows)
    seqs = [passage_dedup.shingles([t])[0] for _, t in rows]
    links = [sum(bool(passage_dedup.similar_passages(x, y)) for j, y in enumerate(seqs) if j != i) for i, x in enumerate(seqs)]
    assert [r[2] for r in whole] == links
    monkeypatch.setattr(passage_dedup, "CELL", 20)
    assert sorted(map(tuple, passage_dedup.repeated_passages(docs).collect())) == whole
    packs = [len(r["texts"]) for r in tables["passages"].filter("place is not null").collect()]
    assert packs and max(packs) < 20 * 396 * 8 / 3


def test_passages_of_texts_with_no_shingle_twice_are_those_of_the_general_way():
    rng = np.random.default_rng(8)
    some = 0
    for _ in range(300):
        source = np.arange(1, 500)
        x, y = (source[at : at + 300].copy() for at in rng.integers(0, 120, 2))
        for text in (x, y):
            for at in rng.integers(0, 290, rng.integers(0, 12)):
                text[at : at + 5] = rng.integers(1000, 10**9, 5)
        if rng.random() < 0.5:
            y = np.concatenate([y[150:], y[:150]])
        if len(set(x)) < 300 or len(set(y)) < 300:
            continue
        place = {v: k for k, v in enumerate(x.tolist())}
        places = np.array([place.get(v, -1) for v in y.tolist()])
        want = set(passage_dedup.similar_passages(x.astype(np.uint64), y.astype(np.uint64)))
        code, _, n = passage_dedup._numbered(np.concatenate([x, y]), np.repeat([0, 1], 300))
        assert set(passage_dedup._similar(code[:300], code[300:], None, None, np.zeros(n, bool), places)) == want
        some += bool(want)
    assert some > 100


def test_texts_are_hashed_and_written_once(spark, monkeypatch):
    """Copies are told by the written hashes, and their rows left out by number: null and repeated ids, and ties."""
    text = " ".join(f"c{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text.upper()), (3, "x " + text), (None, "y " + text), (4, text)]
    hashed = []
    text_hash = passage_dedup.text_hash
    monkeypatch.setattr(passage_dedup, "text_hash", lambda c: hashed.append(1) or text_hash(c))
    monkeypatch.setattr(exact_dedup, "text_hash", lambda c: hashed.append(1) or text_hash(c))
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(hashed) == 1
    want = [(1, 3, 2, "0:60", 4)] * 2 + [(None, 3, 2, "0:60", 4), (4, 3, 2, "0:60", 4), (3, 3, 2, "1:61", 1), (None, 3, 2, "1:61", 1)]
    assert Counter((r["doc_id"], r["class_id"], r["n_links"], r["spans"], r["group_size"]) for r in got) == Counter(want)
