import hashlib
from collections import defaultdict

from yellowstar.llm import exact_dedup


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_groups_equal_brute_force(docs):
    rows = [(r["doc_id"], _lower(r["text"])) for r in docs.collect()]
    by = defaultdict(list)
    for i, t in rows:
        by[t].append(i)
    got = exact_dedup.copy_groups(docs).collect()
    assert len(got) == len(rows)
    shas = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in by.items()}
    for r in got:
        ids = shas[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == (max(known) if known else None)
    # one row of each group stays, also of repeated rows
    assert sum(r["kept"] for r in got) == len(by)


def test_rows_that_stay_keep_their_columns(docs):
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["text"] for r in out.collect() if r["doc_id"] == 8) == ["short text"]
    assert out.count() == sum(r["kept"] for r in exact_dedup.copy_groups(docs).collect())


def test_full_filter_only_costs_work(docs, monkeypatch):
    want = sorted(map(tuple, exact_dedup.copy_groups(docs).collect()), key=str)
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 64)
    assert sorted(map(tuple, exact_dedup.copy_groups(docs).collect()), key=str) == want


def test_empty(empty):
    assert exact_dedup.copy_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
