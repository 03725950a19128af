"""PII, licence and quality classifiers."""

import hashlib
import re
from collections import Counter

from yellowstar.llm import license_scan, pii, quality_classifier
from yellowstar.llm.weak_labels import estimate
from yellowstar.plans.inspect import python_nodes

# the base patterns as stated, by plain regular expressions
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, match):
    d = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def _base(text):
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, p) in enumerate(PLAIN.items())
        for m in re.finditer(p, text or "")
        if _passes(kind, m.group())
    ]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


TEXTS = [
    "a@b.c@d.e x@y.zz_q@r.st a..b@c.d-e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "4111-1111 1111 1111 9",
    "+1 (555) 123-4567 +12 +1234567890123456 ++1555 123 45 67", "é😀 4111111111111111 +49 30 1234567.", "9" * 3000, "a" * 5000 + "@",
    "call 555-123-4567 or (555) 123 4567 now", "jo [at] mail [dot] com",
]


def test_base_spans_equal_plain_patterns(spark, docs):
    more = spark.createDataFrame([(300 + i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").union(more)
    want = Counter()
    for r in every.collect():
        spans = _base(r["text"])
        kinds = Counter(s.split(":")[0] for s in spans)
        sha = hashlib.sha256(",".join(spans).encode()).hexdigest()
        want[(r["doc_id"], *(kinds[k] for k in pii.KINDS), sha)] += 1
    out = pii.find(every)
    assert python_nodes(out) == []
    rows = out.collect()
    assert Counter(tuple(r)[:6] for r in rows) == want
    texts = {r["doc_id"]: r["text"] for r in every.collect()}
    for r in rows:
        if r["doc_id"] is not None:
            assert set(_base(texts[r["doc_id"]])) <= set(r["spans"].split(",")) or r["doc_id"] == 8


def test_redaction_leaves_no_base_span(docs):
    out = pii.redact(docs)
    assert out.columns == docs.columns and python_nodes(out) == []
    before = Counter(r["text"] for r in docs.collect() if not _base(r["text"]))
    after = [r["text"] for r in out.collect()]
    assert not any(_base(t) for t in after)
    assert not before - Counter(after)
    assert any("<EMAIL>" in t and "<PHONE>" in t and "<CARD>" in t and "<IP>" in t for t in after if t)


def test_no_rows(empty):
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def test_many_spans_in_one_text(spark):
    text = " ".join(f"a{i}@b{i % 97}.example.org" for i in range(6_000)) + " at 10.0.0.1"
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row["n_email"], row["n_ip"]) == (6_000, 1)
    assert row["base_sha256"] == hashlib.sha256(",".join(_base(text)).encode()).hexdigest()


def test_reliabilities_are_found_again():
    import random

    rng = random.Random(5)
    rates, counts, truth = [(0.9, 0.8), (0.7, 0.95), (0.85, 0.6), (0.6, 0.6)], Counter(), Counter()
    for _ in range(40_000):
        good = rng.random() < 0.3
        votes = tuple(0 if rng.random() < 0.2 else (1 if good else -1) * (1 if rng.random() < r[not good] else -1) for r in rates)
        counts[votes] += 1
        truth[votes] += good
    prior, found, post = estimate(counts, rounds=200)
    assert abs(prior - 0.3) < 0.03
    assert all(abs(a - b) < 0.05 for x, y in zip(found, rates, strict=True) for a, b in zip(x, y, strict=True))
    often = [v for v, n in counts.items() if n > 400]
    assert all(abs(post[v] - truth[v] / counts[v]) < 0.12 for v in often)


def test_rows_of_one_id_are_sampled_each_by_its_text(spark, monkeypatch):
    """One id on all rows: the sample stays within its bound, and labels are those of the texts."""
    rows = [(7, " ".join(f"plain{i % 13} and the word of it{k}" for i in range(30))) for k in range(300)]
    rows += [(7, "# $ % " * (40 + k)) for k in range(300)] + [(None, None), (7, "x" * 60_000)]
    seen = []
    fit = quality_classifier.fit
    monkeypatch.setattr(quality_classifier, "fit", lambda b, o, y: seen.append(len(y)) or fit(b, o, y))
    got = quality_classifier.classify(spark.createDataFrame(rows, "doc_id bigint, text string"), sample=10).collect()
    assert len(got) == len(rows) and seen == [20]


def test_the_scorer_separates_what_can_be_separated():
    import numpy as np

    texts = [f"good words here {i}" for i in range(40)] + [f"bad things there {i}" for i in range(40)]
    buckets, owners = quality_classifier.grams(texts)
    labels = np.repeat([1.0, 0.0], 40)
    weights, bias = quality_classifier.fit(buckets, owners, labels)
    z = np.bincount(owners, weights=weights[buckets], minlength=80) + bias
    assert ((z > 0) == (labels == 1)).all()


def test_licences(spark, docs, empty):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "All rights reserved.": "Proprietary",
        "my driver license expired and the licensed plumber came": "",
        "nothing of the kind": "",
    }
    rows = [(400 + i, f"first line\n{t}\n") for i, t in enumerate(lines)]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    out = license_scan.scan(every)
    assert python_nodes(out) == []
    got = out.collect()
    assert len(got) == every.count()
    by = {r["doc_id"]: r["families"] for r in got}
    assert by[15] == "MIT" and by[9] == "" and by[5] == ""
    assert [by[400 + i] for i in range(len(lines))] == list(lines.values())
    assert license_scan.scan(empty).count() == 0


#: Notices in other words than those of the templates, and what is none.
HELD_OUT = [
    ("GPLv3", "GPL"), ("This is GPLv3 licensed code", "GPL"), ("CC BY 4.0", "CC-BY"), ("Licence: Apache 2.0", "Apache-2.0"),
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF", "MIT"),
    ("# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files, to deal in\n# the Software without restriction", "MIT"),
    ("Distributed under the terms of the MIT license", "MIT"),
    ("This file is part of a project under the Mozilla Public License 2.0", "MPL-2.0"), ("Licensed under the ISC license", "ISC"),
    ("European Union Public Licence v1.2", "EUPL"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("The library may be used under the GNU Lesser General Public License, version 3 or newer", "LGPL"),
    ("Our server is offered under the GNU Affero General Public License (AGPL)", "AGPL"),
    ("Photos here carry a Creative Commons Attribution-ShareAlike 3.0 license", "CC-BY-SA"),
    ("All articles are CC BY-NC-ND unless noted", "CC-BY-NC"), ("Data is placed in the public domain using CC0 1.0 Universal", "CC0"),
    ("Code may be redistributed under the BSD-3-Clause license", "BSD"), ("See LICENSE.md: the Apache License, Version 2.0 applies", "Apache-2.0"),
    ("Redistributions of source code must retain the above copyright notice and this list", "BSD"),
    ("(c) 2019 Example Corp. All Rights Reserved.", "Proprietary"),
    ("You should have received a copy of the GNU General Public License along with this tool; if not, write to the foundation", "GPL"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", "ISC"),
    ("The driver showed her licence and left", ""), ("The committee reserved all rights of way", ""), ("permission was granted to any visitor", ""),
    ("The software was provided by a vendor without delay", ""), ("a general public meeting at the library", ""),
    ("He teaches at MIT", ""), ("The Apache helicopter landed", ""), ("They drank in the public house", ""),
    ("copies of the book were distributed free of charge to any person", ""), ("creative work, common sense", ""),
]


def test_notices_in_other_words(spark):
    """The shares stated in the README: each text alone, amid prose lines, and amid prose paragraphs."""
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    prose = [r["text"].split("\n")[0][:300] for r in corpus.filter("length(text) > 300").orderBy("doc_id").limit(60).collect()]
    rows, want = [], {}
    for i, (text, family) in enumerate(HELD_OUT):
        a, b = prose[i % 60], prose[(i * 7 + 3) % 60]
        for k, shown in enumerate((text, f"{a}\n{text}\n{b}", f"{a}\n\n{text}\n\n{b}")):
            rows.append((10_000 + 10 * i + k, shown))
            want[10_000 + 10 * i + k] = family
    every = corpus.union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["doc_id"]: r["families"] for r in license_scan.scan(every).collect()}
    wrong = [(want[i], got[i], dict(rows)[i][:60]) for i in want if got[i] != want[i]]
    print(len(wrong), *wrong, sep="\n")
    named = [i for i in want if want[i]]
    assert sum(got[i] == want[i] for i in named) >= 0.9 * len(named)
    assert not any(got[i] for i in want if not want[i])
    # the corpus' own licence lines, and nothing else
    for r in corpus.collect():
        if got.get(r["doc_id"]):
            assert re.search("licens|rights reserved", r["text"].lower())


def test_the_bound_is_no_less_than_any_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(pii.F.col("doc_id").alias("row"), "text")
    model = license_scan.train(docs)
    lines = [t for t, _ in HELD_OUT] + [r["text"][:2000] for r in docs.limit(100).collect()]
    table = spark.createDataFrame([(t,) for t in lines], "t string").select(license_scan.tokens(pii.F.col("t")).alias("ts"))
    rows = table.select(model.bound(pii.F.col("ts")).alias("bound"), model.scores(pii.F.col("ts")).alias("z")).collect()
    assert all(max(r["z"]) <= r["bound"] + 1e-6 for r in rows)
    assert any(r["bound"] < 0 for r in rows)


def test_only_parts_with_a_predicted_family_are_written(spark, monkeypatch):
    """Lines full of licence words that name no licence leave nothing on disk but a row per document."""
    written = {}
    saved = license_scan.saved

    def noted(df, name):
        written[name] = saved(df, name)
        return written[name]

    monkeypatch.setattr(license_scan, "saved", noted)
    lines = "\n".join("the use of any copy in the public work is granted to a person for the terms of notice" for _ in range(200))
    rows = [(i, f"{lines}\nnumber {i}") for i in range(50)] + [(100, "Licensed under the ISC license")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["families"] for r in got if r["families"]} == {100: "ISC"}
    assert list(written) == ["licence-named"]
    table = written["licence-named"]
    assert table.count() == len(rows)
    parts = table.selectExpr("explode(named) as p").select("p.*")
    assert parts.count() <= 3 and parts.filter("family is null").count() == 0


def test_family_is_that_of_the_best_score(spark):
    """The second look leaves out no part that its scores give a family."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(pii.F.col("doc_id").alias("row"), "text")
    model = license_scan.train(docs)
    lines = [t for t, _ in HELD_OUT] + [r["text"][:2000] for r in docs.limit(100).collect()]
    table = spark.createDataFrame([(t,) for t in lines], "t string").select(license_scan.tokens(pii.F.col("t")).alias("ts"))
    seen = 0
    for r in table.select(model.family(pii.F.col("ts")).alias("family"), model.scores(pii.F.col("ts")).alias("z")).collect():
        k = max(range(len(r["z"])), key=lambda i: r["z"][i])
        prob = license_scan._probabilities(license_scan.np.array([r["z"]]))[0][k]
        assert r["family"] == (license_scan.FAMILIES[k] if prob >= model.floors[k] else None)
        seen += r["family"] is not None
    assert seen > 10


def test_weak_labels_agree_with_held_out_labels(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    got = quality_classifier.classify(spark.read.parquet(f"{sf}/documents.parquet"))
    met = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in met if r["quality"] == 1]
    bad = [r["kept"] for r in met if r["quality"] == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.2 * len(bad)
    assert quality_classifier.classify(docs).count() == docs.count()
    assert quality_classifier.classify(empty).count() == 0
