import re
from collections import Counter

from pyspark.sql import functions as F

from yellowstar.llm import common
from yellowstar.llm import quality_rules as q

from .conftest import prose


def _expected(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside),
        n < 50 or 100 * len(inside) > 50 * n,
    )


def test_base_counts_equal_brute_force(spark, docs, labels):
    texts = ["a b c a b c a", "x\x0by\fz\tq x y z", "# * < > | &&\n\n#\n#", "w " * 60, "\x1cword\x1f \x85 \xa0"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").union(more)
    want = Counter((r["doc_id"], *_expected(r["text"])) for r in every.collect())
    got = q.judge(every, labels).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_junk_scores_below_prose(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = q.judge(docs, labels)
    met = judged.filter(~F.col("base_failed")).join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")
    )
    share = {r["quality"]: r["share"] for r in met.collect()}
    assert share[1] > 0.99 and share[0] < 0.5


def test_junk_is_rejected_on_small_inputs_too(spark):
    from pyspark.sql import functions as F

    good = [(k, prose(50 + k, 100)) for k in range(40)]
    junk = [(100 + k, " ".join(f"zq{(k * 31 + i * 7) % 97}" for i in range(90))) for k in range(10)]
    docs = spark.createDataFrame(good + junk, "doc_id bigint, text string")
    for copies in (1, 20):  # the verdict does not depend on the size of the input
        every = docs.crossJoin(spark.range(copies)).select((F.col("doc_id") + 1000 * F.col("id")).alias("doc_id"), "text")
        labels = every.filter("doc_id % 1000 < 100").select("doc_id", F.lit(1).alias("quality"))
        kept = [r["doc_id"] % 1000 for r in q.judge(every, labels).filter("kept").collect()]
        assert sorted(kept) == sorted(list(range(40)) * copies)


def test_every_trusted_row_counts(spark):
    labels = spark.range(20_500).selectExpr("id as doc_id", "1 as quality")
    assert q.trusted_ids(labels).count() == 20_500


def test_trusted_texts_are_counted_where_they_are_read(spark, docs, labels, monkeypatch):
    """Their counts are those of a plain join, also when the filter lets others pass, and no text is shuffled for them."""
    more = spark.range(1000, 1200).selectExpr("id as doc_id", "concat('other words ', id) as text")
    rows = docs.select("doc_id", "text").union(more)
    ids = q.trusted_ids(labels)
    met = rows.join(ids, F.col("doc_id") == F.col("trusted_id")).select("text")
    want = q._bucket_counts(met, q.BUCKETS)
    found = []
    counts = q._bucket_counts

    def noted(texts, buckets):
        found.append((texts._jdf.queryExecution().executedPlan().toString(), counts(texts, buckets)))
        return found[-1][1]

    monkeypatch.setattr(q, "_bucket_counts", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ratios = q.log_ratios(rows, ids)
        assert found[0][1] == want and len(found) == 2
        assert not any("SortMergeJoin" in plan for plan, _ in found)
        monkeypatch.setattr(q, "bit_words", lambda k, c: common.bit_words(k, c, 64))
        monkeypatch.setattr(q, "in_bits", lambda d, c, w: common.in_bits(d, c, w, 64))
        assert q.log_ratios(rows, ids) == ratios
        # one word of bits: some others pass and are taken off again
        assert len(found) == 5 and sum(found[3][1]) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kept_rows_keep_their_columns(docs, labels):
    out = q.keep_good(docs, labels)
    assert out.columns == docs.columns
    kept = sorted(r["doc_id"] or -1 for r in q.judge(docs, labels).filter("kept").collect())
    assert sorted(r["doc_id"] or -1 for r in out.collect()) == kept


def test_no_labels_and_empty(docs, empty, labels):
    assert q.judge(docs, labels.limit(0)).filter("kept").count() > 0
    assert q.judge(empty, labels).count() == 0
