"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Base rules count words, symbols, repeated lines and repeated three-word
windows. The method compares two multinomials over hashed n-grams (single
words and neighbouring pairs): one estimated from trusted target documents, one
from the whole raw corpus. A document's score is the mean over its n-grams of
``ln p_target - ln p_raw``, the target smoothed towards the raw corpus; a document is kept when the base
rules pass and the score reaches a fixed threshold.

Log ratios are rounded to millionths and summed as integers, so the verdict
does not depend on the order of the sums, on partitions or on machines.

The smoothing grows with the target (the raw distribution weighs ``SHARE`` times
the target's n-grams), so an n-gram that no trusted document holds scores the
same whatever the size of the input. What a trusted n-gram loses on average when
it is left out itself is given back to all, so that few trusted documents don't
reject unseen ones of their kind.

Bounds: the tables have ``BUCKETS`` rows whatever the corpus. Both multinomials
count every document of theirs (``max_trusted``, if given, takes the trusted
rows of smallest id hash); only texts of trusted documents shuffle.

Only DataFrame functions, no Python on the executors.

Defined cases: null text has no words and fails; so does any text under 50
words. Without trusted rows all ratios are zero and only the base rules decide. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_words, discard, id_text, in_bits, long_array, saved

BUCKETS = 1 << 14
#: Weight of the raw distribution in the target, as a share of the target's n-grams.
SHARE = 1.0
#: Mean log ratio, in millionths, that a document must reach.
THRESHOLD = -30_000
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """Words: runs of anything but space and the characters 9 to 13."""
    rare = F.lit(False)
    for c in "\t\x0b\f\r":
        rare = rare | F.contains(text, F.lit(c))
    # splitting at one character needs no regular expression
    split = F.when(rare, F.split(text, r"[\x20\x09-\x0D]+")).otherwise(
        F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    )
    return F.array_remove(split, "")


def _once(f, value: Column) -> Column:
    """``f`` of an array value that is computed once per row, not once per use; ``f`` gives a number."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _windows(hashes: Column) -> Column:
    """Hash of each three-word window, from the hashes of the words."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


#: Up to so many repeated windows a text is searched for each of them; beyond, its windows are sorted.
FEW = 32


def _repeated(windows: Column) -> Column:
    """The distinct hashes that the array holds twice or more."""
    return _once(
        lambda ordered: F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i - 1))),
        F.sort_array(windows),
    )


def _starts(windows: Column, repeated: Column) -> Column:
    """Positions of the windows found twice or more, ascending."""

    def sorted_starts(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda x, i: x["h"].eqNullSafe(F.get(pairs, i - 1)["h"]) | x["h"].eqNullSafe(F.get(pairs, i + 1)["h"]),
        )
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    searched = F.array_compact(F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i)))
    ordered = _once(sorted_starts, F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    return F.when(F.size(repeated) <= FEW, searched).otherwise(ordered)


def _covered(windows: Column) -> Column:
    """Words in the windows whose hash is in the array twice or more."""

    def count(starts: Column) -> Column:
        # each window adds the words that the previous one does not cover
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get(starts, i - 1), F.lit(-3)))),
            F.lit(0).cast("bigint"),
            lambda n, more: n + more,
        )

    return _once(lambda again: _once(count, _starts(windows, again)), _repeated(windows))


def repeated_window_words(hashes: Column) -> Column:
    """Words that lie in a three-word window found twice or more, from the hashes of the words."""
    return _once(
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(_covered(w)),
        _windows(hashes),
    )


def with_word_hashes(docs: DataFrame) -> DataFrame:
    """``docs`` with the words (``ws``) and their hashes (``hs``)."""
    return docs.withColumn("ws", words(F.col("text"))).withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ws, hs) with the base columns and the base rule's verdict."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("ls", lines).select(
        "doc_id",
        "hs",
        F.size("ws").cast("bigint").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("hs")).cast("bigint").alias("n_repeat_words"),
    )
    return out.withColumn(
        "base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    )


def _bucket(h: Column, buckets: int) -> Column:
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def _pair(hashes: Column, h: Column, i: Column) -> Column:
    """Hash of a word and its successor; the last word pairs with the end of the text."""
    return F.xxhash64(h, F.coalesce(F.get(hashes, i + 1), F.lit(0).cast("bigint")))


def trusted_ids(labels: DataFrame, max_trusted: int | None = None) -> DataFrame:
    """Ids labelled good: all, or at most ``max_trusted``, those of smallest id hash."""
    good = labels.filter("quality = 1").select(labels["doc_id"].alias("trusted_id")).dropna().distinct()
    return good if max_trusted is None else good.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(max_trusted)


def _bucket_counts(docs: DataFrame, buckets: int) -> list[int]:
    """N-grams per bucket."""
    # one row per word, then its two n-grams: all in generated code
    at = docs.select(words(F.col("text")).alias("ws")).select("ws", F.posexplode("ws").alias("i", "w"))
    nxt = F.get("ws", F.col("i") + 1)
    single = F.xxhash64("w")
    pair = F.xxhash64(single, F.coalesce(F.when(nxt.isNotNull(), F.xxhash64(nxt)), F.lit(0).cast("bigint")))
    grams = at.select(F.explode(F.array(_bucket(single, buckets), _bucket(pair, buckets))).alias("b"))
    counts = [0] * buckets
    for row in grams.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``buckets`` rows
        counts[row["b"]] = row["n"]
    return counts


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Log ratio per bucket in millionths; ``docs`` has doc_id and text, ``trusted`` distinct ids."""
    ids = trusted.select(F.col("trusted_id").cast(docs.schema["doc_id"].dataType).alias("trusted_id"))
    ids = ids.dropna().distinct()
    # the filter lets all trusted texts pass and a few others; only ids and those few texts meet in joins, so what
    # shuffles does not depend on whether the planner can broadcast the ids
    maybe = in_bits(docs.filter("doc_id is not null"), "doc_id", bit_words(ids, "trusted_id"))
    others = maybe.select(F.col("doc_id").alias("other")).distinct()
    others = saved(others.join(ids, F.col("other") == F.col("trusted_id"), "left_anti"), "passed-ids")
    target = _bucket_counts(maybe.select("text"), buckets)
    if others.limit(1).count():
        passed = in_bits(maybe, "doc_id", bit_words(others, "other")).join(others, F.col("doc_id") == F.col("other"))
        target = [m - e for m, e in zip(target, _bucket_counts(passed.select("text"), buckets), strict=True)]
    discard(others)
    raw = [1 + n for n in _bucket_counts(docs, buckets)]
    all_raw, all_target = sum(raw), sum(target)
    if not all_target:
        return [0] * buckets
    # the target is smoothed towards the raw corpus
    prior = SHARE * all_target
    smooth = [(t + prior * r / all_raw) / (all_target + prior) for r, t in zip(raw, target, strict=True)]
    ratios = [math.log(p * all_raw / r) for r, p in zip(raw, smooth, strict=True)]
    # what a trusted n-gram gets on average when it is left out of the target itself: little evidence
    # makes it negative, and an unseen document of the target's kind must not be charged with that
    left_out = [(max(t - 1, 0) + prior * r / all_raw) / (all_target - 1 + prior) for r, t in zip(raw, target, strict=True)]
    unseen = sum(t * math.log(p * all_raw / r) for r, t, p in zip(raw, target, left_out, strict=True)) / all_target
    return [round(1e6 * (x - min(0.0, unseen))) for x in ratios]


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    max_trusted: int | None = None,
) -> DataFrame:
    """One row per document: base columns, ``score`` and ``kept``."""
    rows = id_text(docs, id_col, text_col)
    ratios = log_ratios(rows, trusted_ids(labels, max_trusted))
    return _judged(rows, ratios, threshold)


def _judged(rows: DataFrame, ratios: list[int], threshold: int) -> DataFrame:
    table, size = long_array(ratios), len(ratios)
    hs = F.col("hs")
    gains = F.transform(
        hs, lambda h, i: F.get(table, _bucket(h, size)) + F.get(table, _bucket(_pair(hs, h, i), size))
    )
    counted = base_counts(with_word_hashes(rows))
    scored = counted.withColumn("total", F.aggregate(gains, F.lit(0).cast("bigint"), lambda n, x: n + x))
    grams = F.col("n_words") * 2
    # the row number, always at least 0, keeps the optimizer from copying the whole verdict into a filter below
    once = F.monotonically_increasing_id() >= 0
    return scored.select(
        *[c for c in counted.columns if c != "hs"],
        (F.col("total") / F.greatest(grams, F.lit(1)) / 1e6).alias("score"),
        (~F.col("base_failed") & (F.col("total") >= grams * threshold) & once).alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    max_trusted: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = id_text(docs, id_col, text_col)
    ratios = log_ratios(rows, trusted_ids(labels, max_trusted))
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    return _judged(packed, ratios, threshold).filter("kept").select("doc_id.*")
