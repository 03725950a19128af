"""Source divergence audit: how far each source's word use lies from every other's of its language.

A term is a run of ASCII letters and characters beyond ASCII, A-Z lower-cased.
Tasks count the terms of their documents by language and source; the counts
meet once, dealt by language and term, and terms of fewer than three documents
of the language go. Each kept term gets a number. A group's (term number,
count) arrays, sorted, are cut into shards of some thousand terms by the
term's hash, so that neither a hot source nor a large vocabulary makes a long
array.

Each unordered pair of a language's sources and each shard is one pair task:
the two sorted arrays are co-grouped, the smaller one is searched in the
larger one, and the task prices both directions at once: overlapping terms by
both counts, one-sided terms by one count, absent terms by the rest of the
vocabulary. A pair's tasks are added up. All arithmetic is in whole numbers:
with ``p = 1 + floor(10^9 * (count + 1) / (N + V))`` a term's divergence of
``p`` from ``q`` is ``floor((p - q)^2 / q)``.

Defined cases: null text, language and source read as empty text; the empty
language and the empty source are groups like any other. A group without terms
still has its pairs, and with no kept term at all every pair's value is 0. A
language with a single source has no pairs. Repeated rows count each, and so do
rows whose id is null: ids are not read. Ties of rank go by the item's UTF-8
bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, ship_package, text_batches

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: Terms of a shard, about: the length of the longest array of a pair task.
SHARD_TERMS = 2048
#: Distinct (group, term) counts that a task holds before it hands them on.
HELD = 400_000
#: Bytes of a text that are split at once; the cut lies between two terms.
CHUNK = 1 << 20

#: Letters stay (A-Z lower-cased), bytes of characters beyond ASCII stay, all else separates.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes):
    """Lists of a text's terms, as UTF-8 bytes."""
    text = text.translate(_LETTERS)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: partial counts of each task over ``docs`` (lang, source, text)."""

    def run(batches):
        import pyarrow as pa

        words: dict[tuple, Counter] = {}
        within: dict[tuple, Counter] = {}

        def rows():
            for group, counts in words.items():
                keys = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group[0]] * len(keys), pa.string()),
                        pa.array([group[1]] * len(keys), pa.string()),
                        pa.array(keys, pa.binary()).cast(pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                        pa.array([within[group][k] for k in keys], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()), strict=True):
                count = words.setdefault((lang, source), Counter())
                seen = set()
                for part in terms(text.as_py()):
                    count.update(part)
                    seen.update(part)
                within.setdefault((lang, source), Counter()).update(seen)
            if sum(map(len, words.values())) > HELD:
                yield from rows()
                words, within = {}, {}
        yield from rows()

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def scaled(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total) in whole numbers, three digits of the quotient at a time."""
    whole, rest = np.divmod(np.asarray(count, np.int64) + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return 1 + whole


def _divergence(p, q):
    return (p - q) ** 2 // q


def price_pair(ids_a, n_a, ids_b, n_b, total_a: int, total_b: int) -> tuple[int, int, int]:
    """Divergence of a from b and of b from a over the terms that either has, and the number of those terms.

    The ids are sorted; the totals are N + V of each group.
    """
    swap = len(ids_a) > len(ids_b)
    if swap:
        ids_a, n_a, ids_b, n_b, total_a, total_b = ids_b, n_b, ids_a, n_a, total_b, total_a
    at = np.searchsorted(ids_b, ids_a)
    met = np.zeros(len(ids_a), bool)
    inside = at < len(ids_b)
    met[inside] = ids_b[at[inside]] == ids_a[inside]
    alone = np.ones(len(ids_b), bool)
    alone[at[met]] = False
    pa, pb = scaled(n_a, total_a), scaled(n_b, total_b)
    none_a, none_b = scaled(0, total_a), scaled(0, total_b)
    other = np.where(met, pb[np.minimum(at, len(pb) - 1)] if len(pb) else none_b, none_b)
    ab = int(_divergence(pa, other).sum()) + int(_divergence(none_a, pb[alone]).sum())
    ba = int(_divergence(other, pa).sum()) + int(_divergence(pb[alone], none_a).sum())
    return (ba, ab, len(pa) + int(alone.sum())) if swap else (ab, ba, len(pa) + int(alone.sum()))


def price_pairs(tasks: DataFrame) -> DataFrame:
    """lang, a, b, ab, ba of each pair task; the absent terms of all shards are priced in shard 0."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            shard, na, nb, v = (batch.column(i).to_pylist() for i in range(3, 7))
            lists = [batch.column(i) for i in range(7, 11)]
            ends = [c.offsets.to_numpy() for c in lists]
            values = [c.values.to_numpy(zero_copy_only=False) for c in lists]
            out = []
            for i in range(batch.num_rows):
                if not v[i]:
                    out.append((0, 0))
                    continue
                total_a, total_b = na[i] + v[i], nb[i] + v[i]
                arrays = [x[e[i] : e[i + 1]] for x, e in zip(values, ends, strict=True)]
                ab, ba, either = price_pair(*arrays, total_a, total_b)
                absent = (v[i] if shard[i] == 0 else 0) - either
                p, q = int(scaled(0, total_a)), int(scaled(0, total_b))
                out.append((ab + absent * _divergence(p, q), ba + absent * _divergence(q, p)))
            pairs = [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *pairs], names=["lang", "a", "b", "ab", "ba"])

    return tasks.mapInArrow(run, "lang string, a string, b string, ab bigint, ba bigint")


def _scaled(count: str, total: Column) -> Column:
    """``scaled`` as a column expression, in decimals."""
    product = (F.col(count) + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", product, total.cast("decimal(20,0)")) + 1


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    spark = docs.sparkSession
    ship_package(spark)
    text_batches(spark)
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = rows.select("lang", "source").distinct()
    # dealt by language and term once: both sums and the document count need no other exchange
    dealt = term_counts(rows).repartition("lang", "term")
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("source", "n")).alias("by"), F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs)
    )
    kept = saved(kept.select("lang", "term", "by", "lang_n").withColumn("term_id", F.monotonically_increasing_id()), "terms")
    entries = kept.select("lang", "term", "term_id", "lang_n", F.explode("by").alias("e")).select(
        "lang", "term", "term_id", "lang_n", "e.source", "e.n"
    )
    langs = kept.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    sums = entries.groupBy(F.col("lang").alias("l2"), F.col("source").alias("s2")).agg(F.sum("n").alias("total"))
    groups = saved(
        groups.join(langs, F.col("lang") == F.col("l"), "left")
        .join(sums, (F.col("lang") == F.col("l2")) & (F.col("source") == F.col("s2")), "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("v", "total", "lang_total")]),
        "groups",
    )
    most = groups.agg(F.max("v")).first()[0] or 0
    shards = max(1, -(-most // SHARD_TERMS))

    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")
    # every group has every shard, if with empty arrays: a one-sided shard is priced too
    frame = groups.select("lang", "source", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    blocks = (
        entries.select("lang", "source", shard.alias("shard"), F.struct("term_id", "n").alias("e"))
        .unionByName(frame.withColumn("e", F.lit(None).cast("struct<term_id:bigint,n:bigint>")))
        .repartition("lang", "shard")
        .groupBy("lang", "source", "shard")
        .agg(F.sort_array(F.collect_list("e")).alias("e"))
        .select("lang", "source", "shard", F.col("e.term_id").alias("ids"), F.col("e.n").alias("ns"))
    )
    side = blocks.join(groups.select("lang", "source", "total", "v"), ["lang", "source"])
    a, b = (side.select("lang", "shard", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "total", "v", "ids", "ns")]) for x in "ab")
    tasks = a.join(b, ["lang", "shard"]).filter("source_a < source_b")
    priced = price_pairs(
        tasks.select("lang", "source_a", "source_b", "shard", "total_a", "total_b", "v_a", "ids_a", "ns_a", "ids_b", "ns_b")
    )
    both = priced.groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    directions = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")),
    )
    pairs = both.select("lang", F.explode(directions).alias("d")).select("lang", "d.*")

    priced_terms = entries.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        _scaled("n", F.col("total") + F.col("v")).alias("p"),
        _scaled("lang_n", F.col("lang_total") + F.col("v")).alias("q"),
    )
    above = priced_terms.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    # the rank bound is applied in each task before rows meet in their group
    return _ranked(pairs, "pair").unionByName(_ranked(above, "term").filter(F.col("rank") <= top))
