"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is the set of its five-word shingles (lower-cased); two are near
duplicates from a Jaccard similarity of 0.8, and classes are the connected
components of that relation.

DartMinHash throws darts at the weighted elements: each unit of an element's
weight is a region that receives darts in order of rank (exponential gaps),
the dart's place, coordinate and weight being hashes of the element alone, so
documents that share an element see the same darts. Each of ``COORDINATES``
coordinates keeps its earliest dart. Ranks up to about
``COORDINATES * ln(COORDINATES) / weight`` suffice, so the work is
proportional to elements plus coordinates, not to their product. The ranks are
the signature: ``BANDS`` bands of ``ROWS`` ranks; documents with an equal band
are candidates (a pair of similarity 0.8 shares no band with probability
3e-5, one of 0.9 with 2e-14).

Groups are never expanded into pairs. Equal sets are one node. Buckets of the
same nodes (a pair of similar documents shares dozens of bands) count once.
Every member of a bucket is compared with one centre, its least node; a
further round, with a few other centres, compares only members whose
component still differs from the centre's. A last step takes the members of
buckets that still hold several components and compares those of different
components that share a rare shingle, by the prefix rule that no similar pair
escapes. All comparisons are exact, on whole texts, as sets of 64-bit shingle
hashes; what travels to a comparison are the two texts, which are shorter than
their sets.

Defined cases: null and empty texts and texts without words have no
shingles and stand alone; a text of one to four words has one shingle and
matches its equals. Repeated rows are members of the same class. The class id
is the least id of its documents (null only if all are null). An empty table
gives an empty result; other columns are untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, bit_words, discard, flag_bits, in_bits, map_texts, saved, ship_package, text_batches
from .components import components
from .shingles import C1, C2, distinct, mix, shingles

ROWS = 8
BANDS = 56
COORDINATES = ROWS * BANDS
#: Centres per bucket in each round before the prefix rule.
CENTRES = (1, 5)


def _uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers of [0, 1)."""
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def dart_minhash(
    hashes: np.ndarray, owners: np.ndarray, n: int, k: int = COORDINATES, weights: np.ndarray | None = None
) -> np.ndarray:
    """Ranks of the earliest darts: an ``n`` x ``k`` array; owners without elements have infinite ranks.

    ``hashes`` are distinct per owner; ``weights`` (positive; None: all one)
    give each element its area.
    """
    if weights is None:
        elements, doc, part = mix(hashes), owners, None
    else:
        slabs = np.ceil(weights).astype(np.int64)
        at = np.repeat(np.arange(len(hashes)), slabs)
        level = np.arange(len(at)) - np.repeat(np.cumsum(slabs) - slabs, slabs)
        # the first unit is the element itself, so that equal weights agree with no weights
        elements = np.where(level == 0, mix(hashes[at]), mix(hashes[at] ^ mix(level.astype(np.uint64))))
        doc = owners[at]
        part = weights[at] - level  # the last unit of an element may be in part
    area = np.bincount(doc, weights=None if part is None else np.minimum(part, 1), minlength=n)
    limit = np.where(area > 0, k * (np.log(k) + 3) / np.maximum(area, 1e-12), 0.0)
    ranks = np.full(n * k, np.inf)
    last = np.zeros(len(elements))  # rank of each region's latest dart
    thrown = np.zeros(len(elements), np.uint64)
    doc = doc.astype(np.int64)
    waiting = np.arange(len(elements))
    while True:
        active = waiting[last[waiting] <= limit[doc[waiting]]]
        while len(active):
            block = 4 if len(active) > 20_000 else 32
            j = thrown[active][:, None] + np.arange(1, block + 1, dtype=np.uint64)
            h = mix(elements[active][:, None] ^ (j * C2))
            rank = last[active][:, None] + np.cumsum(-np.log1p(-_uniform(h)), axis=1)
            last[active], thrown[active] = rank[:, -1], j[:, -1]
            ok = rank <= limit[doc[active]][:, None]
            g = mix(h ^ C1)
            if part is not None:
                ok &= _uniform(mix(g)) < part[active][:, None]
            rows, _ = np.nonzero(ok)
            place = doc[active][rows] * k + (g[ok] % np.uint64(k)).astype(np.int64)
            np.minimum.at(ranks, place, rank[ok])
            active = active[last[active] <= limit[doc[active]]]
        empty = (np.isinf(ranks).reshape(n, k).any(axis=1)) & (area > 0)
        if not empty.any():
            return ranks.reshape(n, k)
        # rare: some coordinate has no dart yet; throw all darts of those owners anew, up to a larger rank
        limit[~empty] = -1.0
        limit[empty] *= 2
        again = empty[doc]
        last[again], thrown[again] = 0.0, 0
        waiting = waiting[empty[doc[waiting]]]


def band_keys(ranks: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` ranks; the band's number is part of the key."""
    bits = ranks.view(np.uint64).reshape(len(ranks), -1, rows)
    keys = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(rows):
        keys = mix(keys ^ bits[:, :, r])
    return keys.view(np.int64)


def _set_keys(h: np.ndarray, o: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit key of each text's set."""
    size = np.bincount(o, minlength=n)
    keys = []
    for salt in (C1, C2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ salt), dtype=np.uint64)])
        ends = np.cumsum(size)
        keys.append((total[ends] - total[ends - size]).view(np.int64))
    return size, keys[0], keys[1]


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (shingles), k1 and k2 (key of the set), bands (keys; empty for texts without shingles)."""

    def run(texts):
        h, o, _ = shingles(texts)
        h, o = distinct(h, o)
        size, k1, k2 = _set_keys(h, o, len(texts))
        bands = band_keys(dart_minhash(h, o, len(texts)))
        return None, {"n": size, "k1": k1, "k2": k2, "bands": [b if s else b[:0] for b, s in zip(bands, size, strict=True)]}

    return map_texts(docs, run, "n bigint, k1 bigint, k2 bigint, bands array<bigint>", id_col, text_col)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the sorted set of shingle hashes."""

    def run(texts):
        h, o, _ = shingles(texts)
        h, o = distinct(h, o)
        return None, {"items": np.split(h.view(np.int64), np.cumsum(np.bincount(o, minlength=len(texts)))[:-1])}

    return map_texts(docs, run, "items array<bigint>", id_col, text_col)


def similar(pairs: list[tuple[int, int]], texts: list[str]) -> list[bool]:
    """Whether the two numbered texts of each pair have a similarity of 0.8 or more."""
    h, o, _ = shingles(texts)
    h, o = distinct(h, o)
    ends = np.cumsum(np.bincount(o, minlength=len(texts)))
    sets = np.split(h, ends[:-1])
    out = []
    for i, j in pairs:
        shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        # i / (x + y - i) >= 0.8 in whole numbers
        out.append(shared > 0 and shared * 9 >= (len(sets[i]) + len(sets[j])) * 4)
    return out


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose ``texts`` (node, text) have a similarity of 0.8 or more.

    Only the texts of nodes in ``pairs`` travel: each once for every pair it
    is the greater node of, and those of centres once.
    """
    spark = pairs.sparkSession
    text_batches(spark)
    ship_package(spark)

    def of(end: str) -> DataFrame:
        met = in_bits(texts, "node", bit_words(pairs, end))
        return met.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}"))

    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "text_a", "text_b")

    def run(record_batches):
        import pyarrow as pa

        for batch in record_batches:
            a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
            # ranges stand for the lengths of the pairs' texts
            for part in batches([range(len(x) + len(y)) for x, y in zip(ta, tb, strict=True)]):
                number: dict[int, int] = {}
                held: list[str] = []
                for node, text in zip(a[part] + b[part], ta[part] + tb[part], strict=True):
                    if node not in number:
                        number[node] = len(held)
                        held.append(text)
                good = similar([(number[x], number[y]) for x, y in zip(a[part], b[part], strict=True)], held)
                rows = batch.slice(part.start, part.stop - part.start).select([0, 1])
                yield rows.filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _similar_sizes(a: Column, b: Column) -> Column:
    return F.least(a, b) * 10 >= F.greatest(a, b) * 8


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """What tells a row's id and text apart: a hash of the text, and one of id and text."""
    text_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return text_hash, F.xxhash64(F.lit(1), docs[id_col], text_hash)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_shingles, kept (the class's least id stays)."""
    return _classes(docs, id_col, text_col).drop("text_hash", "mark")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``classes`` with the marks of each row's text and of its id and text."""
    text_hash, mark = _marked(docs, id_col, text_col)
    texts = docs.select(docs[id_col].alias("doc_id"), text_hash.alias("text_hash"), mark.alias("mark"), docs[text_col].alias("text"))
    keyed = texts.select(F.struct("doc_id", "text_hash", "mark").alias("doc_id"), "text")
    sketch = sketches(keyed).select("doc_id.*", "n", "k1", "k2", "bands").withColumn("row", F.monotonically_increasing_id())
    sketch = saved(sketch, "sketches")
    nodes = (
        sketch.filter("n > 0")
        .groupBy("k1", "k2")
        .agg(F.min(F.struct("row", "text_hash", "mark")).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    # a node is the least row of its set; its text is that row's
    nodes = saved(nodes.select("k1", "k2", F.col("rep.row").alias("node"), "rep.text_hash", "rep.mark", "n", "bands"), "shingle-sets")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    held = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("who")
    )
    # of buckets with the same members one is enough
    buckets = saved(held.filter("c >= 2").groupBy("c", "low", "who").agg(F.min("key").alias("k")).select("k", "low"), "buckets")
    members = in_bits(keys, "key", bit_words(buckets, "k")).join(buckets, F.col("key") == F.col("k")).drop("k")
    members = saved(members, "bucket-members")
    wanted = nodes.select("node", "text_hash", "mark", "n").join(members.select("node").distinct(), "node")
    wanted = saved(wanted, "candidates")
    near = in_bits(texts.select("text_hash", "mark", "text"), "mark", bit_words(wanted, "mark"))
    near = near.dropDuplicates(["mark", "text_hash"]).join(wanted.select("node", "mark", "text_hash"), ["mark", "text_hash"])
    found = saved(near.select("node", "text"), "candidate-texts")
    sizes = wanted.select("node", "n")

    labels, links, tested = None, [], []
    for centres in (*CENTRES, 0):
        if labels is None:
            size = {x: sizes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab"}
            pairs = members.filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
            pairs = pairs.join(size["a"], "a").join(size["b"], "b").filter(_similar_sizes(F.col("n_a"), F.col("n_b")))
            pairs = pairs.select("a", "b")
        else:
            met = _open_buckets(members, labels, sizes, centres)
            if centres:
                met = met.withColumn("c", F.explode("c")).filter(
                    (F.col("comp") != F.col("c.comp")) & _similar_sizes(F.col("n"), F.col("c.n"))
                )
                pairs = met.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
            else:
                open_ = saved(met.select("node", "comp", "n").distinct(), "open-members")
                pairs = _prefix_pairs(open_, found)
            for before in tested:
                pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs")
        tested.append(pairs)
        links.append(saved(_linked(pairs, found), "links"))
        if labels is None or links[-1].limit(1).count():
            every = links[0]
            for more in links[1:]:
                every = every.union(more)
            named, old = components(every), labels
            labels = saved(sizes.join(named, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "labels")
            discard(named, *([old] if old else []))
    out = saved(_per_document(sketch, nodes, labels), "near-copies")
    discard(sketch, nodes, buckets, members, wanted, found, open_, labels, *tested, *links)
    return out


def _open_buckets(members: DataFrame, labels: DataFrame, sizes: DataFrame, centres: int) -> DataFrame:
    """key, node, comp and n of members of buckets that hold several components, and the bucket's centres (c)."""
    at = members.select("key", "node").join(labels, "node")
    several = at.groupBy(F.col("key").alias("k")).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    several = several.select("k")
    at = in_bits(at, "key", bit_words(several, "k")).join(several, F.col("key") == F.col("k")).drop("k").join(sizes, "node")
    if not centres:
        return at
    orders = [F.xxhash64(F.lit(k), F.col("node")) for k in range(1, centres)] + [F.col("node")]
    best = at.groupBy(F.col("key").alias("k")).agg(
        F.array(*[F.min(F.struct(o.alias("o"), "node", "comp", "n")) for o in orders]).alias("c")
    )
    return at.join(best, F.col("key") == F.col("k")).drop("k")


def _prefix_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of ``members`` of different components that may reach the similarity; loses none that does.

    Two sets of similarity 0.8 share one of the first ``n - ceil(0.8 n) + 1``
    elements of each in any common order. In the order of rising frequency
    those are the rare ones, so members that have only a common passage in
    common never meet.
    """
    own = in_bits(texts, "node", bit_words(members, "node"))
    sets = shingle_sets(own, "node").select(F.col("doc_id").alias("s"), "items").join(members, F.col("s") == F.col("node"))
    items = saved(sets.select("node", "comp", "n", F.explode("items").alias("item")), "member-items")
    often = items.groupBy(F.col("item").alias("i")).agg(
        F.count(F.lit(1)).alias("often"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    ranked = items.join(often, F.col("item") == F.col("i"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "item"))
    first = ranked.withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1)
    # an element that one component alone has joins nothing
    first = saved(first.filter("low <> high").select("node", "comp", "n", "item", "place"), "member-prefixes")
    earlier = Window.partitionBy("node").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    once, first = first, saved(first.withColumn("before", F.collect_list("item").over(earlier)), "ordered-prefixes")
    discard(items, once)
    other = first.select("item", *[F.col(c).alias(f"{c}2") for c in ("node", "comp", "n", "place", "before")])
    both = F.col("n") + F.col("n2")
    reach = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) + 1
    met = first.join(
        other.withColumnRenamed("item", "item2"),
        (F.col("item") == F.col("item2"))
        & (F.col("node") < F.col("node2"))
        & (F.col("comp") != F.col("comp2"))
        & _similar_sizes(F.col("n"), F.col("n2"))
        # what can follow the first common element must suffice, and a pair counts once, there
        & (reach * 9 >= both * 4)
        & ~F.arrays_overlap("before", "before2"),
    )
    return met.select(F.col("node").alias("a"), F.col("node2").alias("b"))


def _per_document(sketch: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes of nodes brought back to documents."""
    named = nodes.select("node", "k1", "k2").join(labels, "node", "left")
    named = named.select("k1", "k2", F.coalesce("comp", "node").alias("comp"))
    whole = sketch.filter("n > 0").select("doc_id", "text_hash", "mark", "row", "n", "k1", "k2").join(named, ["k1", "k2"])
    # written, so that a hot class is split in the join and not met in the sums' task
    sums = saved(
        whole.groupBy(F.col("comp").alias("c")).agg(
            F.min("doc_id").alias("class_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
            F.count(F.lit(1)).alias("class_size"),
        ),
        "classes",
    )
    grouped = whole.join(sums, whole["comp"] == sums["c"]).select(
        "doc_id",
        "text_hash",
        "mark",
        "class_id",
        "class_size",
        F.col("n").alias("n_shingles"),
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    alone = sketch.filter("n = 0").select(
        "doc_id",
        "text_hash",
        "mark",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("bigint").alias("class_size"),
        F.col("n").alias("n_shingles"),
        F.lit(True).alias("kept"),
    )
    return grouped.union(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one per class, with all columns.

    The decision is keyed by hashes of the text and of id and text, so rows
    that share an id, or have none, are judged each by its own text; of rows
    equal in both, one stays if one is kept. Only rows that a bit filter of
    the dropped ones lets through shuffle; the others pass straight.
    """
    found = _classes(docs, id_col, text_col)
    gone = found.groupBy("mark", "text_hash").agg(
        F.sum(F.col("kept").cast("bigint")).alias("stay"), F.count(F.lit(1)).alias("rows")
    )
    gone = saved(gone.filter("stay < rows").select("mark", "text_hash", "stay"), "gone")
    discard(found)
    text_hash, mark = _marked(docs, id_col, text_col)
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), text_hash.alias("text_hash"), mark.alias("mark"))
    flagged = flag_bits(whole, "mark", bit_words(gone, "mark"), "maybe")
    met = flagged.filter("maybe").join(gone, ["mark", "text_hash"], "left")
    kept = flagged.filter(~F.col("maybe")).select("whole.*").union(met.filter("stay is null").select("whole.*"))
    # rows equal in id and text of which one stays
    ties = met.filter("stay > 0").dropDuplicates(["mark", "text_hash"]).select("whole.*")
    return kept.union(ties)
