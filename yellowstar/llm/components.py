"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
    return tuple(row)


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Hang each node's neighbours (``v``) on the least of the node (``u``) and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("v0")).select(
        F.col("u").alias("k"), F.least("u", "v0").alias("m")
    )
    hung = links.join(least, links["u"] == least["k"])
    pairs = hung.filter("v > u") if larger_only else hung
    out = pairs.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger_only:
        out = out.union(least.select("k", "m"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``comp`` (its least node) for every node of ``edges`` (``a``, ``b``)."""
    now = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    seen = _digest(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v"))
        large = _star(both.union(both.select("v", "u")), True)
        # after the large step every edge points down: a is larger than b
        small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False)
        before, now = now, saved(small, "edges")
        discard(before)
        after = _digest(now)
        if after == seen:
            break
        seen = after
    both = now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )
    out = saved(both, "components")
    discard(now)
    return out
