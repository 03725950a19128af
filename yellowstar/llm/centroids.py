"""Centroid clustering (k-means in whole numbers) over a vector-approximation file.

Every kept vector is written once as two columns: ``cells``, one few-bit cell
number a dimension, and ``vec``, its whole components. A round reads the
cells, adds up two small lookup tables a dimension (the least and the greatest
squared distance from a cell to each centroid) and so has an interval for each
centroid's distance. Centroids whose interval starts above the least upper end
can't be nearest. Only where several intervals overlap is the full vector
decoded and compared, with those centroids alone; the result is exact.

The cells are equal steps between three standard deviations on both sides of
each dimension's mean, with open end cells that reach to the least and the
greatest component found, all from one pass over all vectors. They change the
work and never the result. Both columns lie in one table: a round needs the
sum of every cluster's vectors, so a separate table would only add a join.
What reaches the driver is one row a cluster and dimension.

Defined cases: a vector that is null, has another number of components, or a
component that is null, infinite or not a number is left out. Repeated rows
are vectors of their own. Ids may be null or repeat: the first centroids go by
the hash of the id, then by the components, null ids last. With fewer vectors
than centroids there are as many centroids as vectors; an empty table gives an
empty result. A component of 2**19 or more in size is an error, because
squared distances would leave the range of a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, ship_package, text_batches

CENTROIDS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
#: Bits of a cell: 64 cells a dimension.
CELL_BITS = 6
#: Vectors that numpy handles at once.
ROWS = 1024
_LIMIT = 1 << 27
_ZERO = 1 << 31


def pack(q: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes whose order is that of the numbers."""
    return [r.tobytes() for r in (q + _ZERO).astype(">u4")]


def unpack(rows: list[bytes], dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), ">u4").astype(np.int64).reshape(-1, dimensions) - _ZERO


def quantised(column, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) of an Arrow list column, one row a vector."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    q = np.floor(scale * x)
    if q.size and np.abs(q).max() >= _LIMIT:
        raise ValueError(f"a component of {_LIMIT / scale:.0f} or more has no squared distance in a long")
    return q.astype(np.int64)


def cell_edges(n: int, low: np.ndarray, high: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """First component of each cell, (dimensions, cells + 1): the last column is one past the greatest component."""
    mean = total / n
    spread = 3 * np.sqrt(np.maximum(squares / n - mean**2, 0.0)) + 1
    steps = np.linspace(-1, 1, (1 << CELL_BITS) - 1)
    inner = np.floor(mean[:, None] + spread[:, None] * steps).astype(np.int64)
    inner = np.clip(inner, low[:, None], high[:, None] + 1)
    return np.concatenate([low[:, None], inner, high[:, None] + 1], axis=1)


def cells_of(q: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cell number of each component: the cell is [edges[c], edges[c + 1])."""
    out = np.empty(q.shape, np.uint8)
    for j in range(q.shape[1]):
        out[:, j] = np.searchsorted(edges[j, 1:-1], q[:, j], side="right")
    return out


def tables(edges: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each dimension's cells to each centroid: (dimensions, cells, centroids)."""
    first, last = edges[:, :-1, None], edges[:, 1:, None] - 1
    c = centroids.T[:, None, :]
    below, above = first - c, c - last
    least = np.maximum(np.maximum(below, above), 0) ** 2
    return least, np.maximum(np.abs(below), np.abs(above)) ** 2


def nearest(
    cells: np.ndarray, fetch, lows: np.ndarray, highs: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, int]:
    """Nearest centroid of each row of ``cells`` (ties: the smaller number), and how many vectors were fetched.

    ``fetch(rows)`` gives the whole vectors of the numbered rows.
    """
    least = np.zeros((len(cells), len(centroids)), np.int64)
    most = np.zeros_like(least)
    for j in range(cells.shape[1]):
        least += lows[j][cells[:, j]]
        most += highs[j][cells[:, j]]
    # an equal distance still counts: the smaller number wins a tie
    open_ = least <= most.min(axis=1)[:, None]
    out = open_.argmax(axis=1)
    rows = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(rows):
        exact = np.full((len(rows), len(centroids)), np.iinfo(np.int64).max)
        at, k = np.nonzero(open_[rows])
        full = fetch(rows)
        exact[at, k] = ((full[at] - centroids[k]) ** 2).sum(axis=1)
        out[rows] = exact.argmin(axis=1)
    return out, len(rows)


def _kept(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    v = vectors[vector_col]
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a size other than the wanted one, null vectors included, ends the test before the components are looked at
    good = F.when(F.size(v) == dimensions, finite).otherwise(False)
    return vectors.filter(good).select(vectors[id_col].alias("vec_id"), v.alias("v"))


def _statistics(kept: DataFrame, dimensions: int, scale: int) -> tuple[int, np.ndarray | None]:
    """Number of vectors, and the cells' edges from all of them."""

    def run(batches):
        import pyarrow as pa

        n, parts = 0, None
        for batch in batches:
            q = quantised(batch.column(0), dimensions, scale)
            if len(q):
                new = (q.min(0), q.max(0), q.sum(0).astype(float), (q.astype(float) ** 2).sum(0))
                merge = (np.minimum, np.maximum, np.add, np.add)
                parts = new if parts is None else tuple(f(a, b) for f, a, b in zip(merge, parts, new, strict=True))
                n += len(q)
        if n:
            columns = [np.arange(dimensions, dtype=np.int32), np.full(dimensions, n), *parts]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "n", "low", "high", "total", "squares"])

    found = kept.select("v").mapInArrow(run, "dim int, n bigint, low bigint, high bigint, total double, squares double")
    rows = (
        found.groupBy("dim")
        .agg(F.sum("n"), F.min("low"), F.max("high"), F.sum("total"), F.sum("squares"))
        .orderBy("dim")
        .collect()  # one row a dimension
    )
    if not rows:
        return 0, None
    low, high, total, squares = (np.array([r[i] for r in rows]) for i in range(2, 6))
    return int(rows[0][1]), cell_edges(int(rows[0][1]), low, high, total, squares)


def approximations(vectors: DataFrame, edges: np.ndarray, dimensions: int, scale: int) -> DataFrame:
    """vec_id, cells, vec of every kept vector (``vec_id``, ``v``)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            q = quantised(batch.column(1), dimensions, scale)
            cells = cells_of(q, edges)
            columns = [batch.column(0), pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(pack(q), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cells", "vec"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cells binary, vec binary")


def _first_centroids(table: DataFrame, n: int, k: int, dimensions: int) -> np.ndarray:
    """The ``k`` vectors of least (hash of the id, components)."""
    hashed = table.select(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).alias("h"), "vec")
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint")
    share = (k + 10 * k**0.5 + 50) / max(n, 1)
    while True:
        # hashes below a bound that holds more than k vectors as a rule; all of them, null ids too, if not
        few = hashed if share >= 1 else hashed.filter(place < int(share * 2**32))
        rows = few.groupBy("h", "vec").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("h").asc_nulls_last(), "vec").limit(k).collect()
        if sum(r["n"] for r in rows) >= k or share >= 1:
            chosen = [bytes(r["vec"]) for r in rows for _ in range(min(r["n"], k))][:k]
            return unpack(chosen, dimensions)
        share *= 8


def _each(batches, dimensions: int, lows, highs, centroids):
    """Batch slices with their vectors' bytes and nearest centroids."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dimensions)
            rows = part.column("vec").to_pylist()
            near, _ = nearest(cells, lambda i, r=rows: unpack([r[x] for x in i], dimensions), lows, highs, centroids)
            yield part, rows, near


def _means(table: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """One round: the centroids after every vector has gone to its nearest one."""
    k, dimensions = centroids.shape

    def run(batches):
        import pyarrow as pa

        lows, highs = tables(edges, centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, rows, near in _each(batches, dimensions, lows, highs, centroids):
            q = unpack(rows, dimensions)
            order = np.argsort(near, kind="stable")
            own, first = np.unique(near[order], return_index=True)
            n += np.bincount(near, minlength=k)
            sums[own] += np.add.reduceat(q[order], first, axis=0)
        own = np.flatnonzero(n)
        arrays = [pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "n", "sums"])

    parts = table.select("cells", "vec").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    rows = (
        parts.select("cluster", "n", F.posexplode("sums").alias("dim", "total"))
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()  # one row a cluster and dimension
    )
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def _assigned(table: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    kind = table.schema["vec_id"].dataType.simpleString()
    dimensions = centroids.shape[1]

    def run(batches):
        import pyarrow as pa

        lows, highs = tables(edges, centroids)
        for part, rows, near in _each(batches, dimensions, lows, highs, centroids):
            distance = ((unpack(rows, dimensions) - centroids[near]) ** 2).sum(axis=1)
            arrays = [part.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def _long_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)")).cast("bigint")


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    ship_package(spark)
    text_batches(spark)
    kept = _kept(vectors, id_col, vector_col, dimensions)
    n, edges = _statistics(kept, dimensions, scale)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not n:
        fields = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {kind}, {fields}")
    table = saved(approximations(kept, edges, dimensions, scale), "cells")
    centroids = _first_centroids(table, n, k, dimensions)
    for _ in range(rounds):
        centroids = _means(table, edges, centroids)
    last = saved(_assigned(table, edges, centroids), "clusters")
    sums = {r["cluster"]: r["s"] for r in last.groupBy("cluster").agg(_long_sum("distance").alias("s")).collect()}
    whole = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # one row a cluster
    facts = spark.createDataFrame(
        [(c, s, whole, digests[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return last.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
