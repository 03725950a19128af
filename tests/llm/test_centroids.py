import hashlib
import random

import numpy as np

from yellowstar.llm import centroids

NAN, INF = float("nan"), float("inf")


def _brute(rows, k, rounds, dims, scale=256):
    """Plain k-means in whole numbers over (id, vector) rows."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)))
    named = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cs = [v for _, v in sorted(kept, key=named)[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min(range(len(cs)), key=lambda j: (dist(v, cs[j]), j))
    for _ in range(rounds):
        own = [near(v) for _, v in kept]
        cs = [
            tuple(sum(col) // len(col) for col in zip(*[v for (_, v), o in zip(kept, own, strict=True) if o == j], strict=True)) if j in own else c
            for j, c in enumerate(cs)
        ]
    out = [(i, near(v), dist(v, cs[near(v)])) for i, v in kept]
    total = {}
    for _, c, d in out:
        total[c] = total.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, c, d, total[c], sum(total.values()), sha[c]) for i, c, d in out), key=str)


def _rows(seed, n, dims):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) + (i % 3) for _ in range(dims)]) for i in range(n)]
    rows += rows[:3] + [(None, rows[5][1]), (None, rows[6][1])] + [(7, rows[9][1])]  # repeats, null and repeated ids
    rows += [(900, None), (901, []), (902, [0.0] * (dims + 1)), (903, [None] + [0.0] * (dims - 1))]
    rows += [(904, [NAN] + [0.0] * (dims - 1)), (905, [-INF] + [0.0] * (dims - 1)), (906, [300.0] * dims)]
    return rows


def test_clusters_equal_brute_force(spark):
    rows = _rows(1, 200, 6)
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, cluster int, vec string")
    got = centroids.cluster(table.repartition(5), k=9, rounds=4, dimensions=6).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows, 9, 4, 6)


def test_ties_and_equal_vectors(spark):
    # all on a line, half of them equal: ties go to the smaller number, empty centroids stay
    rows = [(i, [float(i % 4), 0.0]) for i in range(40)] + [(50 + i, [1.0, 0.0]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = centroids.cluster(table, k=12, rounds=5, dimensions=2).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows, 12, 5, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [-0.5, 0.25])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, centroids.cluster(table, dimensions=2).collect()), key=str) == _brute(rows, 40, 5, 2)
    none = centroids.cluster(table.limit(0), dimensions=2)
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_one_id_holds_a_third_of_the_rows(spark):
    rng = random.Random(3)
    rows = [(5 if i % 3 == 0 else i, [rng.random(), rng.random()]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = centroids.cluster(table, k=8, rounds=2, dimensions=2).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows, 8, 2, 2)


def test_cells_spare_vectors_and_lose_none():
    rng = np.random.default_rng(0)
    centre = rng.integers(-200, 200, (12, 16))
    q = centre[rng.integers(0, 12, 3000)] + rng.integers(-40, 40, (3000, 16))
    edges = centroids.cell_edges(len(q), q.min(0), q.max(0), q.sum(0).astype(float), (q.astype(float) ** 2).sum(0))
    cells = centroids.cells_of(q, edges)
    assert cells.max() < 1 << centroids.CELL_BITS
    lows, highs = centroids.tables(edges, centre)
    near, fetched = centroids.nearest(cells, lambda i: q[i], lows, highs, centre)
    exact = ((q[:, None, :] - centre[None]) ** 2).sum(-1)
    assert (near == exact.argmin(1)).all()
    assert fetched < 300
    d = np.arange(16)
    assert (sum(lows[j][cells[:, j]] for j in d) <= exact).all() and (exact <= sum(highs[j][cells[:, j]] for j in d)).all()
