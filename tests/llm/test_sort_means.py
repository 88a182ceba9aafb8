"""Sort-means against plain k-means over integers, with ties and odd rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from palaver.llm import sort_means


def brute(rows, k, rounds, dims, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < 60_000 for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    key = lambda r: ((0, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()) if r[0] is not None else (1, ""), r[1])
    centroids = [x for _, x in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        to = assign()
        for n in range(len(centroids)):
            mine = [x for (_, x), (_, c) in zip(kept, to, strict=True) if c == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    to = assign()
    own = [sum(d for d, c in to if c == n) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, own[c], sum(own), digest[c]) for (i, _), (d, c) in zip(kept, to, strict=True)), key=repr)


def rows_of(n, dims, spread, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-spread, spread) / 4 for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, list(rows[3][1])) for i in range(n // 3)]  # a third are copies
    return rows + [(5, list(rows[7][1])), (None, list(rows[8][1])), (901, None), (902, [1.0]), (903, [None] * dims), (904, [math.nan] * dims), (905, [math.inf] * dims), (906, [1e30] * dims), (907, [])]


def test_equals_plain_k_means(spark):
    for seed, dims, spread in ((1, 3, 2), (2, 4, 30), (3, 2, 1)):
        rows = rows_of(60, dims, spread, seed)
        frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, x string, cluster int").repartition(5)
        mine = sort_means.cluster_report(frame, k=5, rounds=4, dims=dims, scale=8)
        assert sorted(map(tuple, mine.collect()), key=repr) == brute(rows, 5, 4, dims, 8)


def test_scan_skips_only_what_cannot_win():
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (500, 3))
    centroids = np.concatenate([rng.integers(-3, 4, (6, 3)), x[:2], x[:1]])
    for _ in range(5):
        start = rng.integers(0, len(centroids), len(x))
        best, distance = sort_means.nearest(x, start, centroids)
        every = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_empty_and_few(spark):
    kind = "vec_id string, embedding array<double>"
    assert sort_means.cluster_report(spark.createDataFrame([], kind)).count() == 0
    rows = [("a", [1.0] * 64), ("b", [-2.0] * 64)]
    got = sort_means.cluster_report(spark.createDataFrame(rows, kind)).collect()
    assert {r["vec_id"]: r["distance"] for r in got} == {"a": 0, "b": 0} and len({r["cluster"] for r in got}) == 2
