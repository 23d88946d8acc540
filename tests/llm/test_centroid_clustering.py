import hashlib
import math
import random
from itertools import product

import numpy as np
import pytest

from rolepulse.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance string"


def brute(rows, dims, count=16, rounds=3):
    """Plain loops over every vector and every centroid."""
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, [math.floor(64 * x) for x in e]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centroids = [v for _, v in first[:count]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        told = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, j) in zip(kept, told) if j == k]
            if own:
                centroids[k] = [sum(c) // len(own) for c in zip(*own)]
    told = assign()
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for d, j in told if j == k) for k in range(len(centroids))]
    return sorted(((i, k, d, inertia[k], sum(inertia), sha[k]) for (i, _), (d, k) in zip(kept, told)), key=repr)


def clustered(spark, rows, dims):
    df = spark.createDataFrame([(i, e, 1, "clash", "clash") for i, e in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, cc.clustered(df, dims).collect()), key=repr)


def vectors(rng, n, dims, spread=0.2):
    centres = [[rng.uniform(-2, 2) for _ in range(dims)] for _ in range(6)]
    return [[c + rng.gauss(0, spread) for c in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("block, bits", [(256, 4), (7, 1), (16, 6)])
def test_equals_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(cc.blocks_of, "__defaults__", (8, bits, block))
    rng = random.Random(block)
    rows = list(enumerate(vectors(rng, 300, 8)))
    rows += [(1000 + i, [0.5] * 8) for i in range(200)]  # one very common vector
    rows += rows[:9] + [(5, [1.0] * 8), (None, [0.25] * 8)]  # repeated rows, an id of two vectors, no id
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [1.0] * 7 + [None]), (2004, [1.0] * 7 + [math.nan]), (2005, [math.inf] * 8)]
    assert clustered(spark, rows, 8) == brute(rows, 8)


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(0, 2_000_000) for _ in range(8)]) for i in range(60)]
    assert clustered(spark, rows, 8) == brute(rows, 8)
    assert clustered(spark, rows + [(99, [1e300] * 8)], 8) == brute(rows, 8)


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i)] * 8) for i in range(3)]
    assert clustered(spark, rows, 8) == brute(rows, 8)
    assert clustered(spark, [], 8) == [] and clustered(spark, [(1, [1.0])], 8) == []


def test_boxes_rule_out_centroids_but_never_the_nearest():
    rng = np.random.default_rng(2)
    fewer = 0
    for _ in range(200):
        centroids = rng.integers(-100, 100, (16, 4))
        x = rng.integers(-100, 100, 4) + rng.integers(-15, 15, (40, 4))
        left = cc.candidates(x.min(0), x.max(0), centroids)
        best = ((x[:, None] - centroids) ** 2).sum(2).argmin(1)
        assert set(best) <= set(left)
        fewer += len(left) < 8
    assert fewer > 100


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 2), (5, 1), (1, 3)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dims)))
    keys = [bytes(k) for k in cc.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
