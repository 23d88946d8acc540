import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolepulse.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<{}>, label int, kept string, n_links string, node string, tile string"


def usable(e, label):
    return label is not None and bool(e) and all(x is not None and math.isfinite(x) for x in e) and any(e)


def brute(rows):
    """All pairs of rows, then the components from row to row."""
    links = [[] for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                xa, xb = ([x / max(map(abs, v)) for x in v] for v in (a, b))
                if math.fsum(x * y for x, y in zip(xa, xb)) / math.sqrt(math.fsum(x * x for x in xa) * math.fsum(x * x for x in xb)) >= 0.98:
                    links[i].append(j)
                    links[j].append(i)
    out = []
    for i, (vec_id, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), component, vec_id == component))
    return sorted(out, key=repr)


def found(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, e, label, "x", "x", "x", "x") for i, e, label in rows], SCHEMA.format(kind)).repartition(4)
    return sorted(map(tuple, ed.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def corpus(seed, dims=16, n=120):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        centre = rng.normal(size=dims)
        for _ in range(n):
            rows.append((centre * rng.choice([0, 2]) + rng.normal(size=dims), label))
    for x, label in list(rows[:40]):  # near copies, other lengths of a vector, and chains of them
        for _ in range(3):
            x = (x + rng.normal(size=dims) * 0.1) * rng.choice([1, 1e-3, 50])
            rows.append((x, label))
    rows += [(rows[5][0], 0)] * 60  # one very common vector
    order = rng.permutation(len(rows))
    return [(int(i), rows[j][0].tolist(), rows[j][1]) for i, j in enumerate(order)]


@pytest.mark.parametrize("tile, strip, fan", [(512, 64, 16), (8, 4, 2), (33, 7, 3)])
def test_equals_all_pairs(spark, monkeypatch, tile, strip, fan):
    for name, value in (("TILE", tile), ("STRIP", strip), ("FAN", fan)):
        monkeypatch.setattr(ed, name, value)
    rows = corpus(tile)
    got = found(spark, rows)
    assert got == brute(rows)
    assert sum(r[1] > 0 for r in got) > 100 and sum(r[3] for r in got) > 200


def test_odd_rows(spark):
    a, b = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    rows = [(1, a, 1), (2, a, 1), (2, a, 1), (3, a, 2), (4, a, None), (5, [2 * x for x in a], 1), (6, [-x for x in a], 1), (7, b, 1), (7, a, 2),
            (8, None, 1), (9, [], 1), (10, [0.0] * 8, 1), (11, [math.nan] * 8, 1), (12, [1.0] * 7 + [None], 1), (13, [math.inf] * 8, 1),
            (None, a, 1), (None, b, 7), (14, a[:5], 1), (15, a[:5], 1), (16, [1e200] * 8, 3), (17, [1e-200] * 8, 3), (18, [-0.0] + b[1:], 1),
            (19, [1.0], 4), (20, [3.0], 4), (21, [-1.0], 4), (8, None, None), (22, [5e-324] * 8, 3), (23, [0.5] * 5000, 1), (24, [0.5] * 5000, 1)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(1, None, 1), (1, [1.0], None)]) == [(1, 0, 1, True)] * 2


def test_threshold_is_met_from_both_sides(spark):
    rows = []
    for k in range(-6, 7):  # cosines around the threshold, some of them within rounding
        c = 0.98 + k * (1e-16 if abs(k) < 4 else 1e-12)
        rows += [(10 * (k + 6), [1.0, 0.0], k), (10 * (k + 6) + 1, [c, math.sqrt(1 - c * c)], k)]
    assert found(spark, rows) == brute(rows)


def test_single_precision_vectors(spark):
    rows = [(i, [float(np.float32(x)) for x in e], label) for i, e, label in corpus(9, n=30)]
    assert found(spark, rows, "float") == brute(rows)


def test_far_intervals_are_skipped(spark, monkeypatch):
    """In data with structure most pairs of tiles are never met."""
    monkeypatch.setattr(ed, "TILE", 16)
    rng = np.random.default_rng(1)
    angle = rng.uniform(0, 2 * math.pi, 1600)
    df = spark.createDataFrame([(i, [math.cos(t), math.sin(t)], 1) for i, t in enumerate(angle)], "vec_id long, embedding array<double>, label int")
    rows, dtype = ed.keyed_rows(df)
    points = rows.groupBy("label", "length", "digest").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    length, axes = ed.principal_axes(points, dtype)
    tiles = ed.tiles_of(points, dtype, length, axes, 0.2)
    n = tiles.count()
    assert n >= 100 and ed.near_pairs(tiles, 0.2).count() < 0.2 * n * (n + 1) / 2
