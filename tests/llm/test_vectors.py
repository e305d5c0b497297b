"""Clustering and hard negatives against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import clusters, hard_negatives


def vectors(seed, n, dim, spread=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(spread)]
    return [[x + rng.gauss(0, 0.15) for x in rng.choice(centres)] for _ in range(n)]


def awkward(dim):
    good = [0.25] * dim
    return [None, [], [0.5] * (dim - 1), [0.5] * (dim + 1), [*good[1:], None], [*good[1:], math.nan], [*good[1:], math.inf]]


def plain_clusters(rows, k, rounds, dim, scale, seed=3):
    kept = [
        (key, [math.floor(scale * x) for x in v])
        for key, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    token = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=token)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else m for o, m in zip(own, centres, strict=True)]
    found = [(key, *nearest(v)[::-1]) for key, v in kept]
    return [
        (key, c, d, sum(r[2] for r in found if r[1] == c), sum(r[2] for r in found),
         hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for key, c, d in found
    ]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("k", "rounds"), [(8, 10), (1, 3), (40, 4), (3, 0)])
def test_clusters_against_definition(spark, monkeypatch, k, rounds):
    monkeypatch.setattr(clusters, "BLOCK", 17)
    made = vectors(k, 300, 6)
    made[50:90] = [made[0]] * 40  # one very common vector
    rows = [*enumerate(made), (7, made[7]), (None, made[3]), *[(900 + i, v) for i, v in enumerate(awkward(6))]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", *[f"'mine' AS {c}" for c in ("key", "block", "distance", "v", "cluster")])
    found = clusters.cluster(df, "vec_id", "embedding", k=k, rounds=rounds, dim=6, scale=100)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(found.collect()) == order(plain_clusters(rows, k, rounds, 6, 100))


def test_clusters_of_nothing_and_of_too_large_numbers(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "id long, v array<float>")
    found = clusters.cluster(df, "id", "v", dim=2)
    assert found.collect() == [] and clusters.cluster(df.limit(0), "id", "v").count() == 0
    huge = spark.createDataFrame([(1, [1e30, 1.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="too large"):
        clusters.cluster(huge, "id", "v", dim=2).collect()


def test_heaps_leave_settled_vectors_alone():
    made = np.array([[math.floor(1000 * x) for x in v] for v in vectors(4, 2000, 8, 5)], np.int32)
    block = clusters.Block(made, 5)
    centres, drift, scanned = made[:5].astype(np.int64), np.zeros(5), []
    for _ in range(12):
        block.assign(centres, drift)
        scanned.append(block.scanned)
        near = clusters.distances(made, centres).argmin(1)
        assert (block.near == near).all()
        heaps = sorted(at for heap in block.heaps for _, at in heap)
        assert heaps == list(range(2000))
        moved = np.array([made[near == c].mean(0) if (near == c).any() else centres[c] for c in range(5)])
        moved = np.floor(moved).astype(np.int64)
        step = np.sqrt(((moved - centres) ** 2).sum(1))
        drift = drift + step + [max(np.delete(step, c)) for c in range(5)]
        centres = moved
    assert scanned[0] == 2000 and sum(scanned[6:]) < 2000


def plain_negatives(rows, anchor, label, n_pos=5, n_neg=5, scale=256):
    kept = [
        (at, key, label(key, own), [math.floor(scale * x) for x in v])
        for at, (key, v, own) in enumerate(rows)
        if key is not None and own is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for at, key, own, v in kept:
        if not anchor(key):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=False)), other, place, theirs)
            for place, other, theirs, w in kept
            if place != at
        )
        for minus, positive, *_ in [s for s in scored if s[3] == own][:n_pos]:
            inside = [s for s in scored if s[3] != own and 80 * -minus <= 100 * -s[0] <= 100 * -minus]
            found += [(key, positive, k + 1, s[1], -minus, -s[0]) for k, s in enumerate(inside[:n_neg])]
    return found


@pytest.mark.parametrize("group", [2048, 4])
def test_hard_negatives_against_definition(spark, monkeypatch, group):
    monkeypatch.setattr(hard_negatives, "GROUP", group)
    monkeypatch.setattr(hard_negatives, "CHUNK", 32)
    rng = random.Random(9)
    made = vectors(11, 260, 6, 4)
    made[100:140] = [made[100]] * 40  # ties
    rows = [(key, v, rng.randrange(4)) for key, v in enumerate(made)]
    rows += [(10, made[10], 1), (10, made[10], 1), (None, made[1], 1), (13, made[2], None)]
    rows += [(1000 + 10 * i, v, 1) for i, v in enumerate(awkward(6))] + [(-20, made[5], 77)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    df = df.selectExpr("*", *[f"'mine' AS {c}" for c in ("row", "key", "anchor", "v", "part", "rank")])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    found = hard_negatives.mine(df, "vec_id", "embedding", moved, F.col("vec_id") % 10 == 0)
    expected = plain_negatives(rows, lambda k: k % 10 == 0, lambda k, own: (own + 1) % 4 if k % 7 == 0 else own)
    assert expected and order(found.collect()) == order(expected)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0], 1)], "id long, v array<float>, label int")
    for rows, anchor in ((df.limit(0), F.lit(True)), (df, F.lit(False)), (df, F.lit(None)), (df, F.lit(True))):
        assert hard_negatives.mine(rows, "id", "v", F.col("label"), anchor).collect() == []
    huge = spark.createDataFrame([(1, [1e30], 1)], "id long, v array<double>, label int")
    with pytest.raises(Exception, match="too large|overflow"):
        hard_negatives.mine(huge, "id", "v", F.col("label"), F.lit(True)).collect()


def test_tree_bounds_hold_and_cut_scores():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 200, (6, 16))
    rows = np.rint(centres[rng.integers(0, 6, 4000)] + rng.normal(0, 5, (4000, 16))).astype(np.int64)
    anchors = rows[:60]
    tree = hard_negatives.spanning_tree(anchors)
    assert sorted(tree.order.tolist()) == list(range(60)) and (tree.parent[1:] < np.arange(1, 60)).all()
    keys = np.arange(4000)
    norms = np.sqrt((rows**2).sum(1))
    top = 1 << 60
    windows = hard_negatives.Windows([[-top]] * 60, [[top]] * 60, 5)
    scored = 0
    for start in range(0, 4000, 500):
        cut = slice(start, start + 500)
        every = np.ones(500, bool)
        scored += hard_negatives.walk(tree, anchors, rows[cut], norms[cut], lambda at, e=every: e, windows, keys[cut], keys[cut])
    exact = rows @ anchors.T
    for at in range(60):
        best = sorted((-int(s), k) for k, s in enumerate(exact[:, at].tolist()))[:5]
        assert [(s, k) for s, k, _ in windows.found[at][0]] == best
    assert scored < 0.6 * 60 * 4000
