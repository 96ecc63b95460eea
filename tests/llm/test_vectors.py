"""Operators on vectors against plain versions with Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids, exact_topk, hard_negatives, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, ID int, block string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", "y") for i, v, label in rows], SCHEMA).repartition(3)


def drawn(n, width=6, seed=0, hot=0.3):
    """Vectors of which a share is one and the same, some lie near others, and some take no part."""
    draw = random.Random(seed)
    same, out = [0.5 - i / 4 for i in range(width)], []
    for i in range(n):
        kind = draw.random()
        if kind < hot:
            v = list(same)
        elif kind < hot + 0.2 and out and out[-1]:
            v = [x + draw.gauss(0, 0.01) for x in out[-1]]
        else:
            v = [draw.gauss(0, 1) * draw.choice([0.1, 1, 1, 4]) for _ in range(width)]
        out.append(v)
    return [(i, v, draw.randrange(3)) for i, v in enumerate(out)]


ODD = [
    (None, [1.0] * 6, 1),
    (1001, None, 1),
    (1002, [], 0),
    (1003, [1.0, None, 2.0, 0.0, 0.0, 0.0], 0),
    (1004, [1.0, float("nan"), 2.0, 0.0, 0.0, 0.0], 0),
    (1005, [1.0, float("inf"), 2.0, 0.0, 0.0, 0.0], 0),
    (1006, [0.0] * 6, 2),
    (1007, [0.0] * 6, 2),
    (1020, [2.0, -1.0], 1),
    (1040, [1.0] * 9, None),
    (1060, [0.3] * 9, 0),
    (40, [0.7] * 6, 1),
    (40, [0.7] * 6, 1),
    (60, [-0.7] * 6, 1),
    (1100, [1e-9, -1e-9, 0.0, 0.0, 0.0, 0.0], 2),
]


def whole(rows, scale, label=False):
    kept = []
    for i, v, own in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (label and own is None):
            continue
        kept.append((i, [math.floor(scale * x) for x in v], own))
    return kept


def dot(a, b):
    return max(vectors.LOWEST, min(vectors.HIGHEST, sum(x * y for x, y in zip(a, b))))


def asked(rows, every):
    """One row for each id that asks: the least of those that share it."""
    found = {}
    for i, v, label in rows:
        if i % every == 0 and (i not in found or (v, label) < found[i]):
            found[i] = (v, label)
    return found


def plain_top_k(rows, k, every):
    out = []
    for own, (q, _) in asked([(i, v, 0) for i, v, _ in whole(rows, 64)], every).items():
        scored = sorted((-dot(q, v), i) for i, v, _ in whole(rows, 64) if i != own)
        out += [(own, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(
    "rows, how",
    [
        (drawn(400) + ODD, {}),
        (drawn(400) + ODD, {"block": 256, "leaf": 4}),
        (drawn(300, seed=5, hot=0.9), {"block": 128, "leaf": 2}),
        (drawn(300, seed=6, hot=0.0), {"block": 512, "leaf": 8}),
        (drawn(15, seed=7), {}),
        ([(0, [1e12, 1.0], 0), (20, [1e12, 2.0], 0), (3, [-1e12, 1e14], 0), (4, [1.0, 1.0], 0)], {}),
        ([(i, [0.0, 0.0], 0) for i in range(200)], {"block": 32, "leaf": 2}),
        ([(0, [1.0], 0)], {}),
        ([(3, [1.0], 0)], {}),
        ([], {}),
    ],
)
def test_top_k(spark, rows, how):
    got = exact_topk.top_k(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, **how)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top_k(rows, 7, 20)


def test_trees_leave_out_what_cannot_be_reached():
    x = np.floor(np.random.default_rng(1).normal(size=(4000, 8)) * 64)
    tree = exact_topk.Tree(np.arange(4000), x, 32)
    assert len(np.diff(tree.cuts)) == 128 and set(np.diff(tree.cuts)) <= {31, 32}
    visited = []
    leaf = tree._leaf
    tree._leaf = lambda *a: visited.append(len(a[4])) or leaf(*a)
    q = x[:50]
    best = exact_topk.Best(5, np.full(50, vectors.LOWEST), np.full(50, vectors.HIGHEST))
    tree.search(q, np.arange(50), best)
    assert sum(visited) < 50 * 128 / 2
    scores = (q @ x.T).astype(np.int64)
    scores[np.arange(50), np.arange(50)] = vectors.LOWEST
    assert np.array_equal(best.low, np.sort(scores, axis=1)[:, -5])


def plain_negatives(rows, every, k=5, least=80, most=100):
    kept, out = whole(rows, 256, label=True), []
    anchors = {}
    for i, v, label in sorted(kept, key=lambda r: (r[2], r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, label))
    for own, (q, label) in anchors.items():
        scored = sorted((-dot(q, v), i, other == label) for i, v, other in kept)
        positives = [(-s, i) for s, i, same in scored if same and i != own][:k]
        for score, positive in positives:
            found = [(-s, i) for s, i, same in scored if not same and i != own and least * score <= -100 * s <= most * score][:k]
            out += [(own, positive, rank + 1, i, score, s) for rank, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize(
    "rows, how",
    [
        (drawn(400) + ODD, {}),
        (drawn(400) + ODD, {"block": 256}),
        (drawn(300, seed=5, hot=0.9), {"block": 128, "focus": 2}),
        (drawn(300, seed=6, hot=0.0), {"block": 512, "focus": 1}),
        (drawn(300, width=40, seed=8, hot=0.1), {"block": 1024}),
        ([(i, [0.0, 0.0], i % 2) for i in range(200)], {"block": 32}),
        ([(0, [1.0], 0)], {}),
        ([], {}),
    ],
)
def test_hard_negatives(spark, rows, how):
    got = hard_negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 20 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 20)


def test_ranges_of_scores_are_parameters(spark):
    rows = drawn(300, seed=9, hot=0.1)
    got = hard_negatives.hard_negatives(
        table(spark, rows), F.col("vec_id") % 20 == 0, positives=2, negatives=2, least_percent=33, most_percent=117, block=256
    )
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 20, 2, 33, 117)


def test_coordinates_prune_without_losing_answers():
    draw = np.random.default_rng(2)
    x = np.repeat(draw.normal(size=(40, 16)), 50, axis=0) + draw.normal(size=(2000, 16)) / 32
    x = np.floor(x / hard_negatives.lengths(x)[:, None] * 256)
    bucket = hard_negatives.Bucket(np.arange(2000), np.zeros(2000, dtype=np.int64), x)
    seen = 0
    for q in x[::100]:
        scores = x @ q
        low = int(np.sort(scores)[-20])
        rows = bucket.candidates(q, low)
        assert set(np.flatnonzero(scores >= low)) <= set(rows.tolist())
        seen += len(rows)
    assert seen < 20 * 2000 / 4


def plain_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centres)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = {n: sum(d for _, m, d in found if m == n) for n in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, n, d in found), key=repr)


@pytest.mark.parametrize(
    "rows, k, rounds",
    [
        (drawn(500) + ODD, 8, 3),
        (drawn(300, seed=5, hot=0.9), 16, 4),
        (drawn(300, seed=6, hot=0.0), 5, 8),
        (drawn(9, seed=7), 16, 3),
        ([(i, [0.0] * 6, 0) for i in range(50)], 4, 2),
        ([(i, [1e12 * (i % 3), 1.0, 0.0, 0.0, 0.0, float(i)], 0) for i in range(30)], 3, 2),
        ([(1, [1.0] * 5, 0)], 4, 2),
        ([], 4, 2),
    ],
)
def test_clusters(spark, rows, k, rounds):
    got = centroids.clustered(table(spark, rows), k=k, rounds=rounds, width=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = plain_clusters(rows, k, rounds, 6)
    want = [(i, n, *(min(x, vectors.HIGHEST) for x in longs), c) for i, n, *longs, c in want]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_losses_bound_every_fall_and_are_below_the_drift():
    draw = np.random.default_rng(3)
    tighter = 0
    for _ in range(300):
        middle, p, q = draw.normal(size=(3, 4)) * draw.choice([1, 3], size=(3, 1))
        radius = draw.uniform(0, 2)
        x = draw.normal(size=(400, 4))
        x = middle + x / np.linalg.norm(x, axis=1)[:, None] * radius * draw.uniform(size=(400, 1)) ** 0.25
        fall = (np.linalg.norm(x - p, axis=1) - np.linalg.norm(x - q, axis=1)).max()
        bound = centroids.loss(middle, radius, p, q)
        assert fall <= bound + 1e-9 and bound <= np.linalg.norm(p - q) + 1e-9
        tighter += bound < 0.9 * np.linalg.norm(p - q)
    assert tighter > 100


def test_few_vectors_meet_all_centroids_again(spark):
    draw = random.Random(4)
    middles = [[draw.gauss(0, 2) for _ in range(6)] for _ in range(8)]
    rows = [(i, [x + draw.gauss(0, 0.05) for x in middles[i % 8]], 0) for i in range(800)]
    found = centroids.run(table(spark, rows), k=8, rounds=4, width=6)
    assert 800 <= found.compared.value < 2 * 800
