"""Lloyd rounds over two trees against exact rounds over all pairs."""

import hashlib
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from lexiforge.llm import clustering as cl

MOST = 2**63 - 1
KINDS = "vec_id long, embedding array<double>, cluster int, label map<string,int>"


def brute(rows, clusters=40, rounds=5, length=64):
    own = [(i, [floor(256 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted(own, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centre = [list(v) for _, v in named[:clusters]]

    def assign():
        out = []
        for _, v in own:
            d = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centre]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(centre)):
            held = [v for (_, v), (k, _) in zip(own, at, strict=True) if k == c]
            if held:
                centre[c] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    at = assign()
    clip = lambda x: min(MOST, x)
    inertia = [sum(clip(d) for k, d in at if k == c) for c in range(len(centre))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted((i, k, clip(d), clip(inertia[k]), clip(sum(inertia)), digest[k]) for (i, _), (k, d) in zip(own, at, strict=True))


def run(spark, rows, parts=3, **how):
    d = spark.createDataFrame([(*r, 1, {}) for r in rows], KINDS).repartition(parts)
    return sorted(tuple(r) for r in cl.cluster_vectors(d, **how).collect())


def listed(vectors):
    return [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def test_random_and_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(cl, "SHARD", 70)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 4))
    rows = listed([*rng.normal(size=(150, 4)) * 0.2, *(centres[rng.integers(0, 6, 200)] + 0.02 * rng.normal(size=(200, 4)))])
    assert run(spark, rows, length=4) == brute(rows, length=4)


def test_ties_and_equal_centroids(spark):
    rows = listed([[0.0, 0.0]] * 50 + [[1.0, 0.0]] * 30 + [[0.5, 0.0]] * 20 + [[0.0, 1 / 256]] * 9)
    assert run(spark, rows, length=2, clusters=12) == brute(rows, length=2, clusters=12)


def test_defined_cases(spark):
    inf = float("inf")
    rows = [*listed(np.eye(5)), (None, [1.0] * 5), (9, None), (10, [1.0] * 4), (11, [None] * 5), (12, [inf] * 5), (13, [float("nan")] * 5), (3, [2.0] * 5), (3, [2.0] * 5), (14, [])]
    assert run(spark, rows, length=5) == brute(rows, length=5)
    assert run(spark, [], length=5) == []
    assert run(spark, [(1, [1.0])], length=5) == []


@pytest.mark.parametrize("size", [2.0**18, 2.0**24, 1e12, 1e200, 1e306, 1.7e308])
def test_components_of_any_size(spark, size):
    rng = np.random.default_rng(2)
    rows = listed([*rng.normal(size=(60, 3)), *np.clip(rng.normal(size=(30, 3)) / 4, -1, 1) * size])
    assert run(spark, rows, length=3, clusters=8, rounds=3) == brute(rows, length=3, clusters=8, rounds=3)


def test_tree_is_a_nested_net():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-50, 50, size=(300, 3)), np.zeros((20, 3), int)])
    tree = cl.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for n in range(len(tree.parent)):
        own = tree.order[tree.start[n] : tree.start[n] + tree.size[n]]
        away = np.sqrt(((points[own] - points[tree.centre[n]]) ** 2).sum(1))
        assert away.max() <= tree.radius[n] + 1e-9
        kids = range(tree.first[n], tree.first[n] + tree.children[n])
        assert all(tree.parent[k] == n for k in kids)
        assert sum(int(tree.size[k]) for k in kids) in (0, tree.size[n])


def test_pruning_compares_fewer_pairs_on_clustered_vectors(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(-5000, 5000, size=(20, 8))
    points = np.concatenate([c + rng.integers(-20, 20, size=(50, 8)) for c in centres])
    tree, above = cl.Tree(points), cl.Tree.of(cl.centroid_tree(centres))
    seen = []
    monkeypatch.setattr(cl, "exact_distances", lambda a, b: (seen.append(len(a)), ((a - b) ** 2).sum(1))[1])
    cluster, distance = cl.nearest(points, tree, centres, above)
    all_ = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (cluster == all_.argmin(1)).all() and (distance == all_.min(1)).all()
    assert sum(seen) <= 1.1 * len(points)
