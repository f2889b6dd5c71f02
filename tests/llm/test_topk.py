"""Top-k against brute force in whole numbers of any size."""

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from lexiforge.llm import topk

LONG = 2**63


def brute(rows, k=5):
    """{(query id, vector): [(vec_id, score), ...]} for rows (vec_id, vector)."""
    fine = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            fine.append((i, tuple(floor(256 * Fraction(x)) for x in v)))
    out = {}
    for i, q in fine:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in fine if j != i and len(v) == len(q))
            out[i, q] = [(j, max(-LONG, min(LONG - 1, -s))) for s, j in scored[:k]]
    return out


def run(spark, rows, parts=3, k=5):
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, q int").repartition(parts)
    got = {}
    for r in topk.top_k(d, d.where("vec_id % 50 = 0"), k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {i: sorted(x) for i, x in got.items()}


def wanted(rows, k=5):
    out = {}
    for (i, _), x in brute(rows, k).items():
        out.setdefault(i, []).extend((n, j, s) for n, (j, s) in enumerate(x, 1))
    return {i: sorted(x) for i, x in out.items() if x}


def rows_of(vectors, start=0):
    return [(start + i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]


def check(spark, rows, **how):
    assert run(spark, [(*r, "x", 1) for r in rows], **how) == wanted(rows)


def test_random_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(1)
    rows = rows_of([*rng.normal(size=(300, 8)), *rng.normal(size=(120, 3)), [], [], [1.0]])
    rows += [(500, []), (550, [2.0]), (600, None), (650, [None, 1.0]), (700, [float("nan")]), (None, [1.0])]
    check(spark, rows)


def test_ties_and_repeats(spark):
    # Ties across batches, equal query rows, one id with two vectors.
    rows = rows_of([[1.0, 0.0]] * 60 + [[0.5, 0.5]] * 60) + [(50, [1.0, 0.0]), (50, [0.0, 3.0]), (7, [9.0, 9.0]), (7, [9.0, 9.0])]
    check(spark, rows, parts=7)


@pytest.mark.parametrize("size", [70000.0, 1e12, 1e200, 1e305, 3e306, 2e307])
def test_large_components(spark, size):
    rng = np.random.default_rng(2)
    rows = rows_of(np.floor(rng.normal(size=(120, 4)) * size))
    check(spark, rows)


def test_small_blocks_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 5 * 2)
    rng = np.random.default_rng(3)
    check(spark, rows_of(rng.normal(size=(260, 5))))
    check(spark, rows_of([[1.0], [2.0]]))
    d = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(d, d).count() == 0


def test_coarse_cells_read_more_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 2)
    monkeypatch.setattr(topk, "READ", 1)
    rng = np.random.default_rng(4)
    check(spark, rows_of(rng.integers(-3, 4, size=(300, 6))))
