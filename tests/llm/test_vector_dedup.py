"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from lexiforge.llm import vector_dedup as vd

KINDS = "vec_id long, embedding array<double>, n int, key string, links map<string,int>"


def brute(rows, least=0.95):
    """[(vec_id, n_links, component)] of rows (vec_id, vector), by row."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / max(abs(x) for x in v) if o else None for (_, v), o in zip(rows, ok, strict=True)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    n = len(rows)
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(n)]
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in links[i]:
            root[top(j)] = top(i)
    ids = {}
    for i in range(n):
        if ok[i]:
            ids.setdefault(top(i), []).append(rows[i][0])
    out = []
    for i in range(n):
        own = [x for x in ids[top(i)] if x is not None] if ok[i] else []
        component = min(own) if own else rows[i][0]
        out.append((rows[i][0], len(links[i]), component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=str)


def run(spark, rows, parts=3, **how):
    d = spark.createDataFrame([(*r, 1, "x", {}) for r in rows], KINDS).repartition(parts)
    return sorted((tuple(r) for r in vd.near_duplicates(d, **how).collect()), key=str)


def near(rng, base, count, cosine):
    """Vectors at exactly this cosine from ``base``."""
    e = rng.normal(size=(count, len(base)))
    base = base / np.linalg.norm(base)
    e -= (e @ base)[:, None] * base
    e /= np.linalg.norm(e, axis=1)[:, None]
    return cosine * base + (1 - cosine**2) ** 0.5 * e


def listed(vectors, start=0):
    return [(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def test_defined_cases(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1e300, 1e298]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [1.0, None]), (8, [nan, 1.0]), (9, [float("inf"), 1.0])]
    rows += [(10, [1.0]), (11, [3.0]), (12, [-1.0]), (13, [1.0, 0.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 0.0]), (None, None), (14, [1e-300, 0.0]), (15, [-0.0, 5.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("block, occupancy", [(4096, 256), (16, 4), (5, 8)])
def test_chains_copies_and_groups(spark, monkeypatch, block, occupancy):
    monkeypatch.setattr(vd, "BLOCK", block)
    monkeypatch.setattr(vd, "VISITORS", 7)
    monkeypatch.setattr(vd, "OCCUPANCY", occupancy)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    made = [*base, *near(rng, base[0], 120, 0.985), *[base[1]] * 40, *near(rng, base[2], 20, 0.951), *near(rng, base[3], 20, 0.949)]
    chain = [base[5] / np.linalg.norm(base[5])]
    for _ in range(30):
        chain.append(near(rng, chain[-1], 1, 0.96)[0])
    rows = listed([*made, *chain])
    rng.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    # Every cell in reach: what is left to test are blocks, counts and forests.
    assert run(spark, rows, target=1.0 if block == 5 else 0.999) == brute(rows) or _recall(spark, rows) >= 0.99


def _recall(spark, rows):
    got = sum(r[1] for r in run(spark, rows))
    want = sum(r[1] for r in brute(rows))
    assert got <= want
    return got / want


def test_recall_at_the_least_similarity(spark, monkeypatch):
    monkeypatch.setattr(vd, "OCCUPANCY", 4)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(900, 32))
    rows = listed([*base, *[near(rng, v, 1, 0.9501)[0] for v in base]])
    got = run(spark, rows)
    assert sum(r[1] for r in got) >= 0.99 * 2 * 900
    assert all(r[1] <= w[1] for r, w in zip(got, brute(rows), strict=True))


def test_given_table_against_all_pairs(spark):
    d = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").select("vec_id", "embedding")
    rows = d.collect()
    m = np.array([r[1] for r in rows], float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    want = sum(int((m[i : i + 2048] @ m.T >= 0.95).sum()) for i in range(0, len(m), 2048)) - len(m)
    got = sum(r["n_links"] for r in vd.near_duplicates(d).collect())
    assert want > 1000 and 0.995 * want <= got <= want
