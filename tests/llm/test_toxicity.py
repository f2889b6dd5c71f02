"""Toxicity: the fit against its stated loss, and training that does not hang on the layout of rows."""

import numpy as np
import pytest

from lexiforge.llm import toxicity

PROSE = "The ship was in the bay and the town was far away. "


def packed(ids):
    return np.array(sorted(ids), np.int32).tobytes()


def fit(rows, pairs, size, **how):
    return toxicity.fit([y for y, _ in rows], [packed(x) for _, x in rows], [(packed(a), packed(b)) for a, b in pairs], size, **how)


def loss(rows, pairs, size, bias, w, fairness, decay=toxicity.DECAY):
    """The stated loss, term by term."""
    n = len(rows)
    many = [sum(y == k for y, _ in rows) for k in (0, 1)]
    out = 0.0
    for y, x in rows:
        z = bias + sum(w[i] for i in x)
        balance = (0.5 * n / many[y]) ** 0.75
        out += balance * (np.log1p(np.exp(-z)) if y else np.log1p(np.exp(z))) / n
    for a, b in pairs:
        out += fairness * (sum(w[i] for i in a) - sum(w[i] for i in b)) ** 2 / max(1, len(pairs))
    return out + decay * sum(abs(x) for x in w) + decay / 2 * sum(x * x for x in w)


@pytest.mark.parametrize("fairness", [0.0, 1.0])
def test_fit_is_near_a_minimum_of_the_loss(fairness):
    rng = np.random.default_rng(3)
    rows = [(int(0 in x or (1 in x and i % 3 == 0)), sorted(x)) for i, x in enumerate(set(rng.integers(0, 6, 4).tolist()) for _ in range(60))]
    pairs = [([1, 2], [2, 3]), ([1], [4])]
    bias, w = fit(rows, pairs, 6, fairness=fairness, rounds=1500)
    here = loss(rows, pairs, 6, bias, w, fairness)
    assert here < loss(rows, pairs, 6, 0.0, np.zeros(6), fairness)
    for _ in range(200):
        step = rng.normal(size=7) * 0.05
        assert loss(rows, pairs, 6, bias + step[0], w + step[1:], fairness) > here - 2e-3


def test_swaps_pull_group_names_together():
    rows = [(i % 2, [0, 1] if i % 2 else [0, 2]) for i in range(40)]  # feature 1 stands in toxic texts only
    free = fit(rows, [], 3)[1]
    bound = fit(rows, [([1], [2])] * 20, 3)[1]
    assert abs(bound[1] - bound[2]) < 0.3 * abs(free[1] - free[2])


def rows_of(n):
    return [(i, PROSE * (1 + i % 3) + ("you idiot. " if i % 4 == 0 else "") + ("The women left." if i % 5 == 0 else ""), 0.5, 1) for i in range(n)]


def test_layout_repeats_and_clashing_names(spark):
    rows = rows_of(120) + [(0, rows_of(1)[0][1], 0.5, 1)] * 30 + [(7, None, 0.5, 1), (8, "", 0.5, 1), (None, "you idiot.", 0.5, 1), (9, ("Fine words. " * 20000) + "you idiot.", 0.5, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0), "x") for i in range(120)] + [(4, 0, 0, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
    one = sorted(map(tuple, toxicity.toxicity(d, labels).collect()), key=repr)
    two = sorted(map(tuple, toxicity.toxicity(d.repartition(9), labels.repartition(5)).collect()), key=repr)
    assert one == two and len(one) == len(rows)
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in one)
    assert {r[3] for r in one if r[0] == 0} == {1} and {r[3] for r in one if r[0] == 1} == {0}


def test_empty_and_one_class(spark):
    d = spark.createDataFrame(rows_of(20), "doc_id long, text string, score double, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(d, none).collect()} == {0.0}
    for y in (0, 1):
        labels = spark.createDataFrame([(i, 1, y) for i in range(20)], "doc_id long, quality int, toxic int")
        assert {r["predicted"] for r in toxicity.toxicity(d, labels).collect()} == {y}
    assert toxicity.toxicity(d.limit(0), none).count() == 0


def test_every_term_is_swapped():
    pairs = toxicity.template_pairs()
    assert len(pairs) == len(toxicity.TEMPLATES) * len(toxicity.TERMS) and all(a != b for a, b in pairs)


def test_scores_are_those_of_the_fitted_weights(spark):
    """Everything from the text on written out again: words, beginnings, hashes, swaps, the sum and its logistic."""
    import math
    import re

    import xxhash

    def names(text):
        words = {m.group().lower() for m in re.finditer(r"[^\W\d_]+(?:['’][^\W\d_]+)*", (text or "").lower())}
        return words | {w[:n] + "*" for w in words for n in (5, 6, 7, 8) if len(w) > n}

    def ids(text):
        return {xxhash.xxh32(x.encode()).intdigest() % toxicity.WIDTH for x in names(text)}

    def swaps(text):
        out = []
        for sentence in re.split(r"[.!?\n]", text or ""):
            own = {m.group() for m in re.finditer(r"[^\W\d_]+(?:['’][^\W\d_]+)*", sentence.lower())}
            for kin in toxicity.IDENTITY.values():
                for i, term in enumerate(kin):
                    if term in own:
                        other = own - {term} | {kin[(i + 1) % len(kin)]}
                        out.append((packed(ids(" ".join(own))), packed(ids(" ".join(other)))))
        return out

    rows = rows_of(90)
    d = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int")
    y = {i: int(i % 4 == 0) for i in range(90)}
    labels = spark.createDataFrame([(i, 1, t) for i, t in y.items()], "doc_id long, quality int, toxic int")
    import zlib

    taught = sorted((y[i], packed(ids(t))) for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 5)
    neutral = [s.format(t) for s in toxicity.TEMPLATES for t in toxicity.TERMS]
    pairs = sorted({p for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 5 for p in swaps(t)} | {p for t in neutral for p in swaps(t)})
    bias, w = toxicity.fit([a for a, _ in taught], [x for _, x in taught], pairs, toxicity.WIDTH)
    for r in toxicity.toxicity(d, labels).collect():
        z = bias + sum(w[x] for x in ids(rows[r["doc_id"]][1]))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_no_text_waits_for_its_score(spark):
    from lexiforge.llm.toxicity import toxicity

    docs = spark.createDataFrame([(i, "a fool" if i % 2 else "a friend") for i in range(40)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = toxicity(docs, labels)
    assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.where("score is null").count() == 0 and got.count() == 41
