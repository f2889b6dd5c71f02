"""Mixing against brute force: targets by resharing step by step, mass by source, copies by document."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import mixing


def brute_targets(sizes):
    """{source: target}: weights 3, 1, 2 in code-point order (null last) share 150%, cut at twice the size, the excess reshared."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        cut = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not cut:
            return out | {s: weight[s] * level for s in open_}
        for s in cut:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= cut
    return out


@pytest.mark.parametrize("seed", range(5))
def test_targets_are_reshared_to_the_end(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i:02d}" if i else None: rnd.choice([0, 1, 7, 50, 400, 3000]) for i in range(rnd.randint(1, 14))}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


def test_mass_and_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 64)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 2, 3, 9, 40])), rnd.choice(["a"] * 8 + ["b", "c", None]), 5, 7) for i in range(1500)]
    rows += [(None, None, "a", 5, 7), (3, "", None, 5, 7), (4, "x " * 3000, "b", 5, 7)] + [(11, "w w w", "c", 5, 7)] * 40
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, copies int")
    got = mixing.mix(d).collect()
    assert len(got) == len(rows)
    sizes, largest = Counter(), Counter()
    for _, t, s, *_ in rows:
        n = len((t or "").split())
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"]
        assert int(rate) <= r["copies"] <= int(rate) + (rate > int(rate)) or r["size"] == 0
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix(d.repartition(13)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_resample_repeats_rows_as_often_as_the_mix_takes_them(spark):
    rows = [(i, f"word{i} " * (i % 5), "abc"[i % 3], i, 0) for i in range(200)] + [(5, "word5 " * 3, "a", 5, 0)] * 3 + [(6, None, None, 6, 0), (7, "", "b", 7, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` long, target int")
    got = mixing.resample(d)
    assert got.columns == d.columns
    key = F.concat_ws("|", F.col("doc_id").cast("string"), F.coalesce("source", F.lit("-")), F.md5(F.coalesce("text", F.lit("\x00"))))
    have = Counter(r[0] for r in got.select(key).collect())
    made = mixing.mix(d).select("doc_id", "source", "size", "copies").collect()
    want, seen = Counter(), Counter()
    for r in made:
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    for r in got.select("doc_id", "source", F.regexp_count("text", F.lit(r"\S+")).alias("n")).collect():
        seen[r["doc_id"], r["source"], r["n"] or 0] += 1
    assert +want == seen and sum(have.values()) == sum(want.values())
    assert mixing.resample(d.limit(0)).count() == 0
