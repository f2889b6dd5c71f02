"""Straightened markup and block-max retrieval against plain readings of their rules."""

import math
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from lexiforge.functions.nested import EMPHASIS, straightened
from lexiforge.operators.lookup import Index
from lexiforge.operators.retrieval import BlockIndex


def plain(markup):
    out, stack = [], []
    for p in re.findall(r"<[^>]*>|[^<]+|<", markup):
        m = re.match(r"^</?([a-zA-Z][a-zA-Z0-9]*)[^>]*>$", p)
        name = m.group(1).lower() if m else ""
        if name == "a":
            continue
        if name in EMPHASIS and p.startswith("</"):
            at = [i for i, x in enumerate(stack) if x == name]
            if at:
                del stack[at[-1] :]
            if not at or stack:
                continue
        elif name in EMPHASIS:
            stack.append(name)
            if len(stack) > 1:
                continue
        out.append(p)
    return "".join(out)


def test_straightened(spark):
    draw = random.Random(1)
    pieces = ["<b>", "</b>", "<i class='x'>", "</I>", "<em>", "</em>", "<strong>", "</strong>", "<a href='y'>", "</a>", "<p>", "</p>", "<br>", "text ", "a < b", "<", ">", "é\n"]
    rows = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*rows, None])], "i int, x string")
    got = [r["y"] for r in df.select("i", straightened(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [*map(plain, rows), None]
    assert "Python" not in df.select(straightened(F.col("x")))._jdf.queryExecution().toString()


def corpus(seed, n=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    return [(i * 3, " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))) for i in range(n)] + [(5, None), (7, "w0 w0 W0, w1")]


def brute(rows, terms, k):
    docs = {i: re.findall(r"\w+", (t or "").lower()) for i, t in rows}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    df = {t: sum(t in w for w in docs.values()) for t in terms}
    out = []
    for i, w in docs.items():
        if all(t in w for t in terms):
            s = 0.0
            for t in terms:
                tf = w.count(t)
                s += max(math.log((n - df[t] + 0.5) / (df[t] + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
            out.append((round(-s, 6), i))
    return [(i, s) for s, i in sorted(out)[:k]]


def test_block_max(spark):
    rows = corpus(2)
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, text string, no int").repartition(3)
    index, whole = BlockIndex(df, "id", "text", width=8), Index(df, "id", "text")
    for terms, k in ((["w0"], 5), (["w3", "w9"], 5), (["w12", "w20"], 10), (["w0", "w1", "w2"], 3), (["w29"], 1000), (["w5", "none"], 5), (["w7", "w7"], 4)):
        best, told = index.top(terms, k)
        got = [tuple(r) for r in best.collect()]
        assert got == brute(rows, sorted(set(terms)), k), terms
        same = whole.search(terms).select("id", F.round("score", 6).alias("score")).orderBy("score", "id").limit(k)
        assert got == [tuple(r) for r in same.collect()]
        assert told["read"] <= told["blocks"]
    # A word in few ranges next to one in all of them: most blocks of the second are never read.
    told = index.top(["w0", "w25"], 3)[1]
    assert 0 < told["read"] < told["blocks"] / 2
    assert BlockIndex(df.limit(0), "id", "text").top(["a"], 3)[0].count() == 0


def test_packed_postings(spark):
    rows = corpus(3)
    df = spark.createDataFrame([*rows, (7, "w0 once"), (None, "w0 w0"), (-5, None)], "id long, text string").repartition(3)
    index = Index(df, "id", "text")
    held: dict[str, list] = {}
    for i, text in [*rows, (7, "w0 once"), (None, "w0 w0")]:
        for w in re.findall(r"\w+", (text or "").lower()):
            held.setdefault(w, []).append(i)
    want = {w: (len({i for i in ids if i is not None}), len(ids)) for w, ids in held.items()}
    assert {r["term"]: (r["df"], r["cf"]) for r in index.terms().collect()} == want
    # A row for each term and portion, not for each word of each text.
    assert index.postings.count() < sum(len(set(ids)) for ids in held.values()) / 3


def test_portions_and_numbers():
    import numpy as np

    from lexiforge.operators.postings import numbers, portions, varints

    x = np.array([0, 1, 127, 128, 300, 1 << 35, (1 << 64) - 1], np.uint64)
    raw, begin = varints(x)
    assert (numbers(raw.tobytes()) == x).all() and begin[-1] == len(raw)
    keys = [1, 1, 2, 3, 3, 3, 3, None, None, 4]
    batches = [pa.record_batch({"k": pa.array(keys[i : i + 3], pa.int64()), "w": [["a", "b"]] * len(keys[i : i + 3])}) for i in range(0, 10, 3)]
    got = [t.column(0).to_pylist() for t in portions(batches, 4)]
    assert [k for t in got for k in t] == keys and len(got) > 1
    assert all(not set(a) & set(b) for i, a in enumerate(got) for b in got[i + 1 :])


def test_blocks_of_rows_that_share_a_key(spark):
    df = spark.createDataFrame([(1, "w0 w1"), (1, "w0 w0 w0"), (2, "w0"), (3, "w1"), (4, "w2")], "id long, text string")
    best, told = BlockIndex(df, "id", "text", width=2).top(["w0"], 5)
    assert sorted(r["id"] for r in best.collect()) == [1, 1, 2] and told["blocks"] >= 2
