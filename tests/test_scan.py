"""Running figures of spread groups against windows."""

import random

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import scan
from lexiforge.operators import sequence as S


def events(spark, one_key):
    draw = random.Random(1)
    rows = [(0 if one_key else draw.choice([None, 1, 2, 2, 2, 3]), i, draw.choice(["", "ID.", "ID.", "A", "B", None]), draw.choice(["x", "x", "y", None])) for i in range(700)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "k int, i int, author string, name string").repartition(5)


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("one_key", [True, False])
def test_operators_agree_with_windows(spark, one_key):
    d = events(spark, one_key)
    for f in (
        lambda hot: S.resolve_idem(d, ["k"], ["i"], hot_rows=hot),
        lambda hot: S.islands(d, ["k"], ["i"], F.col("name") == "y", "p_", hot),
        lambda hot: S.islands(d, ["k"], ["i"], F.lit(False), hot_rows=hot),
        lambda hot: S.number_repeats(d, [], ["i"], "name", hot),
        lambda hot: S.number_repeats(d, ["k"], ["i"], "name", hot),
    ):
        want = rows(f(scan.SMALL))
        assert len(want) == 700
        assert rows(f(0)) == rows(f(100)) == want


def test_running_figures(spark):
    d = events(spark, True)
    got = scan.running(d, ["k"], ["i"], {"s": F.col("i")}, {"l": F.col("name")}, "n", {"m": F.col("name") == "y"}).orderBy("i").collect()
    total, last, mark = 0, None, None
    for n, r in enumerate(got, 1):
        total += r["i"]
        last = r["name"] or last
        mark = n if r["name"] == "y" else mark
        assert (r["s"], r["l"], r["n"], r["m"]) == (total, last, n, mark)
    assert scan.running(d.limit(0), ["k"], ["i"], row="n").count() == 0
    # The one key is spread.
    assert scan.ranged(d, ["k", "i"]).select("__part").distinct().count() > 1


def test_items_before(spark):
    d = spark.createDataFrame([(i, i % 4 if i % 7 else None, {"a": i}) for i in range(200)], "id int, n int, m map<string,int>").repartition(6)
    total = 0
    for r in scan.items_before(d, ["id"], F.col("n"), "before").orderBy("id").collect():
        assert r["before"] == total
        total += r["n"] or 0
    assert scan.items_before(d.limit(0), ["id"], F.col("n"), "before").count() == 0
