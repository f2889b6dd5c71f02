"""Publication, observed counters and the stateful stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lexiforge.operators.observed import counted
from lexiforge.operators.publish import Publication
from lexiforge.plans import given
from lexiforge.streaming import carry


def tables(spark, n):
    return {"a": spark.range(n), "b": spark.range(2 * n).select(F.col("id").alias("x"), F.lit("t").alias("y"))}


def test_publication_is_all_or_nothing(spark, tmp_path, monkeypatch):
    p = Publication(spark, f"file://{tmp_path}/p")
    assert p.versions() == [] and p.read() == {}
    assert p.write(tables(spark, 5)) == 1
    assert {r["table_name"]: r["n_rows"] for r in p.counts().collect()} == {"a": 5, "b": 10}

    # A write that dies between two tables leaves the old set.
    broken = tables(spark, 7) | {"b": spark.range(3).select(F.raise_error(F.lit("gone")).alias("x"))}
    with pytest.raises(Exception, match="gone"):
        p.write(broken)
    assert p.versions() == [1] and p.read()["a"].count() == 5 and p.read()["b"].count() == 10

    # A reader keeps its version; the next one sees the new set.
    old = p.read()
    assert p.write(tables(spark, 7)) == 2
    assert (old["a"].count(), old["b"].count(), p.read()["a"].count(), p.read()["b"].count()) == (5, 10, 7, 14)
    assert p.read(1)["a"].count() == 5

    # Two writers: the later one takes the next number.
    other, known = Publication(spark, f"file://{tmp_path}/p"), [[1, 2], [1, 2, 3]]
    assert p.write(tables(spark, 1)) == 3
    real = other.versions
    monkeypatch.setattr(other, "versions", lambda: known.pop(0) if known else real())
    assert other.write(tables(spark, 2)) == 4 and p.versions() == [1, 2, 3, 4]

    p.drop_old(1)
    assert p.versions() == [4] and p.read()["b"].count() == 4
    assert len([x for x in (tmp_path / "p" / "data").iterdir() if not x.name.startswith(".")]) == 1


def test_counters_ride_on_the_write(spark):
    table, seen = counted(spark.range(100).withColumn("odd", F.col("id") % 2 == 1), "t", n=F.count("*"), odd=F.count_if("odd"))
    assert seen == {"n": 100, "odd": 50} and table.count() == 100
    _, seen = counted(spark.range(0), "t", n=F.count("*"), top=F.max("id"))
    assert seen == {"n": 0, "top": None}


class Handle:
    """The list state of one user."""

    def __init__(self):
        self.held = None

    def getListState(self, name, schema):
        return self

    def exists(self):
        return self.held is not None

    def get(self):
        return iter(self.held)

    def put(self, rows):
        self.held = list(rows)


def brute(rows):
    """Names resolved over all rows at once."""
    out, last = {}, None
    for ts, i, a in sorted(set(rows), key=lambda x: x[:2]):
        last = a if a not in ("", "ID.", None) else last
        out[i] = (last or "ID.") if a == "ID." else a
    return out


def test_processor_late_and_repeated_rows():
    draw, day = random.Random(3), dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(minutes=i), i, draw.choice(["", "ID.", "ID.", "A", "B", "C"])) for i in range(300)]
    p, handle = carry.CarryAuthor(), Handle()
    p.init(handle)
    say = lambda part: {r["event_id"]: r["resolved_author"] for r in p.handleInputRows((1,), iter([{"ts": t, "event_id": i, "author": a} for t, i, a in part]), None)}
    got = {}
    for at in range(0, 300, 37):
        part = rows[at : at + 37]
        draw.shuffle(part)
        got |= say(part)
    assert got == brute(rows)
    # Rows that come again, and one that comes late, are resolved at their own place.
    assert say(rows[40:60]) == {i: x for i, x in brute(rows).items() if 40 <= i < 60}
    assert say([(day + dt.timedelta(minutes=100, seconds=30), 1000, "ID.")]) == {1000: brute(rows[:101] + [(day + dt.timedelta(minutes=100, seconds=30), 1000, "ID.")])[1000]}
    # Past the horizon the oldest name kept is taken.
    say([(day + dt.timedelta(days=30), 5000, "Z")])
    assert len(handle.held) == 2 and handle.held[-1][2] == "Z"


def test_stream_over_the_given_table(spark):
    got = {r["event_id"]: r["resolved_author"] for r in given.stream_locf(spark, "/root/testdata/sf0.001").collect()}
    by_user = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", "event_type").collect():
        a = {"error": "ID.", "view": ""}.get(r["event_type"], r["event_type"].upper())
        by_user.setdefault(r["user_id"], []).append((r["ts"], r["event_id"], a))
    want = {}
    for rows in by_user.values():
        want |= brute(rows)
    assert got == want
