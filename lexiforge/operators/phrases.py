"""The longest phrases of a table in whole texts, by an automaton with failure links.

Words are what stands between white space; a phrase matches word by word, case and marks
included. An automaton is built once from the distinct phrases and broadcast: a text is read
once, whatever the number of phrases. A table of more than ``MOST_BYTES`` of text is dealt
into as many automata as it takes, by a hash of the whole phrase, so no frequent first word
can fill one; texts are read once for each, and an automaton is released before the next.

``longest_matches`` gives, at each place where any phrase begins, the longest one;
``leftmost`` keeps of these the first, then the first that begins after it, and so on.

Defined cases: a null or empty text holds nothing; a phrase without words matches nowhere;
of equal phrases the least id counts; a null id is an id like others, the greatest; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged

MOST_BYTES = 32 << 20
WORD = r"[^\x09-\x0D\x20]+"
_word = re.compile(WORD)


class Automaton:
    """States are prefixes of phrases; a state without the next word falls back to its longest suffix that is one."""

    def __init__(self, phrases: list[tuple[list[str], int]]):
        self.step: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, int] | None] = [None]  # (words, id) of the phrase that ends here
        for words, number in phrases:
            at = 0
            for w in words:
                to = self.step[at].get(w)
                if to is None:
                    to = self.step[at][w] = len(self.step)
                    self.step.append({})
                    self.ends.append(None)
                at = to
            if words:
                self.ends[at] = (len(words), number)
        self._link()

    def _link(self) -> None:
        self.back = [0] * len(self.step)
        self.shorter = [0] * len(self.step)  # the next state back at which a phrase ends
        todo = deque(self.step[0].values())
        while todo:
            at = todo.popleft()
            for w, to in self.step[at].items():
                back = self.back[at]
                while back and w not in self.step[back]:
                    back = self.back[back]
                self.back[to] = self.step[back].get(w, 0)
                todo.append(to)
            back = self.back[at]
            self.shorter[at] = back if self.ends[back] else self.shorter[back]

    def longest(self, words: list[str]) -> dict[int, tuple[int, int]]:
        """{first word: (words, id)} of the longest phrase that begins at each place."""
        step, back, ends, shorter = self.step, self.back, self.ends, self.shorter
        at, out = 0, {}
        for i, w in enumerate(words):
            to = step[at].get(w)
            while to is None and at:
                at = back[at]
                to = step[at].get(w)
            at = to or 0
            state = at if ends[at] else shorter[at]
            while state:
                n, _ = ends[state]
                out[i - n + 1] = ends[state]  # a later end is a longer phrase
                state = shorter[state]
        return out


def match_rows(batches, automaton: Automaton, only_leftmost: bool):
    """(row, text) to (row, start, n_words, phrase)."""
    for batch in batches:
        own, starts, sizes, ids = [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            found = automaton.longest(_word.findall(text)) if text else {}
            free = 0
            for at in sorted(found):
                if at >= free or not only_leftmost:
                    n, number = found[at]
                    own.append(i)
                    starts.append(at)
                    sizes.append(n)
                    ids.append(number)
                    free = at + n
        if own:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())], ["row", "start", "n_words", "phrase"])


def _chosen(matches: Column) -> Column:
    """Of (start, n_words, phrase) in order of their starts, those that begin after the last one taken."""
    start = F.struct(F.lit(0).cast("long").alias("free"), F.array().cast("array<struct<start:bigint,n_words:bigint,phrase:bigint>>").alias("taken"))

    def step(a, m):
        fits = m["start"] >= a["free"]
        return F.struct(F.when(fits, m["start"] + m["n_words"]).otherwise(a["free"]).alias("free"), F.when(fits, F.concat(a["taken"], F.array(m))).otherwise(a["taken"]).alias("taken"))

    return F.aggregate(matches, start, step, lambda a: a["taken"])


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def phrase_table(phrases: DataFrame, number: str, phrase: str) -> DataFrame:
    """(words, id): the distinct phrases with their least id."""
    d = phrases.select(words_of(F.col(phrase)).alias("words"), F.col(number).cast("long").alias("id")).where(F.size("words") > 0)
    return d.groupBy("words").agg(F.min("id").alias("id"))


def _automata(table: DataFrame, most_bytes: int):
    """One automaton after the other, each of at most about ``most_bytes`` of words."""
    size = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 1)
    held = staged(table.withColumn("bytes", size), "phrases")
    parts = max(1, -(-(held.agg(F.sum("bytes")).first()[0] or 0) // most_bytes))
    for p in range(parts):
        rows = held.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == p).select("words", "id").collect()  # about most_bytes
        yield parts, Automaton([(r["words"], r["id"]) for r in rows])
    discard(held)


def longest_matches(df: DataFrame, key: str, text: str, phrases: DataFrame, number: str, phrase: str, leftmost: bool = True, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(key, start, n_words, phrase): matches by the number of their first word, from 0."""
    spark = df.sparkSession
    own = df.select(F.struct(F.col(key).alias("key"), F.monotonically_increasing_id().alias("n")).alias("row"), F.col(text).alias("t"))
    kind = dict(own.dtypes)["row"]
    schema = f"row {kind}, start long, n_words long, phrase long"
    found = []
    for parts, automaton in _automata(phrase_table(phrases, number, phrase), most_bytes):
        if parts == 1:
            one = spark.sparkContext.broadcast(automaton)
            made = own.mapInArrow(lambda b: match_rows(b, one.value, leftmost), schema)
            return made.select(F.col("row.key").alias(key), "start", "n_words", "phrase")
        if not found:
            own = staged(own, "texts")  # rows keep their numbers from one automaton to the next
        now = spark.sparkContext.broadcast(automaton)
        found.append(staged(own.mapInArrow(lambda b, now=now: match_rows(b, now.value, False), schema), "matches"))
        now.destroy()
    every = found[0]
    for d in found[1:]:
        every = every.unionByName(d)
    best = every.groupBy("row", "start").agg(F.max_by(F.struct("n_words", "phrase"), "n_words").alias("m"))
    each = best.select("row", "start", "m.n_words", "m.phrase")
    if leftmost:
        own = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "n_words", "phrase"))).alias("all"))  # the matches of one text
        each = own.select("row", F.explode(_chosen(F.col("all"))).alias("m")).select("row", "m.*")
    return each.select(F.col("row.key").alias(key), "start", "n_words", "phrase")
