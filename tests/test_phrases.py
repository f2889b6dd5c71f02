"""Phrases against a search at every place."""

import random

import pytest

from lexiforge.operators import phrases as P


def brute(words, table, leftmost):
    out, free = [], 0
    for at in range(len(words)):
        hits = [(len(p), n) for p, n in table.items() if tuple(words[at : at + len(p)]) == p]
        if hits and (at >= free or not leftmost):
            n, number = max(hits)
            out.append((at, n, number))
            free = at + n
    return out


def case(seed):
    draw = random.Random(seed)
    letters = "ab" if seed % 2 else "abcd"
    table = {}
    for i in range(draw.randint(1, 25)):
        table.setdefault(tuple(draw.choice(letters) for _ in range(draw.randint(1, 6))), i)
    return [draw.choice(letters) for _ in range(draw.randint(0, 60))], table


def test_automaton():
    for seed in range(1500):
        words, table = case(seed)
        found = P.Automaton([(list(p), n) for p, n in table.items()]).longest(words)
        assert sorted((at, *x) for at, x in found.items()) == brute(words, table, False), seed
        # Leftmost matches are what a reading without failure links finds.
        free, taken = 0, []
        for at in sorted(found):
            if at >= free:
                taken.append((at, *found[at]))
                free = at + found[at][0]
        assert taken == brute(words, table, True)


@pytest.mark.parametrize("most_bytes", [1 << 20, 30])
@pytest.mark.parametrize("leftmost", [True, False])
def test_tables_and_several_automata(spark, most_bytes, leftmost):
    cases = [case(s) for s in range(40)]
    table = {}
    for _, t in cases:
        for p in t:
            table.setdefault(p, len(table))
    docs = [(i % 30, " \n".join(w), 1, {"a": 1}) for i, (w, _) in enumerate(cases)] + [(900, None, 1, {}), (901, " ", 1, {}), (None, "a b", 1, {})]
    rows = [(n, "  ".join(p)) for p, n in table.items()] + [(10_000 + n, " ".join(p)) for p, n in table.items()] + [(5, ""), (6, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, start int, row map<string,int>").repartition(3)
    ph = spark.createDataFrame(rows, "id long, words string")
    got = sorted((tuple(r) for r in P.longest_matches(df, "doc_id", "text", ph, "id", "words", leftmost, most_bytes).collect()), key=str)
    want = [(i, *m) for i, t, *_ in docs for m in brute((t or "").split(), table, leftmost)]
    assert got == sorted(want, key=str)
    assert P.longest_matches(df, "doc_id", "text", ph.limit(0), "id", "words").count() == 0
    assert P.longest_matches(df.limit(0), "doc_id", "text", ph, "id", "words").count() == 0
