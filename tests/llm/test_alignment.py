"""Alignment against whole-text tokenisation, token by token."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexiforge.llm import alignment, queries

PATHS = alignment.default_paths()
WHOLE = Tokenizer.from_file(PATHS[0])
WHOLE.encode_special_tokens = True


def groups(text):
    """The groups of a text from one call of each tokenizer; None where the bytes differ."""
    p = alignment.pair(*PATHS)
    if not text:
        return []
    a, b = WHOLE.encode(" " + text, add_special_tokens=False).ids, p.b.encode(text)
    raw = (" " + text).encode()
    if not raw == b"".join(p.bytes_a[x] for x in a) == b"".join(p.bytes_b[x] for x in b):
        return []
    out, left, right, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            left.append(a[i])
            at_a += len(p.bytes_a[a[i]])
            i += 1
        else:
            right.append(b[j])
            at_b += len(p.bytes_b[b[j]])
            j += 1
        if at_a == at_b:
            out.append((left, right))
            left, right = [], []
    return out


def brute(texts):
    docs = [groups(t) for t in texts]
    held = Counter(x for g in docs for x in {(x, y) for a, b in g for x in a for y in b})
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for g in docs:
        links = [(x, y) for a, b in g for x in a for y in b]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(told.encode()).hexdigest() if g else ""))
    return out


LETTERS = ["a", "the", " ", "  ", "\n", "\t", "é", "😀", "<|endoftext|>", "<s>", "</s>", "<0x41>", "word", "'s", "12", ".", ",", "　", "\xa0", "\x1c", "ſ", "́", "﻿", "\x00", "​", "\r\n", "漢字", "!!", "…", "ing", "▁"]


def texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("bound", [50, 400_000])
def test_units_stand_by_themselves(monkeypatch, bound):
    monkeypatch.setattr(alignment, "CACHE", bound)
    alignment.units_in_process.cache_clear()
    monkeypatch.setattr(alignment, "CHARS", 3000)
    made = [*texts(4000), "▁x", "a ▁b", "x" * 20_000, " " * 9000 + "a", "é" * 9000, None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int64()), pa.array(made, pa.string())], ["doc_id", "t"])
    got = [r for b in alignment.document_rows([batch], PATHS) for r in b.to_pylist()]
    want = brute(made)
    for t, g, w in zip(made, got, want, strict=True):
        assert (g["n_a"], g["n_b"], g["n_groups"], g["n_links"], g["groups_sha256"]) == (*w[:4], w[6]), t
    alignment.units_in_process.cache_clear()


@pytest.mark.parametrize("lookup", ["mapped", "joined"])
def test_rows_against_brute_force(spark, lookup):
    made = [*texts(300, 2), None, "", "the the the", "the the the", "a▁b"]
    rows = [(i if i != 3 else None, t, 1, "x", {"k": 1}) for i, t in enumerate(made)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_a int, key string, pairs map<string,int>").repartition(5)
    got = sorted((tuple(r) for r in alignment.align(d, lookup=lookup).collect()), key=str)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, brute(made), strict=True)), key=str)


def test_no_rows_and_no_tokens(spark):
    for lookup in ("mapped", "joined"):
        assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), lookup=lookup).count() == 0
        got = alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), lookup=lookup).collect()
        assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "")}


def test_small_partial_counts(monkeypatch, spark):
    monkeypatch.setattr(alignment, "PARTIAL", 40)
    monkeypatch.setattr(alignment, "ROWS", 3)
    made = texts(60, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int64()), pa.array(made)], ["doc_id", "t"])
    rows = [b.select(["pairs"]) for b in alignment.document_rows([batch], PATHS)]
    got = Counter()
    for b in alignment.partial_counts(rows):
        for r in b.to_pylist():
            got[r["key"]] += r["n"]
    held = Counter(x for t in made for x in {(x << 32) | y for a, b in groups(t) for x in a for y in b})
    assert got == held


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    made = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op11_cross_tokenizer(spark, sf).collect())
    assert got == sorted((r[0], *w) for r, w in zip(made, brute([r[1] for r in made]), strict=True))
