"""Packing: exact best-fit decreasing, gapless sequences, ids of the tokenizer."""

import random
import zlib
from array import array
from bisect import bisect_left, insort

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiforge.llm import packing


def best_fit_decreasing(lengths, capacity):
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect_left(free, x)
        gap = free.pop(i) if i < len(free) else capacity
        n += gap == capacity
        insort(free, gap - x)
    return n


def check(rows, capacity):
    """Every sequence is filled from 0 without gap or overlap."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert 0 < at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(4))
def test_plan_opens_as_many_as_best_fit(seed):
    rnd = random.Random(seed)
    for _ in range(200):
        counts = {rnd.randint(1, 64): rnd.randint(1, 30) for _ in range(rnd.randint(0, 14))}
        rows = [{"sequence_id": s + k, "offset": off, "length": n} for n, a, b, s, off in packing.plan(counts, 64) for k in range(b - a)]
        assert len(rows) == sum(counts.values())
        assert check(rows, 64) == best_fit_decreasing([n for n, c in counts.items() for _ in range(c)], 64)


def test_pack_places_every_row(spark):
    rnd = random.Random(5)
    rows = [(i % 40, rnd.choice([3, 5, 7, 11, 13, 17, 29, 33, 64]), "x", "y", i % 3) for i in range(700)]
    rows += [(None, 9, None, None, None)] * 3 + [(1, 20, "x", "y", 1)] * 50
    d = spark.createDataFrame(rows, "doc_id long, length long, sequence_id string, offset string, `a.b` int")
    got = packing.pack(d.repartition(9), 64).collect()
    assert got[0].asDict().keys() == {"doc_id", "length", "a.b", "sequence_id", "offset"}
    assert sorted((r["doc_id"], r["length"], r["a.b"]) for r in got if r["doc_id"] is not None) == sorted((a, b, e) for a, b, _, _, e in rows if a is not None)
    assert check(got, 64) == best_fit_decreasing([r[1] for r in rows], 64)
    assert packing.pack(d.limit(0), 64).count() == 0
    with pytest.raises(ValueError):
        packing.pack(d.limit(5), 2)


def test_documents_to_sequences(spark):
    e = packing.Encoder(packing.tokenizer_path())
    texts = [None, "", " ", "A ship.", "A ship.", "word " * 3000, "été\n\nfin", "x" * 9000]
    d = spark.createDataFrame([(i, t, "z", 0) for i, t in enumerate(texts)], "doc_id long, text string, ids string, piece int")
    got = packing.pack_documents(d, ids=True).collect()
    check(got, packing.CAPACITY)
    for i, t in enumerate(texts):
        want = e._ids(t or "") + bytes(4)
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        assert b"".join(x[4] for x in own) == want
        assert [x[0] for x in own] == list(range(len(own))) and all(x[2] == packing.CAPACITY for x in own[1:])
        assert [x[1] for x in own] == [sum(y[2] for y in own[:k]) for k in range(len(own))]
        assert [x[3] for x in own] == [zlib.crc32(x[4]) for x in own]
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.packed_sequences(d).collect()}
    assert sum(map(len, whole.values())) == 4 * sum(r["length"] for r in got) and len(whole) == len({r["sequence_id"] for r in got})


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path())


LETTERS = "aeinstr'sldAZé0129.,;!-_/\\<|>{}’ 　\t\r\n  ́ßçñ漢😀"


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet=LETTERS, max_size=60), st.text(max_size=40), st.lists(st.sampled_from(["the", "don't", "I'LL", "été", "2024", "x1y", "--", "...", "<|endoftext|>", "Straße", "a\nb", "naïve"]), max_size=15).map(" ".join)))
def test_ids_are_the_tokenizers(encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder.encode(text) == array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
