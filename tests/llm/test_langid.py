"""Language identification: naive Bayes by hand, and predictions that hang on their text alone."""

from collections import Counter
from math import exp, log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiforge.llm import langid

WORDS = {"en": "the and of with that for this is", "de": "der und das mit nicht für ist ein", "fr": "le et de avec que pour ce est"}


def brute_grams(text):
    s = langid.characters(text).tolist()
    return Counter(int(langid.gram_buckets(np.array(s[i : i + o], np.uint32), o)[0]) for o in langid.ORDERS for i in range(len(s) - o + 1))


def counts_of(texts):
    out = [Counter() for _ in texts]
    for place, who, begin in langid.part_grams(texts):
        for w, a, b in zip(who.tolist(), begin.tolist(), [*begin[1:].tolist(), len(place)], strict=True):
            out[w].update(p for p in place[a:b].tolist() if p != langid.BUCKETS)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab dé", max_size=70), max_size=6), st.sampled_from([4, 7, 64]))
def test_grams_never_leave_their_text(texts, piece):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(langid, "PIECE", piece)
        assert counts_of(texts) == [brute_grams(t) for t in texts]


@pytest.fixture(scope="module")
def model():
    table = np.zeros((langid.BUCKETS, 3))
    for i, lang in enumerate(sorted(WORDS)):
        for g, n in brute_grams(WORDS[lang]).items():
            table[g, i] += n
    return sorted(WORDS), table, langid.log_matrix(table)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["o", "", None, "12 !", "the and of", "der und das", "é", "le " * 40, "x y z " * 30]), min_size=1, max_size=8))
def test_a_row_alone_is_the_row_in_any_batch(model, texts):
    names, _, weights = model
    with pytest.MonkeyPatch.context() as m:
        m.setattr(langid, "PIECE", 50)
        got = langid.score_texts(texts, names, weights)
        assert got == [langid.score_texts([t], names, weights)[0] for t in texts]
        assert got[::-1] == langid.score_texts(texts[::-1], names, weights)


def test_long_text_is_read_whole(model):
    names, _, weights = model
    text = (WORDS["de"] + " ") * (langid.PIECE // 20)
    assert len(text) > langid.PIECE
    assert counts_of([text]) == [brute_grams(text)]
    one = langid.score_texts([text], names, weights)[0]
    assert one["lang_pred"] == "de" and langid.score_texts(["the", text, "le"], names, weights)[1] == one


def test_scores_are_naive_bayes(model):
    names, table, weights = model
    total = (table + langid.SMOOTHING).sum(axis=0)
    for text in ("the of", "mit ein", "que", "o", "le and das"):
        grams = brute_grams(text)
        sums = [sum(n * log((table[g, i] + langid.SMOOTHING) / total[i]) for g, n in grams.items()) for i in range(3)]
        best = max(range(3), key=lambda i: (sums[i], -i))
        z = [(s - sums[best]) / max(1.0, sum(grams.values()) / 150) for s in sums]
        got = langid.score_texts([text], names, weights)[0]
        assert got["lang_pred"] == names[best]
        assert got["score"] == pytest.approx(1 / sum(map(exp, z)), abs=1e-3)


def test_query_rows(spark):
    rows = [(i, WORDS["en" if i % 2 else "de"], "en" if i % 2 else "de", 1) for i in range(40)]
    rows += [(41, WORDS["en"], None, 1), (42, None, "en", 1), (43, "12", "en", 1), (43, "12", "en", 1), (None, WORDS["de"], "en", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    got = sorted(map(tuple, langid.identify(d).collect()), key=repr)
    assert len(got) == len(rows) and got == sorted(map(tuple, langid.identify(d.repartition(7)).collect()), key=repr)
    by = {r[0]: r for r in got}
    assert by[41][2] == "en" and by[42][2:] == by[43][2:] == ("und", 0.0) and by[None][2] == "de"
    alone = langid.identify(d.where("lang is null or doc_id < 40")).where("doc_id = 41").first()
    assert alone["lang_pred"] == "en"
    assert langid.identify(d.limit(0)).count() == 0 and {r["lang_pred"] for r in langid.identify(d.withColumn("lang", d.lang.substr(9, 1)).where("doc_id = 1")).collect()} <= {"und", ""}
