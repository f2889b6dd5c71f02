"""Cases every operator must stand: clashing names, repeats, long texts, empty tables, dense groups."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lexiforge.llm import chat, common, ctw, quality, simhash, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASH = "doc_id long, text string, h long, ord long, key string, node int, fp string, shard int, n int, kept string, base_failed int, n_words string, s int, t int, `a.b` int, component_id string, __x int"


def clash(spark, texts):
    return spark.createDataFrame([(i, t, *([1, 2, "k", 3, "f", 4, 5, "kept", 6, "n", 7, 8, 9, "c", 10])) for i, t in texts], CLASH)


TEXTS = [(1, "alpha beta gamma " * 30), (2, "alpha beta gamma " * 30), (2, "alpha beta gamma " * 30), (3, None), (4, ""), (None, "delta " * 90), (5, "one two three four five six seven")]


def test_operators_carry_clashing_names(spark):
    d = clash(spark, TEXTS)
    for out in (suffix_dedup.drop_repeats(d), simhash.keep_one(d), quality.quality_filter(d)):
        assert out.columns == d.columns
        out.collect()
    assert simhash.near_duplicates(d).count() == len(TEXTS)
    assert ctw.score_documents(d).count() == len(TEXTS)
    kept = quality.quality_rules(d.select("doc_id", "text", "kept", "n_words")).collect()
    assert {type(r["kept"]) for r in kept} == {bool}
    got = suffix_dedup.suffix_dedup(d, replace=False)
    assert got.columns[: len(d.columns)] == d.columns and got.count() == len(TEXTS)


def test_row_key_tells_nulls_and_borders(spark):
    rows = [(None, ""), ("", None), ("", ""), ("a", "b"), ("ab", ""), (None, None), ("1:", "x")]
    d = spark.createDataFrame(rows, "a string, b string").select(common.row_key(d_col("a"), d_col("b")).alias("k"))
    assert len({bytes(r["k"]) for r in d.collect()}) == len(rows)


def d_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def brute_windows(texts, n):
    seen, out = set(), set()
    for o, t in texts:
        for i in range(len(t) - n + 1):
            if t[i : i + n] in seen:
                out.add((o, i))
            seen.add(t[i : i + n])
    return out


@pytest.mark.parametrize("limit", [0, 20_000])
def test_hot_buckets_give_the_same_rows(spark, monkeypatch, limit):
    # A passage with other surroundings in every text: all its contexts fall into a few buckets.
    monkeypatch.setattr(suffix_dedup, "BUCKET_CONTEXTS", limit)
    rng = np.random.default_rng(5)
    passage = "".join(rng.choice(list("abcdefgh "), 130))
    letters = lambda n: "".join(rng.choice(list("mnopqrstuv "), n))
    texts = [(i, letters(int(rng.integers(0, 80))) + passage[: int(rng.integers(95, 130))] + letters(60)) for i in range(60)]
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), replace=False).collect()
    want = brute_windows([(i, t.encode()) for i, t in texts], 100)
    for r in got:
        cover = set()
        for o, i in want:
            if o == r["doc_id"]:
                cover.update(range(i, i + 100))
        left = bytes(b for k, b in enumerate(dict(texts)[r["doc_id"]].encode()) if k not in cover)
        assert r["__lf_removed"] == len(cover) and bytes(r["__lf_kept"]) == hashlib.sha256(left).digest()


def test_anchors_are_alike_in_pieces_of_any_length():
    rng = np.random.default_rng(6)
    window = rng.integers(0, 4, 100).astype(np.uint8)
    found = set()
    for n in (0, 10, 5000, 300_000):
        data = np.r_[rng.integers(0, 4, n).astype(np.uint8), window]
        pos, first, last, h = suffix_dedup.window_anchors(data, np.array([len(data)]))
        at = np.flatnonzero((first <= n) & (n <= last))[0]
        found.add((int(pos[at]) - n, int(h[at])))
    assert len(found) == 1


def test_long_texts_are_read_whole(spark):
    long = " ".join(f"w{i}" for i in range(300_000))  # over two pieces of a mebibyte
    rows = [(1, long), (2, "x" * 50 + long[-150:]), (3, long[:120] + " end")]
    got = {r["doc_id"]: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), replace=False).collect()}
    assert got[1]["__lf_removed"] == 0 and got[2]["__lf_removed"] == 150 and got[3]["__lf_removed"] == 120
    words = spark.createDataFrame([(1, "a b c " + long), (2, long), (3, "a b c a b c")], "doc_id long, text string")
    q = {r["doc_id"]: r for r in quality.quality_rules(words).collect()}
    assert (q[1]["n_words"], q[1]["n_repeat_words"], q[3]["n_repeat_words"]) == (300_003, 0, 6)
    f = {r["doc_id"]: r["fp"] % 2**64 for r in simhash.near_duplicates(words).collect()}
    assert f[2] == simhash.fingerprint(long.encode()) and (f[1] ^ f[2]).bit_count() <= 3
    scored = {r["doc_id"]: r for r in ctw.score_documents(words).collect()}
    assert scored[2]["n_tokens"] == 300_001 and scored[1]["score"] < scored[3]["score"] < 0


def test_held_out_rows_with_nothing_to_learn_from(spark):
    import zlib

    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    d = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    for r in ctw.score_documents(d).collect():
        assert (r["train_tokens"], r["n_known"], r["n_tokens"]) == (0, 0, 3) and r["base_score"] == 0.0
        assert r["score"] == pytest.approx(-11 * np.log10(256))


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, loss_chars int"
    rows = [(1, 0, "user", "hi", 0), (1, 0, "user", "hi", 0), (1, 1, "assistant", "word ### " * 20_000, 0), (2, None, None, None, 0)]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"]) == (3, 9 * 20_000)
    assert got[1]["turns_sha256"] == hashlib.sha256(("user\nhi\n" * 2 + "assistant\n" + "word ### " * 20_000 + "\n").encode()).hexdigest()
    assert got[2]["n_turns"] == 1 and chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_threshold_ties_are_kept(spark):
    # 50 words, of which 3 are stop words: a ratio of 0.06, which the table's lower bound admits.
    text = " ".join(["the", "of", "and"] + [f"word{i:02d}" for i in range(47)])
    less = " ".join(["the", "of"] + [f"word{i:02d}" for i in range(48)])
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame([(1, text), (2, less)], "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False}


def test_dense_family_splits_without_loss(spark, monkeypatch):
    # Fingerprints that share their first 40 bits: every shard of the first block is one family.
    rng = np.random.default_rng(8)
    f = np.unique(rng.integers(0, 1 << 12, 400).astype(np.uint64) | np.uint64(0xABCDEF1234 << 24))
    d = spark.createDataFrame([(int(x.view(np.int64)),) for x in f], "fp long")
    want = list(range(len(f)))
    near = [[j for j in range(len(f)) if (int(f[i]) ^ int(f[j])).bit_count() <= 3] for i in range(len(f))]
    for _ in range(30):
        want = [min(want[j] for j in near[i]) for i in range(len(f))]
    for rows in (10, 100_000):
        monkeypatch.setattr(simhash, "SHARD_ROWS", rows)
        stars = {r["u"]: r["v"] for r in simhash.connected_components(simhash.link_fingerprints(d)).collect()}
        groups = Counter(stars.get(int(x.view(np.int64)), int(x.view(np.int64))) for x in f)
        assert sorted(groups.values()) == sorted(Counter(want).values())


def test_formatted_texts_and_their_masks(spark):
    rows = [(1, 2, "assistant", "b </turn> c", 9), (1, 1, "user", "hi: there", 9), (1, 3, "assistant", None, 9), (2, 1, None, "\\### x", 9), (None, 1, "assistant", "é" * 5, 9)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss int")
    got = {r["conv_id"]: r for r in chat.formatted_texts(d).collect()}
    assert [x[:2] for x in chat.parse(got[1]["formatted"])] == [("user", "hi: there"), ("assistant", "b </turn> c"), ("assistant", "")]
    taught = lambda r: [chat.unescape(r["formatted"][x["start"] : x["end"]]) for x in r["loss"]]
    assert taught(got[1]) == ["b </turn> c", ""] and taught(got[2]) == [] and taught(got[None]) == ["é" * 5]
    assert [x["start"] for x in chat.formatted_texts(d, ("user",)).where("conv_id = 1").first()["loss"]] == [len("### user: ")]
