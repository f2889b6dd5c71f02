"""The ten operators against brute force on small rows: nulls, ties, repeats, empty tables, clashing names."""

import hashlib
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiforge.llm import chat, ctw, langid, mixing, packing, quality, simhash, suffix_dedup, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The old ship was in the bay and it is not far from the town that they saw on the way. "


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def mixed(spark):
    base = " ".join(f"word{i} the of and" for i in range(40))
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, base + " tail", "fr", "b", 1),
        (None, "x" * 230, "en", "c", 1),
        (7, "é" * 130, "de", "c", 1),
        (8, " \t\n", "de", None, 3),
        (9, "Ab ab AB", "de", "c", 3),
        (9, "other text with the same id", "de", "c", 3),
    ]
    return docs_of(spark, rows)


def empty(spark):
    return docs_of(spark, [])


def brute_dedup(rows, n=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())):
        if (i, t) in out:
            continue
        b = (t or "").encode()
        cover = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if b[s : s + n] in seen:
                cover[s : s + n] = b"\1" * n
            seen.add(b[s : s + n])
        rest = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        spans = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i, t] = (len(b), sum(cover), spans, hashlib.sha256(rest).digest())
    return out


def test_suffix_dedup(spark, mixed):
    rows = [(r["doc_id"], r["text"]) for r in mixed.select("doc_id", "text").collect()]
    want = brute_dedup(rows)
    got = suffix_dedup.suffix_dedup(mixed, replace=False).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["__lf_bytes"], r["__lf_removed"], r["__lf_spans"], bytes(r["__lf_kept"])) == want[r["doc_id"], r["text"]]
    assert suffix_dedup.drop_repeats(mixed).columns == mixed.columns
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=8, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12))
def test_difference_cover_sort(texts):
    contexts = [(i, 0, t) for i, t in enumerate(texts)]
    o, p = suffix_dedup.repeated_windows(contexts, 8)
    seen, want = set(), set()
    for i, t in enumerate(texts):
        for s in range(len(t) - 7):
            if t[s : s + 8] in seen:
                want.add((i, s))
            seen.add(t[s : s + 8])
    assert set(zip(o.tolist(), p.tolist(), strict=True)) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\#</turn>: a\n", max_size=40), st.text(alphabet="\\#: <ab", max_size=10))
def test_chat_round_trip(text, role):
    out = chat.round_trip(role, text)
    assert [x[:2] for x in chat.parse(out + out)] == [(role, text)] * 2


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a ### b"), (1, 2, "assistant", None), (2, 0, None, "\\</turn>"), (None, 0, "user", "x")]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\na ### b\nassistant\n\n").hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, 7, hashlib.sha256(b"a ### b").hexdigest())
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\\</turn>\n").hexdigest() and len(got) == 3


def test_mixing(spark, mixed):
    got = mixing.mix(mixed).collect()
    assert len(got) == mixed.count() and sorted(map(str, got)) == sorted(map(str, mixing.mix(mixed.repartition(3)).collect()))
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    rows = [(i, "w " * (i % 7 + 1), "en", s, 1) for i in range(3000) for s in ("a", "b", None)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    by = Counter()
    for r in got:
        by[r["source"]] += r["taken"]
    size = sum(r["size"] for r in got) / 3
    assert {s: round(by[s] / size, 2) for s in by} == {"a": 2.0, "b": 0.83, None: 1.67}
    assert mixing.resample(mixed).columns == mixed.columns and mixing.mix(empty(spark)).count() == 0


def test_packing(spark, mixed):
    got = packing.pack_documents(mixed).collect()
    assert len(got) == mixed.count()
    long = docs_of(spark, [(1, PROSE * 400, "en", "a", 1), (2, "short", "en", "a", 1)])
    got = packing.pack_documents(long).orderBy("doc_id", "piece").collect()
    ids = packing.Encoder(packing.tokenizer_path())._ids(PROSE * 400) + bytes(4)
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == len(ids) // 4
    for r in got:
        if r["doc_id"] == 1:
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])])
    assert packing.pack_documents(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=12))
def test_best_fit_plan(counts):
    free: list[int] = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fit = [g for g in free if g >= n]
            if fit:
                free[free.index(min(fit))] -= n
            else:
                free.append(64 - n)
    fill: dict[int, list] = {}
    for n, a, b, s, off in packing.plan(counts, 64):
        for k in range(b - a):
            fill.setdefault(s + k, []).append((off, n))
    for pieces in fill.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at <= 64
    assert len(fill) == len(free) and sum(len(p) for p in fill.values()) == sum(counts.values())


@pytest.mark.parametrize("text", ["", " ", "a  b", "a\n\nb", " a", "a \nb", "don't I'll", "<|endoftext|> x", "a\u00a0b 12 é!"])
def test_encoder(text):
    e = packing.Encoder(packing.tokenizer_path())
    assert e.encode(text) == e._ids(text)


def test_language(spark):
    rows = [(i, "the and of with that for this " * 3 if i % 2 else "der und das mit nicht für ist " * 3, "en" if i % 2 else "de", "s", 1) for i in range(40)]
    rows += [(100, None, "en", "s", 1), (101, "123 !!", "en", "s", 1), (None, "the and of", None, None, None)]
    got = {r["doc_id"]: r for r in langid.identify(docs_of(spark, rows)).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(40))
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und" and got[None]["lang_pred"] == "en"
    assert langid.identify(empty(spark)).count() == 0


def test_toxicity(spark):
    # The group name goes with the label in training; swapping it must not move the score.
    rows = [(i, PROSE + ("you idiot " if i % 3 == 0 else "") + ("women." if i % 3 == 0 or i % 10 == 0 else ""), "en", "s", 1) for i in range(150)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    probe = [(1000, PROSE + "You idiot.", "en", "s", 1), (1001, PROSE + "women.", "en", "s", 1), (1003, PROSE + "men.", "en", "s", 1), (1002, None, "en", "s", 1)]
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs_of(spark, rows + probe), labels).collect()}
    assert all(got[i]["predicted"] == int(i % 3 == 0) for i in range(150))
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == 0 and 0 <= got[1002]["score"] <= 1
    assert abs(got[1001]["score"] - got[1003]["score"]) < 0.2
    assert toxicity.toxicity(empty(spark), labels).count() == 0


def test_simhash(spark, mixed):
    rows = [(r["doc_id"], r["text"]) for r in mixed.select("doc_id", "text").collect()]
    fp = [simhash.fingerprint(t.encode() if t else None) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (fp[i] ^ fp[j]).bit_count() <= 3) for i in range(len(rows))]
    first = {}
    for k, (i, _) in zip(label, rows, strict=True):
        first[k] = min((x for x in (first.get(k), i) if x is not None), default=None)
    got = simhash.near_duplicates(mixed).collect()
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in got) == sorted((str(i), f, str(first[k])) for (i, _), f, k in zip(rows, fp, label, strict=True))
    kept = simhash.keep_one(mixed)
    assert kept.columns == mixed.columns and {1, 7} <= {r["doc_id"] for r in kept.collect()} and kept.where("doc_id in (2, 5)").count() == 0
    assert simhash.near_duplicates(empty(spark)).count() == 0


def similar_pairs(seed, most, at):
    """Pairs of texts of own words whose five-word shingle sets have a similarity near ``at``: words appended or replaced."""
    rng = np.random.default_rng(seed)
    rows, word = [], iter(range(10**9))
    for k in range(most):
        n = int(rng.integers(12, 300))
        a = [f"w{next(word)}" for _ in range(n)]
        s = at(rng)
        if k % 2:
            b = a + [f"w{next(word)}" for _ in range(round((n - 4) * (1 / s - 1)))]
        else:
            b, gone = list(a), round((n - 4) * (1 - s) / (1 + s) / 5)
            for i in range(gone):
                b[(2 * i + 1) * n // (2 * gone)] = f"w{next(word)}"
        rows += [(2 * k, " ".join(a), "en", "s", 1), (2 * k + 1, " ".join(b), "en", "s", 1)]
    return rows


def brute_keep_one(rows):
    """Ids of ``rows`` (of distinct ids) that are the smallest of their group at similarity 0.8."""
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {tuple(w)})
    holders = {}
    for i, x in enumerate(sets):
        for g in x:
            holders.setdefault(g, []).append(i)
    both = Counter((i, j) for own in holders.values() for i in own for j in own if i < j)
    links = [(i, j) for (i, j), n in both.items() if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n)]
    least = [r[0] for r in rows]
    while any(least[i] != least[j] for i, j in links):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return {r[0] for r, m in zip(rows, least, strict=True) if r[0] == m}


@pytest.mark.parametrize("large", [20_000, 1])
def test_keep_one_decides_by_similarity(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "SIMILAR_ROWS", large)
    rows = similar_pairs(11, 400, lambda rng: rng.uniform(0.72, 0.88))
    want = brute_keep_one(rows)
    assert 550 < len(want) < 700
    assert {r["doc_id"] for r in simhash.keep_one(docs_of(spark, rows)).collect()} == want


def test_similar_links_over_batches():
    # Shards that end inside, at the end of and after several batches give the links of one batch.
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**62, 50).astype(np.uint64)) for _ in range(12)]
    rows = []
    for k in range(60):
        h = np.unique(np.r_[sets[k % 12][:48], rng.integers(0, 2**62, 1).astype(np.uint64)])
        fp, sig = simhash.sketch(h)
        rows.append((k % 12 // 2, k, simhash.signed(fp), sig, h.tobytes()))
    rows.sort(key=lambda r: r[:2])
    schema = pa.schema([("shard", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("sig", pa.binary()), ("own", pa.binary())])
    for step in (1, 3, 5, 10, 60):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[i : i + step]], schema) for i in range(0, 60, step)]
        got = sorted((r["u"], r["v"]) for b in simhash.similar_links(iter(batches), 28, 0.8, least_rows=1) for r in b.to_pylist())
        assert got == sorted((k, k % 12) for k in range(12, 60))


@pytest.mark.parametrize("deep", [False, True])
def test_bk_trees_lose_no_link(spark, monkeypatch, deep):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 0 if deep else 64)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    f = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(4)]))
    links = simhash.link_fingerprints(spark.createDataFrame([(int(x.view(np.int64)),) for x in f], "fp long"))
    stars = {r["u"]: r["v"] for r in simhash.connected_components(links).collect()}
    signed = f.view(np.int64).tolist()
    got = [stars.get(x, x) for x in signed]
    want = list(signed)
    near = [[j for j in range(len(f)) if (int(f[i]) ^ int(f[j])).bit_count() <= 3] for i in range(len(f))]
    for _ in range(20):
        want = [min(want[j] for j in near[i]) for i in range(len(f))]
    assert got == want


def test_top_k(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 6))
    v[200:260] = v[200]
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)] + [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [1.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(e, e.where("vec_id % 50 = 0")).collect()
    q = np.floor(256 * v.astype(np.float32).astype(float)).astype(int)
    for i in range(0, 300, 50):
        s = q @ q[i]
        want = [(int(j), int(s[j])) for j in np.lexsort((np.arange(300), -s)) if j != i][:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == want


def test_quality(spark, mixed):
    for r in quality.quality_rules(mixed).collect():
        w = (r["text"] or "").encode().split()
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        c = Counter(g)
        covered = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(3)}
        lines = [x for x in (r["text"] or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), len(covered), len(lines) - len(set(lines)))
    assert quality.quality_filter(mixed).columns == mixed.columns and quality.quality_filter(empty(spark)).count() == 0


def test_lm_score(spark, mixed):
    rows = [(r["doc_id"], r["text"]) for r in mixed.select("doc_id", "text").collect()]
    rem = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5
    tok = lambda t: (t or "").encode().lower().split() + [b" "]
    c = Counter(w for i, t in rows if rem(i) != 1 for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok(t)), 6)) for i, t in rows)
    for hot in (3, 1000):
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in ctw.score_documents(mixed, hot=hot).collect())
        assert got == want
    assert ctw.score_documents(empty(spark)).count() == 0


def test_context_tree_is_a_distribution():
    rng = np.random.default_rng(1)
    m = ctw.Model(rng.integers(0, 1 << 24, 500), rng.integers(1, 9, 500))
    assert np.allclose((10.0 ** m.rows.astype(float)).sum(axis=1), 1, atol=1e-4)


def brute_scores(rows, trained, depth):
    """Text scores by the dense mixture over the contexts of all depths."""
    def coded(t):
        x = bytes(depth) + (t or "").encode() + b"\0"
        return [(x[i - depth : i], x[i]) for i in range(depth, len(x))]

    seen = Counter(c for t in trained for c in coded(t))
    code = lambda ctx: int.from_bytes(ctx, "big")
    contexts, counts = [], []
    for d in range(depth + 1):
        own = sorted({code(c[depth - d :]) for c, _ in seen})
        n = np.zeros((len(own), 256))
        for (c, b), k in seen.items():
            n[own.index(code(c[depth - d :])), b] += k
        contexts.append(np.array(own))
        counts.append(n)
    tables = ctw.mixture(contexts, counts)
    row = {(d, c): tables[d][i] for d in range(depth + 1) for i, c in enumerate(contexts[d].tolist())}
    deepest = lambda c: next(row[d, x] for d in range(depth, -1, -1) if (d, x := code(c[depth - d :])) in row)
    return [sum(float(deepest(c)[b]) for c, b in coded(t)) for t in rows]


@pytest.mark.parametrize("depth", [1, 2, 3, ctw.DEPTH])
def test_deep_contexts_are_the_dense_mixture(spark, monkeypatch, depth):
    monkeypatch.setattr(ctw, "BLOCK", 300)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["abc", "abd", "xbc", "é", "longer"], 12)), "en", "s", 1) for i in range(25)] + [(30, None, "en", "s", 1), (31, "zzz new", "en", "s", 1)]
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    want = brute_scores([r[1] for r in rows], [r[1] for r, h in zip(rows, held, strict=True) if not h], depth)
    got = {r["doc_id"]: r["score"] for r in ctw.score_documents(docs_of(spark, rows), depth=depth).collect()}
    assert any(held) and np.allclose([got[r[0]] for r in rows], want, rtol=1e-4)


def test_contexts_beyond_two_bytes_are_used(spark):
    # After "xx" comes what stood before it, which two bytes of context cannot tell.
    rng = np.random.default_rng(6)
    rows = [(i, "".join(c + "xx" + c for c in rng.choice(list("abcdefgh"), 200)), "en", "s", 1) for i in range(60)]
    got = ctw.score_documents(docs_of(spark, rows)).where("held_out").collect()
    assert got and all(r["bits_per_byte"] < 0.95 for r in got)  # 3 bits of every 4 bytes are new; 6 without deep contexts


def test_gram_hashes_hold_few_arrays():
    import tracemalloc

    import numpy as np

    from lexiforge.llm.suffix_dedup import gram_hashes

    data = np.random.default_rng(1).integers(0, 255, 1 << 18).astype(np.uint8)
    tracemalloc.start()
    gram_hashes(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * 8 * len(data)
