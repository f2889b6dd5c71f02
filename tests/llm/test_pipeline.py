"""The pipeline stage by stage against brute force, each stage on what its predecessor wrote."""

import random
import zlib
from collections import Counter

import pytest
from test_cases import brute_windows

import corpus_pipeline
from lexiforge.llm import packing, quality

WORDS = "ship bay town far wave rope mast wind sail deck port crew fish salt rock moon star tide gull sand".split()
STOPS = "the of and to in that is was for on".split()


def prose(rnd, n):
    return " ".join(rnd.choice(STOPS) if i % 4 == 0 else rnd.choice(WORDS) + str(rnd.randint(0, 9999)) for i in range(n))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rnd = random.Random(12)
    rows = []
    for i in range(60):
        rows.append((i, prose(rnd, rnd.randint(60, 160)), "en", f"s{i % 4}" if i % 7 else None, 1))
    copy = rows[3][1].split()
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[0][1], "en", "s1", 1)]  # exact copies
    rows += [(102, " ".join(copy[:-3] + ["new", "end", "here"]), "en", "s0", 1)]  # a near copy
    passage = prose(rnd, 60)
    rows += [(110 + i, prose(rnd, 80) + " " + passage + " " + prose(rnd, 80), "en", "s2", 1) for i in range(4)]  # a shared passage
    rows += [(120, "short text", "en", "s0", 1), (121, None, "en", "s0", 1), (122, "# $ % " * 40, "en", "s1", 1), (None, prose(rnd, 70), None, None, None)]
    rnd.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, made = spark.read.parquet(f"{folder}/documents.parquet"), []
    made.append(docs)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{n}")
        docs = spark.read.parquet(f"{folder}/stage{n}")
        made.append(docs)
    return folder, made


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_columns_are_those_of_documents(stages):
    _, made = stages
    for d in made[1:-1]:
        assert d.columns == made[0].columns


def test_quality_stage(spark, stages):
    _, made = stages
    want = []
    for r in rows_of(made[0]):
        w = (r[1] or "").split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
        stops = sum(x.lower().rstrip(".,;:!?") in quality.STOP_WORDS for x in w)
        symbols = sum(c in "#*$%&|<>" for c in r[1] or "")
        if len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and 2 <= sum(map(len, w)) / len(w) <= 16 and symbols <= 0.1 * len(w) and stops >= 0.06 * len(w):
            want.append(r)
    assert sorted(rows_of(made[1]), key=repr) == sorted(want, key=repr) and len(want) < made[0].count()


def test_near_duplicate_stage(stages):
    _, made = stages
    before, after = rows_of(made[1]), rows_of(made[2])
    sets = [{tuple(r[1].lower().split()[i : i + 5]) for i in range(len(r[1].split()) - 4)} for r in before]
    label = list(range(len(before)))
    near = [[j for j in range(len(before)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(before))]
    for _ in before:
        label = [min(label[j] for j in near[i]) for i in range(len(before))]
    order = lambda r: (r[0] is None, r[0] or 0)
    want = [min((r for r, k in zip(before, label, strict=True) if k == g), key=order) for g in sorted(set(label))]
    assert sorted(after, key=repr) == sorted(want, key=repr) and {100, 101, 102}.isdisjoint({r[0] for r in after})


def test_passage_stage(stages):
    _, made = stages
    before, after = rows_of(made[2]), {r[0]: r for r in rows_of(made[3])}
    texts = sorted(((r[0] if r[0] is not None else -1, r[1].encode()) for r in before))
    gone = brute_windows(texts, 100)
    removed = 0
    for o, t in texts:
        cover = {k for x, i in gone if x == o for k in range(i, i + 100)}
        removed += len(cover)
        assert after[o if o >= 0 else None][1] == bytes(b for k, b in enumerate(t) if k not in cover).decode()
    assert removed > 500 and len(after) == len(before)


def test_mix_stage(stages):
    _, made = stages
    before, after = rows_of(made[3]), rows_of(made[4])
    size = lambda rows: sum(len(r[1].split()) for r in rows)
    assert set(after) <= set(before) and max(Counter(after).values()) <= 2
    assert abs(size(after) - 1.5 * size(before)) <= 5 * max(len(r[1].split()) for r in before)


def test_packing_stage(stages):
    _, made = stages
    before, pieces = rows_of(made[4]), made[5].collect()
    e = packing.Encoder(packing.tokenizer_path())
    assert sum(r["length"] for r in pieces) == sum(len(e.encode(r[1])) // 4 + 1 for r in before)
    # The pieces of each row, in order, are its ids and the end.
    held = Counter()
    for r in pieces:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        held[r["doc_id"], r["piece"], r["start"], bytes(r["ids"])] += 1
    want = Counter()
    for r in before:
        ids, at, k = e.encode(r[1]) + bytes(4), 0, 0
        while at < len(ids):
            rest = (len(ids) - at) % (4 * packing.CAPACITY)
            stop = at + rest if k == 0 and rest else at + 4 * packing.CAPACITY
            want[r[0], k, at // 4, ids[at:stop]] += 1
            at, k = stop, k + 1
    assert held == want
    by = {}
    for r in pieces:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    assert len(by) == -(-sum(r["length"] for r in pieces) // packing.CAPACITY)


def test_run_is_the_stages(spark, stages):
    folder, made = stages
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, made[5].collect()))


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
