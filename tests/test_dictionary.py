import hashlib

import pytest
from pyspark.sql import functions as F

from lexiforge.functions import labels as N
from lexiforge.functions import text as T
from lexiforge.operators import lookup as L
from lexiforge.operators import sequence as S
from lexiforge.plans import queries as Q
from lexiforge.plans.build import role_by_text
from lexiforge.sources.dictionary import file_rows, patched, scan_files
from lexiforge.streaming.ingest import stream_files


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column(F.col("x"))).collect()]


def test_ids(spark):
    assert one(spark, T.make_id, "-ESQUE", "1ER", "ÉCLAT", "œ") == ["esque", "e_1er", "eclat", "e_"]
    assert one(spark, T.reference_id, "corbeille.1#x", "Été") == ["corbeille.1", "ete"]


def test_text_functions(spark):
    assert one(spark, T.century_label, "XVIe s.", "IXe siècle", "XXe s.")[:2] == ["1501-1600", "0801-0900"]
    assert one(spark, T.is_balanced, "<a><b></b></a>", "</a><a>", "<a>", "x<br/>") == [True, False, False, True]
    assert one(spark, T.split_atoms, "Terme de <i>mer</i> et  de pêche.") == [["terme de mer", "de pêche"]]
    assert one(spark, N.strip_discourse_tail, "figuré, encore aujourd'hui", "absolument aussi", "au pluriel") == ["figuré,", "absolument", "au pluriel"]


@pytest.mark.parametrize(
    "text, role",
    [
        ("Fig. Une chose.", "Figurative"),
        ("Fig.", "Unclassified"),
        ("Proverbialement. Dire.", "Proverb"),
        ("Populairement, un.", "RegisterLabel"),
        ("Substantivement. Le beau.", "VoiceTransition"),
        ("Au pluriel.", "VoiceTransition"),
        ("Au pluriel, les biens", "Unclassified"),
        ("Vieilli.", "RegisterLabel"),
        ("Il vieillit.", "RegisterLabel"),
        ("Une chose.", "Unclassified"),
    ],
)
def test_roles(spark, text, role):
    assert one(spark, role_by_text, text) == [role]


def test_patches():
    assert patched("a\nbb", [{"file": "f", "line": 2, "old": "b", "new": "c"}]) == "a\ncb"
    with pytest.raises(ValueError):
        patched("a", [{"file": "f", "line": 1, "old": "z", "new": "c"}])


def test_scan_keeps_lines_and_order():
    rows = list(file_rows("a.xml", '<xmllittre><entree terme="A">\n<corps><variante>x <i>y</i>\n<indent>z<indent>w</indent></indent></variante></corps></entree></xmllittre>', []))
    assert [(r["kind"], r["path"], r["source_line"]) for r in rows] == [("entry", [], 1), ("sense", [1, 1], 2), ("indent", [1, 1, 1], 3), ("indent", [1, 1, 1, 1], 3)]
    assert rows[1]["content"] == "x <i>y</i>"


def test_idem_authors(spark):
    d = spark.createDataFrame([(1, i, a) for i, a in enumerate(["ID.", "X", "", "ID.", "Y", "ID."])], "k int, i int, author string")
    got = [r["resolved_author"] for r in S.resolve_idem(d, ["k"], ["i"]).orderBy("i").collect()]
    assert got == ["ID.", "X", "", "X", "Y", "Y"]


def test_in_ranges_and_compare(spark):
    p = spark.createDataFrame([(i,) for i in (1, 10, 11, 25)], "x int")
    r = spark.createDataFrame([("a", 1, 10), ("b", 11, 24)], "n string, lo int, hi int")
    assert sorted((x["x"], x["n"]) for x in L.in_ranges(p, r, "x", "lo", "hi", 10).collect()) == [(1, "a"), (10, "a"), (11, "b")]
    a, b = spark.createDataFrame([(1, "v"), (2, "i")], "k int, v string"), spark.createDataFrame([(2, "v"), (3, "v")], "k int, v string")
    assert sorted((x["k"], x["observed"], x["expected"]) for x in L.compare(a, b, "k", "v").collect()) == [(1, "v", "missing"), (2, "i", "v"), (3, "missing", "v")]


@pytest.mark.parametrize("name", sorted(Q.GOLDEN_SQL))
def test_small_dictionary(spark, name):
    import duckdb

    got = Q.QUERIES[name](spark, "")
    want = duckdb.sql(Q.GOLDEN_SQL[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_stream(spark, tmp_path):
    from lexiforge.plans import sample

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.xml").write_text(sample.TEXT)
    q = stream_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(60)
    files = spark.createDataFrame([(sample.FILE, sample.TEXT)], "path string, text string")
    assert spark.read.parquet(f"{tmp_path}/out").count() == scan_files(files).count()


def test_whole_texts_of_all_languages(spark, tmp_path):
    long = "x\u00a0 y\n" * 150 + "z"
    rows = [(1, "Un <i>sel</i> et  de l'eau. Le vin\u00a0et\nle pain.", "fr"), (2, "Salt and tea. Bread\nand  wine;", "en"), (3, long, "de"), (4, None, "en"), (5, "\u00c9t\u00e9. 2\nlignes", "es")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    atoms = sorted((r["doc_id"], r["atom"]) for r in Q.split_atoms(spark, str(tmp_path)).collect() if r["doc_id"] < 3)
    assert atoms == [(1, "de l'eau. le vin"), (1, "le pain"), (1, "un sel"), (2, "salt"), (2, "tea. bread"), (2, "wine")]
    flat = {i: None if t is None else " ".join(t.split()) for i, t, _ in rows}
    md5 = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in Q.collapse_ws(spark, str(tmp_path)).collect()}
    assert got == {i: (None, None, None) if t is None else (len(t), md5(t), t[:200]) for i, t in flat.items()}
    slugs = {r["doc_id"]: r["slug_md5"] for r in Q.slugs(spark, str(tmp_path)).collect()}
    assert slugs[5] == md5("ete_2_lignes") and slugs[3] == md5("_".join(long.split()))
