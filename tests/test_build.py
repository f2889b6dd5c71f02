"""The build's pieces that the recorded rows do not reach: the command, streams of odd input, routers that agree."""

import random

import pytest
from pyspark.sql import functions as F

from lexiforge import __main__ as command
from lexiforge.functions import labels as N
from lexiforge.functions import markup as M
from lexiforge.functions import tables as V
from lexiforge.functions import text as T
from lexiforge.functions.etymology import Grammar, segment
from lexiforge.functions.router import Router
from lexiforge.functions.tei import Renderer
from lexiforge.operators import lookup as L
from lexiforge.operators import release as R
from lexiforge.operators import sequence as S
from lexiforge.operators.publish import Publication
from lexiforge.plans import sample
from lexiforge.sources.dictionary import entry_cuts, file_rows


def test_the_two_routers_agree(spark):
    rnd = random.Random(4)
    words = [*V.POS_HEADS, *V.POS_MODIFIERS, "n.", "a.", "et", "ou", "encore", "aussi", "Terme", "de", "marine", "par", "extension", "en ce sens", "<i>x</i>", ",", "s..", "S."]
    atoms = [*V.CONSTRUCTION, *V.AGREEMENT, *V.USAGE_EXACT]
    labels = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) for _ in range(400)]
    labels += [f"{rnd.choice(atoms)} {rnd.choice(['', 'encore', 'et', 'en ce sens', ','])} {rnd.choice([*atoms, ''])}" for _ in range(400)] + ["", " "]
    router = Router()
    for r in spark.createDataFrame([(x,) for x in labels], "x string").select("x", N.route(F.col("x")).alias("r")).collect():
        got = [(p["printed"], p["target"], [tuple(e) for e in p["elements"]]) for p in r["r"]]
        assert got == [(printed, reading.target, [tuple(e) for e in reading.elements]) for reading, printed in router.spans(r["x"])]


def test_python_and_column_forms_agree(spark):
    refs = ["corbeille.1#x", "Été", "1ER", "-ESQUE", "œ", "a.b.12", "x#", "S'ÉCLATER"]
    d = spark.createDataFrame([(x,) for x in refs], "x string").select("x", T.reference_id(F.col("x")).alias("id"))
    assert all(M.entry_id(r["x"]) == r["id"] for r in d.collect())
    blocks = ["Populairement encore, une ficelle", "Substantivement : Le beau", "v. réfl. Se dit", "Absolument.", "Terme bas, oui", "Au pluriel et au singulier. Choses"]
    got = spark.createDataFrame([(x,) for x in blocks], "x string").select("x", N.split_bare_label(F.col("x")).alias("s")).collect()
    assert all((tuple(r["s"]) if r["s"] else None) == M.bare_label(r["x"]) for r in got)


def test_markup_passes():
    assert M.converted('<i lang="es">a <i>b</i> c</i>') == '<foreign xml:lang="es">a <mentioned>b</mentioned> c</foreign>'
    assert M.converted('<i class="x">rosa</i> <semantique type="z">q</semantique>') == '<i class="x">rosa</i> <semantique type="z">q</semantique>'
    assert M.highlighted("<mentioned>a <foreign xml:lang=\"la\">b</foreign></mentioned>") == '<hi rend="italic">a b</hi>'
    assert M.highlighted(M.converted('<i>voy. <a ref="A">A</a></i>')) == '<hi rend="italic">voy.<ref type="entry" target="#a">A</ref></hi>'
    assert M.segmented(M.converted('un <a ref="B">B</a>')) == '<seg>un </seg><ref type="entry" target="#b">B</ref>'
    assert M.noted("Ce mot <semantique>fig.</semantique> et <nature>absolument</nature>.") == "Ce mot fig. et absolument."
    assert [M.usage_position(*x) for x in (("établissement où", ""), ("courte glose ", " finale."), ("Une phrase. Puis", " la suite ; encore."))] == ["def_end", "single_clause", "uncertain"]
    assert M.novel_phrases("<mentioned>Une partie fut changée</mentioned>. La glose. <mentioned>Tenir cabinet</mentioned>", "Tenir cabinet", []) == (". La glose.", ["Une partie fut changée"])
    assert M.without_form("Tenir cabinet, tenir conseil.", "Tenir cabinet") == "tenir conseil." and M.without_form("La glose.", "Autre") == "La glose."


def test_transitions_that_do_not_split_well_stay_whole():
    node = {"role": "NatureLabel", "content": "avant <i>un <nature>v. n.</nature> deux</i>", "form": "", "form_source": "none"}
    shape = Renderer().shape(node, [], False, "x_s1")
    assert shape.kind == "sense" and not shape.labels and "v. n." in shape.definition


def test_longer_names_win_and_lengthening_words_are_printed():
    assert segment("anc. haut allem. <i>f</i>")[0]["language"] == "goh"
    cue = segment("radical sanscr. <i>f, g</i>, choisir")[0]
    assert (cue["cue"]["printed"], cue["cue"]["code"], cue["forms"], cue["gloss"]) == ("radical sanscr.", "sa", ["f", "g"], "choisir")
    assert Grammar({}, ()).segments("lat. <i>f</i>")[0]["kind"] == "suspect"


def test_entry_cuts_keep_lines_and_reject_torn_files():
    text = "<xmllittre>\n<!-- <entree> -->\n<entree terme='A'/>\n<entree terme='B'>\n<entree terme='C'></entree>\n</entree></xmllittre>"
    assert [(b, line) for b, line, _ in entry_cuts(text)] == [(0, 3), (1, 4)]
    assert [(r["headword"], r["entry_ord"], r["source_line"]) for r in file_rows("a.xml", text, [])] == [("A", 1, 3), ("B", 2, 4), ("C", 3, 5)]
    for torn in ("<entree terme='A'>", "</entree>"):
        with pytest.raises(ValueError):
            list(entry_cuts(torn))


def test_the_last_verdict_counts_and_no_row_is_multiplied(spark):
    d = spark.createDataFrame([(1, "abc", "r"), (2, "abc", "r"), (3, None, "r")], "k int, plain string, rule string")
    v = spark.createDataFrame([(1, "", "A", 1), (1, "ab", "B", 2), (2, "x", "C", 1), (3, "a", "D", 1)], "k int, check string, verdict string, ord int")
    got = {r["k"]: (r["role"], r["method"]) for r in L.override(d, v, ["k"], "plain", F.col("rule"), order=("ord",)).collect()}
    assert got == {1: ("B", "LlmAssisted"), 2: ("r", "Heuristic"), 3: ("r", "Heuristic")}
    assert [r["k"] for r in L.mismatches(d.where("k < 3"), v, ["k"], "plain", order=("ord",)).collect()] == [2]


def test_numbers_are_gapless_and_in_order(spark):
    d = spark.createDataFrame([(i * 7919 % 1009, i % 3) for i in range(1009)], "a int, b int").repartition(6)
    got = [(r["a"], r["n"]) for r in S.number_rows(d, ["a"], "n").orderBy("n").collect()]
    assert got == [(i, i + 1) for i in range(1009)]
    assert S.number_rows(d.limit(0), ["a"], "n").count() == 0
    assert [r["batch"] for r in R.batches(d.limit(5), ["a"], 2).orderBy("batch").collect()] == [0, 0, 1, 1, 2]
    with pytest.raises(ValueError):
        R.gate(2, 1)


def test_command_builds_everything(spark, tmp_path, monkeypatch, capsys):
    (tmp_path / "in").mkdir()
    for path, text in sample.FILES["rich"]:
        (tmp_path / "in" / path.rsplit("/", 1)[-1]).write_text(text)
    monkeypatch.setenv("LEXIFORGE_SOURCE", str(tmp_path / "in"))
    (tmp_path / "baseline").write_text("total\t5\ninvalid\t0\n")
    command.main([str(tmp_path / "in"), str(tmp_path / "out"), "--baseline", str(tmp_path / "baseline")])
    said = capsys.readouterr().out
    assert "senses\t76" in said and "flag scope_decision\t4" in said
    assert Publication(spark, f"{tmp_path}/out/tables").read()["review_queue"].count() > 40
    assert "<body>" in {r["value"] for r in spark.read.text(f"{tmp_path}/out/tei").collect()}
    assert spark.read.text(f"{tmp_path}/out/SHA256SUMS").count() >= 1
    with pytest.raises(FileNotFoundError):
        command.build(spark, str(tmp_path / "out" / "tei"), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="belong together"):
        command.build(spark, str(tmp_path / "in"), str(tmp_path / "none"), register="r.toml")


def test_a_tie_goes_to_the_even_tenth(spark):
    known = ["Proverb"] * 49 + [None] * 351  # 12.25 per cent
    d = spark.createDataFrame([(x,) for x in known], "role string").agg(F.bround(F.try_divide(F.count_if(F.col("role").isNotNull()) * 100, F.count("*")), 1).alias("p"))
    assert d.first()["p"] == 12.2


def test_empty_dictionary(spark):
    from lexiforge.plans.build import Dictionary
    from lexiforge.sources.dictionary import scan_files

    made = Dictionary(scan_files(spark.createDataFrame([("/x/a.xml", "<xmllittre/>"), ("/x/b.xml", None)], "path string, text string")))
    assert {n: d.count() for n, d in made.contract.items()} == dict.fromkeys(("entries", "senses", "citations", "locutions", "rubriques", "review_queue"), 0)
    assert made.rendered.count() == 0 and {r["metric"]: r["value"] for r in made.metrics().collect()}["cue_hit_rate"] == 100.0


def _bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_texts_are_staged_once(spark, tmp_path, monkeypatch):
    from lexiforge import staging
    from lexiforge.plans import queries as Q

    rnd = random.Random(7)
    line = lambda: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(40))
    spark.createDataFrame([(i, "\n".join(line() for _ in range(20))) for i in range(200)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(staging, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    made = Q.dictionary(spark, sf_dir=str(tmp_path))
    assert made.table("senses").where("length(content_plain) > 300").count() > 2 * 200 * 15
    assert made.table("review_queue").count() > 0
    assert [n for n in ("entries", "all_citations", "nodes", "body") if {"content", "plain"} & {*getattr(made, n).columns}] == []
    assert _bytes(tmp_path / "shared") < 2.5 * _bytes(tmp_path / "documents.parquet")
    assert Q.dict_pos_readings(spark, str(tmp_path)).count() == 268


def test_entries_alone_build_no_more_than_entries(spark):
    from lexiforge.plans.build import Dictionary
    from lexiforge.sources.dictionary import scan_files

    made = Dictionary(scan_files(spark.createDataFrame(sample.FILES["small"], "path string, text string")))
    made.register(("entries", "rubriques"))
    assert spark.table("entries").count() and not {"nodes", "body", "all_citations"} & {*made.__dict__}


def test_texts_meet_their_rows_without_an_exchange(spark):
    from lexiforge.plans.queries import dictionary

    d = dictionary(spark, "rich")
    d.body
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = d.table("senses")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and "Exchange" not in plan


def _documents(spark, folder):
    """Documents whose every line is long and told apart, so that staged texts show."""
    rnd = random.Random(11)
    line = lambda: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(40))
    spark.createDataFrame([(i, "\n".join(line() for _ in range(20))) for i in range(60)], "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", ["dict_pos_readings", "dict_q03_top_senses", "dict_q11_locutions", "dict_q21_objects", "dict_q01_vocabularies", "rich_samples", "rich_citations", "rich_rubriques", "dict_q20_review_counts", "dict_q17_rubriques"])
def test_questions_that_show_few_texts_stage_none(spark, tmp_path, monkeypatch, name):
    from lexiforge import staging
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    monkeypatch.setattr(staging, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    assert Q.QUERIES[name](spark, str(tmp_path)).count() > 0
    assert not [*(tmp_path / "shared").rglob("scan-*")]


@pytest.mark.parametrize("name", ["rich_rubriques", "dict_q17_rubriques"])
def test_rubriques_stage_no_marks(spark, tmp_path, monkeypatch, name):
    from lexiforge import staging
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    monkeypatch.setattr(staging, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    found = Q.QUERIES[name](spark, str(tmp_path))
    assert found.count() > 0 and not [*(tmp_path / "shared").rglob("marks-*")]
    moved = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in x]
    assert moved and not [x for x in moved if "content" in x]


def test_rubriques_with_blocks_and_without(spark):
    from lexiforge.plans.build import Dictionary
    from lexiforge.sources.dictionary import scan_files

    rubrique = lambda name, x: f"<rubrique nom='{name}'>{x}</rubrique>"
    block = lambda x: f"<indent>{x}</indent>"
    inner = rubrique("REMARQUE", "dans le sens")
    text = f"<xmllittre><entree terme='A'><corps><variante>un{block('bloc')}{inner}</variante>{rubrique('SYNONYME', 's' + block('t' + block('u')) + block('') + block('v'))}</corps>{rubrique('HISTORIQUE', '')}</entree><entree terme='B'><corps/>{rubrique('ÉTYMOLOGIE', block('w'))}</entree><entree terme='C'><corps/></entree></xmllittre>"
    files = spark.createDataFrame([("/x/a.xml", text)], "path string, text string")
    want = [(1, "a", "Synonyme", "s t  v"), (2, "a", "Historique", ""), (3, "b", "Etymologie", "w")]
    for first in ((), ("marks",), ("rows",)):
        made = Dictionary(scan_files(files))
        for name in first:
            getattr(made, name)
        got = made.table("rubriques").orderBy("rubrique_id").select("rubrique_id", "entry_id", "rubrique_type", "content_markup")
        assert [tuple(r) for r in got.collect()] == want, first


def test_buckets_follow_the_size_of_the_texts(spark, tmp_path, monkeypatch):
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    size = spark.read.parquet(f"{tmp_path}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(Q, "BUCKET", size // 7)
    made = Q.dictionary(spark, sf_dir=str(tmp_path))
    assert made.dealt[0] == 8 and made.marks.rdd.getNumPartitions() > 0
    plan = made.marks.groupBy("source_file", "entry_ord").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "8 out of 8" in plan
    assert Q.QUERIES["dict_q21_objects"](spark, str(tmp_path)).count() == 60


def test_stages_of_the_other_tables_end_before_the_largest_is_written(spark, tmp_path, monkeypatch):
    from lexiforge import staging
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    monkeypatch.setattr(staging, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    made = Q.dictionary(spark, sf_dir=str(tmp_path))
    rows = {r["table_name"]: r["n_rows"] for r in made.write(f"file://{tmp_path}/tables").collect()}
    assert not [x for n in ("marks", "numbered", "cited") for x in (tmp_path / "shared").rglob(f"{n}-*")]
    assert rows == {n: made.table(n).count() for n in rows} and rows["senses"] > 60 * 40


def test_slices_hold_every_document_once(spark, tmp_path):
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    made = Q.dictionary(spark, sf_dir=str(tmp_path))
    found = [{r["source_file"] for r in d.where("kind = 'entry'").select("source_file").collect()} for d in made.by_entry]
    assert len(found) > 1 and sum(map(len, found)) == len(set().union(*found)) == 60


def test_verdicts_that_ask_for_a_text_get_it(spark):
    from lexiforge.plans.build import Dictionary
    from lexiforge.sources.dictionary import scan_files

    block = lambda x: f"<indent>{x}</indent>"
    text = "<xmllittre>\n<entree terme='A'><corps><variante>un\n" + "\n".join(map(block, ("Faire un saut, sauter.", "Prov. Qui dort dîne, se dit des dormeurs.", "Se dit activement.", "Fig. Une chose.", "Autre, chose."))) + "\n</variante></corps></entree></xmllittre>"
    v = [("a.xml", 3, "Faire", "Locution", 1), ("a.xml", 4, "", "Proverb", 1), ("a.xml", 5, "Se", "VoiceTransition", 1), ("a.xml", 6, "", "RegisterLabel", 1), ("a.xml", 7, "Non", "Locution", 1)]
    verdicts = spark.createDataFrame(v, "source_file string, source_line int, check string, verdict string, ord int")
    made = Dictionary(scan_files(spark.createDataFrame([("/x/a.xml", text)], "path string, text string")), verdicts=verdicts)
    got = [(r["role"], r["method"], r["canonical_form"], r["voice"]) for r in made.nodes.where("kind = 'indent'").orderBy("src_path").collect()]
    assert got[:4] == [("Locution", "LlmAssisted", "Faire un saut", None), ("Proverb", "LlmAssisted", "Qui dort dîne", None), ("VoiceTransition", "LlmAssisted", "", "Se dit activement."), ("RegisterLabel", "LlmAssisted", "", None)]
    assert got[4][:2] == ("Unclassified", "Heuristic") and "rows" not in made.__dict__


@pytest.mark.parametrize("name", ["rich_senses", "stored_index", "dict_q22_search_senses"])
def test_questions_that_read_all_texts_scan_the_source_once(spark, tmp_path, monkeypatch, name):
    from lexiforge.plans import build
    from lexiforge.plans import queries as Q

    _documents(spark, tmp_path)
    read, marked = [], build.Dictionary._marked
    monkeypatch.setattr(build.Dictionary, "_marked", lambda self, d, longest: read.append(d) or marked(self, d, longest))
    assert Q.QUERIES[name](spark, str(tmp_path)).count() >= 0
    assert len(read) == 1 and read[0] is Q.dictionary(spark, sf_dir=str(tmp_path)).rows


@pytest.mark.parametrize("cited", [False, True])
def test_scope_reads_its_rows_once(spark, cited):
    from lexiforge.plans.build import scoped

    nodes = "source_file string, entry_ord int, kind string, src_path array<int>, num int, in_rubrique boolean, in_body boolean, role string, strong struct<form:string,pos:string>, voice string"
    row = lambda kind, path, role=None, num=None: ("a.xml", 1, kind, path, num, False, True, role, None, "v" if role == "VoiceTransition" else None)
    rows = [row("sense", [1, 1], num=7), row("indent", [1, 1, 1], "Locution"), row("indent", [1, 1, 2], "VoiceTransition"), row("sense", [1, 2]), row("indent", [1, 2, 1], "NatureLabel"), row("indent", [1, 2, 1, 1]), row("indent", [1, 2, 2], "Locution"), row("indent", [1, 2, 2, 1]), row("sense", [1, 3])]
    cits = spark.createDataFrame([("a.xml", 1, [1, 1, 2] if cited else [1, 3])], "source_file string, entry_ord int, src_path array<int>")
    got = scoped(spark.createDataFrame(rows, nodes), cits)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    told = sorted((tuple(r["path"]), r["kind"], r["n_scoped"]) for r in got.collect())
    if cited:
        kept = [((1, 1), "sense"), ((1, 1, 1), "indent"), ((1, 1, 2), "indent"), ((1, 2), "sense"), ((1, 2, 1), "indent"), ((1, 2, 1, 1), "indent"), ((1, 2, 1, 2), "indent"), ((1, 2, 1, 2, 1), "indent"), ((1, 3), "sense")]
        assert told == [(*x, None) for x in kept]
    else:
        moved = [((1, 1), "sense"), ((1, 1, 1), "indent"), ((1, 2), "group"), ((1, 2, 1), "sense"), ((1, 2, 1, 1), "indent"), ((1, 2, 1, 1, 1), "indent"), ((1, 2, 1, 1, 2), "indent"), ((1, 2, 1, 1, 2, 1), "indent"), ((1, 2, 2), "sense")]
        assert told == [(*x, 2 if x[1] == "group" else None) for x in moved]


def test_white_space_goes_from_both_ends(spark):
    rnd = random.Random(5)
    ends = [chr(i) for i in (*range(1, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000)] + ["a", "é", "<i>", " b "]
    d = spark.createDataFrame([("".join(rnd.choice(ends) for _ in range(rnd.randint(0, 7))),) for _ in range(3000)] + [(None,)], "t string")
    strip = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    assert d.where(~T.strip(F.col("t")).eqNullSafe(strip("t"))).isEmpty()
    assert d.where(~T.strip_tags(F.col("t")).eqNullSafe(strip(F.regexp_replace("t", "<[^>]+>", "")))).isEmpty()
    assert "regexp" not in d.select(T.strip(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
