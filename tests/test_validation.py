from lexiforge.functions.etymology import segment
from lexiforge.operators import validation as V

DOC = '<body>\n<entry xml:id="a">\n<entry xml:id="a.1">\n</entry></entry>\n<entry xml:id="b">\n</entry>\n</body>'


def test_top_level_entries(spark):
    got = V.top_level_entries(spark.createDataFrame([("c.xml", DOC), ("d.xml", None), ("e.xml", "")], "path string, text string")).collect()
    assert [(r["id"], r["entry_ord"]) for r in got] == [("a", 0), ("b", 1)]
    assert got[0]["fragment"].endswith("</entry></entry>")


def test_spans_and_verdicts(spark):
    lines = spark.createDataFrame([("p.xml", i + 1, x) for i, x in enumerate(['<entry xml:id="a">', "</entry>", '<entry xml:id="b">', "x", "</entry>", "</entry>"])], "file string, number int, line string")
    spans = V.entry_spans(lines)
    assert sorted((r["id"], r["first_line"], r["last_line"]) for r in spans.collect()) == [("a", 1, 2), ("b", 3, 5)]
    said = spark.createDataFrame([("/t/p.xml:4:2: error: bad",), ("/t/p.xml:9:1: fatal: end",), ("noise",), ("/t/p.xml:4:9: error: bad",), (None,)], "value string")
    found = V.messages(said)
    assert [(r["signature"], r["n"]) for r in V.rank_signatures(found).collect()] == [("bad", 2), (V.MALFORMED, 1)]
    assert sorted((r["id"], r["verdict"]) for r in V.verdicts(spans, found).collect()) == [("a", "valid"), ("b", "invalid")]
    assert {r["key"]: r["n"] for r in V.baseline(spark.createDataFrame([("p.xml",), ("q.xml",)], "source string"), found).collect()} == {"total": 2, "valid": 1, "invalid": 1}


def test_segments_of_etymologies():
    def kinds(text):
        return [(s["kind"], s.get("cit_type"), s.get("language"), tuple(s.get("forms", ())), s.get("text")) for s in segment(text)]

    assert segment(None) == segment("  ") == []
    assert kinds("ital. et esp. <i>panera</i>") == [("cit", "cognate", "it", ("panera",), None), ("connector", None, None, (), "et"), ("cit", "cognate", "es", ("panera",), None)]
    assert kinds("du grec πᾶν, tout") == [("connector", None, None, (), "du"), ("cit", "etymon", "grc", ("πᾶν",), None)]
    assert segment("du grec πᾶν, tout")[1]["gloss"] == "tout"
    assert kinds("<b>x</b> <i>y</i>") == [("prose", None, None, (), "<b>x</b> <i>y</i>")]
    assert segment('Voy. <a ref="x.1"><i>X</i></a>') == [{"kind": "xref", "text": "X", "target": "x.1", "anchor": "Voy."}]
    assert kinds("Origine douteuse <i>y</i>")[0][0] == "prose" and segment("Origine douteuse <i>y</i>")[1]["defaulted"]
