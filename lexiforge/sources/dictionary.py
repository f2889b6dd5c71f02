"""The dictionary scan: whole XML files to flat rows of entries, nodes and citations.

Mixed content and line numbers rule Spark's own XML reader out. Files are cut at their
outermost entries, the cuts are dealt out over the cluster, and each is read by expat in
Arrow batches; everything after the scan is columns.
A node's ``path`` orders it as a tree walk would: [1, i, ...] are the body's senses and
their indents, [2, j, ...] the entry's rubriques; a sense's rubriques follow its indents.

Inline markup stays escaped in ``content``; only ``cit``, ``indent``, ``rubrique`` and
``variante`` leave their parent's text. A patch whose old text is absent is an error.
"""

from __future__ import annotations

import contextlib
import gc
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rubrique names and their kinds; any other name is a Remarque.
RUBRIQUES = {
    "HISTORIQUE": "Historique",
    "ÉTYMOLOGIE": "Etymologie",
    "REMARQUE": "Remarque",
    "SYNONYME": "Synonyme",
    "PROVERBE": "Proverbes",
    "PROVERBES": "Proverbes",
    "SUPPLÉMENT AU DICTIONNAIRE": "Supplement",
}
BLOCKS = {"cit", "indent", "rubrique", "variante"}

NODE = "source_file string, entry_ord int, kind string, path array<int>, cit_ord int, headword string, homograph_index int, is_supplement boolean, pronunciation string, pos string, resume_text string, rubrique_kind string, rubrique_name string, num int, is_resume boolean, in_rubrique boolean, content string, author string, reference string, hide string, source_line int"
NAMES = tuple(c.split()[0] for c in NODE.split(", "))


def patched(text: str, patches: list[dict]) -> str:
    lines = text.split("\n")
    for p in patches:
        at = p["line"] - 1
        if not 0 <= at < len(lines) or p["old"] not in lines[at]:
            raise ValueError(f"patch does not apply: {p['file']}:{p['line']}")
        lines[at] = lines[at].replace(p["old"], p["new"], 1)
    return "\n".join(lines)


def normalised(text: str) -> str:
    text = text.replace('"PROVERBE"', '"PROVERBES"').replace('"REMARQUES"', '"REMARQUE"')
    if '<span lang="la">' not in text:
        return text
    return re.sub(r'<span lang="la">(.*?)</span>', r'<i lang="la">\1</i>', text, flags=re.S)


def escaped(text: str) -> str:
    if "&" not in text and "<" not in text and ">" not in text:
        return text
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class _Element:
    __slots__ = ("tag", "attrs", "line", "children")

    def __init__(self, tag, attrs, line):
        self.tag, self.attrs, self.line, self.children = tag, attrs, line, []


def tree(text: str, first_line: int = 1) -> _Element:
    from xml.parsers import expat

    root = _Element("", {}, 0)
    stack = [root]
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(tag, attrs):
        e = _Element(tag, attrs, parser.CurrentLineNumber + first_line - 1)
        stack[-1].children.append(e)
        stack.append(e)

    parser.StartElementHandler = start
    parser.EndElementHandler = lambda _: stack.pop()
    parser.CharacterDataHandler = lambda data: stack[-1].children.append(data)
    parser.Parse(text if "<xmllittre" in text else f"<xmllittre>{text}</xmllittre>", True)
    parser.StartElementHandler = parser.EndElementHandler = parser.CharacterDataHandler = None  # else parser and tree hold each other
    return root


def _markup(e: _Element, skip=frozenset()) -> str:
    out = []
    for c in e.children:
        if isinstance(c, str):
            out.append(escaped(c))
        elif c.tag not in skip:
            out.append(_whole(c))
    return "".join(out)


def _whole(e: _Element) -> str:
    attrs = "".join(f' {k}="{escaped(v)}"' for k, v in e.attrs.items())
    return f"<{e.tag}{attrs}>{_markup(e)}</{e.tag}>"


def _content(e: _Element) -> str:
    return " ".join(_markup(e, BLOCKS).split())


def _of(e: _Element | None, *tags: str) -> list[_Element]:
    return [c for c in e.children if not isinstance(c, str) and c.tag in tags] if e is not None else []


def _first(e: _Element | None, tag: str) -> _Element | None:
    return next(iter(_of(e, tag)), None)


def _lead(e: _Element | None) -> str:
    """Text before the first element."""
    out = []
    for c in e.children if e is not None else ():
        if not isinstance(c, str):
            break
        out.append(c)
    return "".join(out).strip()


def _int(x: str | None) -> int | None:
    try:
        return int(x) if x else None
    except ValueError:
        return None


#: All begin with one character, which the search leaps to.
_ENTRY = re.compile(r"<(?:!--.*?--|!\[CDATA\[.*?\]\]|(?P<empty>entree\b[^>]*/)|(?P<open>entree\b[^>]*)|(?P<close>/entree\s*))>", re.S)


def entry_cuts(text: str):
    """(entries before it, first line, text) of each outermost entry; the whole text at once if it defines entities."""
    if "<!ENTITY" in text:
        yield 0, 1, text
        return
    depth, seen, start, before, line, at = 0, 0, 0, 0, 1, 0
    for m in _ENTRY.finditer(text):
        if m["close"]:
            depth -= 1
        elif m["open"] or m["empty"]:
            if depth == 0:
                start, before = m.start(), seen
            seen += 1
            depth += m["open"] is not None
        else:
            continue
        if depth < 0:
            raise ValueError("an entry is closed that was never opened")
        if depth == 0:
            line, at = line + text.count("\n", at, start), start
            yield before, line, text[start : m.end()]
    if depth:
        raise ValueError("an entry is never closed")


def file_rows(name: str, text: str, patches: list[dict]):
    """All rows of one file, as dicts of NODE's columns."""
    for before, line, cut in entry_cuts(normalised(patched(text, patches))):
        yield from entry_rows(name, cut, before, line)


def entry_rows(name: str, text: str, before: int = 0, first_line: int = 1):
    """Rows of the entries of one cut, as dicts; ``before`` entries and ``first_line - 1`` lines precede it in its file."""
    for r in entry_values(name, text, before, first_line):
        yield {n: v for n, v in zip(NAMES, r, strict=True) if v is not None}


def entry_values(name: str, text: str, before: int = 0, first_line: int = 1):
    """The same rows as tuples in the order of NODE."""
    root = tree(text, first_line)

    def entries(e):
        for c in e.children:
            if not isinstance(c, str):
                if c.tag == "entree":
                    yield c
                yield from entries(c)

    for k, e in enumerate(entries(root), before + 1):

        # Between the path and the content: cit_ord, headword, homograph_index, is_supplement, pronunciation, pos, resume_text, rubrique_kind, rubrique_name, num, is_resume, in_rubrique.
        def citations(owner, path, k=k):
            for i, c in enumerate(_of(owner, "cit"), 1):
                said = c.attrs.get
                yield name, k, "citation", path, i, *(None,) * 11, _markup(c).strip(), said("aut", ""), said("ref", ""), said("hide", ""), c.line

        def indent(x, path, in_rubrique, k=k):
            yield name, k, "indent", path, *(None,) * 11, in_rubrique, _content(x), None, None, None, x.line
            yield from citations(x, path)
            for i, c in enumerate(_of(x, "indent"), 1):
                yield from indent(c, [*path, i], in_rubrique)

        def rubrique(x, path, k=k):
            nom = x.attrs.get("nom", "")
            yield name, k, "rubrique", path, *(None,) * 7, RUBRIQUES.get(nom, "Remarque"), nom, None, None, True, _content(x), None, None, None, x.line
            yield from citations(x, path)
            for i, c in enumerate(_of(x, "indent"), 1):
                yield from indent(c, [*path, i], True)

        def sense(x, path, supplement, k=k):
            yield name, k, "sense", path, None, None, None, supplement, *(None,) * 5, _int(x.attrs.get("num")), x.attrs.get("option") == "résumé", False, _content(x), None, None, None, x.line
            yield from citations(x, path)
            inner = _of(x, "indent")
            for i, c in enumerate(inner, 1):
                yield from indent(c, [*path, i], False)
            for i, c in enumerate(_of(x, "rubrique"), len(inner) + 1):
                yield from rubrique(c, [*path, i])

        head, body, resume = _first(e, "entete"), _first(e, "corps"), _first(e, "résumé")
        sens = e.attrs.get("sens")
        rubriques = _of(body, "rubrique") + _of(e, "rubrique")
        named = e.attrs.get("terme", ""), int(sens) if sens else None, e.attrs.get("supplement") == "1"
        yield name, k, "entry", [], None, *named, _lead(_first(head, "prononciation")), _lead(_first(head, "nature")), _whole(resume) if resume is not None else "", *(None,) * 9, e.line
        senses = [(v, False) for v in _of(body, "variante")] + [(v, True) for r in rubriques for v in _of(r, "variante")]
        for i, (v, supplement) in enumerate(senses, 1):
            yield from sense(v, [1, i], supplement)
        for j, r in enumerate(rubriques, 1):
            yield from rubrique(r, [2, j])


@contextlib.contextmanager
def _seldom_collected():
    """Trees and rows are many small objects and end by themselves: the collector looks through them less often."""
    before = gc.get_threshold()
    gc.set_threshold(200_000, *before[1:])
    try:
        yield
    finally:
        gc.set_threshold(*before)


def scan_files(files: DataFrame, patches: list[dict] | None = None, dealt: bool = False) -> DataFrame:
    """``files(path, text)`` to NODE rows; ``patches`` is the small list of a corrections file.

    A file without entries gives no rows. The cuts are dealt out before they are read, so
    the largest file bounds only the cutting, a search for tags. ``dealt``: the files are
    small and already spread over the cluster, so their cuts stay where they are.
    """
    spark = files.sparkSession
    schema = spark.createDataFrame([], NODE).schema
    arrow = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    kinds = pa.schema([(f.name, arrow[f.dataType.simpleString()]) for f in schema])

    cuts_schema = pa.schema([("source_file", pa.string()), ("before", pa.int64()), ("line", pa.int64()), ("text", pa.string())])

    def cuts_of(batches):
        for batch in batches:
            for path, text in zip(batch.column(0), batch.column(1), strict=True):
                name, text = path.as_py().rsplit("/", 1)[-1], text.as_py()
                for cut in entry_cuts(normalised(patched(text or "", [p for p in patches or () if p["file"] == name]))):
                    yield name, *cut

    def cut(batches):
        held, size = [], 0
        for x in cuts_of(batches):
            held.append(x)
            size += len(x[-1])
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), cuts_schema, strict=True)], schema=cuts_schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), cuts_schema, strict=True)], schema=cuts_schema)

    def scan(cuts):
        rows, size = [], 0
        for name, before, line, text in cuts:
            with _seldom_collected():
                rows += entry_values(name, text, before, line)
            size += len(text)
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    if dealt:  # cut and read in one worker: a text goes to Python once
        return files.select("path", "text").mapInArrow(lambda batches: scan(cuts_of(batches)), schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = files.select("path", "text").mapInArrow(cut, "source_file string, before long, line long, text string")
    told = lambda batches: (tuple(v.as_py() for v in x) for batch in batches for x in zip(*batch.columns, strict=True))
    return cuts.repartition(parts, "source_file", "before").mapInArrow(lambda batches: scan(told(batches)), schema)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, text, file_ord)`` of a folder's letter files (a.xml to z.xml and a_prep.xml).

    ``file_ord`` counts from 1 by path, the order of all results; a folder without such files
    is an error.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)
    named = raw.where(F.col("path").rlike(r"/(?:[a-z]|a_prep)\.xml$"))
    paths = sorted(r["path"] for r in named.select("path").collect())  # 27 at most
    if not paths:
        raise FileNotFoundError(f"no letter files in {folder}")
    ord_ = F.array_position(F.array(*[F.lit(p) for p in paths]), F.col("path")).cast("int")
    return named.select("path", F.decode("content", "UTF-8").alias("text"), ord_.alias("file_ord"))
