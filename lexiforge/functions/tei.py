"""Entries as TEI: rows of an entry, in tree order, to one string.

A block's role gives it a ``Shape`` (labels, definition, lemma) without a look at its
neighbours; the writer then walks the sorted rows once, keeping a stack of open elements.
No rendering step recurses. Catalyst has worked out roles, forms, scope, paths, resolved
authors and etymology segments before, and hands each entry over as arrays of structs.

Fragments: a definition admits no usage element, so each is lifted behind it and reported
with its position; a cross-reference drops its citations and children; a label without
text stands alone, without a sense.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup as M
from .labels import NormTables, Reading
from .router import Router

#: The language of the printed text, the types that are routed, the label of a Latin reconstruction.
OBJECT_LANGUAGE = "fr-x-lit19c"
ROUTED = ("sem", "register", "gram")
FICTIF = '<usg type="hint">fictif</usg>'
ROMANS = {r: n for n, r in enumerate("IX X XI XII XIII XIV XV XVI XVII XVIII XIX".split(), 9)}
NOTES = {"Remarque": "remarque", "Supplement": "supplément", "Proverbes": "proverbes"}


@dataclass
class Shape:
    """What a block prints by itself; ``kind`` is sense, related, xr or labels."""

    kind: str = "sense"
    attrs: str = ""
    lemma: str = ""
    labels: list[str] = field(default_factory=list)
    definition: str = ""  # may open with usage elements
    quotes: list[str] = field(default_factory=list)
    orth: str = ""
    slug: str = ""


def gram_markup(elements) -> str:
    norm = lambda e: f' norm="{e.norm}"' if e.norm else ""
    return "<gramGrp>" + "".join(f'<gram type="{e.kind}"{norm(e)}>{M.escaped(e.printed)}</gram>' for e in elements) + "</gramGrp>"


def usage_markup(kind: str, norm: str, printed: str) -> str:
    return f'<usg type="{kind}"' + (f' norm="{norm}"' if norm else "") + f">{printed}</usg>"


def date_markup(text: str) -> str:
    """The years a century label stands for; empty for any other text."""
    m = re.match(r"\s*([IVXivx]+)\s*e?\s*(?:s\.|siècle)", text)
    n = ROMANS.get(m[1].upper(), 0) if m else 0
    return f'<date notBefore="{(n - 1) * 100 + 1:04d}" notAfter="{n * 100:04d}">{M.escaped(text.strip())}</date>' if n else ""


class Renderer:
    def __init__(self, tables: NormTables | None = None, metonymic=frozenset()):
        self.router, self.metonymic = Router(tables), metonymic

    # -- labels and definitions -------------------------------------------------------------

    def labels(self, kind: str, printed: str) -> list[str]:
        """The elements a label becomes: grammar or usage, one for each piece."""
        if kind not in ROUTED:
            return [usage_markup(kind, "", M.usage_text(printed))]
        spans = self.router.spans(printed)
        shown = lambda span: M.usage_text(printed if len(spans) == 1 else span)
        return [gram_markup(r.elements) if r.target == "gram" else usage_markup(*r.elements[0][:2], shown(span)) for r, span in spans]

    def usage_only(self, m: re.Match) -> str:
        """An inline usage element where no grammar element may stand."""
        if m[1] not in ROUTED:
            return m[0]
        spans = self.router.spans(M.lower_text(m[2]))
        target = lambda r: r.elements[0][:2] if r.target == "usg" else ("hint", "")
        return "".join(usage_markup(*target(r), M.usage_text(m[2] if len(spans) == 1 else span)) for r, span in spans)

    def leading(self, text: str) -> tuple[list[str], str]:
        """The usage elements a definition opens with, as labels, and the rest."""
        run = M.LEADING_RUN.match(text)[0]
        labels = [x for m in M.INLINE_USAGE.finditer(run) for x in self.labels(m[1], M.lower_text(m[2]))]
        return labels, text[len(run) :].strip() if run else text

    def lifted(self, text: str, context: str, hoists: list) -> tuple[list[str], str]:
        """The usage elements inside a definition, as labels, and the definition without them."""
        found = list(M.INLINE_USAGE.finditer(text))
        follows = [text[m.end() : n.start() if n else None] for m, n in zip(found, [*found[1:], None], strict=False)]
        labels, kept = [], text[: found[0].start()] if found else text
        for m, follow in zip(found, follows, strict=True):
            labels += self.labels(m[1], M.lower_text(m[2]))
            whole = kept + m[0] + text[m.end() :]
            hoists.append((context, M.usage_position(kept, text[m.end() :]), m[1], M.plain(m[2]), M.plain(whole)[:120]))
            kept = f"{kept.rstrip()} {follow.lstrip(' ,;:')}"
        return labels, re.sub(r"\s+([.,])", r"\1", re.sub(r"\s{2,}", " ", kept) if found else kept).strip()

    def pos(self, text: str) -> str:
        found = self.router.pos(text)
        return gram_markup(found) if found else f'<gramGrp><gram type="pos">{M.escaped(text)}</gram></gramGrp>'

    # -- shapes of blocks -------------------------------------------------------------------

    def shape(self, node: dict, quotes: list[str], has_children: bool, node_id: str) -> Shape:
        role, text = node["role"] or "Unclassified", M.converted(node["content"] or "")
        default = Shape(definition=text)
        if role == "Figurative":
            label, rest = M.label_and_rest(text)
            return Shape(attrs=' ana="figurative"', labels=self.labels("sem", M.without_usage(label)), definition=rest)
        if role == "DomainLabel":
            label, rest = M.label_and_rest(text)
            return Shape(labels=self.labels("domain", M.without_usage(label)), definition=rest) if label and rest else default
        if role == "RegisterLabel":
            label, rest = M.bare_label(text) or M.label_and_rest(text)
            return Shape(labels=self.labels("register", M.without_usage(label)), definition=rest)
        if role in ("Locution", "Proverb"):
            return default if node_id in self.metonymic or not node["form"] else self._related(node, text, quotes)
        if role == "CrossReference":
            return Shape(kind="xr", definition=M.segmented(text))
        if role in ("NatureLabel", "VoiceTransition"):
            return self._transition(text, bool(quotes) or has_children, default)
        return Shape(attrs=' ana="unclassified"', definition=text)

    def _transition(self, text: str, filled: bool, default: Shape) -> Shape:
        before, label, after, kind = M.around_gram(text)
        if not label:
            label, after = M.bare_label(text) or M.label_and_rest(text)
            label = M.without_usage(label) if after or filled else label
            return Shape(kind="sense" if after or filled else "labels", labels=self.labels("gram", label), definition=after)
        if not (M.balanced(before) and M.balanced(after)):
            return default
        labels = self.labels("gram", label)
        if not (after or filled) and kind == "none":
            return Shape(kind="labels", labels=labels)
        return Shape(lemma=M.escaped(M.plain(before)) if kind in ("reflexive_form", "locution_form") else "", labels=labels, definition=after)

    def _related(self, node: dict, text: str, quotes: list[str]) -> Shape:
        form = node["form"]
        marker, body = M.proverb_marker(text)
        definition, phrases = M.novel_phrases(body, form, quotes)
        rest = M.without_form(definition, form)
        echo = not M.key(rest)
        label = usage_markup("meaningType", "proverbial", marker) if marker else '<usg type="meaningType" norm="proverbial"/>' if echo else ""
        orth = f"<orth>{M.escaped(form)}</orth>" if node["form_source"] == "exemple" else f'<orth value="{M.escaped(form)}"/>'
        return Shape(kind="related", labels=[label] if label else [], definition=definition if echo else rest, quotes=[M.quoted(p) for p in phrases], orth=orth, slug=M.slug(form))

    # -- entries ----------------------------------------------------------------------------

    def entry(self, e: dict, nodes: list[dict], cits: list[dict], rubriques: list[dict], level: int = 1) -> tuple[str, list]:
        return _Writer(self, e, nodes, cits, rubriques).write(level)


@dataclass
class _Open:
    """An element that is still open: its path, what closes it, and how its children stand in it."""

    path: tuple
    closing: list[tuple[int, str]]
    level: int
    base: str
    source: tuple
    silent: bool = False


class _Writer:
    def __init__(self, r: Renderer, e: dict, nodes: list[dict], cits: list[dict], rubriques: list[dict]):
        self.r, self.e, self.out, self.hoists = r, e, [], []
        self.nodes = sorted(nodes, key=lambda n: tuple(n["path"]))
        self.cits: dict[tuple, list[dict]] = {}
        for c in sorted(cits, key=lambda c: (tuple(c["owner"]), c["cit_ord"])):
            self.cits.setdefault(tuple(c["owner"]), []).append(c)
        self.rubriques: dict[tuple, dict[tuple, list[dict]]] = {}
        for x in sorted(rubriques, key=lambda x: (tuple(x["rubrique"]), x["line"])):
            path = tuple(x["rubrique"])
            owner = path[:-1] if path[0] == 1 else ()
            self.rubriques.setdefault(owner, {}).setdefault(path, []).append(x)
        self.parents = {tuple(n["path"])[:-1] for n in nodes}

    def say(self, level: int, text: str) -> None:
        self.out.append("  " * level + text)

    def write(self, level: int) -> tuple[str, list]:
        e, say = self.e, self.say
        supplement = ' source="supplement"' if e["is_supplement"] else ""
        say(level, f'<entry xml:id="{M.escaped(e["entry_id"])}" xml:lang="{OBJECT_LANGUAGE}" type="mainEntry"{supplement}>')
        say(level + 1, '<form type="lemma">')
        say(level + 2, f'<orth norm="{M.escaped(e["headword"].lower())}">{M.escaped(e["headword"])}</orth>')
        if e["pronunciation"] and not e["pron_is_prose"]:
            say(level + 2, f"<pron>{M.escaped(e['pronunciation'])}</pron>")
        say(level + 1, "</form>")
        if e["pronunciation"] and e["pron_is_prose"]:
            say(level + 1, f'<note type="pronunciation">{M.escaped(e["pronunciation"])}</note>')
        if e["pos"]:
            say(level + 1, self.r.pos(e["pos"]))
        stack = [_Open((1,), [], level + 1, M.escaped(e["entry_id"]), (1,))]
        for node in self.nodes:
            path = tuple(node["path"])
            while stack[-1].path != path[: len(stack[-1].path)]:
                self.close(stack.pop())
            up = stack[-1]
            if up.silent:
                continue
            node_id = f"{up.base}_s{path[-1]}" if len(path) == 2 else f"{up.base}.{path[-1]}"
            stack.append(self.open(node, path, node_id, up.level))
        while stack:
            self.close(stack.pop())
        self.rubrics((), level + 1)
        say(level, "</entry>")
        return "\n".join(self.out), self.hoists

    def close(self, x: _Open) -> None:
        if not x.silent and x.source[:1] == (1,) and len(x.source) == 2:
            self.rubrics(x.source, x.level)
        for level, text in x.closing:
            self.say(level, text)

    def open(self, node: dict, path: tuple, node_id: str, level: int) -> _Open:
        source, r = tuple(node["src_path"]), self.r
        attr = f' xml:id="{M.escaped(node_id)}"'
        if node["kind"] == "group":
            if node["transition_type"] == "strong":
                self.say(level, f'<entry{attr} xml:lang="{OBJECT_LANGUAGE}" type="homonymicEntry">')
                self.say(level + 1, f'<form type="lemma"><orth>{M.escaped(node["transition_form"])}</orth></form>')
                self.say(level + 1, r.pos(node["transition_pos"]))
                return _Open(path, [(level, "</entry>")], level + 1, node_id, ())
            self.say(level, f"<sense{attr}>")
            for label in r.labels("gram", M.lower_text(M.converted(node["content"]))):
                self.say(level + 1, label)
            return _Open(path, [(level, "</sense>")], level + 1, node_id, ())
        cits = self.cits.get(source, [])
        if node["kind"] == "sense":
            number = f' n="{node["num"]}"' if node["num"] is not None else ""
            shape = Shape(attrs=number + (' source="supplement"' if node["is_supplement"] else ""), definition=M.converted(node["content"] or ""))
        else:
            shape = r.shape(node, [c["text"] for c in cits], path in self.parents, node_id)
        if shape.kind == "xr":
            self.say(level, f'<xr type="related"{attr}>{shape.definition}</xr>')
            return _Open(path, [], level, node_id, source, silent=True)
        if shape.kind == "labels":
            for label in shape.labels:
                self.say(level, label)
            return _Open(path, [], level, node_id, source)
        closing = [(level, "</sense>")]
        if shape.kind == "related":
            outer = f"{node_id}.{shape.slug}" if shape.slug else node_id
            self.say(level, f'<entry xml:id="{M.escaped(outer)}" xml:lang="{OBJECT_LANGUAGE}" type="relatedEntry">')
            self.say(level + 1, f'<form type="lemma">{shape.orth}</form>')
            closing = [(level + 1, "</sense>"), (level, "</entry>")]
            level, node_id = level + 1, f"{outer}.1"
            attr = f' xml:id="{M.escaped(node_id)}"'
        self.say(level, f"<sense{attr}{shape.attrs}>")
        if shape.lemma:
            self.say(level + 1, f'<form type="lemma"><orth>{shape.lemma}</orth></form>')
        opening, definition = ([], shape.definition) if shape.kind == "related" else r.leading(shape.definition)
        for label in shape.labels + opening:
            self.say(level + 1, label)
        if definition:
            behind, definition = r.lifted(definition, node_id, self.hoists)
            if definition := M.highlighted(definition):
                self.say(level + 1, f"<def>{definition}</def>")
            for label in behind:
                self.say(level + 1, label)
        for quote in shape.quotes:
            self.say(level + 1, '<cit type="example">')
            self.say(level + 2, f"<quote>{quote}</quote>")
            self.say(level + 1, "</cit>")
        self.quotations(cits, level + 1)
        return _Open(path, closing, level + 1, node_id, source)

    def quotations(self, cits: list[dict], level: int, ana: str = "", date: str = "") -> None:
        for c in cits:
            author = c["resolved_author"] or c["author"]
            marks = " ".join(x for x in (ana, "hidden" if c["hide"] else "") if x)
            self.say(level, '<cit type="example"' + (f' ana="{marks}"' if marks else "") + ">")
            self.say(level + 1, f"<quote>{M.quoted(M.converted(c['text']))}</quote>")
            if author or c["reference"] or date:
                self.say(level + 1, "<bibl>")
                for tag, text in (("author", author), ("biblScope", c["reference"])):
                    if text:
                        self.say(level + 2, f"<{tag}>{M.escaped(text)}</{tag}>")
                if date:
                    self.say(level + 2, date)
                self.say(level + 1, "</bibl>")
            self.say(level, "</cit>")

    # -- rubriques --------------------------------------------------------------------------

    def rubrics(self, owner: tuple, level: int) -> None:
        """An owner's rubriques in order; all etymologies, then all histories, stand where the first of them does."""
        own = list(self.rubriques.get(owner, {}).values())
        folded = [x for kind in ("Etymologie", "Historique") for x in own if x[0]["rubrique_kind"] == kind]
        for lines in own:
            kind = lines[0]["rubrique_kind"]
            if kind in ("Etymologie", "Historique"):
                if folded:
                    self.say(level, "<etym>")
                    for line in (line for x in folded for line in x):
                        self.etymology(line, level + 1)
                    self.say(level, "</etym>")
                folded = []
                continue
            texts = [M.noted(x["content"]) for x in lines if x["content"]]
            if kind == "Synonyme":
                self.say(level, f'<xr type="synonymy">{M.segmented(" ".join(texts))}</xr>')
            else:
                self.say(level, f'<note type="{NOTES[kind]}">')
                for text in texts:
                    self.say(level + 1, text)
                self.say(level, "</note>")
            for x in lines:
                self.quotations(self.cits.get(tuple(x["owner"]), []), level)

    def residual(self, content: str) -> str:
        return M.INLINE_USAGE.sub(self.r.usage_only, M.highlighted(M.converted(content)))

    def etymology(self, line: dict, level: int) -> None:
        content, date = line["content"], ""
        if content and line["rubrique_kind"] == "Historique":
            text = M.plain(content)
            date = date_markup(text)
            self.say(level, f"<lbl>{M.escaped(text)}</lbl>" if date else self.residual(content))
        elif content:
            for s in line["segments"] or ():
                self.segment(s, level)
        self.quotations(self.cits.get(tuple(line["owner"]), []), level, "attestation", date)

    def segment(self, s: dict, level: int) -> None:
        if s["kind"] == "cit":
            self.say(level, f'<cit type="{s["cit_type"]}"' + (f' xml:lang="{M.escaped(s["language"])}"' if s["language"] else "") + ">")
            if cue := s["cue"]:
                expand = f' expand="{M.escaped(cue["expand"])}"' if cue["expand"] else ""
                self.say(level + 1, f'<lang{expand} norm="{M.escaped(cue["code"])}">{M.escaped(cue["printed"])}</lang>')
            if s["fictif"]:
                self.say(level + 1, FICTIF)
            variant = ' type="variant"' if len(s["forms"]) > 1 else ""
            for form in s["forms"]:
                self.say(level + 1, f"<form{variant}><orth>{M.escaped(form)}</orth></form>")
            if s["gloss"]:
                self.say(level + 1, f"<gloss>{M.escaped(s['gloss'])}</gloss>")
            self.say(level, "</cit>")
        elif s["kind"] == "xref":
            ref = f'<ref type="entry" target="#{M.escaped(M.entry_id(s["target"]))}">{M.escaped(s["text"])}</ref>'
            self.say(level, f'<xr type="related"><lbl>{M.escaped(s["anchor"])}</lbl>{ref}</xr>')
        elif s["kind"] == "prose":
            self.say(level, self.residual(s["text"]))
        else:
            mark = ' ana="suspect"' if s["kind"] == "suspect" else ""
            self.say(level, f"<lbl{mark}>{M.escaped(s['text'])}</lbl>")


HEADER = """<?xml version="1.0" encoding="UTF-8"?>
<TEI xmlns="http://www.tei-c.org/ns/1.0" type="lex-0">
<teiHeader>
  <fileDesc>
    <titleStmt>
      <title type="full">Dictionary</title>
    </titleStmt>
    <publicationStmt>
      <p>Unpublished</p>
    </publicationStmt>
    <sourceDesc>
      <p>Rendered from structured tables</p>
    </sourceDesc>
  </fileDesc>
</teiHeader>
<text>
<body>"""
FOOTER = "</body>\n</text>\n</TEI>"

HOIST = "struct<context_id: string, position: string, usg_type: string, label: string, def_excerpt: string>"


def rendered(entry: Column, nodes: Column, cits: Column, rubriques: Column, tables: NormTables | None = None, metonymic=frozenset()) -> Column:
    """struct(tei, hoists) of each entry; ``metonymic`` is the set of block ids that were adjudicated to be senses."""
    names = ("context_id", "position", "usg_type", "label", "def_excerpt")
    hoist = pa.struct([(n, pa.string()) for n in names])
    kind = pa.struct([("tei", pa.string()), ("hoists", pa.list_(hoist))])

    @F.arrow_udf(f"struct<tei: string, hoists: array<{HOIST}>>")
    def render(e: pa.Array, n: pa.Array, c: pa.Array, r: pa.Array) -> pa.Array:
        renderer, out = Renderer(tables, metonymic), []
        for row in zip(e.to_pylist(), n.to_pylist(), c.to_pylist(), r.to_pylist(), strict=True):
            tei, hoists = renderer.entry(row[0], *[x or [] for x in row[1:]])
            out.append({"tei": tei, "hoists": [dict(zip(names, h, strict=True)) for h in hoists]})
        return pa.array(out, kind)

    return render(entry, nodes, cits, rubriques)


def gram_split(content: Column) -> Column:
    """struct(pre, label, rest, pre_kind) around the first grammatical label of the rendered markup."""
    names = ("pre", "label", "rest", "pre_kind")
    kind = pa.struct([(n, pa.string()) for n in names])

    @F.arrow_udf("struct<pre: string, label: string, rest: string, pre_kind: string>")
    def split(col: pa.Array) -> pa.Array:
        return pa.array([None if x is None else dict(zip(names, M.around_gram(M.converted(x)), strict=True)) for x in col.to_pylist()], kind)

    return split(content)
