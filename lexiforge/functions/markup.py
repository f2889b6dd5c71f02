"""Inline markup of the source to the markup of the rendered entry, as one pass over tags and text.

Everything here takes and gives strings, row by row inside Arrow batches; texts are a few
hundred characters. Markup that does not balance is passed through rather than mended.
"""

from __future__ import annotations

import re
from unicodedata import normalize

_TAG = re.compile(r"(<[^>]+>)")
_LEADING = re.compile(r"^[,;:\s]+")

#: Opening tags of the source and what they and their closing tags become.
ELEMENTS = {
    '<semantique type="domaine">': ('<usg type="domain">', "</usg>"),
    '<semantique type="indicateur">': ('<usg type="sem">', "</usg>"),
    "<semantique>": ('<usg type="sem">', "</usg>"),
    "<exemple>": ("<mentioned>", "</mentioned>"),
    "<nature>": ('<usg type="gram">', "</usg>"),
    "<i>": ("<mentioned>", "</mentioned>"),
}
FAMILIES = ("semantique", "exemple", "nature", "a", "i")
REFERENCE_LABEL = re.compile(r'\b((?:[Vv]oy(?:ez)?|[Cc]f|[Cc]omparez)\.?)\s*(<xr type="related">)')
LEADING_RUN = re.compile(r'(?:<usg\b[^>]*type="[^"]*"[^>]*>.*?</usg>[,;:\s]*)*', re.S)
INLINE_USAGE = re.compile(r'<usg\b[^>]*type="([^"]*)"[^>]*>(.*?)</usg>', re.S)
GRAM = re.compile(r'(.*?)<usg type="gram">(.*?)</usg>(.*)', re.S)
_USAGE = re.compile(r"<usg\b[^>]*>(.*?)</usg>", re.S)
_FOREIGN = re.compile(r'<i\s+lang="([^"]+)"\s*>$')
_LINK = re.compile(r'<a ref="([^"]*)">$')


def pieces(text: str) -> list[str]:
    """Tags and the texts between them, none empty."""
    return [x for x in _TAG.split(text) if x]


def is_tag(piece: str) -> bool:
    return piece.startswith("<")


def plain(text: str) -> str:
    return re.sub(r"<[^>]+>", "", text).strip()


def escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def slug(text: str) -> str:
    ascii_ = normalize("NFKD", text.lower()).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", ascii_).strip("_")


def entry_id(reference: str) -> str:
    """Where a cross-reference points: the part before '#', a trailing .N outside the slug."""
    base, _, number = (m.groups() if (m := re.match(r"(.*)(\.)(\d+)$", reference.split("#")[0], re.S)) else (reference.split("#")[0], "", ""))
    name = slug(base)
    name = name if name[:1].isalpha() else "e_" + name
    return f"{name}.{number}" if number else name


def key(text: str) -> str:
    """Letters and digits only, for comparing phrases."""
    folded = normalize("NFKD", plain(text).lower())
    return "".join(c for c in folded if c.isascii() and c.isalnum())


def converted(markup: str) -> str:
    """Source markup to target markup: elements by table, links to cross-references with their label, usage in lower case."""
    open_: dict[str, list[str]] = {f: [] for f in FAMILIES}
    out = []
    for piece in pieces(markup):
        name = re.match(r"</?([^\s>/]+)", piece)[1] if is_tag(piece) and len(piece) > 2 and re.match(r"</?[^\s>/]", piece) else ""
        if name not in open_:
            out.append(piece)
        elif piece.startswith("</"):
            out.append(open_[name].pop() if open_[name] else piece)
        else:
            if m := _LINK.match(piece):
                shown = f'<xr type="related"><ref type="entry" target="#{escaped(entry_id(m[1]))}">', "</ref></xr>"
            elif m := _FOREIGN.match(piece):
                shown = f'<foreign xml:lang="{m[1]}">', "</foreign>"
            else:
                shown = ELEMENTS.get(piece, (piece, f"</{name}>"))
            out.append(shown[0])
            open_[name].append(shown[1])
    text = REFERENCE_LABEL.sub(r"\2<lbl>\1</lbl>", "".join(out))
    return re.sub(r"(<usg\b[^>]*>)(.*?)(</usg>)", lambda m: m[1] + m[2].lower() + m[3], text, flags=re.S)


def lower_text(text: str) -> str:
    return "".join(x if is_tag(x) else x.lower() for x in pieces(text))


def without_usage(text: str) -> str:
    return _USAGE.sub(r"\1", text)


def balanced(text: str) -> bool:
    depth = 0
    for tag in filter(is_tag, pieces(text)):
        depth += -1 if tag.startswith("</") else not tag.endswith("/>")
        if depth < 0:
            return False
    return depth == 0


def usage_text(printed: str) -> str:
    """Text as a usage element may hold it."""
    return re.sub(r"</?(?:xr|lbl|mentioned|foreign)\b[^>]*>", "", printed)


def without_xr(text: str) -> str:
    return text.replace('<xr type="related">', "").replace("</xr>", "")


def highlighted(text: str) -> str:
    """Phrase wrappers as highlights: never one in another, and none around a cross-reference's wrapper or label."""
    depth, out = 0, []
    for piece in pieces(text):
        if m := re.match(r'<foreign xml:lang="([^"]+)">', piece):
            piece = f'<hi rend="italic" xml:lang="{m[1]}">'
        elif re.match(r"<mentioned>|<i\b", piece):
            piece = '<hi rend="italic">'
        elif piece in ("</foreign>", "</mentioned>", "</i>"):
            piece = "</hi>"
        if piece.startswith("<hi"):
            depth += 1
            keep = depth == 1
        elif piece.startswith("</hi"):
            depth = max(depth - 1, 0)
            keep = depth == 0
        else:
            keep = depth == 0 or not (piece.startswith("<xr") or piece in ("</xr>", "<lbl>", "</lbl>"))
        if keep:
            out.append(piece)
    return "".join(out)


def quoted(text: str) -> str:
    return highlighted(without_xr(text).replace("<lbl>", "").replace("</lbl>", ""))


def noted(content: str) -> str:
    return re.sub(r"</?gram(?:Grp)?\b[^>]*>", "", without_usage(highlighted(converted(content))))


def segmented(text: str) -> str:
    """A cross-reference's body: loose text in segments."""
    depth, out = 0, []
    for piece in pieces(without_xr(text)):
        if is_tag(piece):
            depth += -1 if piece.startswith("</") else not piece.endswith("/>")
            out.append(piece)
        else:
            out.append(piece if depth > 0 or not piece.strip() else f"<seg>{piece}</seg>")
    return "".join(out)


# -- labels -----------------------------------------------------------------------------

_OPENINGS = (
    (re.compile(r"<gramGrp><gram\b[^>]*>(.*?)</gram></gramGrp>\s*", re.S), str.lower),
    (re.compile(r"<usg\b[^>]*>(.*?)</usg>\s*", re.S), lower_text),
    (re.compile(r"(Fig\.)\s*"), str.lower),
)


def label_and_rest(text: str) -> tuple[str, str]:
    """The label a block opens with, and what it governs; without one, all of it is the label."""
    for pattern, fold in _OPENINGS:
        if m := pattern.match(text):
            return fold(without_usage(m[1].strip())), _LEADING.sub("", text[m.end() :]).strip()
    return lower_text(without_usage(text)), ""


def around_gram(text: str) -> tuple[str, str, str, str]:
    """(before, label, after, kind of what stands before) of the first grammatical label; empty without one."""
    m = GRAM.match(text)
    if m is None:
        return "", "", "", "none"
    before = re.sub(r"[,;:\s]+$", "", m[1].strip()).strip()
    label, after = m[2].strip(), _LEADING.sub("", m[3].strip()).strip()
    if not before:
        kind = "none"
    elif re.match("[Ss][e'’]", before) and "réfl" in label:
        kind = "reflexive_form"
    elif re.search(r"loc\.\s*(?:adv|prépos|conj)|locut\.", label, re.I):
        kind = "locution_form"
    else:
        kind = "headword_echo"
    return before, label, after, kind


def bare_label(text: str) -> tuple[str, str] | None:
    """(label, text) of a block that opens with an unmarked label, a separator and a text."""
    from .labels import BARE_ADVERBIALS, BARE_LABELS

    tail = r"((?:\s+et\b[^,.:]*|\s+(?:" + "|".join(BARE_ADVERBIALS) + r")\b)*)\s*[,.:]\s*(.*)"
    for root in BARE_LABELS:
        if (m := re.match(f"((?i:{root})){tail}", text, re.S)) and m[3].strip():
            return (m[1] + m[2]).strip().lower(), m[3].strip()
    return None


def proverb_marker(text: str) -> tuple[str, str]:
    m = re.match(r"\s*(Prov\.|Proverbe\b\.?|Proverbialement\b\.?)\s*", text)
    return (m[1], text[m.end() :]) if m else ("", text)


def without_form(text: str, form: str) -> str:
    """A definition without the printed form it opens with."""
    if form and text.lower().startswith(form.lower()):
        return re.sub(r"^[\s,;:.]+", "", text[len(form) :])
    return text


def novel_phrases(text: str, form: str, quotes: list[str]) -> tuple[str, list[str]]:
    """(text without its mentioned phrases, those that echo neither the form nor a quote)."""
    known = {key(form), *map(key, quotes)}
    parts = re.split(r"<mentioned>(.*?)</mentioned>", text, flags=re.S)
    lifted = [p.strip() for p in parts[1::2] if key(p.strip()) not in known]
    kept = parts[0]
    for part in parts[2::2]:
        kept = f"{kept.rstrip()} {part.lstrip()}"
    for pattern, by in ((r"\s{2,}", " "), (r"\s+([.,])", r"\1"), (r"\.(\s*\.)+", "."), (r"^[\s,;:]+", "")):
        kept = re.sub(pattern, by, kept)
    return kept.strip(), lifted


def usage_position(before: str, after: str) -> str:
    if not re.sub(r"[\s,;:.()]", "", after):
        return "def_end"
    return "uncertain" if any(re.search(r"[;.]\s", x) for x in (before, after)) else "single_clause"
