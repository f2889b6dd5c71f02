"""Part-of-speech strings and usage labels as Column expressions.

A label is read whole as a part of speech first; else each piece between " et " is routed
by the first tier that knows it: agreement, construction, part of speech, exact usage,
then the ordered usage patterns. A piece that no tier knows is tried once more without
its closing discourse words, and is a hint if that fails too. Everything stays in the JVM.

Null labels give null; blank ones an empty list.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables as V
from .text import collapse_content, collapse_ws, normalize_atom, strip

ELEMENT = "struct<kind:string,norm:string,printed:string>"
#: Closing words that only point, as a router drops them.
TAIL = r"(?U)(?:\s+(?:encore|aussi|aujourd['’]hui|en ce sens|en cet emploi|dans le même sens))+$"
ET = r"(?U)\s+et\s+"


def strip_discourse_tail(c: Column) -> Column:
    return F.regexp_replace(c, TAIL, "")


def let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, not copied into every place that names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class Gram(NamedTuple):
    """One element of a reading."""

    kind: str
    norm: str
    printed: str


class Reading(NamedTuple):
    """What a label stands for: grammar or usage."""

    target: str
    elements: tuple


@dataclass(frozen=True)
class NormTables:
    """The router's tables; those of ``tables`` unless others are given (``sources.tables`` reads them from files)."""

    construction: dict = field(default_factory=lambda: V.CONSTRUCTION)
    agreement: dict = field(default_factory=lambda: V.AGREEMENT)
    pos_heads: dict = field(default_factory=lambda: V.POS_HEADS)
    pos_modifiers: dict = field(default_factory=lambda: V.POS_MODIFIERS)
    pos_head_sensitive: dict = field(default_factory=lambda: V.POS_HEAD_SENSITIVE)
    pos_connectors: tuple = V.POS_CONNECTORS
    usage_exact: dict = field(default_factory=lambda: V.USAGE_EXACT)
    usage_prefix: list = field(default_factory=lambda: V.USAGE_PREFIX)
    usage_lemma: list = field(default_factory=lambda: V.USAGE_LEMMA)
    usage_domain: list = field(default_factory=lambda: V.USAGE_DOMAIN)

    def usage_rules(self) -> list[tuple[str, str, str]]:
        """(pattern, kind, norm) in the order they are tried; prefixes and domains at the start only."""
        start = lambda rules: [(f"^(?:{p})", k, n) for p, k, n in rules]
        return start(self.usage_prefix) + [tuple(r) for r in self.usage_lemma] + start(self.usage_domain)

    def pos_tokens(self) -> dict[str, tuple[str, str, str]]:
        """token: (place, kind, norm); the place is head, own, or hangs (on the head before it)."""
        hanging = {k.split("|")[0]: ("hangs", "", "") for k in self.pos_head_sensitive}
        return {k: ("own", *v) for k, v in self.pos_modifiers.items()} | hanging | {k: ("head", *v) for k, v in self.pos_heads.items()}


BUILT_IN = NormTables()


def _map(pairs: dict, names: tuple[str, ...] = ("kind", "norm")) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,struct<" + ",".join(f"{n}:string" for n in names) + ">>")
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.struct(*[F.lit(y).alias(n) for n, y in zip(names, v, strict=True)]))])


def parse_pos(text: Column, t: NormTables = BUILT_IN) -> Column:
    """array<struct(kind, norm, printed)> of a part-of-speech string; null if any token is unknown."""
    tokens = t.pos_tokens()
    known, hangs = _map(tokens, ("place", "kind", "norm")), _map(t.pos_head_sensitive)
    names = list(tokens)
    clean = F.regexp_replace(F.regexp_replace(collapse_ws(text), "[,;:]+$", ""), r"\.\.+$", ".")

    def step(state: Column, printed: Column) -> Column:
        def with_token(x: Column) -> Column:
            return let(F.struct(x.alias("token"), F.element_at(known, x).alias("hit"), F.coalesce(F.element_at(hangs, F.concat(x, F.lit("|"), state["head"])), F.element_at(hangs, F.concat(x, F.lit("|")))).alias("hung")), read)

        def read(x: Column) -> Column:
            hit = F.when(x["hit"]["place"] == "hangs", x["hung"]).when(x["hit"].isNotNull(), F.struct(x["hit"]["kind"].alias("kind"), x["hit"]["norm"].alias("norm")))
            return F.struct(F.when(x["hit"]["place"] == "head", x["token"]).otherwise(state["head"]).alias("head"), (state["ok"] & hit.isNotNull()).alias("ok"), F.concat(state["found"], _one(hit["kind"], hit["norm"], printed)).alias("found"))

        low = F.lower(printed)
        bare = F.regexp_replace(low, r"\.+$", "")
        token = F.get(F.filter(F.array(low, bare, F.concat(bare, F.lit("."))), lambda c: c.isin(*names)), F.lit(0))
        return F.when(low.isin(*t.pos_connectors), state).otherwise(let(token, with_token))

    start = F.struct(F.lit("").alias("head"), F.lit(True).alias("ok"), F.array().cast(f"array<{ELEMENT}>").alias("found"))
    def parsed(c: Column) -> Column:
        return F.when((c != "") & ~c.contains("<"), F.aggregate(F.split(c, " "), start, step, lambda s: F.when(s["ok"] & (F.size(s["found"]) > 0), s["found"])))

    return let(clean, parsed)


def _one(kind: Column, norm: Column, printed: Column) -> Column:
    return F.array(F.struct(kind.alias("kind"), norm.alias("norm"), printed.alias("printed")))


def _usage(atom: Column, t: NormTables = BUILT_IN) -> Column:
    """struct(kind, norm) of the first usage tier that knows the atom, else null."""
    out = F.when(atom.isin(*t.usage_exact), F.element_at(_map(t.usage_exact), atom))
    for pattern, kind, norm in t.usage_rules():
        out = out.when(atom.rlike("(?U)" + pattern), F.struct(F.lit(kind).alias("kind"), F.lit(norm).alias("norm")))
    return out


def route_atom(atom: Column, printed: Column | None = None, t: NormTables = BUILT_IN) -> Column:
    """struct(target, elements) of one normalised label; ``printed`` is its text in the source."""
    printed = atom if printed is None else printed
    agreement, construction = _map(t.agreement), _map({k: ("construction", v) for k, v in t.construction.items()})

    def tiers(x: Column) -> Column:
        named = F.coalesce(F.element_at(agreement, x), F.element_at(construction, x))
        gram = F.coalesce(let(named, lambda n: F.when(n.isNotNull(), _one(n["kind"], n["norm"], x))), parse_pos(x, t))
        return F.struct(gram.alias("gram"), _usage(x, t).alias("usage"))

    def choose(both: Column) -> Column:
        usage = F.coalesce(both[0]["usage"], both[1]["usage"])
        hint = F.coalesce(usage["kind"], F.lit("hint")) == "hint"
        gram = F.coalesce(both[0]["gram"], F.when(hint, both[1]["gram"]))
        elements = F.coalesce(gram, _one(F.coalesce(usage["kind"], F.lit("hint")), F.coalesce(usage["norm"], F.lit("")), printed))
        return F.struct(F.when(gram.isNotNull(), "gram").otherwise("usg").alias("target"), elements.alias("elements"))

    # Two forms: as it stands, and without its closing words.
    return let(F.transform(F.array(atom, F.regexp_replace(atom, TAIL, "")), tiers), choose)


def route(content: Column, t: NormTables = BUILT_IN) -> Column:
    """array<struct(printed, target, elements)>: what each piece of a label stands for."""
    folded = F.split(collapse_content(content), ET)
    source = F.split(content, ET)
    shown = F.when(F.size(source) == F.size(folded), source).otherwise(folded)
    pairs = F.filter(F.zip_with(folded, shown, lambda f, s: F.struct(normalize_atom(f).alias("atom"), strip(s).alias("printed"))), lambda p: p["atom"] != "")

    def routed(p: Column) -> Column:
        return let(route_atom(p["atom"], p["printed"], t), lambda r: F.struct(p["printed"].alias("printed"), r["target"].alias("target"), r["elements"].alias("elements")))

    def pieces(whole: Column) -> Column:
        one = F.array(F.struct(strip(content).alias("printed"), F.lit("gram").alias("target"), whole.alias("elements")))
        return F.when(whole.isNotNull(), one).otherwise(F.transform(pairs, routed))

    return let(parse_pos(content, t), pieces)


def has_valency(content: Column, t: NormTables = BUILT_IN) -> Column:
    """Whether any grammatical reading of a label is of valency."""
    return F.coalesce(F.exists(route(content, t), lambda r: (r["target"] == "gram") & F.exists(r["elements"], lambda e: e["kind"] == "valency")), F.lit(False))


# -- splitting a label from what it governs ---------------------------------------------


#: Labels that can open a block without markup, in order.
BARE_LABELS = [
    r"substantivement\b",
    r"absolument\b",
    r"adjectivement\b",
    r"adverbialement\b",
    r"intransitivement\b",
    r"neutralement\b",
    r"impersonnellement\b",
    r"activement\b",
    r"v\.\s*(?:n|a|réfl)\b",
    r"se\s+conjugue\b",
    r"au\s+(?:pluriel|féminin|singulier|figuré|masculin)\b",
    r"familièrement\b",
    r"populaire(?:ment)?\b",
    r"vulgairement\b",
    r"ironiquement\b",
    r"plaisamment\b",
    r"poétiquement\b",
    r"burlesquement\b",
    r"par\s+(?:euphémisme|exagération|ironie|dérision|extension|analogie|métaphore|plaisanterie|antiphrase)\b",
    r"néologisme\b",
    r"(?:très\s+)?peu\s+usité\b",
    r"hors\s+d'usage\b",
    r"tombé\s+en\s+désuétude\b",
    r"il\s+est\s+(?:familier|vieux|populaire|inusité|hors\s+d'usage)\b",
    r"il\s+n'est\s+plus\s+usité\b",
    r"il\s+(?:a\s+vieilli|vieillit)\b",
    r"ce\s+mot\s+(?:est|a\s+vieilli)\b",
    r"ce\s+sens\s+a\s+vieilli\b",
    r"cet\s+emploi\s+(?:vieillit|a\s+vieilli)\b",
    r"(?:mot|terme)\s+(?:vieilli|vieux|familier|populaire|inusité|bas)\b",
]
#: Words that may stand between such a label and its separator.
BARE_ADVERBIALS = ["encore", "aussi", "aujourd['’]hui", r"au\s+singulier", r"au\s+pluriel", r"en\s+ce\s+sens", r"dans\s+le\s+même\s+sens"]


def split_bare_label(text: Column) -> Column:
    """struct(label, rest) of a block that opens with an unmarked label, a separator and a text; else null."""
    # The label ignores case; what may stand between it and the separator does not.
    tail = r"((?:\s+et\b[^,.:]*|\s+(?:" + "|".join(BARE_ADVERBIALS) + r")\b)*)\s*[,.:]\s*(\S.*)$"
    tries = []
    for root in BARE_LABELS:
        pattern = rf"(?Us)^((?iu:{root}))" + tail
        label = F.concat(F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))
        tries.append(F.when(text.rlike(pattern), F.struct(F.lower(strip(label)).alias("label"), strip(F.regexp_extract(text, pattern, 3)).alias("rest"))))
    # Each root is tried only where one of them can match at all.
    gate = text.rlike("(?iuUs)^(?:" + "|".join(BARE_LABELS) + ")")
    return F.when(gate, F.coalesce(*tries))


#: How long a transcription can be, and words that only a remark on pronunciation has.
PROSE_LONG, PROSE_CLAUSE = 60, 25
PROSE_MARKERS = r"prononc|\s(?:disent|dit|est|sont|on|il|qui|que|mais|selon|certains|toujours|jamais)\s|quelques|plupart|suivant|syllabe|lorsque|aujourd"


def is_pronunciation_prose(text: Column) -> Column:
    """Whether a pronunciation is a remark in prose: long, of several sentences or clauses, or with a marker word."""
    return (F.length(text) > PROSE_LONG) | text.rlike(r"(?U)\.\s") | (text.contains(";") & (F.length(text) > PROSE_CLAUSE)) | text.rlike("(?iuU)" + PROSE_MARKERS)
