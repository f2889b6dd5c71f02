"""The label router for code that already runs on Arrow batches; ``labels`` holds the same rules as Columns.

Readings are cached by their text: a corpus has a few thousand different labels.
"""

from __future__ import annotations

import re
from functools import lru_cache

from .labels import TAIL, Gram, NormTables, Reading

_TAGS, _SPACE, _ET, _END = re.compile(r"<[^>]+>"), re.compile(r"\s+"), re.compile(r"\s+et\s+"), re.compile(r"[.,;:]+$")
_TAIL = re.compile(TAIL.removeprefix("(?U)"))


def collapsed(text: str) -> str:
    return _SPACE.sub(" ", _TAGS.sub("", text).lower()).strip()


class Router:
    def __init__(self, tables: NormTables | None = None):
        self.t = tables or NormTables()
        self.rules = [(re.compile(p), kind, norm) for p, kind, norm in self.t.usage_rules()]
        self.tokens = self.t.pos_tokens()
        self.spans = lru_cache(maxsize=100_000)(self._spans)

    def pos(self, text: str) -> tuple[Gram, ...] | None:
        """The elements of a part-of-speech string; None if any token is unknown."""
        text = re.sub(r"\.\.+$", ".", re.sub(r"[,;:]+$", "", _SPACE.sub(" ", text).strip()))
        if not text or "<" in text:
            return None
        head, found = "", []
        for printed in text.split(" "):
            bare = printed.lower().rstrip(".")
            spelt = [x for x in (printed.lower(), bare, bare + ".") if x in self.tokens]
            if (spelt[0] if spelt else printed.lower()) in self.t.pos_connectors:
                continue
            place, kind, norm = self.tokens[spelt[0]] if spelt else ("", "", "")
            if place == "hangs":
                kind, norm = next((x for h in (head, "") if (x := self.t.pos_head_sensitive.get(f"{spelt[0]}|{h}"))), ("", ""))
            elif place == "head":
                head = spelt[0]
            if not kind:
                return None
            found.append(Gram(kind, norm, printed))
        return tuple(found) or None

    def _gram(self, atom: str) -> tuple[Gram, ...] | None:
        if atom in self.t.agreement:
            return (Gram(*self.t.agreement[atom], atom),)
        if atom in self.t.construction:
            return (Gram("construction", self.t.construction[atom], atom),)
        return self.pos(atom)

    def _usage(self, atom: str) -> tuple[str, str] | None:
        if atom in self.t.usage_exact:
            return tuple(self.t.usage_exact[atom])
        return next(((kind, norm) for p, kind, norm in self.rules if p.search(atom)), None)

    def atom(self, atom: str, printed: str | None = None) -> Reading:
        """One label: the label as it stands, then without its closing words."""
        tries = [atom]
        if (short := _TAIL.sub("", atom)) != atom:
            tries.append(short)
        if gram := self._gram(atom):
            return Reading("gram", gram)
        usage = next((u for x in tries if (u := self._usage(x))), ("hint", ""))
        if usage[0] == "hint" and (gram := next((g for x in tries[1:] if (g := self._gram(x))), None)):
            return Reading("gram", gram)
        return Reading("usg", (Gram(*usage, atom if printed is None else printed),))

    def _spans(self, content: str) -> tuple[tuple[Reading, str], ...]:
        """(reading, printed piece) of each piece of a label."""
        if whole := self.pos(content):
            return ((Reading("gram", whole), content.strip()),)
        folded, source = _ET.split(collapsed(content)), _ET.split(content)
        shown = source if len(source) == len(folded) else folded
        pieces = [(_END.sub("", collapsed(f)).strip(), s.strip()) for f, s in zip(folded, shown, strict=True)]
        return tuple((self.atom(a, s), s) for a, s in pieces if a)
