"""Nested inline markup straightened with a stack of open tags kept in a Catalyst fold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import let

#: A tag, or what stands between tags.
PIECE = r"(<[^>]*>|[^<]+|<)"
EMPHASIS = ("b", "i", "em", "strong")
LINK = "a"
NAME = r"^</?([a-zA-Z][a-zA-Z0-9]*)[^>]*>$"


def straightened(markup: Column, emphasis: tuple[str, ...] = EMPHASIS, link: str = LINK) -> Column:
    """Emphasis within emphasis flattened, links unwrapped.

    Only the outermost of nested emphasis elements keeps its tags; a closing tag closes the
    innermost open element of its name and those open within it, and is dropped if there is
    none. Tags of links go, their text stays. All else is left as it is; null stays null.
    """
    name = lambda piece: F.lower(F.regexp_extract(piece, NAME, 1))
    start = F.struct(F.array().cast("array<string>").alias("open"), F.array().cast("array<int>").alias("drop"))

    def step(a, x):
        open_ = a["open"]
        # The place of the innermost element of this name; 0 if none is open.
        place = F.array_position(F.reverse(open_), x["name"])
        at = F.when(place > 0, F.size(open_) - place + 1).otherwise(F.lit(0)).cast("int")
        after = F.when(~x["shut"], F.concat(open_, F.array(x["name"]))).when(at > 0, F.slice(open_, F.lit(1), at - 1)).otherwise(open_)
        keep = F.when(x["shut"], at == 1).otherwise(F.size(open_) == 0)
        return F.struct(after.alias("open"), F.when(keep, a["drop"]).otherwise(F.concat(a["drop"], F.array(x["i"]))).alias("drop"))

    def of(pieces: Column) -> Column:
        told = F.transform(pieces, lambda p, i: F.struct(name(p).alias("name"), p.startswith("</").alias("shut"), i.alias("i")))
        drop = F.aggregate(F.filter(told, lambda x: x["name"].isin(*emphasis)), start, step, lambda a: a["drop"])
        return let(drop, lambda d: F.array_join(F.filter(pieces, lambda p, i: (name(p) != link) & ~F.array_contains(d, i)), ""))

    return F.when(markup.isNotNull(), let(F.regexp_extract_all(markup, F.lit(PIECE), F.lit(1)), of))
