"""Quality rules: one table of thresholds compiled into Spark projections, without user functions.

Every figure is a built-in expression over one row, so the operator is a scan and a
projection: no shuffle, no Python. Three-word windows are compared by their 64-bit
hash inside one text only.

Defined cases: a null or empty text has no words and fails; blank lines never count as
repeated; figures at a bound are kept; long texts are read whole; repeated rows are judged
alike; an empty table gives no rows. Extra columns pass through; ``quality_rules`` replaces
those that bear the name of a figure, of ``base_failed`` or of ``kept``, ``quality_filter``
returns the columns it was given, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, word_array

#: Frequent function words of the four languages the rules know.
STOP_WORDS = (
    "the of and to in that is was for on are as with they be at this from or had by not but what all were when we there can an your which their said if do will each about how up out them then she "
    "le la les de des du et un une en que qui dans pour est au par sur avec pas plus ne ce se son sa aux il elle ou "
    "der die das und den von zu mit ist im dem nicht ein eine auf für sich als auch es an werden aus er hat dass sie nach bei "
    "el los las y del que se por con no una su para al lo como más pero sus o este sí porque esta entre cuando"
).split()

#: (figure, least, most): a text is kept only if every figure lies in its closed range.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 16.0),
    ("symbol_ratio", None, 0.10),
    ("stop_word_ratio", 0.06, None),
    ("dup_line_ratio", None, 0.50),
    ("bullet_line_ratio", None, 0.90),
    ("ellipsis_line_ratio", None, 0.30),
)

_P = "__lf_q_"


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def quality_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the ratios the thresholds look at."""
    c = lambda name: F.col(_P + name)
    kept = list(docs.columns)
    d = docs.withColumn(_P + "text", F.coalesce(F.col(text), F.lit("")))
    d = d.withColumns({_P + "w": word_array(c("text")), _P + "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(WORD_CLASS))})
    d = d.withColumns(
        {
            _P + "n": F.size(c("w")).cast("long"),
            _P + "chars": F.length(F.array_join(c("w"), "")).cast("long"),
            _P + "symbols": F.regexp_count(c("text"), F.lit(r"[#*$%&|<>]")).cast("long"),
            _P + "nl": F.size(c("lines")).cast("long"),
            _P + "dup": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            _P + "bullets": F.size(F.filter(c("lines"), lambda x: x.rlike(r"^\s*[-*•‣▪]\s"))),
            _P + "dots": F.size(F.filter(c("lines"), lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
            _P + "stops": F.size(F.filter(c("w"), lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?"))).isin(STOP_WORDS))),
            _P + "h": F.when(F.size(c("w")) >= 3, F.transform(F.sequence(F.lit(0), F.size(c("w")) - 3), lambda i: F.xxhash64(F.get(c("w"), i), F.get(c("w"), i + 1), F.get(c("w"), i + 2)))).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Only a text in which some window repeats pays for sorting (window, place) pairs.
    d = d.withColumn(_P + "repeats", F.size(F.array_distinct(c("h"))) < F.size(c("h")))
    d = d.withColumn(_P + "s", F.when(c("repeats"), F.sort_array(F.transform(c("h"), lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    d = d.withColumn(
        _P + "pos",
        F.sort_array(
            F.transform(
                F.filter(c("s"), lambda x, i: ((i > 0) & (F.get(c("s"), i - 1)["h"] == x["h"])) | F.coalesce(F.get(c("s"), i + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["p"],
            )
        ),
    )
    covered = F.aggregate(F.transform(c("pos"), lambda p, i: F.least(F.lit(3), F.coalesce(F.get(c("pos"), i + 1), p + 3) - p)), F.lit(0).cast("long"), lambda a, x: a + x)
    out = {
        "n_words": c("n"),
        "word_chars": c("chars"),
        "n_symbols": c("symbols"),
        "n_dup_lines": c("dup"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        "mean_word_chars": _ratio(c("chars"), c("n")),
        "symbol_ratio": _ratio(c("symbols"), c("n")),
        "stop_word_ratio": _ratio(c("stops"), c("n")),
        "dup_line_ratio": _ratio(c("dup"), c("nl")),
        "bullet_line_ratio": _ratio(c("bullets"), c("nl")),
        "ellipsis_line_ratio": _ratio(c("dots"), c("nl")),
    }
    return d.select(*[F.col(f"`{k}`") for k in kept if k not in out], *[v.alias(k) for k, v in out.items()])


def verdict(thresholds=THRESHOLDS) -> Column:
    """The thresholds as one Boolean expression over the figures."""
    out = F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            out = out & (F.col(name) >= F.lit(least))
        if most is not None:
            out = out & (F.col(name) <= F.lit(most))
    return out


def quality_rules(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """Figures, ``base_failed`` and ``kept`` beside every row of ``docs``."""
    d = quality_figures(docs, text)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", base).withColumn("kept", ~base & verdict(thresholds))


def quality_filter(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    private = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_P + "row"), F.col(text).alias(_P + "in"))
    # The filter refers to a non-deterministic column, so it is not pushed below the
    # projections, where their arrays would be worked out anew for each element.
    judged = quality_rules(private, _P + "in", thresholds).withColumn(_P + "at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col(_P + "at") >= 0)).select(_P + "row.*")
