"""Text functions as Column expressions; only NFKD needs Python (an Arrow batch function)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What (?U)\s matches.
SPACES = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def collapse_ws(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_tags(c: Column) -> Column:
    return strip(F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, "<[^>]+>", "")).otherwise(c))


def escape_xml(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


@F.arrow_udf(StringType())
def nfkd(col: pa.Array) -> pa.Array:
    from unicodedata import normalize

    return pa.array([None if x is None else x if x.isascii() else normalize("NFKD", x) for x in col.to_pylist()], pa.string())


def slugify(c: Column) -> Column:
    ascii_ = F.regexp_replace(nfkd(F.lower(c)), r"[^\x00-\x7F]", "")
    return F.regexp_replace(F.regexp_replace(ascii_, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def make_id(headword: Column, index: Column | None = None) -> Column:
    s = slugify(headword)
    s = F.when(s.rlike("^[a-z]"), s).otherwise(F.concat(F.lit("e_"), s))
    return s if index is None else F.when(index.isNull(), s).otherwise(F.concat(s, F.lit("."), index.cast("string")))


def reference_id(ref: Column) -> Column:
    """Where a cross-reference points: the part before '#', a trailing .N outside the slug."""
    head = F.split_part(ref, F.lit("#"), F.lit(1))
    number = F.regexp_extract(head, r"\.(\d+)$", 1)
    base = make_id(F.regexp_replace(head, r"\.\d+$", ""))
    return F.when(number == "", base).otherwise(F.concat(base, F.lit("."), number))


def collapse_content(c: Column) -> Column:
    return strip(F.regexp_replace(F.lower(F.regexp_replace(c, "<[^>]+>", "")), r"(?U)\s+", " "))


def normalize_atom(c: Column) -> Column:
    return strip(F.regexp_replace(collapse_content(c), r"[.,;:]+$", ""))


def split_atoms(c: Column, separator: str = r"(?U)\s+et\s+") -> Column:
    return F.filter(F.transform(F.split(collapse_content(c), separator), lambda x: strip(F.regexp_replace(x, r"[.,;:]+$", ""))), lambda x: x != "")


def form_before_comma(plain: Column, most: int = 60) -> Column:
    """The text before the first comma, if there is a comma and it is short enough."""
    head = strip(F.substring_index(plain, ",", 1))
    return F.when(F.contains(plain, F.lit(",")) & (F.length(head) <= most) & (head != ""), head)


#: The centuries a label can name, from nine.
ROMANS = ("IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX")


def century_range(label: Column) -> Column:
    """``XVIe s.`` to struct(lo 1501, hi 1600); null for anything else."""
    roman = F.upper(F.regexp_extract(label, r"(?u)^\s*([IVXivx]+)\s*e?\s*(?:s\.|siècle)", 1))
    n = F.array_position(F.array(*[F.lit(r) for r in ROMANS]), roman).cast("int") + 8
    return F.when(n > 8, F.struct(((n - 1) * 100 + 1).alias("lo"), (n * 100).alias("hi")))


def century_label(label: Column) -> Column:
    r = century_range(label)
    return F.concat_ws("-", F.lpad(r["lo"].cast("string"), 4, "0"), F.lpad(r["hi"].cast("string"), 4, "0"))


def is_balanced(markup: Column) -> Column:
    """Whether tags never close more than is open and all end closed."""
    tags = F.filter(F.regexp_extract_all(markup, F.lit(r"<[^>]+>"), F.lit(0)), lambda t: ~t.endswith("/>"))
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("low"))

    def step(a, t):
        d = a["d"] + F.when(t.startswith("</"), -1).otherwise(1)
        return F.struct(d.alias("d"), F.least(a["low"], d).alias("low"))

    return F.aggregate(tags, start, step, lambda a: (a["d"] == 0) & (a["low"] >= 0))
