"""Lookups: ordered first-match rules, verdict overrides, range and full-outer comparisons, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..staging import staged
from .postings import PACKED, POSTING, packed_postings, unpacked


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule (pattern, label) that matches: an ordered CASE, no join."""
    out = None
    for pattern, label in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def last_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last in ``order`` (then by its own values)."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__last")).select(*keys, "__last.*")


def _against(df: DataFrame, verdicts: DataFrame, keys: list[str], check: str, role: str, order: list[str]) -> DataFrame:
    v = last_of(verdicts.select(*keys, F.col(check).alias("__check"), F.col(role).alias("__role"), *order), keys, order).drop(*order)
    v = v.withColumnsRenamed({k: "__v_" + k for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col("__v_" + k))
    return df.join(v, cond, "left").drop(*["__v_" + k for k in keys])


def override(df: DataFrame, verdicts: DataFrame, keys: list[str], plain: str | Column, default: Column, method: Column | None = None, check: str = "check", role: str = "verdict", order: tuple[str, ...] = ()) -> DataFrame:
    """``role`` and ``method`` of the verdict whose check is empty or opens the text, else ``default`` and ``method``.

    Of several verdicts for one key the last in ``order`` counts, so no row is multiplied.
    ``plain`` may be an expression: it is then worked out behind the join, as column ``plain``.
    """
    d = _against(df, verdicts, keys, check, role, list(order))
    if isinstance(plain, Column):
        d, plain = d.withColumn("plain", plain), "plain"
    fits = F.col("__role").isNotNull() & ((F.coalesce("__check", F.lit("")) == "") | F.startswith(F.coalesce(F.col(plain), F.lit("")), F.col("__check")))
    other = F.lit("Heuristic") if method is None else method
    return d.withColumns({"role": F.when(fits, F.col("__role")).otherwise(default), "method": F.when(fits, "LlmAssisted").otherwise(other)}).drop("__check", "__role")


def mismatches(df: DataFrame, verdicts: DataFrame, keys: list[str], plain: str, check: str = "check", role: str = "verdict", order: tuple[str, ...] = ()) -> DataFrame:
    """(keys, check, actual): verdicts that meet a row whose text their check does not open."""
    d = _against(df, verdicts, keys, check, role, list(order))
    d = d.where((F.coalesce("__check", F.lit("")) != "") & ~F.startswith(F.coalesce(F.col(plain), F.lit("")), F.col("__check")))
    return d.select(*keys, F.col("__check").alias("check"), F.substring(plain, 1, 30).alias("actual"))


def in_ranges(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, bucket: int) -> DataFrame:
    """Points joined to the ranges that hold them, by equal buckets of ``bucket`` units."""
    r = ranges.withColumn("__b", F.explode(F.sequence(F.floor(F.col(low) / bucket), F.floor(F.col(high) / bucket))))
    p = points.withColumn("__b", F.floor(F.col(point) / bucket))
    return p.join(r, "__b").where(F.col(point).between(F.col(low), F.col(high))).drop("__b")


def compare(observed: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """(key, observed, expected, agrees) of a full outer comparison; what lacks is ``missing``."""
    o, e = observed.select(key, F.col(value).alias("observed")), expected.select(key, F.col(value).alias("expected"))
    d = o.join(e, key, "full_outer").withColumns({c: F.coalesce(F.col(c), F.lit("missing")) for c in ("observed", "expected")})
    return d.withColumn("agrees", F.col("observed") == F.col("expected"))


# -- full-text search -------------------------------------------------------------------


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


class Index:
    """A stored inverted index: packed postings lie where their rows do, sorted by term in each file, so a search reads only its terms' pages.

    No posting goes through an exchange, and a frequent term has a row in every portion. ``n`` and ``mean`` are the rows and their mean length. Keys are
    whole numbers; ``unique`` says that no two rows share one, else rows that do are brought together first.
    """

    def __init__(self, df: DataFrame, key: str, text: str, unique: bool = False):
        self.key, self.kind = key, dict(df.dtypes)[key]
        d = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t"))
        d = d if unique else d.repartition("key").sortWithinPartitions("key")
        seen = Observation()
        d = d.select("key", words_of(F.col("t")).alias("w")).observe(seen, F.count("*").alias("n"), F.sum(F.size("w")).alias("words"))
        self.postings = staged(d.mapInArrow(packed_postings, PACKED).sortWithinPartitions("term", "first"), "postings", codec="zstd")
        self.n = seen.get["n"]
        self.mean = (seen.get["words"] or 0) / self.n if seen.get["words"] else 1.0

    def terms(self) -> DataFrame:
        """(term, df, cf) of every term."""
        return self.postings.groupBy("term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf"))

    def search(self, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, score) of the rows that hold every term; smaller is better, as bm25() ranks."""
        terms = sorted(set(query))
        hits = self.postings.where(F.col("term").isin(terms))
        n = F.lit(float(self.n))
        per_term = hits.groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.greatest(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
        weights = F.broadcast(per_term.select("term", idf.alias("idf")))  # a row for each term of the question
        tf = F.col("tf")
        part = F.col("idf") * (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * F.col("length") / self.mean))
        d = hits.select("term", "first", "packed").mapInArrow(unpacked, POSTING).join(weights, "term").groupBy("key").agg(F.sum(part).alias("s"), F.count("*").alias("held"))
        return d.where(F.col("held") == len(terms)).select(F.col("key").cast(self.kind).alias(self.key), (-F.col("s")).alias("score"))
