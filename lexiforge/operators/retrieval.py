"""Ranked retrieval over posting blocks that know their greatest score.

Rows are numbered in the order of their key, without gaps inside a partition, and a block holds the postings of
one term for ``WIDTH`` numbers: gaps to the block's first number, frequencies, lengths, and
the greatest part of a score that any of its postings can give. Blocks lie where their rows do,
sorted by term and range in each file; only the texts are dealt out, once.

``top`` reads the headers of the terms asked for first. The greatest parts of the terms of a
range, times their weights, bound every score in it; ranges that lack a term hold no row.
The blocks of the ranges with the greatest bounds are decoded, which gives a k-th score, and
then only those whose bound reaches it. All others are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .lookup import words_of
from .postings import blocks_of

WIDTH = 128
#: Ranges whose blocks are read first, for each row wanted.
FIRST = 2


class BlockIndex:
    """The stored blocks of a table; ``n`` and ``mean`` are its rows and their mean length."""

    def __init__(self, df: DataFrame, key: str, text: str, width: int = WIDTH, k1: float = 1.2, b: float = 0.75):
        spark = df.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.key, self.width, self.k1, self.b = key, width, k1, b
        seen = df.agg(F.count("*").alias("n"), F.sum(F.size(words_of(F.col(text)))).alias("words")).first()
        self.n = seen["n"]
        self.mean = (seen["words"] or 0) / self.n if seen["words"] else 1.0
        # Texts are dealt out once, in the order of their keys; a range lies in one partition, so its blocks are whole where they are made.
        dealt = df.select(F.col(key).alias("key"), F.col(text).alias("t")).repartitionByRange(parts, "key").sortWithinPartitions("key").select(F.monotonically_increasing_id().alias("no"), "key", "t")
        range_ = F.floor(F.col("no") / width)
        rows = dealt.select(range_.alias("range"), (F.col("no") - range_ * width).cast("int").alias("gap"), "key", words_of(F.col("t")).alias("w"))
        made = rows.mapInArrow(lambda b: blocks_of(b, width), f"term string, range long, gaps array<int>, tfs array<int>, lengths array<int>, keys array<{dict(df.dtypes)[key]}>")
        made = made.withColumns({"best": F.array_max(F.zip_with("tfs", "lengths", self._part)), "n": F.size("gaps")})
        made = staged(made.sortWithinPartitions("term", "range"), "blocks", codec="zstd")
        keys = made.where("term is null").select("range", F.explode(F.arrays_zip("gaps", "keys")).alias("p"))
        self.rows = staged(keys.select(F.col("p.keys").alias(key), (F.col("range") * width + F.col("p.gaps")).alias("no")), "row_numbers")
        self.blocks = made.where("term is not null").select("term", "range", "best", "n", "gaps", "tfs", "lengths")

    def _part(self, tf: Column, length: Column) -> Column:
        return (tf * (self.k1 + 1)) / (tf + self.k1 * (1 - self.b + self.b * length / self.mean))

    def top(self, query: list[str], k: int, digits: int = 6) -> tuple[DataFrame, dict]:
        """The ``k`` best of the rows that hold every term, as (key, score) by the score rounded to ``digits``, then by key; and how many blocks were read.

        Smaller scores are better, as ``bm25()`` ranks.
        """
        terms = sorted(set(query))
        n = F.lit(float(self.n))
        of = self.blocks.where(F.col("term").isin(terms))
        held = of.groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.greatest(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
        weights = {r["term"]: r["idf"] for r in held.select("term", idf.alias("idf")).collect()}  # a row for each term of the question
        spark = self.blocks.sparkSession
        if len(weights) < len(terms):
            return spark.createDataFrame([], f"`{self.key}` {dict(self.rows.dtypes)[self.key]}, score double"), {"blocks": 0, "read": 0}
        weight = F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("term"))
        bounds = of.groupBy("range").agg(F.sum(weight * F.col("best")).alias("bound"), F.count("*").alias("terms")).where(F.col("terms") == len(terms))
        bounds = staged(bounds.withColumn("bound", F.col("bound") * (1 + 1e-12)), "bounds")
        # The first ranges, by their bounds, give a k-th score to reach.
        first = staged(bounds.orderBy(F.desc("bound"), "range").limit(FIRST * k).select("range"), "first")
        scored = staged(self._scores(of, first, weight, len(terms)), "scored")
        kth = scored.orderBy(F.desc("s")).limit(k).agg(F.count("*").alias("c"), F.min("s").alias("s")).first()
        rest = bounds.join(first, "range", "left_anti")
        if kth["c"] == k:
            rest = rest.where(F.col("bound") >= kth["s"] - 10.0**-digits)
        rest = staged(rest.select("range"), "rest")
        every = scored.unionByName(self._scores(of, rest, weight, len(terms)))
        best = every.select("no", F.round(-F.col("s"), digits).alias("score")).join(self.rows, "no").orderBy("score", self.key).limit(k)
        told = {"blocks": of.count(), "read": len(terms) * (first.count() + rest.count())}
        return best.select(self.key, "score"), told

    def _scores(self, of: DataFrame, ranges: DataFrame, weight: Column, terms: int) -> DataFrame:
        """(no, s) of the rows of some ranges that hold every term."""
        d = of.join(ranges, "range").select("range", weight.alias("w"), F.explode(F.arrays_zip("gaps", "tfs", "lengths")).alias("p"))
        part = F.col("w") * self._part(F.col("p.tfs"), F.col("p.lengths"))
        d = d.groupBy((F.col("range") * self.width + F.col("p.gaps")).alias("no")).agg(F.sum(part).alias("s"), F.count("*").alias("c"))
        return d.where(F.col("c") == terms).select("no", "s")
