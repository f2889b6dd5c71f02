"""Windowed sequence operators: carry-forward, identity, scope, neighbours, samples, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import truncate
from .scan import by_size, ranged, running

IDEM = "ID."


def resolve_idem(df: DataFrame, keys: list[str], order: list, author: str = "author", out: str = "resolved_author", hot_rows: int | None = None) -> DataFrame:
    """``ID.`` takes the last named author before it; an empty author stays empty and resets nothing."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = F.col(author)
    named = F.when((a != "") & (a != IDEM), a)

    def told(d: DataFrame, last: Column) -> DataFrame:
        return d.withColumn(out, F.when(a == IDEM, F.coalesce(last, F.lit(IDEM))).otherwise(a))

    def large(d: DataFrame) -> DataFrame:
        return told(running(d, keys, order, lasts={"__named": named}), F.col("__named")).drop("__named")

    return by_size(df, keys, lambda d: told(d, F.last(named, ignorenulls=True).over(w)), large, hot_rows)


def number_repeats(df: DataFrame, keys: list[str], order: list, name: str, hot_rows: int | None = None) -> DataFrame:
    """A name that occurs more than once among ``keys`` gets ``_n`` at each occurrence, in order."""
    by = [*keys, name]
    part = Window.partitionBy(*by)

    def small(d: DataFrame) -> DataFrame:
        n, i = F.count("*").over(part), F.row_number().over(part.orderBy(*order))
        return d.withColumn(name, F.when(n > 1, F.concat(F.col(name), F.lit("_"), i)).otherwise(F.col(name)))

    def large(d: DataFrame) -> DataFrame:
        return running(d, by, order, row="__n").withColumn(name, F.concat(F.col(name), F.lit("_"), "__n")).drop("__n")

    return by_size(df, by, small, large, 1 if hot_rows == 0 else hot_rows)


def islands(df: DataFrame, keys: list[str], order: list, opens: Column, prefix: str = "", hot_rows: int | None = None) -> DataFrame:
    """Rows with ``<prefix>island`` (0 before the first opener), ``<prefix>rank`` in it (0: the opener) and ``<prefix>size`` (followers)."""
    island, rank, size = (prefix + x for x in ("island", "rank", "size"))
    opened = F.coalesce(opens, F.lit(False))
    first = (F.col(island) > 0).cast("long")

    def small(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        d = d.withColumn(island, F.sum(opened.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        inner = Window.partitionBy(*keys, island)
        d = d.withColumn(rank, F.row_number().over(inner.orderBy(*order)) - first)
        return d.withColumn(size, F.count("*").over(inner) - first)

    def large(d: DataFrame) -> DataFrame:
        d = running(d, keys, order, sums={island: opened.cast("long")}, row="__n", marks={"__open": opened})
        d = d.withColumn(rank, F.when(first == 1, F.col("__n") - F.col("__open")).otherwise(F.col("__n"))).drop("__n", "__open")
        # The last row of an island knows its size.
        ends = d.groupBy(*keys, island).agg(F.max(rank).alias(size)).withColumnsRenamed({c: "__e_" + c for c in [*keys, island]})
        same = F.lit(True)
        for c in [*keys, island]:
            same = same & F.col(c).eqNullSafe(F.col("__e_" + c))
        return d.join(ends, same).drop(*["__e_" + c for c in [*keys, island]])

    return by_size(df, keys, small, large, hot_rows)


def neighbours(df: DataFrame, keys: list[str], order: list, text: Column, most: int = 100) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({"prev_text": truncate(F.lag(text).over(w), most), "next_text": truncate(F.lead(text).over(w), most)})


def stratified_sample(df: DataFrame, strata: list[str], identity: list, most: int = 5, seed: int = 42) -> DataFrame:
    """At most ``most`` rows a stratum, by a seeded hash of their identity, with ``bucket_size`` and ``pick``.

    Sizes are an aggregate and the rank is cut at ``most``, so a stratum of any size is
    reduced to a few rows a partition before it is gathered.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *identity))
    ranked = df.withColumn("pick", F.row_number().over(Window.partitionBy(*strata).orderBy(draw, *identity))).where(F.col("pick") <= most)
    sizes = df.groupBy(*strata).agg(F.count("*").alias("bucket_size")).withColumnsRenamed({c: "__s_" + c for c in strata})
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col("__s_" + c))
    return ranked.join(sizes, same).drop(*["__s_" + c for c in strata])


def number_rows(df: DataFrame, order: list, out: str, together: bool = False) -> DataFrame:
    """Gapless numbers from 1 in ``order``, without a window over all rows.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus
    the rows of the partitions before it, of which there are as many figures as partitions.
    ``order`` should tell rows apart; ties are numbered in an arbitrary but gapless way.
    ``together``: as for ``staged``, for the joins that make ``df``.
    """
    d = ranged(df, order, "numbered", together)
    parts = d.groupBy("__part").agg(F.count("*").alias("__rows"))  # a row a partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    numbered = d.join(F.broadcast(parts), F.col("__part") == F.col("__p"))
    numbered = numbered.withColumn(out, F.col("__before") + F.col("__place") + 1).drop("__part", "__place", "__p", "__before")
    numbered.lexiforge_stage = d.lexiforge_stage  # so that it can be discarded once its reader is written
    return numbered


def island_ends(df: DataFrame, keys: list[str], order: str, text: Column, most: int = 80) -> DataFrame:
    """First and last text of each group, cut to ``most`` characters."""
    return df.groupBy(*keys).agg(F.min_by(truncate(text, most), order).alias("first_text"), F.max_by(truncate(text, most), order).alias("last_text"), F.count("*").alias("n"))
