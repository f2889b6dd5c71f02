"""Running figures over groups of any size.

A window over a group puts the group into one task. Here only groups of at most ``HOT_ROWS``
rows are left to windows; the rows of a larger one are range-partitioned by key and order, so
that it is spread over many tasks. Each task scans its own segment; a segment hands on one
row (its size, sums and last values), and what lies before a segment is a window over these
few rows. Both ways give the same figures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged

HOT_ROWS = 1 << 20
#: For groups that are known to be small, such as what is in one text.
SMALL = -1
_PLACE = (1 << 33) - 1


def _same(keys: list[str], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def ranged(df: DataFrame, order: list, label: str = "ranged", together: bool = False) -> DataFrame:
    """Rows in range partitions as a table, with ``__part`` and their ``__place`` in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The lower 33 bits of a monotonic id count within a partition.
    return staged(d.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))}), label, together, "zstd" if together else "snappy")


def running(df: DataFrame, keys: list[str], order: list, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, row: str = "", marks: dict[str, Column] | None = None) -> DataFrame:
    """Figures of each row among the rows of its key up to it, by segments.

    ``sums``: running sums; ``lasts``: the last value so far that is not null; ``row``: a
    column for the row's number from 1; ``marks``: the number of the last row so far where a
    condition holds (null before it). ``order`` should tell the rows of a key apart.
    """
    sums, lasts, marks = sums or {}, lasts or {}, marks or {}
    own = df.columns
    d = df.withColumns({**{"__s_" + n: c for n, c in sums.items()}, **{"__l_" + n: c for n, c in lasts.items()}, **{"__m_" + n: c for n, c in marks.items()}})
    d = ranged(d, [*keys, *order], "segments")
    at = Window.partitionBy("__part", *keys).orderBy("__place")
    w = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__row", F.row_number().over(at).cast("long"))
    local = {"__s_" + n: F.sum("__s_" + n).over(w) for n in sums} | {"__l_" + n: F.last("__l_" + n, ignorenulls=True).over(w) for n in lasts}
    local |= {"__m_" + n: F.max(F.when(F.col("__m_" + n), F.col("__row"))).over(w) for n in marks}
    d = d.withColumns(local)
    # One row a segment: what its last row knows.
    end = d.groupBy("__part", *keys).agg(F.max("__row").alias("__n"), *[F.max_by(c, "__place").alias(c) for c in local])
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    end = end.withColumn("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    end = end.withColumns({f"__m_{n}": F.col(f"__m_{n}") + F.col("__b") for n in marks})
    carried = {f"__c_s_{n}": F.sum(f"__s_{n}").over(before) for n in sums} | {f"__c_l_{n}": F.last(f"__l_{n}", ignorenulls=True).over(before) for n in lasts} | {f"__c_m_{n}": F.max(f"__m_{n}").over(before) for n in marks}
    end = end.withColumns(carried).select(F.col("__part").alias("__k___part"), *[F.col(k).alias("__k_" + k) for k in keys], "__b", *carried)
    d = d.join(end, _same(["__part", *keys], "__k_"))
    out = {n: F.coalesce(f"__c_s_{n}", F.lit(0)) + F.coalesce(f"__s_{n}", F.lit(0)) for n in sums}
    out |= {n: F.coalesce(f"__l_{n}", f"__c_l_{n}") for n in lasts}
    out |= {n: F.coalesce(F.col(f"__m_{n}") + F.col("__b"), F.col(f"__c_m_{n}")) for n in marks}
    if row:
        out[row] = F.col("__row") + F.col("__b")
    return d.select(*[c for c in own if c not in out], *[c.alias(n) for n, c in out.items()])


def by_size(df: DataFrame, keys: list[str], small: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame], hot_rows: int | None = None) -> DataFrame:
    """``small`` for the rows of keys with at most ``hot_rows`` rows (of all keys, if it is ``SMALL``), ``large`` for those of all others."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if hot_rows == SMALL:
        return small(df)
    hot = staged(df.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*[F.col(k).alias("__h_" + k) for k in keys]), "hot")
    if hot.isEmpty():
        return small(df)
    same = _same(keys, "__h_")
    cold = df.join(hot, same, "left_anti")
    return small(cold).unionByName(large(df.join(hot, same, "left_semi")))


def items_before(df: DataFrame, order: list[str], size: Column, out: str) -> DataFrame:
    """Rows with ``out``, the sum of ``size`` over all rows before them in ``order``, whose columns tell rows apart.

    Only the order and the sizes are sorted; the rows themselves are joined to their figure.
    """
    d = ranged(df.select(*order, F.coalesce(size, F.lit(0)).cast("long").alias("__size")), order, "sizes")
    at = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    parts = d.groupBy("__part").agg(F.sum("__size").alias("__all"))  # a row a partition
    parts = parts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__all").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    d = d.withColumn("__here", F.coalesce(F.sum("__size").over(at), F.lit(0))).join(F.broadcast(parts), F.col("__part") == F.col("__p"))
    d = d.select(*[F.col(c).alias("__k_" + c) for c in order], (F.col("__base") + F.col("__here")).alias(out))
    return df.join(d, _same(order, "__k_")).drop(*["__k_" + c for c in order])
