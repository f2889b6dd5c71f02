"""Exact top-k by inner product with vector-approximation files.

The file: every vector is quantised once, to one byte a component on a grid laid by each
component's least and greatest value, and the cells are a stored table of their own, a
small part of the vectors. A search has three steps.

1. *Scan of the cells.* Each task takes a block of queries through its cells with one
   matrix product. A cell's centre gives a score, and the half widths of all cells, the
   same for every vector, give how far the exact score can lie from it. A task carries
   each query's k-th best lower bound from batch to batch and hands on only what can still
   reach it; the k-th best lower bound over all tasks then cuts the rest.
2. *Exact vectors, best bounds first.* For each query the ``READ`` * k vectors of the
   greatest bounds are read by id and scored exactly.
3. *Until the k-th is certain.* Only where a remaining bound reaches the k-th exact score
   are more vectors read; equal bounds are, for their ids could win a tie.

Queries are dealt in blocks of bounded size (``BLOCK_BYTES``): a stated query set against
all rows, one scan of the cells a block, one block after the other. Exact scores are sums of whole numbers: in doubles
where these hold them, else in numbers of any size.

Defined cases: vectors that are null or hold a null or non-finite component, and rows
without an id, take no part; finite components of any size do; only vectors of equal length are compared, empty ones have
score 0; a repeated vec_id is a candidate as often as it occurs and never its own query's;
equal query rows are one query, rows of one vec_id with different vectors are queries of
their own; ties go to the smaller vec_id; a score beyond a long is given as the nearest
long, after ranking by the exact one; an empty table, or no queries, give no rows; columns
beyond id and vector are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import scratch, staged

SCALE = 256
CELLS = 256
READ = 4
BLOCK_BYTES = 1 << 25
_LONG = 2**63


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(SCALE * x) / SCALE of each component, of the vectors that take part.

    The quotient is a double whatever the size of x, where the whole number itself might be none.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    d = rows.where(F.col(vector).isNotNull() & F.col(vec_id).isNotNull()).where(fine)
    # Beyond 2**44 a multiple of SCALE is whole already, and a long could not hold it.
    whole = F.transform(x, lambda e: F.when(F.abs(e) < float(1 << 44), F.floor(e * SCALE).cast("double") / SCALE).otherwise(e))
    return d.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))  # a negative zero stays zero in every sum


def whole_number(x: float) -> int:
    """SCALE * x of a component, exactly."""
    return int(x * SCALE) if abs(x) < 2.0**900 else int(x) * SCALE


class Grid:
    """Least value and cell width of each component, for the vectors of one length."""

    def __init__(self, low, high):
        import numpy as np

        self.low = np.array(low, float)
        # In halves, for the whole range may exceed the greatest double.
        self.width = np.maximum((np.array(high, float) / 2 - self.low / 2) / (CELLS / 2), 2.0**-28)
        self.reach = np.maximum(np.abs(self.low), np.abs(np.array(high, float)))

    def cells(self, v):
        import numpy as np

        return np.clip(np.floor(v / self.width - self.low / self.width), 0, CELLS - 1).astype(np.uint8)

    def approximate(self, q, cells):
        """(scores of the cells' centres, how far exact scores can lie from them) for rows of queries."""
        import numpy as np

        with np.errstate(over="ignore", invalid="ignore"):
            centre = (q @ (self.low + self.width / 2))[:, None] + (q * self.width) @ cells.astype(np.float64).T
            size = np.abs(q)
            # Half a cell, and what doubles lose on the way.
            slack = size @ self.width * 0.5 * (1 + 1e-9) + (size @ (self.reach + self.width)) * (len(self.low) + 4) * 2.0**-51
            return np.nan_to_num(centre, nan=0.0, posinf=0.0, neginf=0.0), np.where(np.isfinite(slack) & np.isfinite(centre).all(axis=1), slack, np.inf)


def matrix_of(column, n: int):
    """The rows of an array column, all of length ``n``, as a matrix."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n) if n else np.zeros((len(column), 0))


def by_length_of(sizes):
    """(length, row numbers) of rows of these lengths."""
    import numpy as np

    return [(n, np.flatnonzero(sizes == n)) for n in np.unique(sizes).tolist()]


def by_length(batch, at: int):
    """(length, row numbers) of an array column."""
    import numpy as np

    return by_length_of(np.diff(batch.column(at).offsets.to_numpy()))


def extremes(batches):
    """(vec_id, v) to each component's least and greatest value in a batch: (n, d, low, high)."""
    import numpy as np

    for batch in batches:
        for n, own in by_length(batch, 1):
            if n:
                v = matrix_of(batch.column(1).take(pa.array(own)), n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, n, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(v.min(axis=0)), pa.array(v.max(axis=0))], ["n", "d", "low", "high"])


def cell_rows(batches, grids: dict):
    """(vec_id, v) to (vec_id, n, cells)."""
    import numpy as np

    for batch in batches:
        for n, own in by_length(batch, 1):
            part = batch.take(pa.array(own))
            cells = grids[n].cells(matrix_of(part.column(1), n))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(own), n, np.int32)), pa.array([c.tobytes() for c in cells], pa.binary())], ["vec_id", "n", "cells"])


def scan_cells(batches, blocks: dict, grids: dict, k: int):
    """(vec_id, n, cells) to what can still be among the k best of a query: (q, vec_id, low, high)."""
    import numpy as np

    held = {n: np.full((len(q), k), -np.inf) for n, (_, _, q) in blocks.items()}  # the k best lower bounds so far
    for batch in batches:
        ids, lengths = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths).tolist():
            if n not in blocks:
                continue
            own = np.flatnonzero(lengths == n)
            cells = np.frombuffer(b"".join(batch.column(2).take(pa.array(own)).to_pylist()), np.uint8).reshape(len(own), n)
            number, q_ids, q = blocks[n]
            for at in range(0, len(q), 512):
                part = slice(at, min(at + 512, len(q)))
                centre, slack = grids[n].approximate(q[part], cells)
                low, high = centre - slack[:, None], centre + slack[:, None]
                same = q_ids[part, None] == ids[own][None, :]
                low[same] = high[same] = -np.inf
                best = np.concatenate([held[n][part], low], axis=1)
                held[n][part] = -np.partition(-best, k - 1, axis=1)[:, :k]
                row, col = np.nonzero((high >= held[n][part].min(axis=1)[:, None]) & ~same)
                if len(row):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (number[part][row], ids[own][col], low[row, col], high[row, col])], ["q", "vec_id", "low", "high"])


def exact_scores(a, b) -> list[int]:
    """Inner products, in whole numbers, of the rows of two matrices of components over SCALE."""
    import numpy as np

    if not a.shape[1]:
        return [0] * len(a)
    with np.errstate(over="ignore"):
        sizes = np.abs(a).max(axis=1) * np.abs(b).max(axis=1) * a.shape[1]
    fits = sizes < 2.0**53 / SCALE**2
    out: list[int] = [0] * len(a)
    for i, s in zip(np.flatnonzero(fits).tolist(), np.einsum("ij,ij->i", a[fits] * SCALE, b[fits] * SCALE).tolist(), strict=True):
        out[i] = int(s)
    for i in np.flatnonzero(~fits).tolist():
        out[i] = sum(whole_number(x) * whole_number(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True))
    return out


def score_rows(batches):
    """(q, query_id, vec_id, qv, v) to (q, query_id, vec_id, score, exact): ``exact`` sorts as the number does."""
    import numpy as np

    names = ["q", "query_id", "vec_id", "score", "exact"]
    for batch in batches:
        for n, own in by_length(batch, 3):
            part = batch.take(pa.array(own))
            alike = np.diff(part.column(4).offsets.to_numpy()) == n
            part = part.filter(pa.array(alike))
            s = exact_scores(matrix_of(part.column(3), n), matrix_of(part.column(4), n))
            clipped = [max(-_LONG, min(_LONG - 1, x)) for x in s]
            # Sign, count of digits, digits: as text these rank like the numbers.
            told = [f"1{len(str(x)):05d}{x}" if x >= 0 else "0" + "".join(chr(105 - ord(c)) for c in f"{len(str(-x)):05d}{-x}") for x in s]
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(3)], pa.array(clipped, pa.int64()), pa.array(told, pa.string())], names)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each row of ``queries`` against all ``rows``."""
    spark = rows.sparkSession
    named = integer_vectors(queries, vec_id, vector).distinct().withColumn("n", F.size("v")).withColumn("q", F.monotonically_increasing_id())
    asked = staged(named, "queries")  # written once, so each keeps its number
    data = integer_vectors(rows, vec_id, vector)
    ends = data.mapInArrow(extremes, "n int, d int, low double, high double").groupBy("n", "d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    grids: dict[int, Grid] = {0: Grid([], [])}
    found: dict[int, list] = {}
    for r in ends.orderBy("n", "d").collect():  # one row a component
        found.setdefault(r["n"], []).append((r["low"], r["high"]))
    for n, x in found.items():
        grids[n] = Grid([a for a, _ in x], [b for _, b in x])
    shared = spark.sparkContext.broadcast(grids)
    cells = staged(data.mapInArrow(lambda b: cell_rows(b, shared.value), "vec_id long, n int, cells binary"), "cells")

    total = asked.agg(F.count("*"), F.max("n")).first()
    bounds = scan_blocks(asked, cells, shared, k, max(1, -(-(total[0] * 8 * max(1, total[1] or 1)) // BLOCK_BYTES)))
    best = Window.partitionBy("q").orderBy(F.desc("low"))
    least = bounds.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("q").agg(F.min("low").alias("sure"), F.count("*").alias("c"))
    least = least.select("q", F.when(F.col("c") < k, F.lit(float("-inf"))).otherwise(F.col("sure")).alias("sure"))
    left = bounds.join(least, "q").where(F.col("high") >= F.col("sure")).groupBy("q", "vec_id").agg(F.max("high").alias("high"))
    left = staged(left.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("high"), "vec_id"))), "open")

    def read(wanted: DataFrame) -> DataFrame:
        pairs = wanted.select("q", "vec_id").join(data, "vec_id")
        pairs = pairs.join(asked.select("q", F.col("vec_id").alias("query_id"), F.col("v").alias("qv")), "q")
        return pairs.select("q", "query_id", "vec_id", "qv", "v").mapInArrow(score_rows, "q long, query_id long, vec_id long, score long, exact string")

    ranked = Window.partitionBy("q", "query_id").orderBy(F.desc("exact"), "vec_id")
    first = staged(read(left.where(F.col("r") <= READ * k)), "first")
    kth = first.withColumn("r", F.row_number().over(ranked)).where(F.col("r") == k).groupBy("q").agg(F.min("score").alias("kth"))
    # The k-th score in the bounds' unit, rounded down; what a long cannot hold rules nothing out.
    floor = F.when(F.col("kth") > -_LONG, F.col("kth").cast("double") * (1 - F.signum("kth") * 2.0**-52) / SCALE**2)
    rest = staged(left.where(F.col("r") > READ * k).join(kth, "q", "left").where(floor.isNull() | (F.col("high") >= floor)), "rest")
    every = first if rest.isEmpty() else first.unionByName(read(rest))
    return every.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scan_blocks(asked: DataFrame, cells: DataFrame, grids, k: int, blocks: int) -> DataFrame:
    """Bounds (q, vec_id, low, high) of what the scans leave open, one block of queries after the other.

    A block's bounds are added to one table and its broadcast is destroyed before the next
    block is read, so driver, executors and plan hold one block, however many there are.
    """
    spark = asked.sparkSession
    path, schema = scratch(spark, "bounds"), "q long, vec_id long, low double, high double"
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b) if blocks > 1 else asked
        shared = spark.sparkContext.broadcast(_packed(block))
        cells.mapInArrow(lambda x, own=shared: scan_cells(x, own.value, grids.value, k), schema).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


def _packed(block: DataFrame) -> dict:
    """{length: (q, vec_id, vectors)} of one block, about BLOCK_BYTES."""
    import numpy as np

    held = block.select("q", "vec_id", "v", "n").toArrow()
    out = {}
    for n, own in by_length_of(held.column(3).to_numpy()):
        part = held.take(pa.array(own)).combine_chunks()
        flat = part.column(2).combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        out[n] = (part.column(0).to_numpy(), part.column(1).to_numpy(), matrix_of(flat, n) if n else np.zeros((len(own), 0)))
    return out
