"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, fitted apart on the two halves of the vectors, form a product grid; every
vector is filed in the cell of its nearest two centroids. A vector visits cells in the
order of their excess, which is by how much the two squared distances to a cell's centroids
pass those of its own cell (the order of a multi-sequence traversal), and stops at the
excess within which the target share of partners is found: for a sample of vectors partners
at exactly the least similarity are drawn, and the excess at which one of the two reaches
the other's cell is taken at ``TARGET``. What is visited is compared exactly.

* The fit sees a bounded sample of vectors (``SAMPLE``); the index holds every one.
* Equal vectors are one representative with its number of copies.
* A cell of more than ``BLOCK`` vectors is split into blocks that visit each other, so a
  task holds one block and streams its visitors past it. Nothing is cut.
* A task hands on link counts and a forest that spans its links, never pairs.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component
links with nothing and is its own component; only vectors of equal length are compared;
rows of one vec_id are vectors of their own that share the id; a row without an id has no
component id and is not kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged
from .components import connected_components

SIMILARITY = 0.95
TARGET = 0.999
SAMPLE = 16_384
OCCUPANCY = 256
MOST_CENTROIDS = 1024
BLOCK = 4096
VISITORS = 1024


def units(matrix):
    """Rows scaled to length 1 in doubles, of any finite magnitude."""
    import numpy as np

    m = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def vector_rows(batches):
    """(row, vec_id, vector) to (row, vec_id, n, key, unit): those that can link, by a digest of the vector."""
    from hashlib import blake2b

    import numpy as np

    for batch in batches:
        column = batch.column(2)
        values = column.flatten()
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
        flat = values.to_numpy(zero_copy_only=False).astype(float)
        ends = np.cumsum(lengths)
        found = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        some = np.concatenate([[0], np.cumsum(flat != 0)])
        fine = (lengths > 0) & (found[ends] == found[ends - lengths]) & (some[ends] > some[ends - lengths])
        n = np.where(fine, lengths, 0)
        keys: list = [None] * len(lengths)
        unit: list = [None] * len(lengths)
        for i in np.flatnonzero(fine).tolist():
            v = flat[ends[i] - lengths[i] : ends[i]] + 0.0  # a negative zero is a zero
            keys[i] = blake2b(v.tobytes(), digest_size=16).digest()
            unit[i] = units(v[None])[0].tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(keys, pa.binary()), pa.array(unit, pa.binary())], ["row", "vec_id", "n", "key", "unit"])


def matrix_of(column, n: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, n)


class Codebook:
    """Two sets of centroids for vectors of one length, and how far a search goes."""

    def __init__(self, sample, rows: int, similarity: float, target: float, seed: int = 17):
        import numpy as np

        rng = np.random.default_rng(seed)
        wished = (rows / OCCUPANCY) ** 0.5
        size = min(MOST_CENTROIDS, max(1, len(sample) // 8), 1 << max(0, round(np.log2(max(1.0, wished)))))
        self.n = sample.shape[1]
        self.half = (self.n + 1) // 2
        self.centroids = [self._fit(x, size, rng) for x in self.halves(sample)]
        self.size = len(self.centroids[0])
        other = rng.normal(size=sample.shape)
        other -= (other * sample).sum(1, keepdims=True) * sample
        length = np.sqrt((other**2).sum(1, keepdims=True))
        away = np.where(length > 1e-9, (1 - similarity**2) ** 0.5 * other / np.maximum(length, 1e-9), 0.0)
        # The copy and its source stand as far apart as a link allows.
        partner = similarity * sample + away
        far, near = self.excess(sample), self.excess(partner)
        there = np.minimum(self._at(far, self.cells(near)), self._at(near, self.cells(far)))
        self.reach = float(np.quantile(there, target)) if len(there) else 0.0

    def halves(self, v):
        return v[:, : self.half], v[:, self.half :]

    @staticmethod
    def _fit(points, size: int, rng, rounds: int = 10):
        import numpy as np

        centre = points[rng.choice(len(points), size, replace=False)].copy()
        for _ in range(rounds):
            near = (-2 * points @ centre.T + (centre**2).sum(1)).argmin(1)
            held = np.bincount(near, minlength=size)
            sums = np.zeros_like(centre)
            np.add.at(sums, near, points)
            centre = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centre)
        return centre

    def excess(self, v):
        """By how much each centroid's squared distance passes the nearest one's, for both halves."""
        out = []
        for x, c in zip(self.halves(v), self.centroids, strict=True):
            d = -2 * x @ c.T + (c**2).sum(1)
            out.append(d - d.min(1, keepdims=True))
        return out

    def cells(self, excess):
        return excess[0].argmin(1) * self.size + excess[1].argmin(1)

    def _at(self, excess, cells):
        import numpy as np

        r = np.arange(len(cells))
        return excess[0][r, cells // self.size] + excess[1][r, cells % self.size]

    def visits(self, v):
        """(row numbers, cells): all cells within reach, in the order of their excess, the own one first."""
        import numpy as np

        first, second = self.excess(v)
        rows, cells, much = [], [], []
        order = np.argsort(second, axis=1, kind="stable")
        ranked = np.take_along_axis(second, order, 1)
        for i in range(self.size):
            # In rising order of the second half, so each row's visits are a prefix.
            n = (first[:, i, None] + ranked <= self.reach).sum(1)
            own = np.repeat(np.arange(len(v)), n)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            rows.append(own)
            cells.append(i * self.size + order[own, place])
            much.append(first[own, i] + ranked[own, place])
        rows, cells, much = (np.concatenate(x) for x in (rows, cells, much))
        home = self.cells((first, second))
        much[cells == home[rows]] = -1.0
        order = np.lexsort((much, rows))
        return rows[order], cells[order], home


def visit_rows(batches, books: dict, blocks: dict):
    """(rep, copies, n, unit) to (n, cell, block, role, rep, copies, unit, home, seen): role 0 is filed, 1 visits."""
    import numpy as np

    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    for batch in batches:
        lengths = batch.column(2).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths).tolist():
            for part in _slices(batch.filter(pa.array(lengths == n)), 2048):
                rep, copies = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                v = matrix_of(part.column(3), n)
                rows, cells, home = books[n].visits(v)
                seen = np.split(cells, np.flatnonzero(np.diff(rows)) + 1)
                out: list[list] = [[] for _ in kinds]
                raw = part.column(3).to_pylist()

                def add(i, cell, block, role, out=out, raw=raw, seen=seen, home=home, rep=rep, copies=copies):
                    own = (n, cell, block, role, rep[i], copies[i], raw[i], home[i], None if role else np.sort(seen[i]))
                    for column, x in zip(out, own, strict=True):
                        column.append(x)

                for i, cell in zip(rows.tolist(), cells.tolist(), strict=True):
                    count = blocks.get((n, cell), 1)
                    mine = int(rep[i]) * 0x9E3779B97F4A7C15 % 2**64 * count >> 64
                    if cell != home[i]:
                        for b in range(count):
                            add(i, cell, b, 1)
                    else:
                        add(i, cell, mine, 0)
                        for b in range(mine + 1, count):
                            add(i, cell, b, 1)
                    if len(out[0]) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], VISITS)
                        for column in out:
                            column.clear()
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], VISITS)


VISITS = ["n", "cell", "block", "role", "rep", "copies", "unit", "home", "seen"]


def _slices(batch, size: int):
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


class Block:
    """The filed vectors of one block; visitors go past in batches."""

    def __init__(self, n: int, cell: int, similarity: float):
        self.n, self.cell, self.similarity, self.parts = n, cell, similarity, []

    def file(self, batch) -> None:
        self.parts.append(batch)

    def close(self):
        import numpy as np

        all_ = pa.concat_batches(self.parts)
        self.parts = []
        self.rep, self.copies = (all_.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
        self.v = matrix_of(all_.column(6), self.n)
        seen = all_.column(8)
        grid = int(max(1, seen.flatten().to_numpy(zero_copy_only=False).max(initial=0) + 1, self.cell + 1))
        self.grid = grid
        self.seen = np.repeat(np.arange(len(self.rep)), seen.value_lengths().to_numpy(zero_copy_only=False)) * grid + seen.flatten().to_numpy(zero_copy_only=False)
        self.label = np.arange(len(self.rep))
        self.links = np.zeros(len(self.rep), np.int64)
        for at in range(0, len(self.rep), VISITORS):
            part = slice(at, at + VISITORS)
            hit = self.v[part] @ self.v.T >= self.similarity
            hit &= np.arange(len(self.rep))[None] > np.arange(at, at + len(hit))[:, None]
            self.links[part] += hit @ self.copies
            self.links += hit.T @ self.copies[part]
            rows = np.flatnonzero(hit.any(1))
            if len(rows):
                self._join(hit[rows], at + rows)

    def _join(self, hit, own=None):
        """Make one the labels of filed vectors that a row of ``hit`` links; each row's label.

        ``own``: the filed vectors that the rows are; None for visitors.
        """
        import numpy as np

        most = len(self.label)
        while True:
            least = np.where(hit, self.label, most).min(1)
            low = self.label
            if own is not None:
                least = np.minimum(least, self.label[own])
                low = low.copy()
                np.minimum.at(low, own, least)
            low = np.minimum(np.where(hit, least[:, None], most).min(0), low)
            # A label stands for all that bear it.
            new = np.arange(most)
            np.minimum.at(new, self.label, low)
            while (new[new] != new).any():
                new = new[new]
            if (new[self.label] == self.label).all():
                return least
            self.label = new[self.label]

    def visit(self, batch):
        """(rep, links, partner) of the visitors that link."""
        import numpy as np

        rep, copies, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 7))
        hit = matrix_of(batch.column(6), self.n) @ self.v.T >= self.similarity
        i, j = np.nonzero(hit)
        if not len(i):
            return None
        # If both see each other's cell, the greater one's visit counts.
        wanted = j * self.grid + home[i]
        place = np.minimum(np.searchsorted(self.seen, wanted), len(self.seen) - 1)
        both = (home[i] < self.grid) & (self.seen[place] == wanted) & (home[i] != self.cell)
        drop = both & (rep[i] < self.rep[j])
        hit[i[drop], j[drop]] = False
        self.links += hit.T @ copies
        rows = np.flatnonzero(hit.any(1))
        if not len(rows):
            return None
        hit = hit[rows]
        return rep[rows], hit @ self.copies, self.rep[self._join(hit)]

    def result(self):
        import numpy as np

        own = np.flatnonzero((self.links > 0) | (self.label != np.arange(len(self.label))))
        return self.rep[own], self.links[own], self.rep[self.label[own]]


def link_rows(batches, similarity: float):
    """Rows sorted by (n, cell, block, role) to (rep, links, partner)."""
    import numpy as np

    now, open_, told = None, False, None
    emit = lambda x: pa.RecordBatch.from_arrays([pa.array(np.asarray(y, np.int64)) for y in x], ["rep", "links", "partner"])
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            n, cell, block, role = keys[a].tolist()
            if told != (n, cell, block):
                if now is not None:
                    if not open_:
                        now.close()
                    yield emit(now.result())
                now, open_, told = None, False, (n, cell, block)
            if role == 0:
                now = now or Block(n, cell, similarity)
                now.file(batch.slice(a, b - a))
            elif now is not None:
                if not open_:
                    now.close()
                    open_ = True
                for part in _slices(batch.slice(a, b - a), VISITORS):
                    found = now.visit(part)
                    if found is not None:
                        yield emit(found)
    if now is not None:
        if not open_:
            now.close()
        yield emit(now.result())


def codebooks(reps: DataFrame, similarity: float, target: float, sample: int = SAMPLE) -> dict[int, Codebook]:
    """A grid for each length of vectors, fitted on at most some ``sample`` of them."""
    import numpy as np

    sizes = {r["n"]: r["c"] for r in reps.groupBy("n").agg(F.count("*").alias("c")).collect()}
    total = sum(sizes.values())
    share = min(2**60, int(2**60 * sample / max(1, total)))
    drawn = reps.where(F.shiftrightunsigned(F.xxhash64("rep", F.lit(29)), 4) <= share).select("n", "unit").toArrow()  # about ``sample`` rows
    lengths = drawn.column(0).to_numpy()
    out = {}
    for n, rows in sizes.items():
        raw = drawn.column(1).filter(pa.array(lengths == n)).to_pylist()
        v = np.frombuffer(b"".join(raw), float).reshape(-1, n) if raw else np.eye(1, n)
        out[n] = Codebook(v, rows, similarity, target)
    return out


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", similarity: float = SIMILARITY, target: float = TARGET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = rows.sparkSession
    named = rows.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    vectors = staged(named.mapInArrow(vector_rows, "row long, vec_id long, n int, key binary, unit binary"), "vectors")
    fine = vectors.where("n > 0")
    reps = staged(fine.groupBy("n", "key").agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("unit").alias("unit")), "representatives")
    books = spark.sparkContext.broadcast(codebooks(reps, similarity, target))  # MOST_CENTROIDS a half at most
    filed = reps.select("n", "unit").mapInArrow(lambda b: home_rows(b, books.value), "n int, cell long, c long").groupBy("n", "cell").agg(F.sum("c").alias("c"))
    large = {(r["n"], r["cell"]): -(-r["c"] // BLOCK) for r in filed.where(F.col("c") > BLOCK).collect()}  # one row a cell, of MOST_CENTROIDS ** 2 at most
    blocks = spark.sparkContext.broadcast(large)
    kinds = "n int, cell long, block int, role int, rep long, copies long, unit binary, home long, seen array<long>"
    visits = reps.select("rep", "copies", "n", "unit").mapInArrow(lambda b: visit_rows(b, books.value, blocks.value), kinds)
    dealt = visits.repartition("n", "cell", "block").sortWithinPartitions("n", "cell", "block", "role")
    links = staged(dealt.mapInArrow(lambda b: link_rows(b, similarity), "rep long, links long, partner long"), "links")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(links.where("rep != partner").select(F.col("rep").alias("u"), F.col("partner").alias("v")))
    of = reps.join(counts, "rep", "left").join(roots.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left").select("n", "key", "rep", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("root"))
    of = staged(of, "classes")
    least = of.groupBy("root").agg(F.min("least").alias("component"))
    told = of.join(least, "root").select("n", "key", "links", "component")
    out = vectors.select("vec_id", "n", "key").join(told, ["n", "key"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("vec_id"))
    discard(links)
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def home_rows(batches, books: dict):
    """(n, unit) to (n, cell, c): rows of each cell in a batch."""
    import numpy as np

    for batch in batches:
        lengths = batch.column(0).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths).tolist():
            book = books[n]
            v = matrix_of(batch.column(1).filter(pa.array(lengths == n)), n)
            cells, counts = np.unique(book.cells(book.excess(v)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), n), pa.int32()), pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], ["n", "cell", "c"])
