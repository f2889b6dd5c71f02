"""Centroid clustering by Lloyd rounds over two trees.

A cover tree is a nested net: the children of a node lie within its radius, and no two of
them within the radius of the next level. One is built over each shard of vectors, once,
and kept as a table; one over the centroids of each round. A round goes down both: a pair
of nodes falls when the distance between their centres, less both radii, passes what some
other centroid is known to guarantee for the whole node; a node left with one centroid
gives it to all its vectors; pairs of leaves are compared exactly, in whole numbers.

Sums leave a task as one row a cluster, component and 40-bit limb, so they are exact for
vectors of any magnitude, and the driver sees clusters times components, never vectors.

Defined cases: vectors that are null, of another length than asked, or hold a null or
non-finite component take no part, nor do rows without an id; rows of one id are vectors of
their own; fewer vectors than clusters give as many clusters as vectors; equal centroids:
the smaller number takes all; an empty table gives no rows; a distance or inertia beyond a
long is given as the greatest long; a shard with a component of 2**26 or more is compared
exactly throughout, without its tree; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged

CLUSTERS = 40
ROUNDS = 5
SCALE = 256
LENGTH = 64
SHARD = 1024
STEP = 1.5
SMALL = 1 << 26
LIMB = 40
PAIRS = 1 << 15
_MOST = 2**63 - 1


def scaled(x: float) -> int:
    """floor(SCALE * x), whatever its size."""
    from math import floor

    top, bottom = x.as_integer_ratio()
    return floor(x * SCALE) if abs(x) < 2.0**900 else SCALE * top // bottom


def whole_matrix(raw):
    """Rows of doubles as whole numbers: 64-bit if all are small, else objects."""
    import numpy as np

    if not raw.size or np.abs(raw).max() < SMALL / SCALE:
        return np.floor(raw * SCALE).astype(np.int64)
    return np.array([[scaled(x) for x in row] for row in raw.tolist()], object).reshape(raw.shape)


class Tree:
    """A cover tree in arrays: nodes of one parent lie together, and a node's points are a range of ``order``."""

    def __init__(self, points):
        import numpy as np

        f = points.astype(float)
        order, nodes = [], []
        # (points, their distances to the centre, centre, level radius, parent)
        root = np.sqrt(((f - f[0]) ** 2).sum(1)) if len(f) else np.zeros(0)
        open_ = [(np.arange(len(f)), root, 0, float(root.max(initial=0.0)), -1)]
        while open_:
            after = []
            for own, away, centre, reach, parent in open_:
                number = len(nodes)
                nodes.append([centre, float(away.max(initial=0.0)) * (1 + 1e-12), parent, len(own)])
                if len(own) == 1 or away.max() == 0:
                    order.append((number, own))
                    continue
                reach = min(reach, float(away.max())) / STEP
                rest, far = own, away
                seed, distance = centre, away
                while len(rest):
                    inside = distance <= reach
                    after.append((rest[inside], distance[inside], seed, reach, number))
                    rest, far = rest[~inside], far[~inside]
                    if len(rest):
                        seed = int(rest[far.argmax()])
                        distance = np.sqrt(((f[rest] - f[seed]) ** 2).sum(1))
                        distance[rest == seed] = 0.0
            open_ = after
        self.centre = np.array([x[0] for x in nodes], np.int32)
        self.radius = np.array([x[1] for x in nodes])
        self.parent = np.array([x[2] for x in nodes], np.int32)
        self.leaf = {number: own for number, own in order}
        self._lay_out()

    def _lay_out(self) -> None:
        """First child, number of children and range of points of every node."""
        import numpy as np

        n = len(self.parent)
        self.children = np.bincount(self.parent[1:], minlength=n) if n else np.zeros(0, np.int64)
        self.first = np.zeros(n, np.int64)
        if n > 1:
            self.first[self.parent[1:][::-1]] = np.arange(n - 1, 0, -1)
        size = np.zeros(n, np.int64)
        for number, own in self.leaf.items():
            size[number] = len(own)
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
        self.size, self.start = size, np.zeros(n, np.int64)
        for i in range(n):
            at = self.start[i]
            for c in range(self.first[i], self.first[i] + self.children[i]):
                self.start[c] = at
                at += size[c]
        self.order = np.zeros(int(size[0]) if n else 0, np.int64)
        for number, own in self.leaf.items():
            self.order[self.start[number] : self.start[number] + len(own)] = own
        del self.leaf

    @classmethod
    def of(cls, arrays: dict | None):
        """The tree that ``vars`` told."""
        if arrays is None:
            return None
        out = cls.__new__(cls)
        vars(out).update(arrays)
        return out


def exact_distances(a, b):
    """Squared distances of the rows of two matrices of whole numbers, pair by pair."""
    d = a - b
    return (d * d).sum(1)


def nearest(points, tree: Tree | None, centroids, above: Tree | None):
    """(cluster, squared distance) of each point, exactly; ties go to the smaller number."""
    import numpy as np

    whole = points.dtype != object
    fits = [i for i in range(len(centroids)) if whole and centroids.dtype != object or max(abs(int(x)) for x in centroids[i]) < SMALL]
    if not whole or tree is None or above is None or not fits:
        return _every(points, centroids, range(len(centroids)))
    cluster, distance = _dual(points, tree, centroids[fits].astype(np.int64), above)
    cluster = np.array(fits)[cluster]
    # A small vector lies nearer to any small centroid than to one with a component past 2**32.
    rest = [i for i in range(len(centroids)) if i not in set(fits) and max(abs(int(x)) for x in centroids[i]) < 1 << 32]
    if rest:
        other, far = _every(points.astype(object), centroids, rest)
        better = (far < distance) | ((far == distance) & (other < cluster))
        cluster, distance = np.where(better, other, cluster), np.where(better, far, distance)
    return cluster, distance


def _every(points, centroids, numbers):
    import numpy as np

    best, at = None, np.zeros(len(points), np.int64)
    for i in numbers:
        d = ((points - centroids[i]) ** 2).sum(1) if len(points) else np.zeros(0, object)
        if best is None:
            best, at = d, np.full(len(points), i)
        else:
            less = d < best
            best, at = np.where(less, d, best), np.where(less, i, at)
    return at, best


def _dual(points, tree: Tree, centroids, above: Tree):
    """Descent of both trees, level by level; what is left in the end are single points and centroids."""
    import numpy as np

    f, g = points.astype(float), centroids.astype(float)
    n = len(tree.parent)
    bound = np.full(n, np.inf)  # some centroid is this near to all of a node's points
    cluster, distance = np.full(len(points), -1), np.zeros(len(points), np.int64)
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(v):
        d = np.concatenate([np.sqrt(((f[tree.centre[v[i : i + PAIRS]]] - g[above.centre[c[i : i + PAIRS]]]) ** 2).sum(1)) for i in range(0, len(v), PAIRS)])
        slack = 1e-9 * (d + 1)
        np.minimum.at(bound, v, d + tree.radius[v] + slack)
        # A node of centroids holds its own centre, so the bound needs no second radius.
        keep = d - tree.radius[v] - above.radius[c] - slack <= bound[v]
        v, c = v[keep], c[keep]
        single = above.children[c] == 0
        alone = single & (np.bincount(v, minlength=n)[v] == 1)
        ended = (tree.children[v] == 0) & (np.bincount(v, weights=~single, minlength=n)[v] == 0)
        done = alone | ended
        if done.any():
            _settle(points, tree, centroids, above, v[done], c[done], cluster, distance)
            v, c = v[~done], c[~done]
        # The wider node of a pair is opened.
        down = (above.children[c] > 0) & ((tree.children[v] == 0) | (above.radius[c] >= tree.radius[v]))
        # All pairs of a node are opened on one side, so that they stay together.
        down = down | (np.bincount(v, weights=down, minlength=n)[v] > 0) & (above.children[c] > 0)
        stay = ~down & (np.bincount(v, weights=down, minlength=n)[v] > 0)
        up = ~down & ~stay
        new_v = [v[stay], np.repeat(v[down], above.children[c[down]])]
        new_c = [c[stay], _spread(above.first[c[down]], above.children[c[down]])]
        inherit = _spread(tree.first[v[up]], tree.children[v[up]])
        parents = np.repeat(v[up], tree.children[v[up]])
        bound[inherit] = np.minimum(bound[inherit], bound[parents])
        new_v.append(inherit)
        new_c.append(np.repeat(c[up], tree.children[v[up]]))
        v, c = np.concatenate(new_v), np.concatenate(new_c)
    return cluster, distance


def _spread(first, count):
    import numpy as np

    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


def _settle(points, tree: Tree, centroids, above: Tree, v, c, cluster, distance) -> None:
    """Points of the nodes ``v`` against the centroids left for them: the nearest, exactly."""
    import numpy as np

    sizes = tree.size[v]
    for low, high in _parts(sizes):
        own = tree.order[_spread(tree.start[v[low:high]], sizes[low:high])]
        number = np.repeat(c[low:high], sizes[low:high])
        # A node of centroids without children may stand for equal ones; its least number counts.
        number = above.least[number]
        d = exact_distances(points[own], centroids[number])
        order = np.lexsort((number, d, own))
        own, number, d = own[order], number[order], d[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        own, number, d = own[first], number[first], d[first]
        better = (cluster[own] < 0) | (d < distance[own]) | ((d == distance[own]) & (number < cluster[own]))
        cluster[own[better]], distance[own[better]] = number[better], d[better]


def _parts(sizes):
    """Ranges of rows that make about PAIRS pairs each."""
    import numpy as np

    if not len(sizes):
        return []
    group = np.cumsum(sizes) // PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    return list(zip(cuts, cuts[1:], strict=False))


def centroid_tree(centroids) -> dict | None:
    """The arrays of the tree over the centroids of a round that are small; None if there is none."""
    import numpy as np

    small = [i for i in range(len(centroids)) if max((abs(int(x)) for x in centroids[i]), default=0) < SMALL]
    if not small:
        return None
    tree = Tree(centroids[small].astype(np.int64))
    tree.least = np.array([int(tree.order[a : a + n].min()) for a, n in zip(tree.start.tolist(), tree.size.tolist(), strict=True)], np.int64)
    return vars(tree)


# -- shards ----------------------------------------------------------------------------


def shard_rows(batches, length: int):
    """(vec_id, vector) to one row a shard: ids, whole vectors and their tree, pickled."""
    import pickle

    import numpy as np

    held: list = []

    def made(ids, raw):
        points = whole_matrix(raw)
        tree = vars(Tree(points)) if points.dtype != object else None
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((ids, points, tree))], pa.binary())], ["shard"])

    for batch in batches:
        column = batch.column(1)
        lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        fine = (lengths == length) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        part = batch.filter(pa.array(fine))
        raw = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)
        good = np.isfinite(raw).all(1)
        held.append((part.column(0).to_numpy(zero_copy_only=False)[good].astype(np.int64), raw[good]))
        while sum(len(x) for x, _ in held) >= SHARD:
            ids, raw = (np.concatenate(x) for x in zip(*held, strict=True))
            yield made(ids[:SHARD], raw[:SHARD])
            held = [(ids[SHARD:], raw[SHARD:])]
    ids, raw = (np.concatenate(x) for x in zip(*held, strict=True)) if held else ([], [])
    if len(ids):
        yield made(ids, raw)


def limbs(x: int):
    """(place, limb) of a whole number, the sign with every limb."""
    sign, x, place = (-1 if x < 0 else 1), abs(x), 0
    while x:
        yield place, sign * (x & ((1 << LIMB) - 1))
        x >>= LIMB
        place += 1


def sum_rows(batches, centroids, above):
    """Shards to (cluster, d, place, value): sums of the components by cluster, and counts as component -1."""
    import pickle

    import numpy as np

    k = len(centroids)
    total = np.zeros((k, centroids.shape[1]), object)
    count = np.zeros(k, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            _, points, tree = pickle.loads(raw)
            cluster, _ = nearest(points, Tree.of(tree), centroids, Tree.of(above))
            part = np.zeros(total.shape, points.dtype)
            np.add.at(part, cluster, points)
            total += part
            count += np.bincount(cluster, minlength=k)
    rows = [(i, -1, 0, int(n)) for i, n in enumerate(count.tolist()) if n]
    rows += [(i, d, place, x) for i in np.flatnonzero(count).tolist() for d, y in enumerate(total[i].tolist()) for place, x in limbs(int(y))]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "d", "place", "value"])


def assigned_rows(batches, centroids, above):
    """Shards to (vec_id, cluster, distance)."""
    import pickle

    import numpy as np

    for batch in batches:
        for raw in batch.column(0).to_pylist():
            ids, points, tree = pickle.loads(raw)
            cluster, distance = nearest(points, Tree.of(tree), centroids, Tree.of(above))
            told = np.array([min(_MOST, int(x)) for x in distance.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cluster, pa.int32()), pa.array(told)], ["vec_id", "cluster", "distance"])


def matrix(rows: list[list[int]]):
    """Whole numbers as a matrix, of 64 bits if all are small."""
    import numpy as np

    small = all(abs(x) < SMALL for r in rows for x in r)
    return np.array(rows, np.int64 if small else object)


def cluster_vectors(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", length: int = LENGTH, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    from hashlib import sha256

    spark = rows.sparkSession
    x = F.col(vector)
    fine = (F.size(x) == length) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    own = rows.where(F.col(vec_id).isNotNull() & x.isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("v"))
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = own.orderBy(told, "vec_id", "v").limit(clusters).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [[scaled(float(e)) for e in r["v"]] for r in first]
    forest = staged(own.mapInArrow(lambda b: shard_rows(b, length), "shard binary"), "shards")
    for _ in range(rounds):
        now = spark.sparkContext.broadcast((matrix(centroids), centroid_tree(matrix(centroids))))  # clusters times components
        sums = forest.mapInArrow(lambda b, now=now: sum_rows(b, *now.value), "cluster int, d int, place int, value long")
        found = sums.groupBy("cluster", "d", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        now.unpersist()
        total: dict[tuple[int, int], int] = {}
        for r in found:
            at = (r["cluster"], r["d"])
            total[at] = total.get(at, 0) + (int(r["value"]) << LIMB * r["place"])
        for c in range(len(centroids)):
            if n := total.get((c, -1)):
                centroids[c] = [total.get((c, d), 0) // n for d in range(length)]
    now = spark.sparkContext.broadcast((matrix(centroids), centroid_tree(matrix(centroids))))
    told = staged(forest.mapInArrow(lambda b: assigned_rows(b, *now.value), "vec_id long, cluster int, distance long"), "assigned")
    discard(forest)
    inertia = {r["cluster"]: int(r["s"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [(c, min(_MOST, inertia.get(c, 0)), min(_MOST, sum(inertia.values())), sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in range(len(centroids))]
    facts = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row a cluster
