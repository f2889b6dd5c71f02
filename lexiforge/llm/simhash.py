"""SimHash near-duplicates: BK-trees over shards of equal bit blocks.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bit blocks,
so every such link lies inside a shard of equal block values. Each shard is one
BK-tree: a child hangs on the edge that bears its integer Hamming distance to its
parent, and a search follows only edges within ``radius`` of the query's distance. The
trees of a partition are built and searched together, level by level, in numpy.

A broadcast of all shard trees would grow with the corpus, so each shard's queries are
brought to its tree by the shuffle instead. A shard of more than ``SHARD_ROWS``
fingerprints is split: its remaining bits are cut into ``radius + 1`` parts of which again
one must agree, up to ``LEVELS`` times. A dense family then spreads over many tasks and no
link is lost. Equal fingerprints are merged first, and a shard emits a spanning forest of
its links, never all pairs.

Defined cases: a null or blank text has fingerprint zero and links like any other; a
null ``doc_id`` takes part, but is never the smallest id unless its component has no
other; repeated rows repeat their result; long texts are read whole, their votes counted
4,096 shingles at a time; an empty table gives no rows; ``near_duplicates`` reads doc_id
and text only, ``keep_one`` carries all columns, whatever their names.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .common import row_key
from .components import connected_components

RADIUS = 3
SHARD_ROWS, LEVELS = 4096, 3


def fingerprint(text: bytes | None, size: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text's word shingles."""
    import numpy as np
    from xxhash import xxh64_intdigest

    w = text.lower().split() if text else ()
    if not w:
        return 0
    if len(w) <= size:
        return xxh64_intdigest(b" ".join(w), seed)
    join = b" ".join
    h = np.array([xxh64_intdigest(join(t), seed) for t in zip(*(w[i:] for i in range(size)), strict=False)], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 4096):  # bounded scratch space for very long texts
        votes += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > len(h)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", size: int = 3) -> DataFrame:
    """``docs`` with the column ``out``: the fingerprint as a signed long."""
    @F.arrow_udf("long")
    def fp(col: pa.Array) -> pa.Array:
        found = (fingerprint(x, size) for x in col.cast(pa.binary()).to_pylist())
        return pa.array([x - (x >> 63 << 64) for x in found], pa.int64())

    return docs.withColumn(out, fp(F.col(text)))


# -- BK-trees ---------------------------------------------------------------------------


def build_forest(fp, tree):
    """One BK-tree per value of ``tree`` (sorted): (root of each row, edge codes, children).

    Row i is node i. Edge codes are parent * 65 + distance, sorted, each with its child.
    """
    import numpy as np

    n = len(fp)
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    root = np.repeat(first, np.diff(np.r_[first, n]))
    at, rest = root.copy(), np.setdiff1d(np.arange(n), first, assume_unique=True)
    codes, children = [], []
    while len(rest):
        code = at[rest] * 65 + np.bitwise_count(fp[rest] ^ fp[at[rest]]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, who = code[order], rest[order]
        new = np.r_[True, code[1:] != code[:-1]]
        codes.append(code[new])
        children.append(who[new])
        at[who] = np.repeat(who[new], np.diff(np.r_[np.flatnonzero(new), len(who)]))
        rest = np.sort(who[~new])
    if not codes:
        return root, np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, children = np.concatenate(codes), np.concatenate(children)
    order = np.argsort(codes)
    return root, codes[order], children[order]


def search_forest(fp, root, codes, children, radius: int = RADIUS, chunk: int = 4096):
    """Yield (query, node) arrays of all links with node < query, chunk by chunk."""
    import numpy as np

    for start in range(0, len(fp), chunk):
        who = np.arange(start, min(start + chunk, len(fp)))
        at = root[who]
        while len(who):
            d = np.bitwise_count(fp[who] ^ fp[at]).astype(np.int64)
            hit = (d <= radius) & (at < who)
            if hit.any():
                yield who[hit], at[hit]
            low = np.searchsorted(codes, at * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(codes, at * 65 + np.minimum(d + radius, 64), side="right")
            some = high - low
            who = np.repeat(who, some)
            at = children[np.repeat(low - np.r_[0, np.cumsum(some)[:-1]], some) + np.arange(len(who))]
            on = at < who  # ids grow along a branch, so an earlier partner is above every later node
            who, at = who[on], at[on]


def spanning_forest(n: int, links):
    """The least member reachable from each of n rows, by hooking and path halving."""
    import numpy as np

    up = np.arange(n)
    for a, b in links:
        while len(a):
            while (up[up] != up).any():
                up = up[up]
            ra, rb = up[a], up[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
    while (up[up] != up).any():
        up = up[up]
    return up


def shard_links(batches, radius: int, least_rows: int = 100_000):
    """Rows (shard, fp) sorted by shard to rows (u, v) of a spanning forest of each shard's links."""
    import numpy as np

    def solve(shard, fp):
        many = np.r_[False, shard[1:] == shard[:-1]]
        many[:-1] |= many[1:].copy()  # shards of one row have no links
        shard, fp = shard[many], fp[many]
        if not len(fp):
            return None
        bits = fp.view(np.uint64)
        root, codes, children = build_forest(bits, shard)
        up = spanning_forest(len(fp), search_forest(bits, root, codes, children, radius))
        own = np.flatnonzero(up != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[up[own]])], ["u", "v"]) if len(own) else None

    kept: list = []
    size = 0
    for batch in batches:
        shard, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(shard):
            continue
        kept.append((shard, fp))
        size += len(shard)
        if size < least_rows or shard[0] == shard[-1]:
            continue
        shard, fp = (np.concatenate(x) for x in zip(*kept, strict=True))
        cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on in the next batch
        if cut and (out := solve(shard[:cut], fp[:cut])) is not None:
            yield out
        kept, size = [(shard[cut:], fp[cut:])], len(shard) - cut
    if kept:
        shard, fp = (np.concatenate(x) for x in zip(*kept, strict=True))
        if (out := solve(shard, fp)) is not None:
            yield out


def _bits(places: list[int]):
    """The value of some bit places of ``fp``, as one number."""
    runs: list[list[int]] = []
    for x in places:
        if runs and x == runs[-1][-1] + 1:
            runs[-1].append(x)
        else:
            runs.append([x])
    key = F.lit(0).cast("long")
    for run in runs:
        key = key * (1 << len(run)) + F.shiftrightunsigned(F.col("fp"), run[0]).bitwiseAND(F.lit((1 << len(run)) - 1))
    return key


def _cuts(places: list[int], parts: int) -> list[list[int]]:
    return [places[len(places) * i // parts : len(places) * (i + 1) // parts] for i in range(parts)]


def _blocks(route: tuple[int, ...], parts: int) -> tuple[list[int], list[int]]:
    """(the places whose bits agree after the choices of ``route``, the places left)."""
    held, left = [], list(range(64))
    for i in route:
        own = _cuts(left, parts)[i]
        held, left = held + own, [x for x in left if x not in own]
    return held, left


def _split(fps: DataFrame, route: tuple[int, ...], parts: int) -> DataFrame:
    """``fps(fp)`` once for each next part of the bits that ``route`` leaves: (route, value, fp)."""
    keys = []
    for i in range(parts):
        held, _ = _blocks((*route, i), parts)
        number = 0
        for x in (*route, i):
            number = number * (parts + 1) + x + 1
        keys.append(F.struct(F.lit(number).cast("long").alias("route"), _bits(sorted(held)).alias("value")))
    return fps.select(F.explode(F.array(*keys)).alias("k"), "fp").select("k.route", "k.value", "fp")


def shards(fps: DataFrame, radius: int) -> DataFrame:
    """``fps(fp)`` once for each shard it belongs to, (shard, fp); shards that are too large are split once more."""
    from itertools import product

    parts = radius + 1
    done, now, level = [], _split(fps, (), parts), 1
    while level < LEVELS:
        large = now.groupBy("route", "value").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_ROWS).select("route", "value")
        large = staged(large, "large")
        if large.isEmpty():
            break
        done.append(now.join(large, ["route", "value"], "left_anti"))
        dense, routes = now.join(large, ["route", "value"], "left_semi"), {}
        for route in product(range(parts), repeat=level):
            number = 0
            for x in route:
                number = number * (parts + 1) + x + 1
            routes[number] = route
        seen = {r["route"] for r in large.select("route").distinct().collect()}  # parts ** level at most
        deeper = [_split(dense.where(F.col("route") == n).select("fp"), routes[n], parts) for n in sorted(seen)]
        now = deeper[0]
        for x in deeper[1:]:
            now = now.unionByName(x)
        now, level = staged(now, "shards"), level + 1
    for x in done:
        now = now.unionByName(x)
    return now.select(F.xxhash64("route", "value").alias("shard"), "fp")


def link_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct ``fps(fp)`` to links (u, v) that connect exactly what lies within ``radius``.

    Shards that share a number by chance only share a tree: every link is checked by distance.
    """
    spark = fps.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards(fps, radius).repartition(parts, "shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(lambda batches: shard_links(batches, radius), "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``."""
    d = staged(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")), "t", size=size).select("doc_id", "fp"), "fp")
    return components_of(d, radius)


def components_of(d: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The same from staged rows (doc_id, fp)."""
    per = staged(d.groupBy("fp").agg(F.min("doc_id").alias("first")), "fps")
    stars = connected_components(link_fingerprints(per.select("fp"), radius))
    # Fingerprints without links are their own component and skip the join of members.
    comp = per.join(stars.withColumnsRenamed({"u": "fp", "v": "root"}), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = comp.groupBy("root").agg(F.min("first").alias("component_id"))
    named = comp.join(least, "root").select("fp", "component_id")
    return d.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp="fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


# -- similar texts at a wider radius ----------------------------------------------------

SIMILAR_WORDS, SIMILAR_RADIUS, SIMILARITY = 5, 28, 0.8
BINS, KEYS = 128, 6
SIMILAR_ROWS = 20_000  # a larger shard is dealt out by the sizes of its sets
DEVIATIONS = 6  # how far below its mean the agreement of two sketches may lie


def shingle_set(text: bytes | None, size: int = SIMILAR_WORDS):
    """The sorted 64-bit hashes of a text's distinct word shingles; a blank text has the one hash 0."""
    import numpy as np
    from xxhash import xxh64_intdigest

    w = text.lower().split() if text else ()
    if not w:
        return np.zeros(1, "<u8")
    join = b" ".join
    tuples = zip(*(w[i:] for i in range(size)), strict=False) if len(w) > size else [w]
    return np.unique(np.array([xxh64_intdigest(join(t), 42) for t in tuples], dtype="<u8"))


def _mixed(h):
    import numpy as np

    return np.sort((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15))


def shard_keys(h) -> list[int]:
    """The least hash of each class of a set's shingles: two sets share it with the probability of their similarity."""
    import numpy as np

    mixed = _mixed(h)
    classes = (mixed >> np.uint64(50)) % np.uint64(KEYS)
    keys = []
    for k in range(KEYS):
        own = mixed[classes == k]
        keys.append(int(own[0] if len(own) else mixed[0]) ^ k)
    return keys


def sketch(h) -> tuple[int, bytes]:
    """(SimHash, least hash by bin as one byte each) of a shingle set; the byte of a bin without shingles is zero."""
    import numpy as np

    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 4096):
        votes += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = sum(1 << i for i in np.flatnonzero(2 * votes > len(h)).tolist())
    mixed = _mixed(h)
    seen, first = np.unique((mixed % np.uint64(BINS)).astype(np.int64), return_index=True)
    least = np.zeros(BINS, np.uint8)
    least[seen] = (mixed[first] >> np.uint64(40)).astype(np.uint8) | 1
    return fp, least.tobytes()


def may_reach(a, b, least: float):
    """Whether sketches (n, BINS) agree within ``DEVIATIONS`` of what sets of similarity ``least`` do."""
    import numpy as np

    filled = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return same >= least * filled - DEVIATIONS * np.sqrt(least * (1 - least) * filled)


def jaccard(a, b) -> float:
    """The similarity of two sorted sets."""
    import numpy as np

    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def similar_links(batches, radius: int, least: float, least_rows: int = 50_000, least_bytes: int = 1 << 26):
    """Rows (shard, node, fp, sig, own) sorted by shard to a spanning forest (u, v) of each shard's links.

    SimHash and sketch only pass over pairs far below ``least``; a link is a pair whose sets
    (``own``) are that similar. Pairs already connected are not compared again.
    """
    import numpy as np

    def solve(shard, node, fp, sig, own):
        many = np.r_[False, shard[1:] == shard[:-1]]
        many[:-1] |= many[1:].copy()
        if not many.any():
            return None
        at = np.flatnonzero(many)
        shard, node, bits = shard[at], node.take(pa.array(at)), fp[at].view(np.uint64)
        sig = np.frombuffer(b"".join(sig[i] for i in at.tolist()), np.uint8).reshape(-1, BINS)
        sets = [np.frombuffer(own[i], "<u8") for i in at.tolist()]
        size = np.array([len(x) for x in sets])
        root, codes, children = build_forest(bits, shard)
        up = np.arange(len(at))

        def top(x):
            while (up[x] != x).any():
                x = up[x]
            return x

        for a, b in search_forest(bits, root, codes, children, radius, chunk=512):
            for i in range(0, len(a), 8192):  # bounded scratch space, and few pairs that others connect meanwhile
                x, y = a[i : i + 8192], b[i : i + 8192]
                near = (top(x) != top(y)) & (np.minimum(size[x], size[y]) >= least * np.maximum(size[x], size[y]) - 1e-6)
                x, y = x[near], y[near]
                near = may_reach(sig[x], sig[y], least)
                for p, q in zip(x[near].tolist(), y[near].tolist(), strict=True):
                    u, v = p, q
                    while up[u] != u:
                        u = up[u]
                    while up[v] != v:
                        v = up[v]
                    if u != v and jaccard(sets[p], sets[q]) >= least:
                        up[max(u, v)] = min(u, v)
            up = up[up]
        while (up[up] != up).any():
            up = up[up]
        linked = np.flatnonzero(up != np.arange(len(at)))
        return pa.RecordBatch.from_arrays([node.take(pa.array(linked)), node.take(pa.array(up[linked]))], ["u", "v"]) if len(linked) else None

    def columns():
        shard, fp = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in kept]) for i in (0, 2))
        return shard, pa.concat_arrays([b.column(1) for b in kept]), fp, *([x for b in kept for x in b.column(i).to_pylist()] for i in (3, 4))

    kept: list = []
    size = held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        size, held = size + batch.num_rows, held + batch.nbytes
        shard = batch.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on in the next batch
        if (size < least_rows and held < least_bytes) or (cut == 0 and kept[0].column(0)[0].as_py() == shard[-1]):
            continue
        if cut == 0:  # all of this batch is one shard, which may have begun before it
            rest, back = [], len(kept)
            while back and kept[back - 1].column(0)[kept[back - 1].num_rows - 1].as_py() == shard[-1]:
                own = kept[back - 1].column(0).to_numpy(zero_copy_only=False)
                first = int(np.searchsorted(own, shard[-1]))
                rest.insert(0, kept[back - 1].slice(first))
                kept[back - 1] = kept[back - 1].slice(0, first)
                back -= 1
        else:
            rest, kept[-1] = [batch.slice(cut)], batch.slice(0, cut)
        if sum(b.num_rows for b in kept) and (out := solve(*columns())) is not None:
            yield out
        kept = rest
        size, held = sum(b.num_rows for b in kept), sum(b.nbytes for b in kept)
    if kept and (out := solve(*columns())) is not None:
        yield out


def similar_components(rows: DataFrame, d: DataFrame, radius: int = SIMILAR_RADIUS, least: float = SIMILARITY, size: int = SIMILAR_WORDS) -> DataFrame:
    """``rows`` (key, text) and their staged rows (doc_id, key, node, keys) to (node, component_id)."""
    spark = d.sparkSession
    one = d.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"), F.any_value("keys").alias("keys"))
    per = staged(one, "nodes")
    dealt = per.select(F.explode("keys").alias("shard"), "key")
    shared = dealt.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1").select("shard", (F.col("n") > SIMILAR_ROWS).alias("large"))
    # Only texts that share a key bring their sets to the shards, each shard's as often as it is shared.
    wanted = staged(dealt.join(shared, "shard").groupBy("key").agg(F.collect_set(F.struct("shard", "large")).alias("shards")), "shared")

    @F.arrow_udf("struct<node: binary, fp: long, sig: binary, own: binary>")
    def sk(col: pa.Array) -> pa.Array:
        out = []
        for x in col.cast(pa.binary()).to_pylist():
            h = shingle_set(x, size)
            fp, sig = sketch(h)
            out.append({"node": node_of(h), "fp": signed(fp), "sig": sig, "own": h.tobytes()})
        return pa.array(out, pa.struct([("node", pa.binary()), ("fp", pa.int64()), ("sig", pa.binary()), ("own", pa.binary())]))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = rows.join(wanted, "key").select("shards", sk(F.col("text")).alias("s")).select(F.explode("shards").alias("k"), "s.*")
    # Sets that are similar enough differ in size by one band at most, so each goes to its own band and the next.
    band = F.floor(F.log(F.octet_length("own") / 8) / math.log(1.001 / least))
    bands = F.array(*[F.xxhash64("k.shard", band + i) for i in (0, 1)])
    sets = sets.select(F.explode(F.when(F.col("k.large"), bands).otherwise(F.array("k.shard"))).alias("shard"), "node", "fp", "sig", "own")
    links = sets.repartition(parts, "shard").sortWithinPartitions("shard", "node").mapInArrow(lambda b: similar_links(b, radius, least), "u binary, v binary")
    stars = connected_components(links)
    comp = per.select("node", "first").join(stars.withColumnsRenamed({"u": "node", "v": "root"}), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = comp.groupBy("root").agg(F.min("first").alias("component_id"))
    return comp.join(named, "root").select("node", "component_id")


def signed(x: int) -> int:
    return x - (x >> 63 << 64)


def node_of(h) -> bytes:
    """128 bits that tell a shingle set."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(h.tobytes(), 7)


def keep_one(docs: DataFrame, text: str = "text", size: int = SIMILAR_WORDS, radius: int = SIMILAR_RADIUS, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group of similar texts: its smallest id.

    Texts are grouped whose sets of five-word shingles have a Jaccard similarity of 0.8 or
    more, worked out from the sets (told by 64-bit hashes). Candidates are the texts that
    share the least hash of one of six classes of shingles; sets of similarity s share each
    with probability s, so a pair of 0.8 is missed once in 15,000, more similar ones less
    often. Inside these shards the BK-trees' radius of 28 of 64 bits (such texts differ in
    10 to 12 on average) and the sketches only pass over what lies five or six deviations
    off. A shard of more than ``SIMILAR_ROWS`` texts is dealt out by bands of set sizes, which
    loses no pair. Of rows that repeat the smallest id, the least by text hash stays.
    """
    kept = list(docs.columns)
    key = row_key(F.col(text), *[F.col(f"`{c}`").cast("string") for c in kept if c != text])

    @F.arrow_udf("struct<node: binary, keys: array<long>>")
    def sk(col: pa.Array) -> pa.Array:
        found = (shingle_set(x, size) for x in col.cast(pa.binary()).to_pylist())
        return pa.array([{"node": node_of(h), "keys": [signed(k) for k in shard_keys(h)]} for h in found], pa.struct([("node", pa.binary()), ("keys", pa.list_(pa.int64()))]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.col(text).alias("text"))
    d = staged(rows.select("doc_id", "key", sk(F.col("text")).alias("s")).select("doc_id", "key", "s.*"), "sketches")
    named = similar_components(rows.select("key", "text"), d, radius, least, size)
    own = d.select("doc_id", "key", "node").join(named, "node").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    each = own.groupBy("component_id", "key").agg(F.count("*").alias("n"))
    chosen = staged(each.groupBy("component_id").agg(F.min(F.struct("key", "n")).alias("s")).select(F.col("component_id").alias("__lf_c"), F.col("s.key").alias("__lf_k"), F.col("s.n").alias("__lf_n")), "chosen")
    marked = docs.withColumns({"__lf_id": F.col("doc_id").cast("long"), "__lf_key": key})
    out = marked.join(chosen, (F.col("__lf_key") == F.col("__lf_k")) & F.col("__lf_id").eqNullSafe(F.col("__lf_c")), "left_semi").select(*[F.col(f"`{c}`") for c in kept])
    return out if chosen.where("__lf_n > 1").isEmpty() else out.distinct()
