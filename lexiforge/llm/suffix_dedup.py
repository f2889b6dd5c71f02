"""Suffix-array dedup of long repeated byte strings, built one suffix bucket at a time.

What is removed: every byte covered by a ``length``-byte window whose bytes also start
earlier (a smaller doc_id, or the same document further left).

How the order of all windows is found without one global suffix array:

1. *Buckets.* In each window the k-byte gram of least hash (leftmost on ties) is its
   anchor. Equal windows have equal anchors at equal offsets, so windows fall into
   buckets by anchor hash, and a run of neighbouring windows with the same anchor
   travels as one context instead of one row a suffix. A bucket with a single context
   holds no repeat and goes no further.
2. *Blockwise sort.* Buckets are sorted block by block with a difference cover modulo 7,
   {0, 1, 3}: the cover sample of a block is ranked first, by prefix doubling from one
   cover position to the next (closed under +7). Then the suffixes are sorted by their
   first seven bytes, and ties between any two of them are resolved by the ranks of the
   two cover positions at their common offset, so no comparison reads further than that.
3. Neighbours in suffix order that share ``length`` bytes form classes, and every
   window but the earliest of its class is repeated.

Equal contexts, known by 128 bits of hash beside their anchor's 64, are resolved without their bytes: all but the
first are repeated as a whole. Each task does so for its own rows before the shuffle, so
thousands of copies of a passage or of a document reach a bucket as one row a task.
Only buckets that hold different contexts fetch bytes and are sorted. A bucket of more than
``BUCKET_CONTEXTS`` different contexts is not sorted in one task: its windows are spread
over all tasks and told by 128 bits of hash.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; longer
ones than a piece are read in overlapping pieces; a null doc_id comes before all others (or
with the least long, if both occur); rows equal in doc_id and text are one document and
repeat its result; documents that share a doc_id but not a text are ordered by SHA-256; an
empty table gives no rows; other columns are carried, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..staging import staged
from .common import LEAST

LENGTH = 100
GRAM = 36
PERIOD, COVER = 7, (0, 1, 3)
PIECE = 1 << 20
PLACE_BITS = 22  # pieces laid end to end are shorter than two pieces and a window
BUCKET_CONTEXTS = 20_000
BLOCK = 1 << 20
MERGE = 200_000
_SALT = 0x9E3779B97F4A7C15


# -- anchors ----------------------------------------------------------------------------


def gram_hashes(data, gram: int = GRAM):
    """64-bit hashes of all ``gram``-byte strings, by doubling."""
    import numpy as np

    rng = np.random.default_rng(20240501)
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64)
    h, width = letters[data], 1
    by_width = {1: h}
    while width * 2 <= gram:
        m = np.uint64((_SALT * (2 * width + 1) | 1) & (2**64 - 1))
        if not gram & width:
            by_width.pop(width)  # only widths that make up the gram are asked for again
        longer = h[:-width] * m
        longer += h[width:]
        width *= 2
        h = by_width[width] = longer
    done, out = width, h
    for w in sorted((w for w in by_width if w < width and gram & w), reverse=True):
        m = np.uint64((_SALT * (2 * w + 3) | 1) & (2**64 - 1))
        n = len(data) - done - w + 1
        out = out[:n] * m
        out += by_width.pop(w)[done : done + n]
        done += w
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_anchors(data, ends, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows by anchor in texts laid end to end: (anchor, first window, last window, hash).

    ``ends`` are the texts' end offsets; windows that cross one do not count.
    """
    import numpy as np

    n = len(data)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    if n < length:
        return none
    h = gram_hashes(data, gram)
    # Always the same bits of a hash are compared, so equal windows choose alike in any piece; ties go to the left.
    if n > 1 << PLACE_BITS:
        raise ValueError("a piece is too long")
    shift = np.uint64(PLACE_BITS)
    key = (h >> shift << shift) | np.arange(len(h), dtype=np.uint64)
    span = length - gram + 1
    low, width = key, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    valid = np.ones(len(low), dtype=bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - length + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none
    anchor = (low[at] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return anchor[new], at[new], at[np.r_[new[1:], len(at)] - 1], h[anchor[new]]


def context_hashes(data, start, stop):
    """64-bit polynomial hashes of ``data[start:stop]``, from prefix sums."""
    import numpy as np

    rng = np.random.default_rng(20240502)
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64)
    base = _SALT | 1

    def powers(x):
        p = np.full(len(data) + 1, x, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * powers(np.uint64(base))[:-1], out=prefix[1:])
    # Shifted down by the start, so equal strings hash alike wherever they stand.
    return (prefix[stop] - prefix[start]) * powers(np.uint64(pow(base, -1, 1 << 64)))[start] ^ (stop - start).astype(np.uint64)


def second_hashes(data, start, stop, width: int):
    """Other 64-bit hashes of ``data[start:stop]``: of three strings of ``width`` bytes that cover it."""
    import numpy as np

    h = gram_hashes(data, width)
    out = (stop - start).astype(np.uint64)
    for at in (start, (start + stop - width) // 2, stop - width):
        out = (out ^ h[at]) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(31)
    return out


def anchor_rows(batches, length: int, gram: int):
    """Batches (ord, text) to rows (h, cx, cy, ord, place) of contexts.

    place = first window << 16 | repeated << 8 | windows - 1. A context that this task has
    already met earlier in document order is marked repeated and keeps no bucket.
    """
    import numpy as np

    def solve(pieces):
        data = np.frombuffer(b"".join(x for _, _, x in pieces), dtype=np.uint8)
        ends = np.cumsum([len(x) for _, _, x in pieces])
        pos, first, last, h = window_anchors(data, ends, length, gram)
        which = np.searchsorted(ends, pos, side="right")
        origin = np.array([base for _, base, _ in pieces], dtype=np.int64) - np.r_[0, ends[:-1]]
        orders = np.array([o for o, _, _ in pieces], dtype=np.int64)[which]
        cx = context_hashes(data, first, last + length)
        cy = second_hashes(data, first, last + length, -(-(2 * length - gram) // 3))  # three of them cover the longest context
        return h.view(np.int64), cx.view(np.int64), cy.view(np.int64), orders, (first + origin[which]) << 16 | (last - first)

    def merged(held):
        h, cx, cy, o, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((place, o, cy, cx, h))
        h, cx, cy, o, place = h[order], cx[order], cy[order], o[order], place[order]
        again = np.r_[False, (h[1:] == h[:-1]) & (cx[1:] == cx[:-1]) & (cy[1:] == cy[:-1])]
        place[again] |= 1 << 8
        h[again] = o[again] * 0x2545F491 + place[again]  # any partition will do
        cx[again] = cy[again] = 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, cx, cy, o, place)], ["h", "cx", "cy", "ord", "place"])

    pieces: list = []
    held: list = []
    size = 0
    for batch in batches:
        for o, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):  # one text at a time leaves Arrow
            text = None if not text.is_valid else text.as_buffer().to_pybytes()
            if text is None or len(text) < length:
                continue
            for base in range(0, len(text) - length + 1, PIECE):
                pieces.append((o, base, text[base : base + PIECE + length - 1]))
                size += len(pieces[-1][2])
                if size >= PIECE:
                    held.append(solve(pieces))
                    pieces, size = [], 0
                    if sum(len(x[0]) for x in held) >= MERGE:
                        yield merged(held)
                        held = []
    if pieces:
        held.append(solve(pieces))
    if held:
        yield merged(held)


def resolve_buckets(batches, length: int):
    """Rows of ``anchor_rows`` sorted by bucket to (kind, h, ord, s, t): kind 0, a repeated span;
    kind 1, the first context of its text in a bucket that holds different ones."""
    import numpy as np

    def solve(held):
        h, cx, cy, o, place = (np.concatenate(x) for x in zip(*held, strict=True))
        marked = (place >> 8 & 1) == 1
        new_h = np.r_[True, h[1:] != h[:-1]]
        new_cx = new_h | np.r_[True, (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])] | marked | np.r_[False, marked[:-1]]
        group = np.cumsum(new_h) - 1
        different = np.bincount(group, new_cx & ~marked)[group] > 1
        kind = np.where(marked | ~new_cx, 0, np.where(different, 1, 2))
        use = kind < 2
        start = place[use] >> 16
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (kind[use].astype(np.int32), h[use], o[use], start, start + (place[use] & 255) + length)], ["kind", "h", "ord", "s", "t"])

    held: list = []
    for batch in batches:
        rows = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(rows[0]):
            continue
        held.append(rows)
        if rows[0][0] == rows[0][-1]:
            continue
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        held[-1] = tuple(x[:cut] for x in rows)
        yield solve(held)
        held = [tuple(x[cut:] for x in rows)]
    if held:
        yield solve(held)


# -- contexts ---------------------------------------------------------------------------


def context_rows(batches, column: str):
    """Documents with the places of contexts to rows (h, ord, start, text)."""
    names, kinds = ["h", "ord", "start", "text"], [pa.int64()] * 3 + [pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for o, text, found in zip(batch.column("__lf_ord").to_pylist(), batch.column(column).cast(pa.binary()).to_pylist(), batch.column("__lf_found").to_pylist(), strict=True):
            for x in found:
                for col, v in zip(out, (x["h"], o, x["s"], text[x["s"] : x["t"]]), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)


# -- the sorter -------------------------------------------------------------------------


def _dense(keys):
    import numpy as np

    order = np.argsort(keys, kind="stable")
    k = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.r_[1, k[1:] != k[:-1]]) if len(k) else 0
    return rank


def block_suffix_order(data, base, size, starts, owner):
    """Suffix order of ``starts`` in segments ``base .. base + size`` of ``data``.

    Segments begin at multiples of PERIOD; a suffix ends with its segment. ``owner`` is
    each suffix's segment. Returns the suffixes' indices in suffix order.
    """
    import numpy as np

    end_of = base + size
    total = int(-(-end_of[-1] // PERIOD) * PERIOD) + PERIOD
    segment = np.repeat(np.arange(len(base)), np.diff(np.r_[base, total]))
    stop = end_of[segment]
    place = np.arange(total)
    coded = np.zeros(total + PERIOD, np.int64)
    coded[: len(data)] = data.astype(np.int64) + 1
    coded[:total][place >= stop] = 0
    head = np.zeros(total, np.int64)  # the first PERIOD bytes, nine bits each
    for t in range(PERIOD):
        inside = place + t < stop
        head = head << 9 | np.where(inside, coded[t : t + total], 0)

    sample = np.flatnonzero(np.isin(place % PERIOD, COVER) & (place < stop))
    rank = np.zeros(total + 1, np.int64)
    rank[sample] = _dense(head[sample])
    reach, longest = PERIOD, int(size.max())
    limit = stop[sample]
    while reach < longest and len(sample) and rank[sample].max() < len(sample):
        beyond = np.where(sample + reach < limit, np.minimum(sample + reach, total), total)
        rank[sample] = _dense(rank[sample] * (len(sample) + 1) + rank[beyond])
        reach *= 2

    n = len(starts)
    prefix = _dense(head[starts])
    wide = len(sample) + 2
    residue = starts % PERIOD
    members, keyed = [], {}
    own_stop = end_of[owner]

    def key(i, delta):
        at = starts[i] + delta
        return prefix[i] * wide + np.where(at < own_stop[i], rank[np.minimum(at, total)], 0)

    def common(r, s):
        return next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER)

    for r in range(PERIOD):
        i = np.flatnonzero(residue == r)
        members.append(i[np.argsort(key(i, common(r, r)), kind="stable")])
    final = np.zeros(n, np.int64)
    for r in range(PERIOD):
        for s in range(PERIOD):
            if not len(members[r]) or not len(members[s]):
                continue
            d = common(r, s)
            for who in (r, s):
                if (who, d) not in keyed:
                    keyed[who, d] = key(members[who], d)
            final[members[r]] += np.searchsorted(keyed[s, d], keyed[r, d], side="right" if s < r else "left")
    return np.argsort(final, kind="stable")


def repeated_windows(contexts, length: int = LENGTH):
    """For distinct contexts (ord, start, bytes): the (ord, window) pairs that also start earlier."""
    import numpy as np

    texts = [c[2] for c in contexts]
    size = np.array([len(x) for x in texts], np.int64)
    base = np.r_[0, np.cumsum(-(-size // PERIOD) * PERIOD)][:-1]
    data = np.frombuffer(b"".join(x + bytes(-len(x) % PERIOD) for x in texts), np.uint8)
    count = size - length + 1
    owner = np.repeat(np.arange(len(texts)), count)
    inner = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
    starts = base[owner] + inner
    order = block_suffix_order(data, base, size, starts, owner)

    padded = np.r_[data, np.zeros(8, np.uint8)]
    words = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))
    a, b = starts[order[:-1]], starts[order[1:]]
    same = np.ones(len(a), bool)
    for t in (*range(0, length - 7, 8), length - 8):
        same &= words[a + t] == words[b + t]

    orders = np.array([c[0] for c in contexts], np.int64)[owner]
    places = np.array([c[1] for c in contexts], np.int64)[owner] + inner
    turn = np.empty(len(owner), np.int64)
    turn[np.lexsort((places, orders))] = np.arange(len(owner))
    classes = np.flatnonzero(np.r_[True, ~same])
    least = np.minimum.reduceat(turn[order], classes) if len(order) else turn
    first = np.repeat(least, np.diff(np.r_[classes, len(order)]))
    again = order[turn[order] != first]
    return orders[again], places[again]


def runs(orders, places):
    """Windows to maximal runs (ord, first, last)."""
    import numpy as np

    by = np.lexsort((places, orders))
    o, p = orders[by], places[by]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (p[1:] > p[:-1] + 1)]) if len(o) else np.zeros(0, int)
    last = np.r_[new[1:], len(o)] - 1 if len(o) else new
    return o[new], p[new], p[last]


def sort_buckets(batches, length: int):
    """Distinct contexts sorted by bucket to spans (ord, start, stop), a block of buckets at a time."""

    def solve(contexts):
        o, first, last = runs(*repeated_windows(contexts, length))
        return pa.RecordBatch.from_arrays([pa.array(o), pa.array(first), pa.array(last + length)], ["ord", "s", "t"])

    block: list = []
    size, bucket = 0, None
    for batch in batches:
        for h, o, start, text in zip(*(batch.column(c).to_pylist() for c in ("h", "ord", "start", "text")), strict=True):
            if size >= BLOCK and h != bucket:
                yield solve(block)
                block, size = [], 0
            block.append((o, start, text))
            size += len(text)
            bucket = h
    if block:
        yield solve(block)


# -- the operator -----------------------------------------------------------------------


def numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """``docs`` with __lf_ord, unique a document and in document order; whether rows repeat."""
    d = docs.withColumn("__lf_ord", F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST)))
    if d.groupBy("__lf_ord").count().where("count > 1").isEmpty():
        return d, False
    # Ids repeat: number the distinct (id, SHA-256) pairs in order.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.withColumn("__lf_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    ids = d.select("__lf_ord", "__lf_sha").distinct()
    ranged = staged(ids.repartitionByRange(parts, "__lf_ord", "__lf_sha").withColumn("p", F.spark_partition_id()), "ranged")
    local = ranged.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("__lf_ord", "__lf_sha")).cast("long"))
    offset = ranged.groupBy("p").count().withColumn("o", F.coalesce(F.sum("count").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    dense = local.join(F.broadcast(offset.select("p", "o")), "p").select("__lf_ord", "__lf_sha", (F.col("r") + F.col("o")).alias("__lf_new"))
    return d.join(dense, ["__lf_ord", "__lf_sha"]).drop("__lf_ord", "__lf_sha").withColumnRenamed("__lf_new", "__lf_ord"), True


def repeated_spans(d: DataFrame, text: str, many_rows: bool, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans (ord, s, t) of numbered documents that a merged list of them repeats."""
    spark = d.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = d.select(F.col("__lf_ord").alias("ord"), F.col(text).alias("text"))
    if many_rows:
        texts = texts.groupBy("ord").agg(F.first("text").alias("text"))
    anchors = texts.mapInArrow(lambda b: anchor_rows(b, length, gram), "h long, cx long, cy long, ord long, place long")
    dealt = anchors.repartition(parts, "h").sortWithinPartitions("h", "cx", "cy", "ord", "place")
    found = staged(dealt.mapInArrow(lambda b: resolve_buckets(b, length), "kind int, h long, ord long, s long, t long"), "buckets")

    wanted = found.where("kind = 1").groupBy(F.col("ord").alias("__lf_o")).agg(F.collect_list(F.struct("h", "s", "t")).alias("__lf_found"))  # bounded by the document's own length
    if many_rows:
        d = texts.select(F.col("ord").alias("__lf_ord"), F.col("text").alias(text))
    # All columns go along, so that this exchange of the documents is the one the last join reuses.
    rows = d.join(wanted, F.col("__lf_ord") == F.col("__lf_o")).drop("__lf_o")
    contexts = rows.mapInArrow(lambda b: context_rows(b, text), "h long, ord long, start long, text binary")
    spans = found.where("kind = 0").select("ord", "s", "t")
    hot = staged(found.where("kind = 1").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_CONTEXTS).select("h"), "hot")
    if not hot.isEmpty():
        spans = spans.unionByName(hot_spans(contexts.join(hot, "h", "left_semi"), length))
        contexts = contexts.join(hot, "h", "left_anti")
    blocks = contexts.repartition(parts, "h").sortWithinPartitions("h", "ord", "start")
    return blocks.mapInArrow(lambda b: sort_buckets(b, length), "ord long, s long, t long").unionByName(spans)


def window_rows(batches, length: int):
    """Contexts (h, ord, start, text) to their windows (digest, ord, start); of equal ones in a batch the least is
    marked by ``first`` and bears the digest into the shuffle, the others are decided."""
    from hashlib import blake2b

    for batch in batches:
        seen: dict[bytes, tuple[int, int]] = {}
        out: list[list] = [[], [], []]
        for o, start, text in zip(*(batch.column(c).to_pylist() for c in ("ord", "start", "text")), strict=True):
            for i in range(len(text) - length + 1):
                digest, at = blake2b(text[i : i + length], digest_size=16).digest(), (o, start + i)
                known = seen.get(digest)
                if known is None or at < known:
                    seen[digest] = at
                    known, at = at, known
                if at is not None and at != seen[digest]:
                    for col, x in zip(out, (None, *at), strict=True):
                        col.append(x)
        for digest, at in seen.items():
            for col, x in zip(out, (digest, *at), strict=True):
                col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), *[pa.array(x, pa.int64()) for x in out[1:]]], ["digest", "ord", "start"])


def hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows (ord, s, t) of buckets too large for one task, told by 128 bits of hash.

    Each window of a bucket is a row of its own, so a bucket of any size is spread over all
    tasks; every task reduces equal windows to its first before the shuffle.
    """
    windows = staged(contexts.mapInArrow(lambda b: window_rows(b, length), "digest binary, ord long, start long"), "windows")
    open_ = windows.where("digest is not null")
    first = open_.groupBy("digest").agg(F.min(F.struct("ord", "start")).alias("first"))
    again = open_.join(first, "digest").where(F.struct("ord", "start") != F.col("first")).select("ord", "start")
    decided = windows.where("digest is null").select("ord", "start")
    return again.unionByName(decided).select("ord", F.col("start").alias("s"), (F.col("start") + length).alias("t"))


def cut(text: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of ``text`` without ``spans``, and the maximal removed runs."""
    merged: list[list[int]] = []
    for s, t in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], t)
        else:
            merged.append([s, t])
    left, at = [], 0
    for s, t in merged:
        left.append(text[at:s])
        at = t
    left.append(text[at:])
    return b"".join(left), [(s, t) for s, t in merged]


def whole_characters(text: bytes, runs_: list[tuple[int, int]]) -> str:
    """The text left when each removed run is narrowed to whole UTF-8 characters."""
    left, at = [], 0
    for s, t in runs_:
        while s < t and text[s] & 0xC0 == 0x80:
            s += 1
        while s < t < len(text) and text[t] & 0xC0 == 0x80:
            t -= 1
        left.append(text[at:s])
        at = max(at, t)
    left.append(text[at:])
    return b"".join(left).decode("utf-8", "replace")


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, replace: bool = True) -> DataFrame:
    """``docs`` with __lf_bytes, __lf_removed, __lf_spans, __lf_kept (SHA-256 of the bytes left).

    With ``replace`` the text column becomes what is left, narrowed to whole characters.
    """
    if gram > length or length - gram > 254 or length < 8:
        raise ValueError("8 <= length, gram <= length <= gram + 254")
    shown = list(docs.columns)
    kept = [f"__lf_c{i}" for i in range(len(shown))]  # names of any kind, dots included, come back at the end
    text, doc_id = kept[shown.index(text)], kept[shown.index(doc_id)]
    docs = docs.toDF(*kept)
    d, many_rows = numbered(docs, doc_id, text)
    spans = repeated_spans(d, text, many_rows, length, gram)
    marks = spans.groupBy(F.col("ord").alias("__lf_o")).agg(F.collect_list(F.struct("s", "t")).alias("__lf_list"))
    rows = d.join(marks, F.col("__lf_ord") == F.col("__lf_o"), "left").select(*[F.col(f"`{c}`") for c in kept], "__lf_list")
    facts = ["__lf_bytes", "__lf_removed", "__lf_spans", "__lf_kept"]
    schema = StructType([*[StructField(f.name, f.dataType, True) for f in docs.schema], *[StructField(x, LongType()) for x in facts[:3]], StructField(facts[3], BinaryType())])
    at = kept.index(text)

    def finish(batches):
        from hashlib import sha256

        for batch in batches:
            lists = batch.column("__lf_list").to_pylist()
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            out: list[list] = [[], [], [], []]
            left: list = []
            for i, raw in enumerate(texts):
                raw_ = raw or b""
                spans_ = [(x["s"], x["t"]) for x in lists[i] or ()]
                rest, merged = cut(raw_, spans_) if spans_ else (raw_, [])
                for col, x in zip(out, (len(raw_), len(raw_) - len(rest), len(merged), sha256(rest).digest()), strict=True):
                    col.append(x)
                if replace:
                    left.append(whole_characters(raw_, merged) if merged else raw)
            cols = [batch.column(j) for j in range(len(kept))]
            if replace:
                cols[at] = pa.array([x.decode("utf-8", "replace") if isinstance(x, bytes) else x for x in left], pa.string())
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3], pa.binary())], [*kept, *facts])

    assert isinstance(docs.schema[text].dataType, StringType)
    return rows.mapInArrow(finish, schema).toDF(*shown, *facts)


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with every repeated passage cut from its text; the columns of ``docs``.

    A document of which nothing but white space is left goes.
    """
    out = suffix_dedup(docs, length=length)
    gone = (F.col("__lf_removed") > 0) & (F.btrim(F.col("text"), F.lit("\t\n\x0b\x0c\r ")) == "")
    return out.where(~gone).select(*[F.col(f"`{c}`") for c in docs.columns])
