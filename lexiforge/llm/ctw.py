"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

Each byte is eight binary decisions (255 nodes). Each decision has a context tree over
the preceding bytes, of ``DEPTH`` levels below the root, with a Krichevsky-Trofimov (KT)
estimator in every node; the tree mixes the estimates of all depths with the weights
that context-tree weighting gives them after the training text. KT block probabilities
depend on counts only, so training is one distributed count of (context, byte) over all
training texts, and the mixture is worked out from the counts: bottom-up for the weights,
top-down for the predictions.

The counts are a staged table that grows with the corpus. Contexts of up to ``TOP`` bytes
(at most 256**(TOP+1) counts) are mixed on the driver; what lies below each of them is a
subtree that one task holds, as rows are dealt out by their nearest ``TOP`` bytes. To be
scored, texts are dealt out in blocks of some ``BLOCK`` bytes; each block asks for its
distinct (context, byte) codes, the tasks of the subtrees answer with log probabilities,
and the answers meet the block's texts again.

The unigram base score needs the exact count of every token. Counts stay a distributed
table; the ``HOT`` most frequent tokens are looked up in a broadcast table of bounded
size, and only the rest is shuffled, as (token, document) sums.

Defined cases: null texts are empty and score their end alone; with no training text N
and V are 0 and the base is log10 of 1 a token (0.5 / 0.5), and every byte of the model is
one of 256; repeated rows repeat; texts of any length are read whole, in parts; an empty
table gives no rows; columns beyond doc_id and the text are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged
from .common import remainder

DEPTH, TOP = 5, 2
BLOCK = 1 << 24
CODES = 1 << 22
HOT = 65_536
HOT_BYTES = 64
FLUSH = 500_000
PIECE = 1 << 20
END = b" "  # no word holds a space
OWN, LONG = b"  ", b"   "  # what a row of its own and the digest of a long word open with


# -- the context tree -------------------------------------------------------------------


def log_gamma(x):
    """ln Gamma for x > 0, by Stirling's series after eight steps up."""
    import numpy as np

    y = x + 8.0
    steps = np.ones_like(y)
    for i in range(8):
        steps *= x + i
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(steps)


def decisions(counts):
    """Byte counts (n, 256) to the counts of zeros and ones at each of the 255 nodes, by level."""
    levels = [counts.astype(float)]
    while levels[-1].shape[1] > 1:
        c = levels[-1]
        levels.append(c[:, 0::2] + c[:, 1::2])
    return [(c[:, 0::2], c[:, 1::2]) for c in levels[-2::-1]]


def kt_block(a, b):
    """ln of the KT probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - 1.1447298858494002  # ln pi


def flat(levels):
    import numpy as np

    return np.concatenate(levels, axis=1)


def mixture(contexts, counts):
    """Counts by context to byte log10 probabilities at full depth.

    ``contexts``: for each depth from 0 the sorted codes of the contexts that occur (the
    last byte lowest, so a parent's code is the child's modulo 256**depth);
    ``counts``: the matching (n, 256) counts. Returns, for each depth, the table of
    contexts of that depth with everything below unseen: (n, 256) float32.
    """
    import numpy as np

    zero_one = [tuple(flat(x) for x in zip(*decisions(c), strict=True)) for c in counts]
    depth = len(counts) - 1
    parent = [np.searchsorted(contexts[d - 1], contexts[d] % (1 << 8 * (d - 1))) for d in range(1, depth + 1)]
    weight: list = [None] * (depth + 1)
    below = None
    for d in range(depth, -1, -1):
        kt = kt_block(*zero_one[d])
        if d == depth:
            total = kt
        else:
            total = np.logaddexp(kt, below) - np.log(2)
            weight[d] = np.exp(kt - np.log(2) - total)  # the share of stopping here
        if d:
            below = np.zeros((len(contexts[d - 1]), 255))
            np.add.at(below, parent[d - 1], total)
    one = [(b + 0.5) / (a + b + 1.0) for a, b in zero_one]
    out = []
    for d in range(depth + 1):
        # The path root .. d, then an unseen child, whose every estimate is one half.
        path = np.arange(len(contexts[d]))
        p = one[d] if d == depth else weight[d] * one[d] + (1 - weight[d]) * 0.5
        for up in range(d - 1, -1, -1):
            path = parent[up][path]
            p = weight[up][path] * one[up][path] + (1 - weight[up][path]) * p
        out.append(bytes_of(p))
    return out


def bytes_of(p_one):
    """Node probabilities (n, 255) to log10 byte probabilities (n, 256)."""
    import numpy as np

    p = np.ones((len(p_one), 1))
    at = 0
    for level in range(8):
        own = p_one[:, at : at + (1 << level)]
        p = np.stack([p * (1 - own), p * own], axis=2).reshape(len(p), 2 << level)
        at += 1 << level
    return np.log10(p).astype(np.float32)


class Model:
    """Prediction tables by depth, with a dense index of the deepest contexts: the dense form of a small ``Tree``."""

    def __init__(self, codes, n, depth: int = TOP):
        """``codes``: context * 256 + byte of all that occurs, ``n``: how often."""
        import numpy as np

        codes, n = np.asarray(codes, np.int64), np.asarray(n, np.int64)
        byte = codes & 255
        contexts, counts = [], []
        for d in range(depth + 1):
            own = (codes >> 8) % (1 << 8 * d)
            seen, which = np.unique(own, return_inverse=True)
            if not len(seen):
                seen, which = np.zeros(1, np.int64) if d == 0 else seen, which.astype(np.int64)
            c = np.zeros((len(seen), 256))
            np.add.at(c, (which, byte), n)
            contexts.append(seen)
            counts.append(c)
        self.depth = depth
        tables = mixture(contexts, counts)
        # One table of rows; row_of maps a context of full depth to its deepest known row.
        self.rows = np.concatenate(tables)
        base = np.cumsum([0, *[len(t) for t in tables]])
        index = np.zeros(1 << 8 * depth, np.int32)
        everything = np.arange(1 << 8 * depth)
        for d in range(1, depth + 1):
            at = np.searchsorted(contexts[d], everything % (1 << 8 * d))
            known = (at < len(contexts[d])) & (contexts[d][np.minimum(at, len(contexts[d]) - 1)] == everything % (1 << 8 * d)) if len(contexts[d]) else np.zeros(len(everything), bool)
            index[known] = base[d] + at[known]
        self.index = index

    def score(self, data, begin):
        """log10 probabilities of texts laid end to end, each ended and led by ``depth`` zero bytes."""
        import numpy as np

        code = context_codes(data, self.depth)
        p = self.rows[self.index[code >> 8], code & 255].astype(np.float64)
        p[lead_places(len(data), begin, self.depth)] = 0.0
        return np.add.reduceat(p, begin)


def merged(codes, n):
    """Distinct sorted codes with the sums of their counts."""
    import numpy as np

    seen, which = np.unique(codes, return_inverse=True)
    return seen, np.bincount(which, weights=n, minlength=len(seen))


def place(keys, wanted):
    """Where ``wanted`` stand among sorted ``keys``, and whether they do."""
    import numpy as np

    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def decision(codes, level: int):
    """(context, node) keys and bits of the ``level``-th decision of (context, byte) codes."""
    byte = codes & 255
    return (codes >> 8 << 8) | ((1 << level) - 1 + (byte >> (8 - level))), (byte >> (7 - level)) & 1


class Tree:
    """The depths ``low`` to ``high`` of the context trees of all decisions that occur, as sorted arrays."""

    def __init__(self, codes, n, low: int, high: int, below=None):
        """``codes``: (context, byte) at depth ``high``, ``n``: how often; ``below``: (keys, ln of
        the weighted probability of all children) of that depth, none if it is the deepest."""
        import numpy as np

        self.low, self.high = low, high
        self.keys, self.one, self.stop = {}, {}, {}
        for d in range(high, low - 1, -1):
            codes, n = merged(codes & ((1 << 8 * (d + 1)) - 1), n)
            parts = [decision(codes, level) for level in range(8)]
            keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            bits, times = np.concatenate([x for _, x in parts]), np.tile(n, 8)
            ones = np.bincount(which, weights=times * bits, minlength=len(keys))
            zeros = np.bincount(which, weights=times, minlength=len(keys)) - ones
            kt = kt_block(zeros, ones)
            if below is None:
                total, stop = kt, np.ones(len(keys))
            else:
                rest = np.zeros(len(keys))
                at, known = place(keys, below[0])
                rest[at[known]] = below[1][known]
                total = np.logaddexp(kt, rest) - np.log(2)
                stop = np.exp(kt - np.log(2) - total)  # the share of stopping here
            self.keys[d], self.one[d], self.stop[d] = keys, (ones + 0.5) / (zeros + ones + 1.0), stop
            if d:
                below = merged(((keys >> 8) & ((1 << 8 * (d - 1)) - 1)) << 8 | (keys & 255), total)
        self.below = below  # of depth low - 1

    def predict(self, codes, level: int, p):
        """Probabilities of a one at a decision of each code, where ``p`` is what the depths below say."""
        import numpy as np

        for d in range(self.high, self.low - 1, -1):
            key, _ = decision(codes & ((1 << 8 * (d + 1)) - 1), level)
            at, known = place(self.keys[d], key)
            if known.any():
                own = self.stop[d][at]
                p = np.where(known, own * self.one[d][at] + (1 - own) * p, p)
        return p


def log_probabilities(codes, trees):
    """log10 probabilities of the bytes of codes, by ``trees`` from the deepest to the top."""
    import numpy as np

    out = np.zeros(len(codes))
    for level in range(8):
        p = np.full(len(codes), 0.5)
        for tree in trees:
            p = tree.predict(codes, level, p)
        bit = (codes >> (7 - level)) & 1
        out += np.log10(np.where(bit == 1, p, 1 - p))
    return out


class Answers:
    """The log probabilities of all codes of one block of texts, in a table of open addressing."""

    def __init__(self, codes, value, depth: int):
        import numpy as np

        self.depth, self.shift = depth, 64 - max(4, 2 + int(len(codes)).bit_length())
        self.codes, self.value = np.full(1 << 64 - self.shift, -1, np.int64), np.zeros(1 << 64 - self.shift, np.float32)
        at = self.first(codes)
        while len(codes):
            free = self.codes[at] < 0
            self.codes[at[free]] = codes[free]  # of several codes for one place, one gets it
            own = self.codes[at] == codes
            self.value[at[own]] = value[own]
            codes, value, at = codes[~own], value[~own], (at[~own] + 1) % len(self.codes)

    def first(self, codes):
        import numpy as np

        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(self.shift)).astype(np.int64)

    def of(self, codes):
        import numpy as np

        at = self.first(codes)
        left = np.flatnonzero(self.codes[at] != codes)
        while len(left):
            if (self.codes[at[left]] < 0).any():
                raise ValueError("a code of the block has no answer")
            at[left] = (at[left] + 1) % len(self.codes)
            left = left[self.codes[at[left]] != codes[left]]
        return self.value[at]

    def score(self, data, begin):
        """log10 probabilities of texts laid end to end, each ended and led by ``depth`` zero bytes."""
        import numpy as np

        held = np.ones(len(data), bool)
        held[lead_places(len(data), begin, self.depth)] = False
        p = np.zeros(len(data))
        p[held] = self.of(context_codes(data, self.depth)[held])
        return np.add.reduceat(p, begin)


class Codes:
    """Distinct (context, byte) codes of texts with their counts, merged from time to time."""

    def __init__(self, depth: int):
        self.depth, self.fresh = depth, 0
        self.raw: list = []
        self.parts: list = []

    def add(self, data, begin):
        import numpy as np

        held = np.ones(len(data), bool)
        held[lead_places(len(data), begin, self.depth)] = False
        self.raw.append(context_codes(data, self.depth)[held])
        self.fresh += len(data)
        if self.fresh >= 2 * CODES:
            self.merge()

    def merge(self) -> int:
        import numpy as np

        if self.raw:
            self.parts.append(np.unique(np.concatenate(self.raw), return_counts=True))
            self.raw, self.fresh = [], 0
        if len(self.parts) > 1:
            self.parts = [merged(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
        return len(self.parts[0][0]) if self.parts else 0

    def take(self):
        """The codes and counts; none are left."""
        import numpy as np

        self.merge()
        codes, n = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0))
        self.parts = []
        return codes, n.astype(np.int64)

    @property
    def full(self) -> bool:
        return bool(self.parts) and len(self.parts[0][0]) >= CODES


def context_codes(data, depth: int):
    """(preceding bytes, byte) at each place; what precedes the first place is zero."""
    import numpy as np

    x = data.astype(np.int64)
    code = x.copy()
    for d in range(1, depth + 1):
        code[d:] |= x[:-d] << 8 * d
    return code


def lead_places(n: int, begin, depth: int):
    import numpy as np

    return (np.asarray(begin)[:, None] + np.arange(depth)[None, :]).ravel()


def laid(texts: list[bytes], depth: int):
    """Texts laid end to end in pieces of bounded size: (bytes, text numbers, beginnings).

    Each part is led by its context: zero bytes at a text's start, else what precedes it.
    The end of a text is coded as a zero byte.
    """
    import numpy as np

    held, who, begin, size = [], [], [], 0
    for i, text in enumerate(texts):
        whole = bytes(depth) + text + b"\0"
        for at in range(0, len(whole) - depth, PIECE):
            part = whole[at : at + depth + PIECE]
            held.append(part)
            who.append(i)
            begin.append(size)
            size += len(part)
            if size >= PIECE:
                yield np.frombuffer(b"".join(held), np.uint8), np.array(who), np.array(begin)
                held, who, begin, size = [], [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.array(who), np.array(begin)


# -- training ---------------------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lowered, then the end; a word of more than ``HOT_BYTES`` bytes is told by its SHA-256."""
    from hashlib import sha256

    out = [w if len(w) <= HOT_BYTES else LONG + sha256(w).digest() for w in text.lower().split()]
    out.append(END)
    return out


def count_rows(batches, depth: int):
    """Training texts to partial counts: (token, null, n) and (null, code, n)."""
    from collections import Counter

    import numpy as np

    words: Counter = Counter()
    grams = Codes(depth)
    names = ["token", "code", "n"]

    def of_words():
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(list(words.values()), pa.int64())], names)

    def of_grams():
        at, n = grams.take()
        for i in range(0, len(at), FLUSH):
            own = at[i : i + FLUSH]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.binary()), pa.array(own), pa.array(n[i : i + FLUSH])], names)

    for batch in batches:
        texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
        for t in texts:
            words.update(tokens(t))
            if len(words) >= FLUSH:
                yield of_words()
                words.clear()
        for data, _, begin in laid(texts, depth):
            grams.add(data, begin)
            if grams.full:
                yield from of_grams()
    if words:
        yield of_words()
    yield from of_grams()


def subtrees(batches, depth: int, top: int):
    """Counts (code, n), dealt out by their nearest ``top`` bytes, to what the top tree has below it."""
    import numpy as np

    codes, n = columns_of(batches, 2)
    keys, value = Tree(codes, n, top + 1, depth).below if len(codes) else (np.zeros(0, np.int64), np.zeros(0))
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(value)], ["key", "value"])


def columns_of(batches, many: int):
    import numpy as np

    kept = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(many)] for b in batches if b.num_rows]
    return [np.concatenate(x) for x in zip(*kept, strict=True)] if kept else [np.zeros(0, np.int64)] * many


def answers(batches, shared, depth: int, top: int):
    """Counts (code, n, block -1) and questions (code, 0, block), dealt out alike, to (block, code, value)."""
    import numpy as np

    codes, n, block = columns_of(batches, 3)
    known = block < 0
    deep = Tree(codes[known], n[known], top + 1, depth)
    codes, block = codes[~known], block[~known]
    for i in range(0, len(codes), FLUSH):
        own = codes[i : i + FLUSH]
        distinct, which = np.unique(own, return_inverse=True)
        value = log_probabilities(distinct, [deep, shared.value])[which].astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(block[i : i + FLUSH]), pa.array(own), pa.array(value)], ["block", "code", "value"])


def questions(batches, depth: int):
    """Texts (block, text), sorted by block, to the distinct codes of each block."""
    import numpy as np

    held, own = Codes(depth), None

    def ask():
        codes, _ = held.take()
        for i in range(0, len(codes), FLUSH):
            part = codes[i : i + FLUSH]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(part), np.int64)), pa.array(np.full(len(part), own, np.int64))], ["code", "n", "block"])

    for batch in batches:
        block = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        edge = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for low, high in zip(edge, edge[1:], strict=False):
            if low == high:
                continue
            if own is not None and block[low] != own:
                yield from ask()
            own = int(block[low])
            for data, _, begin in laid([t or b"" for t in texts[low:high]], depth):
                held.add(data, begin)
    if own is not None:
        yield from ask()


class Trained:
    """Token counts as a staged table, their totals, the hot tokens and the byte model."""

    def __init__(self, texts: DataFrame, depth: int = DEPTH, hot: int = HOT):
        counted = texts.mapInArrow(lambda b: count_rows(b, depth), "token binary, code long, n long")
        both = staged(counted.groupBy("token", "code").agg(F.sum("n").alias("n")), "counts")
        self.counts = both.where("token is not null").select("token", "n")
        total = self.counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.n, self.v = total[0], total[1]
        spark = texts.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.depth, self.top = depth, (top := min(TOP, depth - 1))
        self.grams = both.where("code is not null").select("code", "n")
        near = F.col("code").bitwiseAND((1 << 8 * (top + 1)) - 1)
        tops = self.grams.groupBy(near.alias("code")).agg(F.sum("n").alias("n")).toPandas()  # 256**(top+1) rows at most
        dealt = self.grams.repartition(parts, nearest(top))
        below = dealt.mapInArrow(lambda b: subtrees(b, depth, top), "key long, value double").toPandas()  # 255 * 256**top rows at most
        self.tree = Tree(tops["code"].to_numpy(), tops["n"].to_numpy(), 0, top, (below["key"].to_numpy(), below["value"].to_numpy()))
        # The least count that at most ``hot`` tokens reach, from a histogram of counts.
        top = self.counts.orderBy(F.desc("n"), "token").limit(hot)
        self.hot = {bytes(r["token"]): r["n"] for r in top.collect()}


def nearest(top: int):
    """What a code's rows are dealt out by: its nearest ``top`` bytes."""
    return F.shiftright("code", 8).bitwiseAND((1 << 8 * top) - 1)


# -- scoring ----------------------------------------------------------------------------


SCORED = pa.schema(
    [
        ("token", pa.binary()),
        ("times", pa.int64()),
        ("key", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
        ("n_bytes", pa.int64()),
    ]
)


def score_rows(batches, model, hot, n: int, v: int, block: int):
    """(doc_id, held_out, text) of one block to one row a document and one a token that is not hot.

    ``key`` numbers the rows of a block, which one task makes and a stage then keeps.

    A document's own row bears a token that no corpus holds, so the join keeps it apart.
    """
    from collections import Counter
    from math import log10

    import numpy as np

    floor = n + 0.5 * (v + 1)
    value = {t: log10((c + 0.5) / floor) for t, c in hot.items()}
    names, kinds = SCORED.names, SCORED.types
    number = block << 32
    for batch in batches:
        doc_id, held = (batch.column(i).to_pylist() for i in range(2))
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        key = range(number, number + len(texts))
        number += len(texts)
        scores = np.zeros(len(texts))
        for data, who, begin in laid(texts, model.depth):
            np.add.at(scores, who, model.score(data, begin))
        out: list[list] = [[] for _ in names]
        for i, t in enumerate(texts):
            words = Counter(tokens(t))
            known, base, rare, times = 0, 0.0, [], []
            for w, c in words.items():
                x = value.get(w)
                if x is None:
                    rare.append(w)
                    times.append(c)
                else:
                    known += c
                    base += c * x
            m = len(rare) + 1
            own = (OWN + key[i].to_bytes(8, "little"), 0, key[i], doc_id[i], held[i], sum(words.values()), known, base, float(scores[i]), len(t))
            out[0] += [own[0], *rare]
            out[1] += [0, *times]
            out[2] += [key[i]] * m
            for col, x in zip(out[3:], own[3:], strict=True):
                col.append(x)
                col += [None] * (m - 1)
            if len(out[0]) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)
                out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)


def score_documents(docs: DataFrame, text: str = "text", depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row."""
    held = remainder() == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    made = Trained(rows.where("not held_out").select("text"), depth, hot)
    spark = docs.sparkSession
    hot_words, tree = spark.sparkContext.broadcast(made.hot), spark.sparkContext.broadcast(made.tree)
    n, v, top = made.n, made.v, made.top
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK + 1))
    keyed = rows.select("doc_id", "held_out", "text", block.alias("block"))

    def all_answers() -> DataFrame:
        asked = keyed.select("block", "text").repartition(parts, "block").sortWithinPartitions("block").mapInArrow(lambda b: questions(b, depth), "code long, n long, block long")
        both = asked.unionByName(made.grams.select("code", "n", F.lit(-1).cast("long").alias("block"))).repartition(parts, nearest(top))
        return staged(both.mapInArrow(lambda b: answers(b, tree, depth, top), "block long, code long, value float"), "answers")

    answered = all_answers()

    def score_block(texts: pa.Table, known: pa.Table) -> pa.Table:
        model = Answers(known.column("code").to_numpy(), known.column("value").to_numpy(), depth)
        batches = texts.select(["doc_id", "held_out", "text"]).to_batches()
        block = texts.column("block")[0].as_py() if texts.num_rows else 0
        return pa.Table.from_batches(score_rows(batches, model, hot_words.value, n, v, block), SCORED)

    schema = "token binary, times long, key long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long"
    scored = staged(keyed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(score_block, schema), "scored")
    discard(answered)
    joined = scored.join(made.counts, "token", "left")
    c = F.coalesce("n", F.lit(0))
    own = F.col("n_tokens").isNotNull()
    joined = joined.withColumns(
        {
            "base": F.when(own, F.col("base")).otherwise(F.col("times") * F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))),
            "known": F.when(own, F.col("known")).otherwise(F.when(c > 0, F.col("times")).otherwise(0)),
        }
    )
    per = joined.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("known").cast("long").alias("n_known"),
        F.sum("base").alias("base_score"),
        F.max("score").alias("score"),
        F.max("n_bytes").alias("n_bytes"),
    )
    return per.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") / 0.30102999566398120 / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
