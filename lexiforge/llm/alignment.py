"""Alignment of two tokenizers over a corpus: groups, links and how many documents hold each pair.

A text with a space before it is cut into units: at every single space that stands
between two characters that are no white space. No piece of the second vocabulary goes on
past a space, and the byte-level pattern of the first begins anew there, so a unit's tokens
are those it has inside its text, and both tokenizers end a token at its end. Equal units
are tokenised and aligned once, through a bounded cache.

Pairs are counted by packed 64-bit keys, first id above second:

1. *Documents.* One pass aligns every text and writes a row a document: its figures and its
   distinct keys with their occurrences, packed.
2. *Partial counts.* Each task sums the keys of its documents with ``numpy.unique``; only
   (key, documents) leave it.
3. *Sorted shards.* A range partitioning sorts all keys; a sweep sums the runs of a
   partition and writes them as two arrays, a shard, into the shared folder.
4. *Lookup.* Tasks map the shards into memory and find their documents' keys with
   ``searchsorted``. Where the shared folder is no file system that tasks can map, the same
   figures come from a join (``by_join``).

Defined cases: a null or empty text, or one whose tokens' bytes differ from a space and the
text, has no tokens: zeros, and an empty text for ``groups_sha256``; such texts count in no
pair. Special tokens' strings are plain text. Equal rows are documents of their own, and a
null doc_id is carried through. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import shared_dir, staged

CACHE = 150_000
CHARS = 500_000
PARTIAL = 2_000_000
ROWS = 2_000
RUN = 4096
SHIFT = 32
MARK = "▁"
_BREAK = re.compile(r"(?<=\S) (?=\S)")
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_ODD = [x for w in _WHITE for x in (w + " ", " " + w)]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def units_of(text: str) -> list[str]:
    """The units of a text, each without the one space it begins with."""
    odd = text[0] == " " or text[-1] == " " or any(x in text for x in _ODD)
    return _BREAK.split(text) if odd else text.split(" ")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """A piece's bytes: a byte piece's own, else its text with the mark U+2581 as a space."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARK, " ").encode()


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import json

        import numpy as np
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letter = byte_letters()
        with open(path_a, encoding="utf-8") as f:
            told = json.load(f)
        entries = {i: x for x, i in told["model"]["vocab"].items()} | {x["id"]: x["content"] for x in told.get("added_tokens", ())}
        del told
        entries = [entries.get(i, "") for i in range(max(entries) + 1)]
        self.bytes_a = [bytes(letter[c] for c in x) if all(c in letter for c in x) else x.encode() for x in entries]
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.ordinary = self._ranks(path_a) or self._tokenizer(path_a)

    def _tokenizer(self, path: str):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        return lambda text: made.encode(text, add_special_tokens=False).ids

    def _ranks(self, path: str):
        """The first vocabulary as ranks, if that file lies beside and holds the same ids: faster, and smaller in memory."""
        from base64 import b64decode

        import public_tokenizers
        import tiktoken

        try:
            with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
                ranks = {b64decode(x): int(y) for x, y in map(bytes.split, f)}
        except FileNotFoundError:
            return None
        if any(i >= len(self.bytes_a) or self.bytes_a[i] != x for x, i in ranks.items()):
            return None
        return tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, units: list[str]):
        """(tokens of each unit, all ids) for both tokenizers, one call for all units."""
        import numpy as np

        whole = " ".join(units)
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        a = np.array(self.ordinary(" " + whole), np.int64)
        b = np.array(self.b.encode(whole), np.int64)
        out = []
        for ids, size in ((a, self.size_a), (b, self.size_b)):
            at = np.cumsum(size[ids])
            last = np.searchsorted(at, ends)
            if not len(at) or at[-1] != ends[-1] or (at[last] != ends).any():
                return self.encode_each(units)
            out += [np.diff(last, prepend=-1), ids]
        return out

    def encode_each(self, units: list[str]):
        import numpy as np

        out = []
        for ids in ([self.ordinary(" " + u) for u in units], self.b.encode(units, num_threads=1)):
            n = np.array([len(x) for x in ids], np.int64)
            out += [n, np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))]
        return out


@lru_cache(1)
def pair(path_a: str, path_b: str) -> Pair:
    """Both tokenizers, once a process."""
    return Pair(path_a, path_b)


@lru_cache(1)
def units_in_process(paths: tuple[str, str]) -> Units:
    """Aligned units stay with a worker process from task to task."""
    return Units(pair(*paths))


def runs(sorted_values):
    """Where runs of equal values begin."""
    import numpy as np

    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def ranges(starts, counts):
    """Indices starts[i], starts[i] + 1, ..., counts[i] of them, for every i."""
    import numpy as np

    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class Units:
    """Aligned units under numbers of their own; when there are too many, those met least go."""

    def __init__(self, pair: Pair):
        import numpy as np

        self.pair = pair
        self.number: dict[str, int] = {}
        self.told: list[str] = []  # the groups as text
        self.figures = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, 1 if its bytes are the text's
        self.starts = np.zeros(1, np.int64)
        self.keys = self.times = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the half of the bound that is met most."""
        import numpy as np

        keep = np.sort(np.argsort(-self.met, kind="stable")[: CACHE // 2])
        place = np.full(len(self.met), -1)
        place[keep] = np.arange(len(keep))
        where = place.tolist()
        self.number = {u: where[i] for u, i in self.number.items() if where[i] >= 0}
        self.told = [self.told[i] for i in keep.tolist()]
        counts = np.diff(self.starts)[keep]
        at = ranges(self.starts[keep], counts)
        self.keys, self.times = self.keys[at], self.times[at]
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.figures, self.met = self.figures[keep], self.met[keep] // 2

    def _add(self, wanted: list[str]) -> None:
        """Number units that are not known yet."""
        import numpy as np

        pair, first = self.pair, len(self.number)
        # Units that would not stand by themselves between others.
        alone = [u for u in wanted if not u or u[0].isspace() or u[-1].isspace() or MARK in u]
        apart = set(alone)
        wanted = [*(u for u in wanted if u not in apart), *alone]
        plain = len(wanted) - len(alone)
        parts = [f(x) for f, x in ((pair.encode, wanted[:plain]), (pair.encode_each, alone)) if x]
        n_a, a, n_b, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        raw = [(" " + u).encode() for u in wanted]
        told_a, told_b = [pair.bytes_a[t] for t in a.tolist()], [pair.bytes_b[t] for t in b.tolist()]
        same = np.ones(len(wanted), np.int64)
        if alone or not b"".join(raw) == b"".join(told_a) == b"".join(told_b):
            ends_a, ends_b = np.cumsum(n_a).tolist(), np.cumsum(n_b).tolist()
            for i, u in enumerate(raw):
                same[i] = u == b"".join(told_a[ends_a[i] - n_a[i] : ends_a[i]]) == b"".join(told_b[ends_b[i] - n_b[i] : ends_b[i]])
            a, b = a[np.repeat(same, n_a) > 0], b[np.repeat(same, n_b) > 0]
            n_a, n_b = n_a * same, n_b * same
        end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        in_a, in_b = np.bincount(of_a, minlength=len(cut)), np.bincount(of_b, minlength=len(cut))
        at_a, at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        unit = np.repeat(np.arange(len(wanted)), n_a)[at_a]
        # Short groups in one product, long ones by their distinct ids.
        links = in_a * in_b
        short = np.flatnonzero(links <= RUN)
        left = np.repeat(ranges(at_a[short], in_a[short]), np.repeat(in_b[short], in_a[short]))
        right = ranges(np.repeat(at_b[short], in_a[short]), np.repeat(in_b[short], in_a[short]))
        found = [(np.repeat(unit[short], links[short]), (a[left] << SHIFT) | b[right], np.ones(len(left), np.int64))]
        for g in np.flatnonzero(links > RUN).tolist():
            x, times_x = np.unique(a[at_a[g] : at_a[g] + in_a[g]], return_counts=True)
            y, times_y = np.unique(b[at_b[g] : at_b[g] + in_b[g]], return_counts=True)
            found.append((np.full(len(x) * len(y), unit[g]), ((x[:, None] << SHIFT) | y).ravel(), (times_x[:, None] * times_y).ravel()))
        own, key, times = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        n_groups = np.bincount(unit, minlength=len(wanted))
        n_links = np.zeros(len(wanted), np.int64)
        np.add.at(n_links, unit, links)
        self.number.update(zip(wanted, range(first, first + len(wanted)), strict=True))
        self.figures = np.concatenate([self.figures, np.stack([n_a, n_b, n_groups, n_links, same], 1)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.bincount(own, minlength=len(wanted)))])
        self.keys, self.times = np.concatenate([self.keys, key]), np.concatenate([self.times, times])
        self.met = np.concatenate([self.met, np.zeros(len(wanted), np.int64)])
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        shown = [",".join(text_a[i : i + m]) + "|" + ",".join(text_b[j : j + n]) for i, m, j, n in zip(at_a.tolist(), in_a.tolist(), at_b.tolist(), in_b.tolist(), strict=True)]
        ends = np.cumsum(n_groups).tolist()
        self.told += [";".join(shown[i:j]) for i, j in zip([0, *ends], ends, strict=False)]

    def of(self, texts: list[str | None]):
        """(unit numbers of all texts one after the other, how many each text has)."""
        import numpy as np

        split = [units_of(t) if t else [] for t in texts]
        distinct = set(chain.from_iterable(split))
        new = [u for u in distinct if u not in self.number]
        if new:
            if len(self.number) + len(new) > CACHE and len(self.number) > CACHE // 2:
                self._forget()
                new = [u for u in distinct if u not in self.number]
            self._add(new)
        sizes = np.array([len(x) for x in split], np.int64)
        flat = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        self.met += np.bincount(flat, minlength=len(self.met))
        return flat, sizes


def summed(own, key, times):
    """Times summed for each (own, key), sorted."""
    import numpy as np

    order = np.lexsort((key, own))
    own, key, times = own[order], key[order], times[order]
    if not len(own):
        return own, key, times
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])]))
    return own[first], key[first], np.add.reduceat(times, first)


def portions(batches):
    """(first column, texts) of a bounded number of characters at a time."""
    for batch in batches:
        texts, at, size = batch.column(1).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= CHARS or i == len(texts) - 1:
                yield batch.column(0).slice(at, i + 1 - at), texts[at : i + 1]
                at, size = i + 1, 0


def pack(keys, times) -> bytes:
    """Sorted keys and their occurrences, byte by byte: high bytes are mostly zero and fold away."""
    import numpy as np

    first = np.diff(keys >> SHIFT, prepend=0)
    return np.stack([first, keys & (2**SHIFT - 1), times], 1).astype("<u4").view(np.uint8).reshape(-1, 12).T.tobytes()


def unpacked(column):
    """(how many keys each row has, all keys, all occurrences) of a binary column of packed keys."""
    import numpy as np

    raw = [np.frombuffer(x, np.uint8).reshape(12, -1).T for x in column.to_pylist()]
    sizes = np.array([len(x) for x in raw], np.int64)
    if not sizes.sum():
        return sizes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.ascontiguousarray(np.concatenate(raw)).view("<u4").astype(np.int64)
    total = np.cumsum(flat[:, 0])
    starts = np.cumsum(sizes) - sizes
    before = np.concatenate([[0], total])[starts]
    return sizes, (total - np.repeat(before, sizes)) << SHIFT | flat[:, 1], flat[:, 2]


def merged(parts: list):
    """Sums by key of lists of (keys, counts)."""
    import numpy as np

    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def partial_counts(batches):
    """(pairs) to (key, n): documents of this task that hold each pair."""
    import numpy as np

    held, size = [], 0
    rows = lambda x: pa.RecordBatch.from_arrays([pa.array(y) for y in x], ["key", "n"])
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, keys, _ = unpacked(batch.column(0).slice(at, ROWS))
            if len(keys):
                held.append(np.unique(keys, return_counts=True))
                size += len(held[-1][0])
            if size > PARTIAL:
                held = [merged(held)]
                size = len(held[0][0])
                if size > PARTIAL // 2:
                    yield rows(held[0])
                    held, size = [], 0
    if held:
        yield rows(merged(held))


def run_sums(batches):
    """(key, n) sorted by key to one row a key."""
    import numpy as np

    left = None
    for batch in batches:
        keys, counts = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(keys):
            continue
        if left is not None:
            keys, counts = np.concatenate([left[0], keys]), np.concatenate([left[1], counts])
        first = runs(keys)
        sums = np.add.reduceat(counts, first)
        left = keys[-1:], sums[-1:]
        if len(first) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(keys[first[:-1]]), pa.array(sums[:-1])], ["key", "n"])
    if left is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in left], ["key", "n"])


def write_shard(batches, folder: str):
    """A partition of sorted (key, n) to a shard, and a row (shard, first, size, a, best) for each first id in it."""
    import numpy as np

    name, size, start = f"{folder}/{uuid.uuid4().hex}", 0, None
    best: dict[int, int] = {}
    with open(name + ".keys", "wb") as keys_file, open(name + ".counts", "wb") as counts_file:
        for batch in batches:
            keys, counts = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            keys_file.write(keys.astype("<i8").tobytes())
            counts_file.write(counts.astype("<i8").tobytes())
            start = int(keys[0]) if start is None else start
            size += len(keys)
            a = keys >> SHIFT
            at = runs(a)
            for x, y in zip(a[at].tolist(), np.maximum.reduceat(counts, at).tolist(), strict=True):
                best[x] = max(best.get(x, 0), y)
        for f in (keys_file, counts_file):
            f.flush()
            os.fsync(f.fileno())
    if size:
        n = len(best)
        yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array([start] * n, pa.int64()), pa.array([size] * n, pa.int64()), pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.int64())], ["shard", "first", "size", "a", "best"])
    else:
        os.remove(name + ".keys")
        os.remove(name + ".counts")


class Shards:
    """Counts of pairs in sorted arrays mapped into memory."""

    def __init__(self, shards: list[tuple[str, int, int]], best):
        import numpy as np

        self.files = sorted(shards, key=lambda s: s[1])
        self.first = np.array([s[1] for s in self.files], np.int64)
        self.best = best
        self.open: dict[int, tuple] = {}

    def __call__(self, keys):
        """(1 where the pair is its first id's most frequent, documents that hold the pair)."""
        import numpy as np

        out = np.zeros(len(keys), np.int64)
        where = np.searchsorted(self.first, keys, "right") - 1
        for s in np.unique(where).tolist():
            if s not in self.open:
                name, _, size = self.files[s]
                self.open[s] = tuple(np.memmap(name + x, "<i8", "r", shape=(size,)) for x in (".keys", ".counts"))
            known, counts = self.open[s]
            own = np.flatnonzero(where == s)
            at = np.searchsorted(known, keys[own])
            if (at >= len(known)).any() or (known[at] != keys[own]).any():
                raise RuntimeError("a pair is not in the counts that were made from the same texts")
            out[own] = counts[at]
        return (out == self.best[keys >> SHIFT]).astype(np.int64), out


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def document_rows(batches, paths: tuple[str, str]):
    """(doc_id, text) to (doc_id, figures, groups_sha256, pairs)."""
    from hashlib import sha256

    import numpy as np

    units = units_in_process(paths)
    for ids, texts in portions(batches):
        n = len(texts)
        flat, sizes = units.of(texts)
        doc = np.repeat(np.arange(n), sizes)
        bad = np.bincount(doc, weights=1 - units.figures[flat, 4], minlength=n) > 0
        sums = np.zeros((n, 4), np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            sums[full] = np.add.reduceat(units.figures[flat, :4], (np.cumsum(sizes) - sizes)[full], axis=0)
        sums[bad] = 0
        total = max(1, len(units.number))
        both, often = np.unique(doc * total + flat, return_counts=True)
        d, u = both // total, both % total
        counts = np.where(bad[d], 0, np.diff(units.starts)[u])
        at = ranges(units.starts[u], counts)
        own, keys, times = summed(np.repeat(d, counts), units.keys[at], units.times[at] * np.repeat(often, counts))
        ends = np.searchsorted(own, np.arange(n), "right").tolist()
        told, hashes, packed, begin, k = units.told, [], [], 0, 0
        for size, wrong, end in zip(sizes.tolist(), bad.tolist(), ends, strict=True):
            hashes.append("" if wrong or not size else sha256(";".join(map(told.__getitem__, flat[begin : begin + size].tolist())).encode()).hexdigest())
            packed.append(pack(keys[k:end], times[k:end]))
            begin, k = begin + size, end
        yield pa.RecordBatch.from_arrays([ids, *[pa.array(c) for c in sums.T.copy()], pa.array(hashes, pa.string()), pa.array(packed, pa.binary())], ["doc_id", *FIGURES, "groups_sha256", "pairs"])


def scored_rows(batches, look):
    """Rows of a document to its result: keys looked up, sums in place of the packed pairs."""
    import numpy as np

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            sizes, keys, times = unpacked(part.column(part.num_columns - 1))
            distinct, where = np.unique(keys, return_inverse=True)
            best, held = look(distinct)
            stop = np.cumsum(sizes)
            ends = [np.concatenate([[0], np.cumsum(x[where] * times)]) for x in (best, held)]
            n_best, count_sum = (pa.array(e[stop] - e[stop - sizes]) for e in ends)
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(5)], n_best, count_sum, part.column(5)], ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])


def pair_rows(batches):
    """(row, pairs) to (row, key, times): each pair of a document once."""
    import numpy as np

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            sizes, keys, times = unpacked(batch.column(1).slice(at, ROWS))
            own = batch.column(0).slice(at, ROWS).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.RecordBatch.from_arrays([own, pa.array(keys), pa.array(times)], ["row", "key", "times"])


def local_folder(spark: SparkSession) -> str | None:
    """The shared folder as a path that every task can open, if it is one."""
    found = shared_dir(spark)
    if "://" not in found and not found.startswith("file:"):
        if not spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            return None
        return found
    return re.sub("^file:/*", "/", found) if found.startswith("file:") else None


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(key, n) of a column ``pairs`` of packed keys: how many rows hold each pair of ids, the first id above the 32nd bit, sorted over range partitions."""
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = staged(pairs.select("pairs").mapInArrow(partial_counts, "key long, n long"), "pairs")
    return made.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(run_sums, "key long, n long")


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, lookup: str = "auto") -> DataFrame:
    """One row a document: its tokens, groups and links, and what the corpus knows of its pairs.

    ``lookup``: ``mapped`` (shards in the shared folder), ``joined``, or the first where it can be had.
    """
    spark = docs.sparkSession
    paths = paths or default_paths()
    figures = ", ".join(f"{x} long" for x in FIGURES)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    rows = staged(own.mapInArrow(lambda b: document_rows(b, paths), f"doc_id long, {figures}, groups_sha256 string, pairs binary"), "aligned")
    counts = pair_counts(rows)
    folder = None if lookup == "joined" else local_folder(spark)
    if folder is None:
        if lookup == "mapped":
            raise ValueError("spark.checkpoint.dir is no folder that tasks can map")
        return by_join(rows, counts)
    import numpy as np

    folder = f"{folder}/lexiforge/shards-{uuid.uuid4().hex}"
    os.makedirs(folder)
    held = counts.mapInArrow(lambda b: write_shard(b, folder), "shard string, first long, size long, a long, best long").toPandas()  # a row for each first id of a shard
    best = np.zeros(int(held["a"].max()) + 1 if len(held) else 1, np.int64)
    np.maximum.at(best, held["a"].to_numpy(np.int64), held["best"].to_numpy(np.int64))
    files = [tuple(x) for x in held[["shard", "first", "size"]].drop_duplicates().itertuples(index=False)]
    shared = spark.sparkContext.broadcast((files, best))  # a name for each shard, a figure for each id of the first vocabulary
    return rows.mapInArrow(lambda b: scored_rows(b, Shards(*shared.value)), f"doc_id long, {figures}, n_best long, count_sum long, groups_sha256 string")


def by_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same rows through an equi-join of each document's pairs with the counts."""
    counts = staged(counts, "pair_counts")
    numbered = staged(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    pairs = numbered.select("row", "pairs").mapInArrow(pair_rows, "row long, key long, times long")
    first = F.shiftright("key", SHIFT)
    best = counts.groupBy(first.alias("a")).agg(F.max("n").alias("best"))
    known = counts.join(best, first == F.col("a")).select("key", "n", (F.col("n") == F.col("best")).cast("long").alias("hit"))
    per = pairs.join(known, "key").groupBy("row").agg(F.sum(F.col("hit") * F.col("times")).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return numbered.join(per, "row", "left").select("doc_id", *FIGURES, zero("n_best"), zero("count_sum"), "groups_sha256")
