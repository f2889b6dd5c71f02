"""Best-fit packing of tokenised documents, in bulk-synchronous rounds.

Pieces are range-sorted by length and get their rank within their length from two
narrow passes (a count for each partition and length, then offsets). Only the number of
pieces of each length, ``capacity`` figures whatever the corpus, decides the packing:
a round takes all unplaced pieces of the greatest length and all gaps, run-length coded
by size; every piece seeks its successor, the smallest gap that holds it; where more
pieces than gaps meet, ranks decide and the rest go on to the next gap or to new
sequences; gaps shrink and the next round starts. That is best-fit decreasing, piece by
piece. The rounds' matches are ranges of ranks, and a sweep over the sorted pieces turns
them into sequence numbers and offsets.

Token ids come from the byte-level BPE file through a bounded cache of words: between
single spaces and single line ends the encoder treats each word by itself, so equal words
are encoded once. A text with other white space is encoded whole.

Defined cases: a null or empty text is one piece that holds only the end id; repeated
rows are packed as often as they occur; a null doc_id is carried through; an empty table
gives no pieces; a text beyond the capacity is cut, never shortened; ``pack`` replaces
columns named ``sequence_id`` or ``offset`` and carries all others; rows of ``pack`` whose
length is null or outside 1 to the capacity raise an error.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .common import row_key

CAPACITY = 2048
END_ID = 0
CACHE = 1_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to ids as little-endian 32-bit bytes, through a bounded cache of words."""

    def __init__(self, path: str):
        import json
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [x["content"] for x in json.load(f).get("added_tokens", ())]
        # A break before a space or around a line end is a break of the encoder's own
        # pattern only if no other white space is next to it.
        self.odd = re.compile(r"[^\S\n ]|[ \n](?=\s)|[ \n]\Z|\A\n")
        self.cache: dict[str, bytes] = {}
        self.ordinary = self._ranks(path)
        self.line_end = self._ids("\n")

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _ranks(self, path: str):
        """The same vocabulary as ranks, if its file lies beside: several times as fast for one word."""
        from base64 import b64decode

        import public_tokenizers
        import tiktoken

        beside = path.removesuffix(".json") + ".tiktoken"
        try:
            with open(beside, "rb") as f:
                ranks = {b64decode(a): int(b) for a, b in map(bytes.split, f)}
        except FileNotFoundError:
            return None
        if any(self.tokenizer.token_to_id(x) is None for x in ("a", "the")):
            return None
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _word(self, word: str) -> bytes:
        if len(self.cache) >= CACHE:
            self.cache.clear()
        found = self.cache[word] = self._plain(" " + word)
        return found

    def _plain(self, word: str) -> bytes:
        return array("I", self.ordinary(word)).tobytes() if self.ordinary else self._ids(word)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.odd.search(text) or any(x in text for x in self.special):
            return self._ids(text)
        cache, word, lines = self.cache, self._word, []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            out = [cache.get(x) or word(x) for x in rest]  # the cache holds words with their space
            lines.append(b"".join([self._plain(head), *out]) if head else b"".join(out))
        return self.line_end.join(lines)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_rows(batches, path: str, capacity: int, end_id: int, with_ids: bool = False):
    """(doc_id, text) to pieces (doc_id, piece, start, length, ids_crc32[, ids])."""
    from zlib import crc32

    encoder = Encoder(path)
    end = end_id.to_bytes(4, "little")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = memoryview(encoder.encode(text or "") + end)
            n = len(ids) // 4
            at, k = 0, 0
            while at < n:
                stop = at + (n - at) % capacity if k == 0 and (n - at) % capacity else at + capacity
                own = ids[4 * at : 4 * stop]
                for col, x in zip(out, (doc_id, k, at, stop - at, crc32(own), *[bytes(own)] * with_ids), strict=True):
                    col.append(x)
                at, k = stop, k + 1
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)


def tokenised_pieces(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Each row's pieces; with ``ids``, a binary column of unsigned little-endian 32-bit ids."""
    path = path or tokenizer_path()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("t"))
    return narrow.mapInArrow(lambda b: piece_rows(b, path, capacity, end_id, ids), PIECE + ", ids binary" * ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths: matches (length, rank from, rank to, sequence, offset).

    Ranks ``from <= r < to`` of a length go to sequences ``sequence + r - from`` at
    ``offset``. Gaps are kept as runs of sequences of equal gap.
    """
    from bisect import bisect_left, insort

    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, how many)
    sizes: list[int] = []
    made, out = 0, []

    def put(gap: int, first: int, many: int):
        if gap > 0 and many > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, many))

    def fill(length: int, gap: int, first: int, many: int, rank: int, left: int) -> int:
        """Fill ``many`` sequences one after the other, as best fit does with pieces of one length."""
        each = gap // length
        whole = min(many, left // each)
        one = min(left - whole * each, each) if whole < many else 0
        for k in range(each if whole else 0):
            out.append((length, rank + k * whole, rank + (k + 1) * whole, first, capacity - gap + k * length))
        for k in range(one):
            at = rank + whole * each + k
            out.append((length, at, at + 1, first + whole, capacity - gap + k * length))
        put(gap - each * length, first, whole)
        put(gap - one * length, first + whole, 1 if one else 0)
        put(gap, first + whole + (one > 0), many - whole - (one > 0))
        return whole * each + one

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            i = bisect_left(sizes, length)
            if i == len(sizes):  # no gap holds it
                gap, first, many = capacity, made, -(-left // (capacity // length))
                made += many
            else:
                gap = sizes[i]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(i)
            done = fill(length, gap, first, many, rank, left)
            rank, left = rank + done, left - done
    return out


_P = "__lf_pack_"


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows with a ``length`` to the same rows with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    pieces = staged(pieces.toDF(*[c if c in ("length", "ids") else f"{_P}{i}" for i, c in enumerate(names)]), "pieces")
    order = [F.col("length").desc(), *[F.col(c) for c in pieces.columns if c not in ("length", "ids")]]
    ranged = staged(pieces.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(_P + "part", F.spark_partition_id()), "ranged")
    each = ranged.groupBy("length", _P + "part").agg(F.count("*").alias("n"))
    # At most one row for each partition, and for each length: sorted ranges hardly overlap.
    before = Window.partitionBy("length").orderBy(_P + "part").rowsBetween(Window.unboundedPreceding, -1)
    runs = each.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).collect()
    counts: dict[int, int] = {}
    for r in runs:
        counts[r["length"]] = counts.get(r["length"], 0) + r["n"]
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"a piece must hold 1 to {capacity} tokens")
    by_length: dict[int, tuple[list, list, list]] = {}
    for length, start, _, sequence, offset in sorted(plan(counts, capacity)):
        for col, x in zip(by_length.setdefault(length, ([], [], [])), (start, sequence, offset), strict=True):
            col.append(x)
    first = {(r["length"], r[_P + "part"]): r["before"] for r in runs}
    schema = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    shared = spark.sparkContext.broadcast((by_length, first))  # runs of lengths: bounded by capacity and partitions

    # A partition's rows keep their order, so a row's rank is its place among its length's rows there.
    local = F.row_number().over(Window.partitionBy(_P + "part", "length").orderBy(*order[1:], F.monotonically_increasing_id()))
    ranked = ranged.withColumn(_P + "rank", local.cast("long") - 1)

    def place(batches):
        import numpy as np

        matches, before = shared.value
        tables = {k: tuple(np.array(x) for x in v) for k, v in matches.items()}
        for batch in batches:
            length, rank, part = (batch.column(c).to_numpy() for c in ("length", _P + "rank", _P + "part"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x, p in {*zip(length.tolist(), part.tolist(), strict=True)}:
                own = (length == x) & (part == p)
                start, at, off = tables[x]
                r = rank[own] + before[x, p]
                i = np.searchsorted(start, r, side="right") - 1
                sequence[own], offset[own] = at[i] + r - start[i], off[i]
            cols = {n: batch.column(n) for n in batch.schema.names if n not in (_P + "rank", _P + "part")}
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(sequence), pa.array(offset)], [*cols, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema).toDF(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for each piece of each row."""
    out = pack(tokenised_pieces(docs, text, path, capacity, ids=ids), capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * ids)


def pack_with_ids(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The rows of ``pack_documents`` with ``ids``, each piece's ids as unsigned little-endian 32-bit numbers.

    Only lengths are sorted and packed. The places of a text's pieces then go to the text,
    which is encoded once more where it lies, so ids are neither sorted nor staged. Rows
    equal in id and text share one text and bring their places to it.
    """
    path = path or tokenizer_path()
    key = row_key(F.col("doc_id").cast("long"), F.col(text))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("t"))
    numbered = rows.mapInArrow(lambda b: piece_lengths(b, path, capacity, end_id), "key binary, piece int, start long, length long")
    placed = pack(numbered, capacity).select("key", F.struct("piece", "start", "length", "sequence_id", "offset").alias("p"))
    places = placed.groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("p"))  # the pieces of one text
    one = rows.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("t").alias("t"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"
    return one.join(places, "key").select("doc_id", "t", "p").mapInArrow(lambda b: placed_rows(b, path, end_id), schema)


def piece_lengths(batches, path: str, capacity: int, end_id: int):
    """(key, doc_id, text) to (key, piece, start, length)."""
    for batch in batches:
        part = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(2)], ["doc_id", "t"])
        for made in piece_rows([part], path, capacity, end_id):
            yield pa.RecordBatch.from_arrays([batch.column(0).take(made.column(0)), *[made.column(i) for i in (1, 2, 3)]], ["key", "piece", "start", "length"])


def placed_rows(batches, path: str, end_id: int):
    """(doc_id, text, places) to one row a piece, with its ids."""
    from zlib import crc32

    encoder, end = Encoder(path), end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        size = 0
        for doc_id, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = encoder.encode(text or "") + end
            for p in places:
                own = ids[4 * p["start"] : 4 * (p["start"] + p["length"])]
                for col, x in zip(out, (doc_id, p["piece"], p["start"], p["length"], crc32(own), p["sequence_id"], p["offset"], own), strict=True):
                    col.append(x)
                size += len(own)
            if size >= 1 << 25:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)
                out, size = [[] for _ in names], 0
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)


def packed_sequences(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each of at most ``capacity`` ids."""
    d = pack_with_ids(docs, text, path, capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` pieces a sequence
    return d.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
