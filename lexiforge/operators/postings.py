"""Postings packed where texts stand: what is exchanged and stored is a term with its rows, not a row for each word.

Arrow batches of rows with their words are laid together in portions of bounded size. Words
become codes, codes and rows are counted as whole numbers, and each term of a portion gives one row.
"""

from __future__ import annotations

import pyarrow as pa

#: Words of a portion, more only where rows that belong together hold more.
PORTION = 1 << 20


def varints(x):
    """Unsigned numbers with seven bits a byte, the high bit on all bytes of a number but its last; and where each begins, with the end."""
    import numpy as np

    x = x.astype(np.uint64)
    size = np.ones(len(x), np.int64)
    for b in range(1, 10):
        size += x >= np.uint64(1 << 7 * b)
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(begin[-1], np.uint8)
    for b in range(int(size.max(initial=0))):
        held = size > b
        out[begin[:-1][held] + b] = (x[held] >> np.uint64(7 * b)).astype(np.uint8) & 127 | ((size[held] > b + 1) << 7).astype(np.uint8)
    return out, begin


def numbers(packed: bytes):
    """The numbers that ``varints`` packed."""
    import numpy as np

    raw = np.frombuffer(packed, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def portions(batches, most: int = PORTION):
    """Tables of about ``most`` words (lists in the last column); neighbours that agree in the first column stay together."""
    import numpy as np
    import pyarrow.compute as pc

    held, words, limit = [], 0, most
    for batch in batches:
        sums, at = np.cumsum(pc.list_value_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False)), 0
        while at < len(sums):
            before = sums[at - 1] if at else 0
            to = min(len(sums), max(at + 1, int(np.searchsorted(sums, before + limit - words, "right"))))
            held.append(batch.slice(at, to - at))
            words, at = words + int(sums[to - 1] - before), to
            if words < limit:
                continue
            t = pa.Table.from_batches(held)
            first = t.column(0).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            other = np.flatnonzero(first != first[-1])
            if not len(other):
                limit = 2 * words
                continue
            yield t.slice(0, other[-1] + 1).combine_chunks()
            held, limit = t.slice(other[-1] + 1).to_batches(), most
            words = sum(int(pc.sum(pc.list_value_length(b.column(b.num_columns - 1))).as_py() or 0) for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def counted_words(words, rows, n: int):
    """Words of lists, and a whole number below ``n`` for each list, to (terms, term, row, tf), in the order of term codes, then of rows."""
    import numpy as np

    lists = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(rows, lists.value_lengths().to_numpy(zero_copy_only=False))
    code, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, n) + row, return_counts=True)
    return coded.dictionary, code // max(1, n), code % max(1, n), tf


PACKED = "term string, first long, n long, cf long, packed binary"


def packed_postings(batches):
    """(key, words) to PACKED: keys as steps from the one before, beside the word's count there and the key's words.

    Rows of one key, if neighbours, are one text. Rows without a key count for ``cf`` alone.
    """
    import numpy as np

    for t in portions(batches):
        unknown = t.column(0).is_null().to_numpy()
        for of, known in ((~unknown, True), (unknown, False)):
            if not of.any():
                continue
            d = t.filter(pa.array(of))
            keys, rows = np.unique(d.column(0).fill_null(0).to_numpy(), return_inverse=True)
            lists = d.column(1).combine_chunks()
            length = np.bincount(rows, lists.value_lengths().to_numpy(zero_copy_only=False), len(keys)).astype(np.int64)
            terms, term, row, tf = counted_words(lists, rows, len(keys))
            if not len(term):
                continue
            key, begin = keys[row], np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
            step = np.diff(key, prepend=0)
            step[begin] = 0
            raw, at = varints(np.stack([step.astype(np.uint64), tf.astype(np.uint64), length[row].astype(np.uint64)], 1).ravel())
            ends = np.concatenate([at[3 * begin], [len(raw)]]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            n = np.diff(np.append(begin, len(term))) * known
            first = pa.array(key[begin], pa.int64(), mask=np.full(len(begin), not known))
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(term[begin])), first, pa.array(n, pa.int64()), pa.array(np.add.reduceat(tf, begin), pa.int64()), packed], ["term", "first", "n", "cf", "packed"])


POSTING = "term string, key long, tf long, length long"


def unpacked(batches):
    """(term, first, packed) to POSTING."""
    import numpy as np

    names = [x.split()[0] for x in POSTING.split(", ")]
    for batch in batches:
        for term, first, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = numbers(packed).reshape(-1, 3).astype(np.int64)
            key = pa.array(np.cumsum(x[:, 0]) + (first or 0), pa.int64(), mask=np.full(len(x), first is None))
            yield pa.RecordBatch.from_arrays([pa.array([term] * len(x), pa.string()), key, pa.array(x[:, 1]), pa.array(x[:, 2])], names)


def blocks_of(batches, width: int):
    """(range, gap, key, words) to a block for each term of a range, and one without a term that holds its rows' keys."""
    import numpy as np

    for t in portions(batches):
        range_, gap, lists = t.column(0).to_numpy(), t.column(1).to_numpy(), t.column(3).combine_chunks()
        length = lists.value_lengths().to_numpy(zero_copy_only=False)
        of = (range_ - range_[0]) * width + gap  # a row's number in the portion
        size = int(of[-1]) + 1
        lengths = np.zeros(size, np.int32)
        lengths[of] = length
        terms, term, row, tf = counted_words(lists, of, size)
        own = row // width
        begin = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (own[1:] != own[:-1])])[: len(term)])
        names = ["term", "range", "gaps", "tfs", "lengths", "keys"]

        def lists_of(x, begin, kind=None):
            values = x if isinstance(x, pa.Array) else pa.array(x, kind or pa.int32())
            return pa.ListArray.from_arrays(pa.array(np.append(begin, len(x)), pa.int32()), values)

        keys = t.column(2).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [terms.take(pa.array(term[begin])), pa.array(range_[0] + own[begin], pa.int64()), lists_of(row % width, begin), lists_of(tf, begin), lists_of(lengths[row], begin), pa.nulls(len(begin), pa.list_(keys.type))], names
        )
        begin = np.flatnonzero(np.concatenate([[True], range_[1:] != range_[:-1]]))
        yield pa.RecordBatch.from_arrays([pa.nulls(len(begin), pa.string()), pa.array(range_[begin], pa.int64()), lists_of(gap, begin), lists_of(np.zeros(len(gap)), begin), lists_of(length, begin), lists_of(keys, begin)], names)
