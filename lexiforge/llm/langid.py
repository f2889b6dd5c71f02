"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed grams of one to three characters of each language in a bounded
sample of the labelled rows (``TRAIN_ROWS``, chosen by a hash of id and text). The
log-probability matrix (``BUCKETS`` rows, one column a language, fixed point) is broadcast,
and a batch of texts is scored as a sparse product: gram rows are gathered and summed by
text in numpy. Every whole text is scored, in parts of bounded size. A gram never reaches
over its text's end and sums are of whole numbers, so a prediction depends on its text
alone, whatever rows share its batch.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with no
labelled rows at all every text is ``und``; ties go to the first language by code point;
repeated rows are scored alike; an empty table gives no rows; columns beyond the ones named
are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
TRAIN_ROWS = 20_000
SMOOTHING = 0.5
PIECE = 1 << 18
#: Log probabilities are kept as whole multiples of 1 / ONE.
ONE = 1 << 20


def gram_buckets(chars, order: int, buckets: int = BUCKETS):
    """Bucket of the gram of ``order`` characters that starts at each place of ``chars`` (uint32)."""
    import numpy as np

    n = len(chars) - order + 1
    h = chars[:n] + np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)
    for i in range(1, order):
        h = h * np.uint32(0x01000193) ^ chars[i : n + i]
    h = h * np.uint32(0x85EBCA6B)
    return (h >> np.uint32(16)) % np.uint32(buckets)


def characters(text: str):
    """The lower-cased characters of a text between two blanks, as uint32."""
    import numpy as np

    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)


def _pieces(texts):
    """Parts of bounded size laid end to end: (characters, which text, where each begins, how many grams start in it)."""
    import numpy as np

    held, who, starts, size = [], [], [], 0

    def flush():
        lengths = np.array([len(x) for x in held])
        return np.concatenate(held), np.array(who), np.r_[0, np.cumsum(lengths)[:-1]], np.array(starts)

    for i, text in enumerate(texts):
        chars = characters(text)
        for at in range(0, len(chars), PIECE):
            part = chars[at : at + PIECE + max(ORDERS) - 1]  # grams of the part's last places
            held.append(part)
            who.append(i)
            starts.append(min(PIECE, len(part)))
            size += len(part)
            if size >= PIECE:
                yield flush()
                held, who, starts, size = [], [], [], 0
    if held:
        yield flush()


def part_grams(texts, buckets: int = BUCKETS):
    """For each order of each run of parts: (bucket by place, which text, where each part begins).

    Places where no gram of that order starts have the bucket ``buckets``.
    """
    import numpy as np

    for chars, who, begin, starts in _pieces(texts):
        end = np.r_[begin[1:], len(chars)]
        for order in ORDERS:
            out = np.full(len(chars), buckets, np.int64)
            h = gram_buckets(chars, order, buckets) if len(chars) >= order else out[:0]
            out[: len(h)] = h
            # A gram starts in its part's own places and ends before the part does.
            last = np.minimum(begin + starts, end - order + 1)
            for k in range(order + max(ORDERS)):
                place = last + k
                out[place[(place >= begin) & (place < end)]] = buckets
            yield out, who, begin


def count_rows(batches, buckets: int):
    """(lang, text) to partial counts (lang, bucket, n), one table a partition."""
    import numpy as np

    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            t = tables.setdefault(lang, np.zeros(buckets, np.int64))
            for grams, _, _ in part_grams(texts, buckets):
                t += np.bincount(grams, minlength=buckets + 1)[:buckets]
    for lang, t in tables.items():
        at = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(t[at])], ["lang", "bucket", "n"])


def bounded_sample(rows: DataFrame, most: int, seed: int = 5, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """About ``most`` of ``rows`` at most, by a hash of ``key``; all of them if they are fewer."""
    n = rows.count()
    if n <= most:
        return rows
    # 60 bits of the hash: the share stays above 0 for any number of rows.
    return rows.where(F.shiftrightunsigned(F.xxhash64(*key, F.lit(seed)), 4) < (1 << 60) * most // n)


def log_matrix(table):
    """Counts (bucket, language) to smoothed log probabilities in fixed point, with a row of zeros for no gram."""
    import numpy as np

    p = np.log((table + SMOOTHING) / (table + SMOOTHING).sum(axis=0, keepdims=True))
    return np.vstack([np.rint(p * ONE).astype(np.int64), np.zeros((1, table.shape[1]), np.int64)])


def train(labelled: DataFrame, buckets: int = BUCKETS, train_rows: int = TRAIN_ROWS):
    """Rows (doc_id, text, lang) to (languages, matrix)."""
    import numpy as np

    sample = bounded_sample(labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text"), train_rows, key=("doc_id", "text"))
    counts = sample.select("lang", "text").mapInArrow(lambda b: count_rows(b, buckets), "lang string, bucket long, n long")
    got = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS at most
    langs = sorted(got["lang"].unique().tolist())
    table = np.zeros((buckets, len(langs)))
    for i, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        table[own["bucket"].to_numpy(), i] = own["n"].to_numpy()
    # Priors are left uniform: the text decides.
    return langs, log_matrix(table)


def score_texts(texts, names, weights) -> list[dict]:
    """{lang_pred, score} of each text."""
    import re

    import numpy as np

    letter = re.compile(r"[^\W\d_]")
    open_ = [i for i, t in enumerate(texts) if names and t and letter.search(t)]
    out: list[dict] = [{"lang_pred": "und", "score": 0.0}] * len(texts)
    if not open_:
        return out
    columns = [np.ascontiguousarray(weights[:, j]) for j in range(len(names))]
    none = len(weights) - 1
    sums = np.zeros((len(open_), len(names)), np.int64)
    grams = np.zeros(len(open_), np.int64)
    for place, who, begin in part_grams([texts[i] for i in open_], none):
        np.add.at(grams, who, np.add.reduceat((place != none).astype(np.int64), begin))
        for j, w in enumerate(columns):
            np.add.at(sums[:, j], who, np.add.reduceat(w[place], begin))
    # The posterior of an average stretch of text: whole texts would all read 1.
    z = (sums - sums.max(axis=1, keepdims=True)) / ONE / np.maximum(1.0, grams / 150.0)[:, None]
    best = sums.argmax(axis=1)
    for i, k, row in zip(open_, best.tolist(), z.tolist(), strict=True):
        share = sum(np.exp(x) for x in row)
        out[i] = {"lang_pred": names[k], "score": min(1.0, max(0.0, float(1.0 / share)))}
    return out


def predictor(spark, langs, weights):
    """A Column function text -> struct(lang_pred, score)."""
    shared = spark.sparkContext.broadcast((langs, weights))  # BUCKETS rows, a column a language

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(col: pa.Array) -> pa.Array:
        return pa.array(score_texts(col.to_pylist(), *shared.value), pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))

    return predict


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", held_out: Column | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row; held-out rows teach nothing."""
    held = remainder() == 0 if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held.alias("held_out"))
    langs, weights = train(rows.where("not held_out"))
    found = rows.select("doc_id", "held_out", predictor(docs.sparkSession, langs, weights)(F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
