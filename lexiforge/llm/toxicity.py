"""Toxicity: a counterfactual-regularised linear classifier.

A logistic model over the set of a text's lower-cased words and of their beginnings
(``PREFIXES`` letters, which stand for a root with its endings). Its loss adds, for every
training sentence that names a group, the squared change of its score when the identity
term is swapped for another of the same kind, so that group names carry no weight of
their own and neutral mentions are not marked. Each term also comes in the neutral
sentences of ``TEMPLATES``, so terms that no labelled text holds are swapped as well.

Every feature has a place in a vector of ``WIDTH`` weights, its hash; none is left out for
being rare, and every swapped sentence of a training row is a pair. The one bound is
``TRAIN_ROWS``, the labelled rows that training takes, by a hash of id and text; it does not
depend on how rows are laid out. Scoring reads every whole text and adds up the broadcast
weights of its features.

Defined cases: null and empty texts get the score of no words at all; with no labels
every score is 0, with one class of them all are that class; a doc_id that is labelled
several times counts as toxic if any label is; rows equal in id and text teach once and are
scored alike; an empty table gives no rows; columns beyond the ones named are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder
from .langid import bounded_sample

TRAIN_ROWS = 10_000
WIDTH = 1 << 20
PREFIXES = (5, 6, 7, 8)
KNOWN = 200_000
DECAY = 3e-4

#: Neutral sentences that any identity term completes.
TEMPLATES = ("I met {} today", "the {} in our street", "they said that {} came", "a {} wrote this")

#: Identity terms by kind; terms of one kind are swapped for one another.
IDENTITY = {
    "gender": "woman women man men girl girls boy boys female male transgender femme femmes homme hommes frau frauen mann männer mujer mujeres hombre hombres".split(),
    "religion": "christian christians muslim muslims jewish jew jews hindu hindus buddhist buddhists atheist atheists catholic chrétien musulman juif christ christen moslem juden cristiano musulmán judío".split(),
    "origin": "african asian european american mexican chinese indian arab black white immigrant immigrants refugee refugees africain asiatique européen étranger ausländer afrikaner asiaten africano asiático europeo inmigrante".split(),
    "orientation": "gay lesbian straight bisexual homosexual heterosexual queer lesbienne lesbisch schwul homosexuel".split(),
    "ability": "deaf blind disabled autistic elderly young old sourd aveugle handicapé blinde taube ciego sordo".split(),
}
TERMS = {t: kind for kind, terms in IDENTITY.items() for t in terms}

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
SENTENCE = re.compile(r"[^.!?\n]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(words) -> set[str]:
    """Words and, marked with a star, the beginnings of longer ones."""
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


class Places:
    """The places of words' features in the weights, kept for a bounded number of words."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def word(self, w: str):
        from array import array

        from xxhash import xxh32_intdigest

        if len(self.known) >= KNOWN:
            self.known.clear()
        found = self.known[w] = array("i", [xxh32_intdigest(f.encode("utf-8", "replace")) % self.width for f in features([w])])
        return found

    def __call__(self, words):
        """Sorted places of a set of words, each once."""
        import numpy as np

        known = self.known
        found = {x for w in words for x in known.get(w) or self.word(w)}
        out = np.fromiter(found, np.int32, len(found))
        out.sort()
        return out


def swapped(words: set[str]) -> list[set[str]]:
    """A sentence's words with each identity term replaced by the next of its kind."""
    out = []
    for term in sorted(words & TERMS.keys()):
        kin = IDENTITY[TERMS[term]]
        out.append((words - {term}) | {kin[(kin.index(term) + 1) % len(kin)]})
    return out


_CODED = pa.schema([("toxic", pa.int32()), ("own", pa.binary()), ("other", pa.binary())])


def coded_rows(batches, width: int):
    """(toxic, text) to packed places: one row a text (other null), one for each swap of a sentence (toxic null)."""
    places = Places(width)
    for batch in batches:
        rows: list[dict] = []
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            w = words_of(text)
            rows.append({"toxic": y, "own": places(w).tobytes(), "other": None})
            for s in SENTENCE.findall(text) if w & TERMS.keys() else ():
                own = words_of(s)
                rows += [{"toxic": None, "own": places(own).tobytes(), "other": places(x).tobytes()} for x in swapped(own)]
        yield pa.RecordBatch.from_pylist(rows, _CODED)


def template_pairs(width: int = WIDTH) -> list[tuple[bytes, bytes]]:
    """Places of each neutral sentence with each term, and with the next term of its kind."""
    places, out = Places(width), []
    for sentence in TEMPLATES:
        for term in sorted(TERMS):
            own = words_of(sentence.format(term))
            out += [(places(own).tobytes(), places(x).tobytes()) for x in swapped(own)]
    return out


def fit(toxic, sets, pairs, size: int, fairness: float = 1.0, decay: float = DECAY, rounds: int = 300):
    """Labels and packed places of their texts, and pairs (places, places of the swapped sentence), to (bias, weights).

    The loss: each text's logistic loss by a weight of its class, ``fairness`` times the mean
    squared change of the pairs' scores, and ``decay`` times the sum of the weights' sizes and
    of half their squares. Accelerated proximal steps set a weight to nothing unless what it
    explains outweighs the decay; so most words of one text alone keep none.
    """
    import numpy as np

    y = np.array(toxic, float)
    total = [int((y == k).sum()) for k in (0, 1)]
    if not total[0] or not total[1]:
        return (-20.0 if not total[1] else 20.0), np.zeros(size)
    n, k = len(y), len(pairs)
    rows = [*sets, *(a for a, _ in pairs), *(b for _, b in pairs)]
    sizes = np.array([len(x) // 4 for x in rows])
    held, x = np.unique(np.frombuffer(b"".join(rows), np.int32), return_inverse=True)  # all other places keep a weight of 0
    full = np.flatnonzero(sizes)
    begin = (np.cumsum(sizes) - sizes)[full]
    order = np.argsort(x, kind="stable")
    by_place = np.repeat(np.arange(len(rows)), sizes)[order]
    first = np.searchsorted(x[order], np.arange(len(held)))

    def scores(w):
        out = np.zeros(len(rows))
        if len(full):
            out[full] = np.add.reduceat(w[x], begin)
        return out

    def back(of_rows):
        return np.add.reduceat(of_rows[by_place], first) if len(held) else np.zeros(0)

    balance = np.where(y == 1, 0.5 * n / total[1], 0.5 * n / total[0]) ** 0.75 / n  # toxic rows are rare

    def slopes(z, bias):
        """The slope of each row's score, and of the bias."""
        err = balance * (1 / (1 + np.exp(-np.clip(z[:n] + bias, -40, 40))) - y)
        pull = 2 * fairness / max(1, k) * (z[n : n + k] - z[n + k :])
        return np.concatenate([err, pull, -pull]), err.sum()

    # The greatest curvature, by a power iteration, gives the step.
    v, most = np.random.default_rng(1).normal(size=len(held) + 1), 1.0
    for _ in range(30):
        v /= np.sqrt((v * v).sum()) or 1.0
        z = scores(v[:-1])
        bent, pull = balance / 4 * (z[:n] + v[-1]), 2 * fairness / max(1, k) * (z[n : n + k] - z[n + k :])
        v = np.append(back(np.concatenate([bent, pull, -pull])), bent.sum())
        most = np.sqrt((v * v).sum())
    step = 1 / (1.1 * most + 1e-9)
    w, bias = np.zeros(len(held)), float(np.log((total[1] + 0.5) / (total[0] + 0.5)))
    ahead, ahead_bias, t = w, bias, 1.0
    for _ in range(rounds):
        of_rows, of_bias = slopes(scores(ahead), ahead_bias)
        moved = ahead - step * back(of_rows)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * decay, 0) / (1 + step * decay)
        new_bias = ahead_bias - step * of_bias
        if ((ahead - new) * (new - w)).sum() + (ahead_bias - new_bias) * (new_bias - bias) > 0:
            t = 1.0  # the pace points away from the slope: begin anew
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / after * (new - w), new_bias + (t - 1) / after * (new_bias - bias)
        w, bias, t = new, new_bias, after
    out = np.zeros(size)
    out[held] = w
    return float(bias), out


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, width: int = WIDTH, fairness: float = 1.0):
    """Rows (doc_id, text, toxic) to (bias, weights)."""
    import numpy as np

    sample = bounded_sample(labelled.where("toxic is not null").dropDuplicates(["doc_id", "text"]), train_rows, key=("doc_id", "text"))
    made = sample.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(lambda b: coded_rows(b, width), "toxic int, own binary, other binary")
    got = made.toArrow()  # TRAIN_ROWS texts, four bytes a feature, and their swaps
    label = got.column(0).to_numpy()
    own, other = got.column(1).to_pylist(), got.column(2).to_pylist()
    rows = sorted((int(label[i]), own[i]) for i in range(len(own)) if other[i] is None)
    pairs = sorted({(own[i], other[i]) for i in range(len(own)) if other[i] is not None} | set(template_pairs(width)))
    if not rows:
        return -1e9, np.zeros(width)
    return fit([y for y, _ in rows], [x for _, x in rows], pairs, width, fairness)


#: Texts that a worker holds as strings at a time.
PART = 256
SCORED = "doc_id long, held_out boolean, score double"


def scored_rows(batches, bias: float, shared):
    """(doc_id, held_out, text) to SCORED; of a batch's texts a part at a time is laid out as strings."""
    from math import exp

    weight = shared.value
    places = Places(len(weight))
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, PART):
            for text in batch.column(2).slice(at, PART).to_pylist():
                z = bias + float(weight[places(words_of(text))].sum())
                out.append(1 / (1 + exp(-z)) if z > -700 else 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["doc_id", "held_out", "score"])


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; held-out labels are not read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), (remainder() == 0).alias("held_out"))
    y = labels.where("toxic is not null").where(remainder() != 0).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = bounded_sample(y.where("doc_id is not null"), TRAIN_ROWS)
    bias, weights = train(rows.where("not held_out").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # WIDTH doubles
    # Texts end in the workers: no row waits in Spark for its score.
    out = rows.select("doc_id", "held_out", "text").mapInArrow(lambda b: scored_rows(b, bias, shared), SCORED)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
