"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target over its size is the expected number of copies of each of its
documents: a whole part, and a fraction that is rounded. Two fractional documents of a
source exchange mass (probability times size) at random, so that one becomes integral,
every expectation stays as it was, and the source's total is kept exactly. What is left
of a leaf (one document) meets the leftovers of other leaves in the next level of a
reduction tree of bounded fan-in; at the root one document a source is rounded by a
draw. A source's taken words therefore miss its target by one document's size at most.

Draws are hashes of the document and the level, so reruns agree. Leaves are salted, so
a source of any share of the rows is dealt out over many tasks.

Targets are worked out in one task over one row a source; tens of thousands of sources
are little work there.

Defined cases: a null or blank text has size 0 and takes nothing; a null source is a
source of its own, last in order; repeated rows are rounded one by one; an empty table
gives no rows, and if all sizes are 0 all targets are; columns of ``docs`` with clashing
names are carried by ``resample`` and not read by ``mix``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .common import row_key, word_count

WEIGHTS = (3, 1, 2)
LEAF = 4096
FAN_IN = 64
SEED = 17


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The targets are weight * level, cut at ``most`` times the source's size, where the
    level spends ``share`` of all sizes: what resharing the excess by weight ends with.
    One row a source is left when the windows run.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_code = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.get(by_code, (F.row_number().over(ordered) - 1) % len(weights)))
    per = per.withColumn("cap", F.lit(most) * F.col("source_size"))
    whole = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "left": F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(filled), F.lit(0.0)),
            "open": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(filled), F.lit(0.0)),
        }
    )
    # Going up by cap / weight, a source is cut while the level of those still open lies above it.
    per = per.withColumn("cut", F.col("left") / F.col("open") * F.col("w") >= F.col("cap"))
    # Beyond the first open source the quotient only falls, so the greatest is the level.
    level = F.max(F.when(~F.col("cut"), F.col("left") / F.col("open"))).over(whole)
    return per.withColumn("target", F.when(F.col("cut") | level.isNull(), F.col("cap")).otherwise(F.col("w") * level)).select("source", "source_size", "target")


def round_groups(batches, level: int, names: list[str]):
    """Sorted rows (source, leaf, draw, size, copies, part) with at most one row a leaf left fractional.

    ``part`` is null once a row is integral. State is one open row a leaf.
    """
    from xxhash import xxh64_intdigest

    def draw(a, b):
        return xxh64_intdigest(f"{SEED}/{level}/{a}/{b}".encode()) / 2.0**64

    def as_batch(rows):
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    schema, open_row = None, None
    for batch in batches:
        schema = batch.schema
        out = []
        for row in batch.to_pylist():
            if row["part"] is None or row["size"] == 0:
                row["part"] = None  # an empty document takes no words either way
                out.append(row)
                continue
            if open_row is not None and (open_row["source"], open_row["leaf"]) != (row["source"], row["leaf"]):
                out.append(open_row)
                open_row = None
            if open_row is None:
                open_row = row
                continue
            a, b = open_row, row
            up = min((1 - a["part"]) * a["size"], b["part"] * b["size"])  # a gains, b loses
            down = min(a["part"] * a["size"], (1 - b["part"]) * b["size"])
            if draw(a["draw"], b["draw"]) * (up + down) < down:
                gain, lose, mass = a, b, up
            else:
                gain, lose, mass = b, a, down
            full = (1 - gain["part"]) * gain["size"] <= mass
            empty = lose["part"] * lose["size"] <= mass
            gain["part"] = 1.0 if full else gain["part"] + mass / gain["size"]
            lose["part"] = 0.0 if empty else lose["part"] - mass / lose["size"]
            open_row = None
            for x in (a, b):
                if x["part"] <= 0.0 or x["part"] >= 1.0:
                    x["copies"] += int(x["part"] >= 1.0)
                    x["part"] = None
                    out.append(x)
                else:
                    open_row = x
        if out:
            yield as_batch(out)
    if open_row is not None:
        yield as_batch([open_row])


def mixed_rows(rows: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """Rows (doc_id, source, size, draw) with source_size, target and copies."""
    rows = staged(rows, "sizes")
    targets = source_targets(rows.select("source", "size"), share, most, weights)
    total = rows.count()
    leaves = max(1, -(-total // LEAF))
    t = targets.withColumnRenamed("source", "__s")
    d = rows.join(t, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    d = d.withColumn("copies", F.floor(rate).cast("long"))
    d = d.withColumn("part", F.when(rate - F.col("copies") > 0, rate - F.col("copies")))
    d = d.withColumn("leaf", F.pmod(F.col("draw"), F.lit(leaves)))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = d.columns
    done, level = [], 0
    while True:
        schema = d.schema
        dealt = d.repartition(parts, "source", "leaf").sortWithinPartitions("source", "leaf", "draw", "doc_id", "size")
        d = staged(dealt.mapInArrow(lambda b, level=level: round_groups(b, level, names), schema), "rounded")
        done.append(d.where("part is null"))
        d = d.where("part is not null")
        if leaves == 1:
            break
        leaves = -(-leaves // FAN_IN)
        level += 1
        d = d.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("long"))
    last = F.pmod(F.xxhash64("draw", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30) < F.col("part")
    out = d.withColumn("copies", F.col("copies") + last.cast("long"))
    for x in done:
        out = out.unionByName(x)
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("part", "leaf")


def draw_key(docs: DataFrame, text: str = "text"):
    return F.xxhash64(F.col("doc_id"), F.col("source"), F.col(text))


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each row of ``docs``."""
    return mixed_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col(text)).alias("size"), draw_key(docs, text).alias("draw"))).drop("draw")


def resample(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, none for those left out.

    Decisions are made on narrow rows; rows equal in id, source and text share the sum of
    their copies, dealt evenly.
    """
    kept = list(docs.columns)
    key = row_key(F.col("doc_id"), F.col("source"), F.col(text))
    made = mixed_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col(text)).alias("size"), draw_key(docs, text).alias("draw"), key.alias("key")))
    total = staged(made.groupBy(F.col("key").alias("__lf_draw")).agg(F.sum("copies").alias("__lf_all"), F.count("*").alias("__lf_rows")), "copies")
    rows = docs.withColumn("__lf_key", key).join(total.where("__lf_all > 0"), F.col("__lf_key") == F.col("__lf_draw"))
    if total.where("__lf_rows > 1").isEmpty():
        copies = F.col("__lf_all")
    else:
        w = Window.partitionBy("__lf_key").orderBy(F.col("doc_id"))
        rows = rows.withColumn("__lf_i", F.row_number().over(w))
        copies = F.floor(F.col("__lf_all") / F.col("__lf_rows")) + (F.col("__lf_i") <= F.col("__lf_all") % F.col("__lf_rows")).cast("long")
    return rows.withColumn("__lf_again", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(*[F.col(f"`{c}`") for c in kept])
