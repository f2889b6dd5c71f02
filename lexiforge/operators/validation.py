"""Reading and counting what an external schema validator says of rendered entries.

Lines without a place, empty inputs and unknown files give no rows; nothing is dropped
from the counts but what names no source file.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MALFORMED = "not well-formed XML"


def _split(batches):
    """(path, text) to top-level entries, by a depth count over opening and closing tags."""
    import re

    for batch in batches:
        rows = []
        for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            depth, start, ord_ = 0, 0, 0
            for m in re.finditer(r"<entry\b|</entry>", text or ""):
                closes = m.group() == "</entry>"
                if not closes and depth == 0:
                    start = m.start()
                depth += -1 if closes else 1
                if closes and depth == 0:
                    part = text[start : m.end()]
                    found = re.search(r'xml:id="([^"]*)"', part)
                    rows.append((path, ord_, found.group(1) if found else "", part))
                    ord_ += 1
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], ["path", "entry_ord", "id", "fragment"])


def top_level_entries(files: DataFrame) -> DataFrame:
    """(path, entry_ord, id, fragment) of the outermost entries of each (path, text)."""
    return files.select("path", "text").mapInArrow(_split, "path string, entry_ord int, id string, fragment string")


def entry_spans(lines: DataFrame) -> DataFrame:
    """(file, id, first_line, last_line): each opening line to the first closing one after it."""
    id_ = F.regexp_extract("line", r'<entry\s+xml:id="([\w.]+)"', 1)
    d = lines.select("file", "number", "line", F.when(id_ != "", id_).alias("id"))
    d = d.withColumn("span", F.count("id").over(Window.partitionBy("file").orderBy("number"))).where("span > 0")
    d = d.groupBy("file", "span").agg(F.max("id").alias("id"), F.min("number").alias("first_line"), F.min(F.when(F.contains("line", F.lit("</entry>")), F.col("number"))).alias("last_line"))
    return d.where("last_line is not null").drop("span")


def messages(lines: DataFrame) -> DataFrame:
    """(source, line, signature) of validator output ``PATH.xml:line:col: level: message``."""
    text = F.col("value")
    path = F.regexp_extract(text, r"^(.*?\.xml):", 1)
    fatal = text.rlike(r"^.*?\.xml:\d+:\d+:\s*fatal")
    said = r"^.*?\.xml:\d+:\d+:\s*(?:error|fatal(?:\s+error)?):\s*(.*)$"
    signature = F.when(fatal, MALFORMED).when(text.rlike(said), F.regexp_extract(text, said, 1)).otherwise(F.concat(F.lit("unparsed validator output: "), F.trim(text)))
    number = F.expr("try_cast(nullif(regexp_extract(value, '[.]xml:([0-9]+):', 1), '') as int)")
    return lines.where(path != "").select(F.substring_index(path, "/", -1).alias("source"), number.alias("line"), signature.alias("signature"))


def rank_signatures(found: DataFrame) -> DataFrame:
    """(signature, n), the most frequent first, ties by text."""
    return found.groupBy("signature").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "signature")


def baseline(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(key, n) for total, valid and invalid of (source) entries."""
    bad = found.select("source").distinct().withColumn("bad", F.lit(True))
    d = entries.select("source").join(bad, "source", "left").agg(F.count("*").alias("total"), F.count_if(F.col("bad").isNull()).alias("valid"), F.count_if(F.col("bad").isNotNull()).alias("invalid"))
    return d.select(F.explode(F.create_map(F.lit("total"), "total", F.lit("valid"), "valid", F.lit("invalid"), "invalid")).alias("key", "n"))


def verdicts(spans: DataFrame, found: DataFrame) -> DataFrame:
    """(id, verdict): invalid if any message's line lies in the entry's span.

    Both sides meet on blocks of 1,024 lines, so no pair is formed outside a block.
    """
    block = F.explode(F.sequence(F.floor(F.col("first_line") / 1024), F.floor(F.col("last_line") / 1024)))
    s, m = spans.withColumn("block", block), found.select(F.col("source").alias("file"), "line", F.floor(F.col("line") / 1024).alias("block"))
    hit = s.join(m, ["file", "block"]).where("line between first_line and last_line").select("file", "id", "first_line").distinct().withColumn("hit", F.lit(True))
    return spans.join(hit, ["file", "id", "first_line"], "left").select("id", F.when(F.col("hit"), "invalid").otherwise("valid").alias("verdict"))


def errors_by_source(found: DataFrame) -> DataFrame:
    """(source, errors): every message of a rendered entry's file, in the order of its lines."""
    each = F.array_sort(F.collect_list(F.struct(F.coalesce("line", F.lit(0)).alias("line"), "signature")))
    return found.groupBy("source").agg(F.transform(each, lambda x: x["signature"]).alias("errors"))


def entry_results(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(id, errors) of each of ``entries(id, source)``: none if nothing is said of its file."""
    return entries.join(errors_by_source(found), "source", "left").select("id", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def baseline_lines(results: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """(part, n, value): the lines of a baseline file, to be written in the order of part, n and value.

    Counts, ranked signatures, messages outside any entry (``documents(value)``), and the
    invalid entries by id with their messages.
    """
    spark = results.sparkSession
    bad = F.size("errors") > 0
    c = results.agg(F.count("*").alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))
    named = [F.struct(F.lit(i).cast("long").alias("n"), F.concat(F.lit(k + "\t"), F.col(k).cast("string")).alias("value")) for i, k in enumerate(("total", "valid", "invalid"))]
    counts = c.select(F.lit(0).alias("part"), F.explode(F.array(*named)).alias("x")).select("part", "x.*")
    heads = spark.createDataFrame([(1, 0, "# ranked error signatures"), (3, 0, "# document-level errors"), (5, 0, "# invalid entries")], "part int, n long, value string")
    ranked = results.select(F.explode("errors").alias("s")).groupBy("s").agg(F.count("*").alias("k"))
    ranked = ranked.select(F.lit(2).alias("part"), (-F.col("k")).alias("n"), F.concat(F.col("k").cast("string"), F.lit("\t"), "s").alias("value"))
    invalid = results.where(bad).select(F.lit(6).alias("part"), F.lit(0).cast("long").alias("n"), F.concat("id", F.lit("\t"), F.array_join("errors", " | ")).alias("value"))
    out = counts.unionByName(heads).unionByName(ranked).unionByName(invalid)
    if documents is not None:
        said = documents.where(F.col("value").rlike(r"^.*?\.xml:\d+:\d+:\s*(?:error|fatal)"))
        out = out.unionByName(said.select(F.lit(4).alias("part"), F.lit(0).cast("long").alias("n"), F.trim("value").alias("value")))
    return out


def write_baseline(lines: DataFrame, folder: str) -> None:
    """The lines as text; parts in the order of their names make up the file."""
    lines.orderBy("part", "n", "value").select("value").write.mode("overwrite").text(folder)
