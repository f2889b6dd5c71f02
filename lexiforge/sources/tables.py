"""Loaders of the side tables: corrections, norms, languages, verdicts, adjudications, baselines.

Files are read through Spark, so any path its readers can open will do. Tables that steer
the router or the scan are small and made by hand; they come to the driver. Verdicts and
adjudications stay distributed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import NormTables
from ..functions.text import strip

ROLES = ("Figurative", "DomainLabel", "NatureLabel", "CrossReference", "RegisterLabel", "Proverb", "VoiceTransition", "Locution", "Unclassified")


def _text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row[0] if row else ""


def _toml(spark: SparkSession, path: str) -> dict:
    import tomllib

    text = _text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return tomllib.loads(text)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """(ord, line) of a file, from 0; None if there is no such file."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))


def read_patches(spark: SparkSession, path: str) -> list[dict]:
    """Corrections {file, line, old, new} in order; none if the file is absent."""
    import tomllib

    text = _text(spark, path)
    return [dict(p) for p in tomllib.loads(text).get("patches", [])] if text else []


def read_norm_tables(spark: SparkSession, register: str, gram: str, pos: str) -> NormTables:
    """The router's tables from three TOML files."""
    r, g, p = (_toml(spark, x) for x in (register, gram, pos))
    rules = lambda name: [(x["pattern"], x["type"], x["norm"]) for x in r.get(name, [])]
    pairs = lambda table: {k: tuple(v) for k, v in table.items()}
    return NormTables(
        construction=dict(g.get("construction", {})),
        agreement=pairs(g.get("agreement", {})),
        pos_heads=pairs(p.get("heads", {})),
        pos_modifiers=pairs(p.get("modifiers", {})),
        pos_head_sensitive=pairs(p.get("head_sensitive", {})),
        pos_connectors=tuple(p.get("connectors", {}).get("tokens", ())),
        usage_exact=pairs(r.get("exact", {})),
        usage_prefix=rules("prefix"),
        usage_lemma=rules("lemma"),
        usage_domain=rules("domain_prefix"),
    )


def read_language_table(spark: SparkSession, path: str) -> tuple[dict[str, tuple[str, str]], frozenset]:
    """({name: (code, expansion)}, dotted tokens that are no language) from a TOML file."""
    t = _toml(spark, path)
    return {k: (v["code"], v.get("expand", "")) for k, v in t["language"].items()}, frozenset(t["non_language"]["skip"])


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, source_line, check, verdict, ord) of a comma-separated file with a header.

    Fields are split at every comma, without quoting. Rows whose role is unknown are left
    out (``unknown_verdicts`` lists them); ``ord`` is the line, so the last of a key counts.
    """
    return _verdicts(spark, path).where(F.col("verdict").isin(*ROLES))


def unknown_verdicts(spark: SparkSession, path: str) -> DataFrame:
    return _verdicts(spark, path).where(~F.coalesce(F.col("verdict").isin(*ROLES), F.lit(False)))


def _verdicts(spark: SparkSession, path: str) -> DataFrame:
    lines = _lines(spark, path)
    if lines is None:
        return spark.createDataFrame([], "source_file string, source_line int, check string, verdict string, ord int")
    first = lines.where("ord = 0").first()
    head = [h.strip() for h in first["line"].split(",")] if first else []
    fields = F.split("line", ",")

    def named(name: str) -> Column:
        return strip(F.get(fields, F.lit(head.index(name)))) if name in head else F.lit(None).cast("string")

    d = lines.where("ord > 0").where(strip(F.col("line")) != "")
    columns = {"source_file": named("file"), "source_line": named("line").cast("int"), "check": F.coalesce(named("check"), F.lit("")), "verdict": named("llm_role")}
    return d.select(*[c.alias(n) for n, c in columns.items()], "ord")


def read_adjudications(spark: SparkSession, path: str) -> DataFrame:
    """(xml_id, label) of a tab-separated file: a header, then rows of four fields; the last of an id counts."""
    lines = _lines(spark, path)
    if lines is None:
        return spark.createDataFrame([], "xml_id string, label string")
    f = F.split("line", "\t")
    d = lines.where("ord > 0").where(F.size(f) == 4).select(f[0].alias("xml_id"), f[3].alias("label"), "ord")
    return d.groupBy("xml_id").agg(F.max_by("label", "ord").alias("label"))


def read_expected(spark: SparkSession, path: str) -> DataFrame:
    """(id, verdict) of the expected verdicts of probe entries."""
    lines = _lines(spark, path)
    if lines is None:
        raise FileNotFoundError(path)
    f = F.split("line", "\t")
    return lines.where("ord > 0").where(F.size(f) == 2).select(f[0].alias("id"), strip(f[1]).alias("verdict"))


def read_baseline(spark: SparkSession, path: str) -> int:
    """The number of invalid entries a baseline file allows."""
    text = _text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    for line in text.split("\n"):
        fields = line.split("\t")
        if len(fields) == 2 and fields[0] == "invalid":
            return int(fields[1])
    raise ValueError(f"no invalid count in {path}")
