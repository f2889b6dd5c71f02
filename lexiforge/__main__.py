"""Build tables, rendering and reports from a folder of dictionary files.

    python -m lexiforge SOURCE OUTPUT [--patches F] [--verdicts F] [--adjudications F] [--languages F] [--register F --gram F --pos F] [--baseline F]

Paths may be any that Spark's readers and writers can open. ``LEXIFORGE_SOURCE`` and
``LEXIFORGE_OUTPUT`` stand in for the two folders.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.labels import BUILT_IN
from .functions.text import is_balanced
from .operators import release
from .plans.build import Dictionary
from .sources import tables as T
from .sources.dictionary import read_files, scan_files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexiforge", description="Build a dictionary's tables from its XML files.")
    p.add_argument("source", nargs="?", default=os.environ.get("LEXIFORGE_SOURCE"), help="folder of letter files (a.xml to z.xml, a_prep.xml)")
    p.add_argument("output", nargs="?", default=os.environ.get("LEXIFORGE_OUTPUT"), help="folder for tables, tei, reports and checksums")
    for name, what in (("patches", "corrections (TOML)"), ("verdicts", "role overrides (CSV)"), ("adjudications", "adjudicated locutions (TSV)"), ("languages", "language table (TOML)"), ("register", "register norms (TOML)"), ("gram", "grammar norms (TOML)"), ("pos", "part-of-speech tokens (TOML)"), ("baseline", "the counts that a build may not fall behind: it ends if more entries are malformed than the file's invalid ones")):
        p.add_argument("--" + name, help=what)
    return p


def build(spark: SparkSession, source: str, output: str, patches=None, verdicts=None, adjudications=None, languages=None, register=None, gram=None, pos=None, baseline=None) -> Dictionary:
    """Everything the command writes; (table, n_rows) and metrics are written beside the tables."""
    if any((register, gram, pos)) and not all((register, gram, pos)):
        raise ValueError("the norm tables belong together: --register, --gram and --pos")
    norms = T.read_norm_tables(spark, register, gram, pos) if register else BUILT_IN
    rows = scan_files(read_files(spark, source), T.read_patches(spark, patches) if patches else None)
    made = Dictionary(
        rows,
        verdicts=T.read_verdicts(spark, verdicts) if verdicts else None,
        adjudications=T.read_adjudications(spark, adjudications) if adjudications else None,
        tables=norms,
        languages=T.read_language_table(spark, languages) if languages else None,
    )
    if baseline:
        release.gate(made.rendered.where(~is_balanced(F.col("tei"))).count(), T.read_baseline(spark, baseline))
    counts = made.write(f"{output}/tables")
    counts.write.mode("overwrite").parquet(f"{output}/counts")
    made.metrics().write.mode("overwrite").parquet(f"{output}/metrics")
    made.write_tei(output)
    release.compress(spark.read.text(f"{output}/tei"), f"{output}/tei_gz")
    release.manifest(release.checksums(spark, f"{output}/tei_gz")).write.mode("overwrite").text(f"{output}/SHA256SUMS")
    return made


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    if not args["source"] or not args["output"]:
        parser().error("a source and an output folder are needed")
    spark = SparkSession.builder.appName("lexiforge").getOrCreate()
    build(spark, **args)
    for r in spark.read.parquet(f"{args['output']}/counts").orderBy("table_name").collect():
        print(f"{r['table_name']}\t{r['n_rows']}")
    flags = spark.read.parquet(f"{args['output']}/metrics").where(F.col("metric").startswith("flag ")).orderBy(F.desc("value"), "metric")
    for r in flags.collect():
        print(f"{r['metric']}\t{int(r['value'])}")


if __name__ == "__main__":
    main()
