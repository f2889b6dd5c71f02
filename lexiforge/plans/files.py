"""Queries that go through files: folders of sources, side tables, written tables, documents and reports.

Inputs are small texts of our own, written to the shared folder first and read back by the
loaders under test; outputs are written there and read back too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import labels as N
from ..functions.etymology import segments
from ..operators import lookup as L
from ..operators import release as R
from ..operators import validation as V
from ..operators.publish import Publication
from ..sources import tables as T
from ..sources.dictionary import read_files, scan_files
from ..staging import shared_dir
from . import sample


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/lexiforge/{label}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, label: str, text: str, name: str | None = None) -> str:
    """A file of the shared folder that holds ``text``, by way of Hadoop's file system."""
    folder = _folder(spark, label)
    path = f"{folder}/{name or label}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(text.encode()))
    out.close()
    return path


def scan_folder(spark, d):
    """Several letter files and one that is none, in the order of their names."""
    folder = _file(spark, "b.xml", "<xmllittre><entree terme='B'><corps><variante>b</variante></corps></entree></xmllittre>").rsplit("/", 1)[0]
    for name, word in (("a.xml", "A"), ("a_prep.xml", "A2"), ("notes.xml", "N")):
        text = f"<xmllittre>\n<entree terme='{word}'><corps>\n<variante>x<indent>y</indent></variante></corps></entree></xmllittre>"
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
        out.write(bytearray(text.encode()))
        out.close()
    files = read_files(spark, folder)
    order = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "file_ord")
    rows = scan_files(files).where("kind <> 'citation'").select("source_file", "entry_ord", "kind", F.array_join("path", ".").alias("path"), "headword", "content", "source_line")
    return rows.join(order, "source_file").select("file_ord", *rows.columns)


def load_patches(spark, d):
    """Corrections of a file, applied in order; only the first occurrence on a line changes."""
    toml = '[[patches]]\nfile = "c.xml"\nline = 2\nold = "un"\nnew = "deux"\n\n[[patches]]\nfile = "c.xml"\nline = 2\nold = "deux"\nnew = "trois"\n\n[[patches]]\nfile = "d.xml"\nline = 1\nold = "zzz"\nnew = "y"\n'
    patches = T.read_patches(spark, _file(spark, "patches.toml", toml)) + T.read_patches(spark, _folder(spark, "absent"))
    text = "<xmllittre><entree terme='C'><corps>\n<variante>un mot, un autre</variante></corps></entree></xmllittre>"
    rows = scan_files(spark.createDataFrame([("/x/c.xml", text)], "path string, text string"), patches)
    return rows.where("kind = 'sense'").select("source_file", "content", F.lit(len(patches)).alias("n_patches"))


_VERDICTS = "file,line,check,heuristic_role,llm_role\nv.xml,24,Autre chose,Unclassified,RegisterLabel\n\nv.xml,24,Autre,Unclassified, Figurative\nv.xml,25,Pas ce texte,Unclassified,Figurative\nv.xml,26,,Unclassified,Nonsense\n"


def load_verdicts(spark, d):
    """Role overrides: split at every comma, unknown roles left out, the last of a key counts."""
    path = _file(spark, "verdicts.csv", _VERDICTS)
    known = T.read_verdicts(spark, path)
    last = L.last_of(known, ["source_file", "source_line"], ["ord"]).withColumn("state", F.lit("used"))
    left_out = T.unknown_verdicts(spark, path).withColumn("state", F.lit("unknown role"))
    return last.unionByName(left_out).select("source_file", "source_line", "check", "verdict", "state")


def load_adjudications(spark, d):
    """Labels by block id: rows of four fields only, the last of an id counts."""
    text = "xml_id\torth\tdef\tlabel\na_s1.1\tx\ty\tidiom\na_s1.1\tx\ty\tmetonymic_subsense\na_s1.2\tx\tproverb\nb_s1.1\tx\ty\tproverb\n"
    found = T.read_adjudications(spark, _file(spark, "labels.tsv", text))
    return found.unionByName(T.read_adjudications(spark, _folder(spark, "absent")))


_REGISTER = '[exact]\n"argot" = ["socioCultural", "slang"]\n[[prefix]]\npattern = "par jeu"\ntype = "attitude"\nnorm = "playful"\n[[lemma]]\npattern = "vieux"\ntype = "temporal"\nnorm = "old"\n[[domain_prefix]]\npattern = "terme d"\ntype = "domain"\nnorm = ""\n'
_GRAM = '[construction]\n"seul" = "alone"\n[agreement]\n"au duel" = ["number", "dual"]\n'
_POS = '[heads]\n"n." = ["pos", "noun"]\n[modifiers]\n"c." = ["gender", "common"]\n[head_sensitive]\n"x.|n." = ["subtype", "proper"]\n[connectors]\ntokens = ["et"]\n'


def load_norms(spark, d):
    """The router with tables of its own instead of the built-in ones."""
    t = T.read_norm_tables(spark, *[_file(spark, f"{n}.toml", x) for n, x in (("register", _REGISTER), ("gram", _GRAM), ("pos", _POS))])
    labels = ["n. c.", "n. x.", "x.", "argot", "par jeu de mots", "mot vieux", "terme d'art", "seul et au duel", "familièrement", "s. m."]
    r = spark.createDataFrame([(x,) for x in labels], "label string").select("label", F.explode(N.route(F.col("label"), t)).alias("r"))
    return r.select("label", "r.printed", "r.target", F.array_join(F.transform("r.elements", lambda e: F.concat(e["kind"], F.lit("="), e["norm"])), " ").alias("reading"))


def load_languages(spark, d):
    """The segmenter with a language table of its own: ``lat.`` is unknown to it."""
    toml = '[language]\n"klg." = { code = "tlh", expand = "klingon", note = "x" }\n"v. klg." = { code = "tlh-x-old" }\n[non_language]\nskip = ["voy."]\n'
    languages = T.read_language_table(spark, _file(spark, "languages.toml", toml))
    lines = ["klg. <i>ab</i>", "du v. klg. <i>ab</i>, mot", "lat. <i>ab</i>"]
    e = spark.createDataFrame([(x,) for x in lines], "line string").select("line", F.posexplode(segments(F.col("line"), *languages)).alias("i", "s"))
    return e.select("line", "i", "s.kind", "s.cit_type", "s.language", F.col("s.cue.expand").alias("expand"), "s.gloss", "s.text")


_PROBE = '<body>\n<entry xml:id="a">\n<sense/>\n</entry>\n<entry xml:id="b">\n<bad/>\n</entry>\n<entry xml:id="c">\n</entry>\n</body>'
_SAID = ["/t/probe.xml:6:3: error: element bad not allowed", "/t/probe.xml:99:1: error: elsewhere", "noise"]


def probe_verdicts(spark, d):
    """Observed against expected verdicts of probe entries, mismatches first."""
    numbered = spark.createDataFrame([("probe.xml", i, x) for i, x in enumerate(_PROBE.split("\n"), 1)], "file string, number int, line string")
    found = V.messages(spark.createDataFrame([(x,) for x in _SAID], "value string"))
    observed = V.verdicts(V.entry_spans(numbered), found)
    expected = T.read_expected(spark, _file(spark, "expected.tsv", "entry\tverdict\na\tvalid\nb\tvalid\nd\tinvalid\ntoo\tmany\tfields\n"))
    return L.compare(observed, expected, "id", "verdict").orderBy("agrees", "id")


def validation_report(spark, d):
    """The lines of a baseline: counts, ranked signatures, document messages, invalid entries."""
    entries = spark.createDataFrame([(f"e{i}", f"{i}.xml") for i in range(1, 6)], "id string, source string")
    said = ["/t/2.xml:1:1: error: b wrong", "/t/2.xml:3:1: error: a wrong", "/t/4.xml:1:1: error: a wrong", "/t/5.xml:2:2: fatal: broken", "noise"]
    whole = spark.createDataFrame([("/t/corpus.xml:3:1: error: header wrong ",), ("nothing",)], "value string")
    lines = V.baseline_lines(V.entry_results(entries, V.messages(spark.createDataFrame([(x,) for x in said], "value string"))), whole)
    folder = _folder(spark, "baseline")
    V.write_baseline(lines.repartition(3), folder)
    floor = T.read_baseline(spark, _file(spark, "baseline.tsv", "\n".join(r["value"] for r in lines.orderBy("part", "n", "value").collect())))
    R.gate(3, floor)
    return spark.read.text(folder)


def corpus_fragments(spark, d):
    """The outermost entries of a rendered document, dealt into batches of two."""
    from .queries import dictionary

    whole = dictionary(spark, "rich").rendered.orderBy("source_file", "entry_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_file", "entry_ord", "tei"))), lambda x: x["tei"]), "\n").alias("text"))
    parts = V.top_level_entries(whole.select(F.lit("corpus.xml").alias("path"), "text"))
    return R.batches(parts, ["path", "entry_ord"], 2).select("entry_ord", "id", "batch", F.md5("fragment").alias("fragment_md5"))


def tei_document(spark, d):
    """The written document, read back: its first and last lines and what it holds."""
    from .queries import dictionary

    folder = _folder(spark, "document")
    dictionary(spark, "rich").write_tei(folder)
    files = spark.read.text(f"{folder}/tei").withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    numbered = files.select("value", F.regexp_extract("file", r"part-(\d+)", 1).alias("part"), F.monotonically_increasing_id().alias("n"))
    ends = numbered.agg(F.min_by("value", F.struct("part", "n")).alias("first_line"), F.max_by("value", F.struct("part", "n")).alias("last_line"), F.count("*").alias("n_lines"))
    entries = numbered.where("value like '  <entry %'").agg(F.count("*").alias("n_entries"), F.min_by("value", F.struct("part", "n")).alias("first_entry"))
    hoists = spark.read.csv(f"{folder}/reports/def_usg_hoists", sep="\t", header=True).agg(F.count("*").alias("n_hoists"))
    prose = spark.read.csv(f"{folder}/reports/pron_prose_flags", sep="\t", header=True).agg(F.count("*").alias("n_prose"))
    one = F.lit(1).alias("k")
    out = ends.select(one, "*")
    for x in (entries, hoists, prose):
        out = out.join(x.select(one, "*"), "k")
    return out.drop("k")


def written_tables(spark, d):
    """The six tables as written, with their rows and columns."""
    from .queries import dictionary

    folder = _folder(spark, "tables")
    counts = dictionary(spark, "rich", d).write(folder)
    columns = spark.createDataFrame([(n, ",".join(t.columns)) for n, t in Publication(spark, folder).read().items()], "table_name string, columns string")
    return counts.join(columns, "table_name")


def stored_index(spark, d):
    """Terms of the senses with their frequencies, from the stored postings."""
    from .queries import dictionary, index_of

    dictionary(spark, sf_dir=d).register(("senses",))
    index = index_of(spark, (d or "small", "senses plain"), lambda: spark.table("senses").select("sense_id", F.col("content_plain").alias("t")), "sense_id", "t", unique=True)
    return index.terms().where("cf > 1")


def release_manifest(spark, d):
    """Checksums of compressed parts, checked against what the parts hold."""
    folder = _folder(spark, "release")
    R.compress(spark.createDataFrame([("un",), ("deux",)], "value string").coalesce(1), folder)
    sums = R.checksums(spark, folder)
    lines = R.manifest(sums).where(F.col("value").rlike(r"^[0-9a-f]{64}  part-.*\.txt\.gz$"))
    held = spark.read.text(folder).agg(F.lit(1).alias("k"), F.array_join(F.array_sort(F.collect_list("value")), " ").alias("held"))
    return lines.agg(F.lit(1).alias("k"), F.count("*").alias("n_files")).join(held, "k").drop("k")


def corrected_sample(spark, d):
    """Lines of the rich sample's scan whose text a correction changed."""
    files = spark.createDataFrame(sample.FILES["rich"], "path string, text string")
    before, after = (scan_files(files, p).where("kind = 'rubrique'").select("source_file", "source_line", "content") for p in (None, sample.PATCHES["rich"]))
    return after.exceptAll(before)


FILE_QUERIES = (scan_folder, load_patches, load_verdicts, load_adjudications, load_norms, load_languages, probe_verdicts, validation_report, corpus_fragments, tei_document, written_tables, stored_index, release_manifest, corrected_sample)
