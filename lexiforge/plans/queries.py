"""Queries of the engine: the documented questions over a dictionary derived from the given documents, and operators over the given tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as N
from ..functions import text as T
from ..operators import lookup as L
from ..operators import sequence as S
from ..operators.observed import counted
from ..operators.scan import items_before
from ..sources.dictionary import scan_files
from . import derived, given, goldens, sample
from .build import TABLES, TEXT_RULES, Dictionary, role_by_text
from .derived import LEADS
from .files import FILE_QUERIES

# -- the user's SQL over the built tables -----------------------------------------------

_LIST = "SELECT e.headword, s.sense_id,{} s.content_plain FROM senses s JOIN entries e ON e.entry_id = s.entry_id WHERE s.sense_type = '{}' ORDER BY e.headword, s.sense_id"
_OPEN = "(resolution IS NULL OR resolution = '')"

#: The documented questions; ``:name`` is a parameter.
USER_SQL = {
    "dict_q01_vocabularies": "SELECT DISTINCT 'sense_type' AS kind, sense_type AS value FROM senses UNION SELECT DISTINCT 'role', role FROM senses WHERE role IS NOT NULL UNION SELECT DISTINCT 'rubrique', rubrique_type FROM rubriques ORDER BY kind, value",
    "dict_q02_entry": "SELECT entry_id, headword, homograph_index, pronunciation, pos, is_supplement, source_letter FROM entries WHERE headword = :headword",
    "dict_q03_top_senses": "SELECT s.sense_id, s.num, s.sense_type, s.role, s.content_plain FROM senses s JOIN entries e ON e.entry_id = s.entry_id WHERE e.headword = :headword AND s.parent_sense_id IS NULL ORDER BY COALESCE(s.num, 999999), s.sense_id",
    "dict_q04_tree": "SELECT s.sense_id, s.parent_sense_id, s.depth, s.num, s.indent_id, s.xml_id, s.sense_type, s.role, s.transition_type, s.transition_form, s.transition_pos, s.content_plain FROM senses s JOIN entries e ON e.entry_id = s.entry_id WHERE e.headword = :headword ORDER BY s.sense_id",
    "dict_q05_children": "SELECT child.sense_id, child.parent_sense_id, child.depth, child.num, child.sense_type, child.role, child.content_plain FROM senses child WHERE child.parent_sense_id = :sense_id ORDER BY child.sense_id",
    "dict_q05_descendants": "WITH RECURSIVE below AS (SELECT sense_id, parent_sense_id, xml_id, 0 AS steps FROM senses WHERE sense_id = :sense_id UNION ALL SELECT s.sense_id, s.parent_sense_id, s.xml_id, b.steps + 1 FROM senses s JOIN below b ON s.parent_sense_id = b.sense_id) SELECT sense_id, xml_id, steps FROM below ORDER BY sense_id",
    "dict_q06_figurative": _LIST.format(" s.indent_id,", "figurative"),
    **{f"dict_q{n:02d}_{kind}": _LIST.format("", kind) for n, kind in zip(range(7, 11), ("domain", "register", "proverb", "cross_reference"), strict=True)},
    "dict_q11_locutions": "SELECT e.headword, l.canonical_form, s.sense_id, s.content_plain FROM locutions l JOIN senses s ON s.sense_id = l.sense_id JOIN entries e ON e.entry_id = s.entry_id ORDER BY l.canonical_form",
    "dict_q12_locution_like": "SELECT e.headword, l.canonical_form, s.content_plain FROM locutions l JOIN senses s ON s.sense_id = l.sense_id JOIN entries e ON e.entry_id = s.entry_id WHERE l.canonical_form ILIKE :pattern ORDER BY e.headword",
    "dict_q13_transitions": "SELECT e.headword, s.sense_id, s.parent_sense_id, s.depth, s.sense_type, s.transition_type, s.transition_form, s.transition_pos, s.content_plain FROM senses s JOIN entries e ON e.entry_id = s.entry_id WHERE s.sense_type IN ('transition_group', 'homonymic_entry', 'usage_group') ORDER BY e.headword, s.sense_id",
    "dict_q14_citations": "SELECT e.headword, s.sense_id, c.citation_id, c.author, c.resolved_author, c.reference, c.text_plain FROM citations c JOIN senses s ON s.sense_id = c.sense_id JOIN entries e ON e.entry_id = s.entry_id WHERE e.headword = :headword ORDER BY s.sense_id, c.citation_id",
    "dict_q15_by_author": "SELECT e.headword, s.sense_id, c.reference, c.text_plain FROM citations c JOIN senses s ON s.sense_id = c.sense_id JOIN entries e ON e.entry_id = s.entry_id WHERE c.resolved_author = :author ORDER BY e.headword, s.sense_id, c.citation_id",
    "dict_q16_hidden": "SELECT e.headword, s.sense_id, c.reference, c.text_plain FROM citations c JOIN senses s ON s.sense_id = c.sense_id JOIN entries e ON e.entry_id = s.entry_id WHERE c.is_hidden = 1 ORDER BY e.headword, s.sense_id",
    "dict_q17_rubriques": "SELECT e.headword, r.rubrique_type, r.content_plain FROM rubriques r JOIN entries e ON e.entry_id = r.entry_id WHERE e.headword = :headword ORDER BY r.rubrique_id",
    "dict_q18_history": "SELECT e.headword, r.content_plain FROM rubriques r JOIN entries e ON e.entry_id = r.entry_id WHERE r.rubrique_type = 'Historique' ORDER BY e.headword",
    "dict_q19_review": f"SELECT review_id, entry_id, headword, phase, flag_type, reason, context FROM review_queue WHERE {_OPEN} ORDER BY phase, flag_type, headword",
    "dict_q20_review_counts": f"SELECT phase, flag_type, COUNT(*) AS n FROM review_queue WHERE {_OPEN} GROUP BY phase, flag_type ORDER BY n DESC, phase, flag_type",
    "dict_q21_objects": """SELECT e.headword, coalesce(s.n, 0) AS n_senses, coalesce(c.n, 0) AS n_citations, coalesce(l.n, 0) AS n_locutions, coalesce(r.n, 0) AS n_rubriques FROM entries e
      LEFT JOIN (SELECT entry_id, count(*) AS n FROM senses GROUP BY entry_id) s ON s.entry_id = e.entry_id
      LEFT JOIN (SELECT entry_id, count(*) AS n FROM citations JOIN senses USING (sense_id) GROUP BY entry_id) c ON c.entry_id = e.entry_id
      LEFT JOIN (SELECT entry_id, count(*) AS n FROM locutions JOIN senses USING (sense_id) GROUP BY entry_id) l ON l.entry_id = e.entry_id
      LEFT JOIN (SELECT entry_id, count(*) AS n FROM rubriques GROUP BY entry_id) r ON r.entry_id = e.entry_id ORDER BY n_senses DESC, e.headword""",
    "dict_q24_supplements": "SELECT entry_id, headword, pos FROM entries WHERE is_supplement = 1 ORDER BY headword",
    "dict_q24_supplement_senses": "SELECT xml_id, content_plain FROM senses WHERE is_supplement = 1",
    "dict_q25_sense_types": "SELECT sense_type, COUNT(*) AS n FROM senses GROUP BY sense_type ORDER BY n DESC, sense_type",
    "dict_q26_roles": "SELECT role, COUNT(*) AS n FROM senses WHERE role IS NOT NULL GROUP BY role ORDER BY n DESC, role",
    "dict_q27_suspects": "SELECT entry_id, headword, reason, context FROM review_queue WHERE flag_type = 'suspect_language_token' ORDER BY headword",
    "dict_rq1_by_poet": "SELECT e.headword, c.text_plain, c.reference FROM citations c JOIN senses s USING (sense_id) JOIN entries e USING (entry_id) WHERE c.resolved_author = :author",
    "dict_rq2_with_figurative": "SELECT DISTINCT e.headword FROM entries e JOIN senses s USING (entry_id) WHERE s.sense_type = 'figurative'",
    "dict_rq3_unclassified": "SELECT e.headword, s.content_plain FROM senses s JOIN entries e USING (entry_id) WHERE s.role = 'Unclassified'",
    "dict_rq4_text_like": "SELECT e.headword, s.content_plain FROM senses s JOIN entries e USING (entry_id) WHERE s.content_plain ILIKE :pattern",
    "dict_starter_entries": "SELECT headword, pos FROM entries ORDER BY headword, entry_id LIMIT 20",
    "dict_starter_senses": "SELECT e.headword, s.sense_type, s.role, s.content_plain FROM senses s JOIN entries e ON e.entry_id = s.entry_id WHERE e.headword = :headword ORDER BY s.sense_id",
}

#: Questions that only show the texts of senses: what they find is known before a text is fetched.
LATE = ("dict_q03_top_senses", "dict_q11_locutions")

#: The values the registered queries ask with: of the dictionary derived from documents, and of the small sample.
DERIVED_ARGUMENTS = {"headword": "MOT 7", "author": "DUVAL", "sense_id": 1, "dict_q12_locution_like": "%LOC 1%", "dict_rq4_text_like": "%marine%"}
SEARCHED = {"senses": ["terme", "marine"], "citations": ["the"]}
ARGUMENTS = {"headword": "PANIER", "author": "DUVAL", "sense_id": 1, "dict_q12_locution_like": "%PANIER%", "dict_rq4_text_like": "%jupes%"}


_built: dict[tuple[str, str], Dictionary] = {}
#: The documents go through the shuffle in so many slices, one after the other.
SLICES = 4
#: Bytes of the documents' text in a bucket of entries: sorts of its rows stay in memory.
BUCKET = 4 << 20


def dictionary(spark: SparkSession, name: str = "small", sf_dir: str = "") -> Dictionary:
    """The dictionary derived from a folder's documents or, without a folder, one of the small samples; built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir or name)
    if key not in _built:
        if sf_dir:
            docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
            # The documents are dealt out, not the XML that is made of them: it says each line twice.
            size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
            parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
            slices = [docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)) == i) for i in range(SLICES)]
            by_entry = [scan_files(derived.source_files(derived.dealt(x, parts)), dealt=True) for x in slices]
            scanned, more = scan_files(derived.source_files(docs), dealt=True), {"verdicts": derived.verdicts(docs), "by_entry": by_entry, "buckets": parts}
        else:
            scanned = scan_files(spark.createDataFrame(sample.FILES[name], "path string, text string"), sample.PATCHES.get(name))
            more = {} if name == "small" else {"verdicts": spark.createDataFrame(sample.VERDICTS, "source_file string, source_line int, check string, verdict string, ord int"), "adjudications": spark.createDataFrame(sample.ADJUDICATIONS, "xml_id string, label string")}
        _built[key] = Dictionary(scanned, **more)
    return _built[key]


def ask(spark: SparkSession, name: str, **arguments) -> DataFrame:
    """A documented question over the registered tables, with its parameters by name."""
    sql = USER_SQL[name]
    return spark.sql(sql, args={k: v for k, v in arguments.items() if ":" + k in sql})


def _user(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql, made = USER_SQL[name], dictionary(spark, sf_dir=sf_dir)
        late = name in LATE
        texts = not late and re.search(r"content_|\b(context|review_id)\b", sql) is not None
        made.register(tuple(t for t in TABLES if re.search(rf"\b{t}\b", sql)), texts=texts, late=late)
        values = DERIVED_ARGUMENTS if sf_dir else ARGUMENTS
        found = ask(spark, name, **(values | {"pattern": values.get(name)}))
        return made.with_late_texts(found) if late else found

    return run


_indexes: dict[tuple, L.Index] = {}


def index_of(spark: SparkSession, name: tuple, rows, key: str, text: str, unique: bool = False) -> L.Index:
    """The stored index of a table, built once a session."""
    at = (spark.sparkContext.applicationId, *name)
    if at not in _indexes:
        _indexes[at] = L.Index(rows(), key, text, unique)
    return _indexes[at]


def search(spark: SparkSession, view: str, key: str, text: str, terms: list[str], sf_dir: str = "") -> DataFrame:
    """(key, score) of the rows of a registered view that hold every term, case and accents folded."""
    folded = F.regexp_replace(T.nfkd(F.lower(text)), r"\p{M}", "")
    return index_of(spark, (sf_dir or "small", view), lambda: spark.table(view).select(key, folded.alias("t")), key, "t", unique=True).search(terms)


def dict_q22_search_senses(spark, d):
    dictionary(spark, sf_dir=d).register(("entries", "senses"))
    hits = search(spark, "senses", "sense_id", "content_plain", SEARCHED["senses"] if d else ["corbeille"], d)
    found = hits.join(spark.table("senses"), "sense_id").join(spark.table("entries"), "entry_id")
    return found.orderBy("score", "sense_id").select("sense_id", "headword", "sense_type", "content_plain")


def dict_q23_search_citations(spark, d):
    dictionary(spark, sf_dir=d).register(("entries", "senses", "citations"), texts=False)
    hits = search(spark, "citations", "citation_id", "text_plain", SEARCHED["citations"] if d else ["panier", "vide"], d)
    c = hits.join(spark.table("citations"), "citation_id").join(spark.table("senses").select("sense_id", "entry_id"), "sense_id").join(spark.table("entries"), "entry_id")
    return c.orderBy("score", "citation_id").select("citation_id", "headword", "resolved_author", "reference", "text_plain")


def dict_etymology_segments(spark, d):
    e = dictionary(spark, sf_dir=d).etymology.select("entry_id", F.posexplode("segments").alias("i", "s"))
    return e.select("entry_id", "i", "s.kind", "s.cit_type", "s.language", F.array_join("s.forms", ", ").alias("forms"), "s.gloss", "s.text")


# -- whole tables, of the derived dictionary or of a second sample that holds every role, rubrique and flag -----


def rich_senses(spark, d):
    """All columns of every block, scoped, overridden and adjudicated."""
    return dictionary(spark, "rich", d).table("senses")


def rich_entries(spark, d):
    return dictionary(spark, "rich", d).table("entries")


def rich_resumes(spark, d):
    return dictionary(spark, "rich", d).entries.where("resume_text <> ''").select("entry_id", "resume_text")


def rich_citations(spark, d):
    return dictionary(spark, "rich", d).table("citations")


def rich_locutions(spark, d):
    return dictionary(spark, "rich", d).table("locutions")


def rich_forms(spark, d):
    """Where each form comes from, proverbs included."""
    return dictionary(spark, "rich", d).senses.where("canonical_form_source <> 'none'").select("xml_id", "role", "method", "canonical_form", "canonical_form_source")


def rich_rubriques(spark, d):
    return dictionary(spark, "rich", d).table("rubriques")


def rich_flags(spark, d):
    """The review queue in order, without the sample."""
    return dictionary(spark, "rich", d).table("review_queue").where("flag_type <> 'calibration_sample'").select("review_id", "entry_id", "phase", "flag_type", "reason", "context")


def rich_samples(spark, d):
    """How many of each bucket are sampled: five at most."""
    q = dictionary(spark, "rich", d).table("review_queue", texts=False).where("flag_type = 'calibration_sample'")
    return q.groupBy("reason").agg(F.count("*").alias("n"))


def rich_metrics(spark, d):
    return dictionary(spark, "rich", d).metrics()


def rich_mismatches(spark, d):
    return dictionary(spark, "rich", d).verdict_mismatches()


def rich_tei(spark, d):
    """The rendered entries, line by line."""
    lines = dictionary(spark, "rich").rendered.select("entry_id", F.posexplode(F.split("tei", "\n")).alias("i", "line"))
    return lines.select("entry_id", "i", "line")


def rich_hoists(spark, d):
    return dictionary(spark, "rich").hoists()


def rich_pronunciations(spark, d):
    return dictionary(spark, "rich").prose_pronunciations()


def dict_pos_readings(spark, d):
    dictionary(spark, sf_dir=d).register(("entries",))
    e = spark.table("entries").select("entry_id", F.explode(N.parse_pos(F.col("pos"))).alias("g"))
    return e.select("entry_id", "g.kind", "g.norm", "g.printed")


ROUTED = ("s. m. et f.", "v. a. et n.", "Familièrement et par plaisanterie", "Populairement encore", "Terme de marine", "Au plur.", "Absolument aussi", "Inusité")
BARE = ("Populairement encore, une ficelle", "Substantivement et au neutre. Le beau.", "Absolument.", "Une chose.")


def _dealt(spark, d: str, texts: tuple[str, ...], name: str) -> DataFrame:
    """One of ``texts`` for each document in turn or, without a folder, each of them once."""
    if not d:
        return spark.createDataFrame([(x,) for x in texts], f"{name} string")
    return _t(spark, d, "documents").select("doc_id", F.get(F.array(*[F.lit(x) for x in texts]), (F.col("doc_id") % len(texts)).cast("int")).alias(name))


def route_labels(spark, d):
    rows = _dealt(spark, d, ROUTED, "label")
    r = rows.select("*", F.explode(N.route(F.col("label"))).alias("r"))
    return r.select(*rows.columns, "r.printed", "r.target", F.array_join(F.transform("r.elements", lambda e: F.concat(e["kind"], F.lit("="), e["norm"])), " ").alias("reading"))


def bare_labels(spark, d):
    rows = _dealt(spark, d, BARE, "block")
    return rows.select("*", N.split_bare_label(F.col("block")).alias("s")).select(*rows.columns, "s.label", "s.rest")


# -- the same operators over the driver's tables ----------------------------------------


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def author_locf(spark, d):
    e = _t(spark, d, "events")
    a = F.when(F.col("event_type") == "error", "ID.").when(F.col("event_type") == "view", "").otherwise(F.upper("event_type"))
    return S.resolve_idem(e.withColumn("author", a), ["user_id"], ["ts", "event_id"]).select("event_id", "author", "resolved_author")


def id_dedup(spark, d):
    p = _t(spark, d, "part").select("p_partkey", T.make_id(F.col("p_name")).alias("id"))
    return S.number_repeats(p, [], ["p_partkey"], "id")


def scope_inter(spark, d):
    c = _t(spark, d, "conversations")
    return S.islands(c, ["conv_id"], ["turn"], F.col("role") == "user").select("conv_id", "turn", "island", F.col("rank").cast("long").alias("rank"), F.col("size").cast("long").alias("size"))


def scope_intra(spark, d):
    e = _t(spark, d, "events")
    return S.islands(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "island", F.col("rank").cast("long").alias("rank"))


def neighbour_texts(spark, d):
    c = _t(spark, d, "conversations")
    return S.neighbours(c, ["conv_id"], ["turn"], F.col("text")).select("conv_id", "turn", "prev_text", "next_text")


def path_ids(spark, d):
    """Words numbered over all documents: documents by the words before them, words by their place."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    marks = F.length("text") - F.length(F.translate("text", " \n", ""))
    numbered = items_before(docs, ["doc_id"], marks + 1, "before")
    places = F.flatten(F.transform(F.split("text", "\n"), lambda line, i: F.transform(F.split(line, " "), lambda _, j: F.struct((i + 1).alias("i"), (j + 1).alias("j")))))
    w = numbered.select("doc_id", "before", F.posexplode(places).alias("at", "w"))
    return w.select((F.col("before") + F.col("at") + 1).alias("node_id"), F.concat_ws(".", F.col("doc_id").cast("string"), F.col("w.i").cast("string"), F.col("w.j").cast("string")).alias("xml_id"))


def stratified(spark, d):
    x = S.stratified_sample(_t(spark, d, "documents"), ["lang", "source"], [F.col("doc_id").cast("string")])
    return x.select("lang", "source", "doc_id", "bucket_size")


def island_first_last(spark, d):
    c = S.islands(_t(spark, d, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user").where("island > 0 and rank > 0")
    return S.island_ends(c, ["conv_id", "island"], "turn", F.col("text"))


def strip_tags(spark, d):
    return _t(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("plain"))


def escape_xml(spark, d):
    return _t(spark, d, "pages").select("page_id", T.escape_xml(F.col("html")).alias("escaped"))


def _targets(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("ref"))


def xref_targets(spark, d):
    return _targets(spark, d).groupBy("page_id").agg(F.count("*").alias("n"), F.min("ref").alias("first_ref"))


def dangling_refs(spark, d):
    return _targets(spark, d).join(_t(spark, d, "pages").select(F.col("url").alias("ref")).distinct(), "ref", "left_anti").groupBy("ref").agg(F.count("*").alias("n"))


_RULES = [("^PROMO.*BRASS$", "promo brass"), ("BRASS$", "brass"), ("^STANDARD", "standard"), ("^(SMALL|MEDIUM|LARGE)", "sized")]


def first_match_rules(spark, d):
    p = _t(spark, d, "part").select("p_type", L.first_match(F.col("p_type"), _RULES, "hint").alias("label"))
    return p.groupBy("label").agg(F.count("*").alias("n"))


def led_lines(spark, d):
    """(turn, role) of every line of every document, led in by an opening in turn, and of every opening that stands alone."""
    lines = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    turn = F.pmod(F.col("doc_id") + F.col("i"), F.lit(len(LEADS) + 3)).cast("int")
    alone = F.when(turn == len(LEADS), "Au fém.").when(turn == len(LEADS) + 1, "Vieillie.").when(turn == len(LEADS) + 2, "Avec un nom de chose")
    text = F.coalesce(alone, F.concat(F.get(F.array(*[F.lit(x) for x in LEADS]), turn), "line"))
    return lines.select(turn.alias("turn"), role_by_text(text).alias("role"))


def cascade_classify(spark, d):
    return led_lines(spark, d).groupBy("turn", "role").agg(F.count("*").alias("n"))


def observed_roles(spark, d):
    """How many lines have each role, counted while the lines are written: one scan for the table and its figures."""
    roles = sorted({role for _, role in TEXT_RULES} | {"Unclassified"})
    _, seen = counted(led_lines(spark, d), "led_lines", **{r: F.count_if(F.col("role") == r) for r in roles})
    return spark.createDataFrame([(r, seen[r]) for r in roles], "role string, n long")


def verdict_override(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", F.col("text").alias("plain"))
    v = _t(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "T").otherwise("").alias("check"), F.concat(F.lit("q"), "quality").alias("verdict"))
    return L.override(docs, v, ["doc_id"], "plain", F.col("lang")).select("doc_id", "role", "method")


def split_atoms(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.explode(T.split_atoms(F.col("text"), r"(?U)\s+(?:et|and)\s+")).alias("atom"))


def collapse_ws(spark, d):
    x = _t(spark, d, "documents").select("doc_id", T.collapse_ws(F.col("text")).alias("t"))
    return x.select("doc_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5"), T.truncate(F.col("t"), 200).alias("head"))


def slugs(spark, d):
    x = _t(spark, d, "documents").select("doc_id", T.make_id(F.col("text")).alias("s"))
    return x.select("doc_id", F.length("s").cast("long").alias("n_chars"), F.md5("s").alias("slug_md5"))


def form_before_comma(spark, d):
    lines = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return lines.select("doc_id", "i", T.form_before_comma(F.col("line")).alias("form")).where("form is not null")


def century_ranges(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.concat(F.element_at(F.array(*[F.lit(r) for r in T.ROMANS]), (F.col("o_orderkey") % 11 + 1).cast("int")), F.lit("e s.")).alias("label"))
    return o.select("o_orderkey", "label", T.century_range(F.col("label"))["lo"].alias("lo"), T.century_label(F.col("label")).alias("dates"))


def json_context(spark, d):
    e = _t(spark, d, "events")
    return e.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


def flag_union(spark, d):
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    flags = [li.where("l_quantity > 45").select(F.lit("large_quantity").alias("flag")), li.where("l_discount = 0").select(F.lit("no_discount").alias("flag")), o.where("o_totalprice < 5000").select(F.lit("small_order").alias("flag"))]
    return reduce(DataFrame.unionByName, flags).groupBy("flag").agg(F.count("*").alias("n"))


def range_join(spark, d):
    """Orders in overlapping spans of days, one span a nation."""
    n = F.col("n_nationkey")
    spans = _t(spark, d, "nation").select("n_name", (9131 + n * 80).alias("lo"), (9131 + n * 97 + 30).alias("hi"))
    o = _t(spark, d, "orders").select("o_totalprice", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    return L.in_ranges(o, spans, "day", "lo", "hi", 64).groupBy("n_name", "lo", "hi").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def full_outer_verdicts(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 500, "1").otherwise("0").alias("v"))
    return L.compare(docs, _t(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("v")), "doc_id", "v")


def except_ids(spark, d):
    return _t(spark, d, "documents").select("doc_id").exceptAll(_t(spark, d, "labels").select("doc_id"))


def object_counts(spark, d):
    # Each child is counted before the join, so nothing fans out.
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    n_li = li.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    per = o.join(n_li, o["o_orderkey"] == n_li["l_orderkey"], "left").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
    c = _t(spark, d, "customer").select("c_custkey")
    return c.join(per, c["c_custkey"] == per["o_custkey"], "left").select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def _documents_index(spark, d):
    return index_of(spark, ("documents", d), lambda: _t(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def bm25_topk(spark, d):
    hits = _documents_index(spark, d).search(["the", "idiot"])
    return hits.select("doc_id", F.round("score", 6).alias("score")).orderBy("score", "doc_id").limit(20)


def postings_stats(spark, d):
    return _documents_index(spark, d).terms().where("df >= 50")


def balanced_tags(spark, d):
    return _t(spark, d, "pages").select("page_id", T.is_balanced(F.col("html")).alias("balanced"))


def like_and_sort(spark, d):
    c = _t(spark, d, "customer")
    return c.where(F.col("c_name").ilike("%customer%1%") & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).orderBy(F.coalesce("c_nationkey", F.lit(999999)), "c_custkey").limit(20).select("c_custkey", "c_name")


def distinct_segments(spark, d):
    return _t(spark, d, "customer").select("c_mktsegment").distinct()


_UNI = r"[^\p{L}\p{N}]+"
_ROLE = """CASE WHEN regexp_matches(l, '(?i)^prov\\.\\s|^proverbe\\b|^proverbialement\\b') THEN 'Proverb' {} ELSE 'Unclassified' END"""

#: What (?U)\\s matches, as RE2 spells it.
_WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

WHOLE_SQL = {
    "split_atoms": rf"""WITH h AS (SELECT doc_id, trim(regexp_replace(lower(regexp_replace(text, '<[^>]+>', '', 'g')), '{_WS}+', ' ', 'g')) AS h FROM documents),
      a AS (SELECT doc_id, unnest(string_split_regex(h, ' (?:et|and) ')) AS a FROM h), b AS (SELECT doc_id, trim(regexp_replace(a, '[.,;:]+$', '')) AS atom FROM a)
      SELECT doc_id, atom FROM b WHERE atom <> ''""",
    "collapse_ws": rf"""SELECT doc_id, length(t)::BIGINT AS n_chars, md5(t) AS text_md5, substr(t, 1, 200) AS head
      FROM (SELECT doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) AS t FROM documents)""",
    "slugs": r"""WITH s AS (SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM documents),
      m AS (SELECT doc_id, CASE WHEN regexp_matches(s, '^[a-z]') THEN s ELSE 'e_' || s END AS s FROM s)
      SELECT doc_id, length(s)::BIGINT AS n_chars, md5(s) AS slug_md5 FROM m""",
}

DATA_SQL = {
    "author_locf": """WITH a AS (SELECT *, CASE event_type WHEN 'error' THEN 'ID.' WHEN 'view' THEN '' ELSE upper(event_type) END AS author FROM events),
      b AS (SELECT *, last_value(CASE WHEN author NOT IN ('', 'ID.') THEN author END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM a)
      SELECT event_id, author, CASE WHEN author = 'ID.' THEN coalesce(k, 'ID.') ELSE author END AS resolved_author FROM b""",
    "id_dedup": """WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS id FROM part), m AS (SELECT p_partkey, CASE WHEN regexp_matches(id, '^[a-z]') THEN id ELSE 'e_' || id END AS id FROM s)
      SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN id || '_' || row_number() OVER (PARTITION BY id ORDER BY p_partkey) ELSE id END AS id FROM m""",
    "scope_inter": """WITH i AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM conversations)
      SELECT conv_id, turn, island::BIGINT AS island, row_number() OVER (PARTITION BY conv_id, island ORDER BY turn) - (island > 0)::INT AS rank, count(*) OVER (PARTITION BY conv_id, island) - (island > 0)::INT AS size FROM i""",
    "scope_intra": """WITH i AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
      SELECT event_id, island::BIGINT AS island, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) - (island > 0)::INT AS rank FROM i""",
    "neighbour_texts": "SELECT conv_id, turn, substr(lag(text) OVER w, 1, 100) AS prev_text, substr(lead(text) OVER w, 1, 100) AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "path_ids": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
      w AS (SELECT doc_id, i, generate_subscripts(string_split(line, ' '), 1) AS j FROM l)
      SELECT row_number() OVER (ORDER BY doc_id, i, j) AS node_id, doc_id || '.' || i || '.' || j AS xml_id FROM w""",
    "stratified": """SELECT lang, source, doc_id, bucket_size FROM (SELECT *, count(*) OVER (PARTITION BY lang, source) AS bucket_size,
      row_number() OVER (PARTITION BY lang, source ORDER BY md5('42|' || doc_id), doc_id::VARCHAR) AS r FROM documents) WHERE r <= 5""",
    "island_first_last": """WITH i AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM conversations),
      r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, island ORDER BY turn) - 1 AS rank FROM i WHERE island > 0)
      SELECT conv_id, island::BIGINT AS island, min_by(substr(text, 1, 80), turn) AS first_text, max_by(substr(text, 1, 80), turn) AS last_text, count(*) AS n FROM r WHERE rank > 0 GROUP BY conv_id, island""",
    "strip_tags": "SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS plain FROM pages",
    "escape_xml": "SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages",
    "xref_targets": """SELECT page_id, count(*) AS n, min(ref) AS first_ref FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS ref FROM pages) GROUP BY page_id""",
    "dangling_refs": """SELECT ref, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS ref FROM pages) WHERE ref NOT IN (SELECT url FROM pages) GROUP BY ref""",
    "first_match_rules": """WITH r(ord, p, label) AS (VALUES (1, '^PROMO.*BRASS$', 'promo brass'), (2, 'BRASS$', 'brass'), (3, '^STANDARD', 'standard'), (4, '^(SMALL|MEDIUM|LARGE)', 'sized')),
      m AS (SELECT p_partkey, min_by(label, ord) AS label FROM part JOIN r ON regexp_matches(p_type, p) GROUP BY p_partkey)
      SELECT coalesce(label, 'hint') AS label, count(*) AS n FROM part LEFT JOIN m USING (p_partkey) GROUP BY 1""",
    "cascade_classify": f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
      t AS (SELECT *, ((doc_id + i) % {len(LEADS) + 3})::INT AS turn FROM l),
      x AS (SELECT turn, CASE turn WHEN {len(LEADS)} THEN 'Au fém.' WHEN {len(LEADS) + 1} THEN 'Vieillie.' WHEN {len(LEADS) + 2} THEN 'Avec un nom de chose' ELSE [{", ".join("'" + x + "'" for x in LEADS)}][turn + 1] || line END AS l FROM t)
      SELECT turn, CASE WHEN regexp_matches(l, '(?i)^(prov\\.\\s|proverbe\\b|proverbialement\\b)') THEN 'Proverb'
        WHEN regexp_matches(l, '(?i)^(populaire(ment)?|(familièr|vulgair|ironiqu|burlesqu|poétiqu)ement|plaisamment|par (euphémisme|exagération|ironie|dérision|extension|analogie|métaphore|plaisanterie|antiphrase)|néologisme|(très )?peu usité|hors d''usage|tombé en désuétude|il est (familier|vieux|populaire|inusité|hors d''usage)|il n''est plus usité|il (a vieilli|vieillit)|ce mot (est|a vieilli)|ce sens a vieilli|cet emploi (vieillit|a vieilli)|(mot|terme) (vieilli|vieux|familier|populaire|inusité|bas))($|[^\\pL\\pN_])') THEN 'RegisterLabel'
        WHEN regexp_matches(l, '(?i)^(v\\.\\s*(n|a|réfl)|se\\s+conjugue|absolument|substantivement|adverbialement|adjectivement|intransitivement|neutralement|impersonnellement|activement)($|[^\\pL\\pN_])') THEN 'VoiceTransition'
        WHEN regexp_matches(l, '(?i)^fig\\.\\s') THEN 'Figurative'
        WHEN regexp_matches(l, '(?i)^(au (pluriel|féminin|singulier|masc(\\.|ulin)?|fém(\\.|inin)?)\\.?\\s*$|avec un nom de [^,.]*\\.?\\s*$)') THEN 'VoiceTransition'
        WHEN regexp_matches(l, '(?i)^(familière?|familier|vieux|vieillie?|rare|bas(se)?|vulgaire|triviale?|inusitée?)\\.?\\s*$') THEN 'RegisterLabel'
        ELSE 'Unclassified' END AS role, count(*) AS n FROM x GROUP BY ALL""",
    "verdict_override": """WITH v AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'T' ELSE '' END AS c, 'q' || quality AS v FROM labels)
      SELECT d.doc_id, coalesce(v.v, lang) AS role, CASE WHEN v.v IS NULL THEN 'Heuristic' ELSE 'LlmAssisted' END AS method FROM documents d LEFT JOIN v ON v.doc_id = d.doc_id AND starts_with(d.text, v.c)""",
    "form_before_comma": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS i FROM documents)
      SELECT doc_id, i, trim(split_part(line, ',', 1)) AS form FROM l WHERE contains(line, ',') AND length(trim(split_part(line, ',', 1))) BETWEEN 1 AND 60""",
    "century_ranges": """SELECT o_orderkey, ['IX','X','XI','XII','XIII','XIV','XV','XVI','XVII','XVIII','XIX'][o_orderkey % 11 + 1] || 'e s.' AS label, ((o_orderkey % 11 + 8) * 100 + 1)::INT AS lo,
      lpad(((o_orderkey % 11 + 8) * 100 + 1)::VARCHAR, 4, '0') || '-' || lpad(((o_orderkey % 11 + 9) * 100)::VARCHAR, 4, '0') AS dates FROM orders""",
    "json_context": "SELECT json_extract_string(props, '$.k')::INT AS k, count(*) AS n FROM events GROUP BY 1",
    "flag_union": "SELECT flag, count(*) AS n FROM (SELECT 'large_quantity' AS flag FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT 'no_discount' FROM lineitem WHERE l_discount = 0 UNION ALL SELECT 'small_order' FROM orders WHERE o_totalprice < 5000) GROUP BY flag",
    "range_join": """WITH s AS (SELECT n_name, (9131 + n_nationkey * 80)::INT AS lo, (9131 + n_nationkey * 97 + 30)::INT AS hi FROM nation)
      SELECT n_name, lo, hi, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN s ON date_diff('day', DATE '1970-01-01', o_orderdate::DATE) BETWEEN lo AND hi GROUP BY n_name, lo, hi""",
    "full_outer_verdicts": """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, coalesce(CASE WHEN d.doc_id IS NULL THEN NULL WHEN n_chars > 500 THEN '1' ELSE '0' END, 'missing') AS observed, coalesce(quality::VARCHAR, 'missing') AS expected,
      coalesce(CASE WHEN d.doc_id IS NULL THEN NULL WHEN n_chars > 500 THEN '1' ELSE '0' END, 'missing') = coalesce(quality::VARCHAR, 'missing') AS agrees FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
    "except_ids": "SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels",
    "object_counts": "SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey",
    "bm25_topk": """WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
      f AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'idiot')) AS b FROM w),
      s AS (SELECT count(*) AS n, avg(dl) AS m, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM f)
      SELECT doc_id, round(-greatest(ln((n - da + 0.5) / (da + 0.5)), 1e-6) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / m)) - greatest(ln((n - db + 0.5) / (db + 0.5)), 1e-6) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / m)), 6) AS score
      FROM f, s WHERE a > 0 AND b > 0 ORDER BY score, doc_id LIMIT 20""",
    "postings_stats": "SELECT term, count(DISTINCT doc_id) AS df, count(*)::BIGINT AS cf FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents) WHERE term <> '' GROUP BY term HAVING count(DISTINCT doc_id) >= 50",
    "like_and_sort": "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%customer%1%' AND c_mktsegment IN ('BUILDING', 'MACHINERY') ORDER BY coalesce(c_nationkey, 999999), c_custkey LIMIT 20",
    "balanced_tags": """WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<[^>]+>')) AS tag, generate_subscripts(regexp_extract_all(html, '<[^>]+>'), 1) AS i FROM pages),
      d AS (SELECT page_id, sum(CASE WHEN starts_with(tag, '</') THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth, row_number() OVER (PARTITION BY page_id ORDER BY i DESC) AS back FROM t WHERE NOT ends_with(tag, '/>')),
      b AS (SELECT page_id, min(depth) >= 0 AND max(CASE WHEN back = 1 THEN depth END) = 0 AS ok FROM d GROUP BY page_id)
      SELECT page_id, coalesce(ok, html IS NOT NULL) AS balanced FROM pages LEFT JOIN b USING (page_id)""",
    "distinct_segments": "SELECT DISTINCT c_mktsegment FROM customer",
}

given.ORACLE_SQL["bm25_blockmax"] = DATA_SQL["bm25_topk"]
DATA_SQL["observed_roles"] = f"SELECT role, sum(n)::BIGINT AS n FROM ({DATA_SQL['cascade_classify']}) GROUP BY role"

_DATA = (author_locf, id_dedup, scope_inter, scope_intra, neighbour_texts, path_ids, stratified, island_first_last, strip_tags, escape_xml, collapse_ws, slugs, xref_targets, dangling_refs, first_match_rules, cascade_classify, observed_roles, verdict_override, split_atoms, form_before_comma, century_ranges, json_context, flag_union, range_join, full_outer_verdicts, except_ids, object_counts, bm25_topk, postings_stats, balanced_tags, like_and_sort, distinct_segments)

_RICH = (rich_entries, rich_resumes, rich_senses, rich_citations, rich_locutions, rich_forms, rich_rubriques, rich_flags, rich_samples, rich_metrics, rich_mismatches, rich_tei, rich_hoists, rich_pronunciations)

_OWN = (*_RICH, *FILE_QUERIES, dict_q22_search_senses, dict_q23_search_citations, dict_etymology_segments, dict_pos_readings, route_labels, bare_labels)

QUERIES = {**{n: _user(n) for n in USER_SQL}, **{f.__name__: f for f in _OWN}, **{f.__name__: f for f in _DATA}, **given.QUERIES}

#: Rows worked out by hand from the rules, for the small samples.
GOLDEN_SQL = {
    **{n: goldens.sql(n) for n in goldens.EXPECTED},
    "dict_q27_suspects": """SELECT 'panier.1' AS entry_id, 'PANIER' AS headword, 'token in language-abbreviation position missing from language table' AS reason, '{"token":"zzz.","anchor":"zzz."}' AS context""",
    "dict_rq2_with_figurative": "SELECT 'PANIER' AS headword",
    "dict_rq4_text_like": "SELECT 'PANIER' AS headword, 'Grandes jupes.' AS content_plain",
    "dict_etymology_segments": "SELECT * FROM (VALUES ('panier.1', 0, 'cit', 'cognate', 'la', 'panarium', 'corbeille à pain', NULL), ('panier.1', 1, 'suspect', NULL, NULL, NULL, NULL, 'zzz.'), ('panier.1', 2, 'cit', 'cognate', '', 'pana', '', NULL)) t(entry_id, i, kind, cit_type, language, forms, gloss, text)",
    "dict_pos_readings": "SELECT * FROM (VALUES ('panier.1', 'pos', 'noun', 's.'), ('panier.1', 'gender', 'masculine', 'm.'), ('panier.2', 'pos', 'verb', 'v.'), ('panier.2', 'valency', 'active', 'a.')) t(entry_id, kind, norm, printed)",
    "route_labels": """SELECT * FROM (VALUES ('s. m. et f.', 's. m. et f.', 'gram', 'pos=noun gender=masculine gender=feminine'), ('v. a. et n.', 'v. a. et n.', 'gram', 'pos=verb valency=active valency=intransitive'),
      ('Familièrement et par plaisanterie', 'Familièrement', 'usg', 'socioCultural=familiar'), ('Familièrement et par plaisanterie', 'par plaisanterie', 'usg', 'attitude=jocular'), ('Populairement encore', 'Populairement encore', 'usg', 'socioCultural=popular'),
      ('Terme de marine', 'Terme de marine', 'usg', 'domain='), ('Au plur.', 'Au plur.', 'gram', 'number=plural'), ('Absolument aussi', 'Absolument aussi', 'gram', 'construction=absolute'), ('Inusité', 'Inusité', 'usg', 'frequency=rare')) t(label, printed, target, reading)""",
    "bare_labels": "SELECT * FROM (VALUES ('Populairement encore, une ficelle', 'populairement encore', 'une ficelle'), ('Substantivement et au neutre. Le beau.', 'substantivement et au neutre', 'Le beau.'), ('Absolument.', NULL, NULL), ('Une chose.', NULL, NULL)) t(block, label, rest)",
}

_CASCADE = DATA_SQL["cascade_classify"]
_TABLES = derived.tables_sql(_CASCADE[_CASCADE.index("CASE WHEN regexp_matches(l,") : _CASCADE.index(" AS role, count(*)")], _WS)


def _derived_sql() -> dict[str, str]:
    """The documented questions, put to the tables that SQL makes of the documents."""
    out = {}
    for name, question in USER_SQL.items():
        values = DERIVED_ARGUMENTS | {"pattern": DERIVED_ARGUMENTS.get(name)}
        for k, v in values.items():
            question = question.replace(f":{k}", f"'{v}'" if isinstance(v, str) else str(v))
        out[name] = derived.asked(_TABLES, question)
    held = lambda text, terms: " AND ".join(rf"list_contains(string_split_regex(strip_accents(lower({text})), '{_UNI}'), '{t}')" for t in terms)
    out["dict_q22_search_senses"] = derived.asked(_TABLES, f"SELECT sense_id, headword, sense_type, content_plain FROM senses JOIN entries USING (entry_id) WHERE {held('content_plain', SEARCHED['senses'])}")
    out["dict_q23_search_citations"] = derived.asked(_TABLES, f"SELECT citation_id, headword, resolved_author, reference, text_plain FROM citations JOIN senses USING (sense_id) JOIN entries USING (entry_id) WHERE {held('text_plain', SEARCHED['citations'])}")
    segments = "(0, 'cit', 'cognate', 'la', 'panarium', 'corbeille à pain', NULL), (1, 'suspect', NULL, NULL, NULL, NULL, 'zzz.'), (2, 'cit', 'cognate', '', 'pana', '', NULL)"
    out["dict_etymology_segments"] = derived.asked(_TABLES, f"SELECT entry_id, s.* FROM entries, (VALUES {segments}) s(i, kind, cit_type, language, forms, gloss, text) WHERE doc_id % 5 = 0")
    for table in ("entries", "senses", "citations", "locutions", "rubriques"):
        columns = ", ".join(derived.COLUMNS[table])
        out[f"rich_{table}"] = derived.asked(_TABLES, f"SELECT {columns} FROM {table}")
    out["rich_flags"] = derived.asked(_TABLES, "SELECT review_id, entry_id, phase, flag_type, reason, context FROM review_queue WHERE flag_type <> 'calibration_sample'")
    out["rich_samples"] = derived.asked(_TABLES, "SELECT reason, count(*) AS n FROM review_queue WHERE flag_type = 'calibration_sample' GROUP BY reason")
    for name, sql in (("rich_forms", derived.FORMS_SQL), ("rich_resumes", derived.RESUMES_SQL), ("rich_mismatches", derived.MISMATCHES_SQL)):
        out[name] = derived.asked(_TABLES, sql)
    out["rich_metrics"] = derived.asked(_TABLES, derived.METRICS_SQL)
    out["written_tables"] = derived.asked(_TABLES, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{','.join(c)}' AS columns FROM {t}" for t, c in derived.COLUMNS.items()))
    term = rf"SELECT sense_id, unnest(string_split_regex(lower(content_plain), '{_UNI}')) AS term FROM senses"
    out["stored_index"] = derived.asked(_TABLES, f"SELECT term, count(DISTINCT sense_id) AS df, count(*) AS cf FROM ({term}) WHERE term <> '' GROUP BY term HAVING count(*) > 1")
    for name, column, texts in (("route_labels", "label", ROUTED), ("bare_labels", "block", BARE)):
        quoted = ", ".join("'" + x + "'" for x in texts)
        out[name] = f"SELECT doc_id, g.* FROM documents JOIN ({GOLDEN_SQL[name]}) g ON g.{column} = [{quoted}][doc_id % {len(texts)} + 1]"
    readings = "('s. m.', 'pos', 'noun', 's.'), ('s. m.', 'gender', 'masculine', 'm.'), ('v. a.', 'pos', 'verb', 'v.'), ('v. a.', 'valency', 'active', 'a.')"
    out["dict_pos_readings"] = derived.asked(_TABLES, f"SELECT entry_id, kind, norm, printed FROM entries JOIN (VALUES {readings}) r(pos, kind, norm, printed) USING (pos)")
    return out


ORACLE_SQL = {**DATA_SQL, **WHOLE_SQL, **GOLDEN_SQL, **given.ORACLE_SQL, **_derived_sql()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to lines, roles, and counts with a flag for what no rule decides."""
    lines = _t(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    roles = lines.select(role_by_text(F.col("line")).alias("role"), F.length("line").alias("n"))
    return roles.groupBy("role").agg(F.count("*").alias("lines"), F.sum("n").alias("chars")).withColumn("flag", F.when(F.col("role") == "Unclassified", "unclassified"))
