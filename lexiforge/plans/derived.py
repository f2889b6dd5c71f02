"""A dictionary that Spark derives from the given documents, and the rows its tables must hold.

Every document becomes a source file with one entry, every line of it a sense with a block
below. What a block opens with goes round ``LEADS``, ``ALONE`` and some markup, its citation's
author round ``AUTHORS``; some entries share a headword, some have a homograph number, an etymology or a
supplement. So the scan, the build and the documented questions run over as many entries as
there are documents. ``tables_sql`` says, from the documents and
without any XML, what the six tables hold; the user's questions are then asked of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_xml

#: What blocks open with, in turn: nothing or the opening of one rule, before the line; texts that stand alone; markup.
LEADS = (
    "", "Prov. ", "Proverbialement, ", "Populairement, ", "Vulgairement. ", "Par extension, ", "Très peu usité. ", "Il est vieux. ", "Ce mot a vieilli ; ",
    "Terme bas. ", "v. réfl. ", "Se conjugue comme ", "Substantivement. ", "Fig. ", "Fig", "Provence ", "Familier ", "Au pluriel, ",
)
ALONE = ("Au fém.", "Vieillie.", "Avec un nom de chose")
DOMAIN, FIGURE = '<semantique type="domaine">Terme de marine.</semantique> ', '<semantique type="indicateur">Fig.</semantique> '
CROSS = 'Voy. <a ref="mot_1">MOT 1</a>'
TURNS = len(LEADS) + len(ALONE) + 4
#: Turns whose block, a voice transition by itself, bears no citation in every third document: it takes the senses after it.
CARRIERS = (len(LEADS), len(LEADS) + 2)
AUTHORS = ("DUVAL", "ID.", "", "MARIN", "ID.")
NATURES = ("s. m.", "v. a.", "")
ETYMOLOGY = "Lat. <i>panarium</i>, corbeille à pain ; zzz. <i>pana</i>"


def _turned(i: Column, texts: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in texts]), i.cast("int"))


def source_files(docs: DataFrame) -> DataFrame:
    """(path, text) of a source file for each of ``docs`` (doc_id, text)."""
    n, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    name = n.cast("string")

    def sense(line: Column, i: Column) -> Column:
        k, plain = (i + 1).cast("string"), escape_xml(line)
        turn = F.pmod(n + i, F.lit(TURNS))
        at = len(LEADS) + len(ALONE)
        block = (
            F.when(turn < len(LEADS), F.concat(_turned(turn, LEADS), plain))
            .when(turn < at, _turned(turn - len(LEADS), ALONE))
            .when(turn == at, F.concat(F.lit(DOMAIN), plain))
            .when(turn == at + 1, F.concat(F.lit("<exemple>Loc "), name, F.lit("</exemple>, "), plain))
            .when(turn == at + 2, F.lit(CROSS))
            .otherwise(F.concat(F.lit(FIGURE), plain))
        )
        hidden = F.when(F.pmod(n + i, F.lit(4)) == 0, ' hide="1"').otherwise("")
        word = escape_xml(F.regexp_extract(line, r"[^\x09-\x0D ]+", 0))
        cit = F.concat(F.lit('<cit aut="'), _turned(F.pmod(n + i, F.lit(len(AUTHORS))), AUTHORS), F.lit('" ref="ib. '), k, F.lit('"'), hidden, F.lit(">"), word, F.lit("</cit>"))
        uncited = (n % 3 == 1) & turn.isin(*CARRIERS)
        return F.concat(F.lit('<variante num="'), k, F.lit('">'), plain, F.lit("<indent>"), block, F.when(uncited, "").otherwise(cit), F.lit("</indent></variante>"))

    senses = F.array_join(F.transform(F.split(text, "\n"), sense), "\n")
    attributes = F.concat(F.when(n % 3 == 0, F.concat(F.lit(' sens="'), (n % 2 + 1).cast("string"), F.lit('"'))).otherwise(""), F.when(n % 10 == 0, ' supplement="1"').otherwise(""))
    said = F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("<prononciation>pro-"), name, F.lit("</prononciation>")))
    nature = _turned(n % len(NATURES), NATURES)
    head = F.concat(F.lit("<entete>"), said, F.lit("<nature>"), nature, F.lit("</nature></entete>"))
    history = F.concat(F.lit('<rubrique nom="HISTORIQUE">'), escape_xml(F.substring_index(text, "\n", 1)), F.lit("</rubrique>"))
    origin = F.when(n % 5 == 0, f'<rubrique nom="ÉTYMOLOGIE">{ETYMOLOGY}</rubrique>').otherwise("")
    more = F.when(n % 10 == 0, F.concat(F.lit('<rubrique nom="SUPPLÉMENT AU DICTIONNAIRE">Ajout<variante>Rayon '), name, F.lit("</variante></rubrique>"))).otherwise("")
    sums_up = F.when(n % 50 == 0, F.concat(F.lit("<résumé>Sommaire "), name, F.lit("</résumé>"))).otherwise("")
    headword = F.concat(F.lit("MOT "), F.floor(n / 2).cast("string"))
    entry = F.concat(F.lit('<xmllittre>\n<entree terme="'), headword, F.lit('"'), attributes, F.lit(">\n"), head, F.lit("\n<corps>\n"), senses, F.lit("\n</corps>\n"), sums_up, history, origin, more, F.lit("\n</entree>\n</xmllittre>"))
    return docs.where(n.isNotNull()).select(F.concat(F.lit("/derived/"), _file(n)).alias("path"), entry.alias("text"))


def dealt(docs: DataFrame, parts: int) -> DataFrame:
    """``docs`` dealt out as the rows of their entries will be: by file, and by the entry's number in it."""
    return docs.repartition(parts, _file(F.col("doc_id")), F.lit(1))


def _file(n: Column) -> Column:
    return F.concat(F.chr(97 + n % 26), F.lpad(n.cast("string"), 10, "0"), F.lit(".xml"))


#: Every seventh document's first block is a register label by verdict; the verdict of the next one checks a text that is not there.
VERDICT, ABSENT, EVERY = "RegisterLabel", "ZZZ", 7
#: Lines of a source file before its first sense.
BEFORE = 4


def verdicts(docs: DataFrame) -> DataFrame:
    """(source_file, source_line, check, verdict, ord) of hand-made roles."""
    n = F.col("doc_id")
    d = docs.where((n % EVERY).isin(3, 4)).select(_file(n).alias("source_file"), F.lit(BEFORE + 1).alias("source_line"), F.when(n % EVERY == 4, ABSENT).otherwise("").alias("check"))
    return d.withColumns({"verdict": F.lit(VERDICT), "ord": F.lit(1)})


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _array(texts: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(_quoted, texts)) + "]"


def tables_sql(role_by_text: str, spaces: str) -> str:
    """The tables as a list of named queries. ``role_by_text``: the role of a text ``l``; ``spaces``: what counts as white space."""
    at = len(LEADS) + len(ALONE)
    flat = lambda x: f"trim(regexp_replace({x}, '{spaces}+', ' ', 'g'))"
    strip = lambda x: f"trim(regexp_replace({x}, '<[^>]+>', '', 'g'))"
    return rf"""d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, chr((97 + doc_id % 26)::INT) || lpad(doc_id::VARCHAR, 10, '0') || '.xml' AS sf, 'MOT ' || (doc_id // 2) AS headword,
    'mot_' || (doc_id // 2) || CASE WHEN doc_id % 3 = 0 THEN '.' || (doc_id % 2 + 1) ELSE '' END AS id FROM documents
), entries AS MATERIALIZED (
  SELECT CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN id || '_' || row_number() OVER (PARTITION BY id ORDER BY sf) ELSE id END AS entry_id, headword,
    CASE WHEN doc_id % 3 = 0 THEN doc_id % 2 + 1 END::INT AS homograph_index, CASE WHEN doc_id % 4 <> 0 THEN 'pro-' || doc_id END AS pronunciation,
    nullif({_array(NATURES)}[doc_id % {len(NATURES)} + 1], '') AS pos, (doc_id % 10 = 0)::INT AS is_supplement, substr(sf, 1, 1) AS source_letter, doc_id, sf FROM d
), lines AS (
  SELECT doc_id, sf, k, raw, replace(replace(replace(raw, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS esc, ((doc_id + k - 1) % {TURNS})::INT AS turn
  FROM (SELECT doc_id, sf, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)
), marked AS (
  SELECT *, {flat("esc")} AS own, {flat(f'''CASE WHEN turn < {len(LEADS)} THEN {_array(LEADS)}[turn + 1] || esc WHEN turn < {at} THEN {_array(ALONE)}[turn - {len(LEADS) - 1}]
    WHEN turn = {at} THEN {_quoted(DOMAIN)} || esc WHEN turn = {at + 1} THEN '<exemple>Loc ' || doc_id || '</exemple>, ' || esc WHEN turn = {at + 2} THEN {_quoted(CROSS)} ELSE {_quoted(FIGURE)} || esc END''')} AS content FROM lines
), told AS MATERIALIZED (
  SELECT *, CASE WHEN k = 1 AND doc_id % {EVERY} = 3 THEN '{VERDICT}' ELSE CASE turn WHEN {at} THEN 'DomainLabel' WHEN {at + 1} THEN 'Locution' WHEN {at + 2} THEN 'CrossReference' WHEN {at + 3} THEN 'Figurative' ELSE ({role_by_text}) END END AS role,
    CASE WHEN k = 1 AND doc_id % {EVERY} = 3 THEN 'LlmAssisted' WHEN turn >= {at} THEN 'Deterministic' ELSE 'Heuristic' END AS method, NOT (doc_id % 3 = 1 AND turn IN {CARRIERS}) AS cited FROM (SELECT *, {strip("content")} AS l FROM marked)
), units AS (
  SELECT doc_id, k, role = 'VoiceTransition' AND NOT cited AS carrier, 0 AS extra FROM told UNION ALL SELECT doc_id, len(string_split(text, chr(10))) + 1, false, 1 FROM d WHERE doc_id % 10 = 0
), islands AS (
  SELECT *, sum(carrier::INT) OVER (PARTITION BY doc_id ORDER BY k) AS island FROM units
), ranks AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY k) - (island > 0)::INT AS rank, count(*) OVER (PARTITION BY doc_id, island) - (island > 0)::INT AS size FROM islands
), opened AS (
  SELECT *, carrier AND size > 0 AS opens, island > 0 AND rank > 0 AS moved FROM ranks
), placed AS MATERIALIZED (
  SELECT *, CASE WHEN moved THEN [place, rank] ELSE [place - opens::INT] END AS head FROM (
    SELECT *, (sum((NOT moved)::INT + opens::INT) OVER (PARTITION BY doc_id ORDER BY k))::BIGINT AS place FROM opened)
), blocks AS (
  SELECT p.doc_id, p.k, 0 AS lvl, head AS path, CASE WHEN extra = 0 THEN p.k END::INT AS num, NULL AS role, CASE WHEN extra = 1 THEN 'Rayon ' || p.doc_id ELSE nullif(t.own, '') END AS content, extra FROM placed p LEFT JOIN told t ON t.doc_id = p.doc_id AND t.k = p.k
  UNION ALL SELECT p.doc_id, p.k, 1, list_append(head, 1), NULL, t.role, t.content, 0 FROM placed p JOIN told t ON t.doc_id = p.doc_id AND t.k = p.k WHERE NOT opens
  UNION ALL SELECT p.doc_id, p.k, 2, [place], NULL, NULL, t.content, 0 FROM placed p JOIN told t ON t.doc_id = p.doc_id AND t.k = p.k WHERE opens
), numbered AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY e.sf, path) AS sense_id, e.entry_id, e.sf, b.* FROM blocks b JOIN entries e ON e.doc_id = b.doc_id
), senses AS MATERIALIZED (
  SELECT b.sense_id, b.entry_id, u.sense_id AS parent_sense_id, b.num, CASE WHEN b.lvl < 2 THEN b.entry_id || '.' || CASE WHEN b.extra = 1 THEN 1 ELSE b.k END || CASE WHEN b.lvl = 1 THEN '.1' ELSE '' END END AS indent_id,
    b.entry_id || '_s' || array_to_string(b.path, '.') AS xml_id,
    CASE b.lvl WHEN 0 THEN 'sense' WHEN 2 THEN 'usage_group' ELSE CASE b.role WHEN 'Figurative' THEN 'figurative' WHEN 'DomainLabel' THEN 'domain' WHEN 'RegisterLabel' THEN 'register' WHEN 'Proverb' THEN 'proverb'
      WHEN 'Locution' THEN 'locution' WHEN 'CrossReference' THEN 'cross_reference' WHEN 'VoiceTransition' THEN 'annotation' ELSE 'unclassified' END END AS sense_type, b.role,
    {strip("b.content")} AS content_plain, b.content AS content_markup, b.extra::INT AS is_supplement, CASE WHEN b.lvl = 2 THEN 'medium' END AS transition_type, NULL::VARCHAR AS transition_form, NULL::VARCHAR AS transition_pos,
    (len(b.path) - 1)::INT AS depth, b.doc_id, b.k, b.lvl, b.path
  FROM numbered b LEFT JOIN numbered u ON u.doc_id = b.doc_id AND u.path = list_slice(b.path, 1, len(b.path) - 1) AND len(b.path) > 1
), said AS (
  SELECT s.sense_id, t.doc_id, t.k, replace(replace(replace(regexp_extract(t.raw, '[^\x09-\x0D ]+', 0), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS text_markup,
    {_array(AUTHORS)}[(t.doc_id + t.k - 1) % {len(AUTHORS)} + 1] AS author, 'ib. ' || t.k AS reference, ((t.doc_id + t.k - 1) % 4 = 0)::INT AS is_hidden
  FROM told t JOIN senses s ON s.doc_id = t.doc_id AND s.k = t.k AND s.lvl = 1 WHERE t.cited
), citations AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sense_id) AS citation_id, sense_id, text_markup AS text_plain, text_markup, author,
    CASE WHEN author = 'ID.' THEN coalesce(last_value(CASE WHEN author NOT IN ('', 'ID.') THEN author END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING), 'ID.') ELSE author END AS resolved_author, reference, is_hidden FROM said
), locutions AS MATERIALIZED (
  SELECT sense_id, 'Loc ' || doc_id AS canonical_form FROM senses WHERE role = 'Locution'
), sections AS (
  SELECT doc_id, sf, 1 AS j, 'Historique' AS rubrique_type, {flat("replace(replace(replace(string_split(text, chr(10))[1], '&', '&amp;'), '<', '&lt;'), '>', '&gt;')")} AS content_markup FROM d
  UNION ALL SELECT doc_id, sf, 2, 'Etymologie', {_quoted(ETYMOLOGY)} FROM d WHERE doc_id % 5 = 0
  UNION ALL SELECT doc_id, sf, 3, 'Supplement', 'Ajout' FROM d WHERE doc_id % 10 = 0
), rubriques AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY s.sf, j) AS rubrique_id, e.entry_id, rubrique_type, {strip("content_markup")} AS content_plain, content_markup FROM sections s JOIN entries e ON e.doc_id = s.doc_id
), direct AS (
  SELECT s.*, t.method, t.k AS num_, e.headword, e.sf, count(*) OVER (PARTITION BY s.role, t.method) AS bucket, row_number() OVER (PARTITION BY s.role, t.method ORDER BY md5('42|' || s.xml_id), s.xml_id) AS pick
  FROM senses s JOIN told t ON t.doc_id = s.doc_id AND t.k = s.k JOIN entries e ON e.doc_id = s.doc_id WHERE s.lvl = 1
), glossed AS (
  SELECT *, trim(regexp_replace(substr(content_plain, length('Loc ' || doc_id) + 1), '^[ ,;:.]+', '')) AS gloss FROM direct
), grouped AS (
  SELECT g.entry_id, g.path, g.content_plain, p.size, e.headword, e.sf, (SELECT min_by(substr(c.content_plain, 1, 80), c.path) FROM senses c WHERE c.doc_id = g.doc_id AND c.lvl = 0 AND len(c.path) = 2 AND c.path[1] = g.path[1]) AS first_,
    (SELECT max_by(substr(c.content_plain, 1, 80), c.path) FROM senses c WHERE c.doc_id = g.doc_id AND c.lvl = 0 AND len(c.path) = 2 AND c.path[1] = g.path[1]) AS last_
  FROM senses g JOIN placed p ON p.doc_id = g.doc_id AND p.k = g.k JOIN entries e ON e.doc_id = g.doc_id WHERE g.lvl = 2
), flagged AS (
  SELECT 1 AS ord, '' AS bucket_, sf, path, 0 AS sub, entry_id, headword, 'phase3' AS phase, 'unclassified' AS flag_type, 'no rule matched' AS reason,
    to_json({{'sense_num': num_, 'indent_content': substr(content_markup, 1, 200), 'method': method}})::VARCHAR AS context FROM direct WHERE role = 'Unclassified'
  UNION ALL SELECT 3, '', sf, path, 0, entry_id, headword, 'phase3', 'likely_locution', 'starts with Loc./Locution but classified as ' || role,
    to_json({{'sense_num': num_, 'indent_content': substr(content_markup, 1, 200), 'current_role': role}})::VARCHAR FROM direct WHERE role <> 'Locution' AND regexp_matches(content_plain, '(?i)^(loc\.\s|locution)')
  UNION ALL SELECT 4, '', sf, path, 0, entry_id, headword, 'phase5', CASE WHEN size > 15 THEN 'large_scope' ELSE 'scope_decision' END, 'medium scope, ' || size || ' senses',
    to_json({{'transition_content': substr(content_plain, 1, 100), 'scope_type': 'medium', 'transition_form': '', 'transition_pos': '', 'num_scoped': size, 'first_scoped': coalesce(first_, ''), 'last_scoped': coalesce(last_, '')}})::VARCHAR FROM grouped
  UNION ALL SELECT 6, '', sf, path, 0, entry_id, headword, 'structural', 'metonymic_subsense', 'locution gloss opens with a definite article',
    to_json({{'canonical_form': 'Loc ' || doc_id, 'gloss': substr(gloss, 1, 200)}})::VARCHAR FROM glossed WHERE role = 'Locution' AND regexp_matches(gloss, '(?i)^((les|la|le)\s+|l'')\pL')
  UNION ALL SELECT 10, '', sf, [2, 0, 0], 2, entry_id, headword, 'etymology', 'suspect_language_token', 'token in language-abbreviation position missing from language table', '{{"token":"zzz.","anchor":"zzz."}}' FROM entries WHERE doc_id % 5 = 0
  UNION ALL SELECT 11, role || '/' || method, '', [], pick, entry_id, headword, 'calibration', 'calibration_sample', 'sample from ' || role || '/' || method || ' (n=' || bucket || ')',
    to_json({{'sense_num': num_, 'indent_content': substr(content_markup, 1, 200), 'role': role, 'method': method, 'bucket_size': bucket}})::VARCHAR FROM direct WHERE pick <= 5
), review_queue AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY ord, bucket_, sf, path, sub, context) AS review_id, entry_id, headword, phase, flag_type, reason, context, NULL::VARCHAR AS resolution, NULL::VARCHAR AS resolved_by FROM flagged
)"""


#: The columns of the six tables.
COLUMNS = {
    "entries": "entry_id headword homograph_index pronunciation pos is_supplement source_letter".split(),
    "senses": "sense_id entry_id parent_sense_id num indent_id xml_id sense_type role content_plain content_markup is_supplement transition_type transition_form transition_pos depth".split(),
    "citations": "citation_id sense_id text_plain text_markup author resolved_author reference is_hidden".split(),
    "locutions": "sense_id canonical_form".split(),
    "rubriques": "rubrique_id entry_id rubrique_type content_plain content_markup".split(),
    "review_queue": "review_id entry_id headword phase flag_type reason context resolution resolved_by".split(),
}

#: What the build's phases count; half of the derived dictionary's etymology cues are suspect.
METRICS_SQL = """SELECT metric, value::DOUBLE AS value FROM (
  SELECT 'indents' AS metric, count(*) AS value FROM told UNION ALL SELECT 'classified', count(role) FROM told UNION ALL SELECT 'percent_classified', 100
  UNION ALL SELECT unnest(['strong_scoped', 'intra_grouped', 'unknown_rubriques']), 0
  UNION ALL SELECT 'medium_scoped', coalesce(sum(size), 0) FROM placed WHERE opens UNION ALL SELECT 'ambiguous_scopes', count(*) FROM placed WHERE opens AND size > 15
  UNION ALL SELECT 'zero_scope', count(*) FROM placed WHERE carrier AND NOT opens
  UNION ALL SELECT 'cues_resolved', count(*) FROM entries WHERE doc_id % 5 = 0 UNION ALL SELECT 'cues_suspect', count(*) FROM entries WHERE doc_id % 5 = 0 UNION ALL SELECT 'cue_hit_rate', 50
  UNION ALL SELECT 'role ' || role, count(*) FROM told GROUP BY role UNION ALL SELECT 'flag ' || flag_type, count(*) FROM review_queue GROUP BY flag_type)"""


#: Where printed and worked-out forms come from.
FORMS_SQL = r"""SELECT xml_id, s.role, t.method, form AS canonical_form, CASE WHEN s.role = 'Locution' THEN 'exemple' ELSE 'prose' END AS canonical_form_source FROM (
  SELECT doc_id, k, role, method, CASE role WHEN 'Locution' THEN 'Loc ' || doc_id
    WHEN 'Proverb' THEN trim(regexp_replace(trim(string_split_regex(regexp_replace(l, '(?i)^\s*prov(?:erbe|erbialement)?\.?\s*[:.]?\s*', ''), '(?i),?\s*(?:c\.-à-d\.|c''est-à-dire|se dit|pour dire|signifie)')[1]), '[.,;:]+$', '')) ELSE '' END AS form FROM told) t
  JOIN senses s ON s.doc_id = t.doc_id AND s.k = t.k AND s.lvl = 1 WHERE form <> ''"""

RESUMES_SQL = "SELECT entry_id, '<résumé>Sommaire ' || doc_id || '</résumé>' AS resume_text FROM entries WHERE doc_id % 50 = 0"
MISMATCHES_SQL = f"SELECT sf AS source_file, {BEFORE + 1}::INT AS source_line, '{ABSENT}' AS \"check\", substr(l, 1, 30) AS actual FROM told WHERE k = 1 AND doc_id % {EVERY} = 4 AND NOT starts_with(l, '{ABSENT}')"


def asked(tables: str, question: str) -> str:
    """A question of the user's, put to the tables as SQL makes them."""
    rest = question.removeprefix("WITH RECURSIVE ")
    return f"WITH RECURSIVE {tables}" + (f", {rest}" if rest != question else f" {question}")
