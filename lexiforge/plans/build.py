"""From scanned rows to the relational contract: authors, roles, forms, scope, ids, flags.

Roles follow "certain or Unclassified": the first rule that matches decides. Two paths
are kept: ``src_path`` (parse order; authors, lines) and ``path`` (after scope; ids).
Tables follow the order of file names, then of entries, then of the tree.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tei
from ..functions.etymology import segments
from ..functions.labels import BUILT_IN, NormTables, has_valency, is_pronunciation_prose
from ..functions.text import form_before_comma, make_id, strip, strip_tags, truncate
from ..operators.lookup import mismatches, override
from ..operators.publish import Publication
from ..operators.scan import SMALL, items_before
from ..operators.sequence import island_ends, islands, neighbours, number_repeats, number_rows, resolve_idem, stratified_sample
from ..sources.dictionary import RUBRIQUES
from ..staging import discard, staged

ENTRY = ["source_file", "entry_ord"]

#: What a block opens with, by role, in rule order (case is ignored).
PROVERB = [r"^prov\.\s", r"^proverbe\b", r"^proverbialement\b"]
REGISTER = [
    r"^populaire(ment)?\b",
    r"^(familièr|vulgair|ironiqu|burlesqu|poétiqu)ement\b",
    r"^plaisamment\b",
    r"^par (euphémisme|exagération|ironie|dérision|extension|analogie|métaphore|plaisanterie|antiphrase)\b",
    r"^néologisme\b",
    r"^(très )?peu usité\b",
    r"^hors d'usage\b",
    r"^tombé en désuétude\b",
    r"^il est (familier|vieux|populaire|inusité|hors d'usage)\b",
    r"^il n'est plus usité\b",
    r"^il (a vieilli|vieillit)\b",
    r"^ce mot (est|a vieilli)\b",
    r"^ce sens a vieilli\b",
    r"^cet emploi (vieillit|a vieilli)\b",
    r"^(mot|terme) (vieilli|vieux|familier|populaire|inusité|bas)\b",
]
VOICE = [
    r"^v\.\s*(n|a|réfl)\b",
    r"^se\s+conjugue\b",
    r"^(absolument|substantivement|adverbialement|adjectivement|intransitivement|neutralement|impersonnellement|activement)\b",
]
FIGURATIVE = [r"^fig\.\s"]
VOICE_LABEL = [r"^au (pluriel|féminin|singulier|masc(\.|ulin)?|fém(\.|inin)?)\.?\s*$", r"^avec un nom de [^,.]*\.?\s*$"]
REGISTER_LABEL = [r"^(familière?|familier|vieux|vieillie?|rare|bas(se)?|vulgaire|triviale?|inusitée?)\.?\s*$"]
XREF_LEAD, XREF_TAIL, XREF_LONGEST = r"^(voy\.|v\.|voyez\b)", r",\s*voy\.\s*$", 120
CAPITALS = "A-ZÉÈÊÀÂÎÏÔÙÛÜÇ"
REFLEXIVE = rf"^S'[{CAPITALS}].*,\s*v\.\s*réfl\b"
STRONG = [rf"^(S'[{CAPITALS}].+),\s+(v\.\s*.+)", rf"^([{CAPITALS}][{CAPITALS} '\-]+),\s+(v\.\s*(?:n|a|réfl)|s\.\s*[mf]|adj)\b"]
GLOSS = r",?\s*(?:c\.-à-d\.|c'est-à-dire|se dit|pour dire|signifie)"
PROVERB_LEAD = r"^\s*prov(?:erbe|erbialement)?\.?\s*[:.]?\s*"
METONYMIC = r"^(?:(?:les|la|le)\s+|l')\p{L}"
LIKELY_LOCUTION = r"^(Loc\.\s|Locution)"
#: The longest form taken from prose, the scopes that are flagged as large, the rows sampled of a bucket.
FORM_LONGEST, LARGE_SCOPE, LARGE_INTRA, SAMPLED = 60, 15, 5, 5


def _any(text: Column, patterns: list[str]) -> Column:
    """Whether the text opens with one of ``patterns``, which all begin with ``^``: that stands first, so that no other place of the text is tried."""
    return text.rlike("(?iuU)^(?:" + "|".join(f"(?:{p.removeprefix('^')})" for p in patterns) + ")")


def role_by_markup(content: Column, plain: Column) -> Column:
    """Tier A: what markup says for certain; null otherwise."""
    xref = content.contains("<a ref=") & (F.length(plain) < XREF_LONGEST) & (plain.rlike("(?iuU)" + XREF_LEAD) | plain.rlike("(?iuU)" + XREF_TAIL))
    return (
        F.when(content.contains('<semantique type="indicateur">Fig.'), "Figurative")
        .when(content.contains('<semantique type="domaine">'), "DomainLabel")
        .when(content.contains("<nature>"), "NatureLabel")
        .when(content.contains("<exemple>"), F.when(_any(plain, PROVERB), "Proverb").otherwise("Locution"))
        .when(xref, "CrossReference")
    )


def _openings() -> set[str]:
    """The first two letters of every text that a rule can match, as the patterns spell them."""
    words = "pr po fa vu ir bu pl pa né tr pe ho to il ce mo te v. se ab su ad in ne im ac fi au av vi ra ba"
    return set(words.split())


TEXT_RULES = [(PROVERB, "Proverb"), (REGISTER, "RegisterLabel"), (VOICE, "VoiceTransition"), (FIGURATIVE, "Figurative"), (VOICE_LABEL, "VoiceTransition"), (REGISTER_LABEL, "RegisterLabel")]


def role_by_text(plain: Column) -> Column:
    """Tier B: what the block opens with. Two letters rule most texts out before any pattern is tried."""
    rules = TEXT_RULES
    cascade = reduce(lambda out, rule: out.when(_any(plain, rule[0]), rule[1]), rules[1:], F.when(_any(plain, rules[0][0]), rules[0][1]))
    opens = F.lower(F.substring(plain, 1, 2)).isin(*sorted(_openings()))
    return F.when(opens, cascade.otherwise("Unclassified")).otherwise("Unclassified")


def classify(nodes: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """``plain``, ``role`` and ``method`` of indents under body senses. Their text is stripped behind the join, so it travels once."""
    a, b = role_by_markup(F.col("content"), F.col("plain")), role_by_text(F.col("plain"))
    rule, method = F.coalesce(a, b), F.when(a.isNotNull(), "Deterministic").otherwise("Heuristic")
    plain = strip_tags(F.col("content"))
    if verdicts is None:
        return nodes.withColumn("plain", plain).withColumns({"role": rule, "method": method})
    order = ("ord",) if "ord" in verdicts.columns else ()
    return override(nodes, verdicts, ["source_file", "source_line"], plain, rule, method, order=order)


def forms(d: DataFrame) -> DataFrame:
    """``canonical_form`` and its source for locutions and proverbs; a reflexive locution is a voice transition.

    A printed example is the form, even an empty one; else a locution's form is the text before
    its first comma, if there is one, and a proverb's the text before its gloss.
    """
    plain, content = F.col("plain"), F.col("content")
    reflexive = (F.col("role") == "Locution") & plain.rlike("(?uU)" + REFLEXIVE)
    d = d.withColumns({"method": F.when(reflexive, "Heuristic").otherwise(F.col("method")), "role": F.when(reflexive, "VoiceTransition").otherwise(F.col("role"))})
    printed = content.rlike("<exemple>.*?</exemple>")
    example = strip(F.regexp_extract(content, "<exemple>(.*?)</exemple>", 1))
    before_comma = F.coalesce(form_before_comma(plain, FORM_LONGEST), F.lit(""))
    body = F.regexp_replace(plain, "(?iuU)" + PROVERB_LEAD, "")
    saying = strip(F.regexp_replace(strip(F.get(F.split(body, "(?iuU)" + GLOSS, 2), F.lit(0))), r"[.,;:]+$", ""))
    form = F.when(F.col("role") == "Locution", F.when(printed, example).otherwise(before_comma)).when(F.col("role") == "Proverb", F.when(printed, example).otherwise(saying))
    form = F.coalesce(form, F.lit(""))
    source = F.when(F.col("role").isin("Locution", "Proverb") & printed, "exemple").when(form != "", "prose").otherwise("none")
    return d.withColumns({"canonical_form": form, "canonical_form_source": source})


#: Scanned rows whose texts senses show.
BODY = "kind in ('sense', 'indent') and path[0] = 1 and not in_rubrique"
#: Blocks below the body's senses.
OWN = "kind = 'indent' and in_body"
TRANSITIONS = ("NatureLabel", "VoiceTransition")


def told(d: DataFrame) -> DataFrame:
    """What scope and flags ask of a block's text."""
    role, plain, content = F.col("role"), F.col("plain"), F.col("content")
    strong = [F.struct(F.regexp_extract(plain, p, 1).alias("form"), F.regexp_extract(plain, p, 2).alias("pos")) for p in STRONG]
    return d.withColumns({
        "strong": F.when(role == "VoiceTransition", F.when(strong[0]["form"] != "", strong[0]).when(strong[1]["form"] != "", strong[1])),
        "voice": F.when(role == "VoiceTransition", plain),
        "nature": F.when(role.isin(*TRANSITIONS) & content.contains("<nature>"), content),
        "likely": plain.rlike("(?iuU)" + LIKELY_LOCUTION),
        "gloss": F.when(role == "Locution", truncate(gloss(plain, F.col("canonical_form")), 200)),
    })


def entries_of(rows: DataFrame) -> DataFrame:
    e = rows.where("kind = 'entry'").select(*ENTRY, "headword", "homograph_index", "is_supplement", "pronunciation", "pos", "resume_text")
    e = e.withColumn("entry_id", make_id(F.col("headword"), F.col("homograph_index")))
    e = number_repeats(e, ["source_file"], ["entry_ord"], "entry_id", SMALL)
    e = number_repeats(e, [], ENTRY, "entry_id", SMALL)
    return e.withColumn("source_letter", F.substring("source_file", 1, 1))


def citations_of(rows: DataFrame) -> DataFrame:
    c = rows.where("kind = 'citation'").select(*ENTRY, F.col("path").alias("src_path"), "cit_ord", F.col("content").alias("text_markup"), "author", "reference", "hide", "source_line")
    c = resolve_idem(c, ENTRY, ["src_path", "cit_ord"], hot_rows=SMALL)
    return c.withColumn("resolved_author", F.when(F.col("resolved_author") == "", F.col("author")).otherwise(F.col("resolved_author")))


def scoped(nodes: DataFrame, cited: DataFrame) -> DataFrame:
    """Body nodes with ``path`` after scope, and one 'group' node for each scoped transition.

    A sense whose last block is an uncited voice transition carries it: the senses up to
    the next carrier move below a group that stands after the carrier. Inside a sense a
    transition takes the plain blocks after it as further children.

    All is told by windows in one order of the rows, in which a sense comes before its blocks and a block before those
    below it, so that each row has the running figures of its sense and block: nothing is read or sorted once more for each.
    """
    has_cit = cited.select(*ENTRY, "src_path", F.lit(True).alias("cited")).distinct()
    d = nodes.where("in_body").join(has_cit, [*ENTRY, "src_path"], "left")
    own = [c for c in d.columns if c not in {*ENTRY, "cited"}]
    d = d.withColumns({"i": F.col("src_path")[1], "a": F.get("src_path", F.lit(2))})
    indent, n = F.col("kind") == "indent", F.size("src_path")
    d = d.withColumns({"sense": F.col("kind") == "sense", "top": indent & (n == 3), "kid": (indent & (n == 4)).cast("int")})
    sense, top, rows = F.col("sense"), F.col("top"), (Window.unboundedPreceding, Window.currentRow)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.last(F.when(top, F.struct("role", "src_path", "strong", "voice", "cited")), ignorenulls=True)
    d = d.withColumn("last", last.over(Window.partitionBy(*ENTRY, "i").orderBy("a", "src_path").rowsBetween(*whole)))
    d = d.withColumn("last", F.when(sense, F.col("last")))
    carrier = sense & (F.coalesce(F.col("last.role"), F.lit("")) == "VoiceTransition") & F.col("last.cited").isNull()
    d = d.withColumn("island", F.sum(carrier.cast("int")).over(Window.partitionBy(*ENTRY).orderBy("i", "a", "src_path").rowsBetween(*rows)))
    # From here on rows stay in one order.
    w = Window.partitionBy(*ENTRY, "island").orderBy("i", "a", "src_path")
    first, senses = (F.col("island") > 0).cast("long"), F.sum(sense.cast("int"))
    d = d.withColumns({"rank": senses.over(w.rowsBetween(*rows)) - first, "size": senses.over(w.rowsBetween(*whole)) - first})
    d = d.withColumns({"opens": (F.col("island") > 0) & (F.col("rank") == 0) & (F.col("size") > 0), "moved": (F.col("island") > 0) & (F.col("rank") > 0)})
    # A place at top level: one for each sense that stays, one more after a carrier that opens.
    places = F.when(sense, (~F.col("moved")).cast("int") + F.col("opens").cast("int")).otherwise(0)
    d = d.withColumn("place", F.sum(places).over(Window.partitionBy(*ENTRY).orderBy("island", "i", "a", "src_path").rowsBetween(*rows)))
    of_sense = Window.partitionBy(*ENTRY, "island", "i").orderBy("a", "src_path")
    of_top = Window.partitionBy(*ENTRY, "island", "i", "a").orderBy("src_path").rowsBetween(*whole)
    d = d.withColumns({"sense_num": F.max(F.when(sense, F.col("num"))).over(of_sense.rowsBetween(*whole)), "known": F.max(sense).over(of_sense.rowsBetween(*whole)), "last_a": F.max(F.when(top, F.col("a"))).over(of_sense.rowsBetween(*whole))})
    d = d.where("known").withColumn("popped", top & F.col("opens") & (F.col("a") == F.col("last_a")))
    # Blocks that stay: a transition takes those after it, up to the next one.
    d = d.withColumn("stays", top & ~F.col("popped"))
    heads = F.col("stays") & F.coalesce(F.col("role").isin(*TRANSITIONS), F.lit(False))
    d = d.withColumns({"kids": F.sum("kid").over(of_top), "below": F.max("stays").over(of_top)})
    run = of_sense.rowsBetween(*rows)
    d = d.withColumn("nth", F.sum(F.col("stays").cast("int")).over(run))
    d = d.withColumn("head", F.last(F.when(heads, F.struct("nth", "kids")), ignorenulls=True).over(run))
    d = d.withColumn("k_rank", F.when(F.col("head").isNotNull(), F.col("nth") - F.col("head.nth")).otherwise(0))
    d = d.withColumn("at", F.sum((F.col("stays") & (F.col("k_rank") == 0)).cast("int")).over(run))
    tail = F.when(F.col("below"), F.when(F.col("k_rank") > 0, F.array(F.col("at"), F.col("head.kids") + F.col("k_rank"))).otherwise(F.array("at"))).cast("array<int>")
    one = F.lit(1)
    new = F.when(F.col("moved"), F.array(one, F.col("place"), F.col("rank"))).otherwise(F.array(one, F.col("place") - F.col("opens").cast("int"))).cast("array<int>")
    d = d.withColumns({"tail": tail, "sense_path": new})
    # A sense that opens gives the group after it as well; the block that made it one is gone.
    d = d.withColumn("group", F.explode(F.when(sense & F.col("opens"), F.array(F.lit(False), F.lit(True))).when(F.col("popped"), F.array().cast("array<boolean>")).otherwise(F.array(F.lit(False)))))
    rubrique = F.concat("sense_path", F.slice("src_path", F.lit(3), F.size("src_path")))
    path = F.when(sense, F.col("sense_path")).when(F.col("in_rubrique"), rubrique).otherwise(F.concat("sense_path", "tail", F.slice("src_path", F.lit(4), F.size("src_path"))))
    group, st = F.col("group"), F.col("last.strong")
    made = {"kind": F.lit("group"), "src_path": F.col("last.src_path"), "voice": F.col("last.voice")}
    return d.select(
        *ENTRY,
        *[F.when(~group, F.col(c)).otherwise(made.get(c)).alias(c) for c in own],
        F.when(group, F.array(one, F.col("place")).cast("array<int>")).otherwise(path).alias("path"),
        *[F.when(~group, F.col(c)).alias(c) for c in ("sense_path", "sense_num")],
        F.when(group, F.when(st.isNotNull(), "strong").otherwise("medium")).alias("transition_type"),
        F.when(group, F.coalesce(st["form"], F.lit(""))).alias("transition_form"),
        F.when(group, F.coalesce(st["pos"], F.lit(""))).alias("transition_pos"),
        F.when(group, F.col("size")).alias("n_scoped"),
    )


#: The type of a block by its role.
SENSE_TYPE = {"Figurative": "figurative", "DomainLabel": "domain", "CrossReference": "cross_reference", "RegisterLabel": "register", "Proverb": "proverb", "Locution": "locution", "Unclassified": "unclassified"}
METONYMIC_LABEL = "metonymic_subsense"
ORDER = ["source_file", "entry_ord"]


def _xml_id() -> Column:
    return F.concat(F.col("entry_id"), F.lit("_s"), F.array_join(F.slice("path", F.lit(2), F.size("path")), "."))


TABLES = ("entries", "senses", "citations", "locutions", "rubriques", "review_queue")
#: The columns of the senses' table.
COLUMNS = "sense_id entry_id parent_sense_id num indent_id xml_id sense_type role content_plain content_markup is_supplement transition_type transition_form transition_pos depth".split()


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})


def _with_neighbours(json: Column) -> Column:
    """A context with the texts of the blocks beside it; a key is absent where there is none."""
    beside = F.to_json(F.struct(F.col("prev_text").alias("prev_indent"), F.col("next_text").alias("next_indent")))
    return F.when(beside == "{}", json).otherwise(F.concat(F.regexp_replace(json, r"\}$", ","), F.substring(beside, 2, 1 << 20)))


def _flag(when: Column, order: int, phase: str, kind, reason, context: Column) -> Column:
    """A struct of the review queue where ``when`` holds, else null."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(when, F.struct(F.lit(order).alias("flag_ord"), F.lit(phase).alias("phase"), text(kind).alias("flag_type"), text(reason).alias("reason"), context.alias("context")))


def _flags(d: DataFrame, flags: list[Column], level: Column, path: Column, sub: Column | None = None) -> DataFrame:
    """The flags of each row, in one pass over ``d``."""
    every = F.explode(F.filter(F.array(*flags), lambda f: f.isNotNull()))
    place = F.struct(F.lit("").alias("bucket"), "source_file", "entry_ord", level.alias("level"), path.cast("array<int>").alias("path"), (F.lit(0) if sub is None else sub).cast("int").alias("sub"))
    return d.select("entry_id", "headword", place.alias("place"), every.alias("f")).select("entry_id", "headword", "place", "f.*")


class Dictionary:
    """The built tables of one corpus.

    ``verdicts`` (source_file, source_line, check, verdict[, ord]) override roles;
    ``adjudications`` (xml_id, label) take metonymic sub-senses out of the locutions;
    ``tables`` and ``languages`` replace the router's and the segmenter's tables;
    ``by_entry`` are ``rows`` once more, in slices of whole entries that are dealt out by entry:
    they are staged one after the other, so that only one slice is in the shuffle at a time.
    The rows are not staged whole unless texts of the body are asked for.
    ``buckets``: into so many parts entries are dealt out; the rows of one are sorted in memory.
    """

    def __init__(self, rows: DataFrame, verdicts: DataFrame | None = None, adjudications: DataFrame | None = None, tables: NormTables = BUILT_IN, languages: tuple[dict, frozenset] | None = None, by_entry: list[DataFrame] | None = None, buckets: int | None = None):
        self.tables, self.languages, self.verdicts = tables, languages or (None, None), verdicts
        self.spark = rows.sparkSession
        self.dealt = (buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions")), ENTRY)
        self.scanned, self.by_entry = rows, by_entry or [rows]
        empty = self.spark.createDataFrame([], "xml_id string, label string")
        self.adjudications = (empty if adjudications is None else adjudications).where(F.col("label") == METONYMIC_LABEL).select("xml_id").distinct()

    @cached_property
    def rows(self) -> DataFrame:
        """The whole scan, for what shows the body's texts."""
        return staged(self.by_entry[0], "scan", codec="zstd", by=self.dealt, then=self.by_entry[1:])

    @cached_property
    def marks(self) -> DataFrame:
        """The scan's rows without the body's texts, but with what these say by themselves: roles by rule, forms, short or rare texts that scope and flags ask for.

        They are staged in buckets by entry: what joins or groups within entries needs no exchange.
        """
        longest = None if self.verdicts is None else self.verdicts.agg(F.max(F.length("check"))).first()[0] or 0
        made = [self._marked(d, longest) for d in ([self.rows] if "rows" in self.__dict__ else self.by_entry)]
        return staged(made[0], "marks", codec="zstd", by=self.dealt, then=made[1:])

    def _marked(self, d: DataFrame, longest: int | None) -> DataFrame:
        path, content = F.col("path"), F.col("content")
        in_top = F.coalesce(F.col("kind").isin("sense", "indent", "rubrique") & (F.get("path", F.lit(0)) == 1), F.lit(False))
        d = d.withColumns({"in_top": in_top, "in_body": in_top & ((F.col("kind") != "indent") | ~F.col("in_rubrique"))})
        body = F.col("in_body") & F.col("kind").isin("sense", "indent") & ~F.coalesce("in_rubrique", F.lit(False))
        d = d.withColumns({"kept": F.when(~body, content), "content": F.when(F.expr(OWN), content)})
        d = told(forms(classify(d)))
        if longest is not None:  # no more of a text is compared with a verdict than the longest check
            d = d.withColumn("opening", F.substring("plain", 1, longest))
        return d.drop("content", "plain").withColumnRenamed("kept", "content")

    @cached_property
    def sections(self) -> DataFrame:
        """Entries and rubriques with the blocks below these, in buckets by entry: of the marks or the scan, if one is staged, else these rows alone."""
        asked = "kind in ('entry', 'rubrique') or kind = 'indent' and in_rubrique"
        for made in ("marks", "rows"):
            if made in self.__dict__:
                return self.__dict__[made].where(asked)
        head = ["headword", "homograph_index", "is_supplement", "pronunciation", "pos", "resume_text"]
        d = self.scanned.where(asked).select(*ENTRY, "kind", "path", *head, "rubrique_kind", "in_rubrique", "content")
        return staged(self._spread(d), "sections", codec="zstd", by=self.dealt)

    @cached_property
    def entries(self) -> DataFrame:
        return staged(entries_of(self.sections), "entries")

    @property
    def all_citations(self) -> DataFrame:
        return citations_of(self.marks)

    def _spread(self, d: DataFrame) -> DataFrame:
        """Rows dealt out by their entry: what is joined or windowed within entries then stays where it is."""
        return d.repartition(self.dealt[0], *ENTRY)

    def _numbered(self, d: DataFrame, order: list, out: str, keys: DataFrame | None = None, named: DataFrame | None = None) -> DataFrame:
        """Gapless numbers from 1 in the order of entries, and of ``order`` in them: an entry's rows stay where they are.

        ``keys``: a row of ENTRY for each of ``d``, if that is made from more; ``named``: columns of entries to join on the way.
        """
        before = items_before((d if keys is None else keys).groupBy(*ENTRY).agg(F.count("*").alias("n")), ORDER, F.col("n"), "before").drop("n")
        at = F.row_number().over(Window.partitionBy(*ENTRY).orderBy(*order))
        before = before if named is None else before.join(named, ENTRY)
        return d.withColumn("__at", at).join(self._spread(before), ENTRY).withColumn(out, F.col("before") + F.col("__at")).drop("before", "__at")

    def with_text(self, d: DataFrame, most: int | None = None, few: bool = False) -> DataFrame:
        """Rows of the body with the ``content`` of their nodes and its ``plain`` text, of which ``most`` asks for the first characters only.

        Texts stand in the scan alone and are fetched last, so that no stage holds them twice. The scan and
        the body are both staged in buckets by entry, so an entry's texts, in a list, meet its rows without
        any exchange; ``text_at`` says where in the list a row's text is. The texts of ``few`` rows
        are taken from the source again if the scan is not staged.
        """
        content, plain = F.col("content"), strip_tags(F.col("content"))
        said = ["content"] if most is None else [truncate(content, most).alias("content"), truncate(plain, most).alias("plain")]
        few = few and "rows" not in self.__dict__
        t = (self.scanned if few else self.rows).where(BODY)
        if few:
            t = t.join(F.broadcast(d.select(*ENTRY).distinct()), ENTRY, "left_semi")
        t = t.groupBy(*ENTRY).agg(F.array_sort(F.collect_list(F.struct("path", *said))).alias("__texts"))
        met = d.join(t, ENTRY, "left").withColumn("__text", F.get("__texts", F.col("text_at") - 1))
        met = met.withColumn("content", F.col("__text.content")).withColumn("plain", plain if most is None else F.col("__text.plain"))
        return met.drop("__texts", "__text", "text_at")

    @cached_property
    def ruled(self) -> DataFrame:
        """The blocks that a verdict decides, with their role and what their text says in it.

        Only keys and openings meet the verdicts; whole texts are fetched for blocks whose verdict asks for them, if there are any.
        """
        order = ("ord",) if "ord" in self.verdicts.columns else ()
        opened = self.marks.where(OWN).select(*ENTRY, F.col("path").alias("src_path"), "source_line", "opening")
        hits = override(opened, self.verdicts, ["source_file", "source_line"], "opening", F.lit(None).cast("string"), order=order).where("method = 'LlmAssisted'")
        hits = staged(hits.select(*ENTRY, "src_path", "role", "method"), "verdicts")
        asks = F.col("role").isin("Locution", "Proverb", *TRANSITIONS)
        plain = hits.where(~asks).withColumns({"canonical_form": F.lit(""), "canonical_form_source": F.lit("none")})
        if not hits.where(asks).isEmpty():
            texts = self.__dict__.get("rows", self.scanned).where("kind = 'indent' and path[0] = 1 and not in_rubrique").select(*ENTRY, F.col("path").alias("src_path"), "content")
            d = texts.join(hits.where(asks), [*ENTRY, "src_path"]).withColumn("plain", strip_tags(F.col("content")))
            plain = plain.unionByName(told(forms(d)).drop("content", "plain", "likely"), allowMissingColumns=True)
        return staged(plain, "ruled", codec="zstd")

    @property
    def nodes(self) -> DataFrame:
        """Senses, blocks and rubriques with what their texts say, without the texts."""
        keys = [*ENTRY, "kind", F.col("path").alias("src_path"), "rubrique_kind", "rubrique_name", "num", "is_resume", "is_supplement", "in_rubrique", "source_line", "in_top", "in_body"]
        said = ["role", "method", "canonical_form", "canonical_form_source", "strong", "voice", "nature", "gloss"]
        d = self.marks.where("kind in ('sense', 'indent', 'rubrique')").select(*keys, *said, "likely")
        d = d.withColumns({c: F.when(F.expr(OWN), F.col(c)) for c in ("role", "method")})
        if self.verdicts is not None:
            v = self._spread(self.ruled)
            v = v.select(*ENTRY, "src_path", F.struct(*[F.col(c) if c in v.columns else F.lit(None).cast(d.schema[c].dataType).alias(c) for c in said]).alias("ruled"))
            d = d.join(v, [*ENTRY, "src_path"], "left").withColumns({c: F.when(F.col("ruled").isNotNull(), F.col("ruled")[c]).otherwise(F.col(c)) for c in said}).drop("ruled")
        return d.withColumn("likely", (F.col("role") != "Locution") & F.col("likely"))

    @cached_property
    def body(self) -> DataFrame:
        """The senses' rows after scope, numbered, without their texts."""
        walked = scoped(self.nodes.withColumn("in_body", F.col("in_top")), self.all_citations.select(*ENTRY, "src_path"))
        walked = walked.where("kind <> 'rubrique' and not coalesce(in_rubrique, false)")
        up = F.slice("path", F.lit(1), F.size("path") - 1)
        walked = staged(walked.withColumn("parent_path", up), "walked", together=True, codec="zstd", by=self.dealt)
        # An entry's numbers follow those of all entries before it.
        before = items_before(walked.groupBy(*ENTRY).agg(F.count("*").alias("n")), ORDER, F.col("n"), "before").drop("n")
        at, text_at = (F.row_number().over(Window.partitionBy(*ENTRY).orderBy(p)) for p in ("path", "src_path"))
        d = walked.withColumns({"at": at, "text_at": text_at})
        kids = d.groupBy(*ENTRY, F.col("parent_path").alias("path")).agg(F.count("*").alias("kids"))
        above = d.select(*ENTRY, F.col("path").alias("parent_path"), F.col("at").alias("parent_at"))
        d = d.join(kids, [*ENTRY, "path"], "left").fillna(0, ["kids"]).join(above, [*ENTRY, "parent_path"], "left")
        d = d.join(self._spread(self.entries.select(*ENTRY, "entry_id", "headword")), ENTRY).join(self._spread(before), ENTRY)
        d = d.withColumns({"xml_id": _xml_id(), "sense_id": F.col("before") + F.col("at"), "parent_sense_id": F.col("before") + F.col("parent_at")})
        # Only locutions are adjudicated: they alone travel by their ids.
        ruled = d.where("role = 'Locution'").select(*ENTRY, "path", "xml_id").join(self.adjudications, "xml_id", "left_semi").select(*ENTRY, "path", F.lit(True).alias("metonymic"))
        d = d.join(self._spread(ruled), [*ENTRY, "path"], "left").fillna(False, ["metonymic"])
        d = staged(d.drop("before", "at", "parent_at", "parent_path"), "body", together=True, codec="zstd", by=self.dealt)
        discard(walked)
        return d

    # -- the six tables ---------------------------------------------------------------------

    @cached_property
    def senses(self) -> DataFrame:
        """The contract's senses with the keys that lead back to the source, without their texts."""
        return self._senses(self.body)

    def _senses(self, d: DataFrame, *more: str | Column) -> DataFrame:
        named = F.create_map(*[F.lit(x) for p in SENSE_TYPE.items() for x in p])
        kind = (
            F.when((F.col("kind") == "sense") | F.col("metonymic"), "sense")
            .when(F.col("kind") == "group", F.when(F.col("transition_type") == "strong", "homonymic_entry").otherwise("usage_group"))
            .when(F.col("role").isin(*TRANSITIONS), F.when(F.col("kids") == 0, "annotation").otherwise("transition_group"))
            .otherwise(F.element_at(named, F.col("role")))
        )
        below = F.slice("path", F.size("sense_path") + 1, F.size("path"))
        indent_id = F.when(F.col("kind") != "group", F.array_join(F.concat(F.array("entry_id", F.coalesce("sense_num", F.lit(1)).cast("string")), below.cast("array<string>")), "."))
        return d.select(
            "sense_id", "entry_id", "parent_sense_id", "num", indent_id.alias("indent_id"), "xml_id", kind.alias("sense_type"), "role",
            (F.coalesce("is_supplement", F.lit(False)) & (F.col("kind") == "sense")).cast("int").alias("is_supplement"),
            "transition_type", F.expr("nullif(transition_form, '')").alias("transition_form"), F.expr("nullif(transition_pos, '')").alias("transition_pos"),
            (F.size("path") - 2).alias("depth"), "canonical_form", "canonical_form_source", "method", "metonymic", *ENTRY, F.when(F.col("kind") != "group", F.col("src_path")).alias("src_path"), "source_line",
            F.col("src_path").alias("text_path"), (F.col("kind") == "indent").alias("is_block"), *more,
        )

    @cached_property
    def citations(self) -> DataFrame:
        ids = self.body.where("kind <> 'group'").select(*ENTRY, "src_path", "sense_id")
        c = self.all_citations.join(ids, [*ENTRY, "src_path"]).drop("src_path", "source_line")
        c = staged(c, "cited", together=True, codec="zstd", by=self.dealt)
        at = c.lexiforge_stage
        c = self._numbered(c, ["sense_id", "cit_ord"], "citation_id")
        c = c.select("citation_id", "sense_id", strip_tags(F.col("text_markup")).alias("text_plain"), "text_markup", "author", "resolved_author", "reference", (F.col("hide") != "").cast("int").alias("is_hidden"))
        c.lexiforge_stage = at
        return c

    @cached_property
    def rubriques(self) -> DataFrame:
        """Entry-level rubriques, with the texts of their blocks: both are told by one path, so an entry's texts stay where they are staged."""
        path, own = F.col("path"), F.col("kind") == "rubrique"
        d = self.sections.where("kind <> 'entry' and path[0] <> 1")
        line = F.when(own, 0).otherwise(F.element_at(path, -1))
        d = d.select(*ENTRY, F.when(own, path).otherwise(F.slice(path, F.lit(1), F.size(path) - 1)).alias("rubrique"), line.alias("line"), F.when(own, F.col("rubrique_kind")).alias("kind"), "content")
        texts = F.array_sort(F.collect_list(F.when((F.col("line") > 0) | (F.col("content") != ""), F.struct("line", "content"))))
        r = d.groupBy(*ENTRY, "rubrique").agg(F.max("kind").alias("rubrique_type"), F.array_join(F.transform(texts, lambda x: x["content"]), " ").alias("m")).where("rubrique_type is not null")
        keys = d.where("kind is not null").select(*ENTRY, "rubrique").distinct()
        r = self._numbered(r, ["rubrique"], "rubrique_id", keys, self.entries.select(*ENTRY, "entry_id"))
        return r.select("rubrique_id", "entry_id", "rubrique_type", strip_tags(F.col("m")).alias("content_plain"), F.col("m").alias("content_markup"))

    def table(self, name: str, texts: bool = True) -> DataFrame:
        """One of the six tables with the contract's columns; nothing that it does not need is built. Without ``texts`` senses lack theirs, and the review queue its contexts and numbers."""
        self._begin([name], texts)
        if name == "entries":
            nulled = [F.expr(f"nullif({c}, '')").alias(c) for c in ("pronunciation", "pos")]
            return self.entries.select("entry_id", "headword", "homograph_index", *nulled, F.col("is_supplement").cast("int").alias("is_supplement"), "source_letter")
        if name == "senses":
            if not texts:
                return self.senses.select(*[c for c in COLUMNS if not c.startswith("content_")])
            return self._told_senses(self.with_text(self.body.drop("xml_id")))
        if name == "locutions":
            return self.senses.where("role = 'Locution' and canonical_form <> '' and not metonymic").select("sense_id", "canonical_form")
        return {"citations": lambda: self.citations, "rubriques": lambda: self.rubriques, "review_queue": lambda: self.flags if texts else self.cases}[name]()

    def _begin(self, names: list[str] | tuple[str, ...], texts: bool = True) -> None:
        """What goes beyond entries and rubriques reads the marks: they are staged first, and the sections are a part of them.

        Before them the whole scan, if texts of the body are asked for: the marks are then made of it, and the source is read once.
        """
        if texts and {*names} & {"senses", "review_queue"}:
            self.rows
        if {*names} - {"entries", "rubriques"}:
            self.marks

    def _told_senses(self, d: DataFrame) -> DataFrame:
        """Senses with their texts; what follows from other columns is worked out behind the exchange."""
        d = self._senses(d.withColumn("xml_id", _xml_id()), "content", "plain")
        said = F.col("is_block") | (F.col("content") != "")
        return d.withColumns({"content_plain": F.when(said, F.col("plain")), "content_markup": F.when(said, F.col("content"))}).select(*COLUMNS)

    @property
    def contract(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def register(self, names: tuple[str, ...] = TABLES, texts: bool = True, late: bool = False) -> None:
        """The contract's tables as temporary views. ``late``: for a sense's plain text stands where it is, for ``with_late_texts``."""
        self._begin(names, texts and not late)
        for name in names:
            d = self.table(name, texts)
            if late and name == "senses":
                d = self._senses(self.body, F.struct(*ENTRY, "text_at", (F.col("kind") == "indent").alias("is_block")).alias("content_plain"))
            d.createOrReplaceTempView(name)

    def with_late_texts(self, d: DataFrame) -> DataFrame:
        """A question's rows, in their order, with the texts whose places they hold: only these are fetched."""
        own = d.columns
        d = staged(d.withColumn("__no", F.monotonically_increasing_id()), "asked", codec="zstd")
        at = d.select("__no", *[c for c in own if c != "content_plain"], "content_plain.*")
        met = self.with_text(at, few=d.limit(FEW + 1).count() <= FEW)
        said = F.when(F.col("is_block") | (F.col("content") != ""), F.col("plain"))
        return met.withColumn("content_plain", said).orderBy("__no").select(*own)

    def write(self, folder: str) -> DataFrame:
        """The six tables as the next version of a publication, and (table_name, n_rows) as observed on the way."""
        published, before = Publication(self.spark, folder), {*self.__dict__}
        self.rows  # staged before all else, so that the source is read once

        def senses():
            self.body
            # What was staged here for the other tables ends before the largest one is written.
            for name in {"marks", "sections", "rubrique_lines", "flags", "rubriques", "citations"} & {*self.__dict__} - before:
                discard(self.__dict__.pop(name))
            return self._told_senses(self.with_text(self.body.drop("xml_id")))

        # The queue first: what it stages is gone before the largest table is written.
        names = sorted(TABLES, key=lambda n: (n != "review_queue", n == "senses"))
        return published.counts(published.write({n: senses if n == "senses" else lambda n=n: self.table(n) for n in names}))

    # -- rubriques and etymology ------------------------------------------------------------

    @cached_property
    def rubrique_lines(self) -> DataFrame:
        """Every rubrique's own text (``line`` 0) and those of the blocks directly below it."""
        path = F.col("path")
        rub = self.sections.where("kind = 'rubrique'").select(*ENTRY, path.alias("rubrique"), "rubrique_kind", (path[0] == 1).alias("in_top"), F.lit(0).alias("line"), "content", path.alias("owner"))
        up = F.slice(path, F.lit(1), F.size(path) - 1)
        below = self.sections.where("kind = 'indent' and in_rubrique").select(*ENTRY, up.alias("rubrique"), F.element_at(path, -1).alias("line"), "content", path.alias("owner"))
        below = below.join(rub.select(*ENTRY, "rubrique", "rubrique_kind", "in_top"), [*ENTRY, "rubrique"])
        return rub.unionByName(below)

    @cached_property
    def etymology(self) -> DataFrame:
        """Every etymology line with its segments: flags and rendering read them from here."""
        d = self.rubrique_lines.where((F.col("rubrique_kind") == "Etymologie") & (strip(F.col("content")) != ""))
        d = d.join(self.entries.select(*ENTRY, "entry_id", "headword"), ENTRY).withColumn("segments", segments(F.col("content"), *self.languages))
        return staged(d, "etymology")

    # -- the review queue -------------------------------------------------------------------

    @cached_property
    def flags(self) -> DataFrame:
        """Everything uncertain, one row a case, context as JSON, in the order of its kinds."""
        self.rows  # staged before all else, so that the source is read once
        d = reduce(DataFrame.unionByName, [*self._block_flags(self.blocks), self._group_flags(True), *self._rubrique_flags()])
        d = number_rows(d, ["flag_ord", "place.bucket", "place.source_file", "place.entry_ord", "place.level", "place.path", "place.sub", "context"], "review_id", together=True)
        discard(self.__dict__.pop("blocks"))  # what is numbered is staged
        none = F.lit(None).cast("string")
        out = d.select("review_id", "entry_id", "headword", "phase", "flag_type", "reason", "context", none.alias("resolution"), none.alias("resolved_by"))
        out.lexiforge_stage = d.lexiforge_stage
        return out

    @property
    def cases(self) -> DataFrame:
        """The review queue's rows without numbers and contexts: no text is read."""
        none = F.lit(None).cast("string")
        ind = self._flagged_blocks().withColumns({c: none for c in ("content", "plain", "prev_text", "next_text")})
        d = reduce(DataFrame.unionByName, [*self._block_flags(ind), self._group_flags(False), *self._rubrique_flags()])
        return d.select("entry_id", "headword", "phase", "flag_type", "reason", none.alias("resolution"), none.alias("resolved_by"))

    def _flagged_blocks(self) -> DataFrame:
        ind = self.body.where("kind = 'indent'").withColumn("parent", F.slice("path", F.lit(1), F.size("path") - 1))
        direct = F.size("path") == F.size("sense_path") + 1
        return ind.select(*ENTRY, "entry_id", "headword", "xml_id", "text_at", "path", "parent", direct.alias("direct"), "role", "method", "sense_num", "kids", "canonical_form", "likely", "gloss", "nature")

    @cached_property
    def blocks(self) -> DataFrame:
        """Blocks with the openings of their texts and of the texts beside them."""
        ind = neighbours(self.with_text(self._flagged_blocks(), most=200), [*ENTRY, "parent"], ["path"], F.col("plain"))
        return staged(ind.drop("parent"), "blocks", together=True, codec="zstd")

    def _block_flags(self, ind: DataFrame) -> list[DataFrame]:
        ind = ind.withColumn("g", F.when(F.col("nature").isNotNull(), tei.gram_split(F.col("nature"))))
        role, num, content = F.col("role"), F.col("sense_num").alias("sense_num"), truncate(F.col("content"), 200)
        transition, locution = role.isin(*TRANSITIONS), role == "Locution"
        said = F.col("gloss")
        flags = [
            _flag(F.col("direct") & (role == "Unclassified"), 1, "phase3", "unclassified", "no rule matched", _with_neighbours(_json(sense_num=num, indent_content=content, method=F.col("method")))),
            _flag(F.col("direct") & locution & (F.col("canonical_form") == ""), 2, "phase4", "skipped_locution", "no canonical form extracted", _json(sense_num=num, indent_content=content)),
            _flag(F.col("direct") & F.col("likely"), 3, "phase3", "likely_locution", F.concat(F.lit("starts with Loc./Locution but classified as "), role), _json(sense_num=num, indent_content=content, current_role=role)),
            _flag(F.col("direct") & transition & (F.col("kids") > LARGE_INTRA), 4, "phase5", "large_intra_scope", F.concat(role, F.lit(" scoped "), "kids", F.lit(" children")), _json(sense_num=num, indent_content=truncate(F.col("plain"), 100), num_children=F.col("kids"))),
            _flag(locution & said.rlike("(?iuU)" + METONYMIC), 6, "structural", "metonymic_subsense", "locution gloss opens with a definite article", _json(canonical_form=F.col("canonical_form"), gloss=said)),
            _flag(transition & F.col("g.pre_kind").isin("reflexive_form", "locution_form"), 9, "structural", "intra_sense_form", F.concat(F.lit("printed form on an intra-sense transition ("), "g.pre_kind", F.lit(")")), _json(form=F.col("g.pre"), label=F.col("g.label"))),
        ]
        # A sample of each bucket of direct blocks, by a seeded draw.
        sample = stratified_sample(ind.where("direct and role is not null"), ["role", "method"], ["xml_id"], SAMPLED)
        reason = F.concat(F.lit("sample from "), role, F.lit("/"), "method", F.lit(" (n="), "bucket_size", F.lit(")"))
        context = _with_neighbours(_json(sense_num=num, indent_content=content, role=role, method=F.col("method"), bucket_size=F.col("bucket_size")))
        place = F.struct(F.concat_ws("/", "role", "method").alias("bucket"), F.lit("").alias("source_file"), F.lit(0).alias("entry_ord"), F.lit(0).alias("level"), F.array().cast("array<int>").alias("path"), F.col("pick").cast("int").alias("sub"))
        sampled = sample.select("entry_id", "headword", place.alias("place"), F.lit(11).alias("flag_ord"), F.lit("calibration").alias("phase"), F.lit("calibration_sample").alias("flag_type"), reason.alias("reason"), context.alias("context"))
        return [_flags(ind, flags, F.lit(0), F.col("path")), sampled]

    def _group_flags(self, texts: bool) -> DataFrame:
        group = self.body.where("kind = 'group'")
        if not texts:
            return self._scope_flags(group.withColumns({c: F.lit(None).cast("string") for c in ("first_scoped", "last_scoped")}))
        subs = self.body.where("kind = 'sense' and size(path) = 3").select(*ENTRY, "path", "src_path", F.slice("path", 1, 2).alias("head"))
        said = self.rows.where("kind = 'sense'").select(*ENTRY, F.col("path").alias("src_path"), truncate(strip_tags(F.col("content")), 80).alias("plain"))
        subs = subs.join(said, [*ENTRY, "src_path"])
        ends = island_ends(subs, [*ENTRY, "head"], "path", F.col("plain")).select(*ENTRY, F.col("head").alias("path"), F.col("first_text").alias("first_scoped"), F.col("last_text").alias("last_scoped"))
        return self._scope_flags(group.join(ends, [*ENTRY, "path"], "left"))

    def _scope_flags(self, d: DataFrame) -> DataFrame:
        text, n = truncate(F.col("voice"), 100), F.col("n_scoped")
        reason = F.concat("transition_type", F.lit(" scope, "), "n_scoped", F.lit(" senses"))
        context = _json(transition_content=text, scope_type=F.col("transition_type"), transition_form=F.col("transition_form"), transition_pos=F.col("transition_pos"), num_scoped=n, first_scoped=F.coalesce("first_scoped", F.lit("")), last_scoped=F.coalesce("last_scoped", F.lit("")))
        flags = [
            _flag(F.lit(True), 4, "phase5", F.when(n > LARGE_SCOPE, "large_scope").otherwise("scope_decision"), reason, context),
            _flag((F.col("transition_type") == "medium") & has_valency(F.col("voice"), self.tables), 7, "structural", "sense_level_valency", "valency transition scoped without a printed form", _json(transition_content=text, num_scoped=n)),
        ]
        return _flags(d, flags, F.lit(0), F.col("path"))

    def _rubrique_flags(self) -> list[DataFrame]:
        level = F.col("in_top").cast("int")  # an entry's rubriques before its senses'
        cits = self.all_citations.groupBy(*ENTRY, F.col("src_path").alias("owner")).agg(F.count("*").alias("n"))
        cited = self.rubrique_lines.where("rubrique_kind = 'Synonyme'").join(cits, [*ENTRY, "owner"]).groupBy(*ENTRY, "rubrique", "in_top").agg(F.sum("n").alias("n"))
        cited = cited.join(self.entries.select(*ENTRY, "entry_id", "headword"), ENTRY)
        synonyme = _flag(F.lit(True), 8, "structural", "synonyme_citations", F.concat("n", F.lit(" citations emitted as siblings after the synonymy xr")), _json(num_citations=F.col("n")))
        e = self.etymology
        whole = (F.size("segments") == 1) & (F.col("segments")[0]["kind"] == "prose") & F.col("content").contains("<")
        fallback = _flag(whole, 10, "etymology", "etym_fallback", "content carries markup outside the segmentable inventory; emitted as pre-W4 prose", _json(content=truncate(F.col("content"), 160)))
        part = e.select(*ENTRY, "entry_id", "headword", "in_top", "rubrique", "line", F.posexplode("segments").alias("i", "s")).withColumn("at", F.concat("rubrique", F.array(F.lit(0), "line")))
        s = F.col("s")
        flags = [
            _flag(s["kind"] == "suspect", 10, "etymology", "suspect_language_token", "token in language-abbreviation position missing from language table", _json(token=s["text"], anchor=s["anchor"])),
            _flag((s["kind"] == "cit") & s["defaulted"], 10, "etymology", "cognate_defaulted", "etymon-vs-cognate not disambiguated by surrounding prose", _json(forms=F.array_join(s["forms"], ", "))),
        ]
        return [
            _flags(cited, [synonyme], level, F.col("rubrique")),
            _flags(e, [fallback], level, F.concat("rubrique", F.array(F.lit(0), "line"))),
            _flags(part, flags, level, F.col("at"), F.col("i") + 1),
        ]

    # -- counters ---------------------------------------------------------------------------

    def metrics(self) -> DataFrame:
        """(metric, value): what the build's phases count."""
        ind = self.nodes.where("kind = 'indent' and in_body")
        group = self.body.where("kind = 'group'")
        sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
        n, known = F.count("*"), F.count_if(F.col("role").isNotNull())

        def long(d: DataFrame, **named: Column) -> DataFrame:
            one = d.agg(*[v.cast("double").alias(k) for k, v in named.items()])
            return one.select(F.explode(F.create_map(*[x for k in named for x in (F.lit(k), F.col(k))])).alias("metric", "value"))

        seg = self.etymology.select(F.explode_outer("segments").alias("s"))
        cues, suspects = F.count_if(F.col("s.cue").isNotNull()), F.count_if(F.col("s.kind") == "suspect")
        absorbed = self.body.where("kind = 'indent' and size(path) = size(sense_path) + 2 and size(src_path) = 3")
        carriers = self._terminal_transitions()
        parts = [
            long(ind, indents=n, classified=known, percent_classified=F.coalesce(F.bround(F.try_divide(known * 100, n), 1), F.lit(0.0))),
            long(group, strong_scoped=sum_of(F.when(F.col("transition_type") == "strong", F.col("n_scoped"))), medium_scoped=sum_of(F.when(F.col("transition_type") == "medium", F.col("n_scoped"))), ambiguous_scopes=F.count_if(F.col("n_scoped") > LARGE_SCOPE)),
            long(absorbed, intra_grouped=n),
            long(carriers, zero_scope=n),
            long(seg, cues_resolved=cues, cues_suspect=suspects, cue_hit_rate=F.coalesce(F.bround(F.try_divide(cues * 100, cues + suspects), 1), F.lit(100.0))),
            long(self.nodes.where("kind = 'rubrique'"), unknown_rubriques=F.count_if(~F.col("rubrique_name").isin(*RUBRIQUES))),
        ]
        roles = ind.groupBy(F.concat(F.lit("role "), F.coalesce("role", F.lit("unknown"))).alias("metric")).agg(n.cast("double").alias("value"))
        flags = self.flags.groupBy(F.concat(F.lit("flag "), "flag_type").alias("metric")).agg(n.cast("double").alias("value"))
        return reduce(DataFrame.unionByName, [*parts, roles, flags])

    def _terminal_transitions(self) -> DataFrame:
        """Senses that end in an uncited voice transition that governs nothing."""
        tops = self.nodes.where("kind = 'indent' and in_body and size(src_path) = 3")
        ends = tops.groupBy(*ENTRY, F.slice("src_path", 1, 2).alias("sense")).agg(F.max_by(F.struct("role", "src_path"), "src_path").alias("last"))
        ends = ends.where("last.role = 'VoiceTransition'").select(*ENTRY, F.col("last.src_path").alias("src_path"))
        cited, governs = self.all_citations.select(*ENTRY, "src_path"), self.body.where("kind = 'group'").select(*ENTRY, "src_path")
        return ends.join(cited.unionByName(governs), [*ENTRY, "src_path"], "left_anti")

    def verdict_mismatches(self) -> DataFrame:
        """(source_file, source_line, check, actual) of verdicts whose check does not open the block on their line."""
        order = ("ord",) if "ord" in self.verdicts.columns else ()
        longest = self.verdicts.agg(F.max(F.length("check"))).first()[0] or 0  # no more of a text is compared or shown
        opening = truncate(strip_tags(F.col("content")), max(30, longest)).alias("plain")
        blocks = self.rows.where("kind = 'indent' and not in_rubrique and path[0] = 1").select("source_file", "source_line", opening)
        return mismatches(blocks, self.verdicts, ["source_file", "source_line"], "plain", order=order)

    # -- rendering --------------------------------------------------------------------------

    @cached_property
    def rendered(self) -> DataFrame:
        """(source_file, entry_ord, entry_id, headword, pronunciation, pron_is_prose, tei, hoists), one row an entry."""
        nodes = self.with_text(self.body).select(
            *ENTRY, F.struct("path", "src_path", "kind", "role", "content", "num", F.coalesce("is_supplement", F.lit(False)).alias("is_supplement"), F.col("canonical_form").alias("form"), F.col("canonical_form_source").alias("form_source"), "transition_type", "transition_form", "transition_pos").alias("x")
        )
        cits = self.all_citations.select(*ENTRY, F.struct(F.col("src_path").alias("owner"), "cit_ord", F.col("text_markup").alias("text"), "author", "resolved_author", "reference", "hide").alias("x"))
        found = self.etymology.select(*ENTRY, "owner", "segments")
        lines = self.rubrique_lines.join(found, [*ENTRY, "owner"], "left").select(*ENTRY, F.struct("rubrique", "rubrique_kind", "line", "content", "owner", "segments").alias("x"))
        e = self.entries.withColumn("pron_is_prose", (F.col("pronunciation") != "") & is_pronunciation_prose(F.col("pronunciation")))
        for name, d in (("n", nodes), ("c", cits), ("r", lines)):
            e = e.join(d.groupBy(*ENTRY).agg(F.collect_list("x").alias(name)), ENTRY, "left")
        head = F.struct("entry_id", "headword", "pronunciation", "pron_is_prose", "pos", "is_supplement")
        names = frozenset(r["xml_id"] for r in self.adjudications.limit(ADJUDICATED + 1).collect())
        if len(names) > ADJUDICATED:
            raise ValueError(f"more than {ADJUDICATED} adjudications: they are made by hand and come to the driver")
        made = e.withColumn("x", tei.rendered(head, F.col("n"), F.col("c"), F.col("r"), self.tables, names))
        return staged(made.select(*ENTRY, "entry_id", "headword", "pronunciation", "pron_is_prose", "x.tei", "x.hoists"), "tei")

    def hoists(self) -> DataFrame:
        """(context_id, position, usg_type, label, def_excerpt) of every usage element lifted out of a definition."""
        d = self.rendered.select(F.explode("hoists").alias("h")).select("h.*")
        return d.select(*[F.regexp_replace(c, "\t", " ").alias(c) for c in d.columns])

    def prose_pronunciations(self) -> DataFrame:
        """(entry_id, headword, pronunciation) of remarks that stood where a transcription should."""
        return self.rendered.where("pron_is_prose").select("entry_id", "headword", F.regexp_replace("pronunciation", "\t", " ").alias("pronunciation"))

    def write_tei(self, folder: str, header: str = tei.HEADER, footer: str = tei.FOOTER) -> None:
        """The document as text parts that make it up in the order of their names, and the two reports."""
        ends = self.spark.createDataFrame([(0, "", 0, header), (2, "", 0, footer)], "part int, source_file string, entry_ord int, tei string")
        body = self.rendered.select(F.lit(1).alias("part"), "source_file", "entry_ord", "tei")
        whole = ends.unionByName(body).orderBy("part", "source_file", "entry_ord").select("tei")
        whole.write.mode("overwrite").text(f"{folder}/tei")
        for name, d in (("def_usg_hoists", self.hoists()), ("pron_prose_flags", self.prose_pronunciations())):
            d.write.mode("overwrite").csv(f"{folder}/reports/{name}", sep="\t", header=True, quote="", escapeQuotes=False)


#: Rows of a question whose texts are fetched from the source instead of a staged scan.
FEW = 50_000

#: The most adjudications the renderer takes to its workers.
ADJUDICATED = 100_000


def gloss(plain: Column, form: Column) -> Column:
    """What follows the printed form in a locution's text."""
    p = F.regexp_replace(plain, "(?iuU)" + PROVERB_LEAD, "")
    rest = F.when((form != "") & F.startswith(F.lower(p), F.lower(form)), F.regexp_replace(F.substr(p, F.length(form) + 1), r"^[ ,;:.]+", "")).otherwise(p)
    return strip(rest)
