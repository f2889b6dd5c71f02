"""Queries over the given tables: trees, recursion, phrases, scans, streams, published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import EMPHASIS, LINK, straightened
from ..operators import phrases, tree
from ..operators.publish import Publication
from ..operators.retrieval import BlockIndex
from ..staging import scratch, staged
from ..streaming.carry import RESOLVED, carry_author


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- trees ------------------------------------------------------------------------------


def _page_nodes(spark, d):
    return tree.html_tree(_t(spark, d, "pages").select("page_id", "html"), "page_id", "html")


def page_tree(spark, d):
    """Every element of every page with its place in the tree."""
    return _page_nodes(spark, d)


def page_descendants(spark, d):
    """How often a tag stands anywhere below another, in each page."""
    nodes = staged(_page_nodes(spark, d).select("page_id", "node", "last", "tag"), "page_nodes")
    above = nodes.withColumnRenamed("tag", "ancestor_tag")
    pairs = tree.descendants(above, nodes, "page_id", ["ancestor_tag"], ["tag"])
    return pairs.groupBy("page_id", "ancestor_tag", "tag").agg(F.count("*").alias("n"))


def page_roots(spark, d):
    """Root and depth of every element, from the parent pointers alone."""
    nodes = _page_nodes(spark, d).select("page_id", "node", "parent")
    return tree.roots(nodes, ["page_id"], "node", "parent")


def region_tree(spark, d):
    """Nations below their regions, and customers and suppliers below their nations, as one parent table."""
    r, n, c, s = (_t(spark, d, x) for x in ("region", "nation", "customer", "supplier"))
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    rows = r.select(name("r", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"))
    rows = rows.unionByName(n.select(name("n", "n_nationkey").alias("node"), name("r", "n_regionkey").alias("parent")))
    rows = rows.unionByName(c.select(name("c", "c_custkey").alias("node"), name("n", "c_nationkey").alias("parent")))
    rows = rows.unionByName(s.select(name("s", "s_suppkey").alias("node"), name("n", "s_nationkey").alias("parent")))
    return tree.roots(rows, [], "node", "parent")


#: Tags, each with its place, its name and whether it opens, closes or is a leaf; then one step a tag, all pages at once.
_TREE_SQL = rf"""WITH RECURSIVE raw AS (
  SELECT page_id, unnest(a) AS t, unnest(range(len(a))) AS ord FROM (SELECT page_id, regexp_extract_all(html, '{tree.TOKEN}') AS a FROM pages WHERE html IS NOT NULL)
), tags AS MATERIALIZED (
  SELECT page_id, t, lower(regexp_extract(t, '{tree.NAME}', 1)) AS name, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS i FROM raw WHERE NOT starts_with(t, '<!')
), kinds AS MATERIALIZED (
  SELECT *, CASE WHEN starts_with(t, '</') THEN 'c' WHEN name IN ({", ".join(f"'{x}'" for x in tree.VOID)}) OR ends_with(t, '/>') OR position('>' IN t) < length(t) THEN 'l' ELSE 'o' END AS kind FROM tags
), walk AS (
  SELECT DISTINCT page_id, 0::BIGINT AS i, 0::BIGINT AS nodes, '' AS kind, NULL::BIGINT AS parent, 0::BIGINT AS depth, CAST([] AS STRUCT(n BIGINT, t VARCHAR)[]) AS stack FROM tags
  UNION ALL
  SELECT w.page_id, k.i, w.nodes + (k.kind <> 'c')::INT, k.kind, w.stack[-1].n, len(w.stack)::BIGINT, CASE k.kind
    WHEN 'o' THEN list_append(w.stack, {{'n': w.nodes, 't': k.name}})
    WHEN 'l' THEN w.stack
    ELSE list_slice(w.stack, 1, coalesce(list_max([p FOR p IN range(1, len(w.stack) + 1) IF w.stack[p].t = k.name]) - 1, len(w.stack))) END
  FROM walk w JOIN kinds k ON k.page_id = w.page_id AND k.i = w.i + 1
), made AS MATERIALIZED (
  SELECT page_id, i, nodes - 1 AS node, parent, depth, kind FROM walk WHERE kind IN ('o', 'l')
), shut AS (
  SELECT m.page_id, m.node, min(w.i) AS shut, min_by(w.nodes, w.i) - 1 AS last FROM made m JOIN walk w ON w.page_id = m.page_id AND w.i > m.i AND w.kind = 'c' AND len(w.stack) <= m.depth WHERE m.kind = 'o' GROUP BY ALL
), most AS (
  SELECT page_id, max(node) AS last FROM made GROUP BY page_id
), nodes AS MATERIALIZED (
  SELECT m.page_id, m.node::INT AS node, m.parent::INT AS parent, m.depth::INT AS depth, k.name AS tag, trim(regexp_extract(k.t, '^<[a-zA-Z][a-zA-Z0-9:-]*([^>]*?)[ \t\r\n\f]*/?>', 1), chr(9) || chr(10) || chr(12) || chr(13) || ' ') AS attributes,
    (CASE WHEN m.kind = 'l' THEN m.node ELSE coalesce(s.last, e.last) END)::INT AS last,
    (row_number() OVER (PARTITION BY m.page_id ORDER BY CASE WHEN m.kind = 'l' THEN m.i ELSE coalesce(s.shut, 9223372036854775807) END, m.depth DESC) - 1)::INT AS post
  FROM made m JOIN kinds k ON k.page_id = m.page_id AND k.i = m.i JOIN most e ON e.page_id = m.page_id LEFT JOIN shut s ON s.page_id = m.page_id AND s.node = m.node
)"""

TREE_SQL = {
    "page_tree": _TREE_SQL + " SELECT * FROM nodes",
    "page_descendants": _TREE_SQL + " SELECT a.page_id, a.tag AS ancestor_tag, b.tag, count(*) AS n FROM nodes a JOIN nodes b ON b.page_id = a.page_id AND b.node > a.node AND b.post < a.post GROUP BY ALL",
    "page_roots": _TREE_SQL + """, up AS (
      SELECT page_id, node, node AS root, 0::BIGINT AS depth FROM nodes WHERE parent IS NULL
      UNION ALL SELECT n.page_id, n.node, u.root, u.depth + 1 FROM nodes n JOIN up u ON u.page_id = n.page_id AND u.node = n.parent)
      SELECT * FROM up""",
    "region_tree": """WITH RECURSIVE p AS (
      SELECT 'r' || r_regionkey AS node, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
      UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
      up AS (SELECT node, node AS root, 0::BIGINT AS depth FROM p WHERE parent IS NULL UNION ALL SELECT p.node, u.root, u.depth + 1 FROM p JOIN up u ON u.node = p.parent)
      SELECT * FROM up""",
}

# -- phrases ----------------------------------------------------------------------------


def _benchmark_phrases(spark, d):
    """Whole items and their sentences of three words or more: (id, phrase)."""
    b = _t(spark, d, "benchmark").select("item_id", F.concat(F.array("text"), F.split("text", r"\. ")).alias("p"))
    each = b.select("item_id", F.posexplode("p").alias("i", "phrase"))
    return each.select((F.col("item_id") * 10_000 + F.col("i")).alias("id"), "phrase").where(F.size(phrases.words_of(F.col("phrase"))) >= 3)


def phrase_matches(spark, d):
    """The leftmost, longest phrases of the benchmark in whole documents."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return phrases.longest_matches(docs, "doc_id", "text", _benchmark_phrases(spark, d), "id", "phrase")


PHRASE_SQL = {
    "phrase_matches": rf"""WITH RECURSIVE words AS MATERIALIZED (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{phrases.WORD}') AS w FROM documents
    ), parts AS (
      SELECT item_id, unnest(list_prepend(text, string_split(text, '. '))) AS phrase, unnest(range(len(string_split(text, '. ')) + 1)) AS i FROM benchmark
    ), table_ AS MATERIALIZED (
      SELECT min(id) AS phrase, p FROM (SELECT item_id * 10000 + i AS id, regexp_extract_all(phrase, '{phrases.WORD}') AS p FROM parts) WHERE len(p) >= 3 GROUP BY p
    ), places AS (
      SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM words) WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), hits AS (
      SELECT a.doc_id, a.i AS start, max(len(t.p)) AS n, arg_max(t.phrase, len(t.p)) AS phrase FROM places a JOIN table_ t ON t.p[1] = a.w AND t.p[2] = a.w2 AND t.p[3] = a.w3 JOIN words d ON d.doc_id = a.doc_id
      WHERE list_slice(d.w, a.i + 1, a.i + len(t.p)) = t.p GROUP BY a.doc_id, a.i
    ), after AS MATERIALIZED (
      SELECT h.doc_id, h.start, any_value(h.n) AS n, any_value(h.phrase) AS phrase, min(o.start) AS next FROM hits h LEFT JOIN hits o ON o.doc_id = h.doc_id AND o.start >= h.start + h.n GROUP BY h.doc_id, h.start
    ), taken AS (
      SELECT a.* FROM after a JOIN (SELECT doc_id, min(start) AS start FROM after GROUP BY doc_id) f USING (doc_id, start)
      UNION ALL SELECT a.* FROM taken t JOIN after a ON a.doc_id = t.doc_id AND a.start = t.next
    ) SELECT doc_id, start, n::BIGINT AS n_words, phrase FROM taken""",
}


# -- streams and published tables -------------------------------------------------------

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
SLICES = 4


def stream_locf(spark, d):
    """The carry-forward of ``author_locf`` as a stream over time slices, its state kept by user."""
    e = _t(spark, d, "events")
    a = F.when(F.col("event_type") == "error", "ID.").when(F.col("event_type") == "view", "").otherwise(F.upper("event_type"))
    events = e.select("user_id", "ts", "event_id", a.alias("author"))
    folder = scratch(spark, "stream")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    if low is None:
        return spark.createDataFrame([], RESOLVED)
    part = F.least(F.floor((at - low) * SLICES / (high - low + 1)), F.lit(SLICES - 1))
    # A user's rows of a slice are in one file, and files come in the order of the slices.
    for i in range(SLICES):
        events.where(part == i).repartition("user_id").write.mode("append").parquet(f"{folder}/in")
    files = spark.read.parquet(f"{folder}/in").select("_metadata.file_path").distinct().count()
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, -(-files // SLICES))).parquet(f"{folder}/in")
        q = carry_author(raw).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start(f"{folder}/out")
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.schema(RESOLVED).parquet(f"{folder}/out")


def published_counts(spark, d):
    """Lines and orders counted, published as one version of two tables, and joined as read back."""
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    published = Publication(spark, scratch(spark, "published"))
    published.write({"orders": o.select("o_orderkey", "o_custkey"), "lines": li.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))})
    t = published.read()
    both = t["orders"].join(t["lines"], F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return both.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n_lines"))


MECHANISM_SQL = {
    "stream_locf": """WITH a AS (SELECT *, CASE event_type WHEN 'error' THEN 'ID.' WHEN 'view' THEN '' ELSE upper(event_type) END AS author FROM events),
      b AS (SELECT *, last_value(CASE WHEN author NOT IN ('', 'ID.') THEN author END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM a)
      SELECT event_id, author, CASE WHEN author = 'ID.' THEN coalesce(k, 'ID.') ELSE author END AS resolved_author FROM b""",
    "published_counts": """SELECT o_custkey, count(*) AS n_orders, sum(n)::BIGINT AS n_lines FROM (SELECT o_custkey, o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY o_custkey""",
}


# -- retrieval and markup -------------------------------------------------------------


def bm25_blockmax(spark, d):
    """The twenty best documents for two words, reading only the blocks that can hold one of them."""
    index = BlockIndex(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return index.top(["the", "idiot"], 20)[0]


def flat_emphasis(spark, d):
    """Pages with nested emphasis flattened and links unwrapped."""
    return _t(spark, d, "pages").select("page_id", straightened(F.col("html")).alias("html"))


def page_blocks(spark, d):
    """The elements directly below each page's body, read by a table function."""
    _t(spark, d, "pages").select("page_id", "html").createOrReplaceTempView("given_pages")
    spark.udtf.register("html_blocks", tree.HtmlBlocks)
    return spark.sql("SELECT p.page_id, b.node, b.tag, b.last FROM given_pages p, LATERAL html_blocks(p.html) b")


_STRESS = ", ".join(f"'{x}'" for x in EMPHASIS)

TEXT_SQL = {
    "flat_emphasis": rf"""WITH RECURSIVE raw AS (
      SELECT page_id, unnest(a) AS p, unnest(range(1, len(a) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<[^>]*>|[^<]+|<') AS a FROM pages WHERE html IS NOT NULL)
    ), named AS MATERIALIZED (
      SELECT *, lower(regexp_extract(p, '^</?([a-zA-Z][a-zA-Z0-9]*)[^>]*>$', 1)) AS name FROM raw
    ), marks AS MATERIALIZED (
      SELECT page_id, i, name, starts_with(p, '</') AS shut, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k FROM named WHERE name IN ({_STRESS})
    ), walk AS (
      SELECT DISTINCT page_id, 0::BIGINT AS k, 0::BIGINT AS i, false AS keep, CAST([] AS VARCHAR[]) AS open FROM marks
      UNION ALL
      SELECT w.page_id, m.k, m.i, CASE WHEN m.shut THEN coalesce(list_max([x FOR x IN range(1, len(w.open) + 1) IF w.open[x] = m.name]), 0) = 1 ELSE len(w.open) = 0 END,
        CASE WHEN m.shut THEN list_slice(w.open, 1, coalesce(list_max([x FOR x IN range(1, len(w.open) + 1) IF w.open[x] = m.name]) - 1, len(w.open))) ELSE list_append(w.open, m.name) END
      FROM walk w JOIN marks m ON m.page_id = w.page_id AND m.k = w.k + 1
    )
    SELECT p.page_id, CASE WHEN p.html IS NOT NULL THEN coalesce(f.html, '') END AS html FROM pages p LEFT JOIN (
      SELECT n.page_id, string_agg(n.p, '' ORDER BY n.i) AS html FROM named n LEFT JOIN walk w ON w.page_id = n.page_id AND w.i = n.i WHERE n.name <> '{LINK}' AND coalesce(w.keep, true) GROUP BY n.page_id) f USING (page_id)""",
    "page_blocks": _TREE_SQL + " SELECT n.page_id, n.node, n.tag, n.last FROM nodes n JOIN nodes b ON b.page_id = n.page_id AND b.node = n.parent WHERE b.tag = 'body'",
}


GIVEN = (page_tree, page_descendants, page_roots, region_tree, phrase_matches, stream_locf, published_counts, bm25_blockmax, flat_emphasis, page_blocks)

QUERIES = {f.__name__: f for f in GIVEN}
ORACLE_SQL = {**TREE_SQL, **PHRASE_SQL, **MECHANISM_SQL, **TEXT_SQL}
