"""Trees from tags, structural joins and recursion, against plain walks."""

import random

from lexiforge.operators import tree


def walk(html):
    """Nodes by a plain reading of the rules: (tag, parent, depth, last, post)."""
    import re

    out, stack, order = [], [], []

    def shut(to):
        while len(stack) > to:
            out[stack[-1]][3] = len(out) - 1
            order.append(stack.pop())

    for t in re.findall(tree.TOKEN, html):
        if t.startswith("<!"):
            continue
        name = re.match(r"</?([\w:-]+)", t).group(1).lower()
        if t.startswith("</"):
            at = [i for i, n in enumerate(stack) if out[n][0] == name]
            if at:
                shut(at[-1])
            continue
        out.append([name, stack[-1] if stack else None, len(stack), len(out), None])
        if name in tree.VOID or t.endswith("/>") or re.search(r"</(script|style)\s*>$", t.lower()):
            order.append(len(out) - 1)
        else:
            stack.append(len(out) - 1)
    shut(0)
    for i, n in enumerate(order):
        out[n][4] = i
    return [tuple(x) for x in out]


PIECES = ["<p>", "</p>", "<b class='x'>", "</b>", "<br>", "<img src=a />", "<div\n id=1 >", "</DIV>", "<i/>", "x < y > z", "<!-- <p> -->", "<!DOCTYPE html>", "<script>'<p>'</script>", "<style>p{}</style >", "<script", "</", "<1>", "<UL>", "</ul >", "text"]


def pages(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_stack_machine():
    for html in pages(3000):
        n, parent, depth, tag, attributes, last, post = tree.nodes_of(html)
        assert list(zip(tag, parent, depth, last, post, strict=True)) == walk(html), html
        assert n == list(range(len(n)))
    assert tree.nodes_of("<a href='x' /><B>")[4] == ["href='x'", ""]


def test_tree_rows_and_pairs(spark):
    rows = [(i, h, "n", {"a": 1}) for i, h in enumerate(pages(150, 2))] + [(900, None, "n", {}), (901, "", "n", {}), (None, "<p><b>", "n", {})]
    df = spark.createDataFrame(rows, "page_id long, html string, node string, m map<string,int>")
    nodes = tree.html_tree(df, "page_id", "html").cache()
    got = {}
    for r in nodes.collect():
        got.setdefault(r["page_id"], []).append((r["node"], r["tag"], r["parent"], r["depth"], r["last"], r["post"]))
    want = {i: [(n, *x) for n, x in enumerate(walk(h))] for i, h, *_ in rows if h and walk(h)}
    assert {k: sorted(v) for k, v in got.items()} == want
    below = {(i, a, n) for i, t in want.items() if i is not None for a, x in enumerate(t) for n in range(a + 1, x[4] + 1)}
    for width in (3, 1 << 16):
        pairs = tree.descendants(nodes.withColumnRenamed("tag", "up"), nodes, "page_id", ["up"], ["tag", "depth"], width).collect()
        assert len(pairs) == len(below) and {(r["page_id"], r["ancestor"], r["node"]) for r in pairs} == below
        assert all(r["up"] == want[r["page_id"]][r["ancestor"]][1] and r["tag"] == want[r["page_id"]][r["node"]][1] for r in pairs)
    plan = tree.descendants(nodes, nodes, "page_id", [], [])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_roots_of_deep_wide_and_circular_tables(spark):
    rows = [("k", f"d{i}", f"d{i - 1}" if i else None) for i in range(300)]
    rows += [("k", f"w{i}", "hub") for i in range(500)] + [("k", "hub", "d3"), ("k", "orphan", "nowhere"), ("k", "hub", "d3")]
    rows += [("k", "c0", "c2"), ("k", "c1", "c0"), ("k", "c2", "c1"), ("k", "tail", "c0"), ("k", "self", "self"), ("k", None, "d1"), (None, "d1", None), (None, "d9", "d1")]
    df = spark.createDataFrame(rows, "key string, node string, parent string")
    got = {(r["key"], r["node"]): (r["root"], r["depth"]) for r in tree.roots(df, ["key"], "node", "parent").collect()}
    want = {("k", f"d{i}"): ("d0", i) for i in range(300)} | {("k", f"w{i}"): ("d0", 5) for i in range(500)}
    want |= {("k", "hub"): ("d0", 4), ("k", "orphan"): ("orphan", 0), (None, "d1"): ("d1", 0), (None, "d9"): ("d1", 1)}
    want |= {("k", x): (None, None) for x in ("c0", "c1", "c2", "tail", "self")}
    assert got == want
    assert tree.roots(df.limit(0), [], "node", "parent").count() == 0


def test_several_parents(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1), (3, 2), (4, 3), (4, 1)], "node int, parent int")
    got = sorted(tuple(r) for r in tree.roots(df, [], "node", "parent").collect())
    assert got == [(1, 1, 0), (2, 2, 0), (3, 1, 1), (3, 2, 1), (4, 1, 1), (4, 1, 2), (4, 2, 2)]


def test_table_functions_agree(spark):
    df = spark.createDataFrame([(i, "<body>" + h) for i, h in enumerate(pages(60, 5))] + [(70, None), (71, "<p>")], "id long, html string")
    df.createOrReplaceTempView("block_pages")
    spark.udtf.register("html_blocks", tree.HtmlBlocks)
    spark.udtf.register("html_block_table", tree.HtmlBlockTable)
    one = spark.sql("SELECT p.id, b.* FROM block_pages p, LATERAL html_blocks(p.html) b")
    two = spark.sql("SELECT * FROM html_block_table(TABLE(SELECT id, html FROM block_pages))")
    nodes = tree.html_tree(df, "id", "html")
    up = nodes.where("tag = 'body'").selectExpr("id", "node as parent")
    want = nodes.join(up, ["id", "parent"]).select("id", "node", "tag", "last")
    told = lambda d: sorted(tuple(r) for r in d.collect())
    assert told(one) == told(two) == told(want) and one.count() > 60
