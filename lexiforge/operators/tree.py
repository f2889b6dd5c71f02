"""Trees: nodes from a tag stream, ancestors joined to descendants, and recursion to a fixpoint.

``html_tree`` reads tags with a stack, once through each text:

* an opening tag is a node below the innermost open one; numbers ``node`` (preorder) and
  ``post`` (postorder) count from 0 in each text, and ``last`` is the greatest number below
  a node, so ``[node, last]`` is its interval;
* void elements, ``<x/>`` and ``script`` or ``style`` with what is in them are leaves;
* a closing tag closes the innermost open node of its name and all that stand open in it;
  one without such a node is passed over; what is open in the end closes there;
* comments and declarations are no nodes; a tag ends at the next ``>``.

A null text and a text without tags have no nodes.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged

_SPACE = r"[ \t\r\n\f]"
_RAW = "|".join(rf"<{x}(?:[ \t\r\n\f/][^>]*)?>.*?</{x}{_SPACE}*>" for x in ("[sS][cC][rR][iI][pP][tT]", "[sS][tT][yY][lL][eE]"))
#: A comment, a script or style element, or a tag.
TOKEN = rf"(?s)<!--.*?-->|{_RAW}|</?[a-zA-Z][^>]*>"
NAME = "^</?([a-zA-Z][a-zA-Z0-9:-]*)"
#: Elements that have no closing tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

_token, _name = re.compile(TOKEN), re.compile(NAME)
_attributes = re.compile(rf"<[a-zA-Z][a-zA-Z0-9:-]*([^>]*?){_SPACE}*/?>")
NODE = "node int, parent int, depth int, tag string, attributes string, last int, post int"


def nodes_of(html: str) -> list[list]:
    """The columns of ``NODE`` for one text."""
    parent, depth, tag, attributes, last, post = ([] for _ in range(6))
    stack: list[int] = []
    open_: dict[str, int] = {}
    closed = 0
    for m in _token.finditer(html):
        t = m.group()
        if t[1] == "!":
            continue
        name = _name.match(t).group(1).lower()
        if t[1] == "/":
            while open_.get(name):
                top = stack.pop()
                open_[tag[top]] -= 1
                last[top], post[top] = len(tag) - 1, closed
                closed += 1
                if tag[top] == name:
                    break
            continue
        node = len(tag)
        parent.append(stack[-1] if stack else None)
        depth.append(len(stack))
        tag.append(name)
        attributes.append(_attributes.match(t).group(1).strip(" \t\r\n\f"))
        last.append(node)
        if name in VOID or t.endswith("/>") or t.find(">") < len(t) - 1:
            post.append(closed)
            closed += 1
        else:
            post.append(-1)
            stack.append(node)
            open_[name] = open_.get(name, 0) + 1
    while stack:
        top = stack.pop()
        last[top], post[top] = len(tag) - 1, closed
        closed += 1
    return [list(range(len(tag))), parent, depth, tag, attributes, last, post]


def html_tree(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, node, parent, depth, tag, attributes, last, post) of every node of every text; ``key`` should tell rows apart."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in NODE.split(", ")]

    def read(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                made = nodes_of(text) if text else [[]]
                if made[0]:
                    own = batch.column(0).take(pa.array([i] * len(made[0])))
                    yield pa.RecordBatch.from_arrays([own, *[pa.array(x, k) for x, k in zip(made, kinds, strict=True)]], [key, *names])

    return df.select(key, F.col(html).alias("__html")).mapInArrow(read, f"`{key}` {dict(df.dtypes)[key]}, {NODE}")


def body_blocks(html: str | None):
    """(node, tag, last) of the elements directly below a text's ``body``; none for a null text or one without a body."""
    node, parent, _, tag, _, last, _ = nodes_of(html or "")
    return [(i, tag[i], last[i]) for i in node if parent[i] is not None and tag[parent[i]] == "body"]


@F.udtf(returnType="node int, tag string, last int", useArrow=False)
class HtmlBlocks:
    """The blocks of one text, for a lateral join: Spark joins Arrow table functions to whole tables only."""

    def eval(self, html: str):
        yield from body_blocks(html)


@F.arrow_udtf(returnType="key long, node int, tag string, last int")
class HtmlBlockTable:
    """The blocks of all texts of a table argument (key, html), a batch at a time."""

    def eval(self, table: pa.RecordBatch):
        key, html = (table.column(i).to_pylist() for i in range(2))
        rows = [(k, *x) for k, text in zip(key, html, strict=True) for x in body_blocks(text)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.table({n: pa.array(x, t) for n, x, t in zip(("key", "node", "tag", "last"), columns, (pa.int64(), pa.int32(), pa.string(), pa.int32()), strict=True)})


# -- structural join --------------------------------------------------------------------

#: Nodes of one tree that a task takes at a time.
WIDTH = 1 << 16


def descendants(ancestors: DataFrame, below: DataFrame, key: str, keep: list[str], kept: list[str], width: int = WIDTH) -> DataFrame:
    """Pairs of an ancestor and a node below it, as (key, ancestor, node, keep..., kept...).

    Both sides hold ``key`` and ``node``, the ancestors ``last`` too; ``keep`` names more
    columns of the ancestors, ``kept`` of the nodes. Both are dealt by (key, ``width`` numbers
    of the tree), an ancestor to each portion that its interval meets, and sorted by number;
    one pass keeps the ancestors that are open on a stack. So a tree of any size is shared
    by many tasks, a task holds no more than a path, and the work is that of the pairs.
    A row without a key or number is in no pair; repeated rows are paired as often as they occur.
    """
    ends = F.sequence(F.floor(F.col("node") / width), F.floor(F.col("last") / width))
    a = ancestors.where(F.col("last") > F.col("node")).select(F.col(key).alias("key"), F.explode(ends).alias("portion"), F.col("node").cast("long"), F.lit(0).alias("side"), F.col("last").cast("long"), F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("a"), F.lit(None).alias("b"))
    b = below.where(F.col("node").isNotNull()).select(F.col(key).alias("key"), F.floor(F.col("node") / width).alias("portion"), F.col("node").cast("long"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("last"), F.lit(None).alias("a"), F.struct(*[F.col(c) for c in kept] or [F.lit(0)]).alias("b"))
    types = {**dict(a.dtypes), "b": dict(b.dtypes)["b"]}
    both = a.withColumn("b", F.col("b").cast(types["b"])).unionByName(b.withColumn("a", F.col("a").cast(types["a"])))
    # At one number the node comes first: it is not below itself.
    dealt = both.where(F.col("key").isNotNull()).repartition("key", "portion").sortWithinPartitions("key", "portion", "node", F.desc("side"))

    def walk(batches):
        key_type = struct_a = struct_b = None
        at, stack = None, []  # the open ancestors: (last, node, columns)
        for batch in batches:
            keys, portions, nodes, sides, lasts, left, right = (batch.column(i) for i in range(7))
            key_type, struct_a, struct_b = keys.type, left.type, right.type
            left, out = left.to_pylist(), [[], [], []]
            rows = zip(keys.to_pylist(), portions.to_pylist(), nodes.to_pylist(), sides.to_pylist(), lasts.to_pylist(), strict=True)
            for i, (k, p, node, side, last) in enumerate(rows):
                if at != (k, p):
                    at, stack = (k, p), []
                while stack and stack[-1][0] < node:
                    stack.pop()
                if side == 0:
                    stack.append((last, node, left[i]))
                    continue
                for _, above, columns in stack:
                    out[0].append(above)
                    out[1].append(i)
                    out[2].append(columns)
                if len(out[0]) >= 1 << 16:
                    yield pairs(keys, nodes, right, out, struct_a)
                    out = [[], [], []]
            if out[0]:
                yield pairs(keys, nodes, right, out, struct_a)

    def pairs(keys, nodes, right, out, struct_a):
        i = pa.array(out[1])
        return pa.RecordBatch.from_arrays([keys.take(i), pa.array(out[0], pa.int64()), nodes.take(i), pa.array(out[2], struct_a), right.take(i)], ["key", "ancestor", "node", "a", "b"])

    made = dealt.mapInArrow(walk, f"key {types['key']}, ancestor long, node long, a {types['a']}, b {types['b']}")
    return made.select(F.col("key").alias(key), "ancestor", "node", *[F.col(f"a.`{c}`").alias(c) for c in keep], *[F.col(f"b.`{c}`").alias(c) for c in kept])


# -- recursion --------------------------------------------------------------------------


def roots(df: DataFrame, keys: list[str], node: str, parent: str) -> DataFrame:
    """(keys, node, root, depth) of each node of a parent table, by pointer doubling.

    A round replaces every open pointer by its target's pointer and adds the lengths, so
    rounds grow with the logarithm of the depth. Only open rows are joined; what has reached
    a root is put aside. Each round is a staged table, and the loop ends when no pointer is
    open or, after as many rounds as could cover every node, when what is left runs in
    circles. Many nodes below one parent share a join key of the pointers' side alone, which
    adaptive execution splits.

    Defined cases: a node whose parent is null is its own root at depth 0; so is one whose
    parent is not among the nodes; a node on a circle, or below one, has neither root nor
    depth (null); a null node is left out; repeated rows of one node with one parent count
    once; a node with several parents has a row for each root and length.
    """
    base = df.where(F.col(node).isNotNull()).select(*keys, F.col(node).alias("node"), F.col(parent).alias("up")).distinct()
    same = F.col("up") == F.col("__node")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("__" + k))
    known = base.select(*[F.col(k).alias("__" + k) for k in keys], F.col("node").alias("__node")).distinct()
    base = staged(base.join(known, same, "left").select(*keys, "node", F.col("__node").alias("up"), F.lit(1).cast("long").alias("steps")), "parents")
    total, made, ended, rounds = base.count(), [base], [], 0
    now = base.where("up is not null")
    while not now.isEmpty() and (1 << rounds) <= 2 * total:
        rounds += 1
        # Pointers that have ended stay targets; a target without a pointer is a root.
        pointers = now.withColumn("final", F.lit(False))
        for d in ended:
            pointers = pointers.unionByName(d.withColumn("final", F.lit(True)))
        target = pointers.select(*[F.col(k).alias("__" + k) for k in keys], F.col("node").alias("__node"), F.col("up").alias("__up"), F.col("steps").alias("__steps"), F.col("final").alias("__final"))
        step = now.join(target, same, "left").select(
            *keys, "node", F.coalesce("__up", "up").alias("up"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"), F.coalesce("__final", F.lit(True)).alias("final")
        )
        made.append(staged(step.distinct(), "pointers"))
        ended.append(made[-1].where("final").drop("final"))
        now = made[-1].where("not final").drop("final")
    out = base.where("up is null").select(*keys, "node", F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"))
    for d in ended:
        out = out.unionByName(d.select(*keys, "node", F.col("up").alias("root"), F.col("steps").alias("depth")))
    lost = now.select(*keys, "node").distinct().withColumns({"root": F.lit(None).cast(dict(out.dtypes)["root"]), "depth": F.lit(None).cast("long")})
    out = staged(out.unionByName(lost), "roots")
    for d in made:
        discard(d)
    return out.withColumnRenamed("node", node)
