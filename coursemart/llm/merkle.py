"""Merkle manifest of a dataset by cogrouped subtree exchange, with a membership proof for every row.

Every row is a leaf; the leaves of a source in order of their ids form a tree of runs of FANOUT, the sources' roots in
order form another one, whose root names the dataset. Positions come from a range sort (rows numbered within their range,
ranges counted), so a source that holds a third of all rows is spread over many ranges.

The tree is worked in superblocks of FANOUT ^ levels consecutive nodes. Upwards, each superblock is reduced
to its node, and these nodes are the next layer, until one is left. Downwards, the nodes on the way to the root that a
superblock lacks (its *outer* nodes: the siblings at every level above it) come from the layer above, and leaves and
outer nodes are cogrouped by superblock in ``applyInPandas``, which reduces the block, joins both parts of each proof and
folds them. A superblock is the largest thing that one task holds; a layer has FANOUT ^ levels times fewer nodes than
the one below, and no layer is collected.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.llm.common import ascii_lower, cut, fold
from coursemart.llm.lines import _small

FANOUT = 16
LEVELS = 3                     # of a superblock: 4,096 nodes

PATH = "array<struct<left:string,right:string>>"


def coded(c: Column) -> Column:
    """A value in a leaf: '-' if null, else its UTF-8 byte count, ':' and the value (integers in decimal)."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*[coded(c) for c in columns]), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def depth(n: int) -> int:
    """Levels until one of ``n`` nodes remains."""
    d = 0
    while n > 1:
        n, d = -(-n // FANOUT), d + 1
    return d


def layers(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and what they become in ``levels`` levels."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest("".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        out.append(nodes)
    return out


def way_up(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Siblings of node ``i`` at each level of its superblock: those left of it and those right of it."""
    out = []
    for level in tree[:-1]:
        a = i - i % FANOUT
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + FANOUT])))
        i //= FANOUT
    return out


def folded(leaf: str, path) -> str:
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {FANOUT ** levels}"))


def block_layers(block: pd.DataFrame, levels: int) -> list[list[str]]:
    """The tree of one superblock (its rows sorted by place): all levels that its layer has left, at most ``levels``."""
    return layers(block["node"].tolist(), min(levels, depth(int(block["size"].iloc[0]))))


# ------------------------------------------------------------------ positions

def numbered(rows: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0 in each tree, by ``order``) and ``size`` (nodes of the tree).

    Rows are dealt into ranges of (tree, order); the last word is the row's own place in the input, so equal rows can be
    parted as well. Rows of a range are numbered as they are written; ranges before it are counted."""
    spread = rows.withColumn("nth", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*tree, *order, "nth").sortWithinPartitions(*tree, *order, "nth").drop("nth")
    held = cut(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-nodes")
    part = F.shiftright("at", 33)
    counts = held.groupBy(*tree, part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    w = Window.partitionBy(*tree).orderBy("part")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = cut(counts.select(*tree, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(*tree)).alias("size")),
                 "merkle-ranges")
    r = _small(ranges, 96).withColumnsRenamed({t: f"_{t}" for t in tree})
    same = [F.col(t).eqNullSafe(F.col(f"_{t}")) for t in tree]
    on = part == r["part"]
    for s in same:
        on = on & s
    return held.join(r, on).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift", *[f"_{t}" for t in tree])


# ------------------------------------------------------------------ up and down

def reduce_up(nodes: DataFrame, trees: list[str], levels: int) -> list[DataFrame]:
    """The layers of all trees: ``nodes`` (trees, place, size, node) and the written ones above it; the last one
    has one node in each tree."""
    out = [nodes]
    schema = nodes.select(*trees, "place", "size", "node").schema

    def up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        top = pdf.head(1).copy()
        top["node"] = block_layers(pdf, levels)[-1][0]
        top["place"], top["size"] = top["place"] // FANOUT ** levels, -(-top["size"] // FANOUT ** levels)
        return top[[*trees, "place", "size", "node"]]

    while not out[-1].filter("size > 1").isEmpty():
        blocks = in_blocks(out[-1].select(*trees, "place", "size", "node"), levels)
        out.append(cut(blocks.groupBy(*trees, "block").applyInPandas(up, schema), "merkle-layer"))
    return out


def outer_nodes(found: list[DataFrame], trees: list[str], top: DataFrame, levels: int) -> DataFrame:
    """(trees, block, path, subroot, root): the siblings above each superblock of the lowest layer. ``top``: trees, path,
    subroot, root of each whole tree."""
    known = top.withColumn("block", F.lit(0).cast("long"))
    schema = ", ".join([*[f"{t} string" for t in trees], "block long", f"path {PATH}", "subroot string", "root string"])

    def down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes):
            return pd.DataFrame({c: [] for c in [*trees, "block", "path", "subroot", "root"]})
        nodes = nodes.sort_values("place")
        tree = block_layers(nodes, levels)
        above = [(s["left"], s["right"]) for s in outer["path"].iloc[0]]
        out = nodes[[*trees]].copy()
        out["block"] = nodes["place"]
        out["path"] = [[{"left": a, "right": b} for a, b in way_up(tree, i) + above] for i in range(len(nodes))]
        out["subroot"], out["root"] = outer["subroot"].iloc[0], outer["root"].iloc[0]
        return out

    for layer in reversed(found[1:-1] if len(found) > 1 else []):
        known = cut(in_blocks(layer, levels).groupBy(*trees, "block").cogroup(known.groupBy(*trees, "block")).applyInPandas(down, schema), "merkle-outer")
    return known


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", value_cols: tuple[str, ...] = ("source", "lang", "n_chars", "text"),
             text_col: str = "text", tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    A leaf is the sha256 of the id and ``value_cols``, each '-' if null, else byte count, ':' and value. The leaves of a
    source (null is one of its own, the first; the empty text another) ascend by id, a null id first, rows of equal id by
    their leaf; equal rows are leaves of their own, and get the same values but for the proofs. Runs of FANOUT become the hash of
    their nodes until one is left (a lone leaf is its own root); the sources' roots, ordered by source, likewise. The proof is
    the hash of all siblings, level by level from the leaf to the root, left to right; that of a lone row is the hash of nothing.
    Where ``tampered`` (over the id) holds, the text that is checked has its A-Z lower-cased (a null stays null); ``folded_root`` is
    folded from that row's leaf and the original siblings, ``verified`` says whether it is the root. Texts may be of any
    length; they are hashed where they are read and not shuffled. ``levels`` is the height of a superblock. An empty table gives an empty one; other columns are not read."""
    columns = [F.col(id_col), *[F.col(c) for c in value_cols]]
    changed = [ascii_lower(F.col(c)) if c == text_col else F.col(c) for c in value_cols]
    hit = F.coalesce(tampered if tampered is not None else F.lit(False), F.lit(False))
    own = leaf_hash(*columns)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("source"), own.alias("node"),
                       F.when(hit, leaf_hash(F.col(id_col), *changed)).alias("shown"))
    leaves = numbered(rows, ["source"], ["doc_id", "node"])
    found = reduce_up(cut(leaves.select("source", "place", "size", "node", "doc_id", "shown"), "merkle-leaves"), ["source"], levels)

    # the tree over the sources: its one group is the constant "all"; a source's place there is its block of one node
    roots = found[-1].select(F.lit("all").alias("all"), "source", F.col("node"))
    sources = numbered(roots, ["all"], ["source"])
    above = reduce_up(cut(sources.select("all", "place", "size", "node", "source"), "merkle-sources"), ["all"], levels)
    whole = above[-1].select("all", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    top = finish(above[0], outer_nodes(above, ["all"], whole, levels), ["all"], ["source"], levels, paths=True)
    top = cut(top, "merkle-tops")
    out = finish(found[0], outer_nodes(found, ["source"], top, levels), ["source"], ["doc_id", "shown"], levels, paths=False)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def finish(nodes: DataFrame, outer: DataFrame, trees: list[str], extra: list[str], levels: int, paths: bool) -> DataFrame:
    """Nodes and outer nodes cogrouped by superblock. With ``paths`` one row per node with its own way to the root
    (``extra``, path, subroot, root); else the leaves' manifest rows."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({c: [] for c in names})
        block = block.sort_values("place")
        tree = block_layers(block, levels)
        over = [(s["left"], s["right"]) for s in above["path"].iloc[0]]
        over_text = "".join(a + b for a, b in over)
        rows, root, subroot = [], above["root"].iloc[0], above["subroot"].iloc[0]
        for i, r in enumerate(block.itertuples(index=False)):
            own = way_up(tree, i)
            if paths:
                rows.append((r.source, [{"left": a, "right": b} for a, b in own + over], r.node, root))
            else:
                proof = digest("".join(a + b for a, b in own) + over_text)
                shown = r.shown if isinstance(r.shown, str) else r.node
                rows.append((r.doc_id, r.node, subroot, root, proof, folded(shown, own + over)))
        return pd.DataFrame(rows, columns=names)

    if paths:
        names, schema = ["source", "path", "subroot", "root"], f"source string, path {PATH}, subroot string, root string"
    else:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    blocks = in_blocks(nodes.select(*trees, "place", "size", "node", *extra), levels)
    return blocks.groupBy(*trees, "block").cogroup(outer.groupBy(*trees, "block")).applyInPandas(join, schema)


def tampered_rows(id_col: str = "doc_id") -> Column:
    """Every fifth row, by crc32 of the decimal id."""
    return fold(id_col, 5) == 0


def oracle(levels: int = 6, upper: int = 3) -> str:
    """DuckDB SQL for ``manifest`` over documents (16 ^ levels rows a source and 16 ^ upper sources at most)."""
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(length({0})), "
           "lambda i: list_transform(range(8), lambda b: ((ascii({0}[(i + 1)::int]) >> b) & 1)::bigint)))), "
           "lambda s, b: xor(s >> 1, case when (s & 1) <> b then 3988292384::bigint else 0::bigint end)), 4294967295::bigint)")

    def enc(c):
        return f"case when {c} is null then '-' else strlen({c}::varchar)::varchar || ':' || {c}::varchar end"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = "sha256(" + " || ".join(enc(c) for c in ["doc_id", "source", "lang", "n_chars"]) + " || {})"
    sql = [f"""with raw as (select doc_id, source, {leaf.format(enc('text'))} leaf, {leaf.format(enc(lower))} bent,
       {crc.format("coalesce(doc_id::varchar, '')")} % 5 = 0 hit from documents),
a as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by source) n from raw),
l0 as (select source g, i, n, leaf h from a)"""]

    def up(p, k):
        sql.append(f"""{p}{k + 1} as (select g, i // 16 i, max((n + 15) // 16) n,
       case when max(n) = 1 then max(h) else sha256(string_agg(h, '' order by i)) end h from {p}{k} group by g, i // 16)""")

    for k in range(levels):
        up("l", k)
    sql.append(f"tops as (select g source, h, row_number() over (order by g nulls first) - 1 i, count(*) over () n from l{levels})")
    sql.append("u0 as (select 0 g, i, n, h from tops)")
    for k in range(upper):
        up("u", k)
    steps = []
    for p, first, count in (("l", "a.i", levels), ("u", "t.i", upper)):
        for k in range(count):
            div = 16 ** k
            grp = "x.g is not distinct from a.source" if p == "l" else "true"
            run = f"x.i // 16 = ({first} // {div}) // 16"
            for side, cmp in (("lo", "<"), ("hi", ">")):
                steps.append((f"{p}{k}{side}", f"coalesce((select string_agg(x.h, '' order by x.i) from {p}{k} x where {grp} and {run} "
                              f"and x.i {cmp} {first} // {div}), '')"))
            steps.append((f"{p}{k}one", f"(select max(x.n) = 1 from {p}{k} x where {grp})"))
    sql.append("w as (select a.*, t.h subroot, " + ", ".join(f"{e} {n}" for n, e in steps) + " from a join tops t on a.source is not distinct from t.source)")
    prev, names = "w", []
    sql.append("f0 as (select *, case when hit then bent else leaf end fold from w)")
    prev = "f0"
    for n, (p, k) in enumerate([("l", k) for k in range(levels)] + [("u", k) for k in range(upper)]):
        sql.append(f"f{n + 1} as (select * replace (case when {p}{k}one then fold else sha256({p}{k}lo || fold || {p}{k}hi) end as fold) from {prev})")
        prev = f"f{n + 1}"
        names += [f"{p}{k}lo", f"{p}{k}hi"]
    return ",\n".join(sql) + f"""
select doc_id, leaf, subroot, (select h from u{upper}) root, sha256({' || '.join(names)}) proof_sha256, fold folded_root,
       fold = (select h from u{upper}) verified from {prev}"""


ORACLE = oracle()
