"""Connected components by joins: nothing but narrow id tables, and nothing collected but counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tileweave.functions.shared import cut, drop


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b), any direction, loops and repeats allowed -> (node, component): the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label of that label (pointer jumping), so a
    chain of length n needs about log n rounds. A node with very many links is only a skewed join key, which the
    adaptive planner splits; the minima combine before they are shuffled. Rows with a null end are ignored.
    Empty edges give an empty result.
    """
    e = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = cut(e.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(e.select("b", "a")).distinct())
    now = cut(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = both.join(now.select(F.col("node").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        step = now.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = now.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = cut(step.join(jump, "label", "left").select("node", "was", F.coalesce("up", "label").alias("label")))
        changed = new.where("was <> label").limit(1).count()
        drop(now)
        if not changed:
            drop(both)
            return new.select("node", F.col("label").alias("component"))
        now = new


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of 0 to n - 1 the smallest number reachable by edges a[k], b[k]: for the edges within one bounded block."""
    low = np.arange(n)
    while True:
        ra, rb = low[a], low[b]
        apart = ra != rb
        if not apart.any():
            return low
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(low, np.maximum(ra, rb), np.minimum(ra, rb))
        while (low[low] != low).any():
            low = low[low]


def linked(nodes: DataFrame, edges: DataFrame, id_col: str) -> DataFrame:
    """nodes with component: that of connected_components, or the node itself where it has no link."""
    found = connected_components(edges).select(F.col("node").alias(id_col), "component")
    return nodes.join(found, id_col, "left").withColumn("component", F.coalesce("component", id_col))


def follow(links: DataFrame, **weights: str) -> DataFrame:
    """links (node, next or null, columns of weights) -> (node, last, steps, low, weights): what lies from each node on.

    By pointer doubling: a node's pointer jumps to where the pointer there leads, so a chain of n nodes takes about log2(n)
    rounds of one join on narrow rows. last: the end of its chain; steps: nodes up to there, itself included; each weight is
    'sum' or 'xor' over those nodes. Nodes on cycles, and those that lead into one, have last null; on a cycle, low is the
    cycle's smallest node. next must be a node of links, and node unique. The result is a table cut off from its lineage.
    """
    names = list(weights)
    now = cut(links.select("node", F.col("next").alias("ptr"), F.when(F.col("next").isNull(), F.col("node")).alias("last"), F.lit(1).cast("long").alias("steps"), F.col("node").alias("low"), *names, F.lit(True).alias("moved")))
    left = moved = now.where("ptr is not null").limit(1).count()
    while left and moved:
        there = now.select(F.col("node").alias("ptr"), F.col("ptr").alias("t_ptr"), *[F.col(c).alias(f"t_{c}") for c in ("last", "steps", "low", *names)])
        both = {c: F.col(c) + F.col(f"t_{c}") if kind == "sum" else F.col(c).bitwiseXOR(F.col(f"t_{c}")) for c, kind in weights.items()}
        low = F.least("low", "t_low")
        # a pointer has moved where it met an end or a smaller node; when none has, all that is left runs in cycles
        step = now.where("ptr is not null").join(there, "ptr").select("node", F.col("t_ptr").alias("ptr"), F.col("t_last").alias("last"), (F.col("steps") + F.col("t_steps")).alias("steps"), low.alias("low"), *[both[c].alias(c) for c in names], (F.col("t_ptr").isNull() | (low < F.col("low"))).alias("moved"))
        new = cut(now.where("ptr is null").withColumn("moved", F.lit(False)).select(*step.columns).unionByName(step))
        drop(now)
        now = new
        left, moved = now.agg(F.count_if(F.col("ptr").isNotNull()), F.count_if("moved")).first()
    return now.select("node", "last", "steps", "low", *names)


def rank_cycles(links: DataFrame) -> DataFrame:
    """links (node, next), each node on a cycle -> (node, cycle, pos): the cycle's smallest node, and the place from there on."""
    found = follow(links)
    held = cut(links.join(found.select("node", F.col("low").alias("cycle")), "node"))
    # back from each node to its cycle's smallest one, which has nothing before it
    back = held.select(F.col("next").alias("node"), F.when(F.col("next") != F.col("cycle"), F.col("node")).alias("next"), "cycle")
    return follow(back).join(back.select("node", "cycle"), "node").select("node", "cycle", (F.col("steps") - 1).alias("pos"))


def spanning_forest(edges: DataFrame) -> DataFrame:
    """edges (e: unique number, a, b) -> (e): edges that join all that is joined, without a cycle.

    In each round every component takes its edge of the smallest number; the components that so hang together become one, found
    by pointer doubling. At least half of the components that have edges go in each round; of edges between the same two
    components the smallest stays.
    """
    live = cut(edges.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("e").alias("e")))
    taken = None
    while live.limit(1).count():
        ends = live.select("e", F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("s")).select("e", "s.*")
        best = cut(ends.groupBy("node").agg(F.min(F.struct("e", "to")).alias("m")).select("node", "m.e", "m.to"))
        now = best.select("e").distinct()
        held = cut(now if taken is None else taken.union(now))
        # two components that take one edge point at each other: the smaller is the root
        mutual = best.select(F.col("node").alias("to"), F.col("e").alias("e2"))
        links = best.join(mutual, "to").select("node", F.when((F.col("e") == F.col("e2")) & (F.col("node") < F.col("to")), F.lit(None)).otherwise(F.col("to")).alias("next"))
        root = follow(links).select("node", F.col("last").alias("root"))
        ra, rb = (root.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        moved = live.join(ra, "a").join(rb, "b").where("ra <> rb")
        new = cut(moved.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("e").alias("e")))
        for old in (live, best, *([taken] if taken is not None else [])):
            drop(old)
        live, taken = new, held
    return edges.select("e").where("false") if taken is None else taken


def _tour(halves: DataFrame, salts: int = 16) -> DataFrame:
    """halves (node: number of the directed edge, at: where it begins) with next in a circle around each `at`: (node, turn).

    The circle goes through `salts` groups for each place, so that a place of very many edges is ordered by several tasks.
    """
    h = halves.select("node", "at", F.pmod(F.xxhash64("node"), F.lit(salts)).alias("g"))
    inner = h.withColumn("turn", F.lead("node").over(W.partitionBy("at", "g").orderBy("node")))
    groups = h.groupBy("at", "g").agg(F.min("node").alias("first"))
    w = W.partitionBy("at").orderBy("g")
    after = groups.select("at", "g", F.coalesce(F.lead("first").over(w), F.first("first").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("next_first"))
    return inner.join(after, ["at", "g"]).select("node", "at", F.coalesce("turn", "next_first").alias("turn"))


#: Rows of links that one task finishes.
FEW = 400_000


def _around(table: pa.Table) -> pa.Table:
    """Rows (node, next, tag) of whole cycles, a bounded number -> (node, x), as in potentials."""
    node, following, x = (table.column(c).to_numpy() for c in ("node", "next", "tag"))
    order = np.argsort(node)
    node, x = node[order], x[order].copy()
    at = np.searchsorted(node, following[order])
    here = np.arange(len(node))
    low, to = here, at
    for _ in range(len(node).bit_length()):
        low, to = np.minimum(low, low[to]), to[to]
    # what comes after a cycle's smallest node counts as nothing
    first = low == here
    x[first], to = 0, np.where(first, here, at)
    for _ in range(len(node).bit_length()):
        x, to = x ^ np.where(to == here, 0, x[to]), to[to]
    return pa.table({"node": node, "x": x})


def potentials(links: DataFrame, few: int = FEW) -> DataFrame:
    """links (node, next, tag), nodes on cycles, each cycle's tags cancelling out -> (node, x) with x = tag xor the next node's x.

    In each round the nodes whose coin (a hash) is 1 while the next node's is 0 are left out and their tags go to the node before: a
    quarter, so that all rounds together shuffle a few times the rows, not each row in each round. When at most `few` are left they
    are finished in one task, and the nodes left out take x from their next ones, last round first. x is 0 at one node of each cycle.
    """
    coin = lambda c, k: F.pmod(F.xxhash64(F.lit(k), c), F.lit(2)) == 1
    out = lambda k: coin("node", k) & ~coin("next", k)
    levels = [cut(links.select("node", "next", "tag"))]
    while levels[-1].where("node <> next").count() > few:
        k, now = len(levels), levels[-1].where("node <> next")
        gone = now.where(out(k)).select(F.col("node").alias("next"), F.col("next").alias("after"), F.col("tag").alias("more"))
        stay = now.where(~out(k))
        met = stay.where(coin("next", k)).join(gone, "next", "left").select("node", F.coalesce("after", "next").alias("next"), F.col("tag").bitwiseXOR(F.coalesce("more", F.lit(0).cast("long"))).alias("tag"))
        levels.append(cut(stay.where(~coin("next", k)).unionByName(met)))
    alone = lambda level: level.where("node = next").select("node", F.lit(0).cast("long").alias("x"))
    last = levels[-1]
    known = cut(last.where("node <> next").groupBy(F.pmod("node", F.lit(1)).alias("all")).applyInArrow(_around, "node long, x long").unionByName(alone(last)))
    for k in range(len(levels) - 1, 0, -1):
        gone = levels[k - 1].where("node <> next").where(out(k))
        late = gone.join(known.select(F.col("node").alias("next"), "x"), "next").select("node", F.col("tag").bitwiseXOR(F.col("x")).alias("x"))
        new = cut(known.unionByName(late).unionByName(alone(levels[k - 1])))
        drop(known)
        known = new
    for level in levels:
        drop(level)
    return known


def bridges(edges: DataFrame) -> DataFrame:
    """edges (e: unique number, a, b) -> (e): those whose removal parts their ends.

    Edges outside of a spanning forest get a random tag each (a hash of e). A tree edge is a bridge if no other edge leads out
    of its subtree, that is if the tags at the subtree's nodes cancel out: an edge within it occurs twice. Subtrees are
    stretches of a tour around the tree, along which the tags are combined; all around they cancel out. An edge that isn't a
    bridge is taken for one with a chance of 1 in 2 ** 64. Edges from a node to itself are none; of parallel edges none is.
    """
    tree = cut(spanning_forest(edges).join(edges, "e").select("e", "a", "b"))
    rest = edges.where("a <> b").join(tree, "e", "left_anti").select(F.explode(F.array("a", "b")).alias("at"), F.xxhash64(F.lit(7), "e").alias("tag"))
    tags = rest.groupBy("at").agg(F.bit_xor("tag").alias("tag"))
    halves = cut(tree.select(F.explode(F.array(F.struct((2 * F.col("e")).alias("node"), F.col("a").alias("at")), F.struct((2 * F.col("e") + 1).alias("node"), F.col("b").alias("at")))).alias("h")).select("h.*"))
    bearer = halves.groupBy("at").agg(F.min("node").alias("node")).join(tags, "at").select("node", "tag")
    # an edge is followed by the one after its way back
    nexts = _tour(halves).select(F.col("node").bitwiseXOR(F.lit(1).cast("long")).alias("node"), F.col("turn").alias("next"))
    links = cut(nexts.join(bearer, "node", "left").withColumn("tag", F.coalesce("tag", F.lit(0).cast("long"))))
    # from the edge on to its way back, without the edge itself
    each = potentials(links).unionByName(links.select("node", F.col("tag").alias("x")))
    return each.groupBy(F.shiftright("node", 1).alias("e")).agg(F.bit_xor("x").alias("x")).where("x = 0").select("e")
