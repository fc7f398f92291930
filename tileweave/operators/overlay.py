"""Overlay of polygons by priority, on a fixed cell grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tileweave.functions.shared import cut, spread
from tileweave.operators.graph import connected_components, rank_cycles
from tileweave.operators.rings import RING, _held, around, clip_rect, interior_points, points_in_polygons, renumber

CELL = ["i", "j"]


def cell_runs(verts: DataFrame, grid: int) -> DataFrame:
    """(poly_id, j, i0, i1): runs of cells i0 to i1 - 1 of row j whose centres are inside each polygon, holes left out.

    For each row of cells, an edge that crosses the centre line is a place where inside changes; the cells between
    the first and the second, the third and the fourth such place are inside. So a row costs its crossings and its
    cells, and nothing is compared with cells outside. Coordinates are doubled, so centres are whole numbers.
    """
    e = around(RING, "x", "y", df=verts, back=False).where("y <> n_y").select("poly_id", *[(2 * F.col(c)).alias(c) for c in ("x", "y", "n_x", "n_y")])
    lo, hi = F.least("y", "n_y"), F.greatest("y", "n_y")
    # rows j whose centre (2j+1)*grid is in [lo, hi)
    first, last = F.ceil((lo - grid) / (2 * grid)), F.ceil((hi - grid) / (2 * grid)) - 1
    rows = e.where(first <= last).withColumn("j", F.explode(F.sequence(first, last))).withColumn("yc", (2 * F.col("j") + 1) * grid)
    num = (F.col("yc") - F.col("y")) * (F.col("n_x") - F.col("x"))
    den = F.col("n_y") - F.col("y")
    # crossing x = x + num / den; cells with centre strictly left of it: (2i+1)*grid < crossing
    sign = F.when(den > 0, 1).otherwise(-1)
    top = (num + F.col("x") * den - grid * den) * sign
    width = 2 * grid * F.abs(den)
    end = F.floor((top - F.pmod(top, width)) / width) + F.when(F.pmod(top, width) > 0, 1).otherwise(0)
    x = rows.select("poly_id", "j", end.cast("long").alias("i0"))
    w = W.partitionBy("poly_id", "j").orderBy("i0")
    spans = x.withColumn("k", F.row_number().over(w)).withColumn("i1", F.lead("i0").over(w)).where("k % 2 = 1 and i1 > i0")
    return spans.select("poly_id", "j", "i0", "i1")


def rasterize(verts: DataFrame, grid: int) -> DataFrame:
    """(poly_id, i, j): cells whose centre is inside each polygon, holes left out."""
    return run_cells(cell_runs(verts, grid)).select("poly_id", *CELL)


def run_cells(runs: DataFrame) -> DataFrame:
    """Runs (j, i0, i1, more) as cells (i, j, more)."""
    return runs.select(F.explode(F.sequence(F.col("i0"), F.col("i1") - 1)).alias("i"), *[c for c in runs.columns if c not in ("i0", "i1")])


def overlay_runs(runs: DataFrame, polys: DataFrame, width: int = 64) -> DataFrame:
    """priority_overlay of runs (poly_id, j, i0, i1): runs, not cells, are shuffled, to the stretch of `width` cells that they lie in."""
    part = spread(runs).join(polys.select("poly_id", "priority"), "poly_id").withColumn("b", F.explode(F.sequence(F.floor(F.col("i0") / width), F.floor((F.col("i1") - 1) / width))))
    dealt = part.select("j", "b", F.greatest("i0", F.col("b") * width).alias("i0"), F.least("i1", F.col("b") * width + width).alias("i1"), "priority", "poly_id").repartition("j", "b")
    # grouped by what it is dealt by and the cell, so nothing is shuffled again
    cells = dealt.select("j", "b", F.explode(F.sequence(F.col("i0"), F.col("i1") - 1)).alias("i"), F.struct("priority", "poly_id").alias("p"))
    return cells.groupBy("j", "b", "i").agg(F.min("p")["poly_id"].alias("poly_id")).select(*CELL, "poly_id")


def priority_overlay(cells: DataFrame, polys: DataFrame) -> DataFrame:
    """(i, j, poly_id): for each cell its polygon of the smallest (priority, poly_id); polys: (poly_id, priority)."""
    return spread(cells).join(polys.select("poly_id", "priority"), "poly_id").groupBy(*CELL).agg(F.min(F.struct("priority", "poly_id"))["poly_id"].alias("poly_id"))


def mask_cells(cells: DataFrame, land: DataFrame, islands: DataFrame) -> DataFrame:
    """cells (i, j, poly_id, category): all but holes only on land, and water not on islands."""
    on = cells.where("category <> 'hole'").join(spread(land.select(*CELL).distinct()), CELL, "left_semi").unionByName(cells.where("category = 'hole'"))
    water = on.where("category IN ('lake', 'stream')").join(spread(islands.select(*CELL).distinct()), CELL, "left_anti")
    return on.where("category NOT IN ('lake', 'stream')").unionByName(water)


def uncovered(tiles: DataFrame, covered: DataFrame, side: int) -> DataFrame:
    """(tile_x, tile_y, i, j) of the cells of square tiles that nothing covers."""
    s = lambda c: F.sequence(F.col(c) * side, F.col(c) * side + side - 1)
    cells = tiles.withColumn("i", F.explode(s("tile_x"))).withColumn("j", F.explode(s("tile_y")))
    return cells.join(spread(covered.select(*CELL).distinct()), CELL, "left_anti").select("tile_x", "tile_y", *CELL)


def dissolve(verts: DataFrame, key: str) -> DataFrame:
    """(key, ax, ay, bx, by): outline edges of the union of edge-matched rings with one value of key: those that occur once."""
    e = around([key, *RING] if key not in RING else RING, "x", "y", df=verts, back=False)
    a, b = F.struct("x", "y"), F.struct(F.col("n_x").alias("x"), F.col("n_y").alias("y"))
    once = e.select(key, F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).groupBy(key, "a", "b").count().where("count = 1")
    return once.select(key, F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def directed_outline(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Of directed edges (keys, ax, ay, bx, by) of edge-matched rings, those that occur once, whichever way round."""
    a, b = (F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}y").alias("y")) for e in "ab")
    once = edges.select(*keys, F.least(a, b).alias("p"), F.greatest(a, b).alias("q"), (a < b).alias("up")).groupBy(*keys, "p", "q").agg(F.count("*").alias("n"), F.first("up").alias("up")).where("n = 1")
    at = lambda first, c: F.when(F.col("up") == first, F.col(f"p.{c}")).otherwise(F.col(f"q.{c}"))
    return once.select(*keys, *[at(e == "a", c).alias(f"{e}{c}") for e in "ab" for c in "xy"])


def trace_rings(outline: DataFrame, keys: list[str], corners_only: bool = True) -> DataFrame:
    """Outline edges (keys, ax, ay, bx, by), inside on their left -> rings (keys, ring_id, is_hole, seq, x, y, area2).

    An edge is followed by the one at its end that comes first clockwise from the way back, so the inside stays one wedge
    and parts that touch in a corner are rings of their own (holes that do are one ring). Edges are put in order by pointer doubling: about log2 of the
    longest ring rounds, whatever tiles a ring passes. Outer rings run counter-clockwise, with area2 over 0, holes clockwise,
    under 0. ring_id is a number without meaning, seq begins at the ring's edge of the smallest number; with corners_only
    vertices on straight lines go. The outline must be closed: as many edges lead to a place as from it.
    """
    o = cut(outline.withColumn("node", F.monotonically_increasing_id()))
    out = o.select(*keys, F.col("node").alias("next"), F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("bx").alias("cx"), F.col("by").alias("cy"))
    way = lambda x, y: F.atan2((F.col(y) - F.col("by")).cast("double"), (F.col(x) - F.col("bx")).cast("double"))
    turn = F.pmod(way("ax", "ay") - way("cx", "cy"), F.lit(2 * math.pi))
    links = cut(o.select(*keys, "node", "ax", "ay", "bx", "by").join(out, [*keys, "bx", "by"]).groupBy("node").agg(F.min_by("next", F.struct(F.when(turn < 1e-12, 2 * math.pi).otherwise(turn), "next")).alias("next")))
    ranked = rank_cycles(links).select("node", F.col("cycle").alias("ring_id"), F.col("pos").cast("long").alias("seq"))
    rings = o.join(ranked, "node").select(*keys, "ring_id", "seq", F.col("ax").alias("x"), F.col("ay").alias("y"), (F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")).alias("cross"))
    if corners_only:
        n = around(["ring_id"], "x", "y", df=rings)
        straight = (F.col("x") - F.col("p_x")) * (F.col("n_y") - F.col("y")) == (F.col("y") - F.col("p_y")) * (F.col("n_x") - F.col("x"))
        rings = renumber(n.withColumn("keep", ~straight), ["ring_id", "keep"], "seq").where("keep").select(*keys, "ring_id", F.col("seq").cast("long").alias("seq"), "x", "y")
    rings = cut(rings.select(*keys, "ring_id", "seq", "x", "y"))
    area = around(["ring_id"], "x", "y", df=rings, back=False).groupBy("ring_id").agg(F.sum(F.col("x") * F.col("n_y") - F.col("n_x") * F.col("y")).alias("area2"))
    return rings.join(area, "ring_id").select(*keys, "ring_id", (F.col("area2") < 0).alias("is_hole"), "seq", "x", "y", "area2")


def assign_holes(rings: DataFrame, keys: list[str], cell: int) -> DataFrame:
    """rings of trace_rings with outer_id: the ring's own id, or for a hole the smallest outer ring of its keys around it.

    A place inside the hole is looked up among the outer rings by rows of cells `cell` high; no ring meets another but by place.
    """
    d = cut(rings.select(*keys, "ring_id", "is_hole", "seq", (2 * F.col("x")).alias("x"), (2 * F.col("y")).alias("y"), "area2"))
    as_poly = lambda df: df.select(F.col("ring_id").alias("poly_id"), F.lit(0).alias("ring"), "seq", "x", "y")
    # in doubled units; interior_points doubles again, and a place on the half of it is inside, too
    inner = interior_points(as_poly(d.where("is_hole").withColumn("x", F.col("x").cast("long"))))
    points = inner.select(F.col("poly_id").alias("pt_id"), F.col("x2").alias("x"), F.col("y2").alias("y"))
    outer = as_poly(d.where("not is_hole")).withColumn("x", 2 * F.col("x")).withColumn("y", 2 * F.col("y"))
    met = points_in_polygons(points, outer, 4 * cell)
    of = d.select("ring_id", *keys, "area2").distinct()
    hole, around_it = of.select(F.col("ring_id").alias("pt_id"), *keys, F.col("area2").alias("hole2")), of.select(F.col("ring_id").alias("poly_id"), *keys, "area2")
    # the place may lie on an island in the hole, which is smaller than the hole
    best = met.join(hole, "pt_id").join(around_it, ["poly_id", *keys]).where("area2 > -hole2").groupBy(F.col("pt_id").alias("ring_id")).agg(F.min(F.struct("area2", "poly_id"))["poly_id"].alias("outer_id"))
    return rings.join(best, "ring_id", "left").withColumn("outer_id", F.when(F.col("is_hole"), F.col("outer_id")).otherwise(F.col("ring_id")))


def dissolve_rings(verts: DataFrame, key: str, cell: int) -> DataFrame:
    """(key, ring_id, outer_id, is_hole, seq, x, y, area2): the union of edge-matched rings with one value of key, as rings.

    verts (key, poly_id, ring, seq, x, y) run counter-clockwise, holes clockwise, and meet along whole edges.
    """
    e = around([key, *RING] if key not in RING else RING, "x", "y", df=verts, back=False)
    edges = e.select(key, F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by"))
    return assign_holes(trace_rings(directed_outline(edges, [key]), [key]), [key], cell)


def clip_parts(verts: DataFrame, keys: list[str], bounds: tuple[Column, Column, Column, Column]) -> DataFrame:
    """Polygons (keys, ring, seq, x, y) clipped to a rectangle (west, east, south, north) as separate parts, as trace_rings has them.

    Clipping by half-planes leaves a concave ring whole, with stretches to and fro along the rectangle's sides. Of each stretch of
    a side the passes one way and the other are counted along it, all rings of a polygon together, and what cancels out goes: a ring
    falls apart where it should, and a hole that reaches a side becomes a notch. Outer rings run counter-clockwise, holes clockwise;
    bounds are constants or columns constant within a polygon. Polygons without area inside vanish.
    """
    sides = dict(zip(("b_w", "b_e", "b_s", "b_n"), bounds, strict=True))
    v = verts.withColumns({n: b.cast("long") for n, b in sides.items()})
    c = clip_rect(v, [*keys, "ring"], tuple(F.col(n) for n in sides), list(sides))
    e = around([*keys, "ring"], "x", "y", df=c, back=False).select(*keys, *sides, F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by")).where("ax <> bx or ay <> by")
    line = F.when((F.col("ax") == F.col("bx")) & (F.col("ax") == F.col("b_w")), "w").when((F.col("ax") == F.col("bx")) & (F.col("ax") == F.col("b_e")), "e").when((F.col("ay") == F.col("by")) & (F.col("ay") == F.col("b_s")), "s").when((F.col("ay") == F.col("by")) & (F.col("ay") == F.col("b_n")), "n")
    e = cut(e.withColumn("line", line))
    upright = F.col("line").isin("w", "e")
    p, q = F.when(upright, F.col("ay")).otherwise(F.col("ax")), F.when(upright, F.col("by")).otherwise(F.col("bx"))
    # going up adds one from its start on and takes it away from its end on; going down the other way round
    turn = lambda at, way: F.struct(at.alias("at"), F.lit(way).alias("way"))
    passes = e.where("line is not null").select(*keys, "line", F.when(upright, F.col("ax")).otherwise(F.col("ay")).alias("side"), F.explode(F.array(turn(p, 1), turn(q, -1))).alias("t"))
    w = W.partitionBy(*keys, "line").orderBy("at")
    net = passes.groupBy(*keys, "line", "side", "t.at").agg(F.sum("t.way").alias("way")).withColumns({"net": F.sum("way").over(w), "to": F.lead("at").over(w)}).where("net <> 0 and to is not null")
    up, upright = F.col("net") > 0, F.col("line").isin("w", "e")
    start, end = F.when(up, F.col("at")).otherwise(F.col("to")), F.when(up, F.col("to")).otherwise(F.col("at"))
    xy = lambda along, stands: F.when(upright, F.col("side") if stands else along).otherwise(along if stands else F.col("side"))
    kept = net.select(*keys, xy(start, True).alias("ax"), xy(start, False).alias("ay"), xy(end, True).alias("bx"), xy(end, False).alias("by"), F.explode(F.array_repeat(F.lit(0), F.abs("net").cast("int")))).drop("col")
    return trace_rings(e.where("line is null").select(*keys, "ax", "ay", "bx", "by").unionByName(kept), keys)


def cell_parts(cells: DataFrame, key: str) -> DataFrame:
    """Distinct cells (key, i, j) -> runs (key, j, i0, i1, part_i, part_j): single parts, told by their first cell by row.

    Cells of a key that share an edge are one part, whatever tiles they lie in. Cells become runs, runs of one row and the next that
    overlap are links, and the parts are the links' components.
    """
    w = W.partitionBy(key, "j").orderBy("i")
    g = cells.select(key, *CELL).withColumn("g", F.col("i") - F.row_number().over(w))
    runs = cut(g.groupBy(key, "j", "g").agg(F.min("i").alias("i0"), (F.max("i") + 1).alias("i1")).drop("g"))
    node = F.struct(F.col(key).alias("k"), "j", F.col("i0").alias("i"))
    up = runs.select(key, (F.col("j") - 1).alias("j"), F.col("i0").alias("u0"), F.col("i1").alias("u1"))
    links = runs.join(up, [key, "j"]).where("u0 < i1 and i0 < u1").select(node.alias("a"), F.struct(F.col(key).alias("k"), (F.col("j") + 1).alias("j"), F.col("u0").alias("i")).alias("b"))
    found = connected_components(links).select(F.col("node.k").alias(key), F.col("node.j").alias("j"), F.col("node.i").alias("i0"), F.col("component.i").alias("part_i"), F.col("component.j").alias("part_j"))
    return runs.join(found, [key, "j", "i0"], "left").select(key, "j", "i0", "i1", F.coalesce("part_i", "i0").alias("part_i"), F.coalesce("part_j", "j").alias("part_j"))


def run_outline(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Directed outline (keys, ax, ay, bx, by), inside on the left, of runs (keys, j, i0, i1) of cells, in units of cells.

    A run's two ends are outline as they are; of lower and upper sides those stay that no other cell has. Sides in one line and
    direction are one edge: where such lines touch another ring's corner, their directions differ.
    """
    side = lambda x, y, way: F.struct(x.alias("x"), y.alias("y"), F.lit(way).alias("way"))
    ends = runs.select(*keys, F.explode(F.array(side(F.col("i0"), F.col("j"), -1), side(F.col("i1"), F.col("j"), 1))).alias("s")).select(*keys, "s.*")
    flat = runs.select(*keys, "j", F.explode(F.sequence("i0", F.col("i1") - 1)).alias("i")).select(*keys, F.explode(F.array(side(F.col("i"), F.col("j"), 1), side(F.col("i"), F.col("j") + 1, -1))).alias("s")).select(*keys, "s.*")
    flat = flat.groupBy(*keys, "x", "y").agg(F.count("*").alias("n"), F.first("way").alias("way")).where("n = 1").drop("n")

    def lines(df: DataFrame, along: str, across: str) -> DataFrame:
        w = W.partitionBy(*keys, across, "way").orderBy(along)
        g = df.withColumn("g", F.col(along) - F.row_number().over(w)).groupBy(*keys, across, "way", "g").agg(F.min(along).alias("lo"), (F.max(along) + 1).alias("hi"))
        ahead = F.col("way") > 0
        at = {f"a{along}": F.when(ahead, F.col("lo")).otherwise(F.col("hi")), f"b{along}": F.when(ahead, F.col("hi")).otherwise(F.col("lo")), f"a{across}": F.col(across), f"b{across}": F.col(across)}
        return g.select(*keys, *[at[c].cast("long").alias(c) for c in ("ax", "ay", "bx", "by")])

    return lines(ends, "y", "x").unionByName(lines(flat, "x", "y"))


def run_rings(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Rings around runs (keys, j, i0, i1) of cells, in units of cells, as trace_rings gives them."""
    return trace_rings(run_outline(runs, keys), keys, corners_only=False)


def cut_out_parts(features: DataFrame, cutter: DataFrame) -> DataFrame:
    """What is left of features' cells (poly_id, i, j) without the cutter's, in single parts, as runs of cell_parts."""
    return cell_parts(features.join(spread(cutter.select(*CELL).distinct()), CELL, "left_anti"), "poly_id")


def union_cells(cells: DataFrame, key: str) -> DataFrame:
    """Cells that any row of a key covers."""
    return cells.select(key, *CELL).distinct()


def set_operation(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Cells of intersection, difference or symmetric_difference of two cell sets."""
    a, b = spread(a.select(*CELL).distinct()), spread(b.select(*CELL).distinct())
    if how == "intersection":
        return a.join(b, CELL, "left_semi")
    if how == "difference":
        return a.join(b, CELL, "left_anti")
    if how == "symmetric_difference":
        return a.join(b, CELL, "left_anti").unionByName(b.join(a, CELL, "left_anti"))
    raise ValueError(how)


def or_overlay(a: DataFrame, b: DataFrame) -> DataFrame:
    """(i, j, cls) of two layers: a's class, unless it is null or 0."""
    return a.select(*CELL, F.col("cls").alias("ca")).join(b.select(*CELL, F.col("cls").alias("cb")), CELL, "full_outer").select(*CELL, F.coalesce(F.nullif("ca", F.lit(0)), "cb").alias("cls"))


def cut_out(features: DataFrame, cutter: DataFrame) -> DataFrame:
    """(poly_id, n_before, n_left, relation) of features' cells: untouched, cut, or within the cutter, which deletes them."""
    c = cutter.select(*CELL).distinct().withColumn("hit", F.lit(1))
    n = features.join(spread(c), CELL, "left").groupBy("poly_id").agg(F.count("*").alias("n_before"), F.count_if(F.col("hit").isNull()).alias("n_left"))
    return n.withColumn("relation", F.when(F.col("n_left") == F.col("n_before"), "untouched").when(F.col("n_left") == 0, "within").otherwise("cut"))


def face_class(points: DataFrame, inside: DataFrame, polys: DataFrame) -> DataFrame:
    """points (pt_id) with the polygon of smallest (priority, poly_id) that they are inside of; inside: (pt_id, poly_id)."""
    best = spread(inside).join(polys.select("poly_id", "priority"), "poly_id").groupBy("pt_id").agg(F.min(F.struct("priority", "poly_id"))["poly_id"].alias("poly_id"))
    return points.join(spread(best), "pt_id", "left")


def best_at_points(points: DataFrame, verts: DataFrame, polys: DataFrame, cell: int) -> DataFrame:
    """(pt_id, poly_id): for each point (pt_id, x, y) inside any polygon that of the smallest (priority, poly_id).

    A grid cell of twice `cell` is covered by a polygon that holds its centre and has no edge near; the best polygon that covers a
    cell holds all its points. Only polygons with an edge in the cell that come before it are left to be tested at the points, so
    what lies below a cover costs nothing, however many polygons are stacked there.
    """
    from tileweave.operators.mesh import _deal

    side = 2 * cell
    rank = polys.select("poly_id", F.struct("priority", "poly_id").alias("rank"))
    e = around(RING, "x", "y", df=verts, back=False).select("poly_id", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by"))
    border = cut(_deal(e, side, 1).select("poly_id", "gx", "gy").distinct())
    inner = rasterize(verts, side).select("poly_id", F.col("i").alias("gx"), F.col("j").alias("gy")).join(spread(border), ["poly_id", "gx", "gy"], "left_anti")
    cover = cut(spread(inner).join(rank, "poly_id").groupBy("gx", "gy").agg(F.min("rank").alias("best")))
    asked = spread(border).join(rank, "poly_id").join(spread(cover), ["gx", "gy"], "left").where("best is null or rank < best").select("poly_id", "gx", "gy")
    p = points.select("pt_id", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / side).alias("gx"), F.floor(F.col("y") / side).alias("gy"))
    met = spread(_held(p.join(spread(asked), ["gx", "gy"]).select("pt_id", "poly_id", "px", "py"), verts, cell)).join(rank, "poly_id").select("pt_id", "rank")
    covered = p.join(spread(cover), ["gx", "gy"]).select("pt_id", F.col("best").alias("rank"))
    return met.unionByName(covered).groupBy("pt_id").agg(F.min("rank")["poly_id"].alias("poly_id"))


def area_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(layer, area2_before, area2_after, difference) from ring areas (layer, area2)."""
    a = before.groupBy("layer").agg(F.sum("area2").alias("area2_before"))
    b = after.groupBy("layer").agg(F.sum("area2").alias("area2_after"))
    return a.join(b, "layer", "full_outer").withColumn("difference", F.coalesce("area2_after", F.lit(0)) - F.coalesce("area2_before", F.lit(0)))
