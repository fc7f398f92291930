"""Ring and polygon geometry over vertices (keys, ring, seq, x, y) in whole units; lines have (line_id, seq, x, y)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.functions.shared import cut, drop, spread

RING = ["poly_id", "ring"]


def around(keys: list[str] = RING, *columns: str, df: DataFrame | None = None, back: bool = True) -> DataFrame:
    """df with the circular next (n_) and, if back, previous (p_) value of columns within each ring."""
    w = W.partitionBy(*keys).orderBy("seq")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # the end is where no seq follows: a neighbour's own value may be null
    new = {f"n_{c}": F.when(F.lead("seq").over(w).isNull(), F.first(c).over(whole)).otherwise(F.lead(c).over(w)) for c in columns}
    if back:
        new |= {f"p_{c}": F.when(F.lag("seq").over(w).isNull(), F.last(c).over(whole)).otherwise(F.lag(c).over(w)) for c in columns}
    return df.withColumns(new)


def renumber(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """df with seq from 0 within keys in an order."""
    return df.withColumn("seq", F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("int") - 1)


def bounding_boxes(verts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, min_x, min_y, max_x, max_y)."""
    return verts.groupBy(*keys).agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))


def areas(verts: DataFrame, keys: list[str] = RING) -> DataFrame:
    """(keys, area2): twice the signed area of each ring, positive counter-clockwise; exact in whole units."""
    v = around(keys, "x", "y", df=verts, back=False)
    return v.groupBy(*keys).agg(F.sum(F.col("x") * F.col("n_y") - F.col("n_x") * F.col("y")).alias("area2"))


def polygon_areas(verts: DataFrame) -> DataFrame:
    """(poly_id, area2): outer area less holes, whatever their orientation."""
    holes = verts.select(*RING, "is_hole").distinct()
    a = areas(verts).join(holes, RING)
    return a.groupBy("poly_id").agg(F.sum(F.when(F.col("is_hole"), -F.abs("area2")).otherwise(F.abs("area2"))).alias("area2"))


def _angle() -> Column:
    ax, ay, bx, by = F.col("p_x") - F.col("x"), F.col("p_y") - F.col("y"), F.col("n_x") - F.col("x"), F.col("n_y") - F.col("y")
    return F.degrees(F.abs(F.atan2((ax * by - ay * bx).cast("double"), (ax * bx + ay * by).cast("double"))))


def min_angles(verts: DataFrame, keys: list[str] = RING) -> DataFrame:
    """(keys, min_angle): smallest angle between the two edges of a vertex, in degrees."""
    return around(keys, "x", "y", df=verts).groupBy(*keys).agg(F.round(F.min(_angle()), 6).alias("min_angle"))


def snap(verts: DataFrame, grid: int) -> DataFrame:
    """Vertices at the nearest grid place; halves go up."""
    at = lambda c: (F.floor((2 * F.col(c) + grid) / (2 * grid)) * grid).cast("long")
    return verts.withColumn("x", at("x")).withColumn("y", at("y"))


def rect_relation(boxes: DataFrame, w: int, s: int, e: int, n: int) -> DataFrame:
    """boxes with inside and meets: whether the rectangle holds them, or shares a place with them."""
    x0, x1, y0, y1 = F.least("min_x", "max_x"), F.greatest("min_x", "max_x"), F.least("min_y", "max_y"), F.greatest("min_y", "max_y")
    return boxes.withColumn("inside", (x0 >= w) & (x1 <= e) & (y0 >= s) & (y1 <= n)).withColumn("meets", (x1 >= w) & (x0 <= e) & (y1 >= s) & (y0 <= n))


def remove_duplicates(verts: DataFrame, keys: list[str] = RING) -> DataFrame:
    """Vertices without repeats of the one before, also across the ring's end; the highest z of a run stays."""
    w = W.partitionBy(*keys).orderBy("seq")
    same = F.lag("x").over(w).eqNullSafe(F.col("x")) & F.lag("y").over(w).eqNullSafe(F.col("y"))
    v = verts.withColumn("__new", F.when(same, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(w))
    last = F.max("__run").over(W.partitionBy(*keys))
    ends = W.partitionBy(*keys).orderBy("seq").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    closed = (F.first("x").over(ends) == F.last("x").over(ends)) & (F.first("y").over(ends) == F.last("y").over(ends))
    v = v.withColumn("__run", F.when(closed & (F.col("__run") == last), 1).otherwise(F.col("__run")))
    out = v.groupBy(*keys, "__run").agg(F.min("seq").alias("seq"), F.first("x").alias("x"), F.first("y").alias("y"), F.max("z").alias("z"))
    return renumber(out, keys, "seq").select(*keys, "seq", "x", "y", "z")


def drop_small(verts: DataFrame, min_verts: int = 3, min_area2: int = 1, keys: list[str] = RING) -> DataFrame:
    """Rings with enough vertices and area."""
    ok = areas(verts, keys).where(F.abs("area2") >= min_area2).join(verts.groupBy(*keys).count().where(F.col("count") >= min_verts), keys).select(*keys)
    return verts.join(ok, keys, "left_semi")


def split_cycles(verts: DataFrame, keys: list[str] = RING) -> DataFrame:
    """Rings split where they meet themselves at a vertex, into simple cycles: `cycle` numbers them.

    A round cuts, in every ring at once, the innermost stretches between two visits of one place into cycles of their
    own, named by the round and the place in the ring where they start; what is left is cycle 0. Rounds go on until no
    place repeats, each cut off from the lineage; their number is the depth of nesting.
    """
    now = cut(verts.withColumn("cycle", F.lit(0).cast("long")).withColumn("__at", F.row_number().over(W.partitionBy(*keys).orderBy("seq")).cast("long")))
    done, r = None, 0
    while True:
        r += 1
        w = W.partitionBy(*keys, "x", "y").orderBy("__at")
        stretch = now.withColumn("__until", F.lead("__at").over(w)).where("__until is not null").select(*keys, F.col("__at").alias("a"), F.col("__until").alias("b"))
        # innermost: no other stretch begins in it and ends in it
        inner = cut(stretch.withColumn("__nb", F.min("b").over(W.partitionBy(*keys).orderBy("a").rowsBetween(1, W.unboundedFollowing))).where("__nb is null or __nb > b").select(*keys, "a", "b"))
        if not inner.limit(1).count():
            drop(inner)
            return (now if done is None else now.unionByName(done)).drop("__at")
        # innermost stretches overlap by ends only, so a vertex is in the one that starts last before it, if in any
        ends = now.select(*keys, "__at").withColumn("__x", F.lit(1)).unionByName(inner.select(*keys, F.col("a").alias("__at"), F.lit(0).alias("__x"), "b"), allowMissingColumns=True)
        before = W.partitionBy(*keys).orderBy("__at", "__x")
        held = ends.withColumn("__a", F.last(F.when(F.col("__x") == 0, F.col("__at")), True).over(before)).withColumn("__b", F.last("b", True).over(before)).where("__x = 1 AND __at < __b").select(*keys, "__at", "__a")
        marked = cut(now.join(held, [*keys, "__at"], "left"))
        out = marked.where("__a is not null").withColumn("cycle", F.lit(r).cast("long") * (1 << 40) + F.col("__a")).drop("__a")
        done = out if done is None else done.unionByName(out)
        drop(inner)
        drop(now)
        now = cut(marked.where("__a is null").drop("__a"))


def remove_spikes(verts: DataFrame, min_angle: float = 0.1, keys: list[str] = RING, rounds: int = 4) -> DataFrame:
    """Rings without vertices where the edge turns back by less than min_angle, until there is none, or three are left.

    Of two in a row one goes in a round; the lineage is cut every `rounds` rounds.
    """
    now = cut(verts)
    while True:
        out = now
        for _ in range(rounds):
            v = around(keys, "x", "y", df=out).withColumn("__spike", _angle() < min_angle)
            w = W.partitionBy(*keys).orderBy("seq")
            n, first = F.count("*").over(W.partitionBy(*keys)), F.first("__spike").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
            # in a row of spikes every second goes; the last one also stays where the first one goes
            start = F.last(F.when(~F.col("__spike"), F.col("__i")), True).over(w.rowsBetween(W.unboundedPreceding, -1))
            v = v.withColumn("__i", F.row_number().over(w)).withColumn("__turn", (F.col("__i") - F.coalesce(start, F.lit(0))) % 2 == 1)
            gone = F.col("__spike") & F.col("__turn") & (n > 3) & ~((F.col("__i") == n) & first & (n > 1))
            v = v.withColumn("__gone", gone).withColumn("__g", F.sum(F.col("__gone").cast("int")).over(w))
            # a ring keeps three
            out = renumber(v.withColumn("__n", n).where("not __gone or __g > __n - 3"), keys, "seq").select(*verts.columns)
        out = cut(out)
        same = out.count() == now.count()
        drop(now)
        now = out
        if same:
            return now


def slivers(verts: DataFrame, max_angle: float, max_area2: int, tiny_area2: int) -> DataFrame:
    """(poly_id, ring, sliver) of outer rings: thin and small, or tiny."""
    v = verts.where("not is_hole")
    j = areas(v).join(min_angles(v), RING)
    return j.select(*RING, ((F.col("min_angle") < max_angle) & (F.abs("area2") < max_area2) | (F.abs("area2") < tiny_area2)).alias("sliver"))


def merge_targets(verts: DataFrame, small: DataFrame) -> DataFrame:
    """(poly_id, into): for each polygon of small, the neighbour with the longest shared edge; ties take the lowest id."""
    e = around(RING, "x", "y", df=verts, back=False).select("poly_id", F.least(F.struct("x", "y"), F.struct(F.col("n_x").alias("x"), F.col("n_y").alias("y"))).alias("a"), F.greatest(F.struct("x", "y"), F.struct(F.col("n_x").alias("x"), F.col("n_y").alias("y"))).alias("b"))
    other = e.select(F.col("poly_id").alias("into"), "a", "b")
    length2 = F.pow(F.col("a.x") - F.col("b.x"), 2) + F.pow(F.col("a.y") - F.col("b.y"), 2)
    shared = e.join(small.select("poly_id").distinct(), "poly_id").join(other, ["a", "b"]).where("poly_id <> into").groupBy("poly_id", "into").agg(F.sum(F.sqrt(length2)).alias("len"))
    return shared.groupBy("poly_id").agg(F.min(F.struct((-F.col("len")).alias("l"), "into"))["into"].alias("into"))


def densify(verts: DataFrame, longest: int, keys: list[str] = RING) -> DataFrame:
    """Rings whose edges longer than `longest` are cut into int(length / longest) + 1 equal parts."""
    v = around(keys, "x", "y", df=verts, back=False)
    d = F.sqrt((F.pow(F.col("n_x") - F.col("x"), 2) + F.pow(F.col("n_y") - F.col("y"), 2)).cast("double"))
    v = v.withColumn("__n", F.when(d > longest, F.floor(d / longest) + 1).otherwise(1).cast("long")).withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    at = lambda c: F.floor(F.col(c) + (F.col(f"n_{c}") - F.col(c)) * F.col("__k") / F.col("__n") + 0.5).cast("long")
    return renumber(v.withColumn("__x", at("x")).withColumn("__y", at("y")), keys, "seq", "__k").select(*keys, "seq", F.col("__x").alias("x"), F.col("__y").alias("y"))


def strip_holes(verts: DataFrame) -> DataFrame:
    """Outer rings only."""
    return verts.where(~F.col("is_hole"))


def remove_collinear(verts: DataFrame, keys: list[str] = RING) -> DataFrame:
    """Vertices that turn; those on the line between their neighbours go."""
    v = around(keys, "x", "y", df=verts)
    cross = (F.col("x") - F.col("p_x")) * (F.col("n_y") - F.col("y")) - (F.col("y") - F.col("p_y")) * (F.col("n_x") - F.col("x"))
    return renumber(v.where(cross != 0), keys, "seq").select(*verts.columns)


def _gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of whole numbers from 0 on, by as many of Euclid's steps as the smaller one may take."""
    steps = F.sequence(F.lit(1), (F.ceil(1.45 * F.log2(F.least(a, b) + 1.0)) + 3).cast("int"))
    pair = lambda p, q: F.struct(p.cast("long").alias("p"), q.cast("long").alias("q"))
    return F.aggregate(steps, pair(a, b), lambda s, _: F.when(s["q"] == 0, s).otherwise(pair(s["q"], s["p"] % F.greatest(s["q"], F.lit(1)))), lambda s: s["p"])


def nodes_on_edges(edges: DataFrame, nodes: DataFrame, cell: int, most: int = 64) -> DataFrame:
    """edges (more, ax, ay, bx, by) with each node (x, y, more) that lies on them between their ends; all in whole units.

    An edge passes as many whole places as the greatest common divisor of its extents says. Up to `most` of them are listed and met
    by place. An edge with more has one of few directions: it meets the nodes of its own line in the grid cells of its box. So no
    node is compared with an edge whose line it isn't on.
    """
    kind = dict(edges.dtypes)["ax"]
    # an edge of no length has 0, and 1 here: a filter may be evaluated after divisions by it
    e = edges.withColumn("__g", F.greatest(_gcd(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay"))), F.lit(1))).where("__g > 1")
    listed = e.where(F.col("__g") <= most).withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__g") - 1)))
    at = lambda c: F.expr(f"cast(a{c} + (b{c} - a{c}) div __g * __k AS {kind})").alias(c)
    met = spread(listed.select(*edges.columns, at("x"), at("y"))).join(nodes, ["x", "y"])
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    way = F.when((F.col("bx") > F.col("ax")) | ((F.col("bx") == F.col("ax")) & (F.col("by") > F.col("ay"))), F.col("__g")).otherwise(-F.col("__g"))
    long = e.where(F.col("__g") > most).withColumn("__w", way).selectExpr(*edges.columns, "(bx - ax) div __w AS __ux", "(by - ay) div __w AS __uy").withColumn("__c", F.expr("ax * __uy - ay * __ux"))
    dealt = long.withColumn("__cx", F.explode(span("ax", "bx"))).withColumn("__cy", F.explode(span("ay", "by")))
    ways = dealt.select("__cx", "__cy", "__ux", "__uy").distinct()
    n = nodes.withColumn("__cx", F.floor(F.col("x") / cell)).withColumn("__cy", F.floor(F.col("y") / cell))
    lines = spread(ways).join(n, ["__cx", "__cy"]).withColumn("__c", F.expr("x * __uy - y * __ux"))
    between = [F.col(c).between(F.least(f"a{c}", f"b{c}"), F.greatest(f"a{c}", f"b{c}")) for c in "xy"]
    ends = [(F.col("x") == F.col(f"{p}x")) & (F.col("y") == F.col(f"{p}y")) for p in "ab"]
    along = spread(lines).join(dealt, ["__cx", "__cy", "__ux", "__uy", "__c"]).where(between[0] & between[1] & ~ends[0] & ~ends[1])
    return met.unionByName(along.select(*met.columns))


def insert_on_edges(verts: DataFrame, nodes: DataFrame, cell: int, keys: list[str] = RING) -> DataFrame:
    """Rings with every node (x, y) that lies on an edge inserted there, in order along the edge.

    nodes_on_edges finds them by place or by line.
    """
    e = around(keys, "x", "y", df=verts, back=False).select(*keys, "seq", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by"))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    t = (F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy
    new = nodes_on_edges(e, nodes.select("x", "y").distinct(), cell).select(*keys, "seq", t.alias("__t"), "x", "y").distinct()
    both = verts.select(*keys, "seq", F.lit(0).cast("long").alias("__t"), "x", "y").unionByName(new)
    return renumber(both, keys, "seq", "__t").select(*keys, "seq", "x", "y")


def inherit_elevation(points: DataFrame, verts: DataFrame, cell: int, keys: list[str] = RING) -> DataFrame:
    """points (pt_id, x, y) with z of the source vertex (x, y, z) at their place, else interpolated along the edge they are on."""
    exact = verts.groupBy("x", "y").agg(F.max("z").alias("z"))
    e = around(keys, "x", "y", "z", df=verts, back=False)
    e = e.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), F.col("n_x").alias("bx"), F.col("n_y").alias("by"), F.col("n_z").alias("bz"))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    t = ((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / (dx * dx + dy * dy)
    # an edge's ends are vertices, so those are exact
    between = nodes_on_edges(e, points.select("pt_id", "x", "y"), cell).groupBy("pt_id").agg(F.max(F.round(F.col("az") + t * (F.col("bz") - F.col("az")), 6)).alias("ze"))
    return points.join(spread(exact), ["x", "y"], "left").join(spread(between), "pt_id", "left").select("pt_id", "x", "y", F.coalesce(F.col("z").cast("double"), "ze").alias("z"))


def point_squares(points: DataFrame, size: int) -> DataFrame:
    """(pt_id, seq, x, y): a square of a given size around each point, counter-clockwise."""
    h = size // 2
    corners = F.array(*[F.struct((F.col("x") + sx * h).alias("x"), (F.col("y") + sy * h).alias("y")) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1))])
    return points.select("pt_id", F.posexplode(corners).alias("seq", "p")).select("pt_id", "seq", "p.x", "p.y")


def prepare_line(points: DataFrame, stretch: float, ratio: int = 10) -> DataFrame:
    """Lines with both ends moved outward by `stretch` and segments longer than ratio * width cut into equal parts."""
    w = W.partitionBy("line_id").orderBy("seq")
    v = points.withColumns({f"{p}{c}": f(c).over(w) for c in ("x", "y") for p, f in (("p_", F.lag), ("n_", F.lead))})
    dist = lambda a, b: F.sqrt((F.pow(F.col(f"{a}x") - F.col(f"{b}x"), 2) + F.pow(F.col(f"{a}y") - F.col(f"{b}y"), 2)).cast("double"))
    def moved(c: str) -> Column:
        first = F.when(dist("", "n_") > 0, F.col(c) - (F.col(f"n_{c}") - F.col(c)) / dist("", "n_") * stretch).otherwise(F.col(c).cast("double"))
        last = F.when(dist("", "p_") > 0, F.col(c) - (F.col(f"p_{c}") - F.col(c)) / dist("", "p_") * stretch).otherwise(F.col(c).cast("double"))
        return F.when(F.col("p_x").isNull() & F.col("n_x").isNotNull(), first).when(F.col("n_x").isNull() & F.col("p_x").isNotNull(), last).otherwise(F.col(c).cast("double"))
    m = v.select("line_id", "seq", "width", moved("x").alias("x"), moved("y").alias("y"))
    m = m.withColumns({f"n_{c}": F.lead(c).over(w) for c in ("x", "y")})
    n = F.when(F.col("n_x").isNull(), 1).otherwise(F.floor(dist("", "n_") / (F.col("width") * ratio)) + 1).cast("long")
    m = m.withColumn("__n", n).withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    at = lambda c: F.round(F.col(c) + F.coalesce(F.col(f"n_{c}") - F.col(c), F.lit(0.0)) * F.col("__k") / F.col("__n"), 4)
    out = m.select("line_id", F.col("seq").alias("__s"), "__k", at("x").alias("x"), at("y").alias("y"))
    return out.withColumn("seq", F.row_number().over(W.partitionBy("line_id").orderBy("__s", "__k")) - 1).select("line_id", "seq", "x", "y")


def line_quads(points: DataFrame) -> DataFrame:
    """(line_id, seq, corner, x, y): a quad for each segment, half the width to each side, mitred where segments meet."""
    w = W.partitionBy("line_id").orderBy("seq")
    v = points.withColumns({f"{p}{c}": f(c).over(w) for c in ("x", "y") for p, f in (("p_", F.lag), ("n_", F.lead))})
    def unit(a: str, b: str) -> tuple[Column, Column]:
        dx, dy = F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y")
        d = F.sqrt((dx * dx + dy * dy).cast("double"))
        return F.when(d > 0, dx / d), F.when(d > 0, dy / d)
    (ix, iy), (ox, oy) = unit("p_", ""), unit("", "n_")
    ix, iy, ox, oy = F.coalesce(ix, ox), F.coalesce(iy, oy), F.coalesce(ox, ix), F.coalesce(oy, iy)
    k = 1 + ix * ox + iy * oy
    h = F.col("width") / 2
    # the mitre: both edges' offset lines meet there; where the line turns back, the outgoing edge's own offset
    mx, my = F.when(k > 0.05, -(iy + oy) / k).otherwise(-oy), F.when(k > 0.05, (ix + ox) / k).otherwise(ox)
    o = v.select("line_id", "seq", (F.col("x") + mx * h).alias("lx"), (F.col("y") + my * h).alias("ly"), (F.col("x") - mx * h).alias("rx"), (F.col("y") - my * h).alias("ry"))
    o = o.withColumns({f"n_{c}": F.lead(c).over(w) for c in ("lx", "ly", "rx", "ry")}).where("n_lx is not null")
    corners = F.array(*[F.struct(F.round(a, 4).alias("x"), F.round(b, 4).alias("y")) for a, b in (("rx", "ry"), ("n_rx", "n_ry"), ("n_lx", "n_ly"), ("lx", "ly"))])
    return o.select("line_id", "seq", F.posexplode(corners).alias("corner", "p")).select("line_id", "seq", "corner", "p.x", "p.y")


def offset_ring(verts: DataFrame, d: float, keys: list[str] = RING) -> DataFrame:
    """Convex counter-clockwise rings grown by d: each edge line moves outward, and neighbours are intersected again."""
    v = around(keys, "x", "y", df=verts)
    def unit(x0, y0, x1, y1):
        dx, dy = F.col(x1) - F.col(x0), F.col(y1) - F.col(y0)
        n = F.sqrt((dx * dx + dy * dy).cast("double"))
        return dx / n, dy / n
    (ax, ay), (bx, by) = unit("p_x", "p_y", "x", "y"), unit("x", "y", "n_x", "n_y")
    k = 1 + ax * bx + ay * by
    return v.select(*keys, "seq", F.round(F.col("x") + d * (ay + by) / k, 4).alias("x"), F.round(F.col("y") - d * (ax + bx) / k, 4).alias("y"))


def clip_rect(verts: DataFrame, keys: list[str], bounds: tuple[Column, Column, Column, Column], carry: list[str] = ()) -> DataFrame:
    """Rings clipped to a rectangle (west, east, south, north), by half-planes; rings of under three vertices vanish.

    bounds may be columns, so each ring can have its own rectangle; `carry` are columns constant within a ring. Both sides
    of an axis are clipped in one pass over a ring: an edge is cut at the low side, and what is left of it at the high side.
    """
    names = ("__w", "__e", "__s", "__n")
    kept = [*keys, *carry]
    out = verts.select(*kept, "x", "y", F.col("seq").cast("long").alias("__o"), *[b.cast("long").alias(n) for b, n in zip(bounds, names, strict=True)])
    ring = f"PARTITION BY {', '.join(keys)}"
    w = f"({ring} ORDER BY __o)"
    so_far = w[:-1] + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    for axis, other, lo, hi in (("x", "y", "__w", "__e"), ("y", "x", "__s", "__n")):
        # (a, o) to (b, q): an edge; from it (sa, so) to (ea, eo): what is left of it above the low side
        nxt = lambda c: f"CASE WHEN lead(__o) OVER {w} IS NULL THEN first_value({c}) OVER {so_far} ELSE lead({c}) OVER {w} END"
        at = lambda o, side, a, q, b: f"cast(floor({o}+cast(({side}-{a})*({q}-{o}) AS double)/({b}-{a})+0.5) AS bigint)"
        point = lambda first, a, o: f"struct(cast({first} AS int) AS r, {a} AS {axis}, {o} AS {other})"
        v = out.selectExpr(*kept, *names, "__o", f"{axis} AS a", f"{other} AS o", f"{nxt(axis)} AS b", f"{nxt(other)} AS q")
        v = v.where(f"a >= {lo} OR b >= {lo}").selectExpr("*", f"a >= {lo} AS pi", f"CASE WHEN (a >= {lo}) <> (b >= {lo}) THEN {at('o', lo, 'a', 'q', 'b')} END AS c")
        v = v.selectExpr("*", f"IF(pi, a, {lo}) AS sa", "IF(pi, o, c) AS so", f"IF(b >= {lo}, b, {lo}) AS ea", f"IF(b >= {lo}, q, c) AS eo", f"row_number() OVER {w} AS rn")
        v = v.selectExpr("*", "rn = 1 AS head", f"CASE WHEN (sa <= {hi}) <> (ea <= {hi}) THEN {at('so', hi, 'sa', 'eo', 'ea')} END AS d")
        # the ring's numbers go on from the point that the first edge begins with, so what leads there comes last
        enters = f"IF(pi, array(), array({point('head', lo, 'c')}))"
        first = "(head AND pi)"
        left = f"CASE WHEN sa <= {hi} AND ea <= {hi} THEN array({point(first, 'ea', 'eo')}) WHEN sa <= {hi} THEN array({point(first, hi, 'd')}) WHEN ea <= {hi} THEN array({point(first, hi, 'd')}, {point(first, 'ea', 'eo')}) ELSE array() END"
        v = v.selectExpr(*kept, *names, "rn", f"posexplode(concat({enters}, {left})) AS (k, p)")
        # an edge gives up to three points, so one number holds the order
        out = v.selectExpr(*kept, *names, f"IF(p.r = 1, {1 << 40}L, 0L) + 4L * rn + k AS __o", "p.x", "p.y")
    n = out.selectExpr(*kept, f"cast(row_number() OVER {w} AS int)-1 AS seq", "x", "y", f"count(*) OVER ({ring}) AS n")
    return n.where("n >= 3").select(*kept, "x", "y", "seq")


def thin_outside(verts: DataFrame, keys: list[str], bounds: tuple[Column, Column, Column, Column], carry: list[str] = ()) -> DataFrame:
    """Rings without the vertices that can't change what clip_rect covers in any rectangle within bounds.

    A vertex goes where it and both its neighbours lie beyond the same side: half-planes see only where a run of such
    vertices begins and ends. Nothing is cut or rounded, so clipping the thinned ring covers exactly what clipping the whole
    one does; only stretches that run to and fro along the rectangle's border, without any width, may be missing, and a ring
    may begin at another of its vertices. Rings that lie beyond one side altogether vanish.
    """
    out = verts
    for axis, low, high in (("x", *bounds[:2]), ("y", *bounds[2:])):
        v = out.withColumn("__side", F.when(F.col(axis) < low, -1).when(F.col(axis) > high, 1).otherwise(0))
        v = around(keys, "__side", df=v)
        gone = (F.col("__side") != 0) & (F.col("__side") == F.col("p___side")) & (F.col("__side") == F.col("n___side"))
        out = v.where(~gone).select(*keys, *carry, "seq", "x", "y")
    return renumber(out, keys, "seq", "x")


def chop_to_tiles(verts: DataFrame, margin: int = 0, chunk: int | None = 3600) -> DataFrame:
    """(tile, poly_id, ring, is_hole, material, seq, x, y): polygons cut along the tiles that they meet, widened by margin.

    Boxes give the tiles without a join. The vertices of a polygon whose box fits a chunk go to each of its tiles. A larger one
    goes to each of its chunks, thinned to what matters there, and from there to the chunk's tiles, so its tiles don't each
    get all of its vertices. Chunks are `chunk` arcseconds high and wide (whole degrees), and wider where a tile reaches beyond. They are
    found by division, so longitude 0 is a border like others; what is covered is the same whatever the chunk, and without any (None).
    """
    from tileweave.functions.geo import TILE_HEIGHT, tile_south, tile_west, tile_width
    from tileweave.operators.tiles import tiles_in_bbox

    boxes = bounding_boxes(verts, ["poly_id"]).toDF("poly_id", "w", "s", "e", "n")
    wide = (F.col("e") - F.col("w") > chunk) | (F.col("n") - F.col("s") > chunk) if chunk else F.lit(False)
    t = F.col("tile")
    # each tile's bounds are worked out once, in the narrow table of polygons and tiles, and travel as plain numbers
    west, south = tile_west(t), tile_south(t)
    edges = [(west - margin).alias("t_w"), (west + tile_width(t) + margin).alias("t_e"), (south - margin).alias("t_s"), (south + TILE_HEIGHT + margin).alias("t_n")]
    names = ["tile", *RING, "is_hole", "material", "seq", "x", "y", "t_w", "t_e", "t_s", "t_n"]
    v = verts.join(spread(tiles_in_bbox(boxes.where(~wide), "poly_id").select("poly_id", "tile", *edges)), "poly_id").select(*names)
    if chunk and chunk % 3600:
        raise ValueError("a chunk must hold whole degrees, as these hold whole tiles")
    if chunk and boxes.where(wide).limit(1).count():
        cw, cs = west - F.pmod(west, F.lit(chunk)), south - F.pmod(south, F.lit(chunk))
        across = F.greatest(F.lit(chunk).cast("long"), west + tile_width(t) - cw)
        tiles = tiles_in_bbox(boxes.where(wide), "poly_id").select("poly_id", "tile", *edges, cw.alias("cw"), across.alias("ct"), cs.alias("cs"))
        bounds = (F.col("cw") - margin, F.col("cw") + F.col("ct") + margin, F.col("cs") - margin, F.col("cs") + chunk + margin)
        held = verts.join(spread(tiles.select("poly_id", "cw", "ct", "cs").distinct()), "poly_id")
        thin = thin_outside(held, ["cw", "ct", "cs", *RING], bounds, ["is_hole", "material"])
        v = v.unionByName(spread(thin).join(tiles, ["poly_id", "cw", "ct", "cs"]).select(*names))
    # a narrow table of boxes has become many vertices: they are dealt anew, so that tasks are sized by vertices
    v = v.repartition("tile", "poly_id")
    return clip_rect(v, ["tile", *RING], tuple(F.col(c) for c in names[-4:]), ["is_hole", "material", *names[-4:]]).drop(*names[-4:])


def interior_points(verts: DataFrame) -> DataFrame:
    """(poly_id, x2, y2): a place inside each polygon, doubled: on the scan line through the middle of its widest
    gap between vertex heights, the middle of the widest stretch inside."""
    w = W.partitionBy("poly_id").orderBy("y")
    ys = verts.select("poly_id", "y").distinct().withColumn("gap", F.lead("y").over(w) - F.col("y")).where("gap > 0")
    line = ys.groupBy("poly_id").agg(F.min(F.struct((-F.col("gap")).alias("g"), "y")).alias("b")).select("poly_id", (2 * F.col("b.y") - F.col("b.g")).alias("y2"))
    e = around(RING, "x", "y", df=verts, back=False).join(line, "poly_id").where((F.least("y", "n_y") * 2 < F.col("y2")) & (F.greatest("y", "n_y") * 2 > F.col("y2")))
    x2 = F.floor(2 * F.col("x") + ((F.col("y2") - 2 * F.col("y")) * (F.col("n_x") - F.col("x"))).cast("double") / (F.col("n_y") - F.col("y")) + 0.5).cast("long")
    x = e.select("poly_id", "y2", x2.alias("x2"), F.row_number().over(W.partitionBy("poly_id").orderBy(x2, *RING, "seq")).alias("k"))
    wx = W.partitionBy("poly_id").orderBy("k")
    spans = x.withColumn("to", F.lead("x2").over(wx)).where("k % 2 = 1 and to is not null")
    return spans.groupBy("poly_id").agg(F.min(F.struct((F.col("x2") - F.col("to")).alias("l"), "x2", "to", "y2")).alias("b")).select("poly_id", F.floor((F.col("b.x2") + F.col("b.to")) / 2).alias("x2"), "b.y2")


def points_in_polygons(points: DataFrame, verts: DataFrame, cell: int, tile: int = 16) -> DataFrame:
    """(pt_id, poly_id) for points inside polygons: an odd number of edges to the right, so holes count.

    Places first meet, by tiles of `tile` cells a side, the polygons whose boxes hold them, and then only those polygons'
    edges in their own row of cells: both joins have a place or a polygon as their key. Points of one place are looked up once, and
    their rows come from the last join, which nothing shuffles.
    """
    side = tile * cell
    span = lambda a, b, unit: F.explode(F.sequence(F.floor(F.col(a) / unit), F.floor(F.col(b) / unit)))
    boxes = bounding_boxes(verts, ["poly_id"]).withColumn("tx", span("min_x", "max_x", side)).withColumn("ty", span("min_y", "max_y", side))
    p = points.select(F.col("x").alias("px"), F.col("y").alias("py")).distinct().withColumn("tx", F.floor(F.col("px") / side)).withColumn("ty", F.floor(F.col("py") / side))
    near = p.join(spread(boxes), ["tx", "ty"]).where("px between min_x and max_x and py between min_y and max_y").select("px", "py", "poly_id")
    held = spread(_held(near, verts, cell, ["px", "py"]))
    return points.select("pt_id", F.col("x").alias("px"), F.col("y").alias("py")).join(held, ["px", "py"]).select("pt_id", "poly_id")


def _held(near: DataFrame, verts: DataFrame, cell: int, keys: list[str] = ("pt_id",)) -> DataFrame:
    """Of pairs (keys, poly_id, px, py) those (keys, poly_id) whose polygon holds the point; a point meets the edges in its row of cells."""
    near = near.withColumn("cy", F.floor(F.col("py") / cell))
    e = around(RING, "x", "y", df=verts, back=False).where("y <> n_y").select("poly_id", "x", "y", "n_x", "n_y")
    e = e.withColumn("cy", F.explode(F.sequence(F.floor(F.least("y", "n_y") / cell), F.floor(F.greatest("y", "n_y") / cell))))
    left = (F.col("px") - F.col("x")) * (F.col("n_y") - F.col("y")) - (F.col("py") - F.col("y")) * (F.col("n_x") - F.col("x"))
    hit = (F.least("y", "n_y") <= F.col("py")) & (F.col("py") < F.greatest("y", "n_y")) & F.when(F.col("n_y") > F.col("y"), left < 0).otherwise(left > 0)
    return spread(near).join(e, ["poly_id", "cy"]).where(hit).groupBy(*keys, "poly_id").count().where("count % 2 = 1").select(*keys, "poly_id")


def segment_relations(pairs: DataFrame) -> DataFrame:
    """pairs of segments (a*, b* and c*, d*) with crosses, the crossing (ix, iy), and whether c lies on a-b."""
    o = lambda p, q, r: (F.col(f"{q}x") - F.col(f"{p}x")) * (F.col(f"{r}y") - F.col(f"{p}y")) - (F.col(f"{q}y") - F.col(f"{p}y")) * (F.col(f"{r}x") - F.col(f"{p}x"))
    sign = lambda c: F.signum(c.cast("double")).cast("int")
    crosses = (sign(o("a", "b", "c")) * sign(o("a", "b", "d")) < 0) & (sign(o("c", "d", "a")) * sign(o("c", "d", "b")) < 0)
    t = o("c", "d", "a") / (o("c", "d", "a") - o("c", "d", "b"))
    on = (o("a", "b", "c") == 0) & F.col("cx").between(F.least("ax", "bx"), F.greatest("ax", "bx")) & F.col("cy").between(F.least("ay", "by"), F.greatest("ay", "by"))
    at = lambda c: F.when(crosses, F.round(F.col(f"a{c}") + t * (F.col(f"b{c}") - F.col(f"a{c}")), 4))
    return pairs.withColumn("crosses", crosses).withColumn("ix", at("x")).withColumn("iy", at("y")).withColumn("on_edge", on)


#: Pairs of segments that are looked at together: few enough for a core's cache.
PAIRS = 1 << 14


def four(v: np.ndarray) -> np.ndarray:
    """v rounded to four digits, halves away from zero."""
    w = v * 10_000.0
    return np.trunc(w + np.copysign(0.5, w)) / 10_000.0


def columns_of(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns of a table as whole numbers."""
    return [table.column(c).to_numpy().astype(np.int64, copy=False) for c in names]


def crossings(edges: list[np.ndarray], segs: list[np.ndarray]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, i, ix, iy) for stretches of edges (ax, ay, bx, by) against all segs: edge i crosses one of them properly at (ix, iy).

    As segment_relations has it, a bounded number of pairs at a time. Doubles hold the products of places up to 2 ** 24 exactly, and
    are quicker; whole numbers beyond.
    """
    if all(np.abs(v).max(initial=0) < 1 << 24 for v in (*edges, *segs)):
        edges, segs = ([v.astype(np.float64) for v in of] for of in (edges, segs))
    ax, ay, bx, by = edges
    cx, cy, dx, dy = segs
    sx, sy = dx - cx, dy - cy
    k = sx * cy - sy * cx
    step = max(1, PAIRS // max(1, len(cx)))
    for at in range(0, len(ax), step):
        rows = slice(at, min(at + step, len(ax)))
        # on which side of each segment an edge's ends are
        a = (sx * ay[rows, None] - sy * ax[rows, None] - k).ravel()
        b = (sx * by[rows, None] - sy * bx[rows, None] - k).ravel()
        near = np.flatnonzero((a < 0) != (b < 0))
        i, j = np.divmod(near, max(1, len(cx))) if rows.stop - at > 1 else (np.zeros(len(near), np.int64), near)
        i += at
        a, b, x, y = a[near], b[near], ax[i], ay[i]
        ex, ey = bx[i] - x, by[i] - y
        c, d = ex * (cy[j] - y) - ey * (cx[j] - x), ex * (dy[j] - y) - ey * (dx[j] - x)
        hit = np.flatnonzero(((c < 0) != (d < 0)) & (c != 0) & (d != 0) & (a != 0) & (b != 0))
        a, b, i = a[hit], b[hit], i[hit]
        t = a / (a - b)
        yield rows, i, four(x[hit] + t * ex[hit]), four(y[hit] + t * ey[hit])


def oriented_rect(df: DataFrame, heading: Column, length: Column, width: Column) -> DataFrame:
    """df (id, x, y) with the four corners of a rectangle that starts at (x, y) and runs along its heading."""
    s, c = F.sin(F.radians(heading)), F.cos(F.radians(heading))
    corner = lambda along, side: F.struct(F.round(F.col("x") + along * s + side * c, 4).alias("cx"), F.round(F.col("y") + along * c - side * s, 4).alias("cy"))
    zero = F.lit(0.0)
    return df.select("*", F.posexplode(F.array(corner(zero, -width / 2), corner(zero, width / 2), corner(length, width / 2), corner(length, -width / 2))).alias("corner", "p")).select(*df.columns, "corner", "p.cx", "p.cy")


def flatten_bezier(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Rings of nodes (keys, seq, x, y, cx, cy: control point or null) in metres as straight steps.

    An edge is straight without control points, quadratic with one, cubic with two (the far one mirrored at its node). By
    its length over the control points it has int(length) + 1 steps under 8 if curved, 8 up to 800 if curved, and else
    int(length / 100) + 1, but for a straight one under 8, which has one. A curve of one step is straight.
    """
    v = around(keys, "x", "y", "cx", "cy", df=nodes, back=False)
    mx, my = 2 * F.col("n_x") - F.col("n_cx"), 2 * F.col("n_y") - F.col("n_cy")
    curved, both = F.col("cx").isNotNull() | mx.isNotNull(), F.col("cx").isNotNull() & mx.isNotNull()
    far = lambda ax, ay, bx, by: F.sqrt((F.pow(ax - bx, 2) + F.pow(ay - by, 2)).cast("double"))
    here, there, own, other = (F.col("x"), F.col("y")), (F.col("n_x"), F.col("n_y")), (F.col("cx"), F.col("cy")), (mx, my)
    one = F.coalesce("cx", mx), F.coalesce("cy", my)
    length = F.when(both, far(*here, *own) + far(*own, *other) + far(*other, *there)).when(curved, far(*here, *one) + far(*one, *there)).otherwise(far(*here, *there))
    v = v.withColumn("__d", length)
    n = F.when(F.col("__d") < 8, F.when(curved, F.floor("__d") + 1).otherwise(1)).when(curved & (F.col("__d") <= 800), 8).otherwise(F.floor(F.col("__d") / 100) + 1).cast("int")
    v = v.withColumn("__n", n).withColumn("__k", F.explode(F.sequence(F.lit(0), n - 1)))
    t = F.col("__k") / F.col("__n")
    u = 1 - t
    def at(c: str, mirrored: Column) -> Column:
        a, b, ctl = F.col(c), F.col(f"n_{c}"), F.col(f"c{c}")
        quad = a * u * u + F.coalesce(ctl, mirrored) * 2 * u * t + b * t * t
        cubic = a * u * u * u + ctl * 3 * u * u * t + mirrored * 3 * u * t * t + b * t * t * t
        return F.when(~curved | (F.col("__n") == 1), a * u + b * t).when(both, cubic).otherwise(quad)
    out = v.withColumn("__x", at("x", mx)).withColumn("__y", at("y", my))
    return renumber(out, keys, "seq", "__k").select(*keys, "seq", F.col("__x").alias("x"), F.col("__y").alias("y"))


def arc(df: DataFrame, steps: int = 72) -> DataFrame:
    """df (id, lon, lat, radius_m, from_deg, to_deg, clockwise) with points (seq, plon, plat) along the arc, on the sphere."""
    from tileweave.functions.geo import RADIUS

    sweep = F.when(F.col("clockwise"), F.pmod(F.col("to_deg") - F.col("from_deg"), F.lit(360.0))).otherwise(-F.pmod(F.col("from_deg") - F.col("to_deg"), F.lit(360.0)))
    v = df.withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    az = F.radians(F.col("from_deg") + sweep * F.col("seq") / steps)
    d, la = F.col("radius_m") / RADIUS, F.radians("lat")
    plat = F.asin(F.sin(la) * F.cos(d) + F.cos(la) * F.sin(d) * F.cos(az))
    plon = F.radians("lon") + F.atan2(F.sin(az) * F.sin(d) * F.cos(la), F.cos(d) - F.sin(la) * F.sin(plat))
    return v.select("id", "seq", F.round(F.degrees(plon), 6).alias("plon"), F.round(F.degrees(plat), 6).alias("plat"))


def thin(verts: DataFrame, tolerance: float, keys: list[str] = RING) -> DataFrame:
    """Vertices farther than tolerance from the chord of their neighbours, or at even places: no two neighbours go."""
    v = around(keys, "x", "y", df=verts)
    dx, dy = F.col("n_x") - F.col("p_x"), F.col("n_y") - F.col("p_y")
    cross = F.abs((F.col("x") - F.col("p_x")) * dy - (F.col("y") - F.col("p_y")) * dx)
    near = cross.cast("double") < tolerance * F.sqrt((dx * dx + dy * dy).cast("double"))
    return renumber(v.where(~near | (F.col("seq") % 2 == 0)), keys, "seq").select(*verts.columns)


def insert_crossings(verts: DataFrame, segs: DataFrame, cell: int, keys: list[str] = RING) -> DataFrame:
    """Rings with the crossings of their edges and segments (ax, ay, bx, by) inserted, rounded to whole units.

    Edges and segments are dealt to the grid cells that they pass and meet there, a cell's in one Arrow group; equal segments cross
    once. Crossings rounded to one place are one before anything is shuffled: a place counts in its own cell, so an edge's places in a
    cell are a stretch of the ring, which is numbered stretch by stretch. Of a pair of edge and segment nothing is shuffled or kept.
    """
    from tileweave.operators.mesh import _deal

    e = around(keys, "x", "y", df=verts, back=False).select(*keys, "seq", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n_x").alias("bx"), F.col("n_y").alias("by"))
    kinds = dict(e.dtypes)
    carry = [*keys, "seq"]

    def meet(edges: pa.Table, others: pa.Table) -> pa.Table:
        ends = columns_of(edges, "ax", "ay", "bx", "by")
        who, first, size, xs, ys = [], [], [], [], []
        if others.num_rows and edges.num_rows:
            gx, gy = edges.column("gx")[0].as_py(), edges.column("gy")[0].as_py()
            for _, i, ix, iy in crossings(ends, columns_of(others, "ax", "ay", "bx", "by")):
                x, y = (np.floor(v + 0.5).astype(np.int64) for v in (ix, iy))
                own = np.flatnonzero((x // cell == gx) & (y // cell == gy))
                i, x, y = i[own], x[own], y[own]
                # along an edge neither extent shrinks, so their sum stands for one place
                far = np.abs(x - ends[0][i]) + np.abs(y - ends[1][i])
                parts = np.flatnonzero(np.diff(i, prepend=-1, append=-1)) if len(i) else i
                for lo, hi in zip(parts[:-1], parts[1:], strict=True):
                    f = far[lo:hi]
                    base = f.min()
                    at = np.full(f.max() - base + 1, -1)
                    at[f - base] = np.arange(lo, hi)
                    at = at[at >= 0]
                    who.append(i[lo])
                    first.append(base)
                    size.append(len(at))
                    xs.append(x[at])
                    ys.append(y[at])
        ends_at = np.r_[0, np.cumsum(size, dtype=np.int64)].astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends_at, np.concatenate(v) if v else np.zeros(0, np.int64)) for v in (xs, ys)]
        held = edges.select(carry).take(pa.array(who, pa.int64()))
        return pa.table([*held.columns, pa.array(first, pa.int64()), *lists], names=[*carry, "first", "xs", "ys"])

    s = _deal(segs.select("ax", "ay", "bx", "by").distinct(), cell, 1)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in carry), "first long, xs array<long>, ys array<long>"])
    new = _deal(e, cell, 1).groupBy("gx", "gy").cogroup(s.groupBy("gx", "gy")).applyInArrow(meet, schema)
    old = verts.select(*carry, F.lit(-1).cast("long").alias("first"), *[F.array(F.col(c).cast("long")).alias(f"{c}s") for c in "xy"])
    before = F.coalesce(F.sum(F.size("xs")).over(W.partitionBy(*keys).orderBy("seq", "first").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = old.unionByName(new).withColumn("before", before.cast("int"))
    at = runs.select(*keys, "before", "ys", F.posexplode("xs").alias("pos", "x"))
    return at.select(*keys, (F.col("before") + F.col("pos")).alias("seq"), "x", F.get("ys", "pos").alias("y"))
