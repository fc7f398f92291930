"""Queries of the ring and polygon operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.functions.geo import sql_south, sql_tile_id, sql_west, sql_width, sql_width8
from tileweave.operators import rings as G
from tileweave.registry import query
from tileweave.sources import derived as D


def around(src: str, name: str, keys: str = "poly_id, ring", cols: tuple[str, ...] = ("x", "y")) -> str:
    """SQL of a CTE with circular neighbours."""
    parts = ", ".join(f"CASE WHEN lead(seq) OVER w IS NULL THEN first_value({c}) OVER w ELSE lead({c}) OVER w END AS n_{c}, CASE WHEN lag(seq) OVER w IS NULL THEN last_value({c}) OVER f ELSE lag({c}) OVER w END AS p_{c}" for c in cols)
    return f"{name} AS (SELECT *, {parts} FROM {src} WINDOW w AS (PARTITION BY {keys} ORDER BY seq), f AS (PARTITION BY {keys} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


V = around("poly_verts", "v")
AREA = "SELECT poly_id, ring, CAST(sum(x*n_y-n_x*y) AS BIGINT) AS area2 FROM v GROUP BY 1,2"
ANGLE = "degrees(abs(atan2(CAST((p_x-x)*(n_y-y)-(p_y-y)*(n_x-x) AS DOUBLE), CAST((p_x-x)*(n_x-x)+(p_y-y)*(n_y-y) AS DOUBLE))))"
SEQ = "row_number() OVER (PARTITION BY poly_id, ring ORDER BY {})-1 AS seq"


@query("g01_bounding_boxes", "SELECT poly_id, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM poly_verts GROUP BY 1")
def _(spark, sf):
    return G.bounding_boxes(D.poly_verts(spark, sf), ["poly_id"])


@query("g02_ring_areas", f"WITH {V} {AREA}")
def _(spark, sf):
    return G.areas(D.poly_verts(spark, sf))


@query("g02_polygon_areas", f"WITH {V}, a AS ({AREA}) SELECT poly_id, CAST(sum(CASE WHEN ring=1 THEN -abs(area2) ELSE abs(area2) END) AS BIGINT) AS area2 FROM a GROUP BY 1")
def _(spark, sf):
    return G.polygon_areas(D.poly_verts(spark, sf))


@query("g03_min_angles", f"WITH {V} SELECT poly_id, ring, round(min({ANGLE}),6) AS min_angle FROM v GROUP BY 1,2")
def _(spark, sf):
    return G.min_angles(D.poly_verts(spark, sf))


@query("g04_snap", "SELECT poly_id, ring, seq, CAST(floor((2*x+32)/64.0) AS BIGINT)*32 AS x, CAST(floor((2*y+32)/64.0) AS BIGINT)*32 AS y FROM poly_verts")
def _(spark, sf):
    return G.snap(D.poly_verts(spark, sf), 32).select("poly_id", "ring", "seq", "x", "y")


@query("g05_rect_relation", "WITH b AS (SELECT poly_id, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM poly_verts GROUP BY 1) SELECT poly_id, min_x>=5000 AND max_x<=25000 AND min_y>=5000 AND max_y<=25000 AS inside, max_x>=5000 AND min_x<=25000 AND max_y>=5000 AND min_y<=25000 AS meets FROM b")
def _(spark, sf):
    return G.rect_relation(G.bounding_boxes(D.poly_verts(spark, sf), ["poly_id"]), 5000, 5000, 25000, 25000).select("poly_id", "inside", "meets")


@query("g06_remove_duplicates", f"WITH d AS (SELECT poly_id, ring, 2*seq AS seq, x, y, seq AS z FROM poly_verts UNION ALL SELECT poly_id, ring, 2*seq+1, x, y, seq+10 FROM poly_verts WHERE (poly_id+seq)%3=0 UNION ALL SELECT poly_id, ring, 99, x, y, 50 FROM poly_verts WHERE seq=0 AND poly_id%4=0), g AS (SELECT poly_id, ring, x, y, min(seq) AS s, max(z) AS z FROM d GROUP BY 1,2,3,4) SELECT poly_id, ring, {SEQ.format('s')}, x, y, z FROM g")
def _(spark, sf):
    v = D.poly_verts(spark, sf)
    d = v.selectExpr("poly_id", "ring", "2*seq AS seq", "x", "y", "seq AS z").unionByName(v.where("(poly_id+seq)%3=0").selectExpr("poly_id", "ring", "2*seq+1 AS seq", "x", "y", "seq+10 AS z")).unionByName(v.where("seq=0 AND poly_id%4=0").selectExpr("poly_id", "ring", "99 AS seq", "x", "y", "50 AS z"))
    return G.remove_duplicates(d)


@query("g07_drop_small", f"WITH {V}, a AS ({AREA}) SELECT p.poly_id, p.ring, p.seq, p.x, p.y FROM poly_verts p JOIN a USING (poly_id, ring) WHERE abs(area2) >= 1500000")
def _(spark, sf):
    return G.drop_small(D.poly_verts(spark, sf), 3, 1_500_000).select("poly_id", "ring", "seq", "x", "y")


@query("g08_split_cycles")
def _(spark, sf):
    v = D.poly_verts(spark, sf).where("ring=0").select("poly_id", "ring", "seq", "x", "y")
    mid = v.groupBy("poly_id", "ring").agg(F.floor(F.avg("x")).alias("x"), F.floor(F.avg("y")).alias("y"))
    knots = mid.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(3))))
    eight = v.withColumn("seq", F.col("seq") * 2 - F.when(F.col("seq") > 1, 0).otherwise(0)).unionByName(knots.select("poly_id", "ring", F.col("seq"), "x", "y"))
    return G.split_cycles(eight)


@query("g09_remove_spikes")
def _(spark, sf):
    v = D.poly_verts(spark, sf).where("ring=0").selectExpr("poly_id", "ring", "seq*3 AS seq", "x", "y")
    spike = v.where("seq=3").selectExpr("poly_id", "ring", "4 AS seq", "x+5000 AS x", "y").unionByName(v.where("seq=3").selectExpr("poly_id", "ring", "5 AS seq", "x", "y"))
    return G.remove_spikes(v.unionByName(spike))


@query("g10_slivers", f"WITH {V}, a AS ({AREA}), m AS (SELECT poly_id, ring, round(min({ANGLE}),6) AS g FROM v GROUP BY 1,2) SELECT poly_id, ring, (g<88.5 AND abs(area2)<2000000) OR abs(area2)<600000 AS sliver FROM a JOIN m USING (poly_id, ring) WHERE ring=0")
def _(spark, sf):
    return G.slivers(D.poly_verts(spark, sf), 88.5, 2_000_000, 600_000)


#: A mesh of unit cells whose sides coincide, for neighbours by shared edge.
def mesh_squares(spark, sf):
    c = D.table(spark, sf, "customer").selectExpr("c_custkey AS poly_id", "(c_custkey%12)*10 AS x0", "(c_custkey div 12)*10 AS y0")
    return c.selectExpr("poly_id", "0 AS ring", "posexplode(array(struct(x0 AS x, y0 AS y), struct(x0+10 AS x, y0 AS y), struct(x0+10 AS x, y0+10 AS y), struct(x0 AS x, y0+10 AS y))) AS (seq, p)").select("poly_id", "ring", "seq", "p.x", "p.y")


@query("g11_merge_targets", "SELECT c_custkey AS poly_id, CASE WHEN c_custkey>=12 THEN c_custkey-12 WHEN c_custkey%12>0 THEN c_custkey-1 WHEN c_custkey%12<11 THEN c_custkey+1 END AS into FROM customer WHERE c_custkey%5=0 AND c_custkey<(SELECT max(c_custkey) FROM customer)")
def _(spark, sf):
    m = mesh_squares(spark, sf)
    top = D.table(spark, sf, "customer").agg(F.max("c_custkey").alias("top"))
    small = m.crossJoin(F.broadcast(top)).where("poly_id%5=0 AND poly_id<top").select("poly_id").distinct()
    return G.merge_targets(m, small)


@query("g12_densify", f"WITH {V}, d AS (SELECT *, CASE WHEN sqrt(CAST((n_x-x)*(n_x-x)+(n_y-y)*(n_y-y) AS DOUBLE))>250 THEN CAST(floor(sqrt(CAST((n_x-x)*(n_x-x)+(n_y-y)*(n_y-y) AS DOUBLE))/250) AS BIGINT)+1 ELSE 1 END AS n FROM v), k AS (SELECT *, unnest(range(n)) AS k FROM d) SELECT poly_id, ring, {SEQ.format('seq, k')}, CAST(floor(x+(n_x-x)*k/CAST(n AS DOUBLE)+0.5) AS BIGINT) AS x, CAST(floor(y+(n_y-y)*k/CAST(n AS DOUBLE)+0.5) AS BIGINT) AS y FROM k")
def _(spark, sf):
    return G.densify(D.poly_verts(spark, sf), 250)


@query("g13_strip_holes", "SELECT poly_id, ring, seq, x, y FROM poly_verts WHERE NOT is_hole")
def _(spark, sf):
    return G.strip_holes(D.poly_verts(spark, sf)).select("poly_id", "ring", "seq", "x", "y")


@query("g14_remove_collinear", "SELECT poly_id, ring, seq, x, y FROM poly_verts WHERE ring=0")
def _(spark, sf):
    v = D.poly_verts(spark, sf).where("ring=0").select("poly_id", "ring", "seq", "x", "y")
    w = G.around(G.RING, "x", "y", df=v.selectExpr("poly_id", "ring", "seq*2 AS seq", "2*x AS x", "2*y AS y"), back=False)
    mid = w.selectExpr("poly_id", "ring", "seq+1 AS seq", "(x+n_x) div 2 AS x", "(y+n_y) div 2 AS y")
    both = w.select("poly_id", "ring", "seq", "x", "y").unionByName(mid)
    return G.remove_collinear(both).selectExpr("poly_id", "ring", "seq", "x div 2 AS x", "y div 2 AS y")


NODES = "nodes AS (SELECT DISTINCT x+(n_x-x)//4 AS x, y+(n_y-y)//4 AS y FROM v WHERE (n_x-x)%4=0 AND (n_y-y)%4=0 UNION SELECT DISTINCT x, y FROM poly_verts)"
ON = "(p.x-v.x)*(n_y-v.y)=(p.y-v.y)*(n_x-v.x) AND p.x BETWEEN least(v.x,n_x) AND greatest(v.x,n_x) AND p.y BETWEEN least(v.y,n_y) AND greatest(v.y,n_y)"


def edge_nodes(spark, sf):
    v = D.poly_verts(spark, sf)
    w = G.around(G.RING, "x", "y", df=v, back=False).where("(n_x-x)%4=0 AND (n_y-y)%4=0")
    return w.selectExpr("x+(n_x-x) div 4 AS x", "y+(n_y-y) div 4 AS y").unionByName(v.select("x", "y")).distinct()


@query("g15_insert_on_edges", f"WITH {V}, {NODES}, i AS (SELECT DISTINCT v.poly_id, v.ring, v.seq, (p.x-v.x)*(n_x-v.x)+(p.y-v.y)*(n_y-v.y) AS t, p.x, p.y FROM v, nodes p WHERE {ON} AND NOT (p.x=v.x AND p.y=v.y) AND NOT (p.x=n_x AND p.y=n_y) UNION ALL SELECT poly_id, ring, seq, 0, x, y FROM poly_verts) SELECT poly_id, ring, {SEQ.format('seq, t')}, x, y FROM i")
def _(spark, sf):
    return G.insert_on_edges(D.poly_verts(spark, sf), edge_nodes(spark, sf), 500)


@query("g16_inherit_elevation", f"WITH z AS (SELECT *, poly_id%50+seq*7 AS z FROM poly_verts), {around('z', 'v', cols=('x', 'y', 'z'))}, {NODES}, e AS (SELECT p.x, p.y, max(round(v.z + CAST((p.x-v.x)*(n_x-v.x)+(p.y-v.y)*(n_y-v.y) AS DOUBLE)/((n_x-v.x)*(n_x-v.x)+(n_y-v.y)*(n_y-v.y))*(n_z-v.z),6)) AS ze FROM v, nodes p WHERE {ON} GROUP BY 1,2), x AS (SELECT x, y, max(z) AS z FROM z GROUP BY 1,2) SELECT n.x, n.y, coalesce(x.z, ze) AS z FROM nodes n LEFT JOIN x USING (x, y) LEFT JOIN e USING (x, y)")
def _(spark, sf):
    z = D.poly_verts(spark, sf).selectExpr("*", "poly_id%50+seq*7 AS z")
    p = edge_nodes(spark, sf).withColumn("pt_id", F.struct("x", "y"))
    return G.inherit_elevation(p, z, 500).select("x", "y", "z")


@query("g17_point_squares", "SELECT pt_id, s.range AS seq, lon_as+CASE WHEN s.range IN (0,3) THEN -20 ELSE 20 END AS x, lat_as+CASE WHEN s.range<2 THEN -20 ELSE 20 END AS y FROM geo_points, range(4) s")
def _(spark, sf):
    return G.point_squares(D.geo_points(spark, sf).selectExpr("pt_id", "lon_as AS x", "lat_as AS y"), 40)


W_LINE = "WINDOW w AS (PARTITION BY line_id ORDER BY seq)"
DIST = "sqrt(CAST(({a}x-{b}x)*({a}x-{b}x)+({a}y-{b}y)*({a}y-{b}y) AS DOUBLE))"


def _moved(c: str) -> str:
    n, p = DIST.format(a="", b="n_"), DIST.format(a="", b="p_")
    return f"CASE WHEN p_x IS NULL AND n_x IS NOT NULL THEN CASE WHEN {n}>0 THEN {c}-(n_{c}-{c})/{n}*3.0 ELSE {c} END WHEN n_x IS NULL AND p_x IS NOT NULL THEN CASE WHEN {p}>0 THEN {c}-(p_{c}-{c})/{p}*3.0 ELSE {c} END ELSE {c} END"


@query("g18_prepare_line", f"""WITH v AS (SELECT *, lag(x) OVER w AS p_x, lag(y) OVER w AS p_y, lead(x) OVER w AS n_x, lead(y) OVER w AS n_y FROM track_points {W_LINE}), m AS (SELECT line_id, seq, width, CAST({_moved('x')} AS DOUBLE) AS x, CAST({_moved('y')} AS DOUBLE) AS y FROM v),
 m2 AS (SELECT *, lead(x) OVER w AS n_x, lead(y) OVER w AS n_y FROM m {W_LINE}), d AS (SELECT *, CASE WHEN n_x IS NULL THEN 1 ELSE CAST(floor({DIST.format(a='', b='n_')}/(width*1000)) AS BIGINT)+1 END AS n FROM m2), k AS (SELECT *, unnest(range(n)) AS k FROM d)
 SELECT line_id, row_number() OVER (PARTITION BY line_id ORDER BY seq, k)-1 AS seq, round(x+coalesce(n_x-x,0)*k/n,4) AS x, round(y+coalesce(n_y-y,0)*k/n,4) AS y FROM k""")
def _(spark, sf):
    return G.prepare_line(D.track_points(spark, sf), 3.0, 1000)


@query(
    "g19_line_quads",
    """WITH v AS (SELECT line_id, seq, x, y, width, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny
      FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)),
d AS (SELECT *, sqrt(CAST((x-px)*(x-px)+(y-py)*(y-py) AS DOUBLE)) AS d0, sqrt(CAST((nx-x)*(nx-x)+(ny-y)*(ny-y) AS DOUBLE)) AS d1 FROM v),
u AS (SELECT *, CASE WHEN d0>0 THEN (x-px)/d0 END AS a, CASE WHEN d0>0 THEN (y-py)/d0 END AS b, CASE WHEN d1>0 THEN (nx-x)/d1 END AS c, CASE WHEN d1>0 THEN (ny-y)/d1 END AS e FROM d),
f AS (SELECT *, coalesce(a,c) AS ix, coalesce(b,e) AS iy, coalesce(c,a) AS ox, coalesce(e,b) AS oy FROM u),
k AS (SELECT *, 1+ix*ox+iy*oy AS k FROM f),
m AS (SELECT *, CASE WHEN k>0.05 THEN -(iy+oy)/k ELSE -oy END AS mx, CASE WHEN k>0.05 THEN (ix+ox)/k ELSE ox END AS my FROM k),
o AS (SELECT line_id, seq, x+mx*(width/2) AS lx, y+my*(width/2) AS ly, x-mx*(width/2) AS rx, y-my*(width/2) AS ry FROM m),
q AS (SELECT *, lead(lx) OVER w AS n_lx, lead(ly) OVER w AS n_ly, lead(rx) OVER w AS n_rx, lead(ry) OVER w AS n_ry FROM o WINDOW w AS (PARTITION BY line_id ORDER BY seq))
SELECT line_id, seq, c.range AS corner, round(CASE c.range WHEN 0 THEN rx WHEN 1 THEN n_rx WHEN 2 THEN n_lx ELSE lx END, 4) AS x,
       round(CASE c.range WHEN 0 THEN ry WHEN 1 THEN n_ry WHEN 2 THEN n_ly ELSE ly END, 4) AS y FROM q, range(4) c WHERE n_lx IS NOT NULL""",
)
def _(spark, sf):
    return G.line_quads(D.track_points(spark, sf))


@query("g20_offset_ring", f"WITH {V}, u AS (SELECT *, (x-p_x)/{DIST.format(a='', b='p_')} AS ax, (y-p_y)/{DIST.format(a='', b='p_')} AS ay, (n_x-x)/{DIST.format(a='', b='n_')} AS bx, (n_y-y)/{DIST.format(a='', b='n_')} AS by FROM v WHERE ring=0) SELECT poly_id, ring, seq, round(x+25.0*(ay+by)/(1+ax*bx+ay*by),4) AS x, round(y-25.0*(ax+bx)/(1+ax*bx+ay*by),4) AS y FROM u")
def _(spark, sf):
    return G.offset_ring(D.poly_verts(spark, sf).where("ring=0"), 25.0)


def clip_sql(src: str, keys: str, bounds: tuple[str, str, str, str], carry: str = "") -> str:
    """CTEs that clip src; the last is clipped."""
    out, carry = [], f", {carry}" if carry else ""
    for n, (axis, other, op, b) in enumerate((("x", "y", ">=", bounds[0]), ("x", "y", "<=", bounds[1]), ("y", "x", ">=", bounds[2]), ("y", "x", "<=", bounds[3]))):
        out.append(around(src, f"ca{n}", keys))
        out.append(f"cb{n} AS (SELECT *, {b} AS b, {axis} {op} {b} AS i, n_{axis} {op} {b} AS j FROM ca{n})")
        out.append(f"cc{n} AS (SELECT *, CAST(floor({other}+CAST((b-{axis})*(n_{other}-{other}) AS DOUBLE)/(n_{axis}-{axis})+0.5) AS BIGINT) AS o FROM cb{n} WHERE i OR j)")
        cut = {axis: "b", other: "o"}
        out.append(f"cd{n} AS (SELECT {keys}{carry}, seq AS s, 0 AS k, {cut['x']} AS x, {cut['y']} AS y FROM cc{n} WHERE i<>j UNION ALL SELECT {keys}{carry}, seq, 1, n_x, n_y FROM cc{n} WHERE j)")
        src = f"ce{n}"
        out.append(f"ce{n} AS (SELECT {keys}{carry}, x, y, row_number() OVER (PARTITION BY {keys} ORDER BY s, k)-1 AS seq FROM cd{n})")
    out.append(f"clipped AS (SELECT * FROM {src} QUALIFY count(*) OVER (PARTITION BY {keys}) >= 3)")
    return ", ".join(out)


@query("g21_clip_rect", f"WITH {clip_sql('poly_verts', 'poly_id, ring', ('8000', '22000', '6000', '27000'))} SELECT poly_id, ring, seq, x, y FROM clipped")
def _(spark, sf):
    return G.clip_rect(D.poly_verts(spark, sf), G.RING, tuple(F.lit(b) for b in (8000, 22000, 6000, 27000))).select("poly_id", "ring", "seq", "x", "y")


POLY_TILES = f"""pb AS (SELECT poly_id, min(x) AS w, min(y) AS s, max(x) AS e, max(y) AS n FROM poly_verts GROUP BY 1), pr AS (SELECT *, unnest(range(CAST(floor(s/450.0) AS BIGINT), CAST(floor(n/450.0) AS BIGINT)+1))*450 AS lat FROM pb),
 pw AS (SELECT *, ({sql_width8('lat')})*450 AS tw FROM pr), pc AS (SELECT *, unnest(range(CAST(floor(w/CAST(tw AS DOUBLE)) AS BIGINT), CAST(floor(e/CAST(tw AS DOUBLE)) AS BIGINT)+1))*tw AS lon FROM pw),
 pt AS (SELECT DISTINCT poly_id, {sql_tile_id('lon', 'lat')} AS tile FROM pc), pv AS (SELECT tile, poly_id, ring, seq, x, y FROM poly_verts JOIN pt USING (poly_id))"""
CHOPPED = f"{POLY_TILES}, pg AS (SELECT *, {sql_west('tile')} AS tw, {sql_west('tile')}+{sql_width('tile')} AS te, {sql_south('tile')} AS ts FROM pv), {clip_sql('pg', 'tile, poly_id, ring', ('tw', 'te', 'ts', 'ts+450'), 'tw, te, ts')}"


@query("g22_chop_to_tiles", f"WITH {CHOPPED} SELECT tile, poly_id, ring, seq, x, y FROM clipped")
def _(spark, sf):
    return G.chop_to_tiles(D.poly_verts(spark, sf)).select("tile", "poly_id", "ring", "seq", "x", "y")


@query("g23_interior_points", f"""WITH {V}, ys AS (SELECT poly_id, y, lead(y) OVER (PARTITION BY poly_id ORDER BY y)-y AS gap FROM (SELECT DISTINCT poly_id, y FROM poly_verts) d), l AS (SELECT poly_id, arg_min(2*y+gap, (-gap, y)) AS y2 FROM ys WHERE gap>0 GROUP BY 1),
 e AS (SELECT poly_id, y2, CAST(floor(2*x+CAST((y2-2*y)*(n_x-x) AS DOUBLE)/(n_y-y)+0.5) AS BIGINT) AS x2 FROM v JOIN l USING (poly_id) WHERE least(y,n_y)*2<y2 AND greatest(y,n_y)*2>y2), k AS (SELECT *, row_number() OVER (PARTITION BY poly_id ORDER BY x2) AS k, lead(x2) OVER (PARTITION BY poly_id ORDER BY x2) AS nx FROM e)
 SELECT poly_id, arg_min(CAST(floor((x2+nx)/2.0) AS BIGINT), (x2-nx, x2)) AS x2, min(y2) AS y2 FROM k WHERE k%2=1 AND nx IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return G.interior_points(D.poly_verts(spark, sf))


@query("g24_points_in_polygons", f"WITH {V}, p AS (SELECT event_id AS pt_id, (event_id*7919)%40000 AS px, (event_id*6007)%40000 AS py FROM events) SELECT pt_id, poly_id FROM p, v WHERE least(y,n_y)<=py AND py<greatest(y,n_y) AND CASE WHEN n_y>y THEN (px-x)*(n_y-y)-(py-y)*(n_x-x)<0 ELSE (px-x)*(n_y-y)-(py-y)*(n_x-x)>0 END GROUP BY 1,2 HAVING count(*)%2=1")
def _(spark, sf):
    return G.points_in_polygons(event_points(spark, sf), D.poly_verts(spark, sf), 100)


def event_points(spark, sf):
    return D.table(spark, sf, "events").selectExpr("event_id AS pt_id", "(event_id*7919)%40000 AS x", "(event_id*6007)%40000 AS y")


SEGS = "sg AS (SELECT line_id, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)), pr AS (SELECT a.line_id, a.seq, a.ax, a.ay, a.bx, a.by, b.ax AS cx, b.ay AS cy, b.bx AS dx, b.by AS dy FROM sg a JOIN sg b ON b.line_id=a.line_id AND b.seq=a.seq+2 WHERE a.bx IS NOT NULL AND b.bx IS NOT NULL)"
OR = "(({q}x-{p}x)*({r}y-{p}y)-({q}y-{p}y)*({r}x-{p}x))"


def _o(p, q, r):
    return OR.format(p=p, q=q, r=r)


CROSS = f"(sign({_o('a', 'b', 'c')})*sign({_o('a', 'b', 'd')})<0 AND sign({_o('c', 'd', 'a')})*sign({_o('c', 'd', 'b')})<0)"


def segments(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("line_id").orderBy("seq")
    return D.track_points(spark, sf).withColumns({"bx": F.lead("x").over(w), "by": F.lead("y").over(w)}).where("bx is not null").withColumnsRenamed({"x": "ax", "y": "ay"})


@query("g25_segment_relations", f"WITH {SEGS}, t AS (SELECT *, {CROSS} AS crosses, CAST({_o('c', 'd', 'a')} AS DOUBLE)/nullif({_o('c', 'd', 'a')}-{_o('c', 'd', 'b')},0) AS t FROM pr) SELECT line_id, seq, crosses, CASE WHEN crosses THEN round(ax+t*(bx-ax),4) END AS ix, CASE WHEN crosses THEN round(ay+t*(by-ay),4) END AS iy, {_o('a', 'b', 'c')}=0 AND cx BETWEEN least(ax,bx) AND greatest(ax,bx) AND cy BETWEEN least(ay,by) AND greatest(ay,by) AS on_edge FROM t")
def _(spark, sf):
    s = segments(spark, sf)
    b = s.selectExpr("line_id", "seq-2 AS seq", "ax AS cx", "ay AS cy", "bx AS dx", "by AS dy")
    pairs = s.select("line_id", "seq", "ax", "ay", "bx", "by").join(b, ["line_id", "seq"])
    return G.segment_relations(pairs).select("line_id", "seq", "crosses", "ix", "iy", "on_edge")


@query("g26_oriented_rect", "WITH p AS (SELECT c_custkey AS id, (c_custkey*31)%1000 AS x, (c_custkey*17)%1000 AS y, (c_custkey*7%360)::DOUBLE AS h, (50+c_custkey%90)::DOUBLE AS l, (10+c_custkey%20)::DOUBLE AS w FROM customer) SELECT id, s.range AS corner, round(x+CASE WHEN s.range IN (1,2) THEN 1 ELSE -1 END*w/2*cos(radians(h))+CASE WHEN s.range>1 THEN l ELSE 0.0 END*sin(radians(h)),4) AS cx, round(y+CASE WHEN s.range>1 THEN l ELSE 0.0 END*cos(radians(h))-CASE WHEN s.range IN (1,2) THEN 1 ELSE -1 END*w/2*sin(radians(h)),4) AS cy FROM p, range(4) s")
def _(spark, sf):
    p = D.table(spark, sf, "customer").selectExpr("c_custkey AS id", "(c_custkey*31)%1000 AS x", "(c_custkey*17)%1000 AS y", "cast(c_custkey*7%360 AS double) AS h", "cast(50+c_custkey%90 AS double) AS l", "cast(10+c_custkey%20 AS double) AS w")
    return G.oriented_rect(p, F.col("h"), F.col("l"), F.col("w")).select("id", "corner", "cx", "cy")


@query("g27_flatten_bezier", f"""WITH b AS (SELECT poly_id, ring, seq, x, y, CASE WHEN (poly_id+seq)%3=0 THEN x+40 END AS cx, CASE WHEN (poly_id+seq)%3=0 THEN y-30 END AS cy FROM poly_verts), {around('b', 'v', cols=('x', 'y', 'cx', 'cy'))},
 w AS (SELECT poly_id, ring, seq, x, y, cx, cy, lead(x) OVER w AS lx, lead(cx) OVER w AS lcx, lead(cy) OVER w AS lcy, first_value(cx) OVER w AS fcx, first_value(cy) OVER w AS fcy FROM b WINDOW w AS (PARTITION BY poly_id, ring ORDER BY seq)),
 q AS (SELECT v.poly_id, v.ring, v.seq, v.x, v.y, v.n_x, v.n_y, v.cx, v.cy, 2*v.n_x-v.n_cx AS mx, 2*v.n_y-v.n_cy AS my FROM v),
 n AS (SELECT *, cx IS NOT NULL OR mx IS NOT NULL AS cv, CASE WHEN cx IS NOT NULL AND mx IS NOT NULL THEN sqrt(((x-cx)^2+(y-cy)^2)::DOUBLE)+sqrt(((cx-mx)^2+(cy-my)^2)::DOUBLE)+sqrt(((mx-n_x)^2+(my-n_y)^2)::DOUBLE) WHEN cx IS NOT NULL OR mx IS NOT NULL THEN sqrt(((x-coalesce(cx,mx))^2+(y-coalesce(cy,my))^2)::DOUBLE)+sqrt(((coalesce(cx,mx)-n_x)^2+(coalesce(cy,my)-n_y)^2)::DOUBLE) ELSE sqrt(((x-n_x)^2+(y-n_y)^2)::DOUBLE) END AS d FROM q), s AS (SELECT *, CASE WHEN d<8 THEN CASE WHEN cv THEN CAST(floor(d) AS INT)+1 ELSE 1 END WHEN cv AND d<=800 THEN 8 ELSE CAST(floor(d/100) AS INT)+1 END AS n FROM n), k AS (SELECT *, unnest(range(n)) AS k FROM s), t AS (SELECT *, k/CAST(n AS DOUBLE) AS t FROM k)
 SELECT poly_id, ring, {SEQ.format('seq, k')}, CAST(floor((CASE WHEN NOT cv OR n=1 THEN x*(1-t)+n_x*t WHEN cx IS NOT NULL AND mx IS NOT NULL THEN x*(1-t)*(1-t)*(1-t)+cx*3*(1-t)*(1-t)*t+mx*3*(1-t)*t*t+n_x*t*t*t ELSE x*(1-t)*(1-t)+coalesce(cx,mx)*2*(1-t)*t+n_x*t*t END)*10000) AS BIGINT) AS x4,
 CAST(floor((CASE WHEN NOT cv OR n=1 THEN y*(1-t)+n_y*t WHEN cy IS NOT NULL AND my IS NOT NULL THEN y*(1-t)*(1-t)*(1-t)+cy*3*(1-t)*(1-t)*t+my*3*(1-t)*t*t+n_y*t*t*t ELSE y*(1-t)*(1-t)+coalesce(cy,my)*2*(1-t)*t+n_y*t*t END)*10000) AS BIGINT) AS y4 FROM t""".replace("lead(cx) OVER w AS lcx, lead(cy) OVER w AS lcy, ", ""))
def _(spark, sf):
    b = D.poly_verts(spark, sf).selectExpr("poly_id", "ring", "seq", "x", "y", "CASE WHEN (poly_id+seq)%3=0 THEN x+40 END AS cx", "CASE WHEN (poly_id+seq)%3=0 THEN y-30 END AS cy")
    return G.flatten_bezier(b, G.RING).select(*G.RING, "seq", *[F.floor(F.col(c) * 10000).alias(f"{c}4") for c in ("x", "y")])


@query("g28_arc", "WITH p AS (SELECT pt_id AS id, lon_as/3600.0::DOUBLE AS lon, lat_as/3600.0::DOUBLE AS lat, 1000.0+pt_id%50*100 AS r, (pt_id*13%360)::DOUBLE AS f, (pt_id*29%360)::DOUBLE AS t, pt_id%2=0 AS cw FROM geo_points), s AS (SELECT *, k.range AS seq, CASE WHEN cw THEN ((t-f)%360+360)%360 ELSE -(((f-t)%360+360)%360) END AS sw FROM p, range(73) k), a AS (SELECT id, seq, lon, lat, radians(f+sw*seq/72) AS az, r/6371008.8 AS d FROM s), b AS (SELECT *, asin(sin(radians(lat))*cos(d)+cos(radians(lat))*sin(d)*cos(az)) AS la2 FROM a) SELECT id, seq, round(degrees(radians(lon)+atan2(sin(az)*sin(d)*cos(radians(lat)), cos(d)-sin(radians(lat))*sin(la2))),6) AS plon, round(degrees(la2),6) AS plat FROM b")
def _(spark, sf):
    p = D.geo_points(spark, sf).selectExpr("pt_id AS id", "lon_as/3600.0D AS lon", "lat_as/3600.0D AS lat", "1000.0D+pt_id%50*100 AS radius_m", "cast(pt_id*13%360 AS double) AS from_deg", "cast(pt_id*29%360 AS double) AS to_deg", "pt_id%2=0 AS clockwise")
    return G.arc(p)


DENSE = f"WITH {V}, d AS (SELECT poly_id, ring, seq*2 AS seq, x, y FROM v UNION ALL SELECT poly_id, ring, seq*2+1, (x+n_x)//2+3, (y+n_y)//2 FROM v), {around('d', 'u')}"


@query("g29_thin", f"{DENSE} SELECT poly_id, ring, {SEQ.format('seq')}, x, y FROM u WHERE NOT abs((x-p_x)*(n_y-p_y)-(y-p_y)*(n_x-p_x)) < 2.5*sqrt(CAST((n_x-p_x)*(n_x-p_x)+(n_y-p_y)*(n_y-p_y) AS DOUBLE)) OR seq%2=0")
def _(spark, sf):
    v = G.around(G.RING, "x", "y", df=D.poly_verts(spark, sf), back=False)
    d = v.selectExpr("poly_id", "ring", "seq*2 AS seq", "x", "y").unionByName(v.selectExpr("poly_id", "ring", "seq*2+1 AS seq", "(x+n_x) div 2+3 AS x", "(y+n_y) div 2 AS y"))
    return G.thin(d, 2.5)


@query("g30_insert_crossings", f"""WITH {V}, s AS (SELECT line_id, 2*x AS cx, 2*y AS cy, 2*lead(x) OVER w AS dx, 2*lead(y) OVER w AS dy FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)), e AS (SELECT poly_id, ring, seq, x AS ax, y AS ay, n_x AS bx, n_y AS by FROM v),
 h AS (SELECT *, CAST({_o('c', 'd', 'a')} AS DOUBLE)/nullif({_o('c', 'd', 'a')}-{_o('c', 'd', 'b')},0) AS t FROM e, s WHERE dx IS NOT NULL AND {CROSS}), i AS (SELECT poly_id, ring, seq, round(ax+t*(bx-ax),4) AS ix, round(ay+t*(by-ay),4) AS iy, ax, ay FROM h),
 g AS (SELECT poly_id, ring, seq, CAST(floor(ix+0.5) AS BIGINT) AS x, CAST(floor(iy+0.5) AS BIGINT) AS y, min((ix-ax)*(ix-ax)+(iy-ay)*(iy-ay)) AS t FROM i GROUP BY 1,2,3,4,5), b AS (SELECT poly_id, ring, seq, x, y, -1.0 AS t FROM poly_verts UNION ALL SELECT * FROM g) SELECT poly_id, ring, {SEQ.format('seq, t')}, x, y FROM b""")
def _(spark, sf):
    s = segments(spark, sf).selectExpr("2*ax AS ax", "2*ay AS ay", "2*bx AS bx", "2*by AS by")
    return G.insert_crossings(D.poly_verts(spark, sf), s, 1000)
