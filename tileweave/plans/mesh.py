"""Queries of the node and mesh operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.functions.geo import sql_south, sql_tile_id, sql_west, sql_width
from tileweave.operators import mesh as N
from tileweave.operators.tiles import assign_tiles
from tileweave.plans.network import LOOSE, loose
from tileweave.plans.raster import GRID_POINTS, grid_points
from tileweave.plans.rings import CROSS, SEGS, _o, segments
from tileweave.registry import query
from tileweave.sources import derived as D

#: Faces of the grid, and vertices whose tiles touch: the last row of a tile is the first of the next.
FACES = """q AS (SELECT a.tile_no, a.col, a.row, a.elev AS a, b.elev AS b, c.elev AS c, d.elev AS d FROM grid_cells a JOIN grid_cells b ON b.tile_no=a.tile_no AND b.col=a.col+1 AND b.row=a.row JOIN grid_cells c ON c.tile_no=a.tile_no AND c.col=a.col AND c.row=a.row+1 JOIN grid_cells d ON d.tile_no=a.tile_no AND d.col=a.col+1 AND d.row=a.row+1 WHERE a.elev+b.elev+c.elev+d.elev IS NOT NULL),
 faces AS (SELECT tile_no, col, row, 0 AS half, col AS x1, row AS y1, a AS z1, col+1 AS x2, row AS y2, b AS z2, col+1 AS x3, row+1 AS y3, d AS z3 FROM q UNION ALL SELECT tile_no, col, row, 1, col, row, a, col+1, row+1, d, col, row+1, c FROM q)"""
VERTS = "gv AS (SELECT tile_no*4096+col*64+row AS v_id, tile_no, 10*col+(col+row)%3 AS x, 10*(tile_no*63+row)+(col*row)%3 AS y, elev AS z FROM grid_cells WHERE elev IS NOT NULL)"


def faces(spark, sf):
    return N.triangulate_grid(D.grid_cells(spark, sf))


def verts(spark, sf):
    return D.grid_cells(spark, sf).where("elev is not null").selectExpr("tile_no*4096+col*64+row AS v_id", "tile_no", "10*col+(col+row)%3 AS x", "10*(tile_no*63+row)+(col*row)%3 AS y", "elev AS z")


def node_faces(spark, sf):
    """(face_id, tile_no, n1, n2, n3) with grid nodes as ids."""
    n = lambda k: F.col("tile_no") * 4096 + F.col(f"x{k}") * 64 + F.col(f"y{k}")
    return faces(spark, sf).select((F.col("tile_no") * 8192 + F.col("col") * 128 + F.col("row") * 2 + F.col("half")).alias("face_id"), "tile_no", *[n(k).alias(f"n{k}") for k in (1, 2, 3)])


NF = ", nf AS (SELECT tile_no*8192+col*128+row*2+half AS face_id, tile_no, tile_no*4096+x1*64+y1 AS n1, tile_no*4096+x2*64+y2 AS n2, tile_no*4096+x3*64+y3 AS n3 FROM faces)"


@query("n01_unique_nodes", f"WITH {VERTS} SELECT CAST(floor((2*x+10)/20.0) AS BIGINT) AS kx, CAST(floor((2*y+10)/20.0) AS BIGINT) AS ky, min(v_id) AS node_id, arg_min(x, v_id) AS x, arg_min(y, v_id) AS y, arg_min(z, v_id) AS z FROM gv GROUP BY 1,2")
def _(spark, sf):
    return N.unique_nodes(verts(spark, sf), 10)


@query("n02_attach_nodes", f"WITH {VERTS} SELECT v_id, min(v_id) OVER (PARTITION BY floor((2*x+10)/20.0), floor((2*y+10)/20.0)) AS node_id FROM gv")
def _(spark, sf):
    v = verts(spark, sf)
    return N.attach_nodes(v, N.unique_nodes(v, 10), 10).select("v_id", "node_id")


@query("n03_nodes_in_rects", f"WITH {VERTS}, r AS (SELECT c_custkey AS rect_id, (c_custkey*37)%600 AS w, (c_custkey*53)%4000 AS s FROM customer) SELECT rect_id, v_id AS node_id FROM gv, r WHERE x BETWEEN w AND w+25 AND y BETWEEN s AND s+35")
def _(spark, sf):
    r = D.table(spark, sf, "customer").selectExpr("c_custkey AS rect_id", "(c_custkey*37)%600 AS w", "(c_custkey*53)%4000 AS s").selectExpr("*", "w+25 AS e", "s+35 AS n")
    return N.nodes_in_rects(verts(spark, sf).withColumnRenamed("v_id", "node_id"), r, 40)


@query("n04_border_nodes", "WITH b AS (SELECT tile_no*4096+col*64+row AS node_id, col, row FROM grid_cells) SELECT node_id, unnest(list_filter([CASE WHEN row=63 THEN 'N' END, CASE WHEN row=0 THEN 'S' END, CASE WHEN col=63 THEN 'E' END, CASE WHEN col=0 THEN 'W' END], lambda s: s IS NOT NULL)) AS side FROM b")
def _(spark, sf):
    b = D.grid_cells(spark, sf).selectExpr("tile_no*4096+col*64+row AS node_id", "col AS x", "row AS y", "0 AS w", "0 AS s", "63 AS e", "63 AS n")
    return N.border_nodes(b).select("node_id", "side")


@query("n05_used_nodes", f"WITH {FACES}{NF}, u AS (SELECT n1 AS n FROM nf UNION SELECT n2 FROM nf UNION SELECT n3 FROM nf) SELECT tile_no*4096+col*64+row AS node_id, row_number() OVER (PARTITION BY tile_no ORDER BY col*64+row)-1 AS new_id FROM grid_cells WHERE tile_no*4096+col*64+row IN (SELECT n FROM u)")
def _(spark, sf):
    n = D.grid_cells(spark, sf).selectExpr("tile_no*4096+col*64+row AS node_id", "tile_no")
    return N.used_nodes(n, node_faces(spark, sf), "tile_no").select("node_id", "new_id")


def sides(spark, sf):
    e = D.table(spark, sf, "events").selectExpr("user_id AS border", "(event_id*7919)%5000 AS pos", "event_id%2 AS side", "event_id%3=0 AS shared")
    own = e.where("side=0 OR shared").select("border", "pos")
    other = e.where("side=1 OR shared").selectExpr("border", "CASE WHEN shared THEN pos ELSE pos+1 END AS pos")
    return own, other


MATCH = """e AS (SELECT user_id AS border, (event_id*7919)%5000 AS pos, event_id%2 AS side, event_id%3=0 AS shared FROM events), a AS (SELECT border, pos//4 AS k, min(pos) AS pa FROM e WHERE side=0 OR shared GROUP BY 1,2), b AS (SELECT border, (CASE WHEN shared THEN pos ELSE pos+1 END)//4 AS k, min(CASE WHEN shared THEN pos ELSE pos+1 END) AS pb FROM e WHERE side=1 OR shared GROUP BY 1,2),
 j AS (SELECT border, k, pa, pb FROM a FULL JOIN b USING (border, k)), l AS (SELECT border, coalesce(pa,pb) AS pos, pb IS NULL AS mine FROM j WHERE pa IS NULL OR pb IS NULL),
 d AS (SELECT *, pos-lag(pos) OVER w AS bd, lag(mine) OVER w AS bm, lead(pos) OVER w-pos AS fd, lead(mine) OVER w AS fm FROM l WINDOW w AS (PARTITION BY border ORDER BY pos, mine)), o AS (SELECT *, coalesce(bm<>mine AND bd<=40, false) AS ob, coalesce(fm<>mine AND fd<=40, false) AS ob2 FROM d),
 w AS (SELECT *, CASE WHEN ob AND (NOT ob2 OR bd<=fd) THEN -1 WHEN ob2 THEN 1 ELSE 0 END AS want FROM o), p AS (SELECT *, lead(want) OVER w AS nw, lag(want) OVER w AS pw, lead(pos) OVER w AS np FROM w WINDOW w AS (PARTITION BY border ORDER BY pos, mine))
 SELECT border, 2*least(pa,pb) AS pos2, 'both' AS kind FROM j WHERE pa IS NOT NULL AND pb IS NOT NULL UNION ALL SELECT border, CASE WHEN want=1 AND nw=-1 THEN pos+np ELSE 2*pos END, CASE WHEN want=1 AND nw=-1 THEN 'merged' WHEN mine THEN 'current' ELSE 'neighbor' END FROM p WHERE NOT coalesce(want=-1 AND pw=1, false)"""


@query("n06_match_edges", f"WITH {MATCH}")
def _(spark, sf):
    return N.match_edges(*sides(spark, sf), same=4, close=40)


@query("n07_snap_to_border", "WITH e AS (SELECT event_id AS node_id, user_id AS border, (event_id*7919)%5000 AS pos FROM events), f AS (SELECT border, pos FROM e WHERE node_id%4=0), r AS (SELECT e.node_id, e.border, f.pos, row_number() OVER (PARTITION BY e.node_id ORDER BY abs(e.pos-f.pos), f.pos) AS k FROM e JOIN f USING (border) WHERE e.node_id%4<>0) SELECT node_id, border, pos FROM r WHERE k=1")
def _(spark, sf):
    e = D.table(spark, sf, "events").selectExpr("event_id AS node_id", "user_id AS border", "(event_id*7919)%5000 AS pos")
    return N.snap_to_border(e.where("node_id%4<>0"), e.where("node_id%4=0")).where("pos is not null")


@query("n08_share_elevations", f"WITH {VERTS}, g AS (SELECT v_id AS node_id, x//10 AS x, y//10 AS y, z, v_id%11=0 AS fixed FROM gv) SELECT node_id, CASE WHEN fixed THEN z ELSE round(avg(z) OVER (PARTITION BY x, y),6) END AS z FROM g")
def _(spark, sf):
    v = verts(spark, sf).selectExpr("v_id AS node_id", "x div 10 AS x", "y div 10 AS y", "z", "v_id%11=0 AS fixed")
    return N.share_elevations(v).select("node_id", "z")


@query("n09_faces_of_nodes", f"WITH {FACES}{NF}, x AS (SELECT face_id, unnest([n1,n2,n3]) AS node_id FROM nf) SELECT node_id, count(*) AS n_faces, min(face_id) AS first_face FROM x GROUP BY 1")
def _(spark, sf):
    return N.faces_of_nodes(node_faces(spark, sf)).drop("face_ids")


@query("n10_to_cartesian", "WITH p AS (SELECT pt_id, radians(lon_as/3600.0::DOUBLE) AS lo, radians(lat_as/3600.0::DOUBLE) AS la, (pt_id%300)::DOUBLE AS z FROM geo_points), n AS (SELECT *, 6378137.0::DOUBLE/sqrt(1-6.69437999014e-3*sin(la)*sin(la)) AS n FROM p) SELECT pt_id, round((n+z)*cos(la)*cos(lo),3) AS cx, round((n+z)*cos(la)*sin(lo),3) AS cy, round((n*(1-6.69437999014e-3)+z)*sin(la),3) AS cz FROM n")
def _(spark, sf):
    p = D.geo_points(spark, sf).selectExpr("pt_id", "lon_as/3600.0D AS lon", "lat_as/3600.0D AS lat", "cast(pt_id%300 AS double) AS z")
    return N.to_cartesian(p).select("pt_id", *[F.round(c, 3).alias(c) for c in ("cx", "cy", "cz")])


NORMALS = "c AS (SELECT *, (y2-y1)*(z3-z1)-(z2-z1)*(y3-y1) AS cx, (z2-z1)*(x3-x1)-(x2-x1)*(z3-z1) AS cy, (x2-x1)*(y3-y1)-(y2-y1)*(x3-x1) AS cz FROM faces), fn AS (SELECT *, sqrt(CAST(cx*cx+cy*cy+cz*cz AS DOUBLE))/2 AS area FROM c), nn AS (SELECT *, cx/(2*area) AS nx, cy/(2*area) AS ny, cz/(2*area) AS nz FROM fn)"


@query("n11_face_normals", f"WITH {FACES}, {NORMALS} SELECT tile_no, col, row, half, round(area,6) AS area, round(nx,6) AS nx, round(ny,6) AS ny, round(nz,6) AS nz FROM nn")
def _(spark, sf):
    return N.face_normals(faces(spark, sf)).select("tile_no", "col", "row", "half", *[F.round(c, 6).alias(c) for c in ("area", "nx", "ny", "nz")])


@query("n12_node_normals", f"WITH {FACES}, {NORMALS}, v AS (SELECT x1 AS x, tile_no*63+y1 AS y, area, nx, ny, nz FROM nn UNION ALL SELECT x2, tile_no*63+y2, area, nx, ny, nz FROM nn UNION ALL SELECT x3, tile_no*63+y3, area, nx, ny, nz FROM nn) SELECT x, y, round(sum(nx*area)/sum(area),6) AS nx, round(sum(ny*area)/sum(area),6) AS ny, round(sum(nz*area)/sum(area),6) AS nz FROM v GROUP BY 1,2")
def _(spark, sf):
    f = N.face_normals(faces(spark, sf)).withColumns({f"y{k}": F.col("tile_no") * 63 + F.col(f"y{k}") for k in (1, 2, 3)})
    return N.node_normals(f)


@query("n13_elevation_by_type", "WITH n AS (SELECT c_custkey AS node_id, CASE c_custkey%4 WHEN 0 THEN 'fixed' WHEN 1 THEN 'interpolated' WHEN 2 THEN 'smoothed' ELSE 'draped' END AS kind, c_custkey*10 AS z FROM customer) SELECT node_id, kind, CASE kind WHEN 'fixed' THEN z WHEN 'interpolated' THEN CASE WHEN node_id%3<>0 THEN node_id+1 END WHEN 'smoothed' THEN node_id+2 ELSE node_id+3 END AS z FROM n")
def _(spark, sf):
    n = D.table(spark, sf, "customer").selectExpr("c_custkey AS node_id", "CASE c_custkey%4 WHEN 0 THEN 'fixed' WHEN 1 THEN 'interpolated' WHEN 2 THEN 'smoothed' ELSE 'draped' END AS kind", "c_custkey*10 AS z")
    return N.elevation_by_type(n, n.where("node_id%3<>0").selectExpr("node_id", "node_id+1 AS z"), n.selectExpr("node_id", "node_id+2 AS z"), n.selectExpr("node_id", "node_id+3 AS z"))


@query("n14_drape", f"WITH {FACES}, {GRID_POINTS}, h AS (SELECT pt_id, col, row, half, z1, z2, z3, (x3-x2)*(y-10*y2)-(y3-y2)*(x-10*x2) AS u, (x1-x3)*(y-10*y3)-(y1-y3)*(x-10*x3) AS v, (x2-x1)*(y-10*y1)-(y2-y1)*(x-10*x1) AS w FROM grid_points JOIN faces USING (tile_no) WHERE x BETWEEN 10*col AND 10*col+10 AND y BETWEEN 10*row AND 10*row+10), b AS (SELECT pt_id, arg_min((u*z1+v*z2+w*z3)/CAST(u+v+w AS DOUBLE)+0.01, (col,row,half)) AS z FROM h WHERE u>=0 AND v>=0 AND w>=0 GROUP BY 1) SELECT pt_id, round(z,6) AS z FROM grid_points LEFT JOIN b USING (pt_id)")
def _(spark, sf):
    return N.drape(grid_points(spark, sf), faces(spark, sf)).select("pt_id", "z")


KIND = "CASE (col//8+row//8)%5 WHEN 0 THEN 'ocean' WHEN 1 THEN 'lake' WHEN 2 THEN 'stream' WHEN 3 THEN 'road' ELSE 'land' END"


@query("n15_flatten", f"""WITH {FACES}, k AS (SELECT *, {KIND} AS kind, least(z1,z2,z3) AS low FROM faces), b AS (SELECT *, CASE WHEN low=z1 THEN x1 WHEN low=z2 THEN x2 ELSE x3 END AS bx, CASE WHEN low=z1 THEN y1 WHEN low=z2 THEN y2 ELSE y3 END AS yb FROM k),
 v AS (SELECT tile_no, kind, low, bx, yb, x1 AS x, y1 AS y, z1 AS z FROM b UNION ALL SELECT tile_no, kind, low, bx, yb, x2, y2, z2 FROM b UNION ALL SELECT tile_no, kind, low, bx, yb, x3, y3, z3 FROM b)
 SELECT x, tile_no*63+y AS y, round(min(CASE kind WHEN 'ocean' THEN 0.0 WHEN 'lake' THEN low WHEN 'stream' THEN least(z, low+sqrt(CAST((x-bx)*(x-bx)+(y-yb)*(y-yb) AS DOUBLE))*20/100) WHEN 'road' THEN least(z, low+sqrt(CAST((x-bx)*(x-bx)+(y-yb)*(y-yb) AS DOUBLE))*30/100) ELSE z END),6) AS z FROM v GROUP BY 1,2""")
def _(spark, sf):
    f = faces(spark, sf).withColumn("kind", F.expr(KIND.replace("//", " div "))).withColumns({f"y{k}": F.col("tile_no") * 63 + F.col(f"y{k}") for k in (1, 2, 3)})
    return N.flatten(f)


@query("n16_move_to_edges", f"WITH {SEGS}, e AS (SELECT line_id*100000+seq AS edge_id, ax, ay, bx, by FROM sg WHERE bx IS NOT NULL), p AS (SELECT c_custkey AS pt_id, (c_custkey*7919)%20000 AS x, (c_custkey*6007)%20000 AS y FROM customer), t AS (SELECT *, least(greatest(CAST((x-ax)*(bx-ax)+(y-ay)*(by-ay) AS DOUBLE)/greatest((bx-ax)*(bx-ax)+(by-ay)*(by-ay),1),0.0),1.0) AS t FROM p, e), q AS (SELECT *, ax+t*(bx-ax) AS qx, ay+t*(by-ay) AS qy FROM t), d AS (SELECT *, round(sqrt((qx-x)*(qx-x)+(qy-y)*(qy-y)),6) AS d FROM q), r AS (SELECT *, row_number() OVER (PARTITION BY pt_id ORDER BY d, edge_id) AS k FROM d WHERE d<=60) SELECT p.pt_id, r.edge_id, round(coalesce(qx,p.x),4) AS x, round(coalesce(qy,p.y),4) AS y FROM p LEFT JOIN r ON r.pt_id=p.pt_id AND k=1")
def _(spark, sf):
    e = segments(spark, sf).selectExpr("line_id*100000+seq AS edge_id", "ax", "ay", "bx", "by")
    p = D.table(spark, sf, "customer").selectExpr("c_custkey AS pt_id", "(c_custkey*7919)%20000 AS x", "(c_custkey*6007)%20000 AS y")
    return N.move_to_edges(p, e, 1000, 60)


def cluster_input(spark, sf):
    return D.table(spark, sf, "events").selectExpr("event_id AS node_id", "(event_id*7919)%20000 AS x", "(event_id*6007)%20000 AS y", "event_id%50=0 AS fixed")


@query("n17_cluster_nodes")
def _(spark, sf):
    return N.cluster_nodes(cluster_input(spark, sf), 60)


@query("n18_remap_edges", "WITH e AS (SELECT DISTINCT l_partkey%97 AS a, l_suppkey%89 AS b FROM lineitem) SELECT DISTINCT least(a//3,b//3) AS a, greatest(a//3,b//3) AS b FROM e WHERE a//3<>b//3")
def _(spark, sf):
    e = D.table(spark, sf, "lineitem").selectExpr("l_partkey%97 AS a", "l_suppkey%89 AS b").distinct()
    c = spark.range(100).selectExpr("id AS node_id", "id div 3 AS cluster")
    return N.remap_edges(e, c)


@query("n19_snap_round")
def _(spark, sf):
    return N.snap_round(D.poly_verts(spark, sf).select("poly_id", "ring", "seq", "x", "y"), 50, ["poly_id", "ring"])


#: Net of LOOSE on pixels of 16: ends and crossings are hot, and ways are led through hot pixels until nothing moves.
_FD = lambda a, b: f"(({a})-((({a})%({b}))+({b}))%({b}))//({b})"
_IN = lambda c: f"if(b{c}>a{c}, 2*p*k{c}-p-2*a{c}, 2*a{c}-2*p*k{c}-p)"
_OUT = lambda c: f"if(b{c}>a{c}, 2*p*k{c}+p-2*a{c}, 2*a{c}-2*p*k{c}+p)"
_ORDER = lambda c, d: f"({_IN(c)}*abs(b{d}-a{d}) < {_OUT(d)}*abs(b{c}-a{c}) OR ({_IN(c)}*abs(b{d}-a{d}) = {_OUT(d)}*abs(b{c}-a{c}) AND b{c}>a{c} AND b{d}<a{d}))"
_MET = " AND ".join(f"2*greatest(a{c},b{c}) >= 2*p*k{c}-p AND 2*least(a{c},b{c}) < 2*p*k{c}+p" for c in "xy") + f" AND (ax=bx OR ay=by OR ({_ORDER('x', 'y')} AND {_ORDER('y', 'x')}))"
_HERE = lambda c: f"unnest(range(CAST(floor((least(a{c},b{c})/p-1)/16.0) AS BIGINT), CAST(floor((greatest(a{c},b{c})/p+1)/16.0) AS BIGINT)+1)) AS g{c}"


@query(
    "n19_snap_segments",
    f"""WITH RECURSIVE net AS ({LOOSE}),
nc AS (SELECT *, unnest(range(CAST(floor(least(ay,by)/200.0) AS BIGINT), CAST(floor(greatest(ay,by)/200.0) AS BIGINT)+1)) AS gy FROM (SELECT *, unnest(range(CAST(floor(least(ax,bx)/200.0) AS BIGINT), CAST(floor(greatest(ax,bx)/200.0) AS BIGINT)+1)) AS gx FROM net)),
pr AS (SELECT DISTINCT a.seg_id, a.ax, a.ay, a.bx, a.by, b.seg_id AS o, b.ax AS cx, b.ay AS cy, b.bx AS dx, b.by AS dy FROM nc a JOIN nc b ON a.gx=b.gx AND a.gy=b.gy AND a.seg_id<b.seg_id),
cr AS (SELECT *, {_o('c', 'd', 'a')} AS oa, {_o('c', 'd', 'a')}-{_o('c', 'd', 'b')} AS od FROM pr WHERE {CROSS}),
cn AS (SELECT *, CASE WHEN od<0 THEN -oa ELSE oa END AS num, abs(od) AS den FROM cr),
hot AS (SELECT {_FD('2*num*(bx-ax)+(2*ax+16)*den', '32*den')} AS kx, {_FD('2*num*(by-ay)+(2*ay+16)*den', '32*den')} AS ky FROM cn UNION SELECT CAST(floor((2*ax+16)/32.0) AS BIGINT), CAST(floor((2*ay+16)/32.0) AS BIGINT) FROM net UNION SELECT CAST(floor((2*bx+16)/32.0) AS BIGINT), CAST(floor((2*by+16)/32.0) AS BIGINT) FROM net),
hc AS (SELECT *, CAST(floor(kx/16.0) AS BIGINT) AS gx, CAST(floor(ky/16.0) AS BIGINT) AS gy FROM hot),
r AS (SELECT seg_id, CAST([] AS BIGINT[]) AS path, ax, ay, bx, by, 16 AS p FROM net
 UNION ALL SELECT seg_id, list_append(path, k), kx, ky, nx, ny, 1 FROM (
  SELECT seg_id, path, p, kx, ky, row_number() OVER w AS k, lead(kx) OVER w AS nx, lead(ky) OVER w AS ny, count(*) OVER (PARTITION BY seg_id, path) AS n
  FROM (SELECT *, {_HERE('y')} FROM (SELECT *, {_HERE('x')} FROM r)) e JOIN hc USING (gx, gy) WHERE {_MET}
  WINDOW w AS (PARTITION BY seg_id, path ORDER BY CAST(sign(bx-ax) AS BIGINT)*kx+CAST(sign(by-ay) AS BIGINT)*ky)) s WHERE nx IS NOT NULL AND (n>2 OR p>1)),
leaf AS (SELECT * FROM r WHERE p=1 AND NOT EXISTS (SELECT 1 FROM r c WHERE c.seg_id=r.seg_id AND c.path[1:len(c.path)-1]=r.path AND len(c.path)=len(r.path)+1))
SELECT seg_id, row_number() OVER (PARTITION BY seg_id ORDER BY path)-1 AS part, 16*ax AS ax, 16*ay AS ay, 16*bx AS bx, 16*by AS by FROM leaf""",
)
def _(spark, sf):
    return N.snap_round_segments(loose(spark, sf), 16, 256)


@query("n20_peel_antennas")
def _(spark, sf):
    return N.peel_antennas(D.table(spark, sf, "orders").selectExpr("o_custkey AS a", "1000000000+o_orderkey div 3 AS b"))


@query("n20_remove_antennas")
def _(spark, sf):
    return N.remove_antennas(D.table(spark, sf, "orders").selectExpr("o_custkey AS a", "1000000000+o_orderkey div 3 AS b"))


@query("n21_join_children", f"WITH {VERTS}, b AS (SELECT v_id, (v_id%64) IN (0,63) AS border, x//10 AS kx, y//10 AS ky FROM gv) SELECT v_id, CASE WHEN border THEN min(v_id) FILTER (border) OVER (PARTITION BY kx, ky) ELSE v_id END AS node FROM b")
def _(spark, sf):
    v = verts(spark, sf).selectExpr("v_id", "tile_no AS tile", "x", "y", "(v_id%64) IN (0,63) AS border")
    return N.join_children(v, 10).select("v_id", "node")


def _k(c: str, k: int) -> str:
    return f"CASE WHEN x{k} IN (0,63) OR y{k} IN (0,63) THEN {c}{k} ELSE {c}{k}//4*4 END AS {c}{k}"


@query("n22_simplify", f"WITH {FACES}, s AS (SELECT tile_no, {', '.join(_k(c, k) for k in (1, 2, 3) for c in 'xy')} FROM faces) SELECT DISTINCT * FROM s WHERE NOT (x1=x2 AND y1=y2) AND NOT (x2=x3 AND y2=y3) AND NOT (x1=x3 AND y1=y3)")
def _(spark, sf):
    return N.simplify(faces(spark, sf), 1 / 16, F.lit(False))


@query("n22_simplify_by_error")
def _(spark, sf):
    return N.simplify_by_error(faces(spark, sf), 1 / 8, 64, unit=90.0)


T = sql_tile_id("lon_as", "lat_as")


@query("n23_ocean_quads", f"WITH t AS (SELECT DISTINCT {T} AS tile FROM geo_points EXCEPT SELECT {T} FROM geo_points WHERE pt_id%2=0), b AS (SELECT tile, {sql_west('tile')} AS w, {sql_south('tile')} AS s, {sql_width('tile')} AS d FROM t) SELECT tile, c.range AS corner, CASE WHEN c.range IN (1,2) THEN w+d ELSE w END AS x, CASE WHEN c.range>1 THEN s+450 ELSE s END AS y FROM b, range(4) c")
def _(spark, sf):
    p = assign_tiles(D.geo_points(spark, sf))
    return N.ocean_quads(p.select("tile").distinct(), p.where("pt_id%2=0"))


@query("n24_triangulate_grid", f"WITH {FACES} SELECT * FROM faces")
def _(spark, sf):
    return faces(spark, sf)


@query("n25_texture_coords", "WITH p AS (SELECT c_custkey AS id, (c_custkey*31)%1000-300 AS dx, (c_custkey*17)%1000-200 AS dy, radians((c_custkey*7%360)::DOUBLE) AS h, (300+c_custkey%90)::DOUBLE AS l, (40+c_custkey%20)::DOUBLE AS w FROM customer) SELECT id, round(least(greatest((dx*sin(h)+dy*cos(h))/l,0.0),1.0),6) AS u, round((dx*cos(h)-dy*sin(h))/w,6) AS v FROM p")
def _(spark, sf):
    p = D.table(spark, sf, "customer").selectExpr("c_custkey AS id", "(c_custkey*31)%1000-300 AS dx", "(c_custkey*17)%1000-200 AS dy", "cast(c_custkey*7%360 AS double) AS h", "cast(300+c_custkey%90 AS double) AS l", "cast(40+c_custkey%20 AS double) AS w")
    return N.texture_coords(p, F.col("h"), F.col("l"), F.col("w")).select("id", "u", "v")


@query("n26_dictionary", "SELECT o_orderkey, round(o_totalprice, -2) AS value, count(*) OVER (PARTITION BY round(o_totalprice, -2)) AS n FROM orders")
def _(spark, sf):
    from pyspark.sql import Window as W

    coded, values = N.dictionary_encode(D.table(spark, sf, "orders"), "o_totalprice", -2)
    return coded.select("o_orderkey", "code").join(values, "code").select("o_orderkey", "value", F.count("*").over(W.partitionBy("code")).alias("n"))
