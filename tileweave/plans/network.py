"""Queries of the segment-network operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.operators import mesh as N
from tileweave.operators import network as S
from tileweave.plans.rings import CROSS, _o
from tileweave.registry import query
from tileweave.sources import derived as D

#: Short segments of two lattices, so that ends meet, cross and dangle.
NET = "SELECT event_id AS seg_id, (event_id*7919)%400*10 AS ax, (event_id*6007)%400*10 AS ay, (event_id*7919)%400*10+(event_id%7-3)*10 AS bx, (event_id*6007)%400*10+(event_id%5-2)*15 AS by FROM events WHERE event_id%7<>3 OR event_id%5<>2"
#: Longer segments from places that don't repeat, so that some cross and most ends are loose.
LOOSE = "SELECT event_id AS seg_id, (event_id*7919)%4003*5 AS ax, (event_id*6007)%997*20 AS ay, (event_id*7919)%4003*5+(event_id%7-3)*40 AS bx, (event_id*6007)%997*20+(event_id%5-2)*60 AS by FROM events WHERE event_id%7<>3 OR event_id%5<>2"
HIT = f"t AS (SELECT a.*, b.seg_id AS o, b.ax AS cx, b.ay AS cy, b.bx AS dx, b.by AS dy FROM net a JOIN net b ON a.seg_id<>b.seg_id AND greatest(a.ax,a.bx)>=least(b.ax,b.bx) AND greatest(b.ax,b.bx)>=least(a.ax,a.bx)), h AS (SELECT *, CAST({_o('c', 'd', 'a')} AS DOUBLE)/nullif({_o('c', 'd', 'a')}-{_o('c', 'd', 'b')},0) AS t FROM t WHERE {CROSS})"


def net(spark, sf):
    return D.table(spark, sf, "events").where("event_id%7<>3 OR event_id%5<>2").selectExpr("event_id AS seg_id", "(event_id*7919)%400*10 AS ax", "(event_id*6007)%400*10 AS ay", "(event_id*7919)%400*10+(event_id%7-3)*10 AS bx", "(event_id*6007)%400*10+(event_id%5-2)*15 AS by")


def loose(spark, sf):
    return D.table(spark, sf, "events").where("event_id%7<>3 OR event_id%5<>2").selectExpr("event_id AS seg_id", "(event_id*7919)%4003*5 AS ax", "(event_id*6007)%997*20 AS ay", "(event_id*7919)%4003*5+(event_id%7-3)*40 AS bx", "(event_id*6007)%997*20+(event_id%5-2)*60 AS by")


@query("s01_segments", "SELECT * FROM (SELECT line_id, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by, width, kind FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)) s WHERE bx IS NOT NULL")
def _(spark, sf):
    return S.to_segments(D.track_points(spark, sf), ["width", "kind"])


@query("s02_split_at_crossings", f"""WITH net AS ({LOOSE}), {HIT}, c AS (SELECT DISTINCT seg_id, round(abs(round(ax+t*(bx-ax),4)-ax)+abs(round(ay+t*(by-ay),4)-ay),4) AS t, round(ax+t*(bx-ax),4) AS x, round(ay+t*(by-ay),4) AS y FROM h UNION ALL SELECT seg_id, 0, ax, ay FROM net UNION ALL SELECT seg_id, abs(bx-ax)+abs(by-ay), bx, by FROM net),
 p AS (SELECT seg_id, row_number() OVER w-1 AS part, x AS px, y AS py, lead(x) OVER w AS qx, lead(y) OVER w AS qy FROM c WINDOW w AS (PARTITION BY seg_id ORDER BY t, x, y)) SELECT * FROM p WHERE qx IS NOT NULL""")
def _(spark, sf):
    return S.split_at_crossings(loose(spark, sf), 200)


@query("s03_node_degrees", "WITH e AS (SELECT o_custkey%211 AS src, 1000+o_orderkey%307 AS dst FROM orders), n AS (SELECT src AS node FROM e UNION ALL SELECT dst FROM e), d AS (SELECT node, count(*) AS degree FROM n GROUP BY 1) SELECT node, degree, CASE degree WHEN 1 THEN 'dangling' WHEN 2 THEN 'through' ELSE 'junction' END AS kind FROM d UNION ALL SELECT range, 0, 'isolated' FROM range(1500) WHERE range NOT IN (SELECT node FROM n)")
def _(spark, sf):
    e = D.table(spark, sf, "orders").selectExpr("o_custkey%211 AS src", "1000+o_orderkey%307 AS dst")
    lone = S.node_edges(spark.range(1500).withColumnRenamed("id", "node"), e)
    return S.node_degrees(e).unionByName(lone.select("node", F.lit(0).cast("long").alias("degree"), F.lit("isolated").alias("kind")))


@query("s04_cluster_network")
def _(spark, sf):
    s = net(spark, sf)
    ends = s.select(F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("p")).select("p.*").distinct()
    ids = ends.select((F.col("x") * 100_000 + F.col("y")).alias("node_id"), "x", "y", F.lit(False).alias("fixed"))
    c = N.cluster_nodes(ids, 12)
    return N.remap_edges(s.selectExpr("ax*100000+ay AS a", "bx*100000+by AS b"), c)


ENDS = "pt AS (SELECT ax AS x, ay AS y FROM net UNION ALL SELECT bx, by FROM net), dg AS (SELECT x, y, count(*) AS d FROM pt GROUP BY 1,2), loose AS (SELECT seg_id, bx AS x, by AS y, ax AS hx, ay AS hy FROM net JOIN dg ON x=bx AND y=by WHERE d=1 UNION ALL SELECT seg_id, ax, ay, bx, by FROM net JOIN dg ON x=ax AND y=ay WHERE d=1), nb AS (SELECT l.*, n.seg_id AS o, n.ax AS cx, n.ay AS cy, n.bx AS dx, n.by AS dy FROM loose l JOIN net n ON n.seg_id<>l.seg_id)"


@query("s05_drop_dangling", f"WITH net AS ({LOOSE}), {ENDS}, f AS (SELECT *, least(greatest(CAST((x-cx)*(dx-cx)+(y-cy)*(dy-cy) AS DOUBLE)/greatest((dx-cx)*(dx-cx)+(dy-cy)*(dy-cy),1),0.0),1.0) AS t FROM nb), g AS (SELECT DISTINCT seg_id FROM f WHERE (cx+t*(dx-cx)-x)*(cx+t*(dx-cx)-x)+(cy+t*(dy-cy)-y)*(cy+t*(dy-cy)-y) <= 900) SELECT seg_id FROM net WHERE seg_id NOT IN (SELECT seg_id FROM g)")
def _(spark, sf):
    return S.drop_dangling(loose(spark, sf), 200, 30).select("seg_id")


@query("s06_extend_dangling", f"WITH net AS ({LOOSE}), {ENDS}, r AS (SELECT *, CAST((cx-x)*(dy-cy)-(cy-y)*(dx-cx) AS DOUBLE)/nullif((x-hx)*(dy-cy)-(y-hy)*(dx-cx),0) AS t, CAST((cx-x)*(y-hy)-(cy-y)*(x-hx) AS DOUBLE)/nullif((x-hx)*(dy-cy)-(y-hy)*(dx-cx),0) AS u FROM nb), d AS (SELECT *, round(t*sqrt(CAST((x-hx)*(x-hx)+(y-hy)*(y-hy) AS DOUBLE)),6) AS d FROM r WHERE t>0 AND u>=0 AND u<=1), k AS (SELECT *, row_number() OVER (PARTITION BY seg_id, x, y ORDER BY d, o) AS k FROM d WHERE d<=150) SELECT l.seg_id, l.x, l.y, round(l.x+t*(l.x-l.hx),4) AS tx, round(l.y+t*(l.y-l.hy),4) AS ty, k.o AS hit FROM loose l LEFT JOIN k ON k.seg_id=l.seg_id AND k.x=l.x AND k.y=l.y AND k=1")
def _(spark, sf):
    return S.extend_dangling(loose(spark, sf), 200, 150)


@query("s07_contract_short", "WITH net AS (" + NET + """), pt AS (SELECT ax AS x, ay AS y FROM net UNION ALL SELECT bx, by FROM net), dg AS (SELECT x, y, count(*) AS d FROM pt GROUP BY 1,2), s AS (SELECT n.*, a.d AS da, b.d AS db FROM net n JOIN dg a ON a.x=ax AND a.y=ay JOIN dg b ON b.x=bx AND b.y=by WHERE (bx-ax)*(bx-ax)+(by-ay)*(by-ay)<625 AND a.d>1 AND b.d>1),
 m AS (SELECT seg_id, CASE WHEN da<db THEN ax ELSE bx END AS fx, CASE WHEN da<db THEN ay ELSE by END AS fy, CASE WHEN da<db THEN bx ELSE ax END AS tx, CASE WHEN da<db THEN by ELSE ay END AS ty FROM s), m1 AS (SELECT fx, fy, arg_min(tx, seg_id) AS tx, arg_min(ty, seg_id) AS ty FROM m GROUP BY 1,2),
 r AS (SELECT seg_id, coalesce(a.tx,ax) AS ax, coalesce(a.ty,ay) AS ay, coalesce(b.tx,bx) AS bx, coalesce(b.ty,by) AS by FROM net LEFT JOIN m1 a ON a.fx=ax AND a.fy=ay LEFT JOIN m1 b ON b.fx=bx AND b.fy=by) SELECT * FROM r WHERE ax<>bx OR ay<>by""")
def _(spark, sf):
    return S.contract_short(net(spark, sf), 25)


#: A lattice with repeated and opposite segments.
LAT = "SELECT event_id AS seg_id, event_id%17 AS ax, event_id%13 AS ay, (event_id*3)%17 AS bx, (event_id*5)%13 AS by, 1+event_id%4 AS width, event_type AS kind, event_id%9 AS z_order, event_id*37%360 AS heading FROM events"


@query("s08_merge_coincident", f"WITH l AS ({LAT}), o AS (SELECT *, (ax>bx OR (ax=bx AND ay>by)) AS rev FROM l WHERE ax<>bx OR ay<>by) SELECT CASE WHEN rev THEN bx ELSE ax END AS px, CASE WHEN rev THEN by ELSE ay END AS py, CASE WHEN rev THEN ax ELSE bx END AS qx, CASE WHEN rev THEN ay ELSE by END AS qy, max(width) AS width, max(kind) AS kind, max(z_order) AS z_order, round(avg(CASE WHEN rev THEN (heading+180)%360 ELSE heading END),6) AS heading, count(*) AS n FROM o GROUP BY 1,2,3,4")
def _(spark, sf):
    s = D.table(spark, sf, "events").selectExpr("event_id AS seg_id", "event_id%17 AS ax", "event_id%13 AS ay", "(event_id*3)%17 AS bx", "(event_id*5)%13 AS by", "1+event_id%4 AS width", "event_type AS kind", "event_id%9 AS z_order", "event_id*37%360 AS heading")
    return S.merge_coincident(s)


@query("s09_style", "SELECT line_id, seq, CASE kind WHEN 'click' THEN 'Road' WHEN 'view' THEN 'Rail' END AS material, CASE kind WHEN 'click' THEN 10 WHEN 'view' THEN 25 END AS v_dist FROM track_points")
def _(spark, sf):
    styles = spark.createDataFrame([("click", "Road", 10), ("view", "Rail", 25)], "kind string, material string, v_dist int")
    return S.with_style(D.track_points(spark, sf), styles).select("line_id", "seq", "material", "v_dist")


@query("s10_running_distance", "WITH s AS (SELECT line_id, seq, coalesce(sqrt(CAST((x-lag(x) OVER w)*(x-lag(x) OVER w)+(y-lag(y) OVER w)*(y-lag(y) OVER w) AS DOUBLE)),0) AS s FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)) SELECT line_id, seq, round(sum(s) OVER (PARTITION BY line_id ORDER BY seq),3) AS dist, round(sum(s) OVER (PARTITION BY line_id)-sum(s) OVER (PARTITION BY line_id ORDER BY seq),3) AS left_over FROM s")
def _(spark, sf):
    d = S.running_distance(D.track_points(spark, sf))
    return d.select("line_id", "seq", F.round("dist", 3).alias("dist"), F.round("left", 3).alias("left_over"))


#: A segment from each event's place to the next one's, some left out, with branches: chains that pass from line to line.
WAYS = """SELECT event_id AS seg_id, (event_id*7919)%1000003 AS ax, (event_id*6007)%999983 AS ay,
       ((event_id+d)*7919)%1000003 AS bx, ((event_id+d)*6007)%999983 AS by, concat('k', event_id//400%2) AS kind
FROM (SELECT event_id, CASE WHEN event_id%61=60 THEN -59 WHEN event_id%173=0 THEN 20 ELSE 1 END AS d FROM events WHERE event_id%97<>13)"""


def ways(spark, sf):
    e = D.table(spark, sf, "events").where("event_id%97<>13").selectExpr("event_id", "CASE WHEN event_id%61=60 THEN -59 WHEN event_id%173=0 THEN 20 ELSE 1 END AS d")
    return e.selectExpr("event_id AS seg_id", "(event_id*7919)%1000003 AS ax", "(event_id*6007)%999983 AS ay", "((event_id+d)*7919)%1000003 AS bx", "((event_id+d)*6007)%999983 AS by", "concat('k', event_id div 400%2) AS kind")


@query(
    "s10_chain_distances",
    f"""WITH RECURSIVE ways AS ({WAYS}),
s AS (SELECT *, CAST(round(sqrt(CAST((bx-ax)*(bx-ax)+(by-ay)*(by-ay) AS DOUBLE))*1000) AS BIGINT) AS l FROM ways WHERE ax<>bx OR ay<>by),
o AS (SELECT 2*seg_id AS half, ax AS x, ay AS y, kind, l FROM s UNION ALL SELECT 2*seg_id+1, bx, by, kind, l FROM s),
thru AS (SELECT min(half) AS p, max(half) AS q FROM o GROUP BY x, y HAVING count(*)=2 AND min(kind)=max(kind)),
nxt AS (SELECT xor(p, 1) AS half, q AS nxt FROM thru UNION ALL SELECT xor(q, 1), p FROM thru),
walk AS (
  SELECT half, l, 1 AS n FROM o ANTI JOIN nxt USING (half)
  UNION ALL SELECT o.half, walk.l+o.l, n+1 FROM walk JOIN nxt ON nxt.nxt=walk.half JOIN o ON o.half=nxt.half)
SELECT seg_id, a.l/1000 AS ahead, b.l/1000 AS back, (a.l+b.l-s.l)/1000 AS total, a.n+b.n-1 AS n_edges
FROM s LEFT JOIN walk a ON a.half=2*seg_id LEFT JOIN walk b ON b.half=2*seg_id+1""",
)
def _(spark, sf):
    return S.chain_distances(ways(spark, sf))
