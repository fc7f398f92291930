"""Queries of the elevation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.operators import raster as C
from tileweave.registry import query
from tileweave.sources import derived as D

FILL = "".join(
    f", f{n} AS (SELECT tile_no, col, row, coalesce(last_value(elev IGNORE NULLS) OVER (PARTITION BY tile_no, {line} ORDER BY {along} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(elev IGNORE NULLS) OVER (PARTITION BY tile_no, {line} ORDER BY {along} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS elev FROM {before})"
    for n, before, line, along in ((1, "grid_cells", "col", "row"), (2, "f1", "row", "col"), (3, "f2", "col", "row"), (4, "f3", "row", "col"))
)[2:] + ", filled AS (SELECT tile_no, col, row, coalesce(elev, 0) AS elev FROM f4)"
#: Points within the tiles of grid_cells, in tenths of a cell; some lie outside.
GRID_POINTS = "grid_points AS (SELECT c_custkey AS pt_id, c_custkey%(SELECT max(vec_id)//64+1 FROM embeddings) AS tile_no, (c_custkey*37)%640 AS x, (c_custkey*53)%640 AS y FROM customer)"
SAMPLE = """s0 AS (SELECT *, least(x//10, 62) AS i, least(y//10, 62) AS j FROM grid_points), s1 AS (SELECT *, x-10*i AS dx, y-10*j AS dy FROM s0),
 s2 AS (SELECT s1.*, a.elev AS z1, b.elev AS z2, c.elev AS z3 FROM s1 LEFT JOIN {cells} a ON a.tile_no=s1.tile_no AND a.col=i AND a.row=j
  LEFT JOIN {cells} b ON b.tile_no=s1.tile_no AND b.col=CASE WHEN dx>dy THEN i+1 ELSE i END AND b.row=CASE WHEN dx>dy THEN j ELSE j+1 END LEFT JOIN {cells} c ON c.tile_no=s1.tile_no AND c.col=i+1 AND c.row=j+1),
 plain AS (SELECT pt_id, tile_no, x, y, CASE WHEN x<=630 AND y<=630 THEN round(z1 + CASE WHEN dx>dy THEN (dx*(z2-z1)+dy*(z3-z2))/10 ELSE (dx*(z3-z2)+dy*(z2-z1))/10 END, 6) END AS elev FROM s2),
 void AS (SELECT pt_id, arg_min(c.elev, ((c.col*10-x)*(c.col*10-x)+(c.row*10-y)*(c.row*10-y), c.col, c.row)) AS near FROM plain p JOIN {cells} c ON c.tile_no=p.tile_no WHERE p.elev IS NULL AND x<=630 AND y<=630 AND c.elev IS NOT NULL GROUP BY 1),
 sampled AS (SELECT pt_id, tile_no, x, y, coalesce(elev, near) AS elev FROM plain LEFT JOIN void USING (pt_id))"""


def grid_points(spark, sf):
    tiles = D.table(spark, sf, "embeddings").agg((F.floor(F.max("vec_id") / 64) + 1).alias("n"))
    return D.table(spark, sf, "customer").crossJoin(F.broadcast(tiles)).selectExpr("c_custkey AS pt_id", "c_custkey%n AS tile_no", "(c_custkey*37)%640 AS x", "(c_custkey*53)%640 AS y")


@query("slice_tile_elevation", f"WITH {FILL}, {GRID_POINTS}, {SAMPLE.format(cells='filled')} SELECT tile_no, count(*) AS n, round(min(elev),6) AS min_elev, round(avg(elev),6) AS avg_elev, round(max(elev),6) AS max_elev FROM sampled GROUP BY 1")
def _(spark, sf):
    s = C.sample_elevation(grid_points(spark, sf), C.fill_voids(D.grid_cells(spark, sf)), 64, 10)
    return s.groupBy("tile_no").agg(F.count("*").alias("n"), F.round(F.min("elev"), 6).alias("min_elev"), F.round(F.avg("elev"), 6).alias("avg_elev"), F.round(F.max("elev"), 6).alias("max_elev"))


@query("c01_cells_round_trip", "SELECT tile_no, col, row, elev FROM grid_cells")
def _(spark, sf):
    return C.to_cells(C.from_cells(D.grid_cells(spark, sf))).select("tile_no", "col", F.col("row").cast("long").alias("row"), "elev")


ABS = "abs_cells AS (SELECT col AS x, tile_no*64+row AS y, elev FROM grid_cells)"


@query("c02_chop_cells", f"WITH {ABS}, d AS (SELECT DISTINCT x, y, elev, tx, ty FROM abs_cells, LATERAL (SELECT unnest([CAST(floor(x/16.0) AS BIGINT), CAST(floor((x-1)/16.0) AS BIGINT)]) AS tx), LATERAL (SELECT unnest([CAST(floor(y/16.0) AS BIGINT), CAST(floor((y-1)/16.0) AS BIGINT)]) AS ty)) SELECT tx, ty, x, y, elev FROM d WHERE (tx,ty) IN (SELECT (tx,ty) FROM d GROUP BY tx, ty HAVING count(*)=289)")
def _(spark, sf):
    a = D.grid_cells(spark, sf).selectExpr("col AS x", "tile_no*64+row AS y", "elev")
    return C.chop_cells(a, 16)


@query("c03_drop_zero_tiles", "WITH z AS (SELECT tile_no, col, row, CASE WHEN tile_no%2=0 THEN elev ELSE 0 END AS elev FROM grid_cells), m AS (SELECT tile_no, max(col) AS mc, max(row) AS mr FROM z GROUP BY 1), k AS (SELECT z.tile_no FROM z JOIN m USING (tile_no) WHERE col<mc AND row<mr GROUP BY 1 HAVING bool_or(elev<>0)) SELECT * FROM z WHERE tile_no IN (SELECT tile_no FROM k)")
def _(spark, sf):
    return C.drop_zero_tiles(D.grid_cells(spark, sf).selectExpr("tile_no", "col", "row", "CASE WHEN tile_no%2=0 THEN elev ELSE 0 END AS elev"))


@query("c04_stitch_border", """WITH g AS (SELECT * FROM grid_cells WHERE row<64), t AS (SELECT DISTINCT tile_no FROM g), k AS (SELECT unnest(range(65)) AS k),
 b AS (SELECT tile_no, 64 AS col, k AS row FROM t, k UNION SELECT tile_no, k, 64 FROM t, k),
 n AS (SELECT b.*, CASE WHEN col=64 AND row=64 THEN tile_no+5 WHEN col=64 THEN tile_no+1 ELSE tile_no+4 END AS nt FROM b),
 f AS (SELECT n.tile_no, n.col, n.row, s.tile_no IS NOT NULL AND NOT (n.col=64 AND n.tile_no%4=3) AS has, s.elev, o.elev AS own, n.col=64 AND n.tile_no%4=3 AS world FROM n LEFT JOIN g s ON s.tile_no=nt AND s.col=n.col%64 AND s.row=n.row%64 LEFT JOIN g o ON o.tile_no=n.tile_no AND o.col=least(n.col,63) AND o.row=least(n.row,63))
 SELECT tile_no, col, row, elev FROM g UNION ALL SELECT tile_no, col, row, CASE WHEN has THEN elev WHEN world THEN own ELSE 0 END FROM f""")
def _(spark, sf):
    return C.stitch_border(D.grid_cells(spark, sf), 64, 4)


@query("c05_resample", "WITH src AS (SELECT tile_no AS source, col AS sx, row AS sy, elev FROM grid_cells WHERE elev IS NOT NULL), best AS (SELECT sx, sy, arg_max(elev, source) AS elev FROM src GROUP BY 1,2), tg AS (SELECT c_custkey AS tile_no, (c_custkey*37)%200 AS x, (c_custkey*53)%200 AS y FROM customer) SELECT tile_no, x, y, elev FROM tg LEFT JOIN best ON sx=(2*x+3)//6 AND sy=(2*y+3)//6")
def _(spark, sf):
    t = D.table(spark, sf, "customer").selectExpr("c_custkey AS tile_no", "(c_custkey*37)%200 AS x", "(c_custkey*53)%200 AS y")
    return C.resample(t, D.grid_cells(spark, sf).selectExpr("tile_no AS source", "col AS sx", "row AS sy", "elev"), 3)


@query("c06_coverage_gate", "SELECT tile_no, count(*) AS n FROM grid_cells WHERE tile_no IN (SELECT tile_no FROM grid_cells GROUP BY 1 HAVING (count(*)-count(elev))*100 <= 12*count(*)) GROUP BY 1")
def _(spark, sf):
    return C.coverage_gate(D.grid_cells(spark, sf), 12).groupBy("tile_no").agg(F.count("*").alias("n"))


@query("c07_fill_from", "WITH s AS (SELECT tile_no, col, row, (col*7+row)%500 AS e FROM grid_cells WHERE (col+row)%3<>0) SELECT g.tile_no, g.col, g.row, coalesce(g.elev, s.e) AS elev, g.elev IS NULL AND s.e IS NOT NULL AS filled FROM grid_cells g LEFT JOIN s USING (tile_no, col, row)")
def _(spark, sf):
    g = D.grid_cells(spark, sf)
    return C.fill_from(g, g.where("(col+row)%3<>0").selectExpr("tile_no", "col", "row", "(col*7+row)%500 AS elev"))


@query("c08_fill_voids", f"WITH {FILL} SELECT * FROM filled")
def _(spark, sf):
    return C.fill_voids(D.grid_cells(spark, sf))


@query("c09_clean_profile", "WITH g AS (SELECT tile_no, col, row, CASE WHEN (col+row)%9=0 THEN 33000 WHEN (col+row)%9=1 THEN 12000 ELSE elev END AS elev FROM grid_cells) SELECT tile_no, col, row, round(coalesce(last_value(CASE WHEN elev*0.3048::DOUBLE<=10000 THEN elev*0.3048::DOUBLE END IGNORE NULLS) OVER (PARTITION BY tile_no, col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 6) AS elev_m FROM g")
def _(spark, sf):
    return C.clean_profile(D.grid_cells(spark, sf).withColumn("elev", F.expr("CASE WHEN (col+row)%9=0 THEN 33000 WHEN (col+row)%9=1 THEN 12000 ELSE elev END"))).select("tile_no", "col", "row", "elev_m")


@query("c10_sample_elevation", f"WITH {GRID_POINTS}, {SAMPLE.format(cells='grid_cells')} SELECT pt_id, elev FROM sampled")
def _(spark, sf):
    return C.sample_elevation(grid_points(spark, sf), D.grid_cells(spark, sf), 64, 10).select("pt_id", "elev")


@query("c11_nearest_valid", f"WITH {GRID_POINTS}, r AS (SELECT pt_id, elev, row_number() OVER (PARTITION BY pt_id ORDER BY (col*10-x)*(col*10-x)+(row*10-y)*(row*10-y), col, row) AS k FROM grid_points JOIN grid_cells USING (tile_no) WHERE elev IS NOT NULL) SELECT pt_id, elev FROM r WHERE k=1")
def _(spark, sf):
    return C.nearest_valid(grid_points(spark, sf), D.grid_cells(spark, sf), 10).select("pt_id", "elev")


@query("c12_pick_source", "WITH s AS (SELECT 1 AS rank, 'a' AS source, tile_no, col, row, elev FROM grid_cells WHERE tile_no%2=0 UNION ALL SELECT 2, 'b', tile_no, col, row, -elev FROM grid_cells), k AS (SELECT tile_no, min(rank) AS rank FROM s GROUP BY 1) SELECT tile_no, source, count(*) AS n, CAST(sum(elev) AS BIGINT) AS s FROM s JOIN k USING (tile_no, rank) GROUP BY 1,2")
def _(spark, sf):
    g = D.grid_cells(spark, sf)
    s = g.where("tile_no%2=0").selectExpr("1 AS rank", "'a' AS source", "*").unionByName(g.selectExpr("2 AS rank", "'b' AS source", "tile_no", "col", "row", "-elev AS elev"))
    return C.pick_source(s).groupBy("tile_no", "source").agg(F.count("*").alias("n"), F.sum("elev").alias("s"))


@query("c13_average_elevation", f"WITH {GRID_POINTS}, {SAMPLE.format(cells='grid_cells')} SELECT pt_id%10 AS grp, round(avg(elev),6) AS avg_elev, count(elev) AS n FROM sampled GROUP BY 1")
def _(spark, sf):
    s = C.sample_elevation(grid_points(spark, sf), D.grid_cells(spark, sf), 64, 10).withColumn("grp", F.col("pt_id") % 10)
    return C.average_elevation(s, "grp")


@query("c14_mosaic", "SELECT (tile_no%4)*48+col AS x, (tile_no//4)*48+row AS y, arg_max_null(elev, tile_no) AS elev FROM grid_cells GROUP BY 1,2")
def _(spark, sf):
    return C.mosaic(D.grid_cells(spark, sf), (F.col("tile_no") % 4) * 48, F.floor(F.col("tile_no") / 4) * 48)


@query("c15_select_points")
def _(spark, sf):
    return C.select_points(D.grid_cells(spark, sf), 150)


@query("c15_insert_points")
def _(spark, sf):
    return C.insert_points(D.grid_cells(spark, sf))


@query("c16_approx_error", "SELECT g.tile_no, max(abs(g.elev-(g.col*2-g.row))) AS max_err, round(sqrt(avg((g.elev-(g.col*2-g.row))*(g.elev-(g.col*2-g.row)))),6) AS rms_err, count(*) AS n FROM grid_cells g WHERE elev IS NOT NULL GROUP BY 1")
def _(spark, sf):
    g = D.grid_cells(spark, sf)
    return C.approx_error(g, g.withColumn("elev", F.col("col") * 2 - F.col("row")))


@query("c17_subsample", "WITH k AS (SELECT (2*range*63+8)//16 AS k FROM range(9)) SELECT tile_no, col, row, elev, CASE WHEN col%2=1 THEN 'select' WHEN col%3=1 THEN 'ignore' ELSE 'unknown' END AS mark FROM grid_cells WHERE col IN (SELECT k FROM k) AND row IN (SELECT k FROM k)")
def _(spark, sf):
    g = D.grid_cells(spark, sf)
    mask = g.where("tile_no=0 AND (col%2=1 OR col%3=1)").selectExpr("col", "row", "CASE WHEN col%2=1 THEN 'select' ELSE 'ignore' END AS mark")
    return C.with_mask(C.subsample(g, 64, 9), mask).select("tile_no", "col", "row", "elev", "mark")


@query("c18_block_mean", "WITH d AS (SELECT DISTINCT tile_no, col, row, elev, bc, br FROM grid_cells, LATERAL (SELECT unnest([col//10, greatest(0,CAST(floor((col-1)/10.0) AS BIGINT))]) AS bc), LATERAL (SELECT unnest([row//10, greatest(0,CAST(floor((row-1)/10.0) AS BIGINT))]) AS br)) SELECT tile_no, bc, br, round(avg(elev),6) AS mean_elev FROM d GROUP BY 1,2,3")
def _(spark, sf):
    return C.block_mean(D.grid_cells(spark, sf), 10)


@query("c19_clamp", "WITH m AS (SELECT tile_no, CAST(floor((min(elev)+max(elev))/2.0) AS BIGINT) AS m FROM grid_cells GROUP BY 1) SELECT tile_no, col, row, CASE WHEN elev IS NOT NULL THEN least(greatest(elev, m-100), m+100) ELSE m-100 END AS elev FROM grid_cells JOIN m USING (tile_no) WHERE elev IS NOT NULL")
def _(spark, sf):
    return C.clamp(D.grid_cells(spark, sf).where("elev is not null"))


@query("c20_limit_slope")
def _(spark, sf):
    return C.limit_slope(D.grid_cells(spark, sf), 60, 6)


@query("c21_fit_surface")
def _(spark, sf):
    p = D.grid_cells(spark, sf).selectExpr("tile_no", "(col-31.5)/31.5 AS u", "(row-31.5)/31.5 AS v", "elev")
    return C.fit_surface(p)


@query("c22_eval_surface")
def _(spark, sf):
    p = D.grid_cells(spark, sf).selectExpr("tile_no", "col", "row", "(col-31.5)/31.5 AS u", "(row-31.5)/31.5 AS v", "elev")
    return C.eval_surface(p, C.fit_surface(p)).select("tile_no", "col", "row", F.round("elev_fit", 4).alias("elev_fit"))


@query("c23_roughness", f"WITH {GRID_POINTS}, {SAMPLE.format(cells='grid_cells')} SELECT pt_id%12 AS poly_id, round((max(elev)-min(elev))/50,6) AS rough FROM sampled GROUP BY 1")
def _(spark, sf):
    s = C.sample_elevation(grid_points(spark, sf), D.grid_cells(spark, sf), 64, 10).withColumn("poly_id", F.col("pt_id") % 12)
    return C.roughness(s, "poly_id")


@query("c24_raster_stats", "SELECT tile_no, min(elev) AS min_elev, max(elev) AS max_elev, count(elev) AS n_valid, count(*) AS n_cells, max(col) AS max_col, max(row) AS max_row FROM grid_cells GROUP BY 1")
def _(spark, sf):
    return C.raster_stats(D.grid_cells(spark, sf), ["tile_no"])
