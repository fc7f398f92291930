"""Queries of the tiling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.functions.geo import sql_south, sql_tile_dir, sql_tile_id, sql_west, sql_width, sql_width8
from tileweave.operators import tiles as T
from tileweave.registry import query
from tileweave.sources import derived as D

PT = sql_tile_id("lon_as", "lat_as")
#: Boxes of up to three quarters of a degree around points, within one hemisphere, as SQL for both engines.
BOX = "SELECT pt_id AS box_id, lon_as-(pt_id%5)*300 AS w, lat_as-(pt_id%3)*300 AS s, lon_as+(pt_id%7)*300 AS e, lat_as+(pt_id%4)*300 AS n FROM geo_points WHERE abs(lat_as) < 280000 AND abs(lon_as) < 640000"


def boxes(spark, sf):
    return D.geo_points(spark, sf).where("abs(lat_as) < 280000 AND abs(lon_as) < 640000").selectExpr("pt_id AS box_id", "lon_as-(pt_id%5)*300 AS w", "lat_as-(pt_id%3)*300 AS s", "lon_as+(pt_id%7)*300 AS e", "lat_as+(pt_id%4)*300 AS n")


BOX_TILES = f"""boxes AS ({BOX}), r AS (SELECT *, unnest(range(CAST(floor(s/450.0) AS BIGINT), CAST(floor(n/450.0) AS BIGINT)+1))*450 AS lat FROM boxes),
 rw AS (SELECT *, ({sql_width8('lat')})*450 AS tw FROM r),
 c AS (SELECT *, unnest(range(CAST(floor(w/CAST(tw AS DOUBLE)) AS BIGINT), CAST(floor(e/CAST(tw AS DOUBLE)) AS BIGINT)+1))*tw AS lon FROM rw)"""


@query("t01_tile_id", f"SELECT pt_id, {PT} AS tile FROM geo_points")
def _(spark, sf):
    return T.assign_tiles(D.geo_points(spark, sf)).select("pt_id", "tile")


@query("t02_tile_dir", f"SELECT pt_id, {sql_tile_dir('lon_as', 'lat_as')} AS tile_dir FROM geo_points")
def _(spark, sf):
    return T.assign_tiles(D.geo_points(spark, sf)).select("pt_id", "tile_dir")


@query("t03_tiles_in_bbox", f"WITH {BOX_TILES} SELECT DISTINCT box_id, {sql_tile_id('greatest(lon,-648000)', 'lat')} AS tile FROM c")
def _(spark, sf):
    return T.tiles_in_bbox(boxes(spark, sf))


@query("t03_tiles_by_centre", f"WITH {BOX_TILES} SELECT DISTINCT box_id, {sql_tile_id('greatest(lon,-648000)', 'lat')} AS tile FROM c WHERE 2*lon+tw BETWEEN 2*w AND 2*e AND 2*lat+450 BETWEEN 2*s AND 2*n")
def _(spark, sf):
    return T.tiles_in_bbox(boxes(spark, sf), centre_only=True)


@query("t04_remove_tiles", f"WITH t AS (SELECT DISTINCT {PT} AS tile FROM geo_points), g AS (SELECT {PT} AS tile FROM geo_points WHERE pt_id%3=0) SELECT tile FROM t WHERE tile NOT IN (SELECT tile FROM g)")
def _(spark, sf):
    p = T.assign_tiles(D.geo_points(spark, sf))
    return T.remove_tiles(p.select("tile").distinct(), p.where("pt_id%3=0"))


@query("t05_tile_bounds", f"WITH t AS (SELECT DISTINCT {PT} AS tile FROM geo_points), b AS (SELECT tile, {sql_west('tile')} AS west, {sql_south('tile')} AS south, {sql_width('tile')} AS width FROM t) SELECT tile, west, south, width, 450 AS height, 2*west+width AS cx2, 2*south+450 AS cy2 FROM b")
def _(spark, sf):
    return T.tile_bounds(T.assign_tiles(D.geo_points(spark, sf)).select("tile").distinct())


@query("t06_tile_neighbors", f"""WITH t AS (SELECT DISTINCT {PT} AS tile FROM geo_points), b AS (SELECT tile, {sql_west('tile')} AS west, {sql_south('tile')} AS south, {sql_width('tile')} AS width FROM t),
 r AS (SELECT *, unnest([south-450, south, south+450]) AS lat FROM b), rw AS (SELECT *, ({sql_width8('lat')})*450 AS tw FROM r WHERE lat >= -324000 AND lat < 324000),
 c AS (SELECT *, unnest(range(CAST(floor((west-1)/CAST(tw AS DOUBLE)) AS BIGINT), CAST(floor((west+width)/CAST(tw AS DOUBLE)) AS BIGINT)+1))*tw AS lon0 FROM rw),
 d AS (SELECT *, ((lon0+648000)%1296000+1296000)%1296000-648000 AS lon FROM c)
 SELECT DISTINCT tile, {sql_tile_id('lon', 'lat')} AS neighbor FROM d WHERE tile <> {sql_tile_id('lon', 'lat')}""")
def _(spark, sf):
    return T.tile_neighbors(T.assign_tiles(D.geo_points(spark, sf)))


@query("t07_tile_parent", "SELECT pt_id, CAST(floor(floor(lon_as/450.0)/6.0) AS BIGINT)*6 AS lon8, CAST(floor(floor(lat_as/450.0)/6.0) AS BIGINT)*6 AS lat8, 6 AS w8, 6 AS h8, 2 AS level FROM geo_points")
def _(spark, sf):
    p = D.geo_points(spark, sf)
    return p.select("pt_id", T.tile_parent(T.floor_div(F.col("lon_as"), 450), T.floor_div(F.col("lat_as"), 450), 2).alias("p")).select("pt_id", "p.*")


@query("t08_pyramid", """WITH t AS (SELECT DISTINCT CAST(floor(lon_as/4500.0) AS BIGINT) AS lon8, CAST(floor(lat_as/4500.0) AS BIGINT) AS lat8 FROM geo_points),
 f AS (SELECT *, CASE WHEN (lon8+lat8)%3=0 THEN 1 ELSE 0 END AS land FROM t),
 a AS (SELECT CAST(floor(lon8/2.0) AS BIGINT)*2 AS lon8, CAST(floor(lat8/2.0) AS BIGINT)*2 AS lat8, CAST(sum(land) AS BIGINT) AS land, count(*) AS children FROM f GROUP BY 1,2 HAVING sum(land)>0),
 b AS (SELECT CAST(floor(lon8/6.0) AS BIGINT)*6 AS lon8, CAST(floor(lat8/6.0) AS BIGINT)*6 AS lat8, count(*) AS land, count(*) AS children FROM a GROUP BY 1,2)
 SELECT 1 AS level, *, round(1/children, 6) AS ratio FROM a UNION ALL SELECT 2, *, round(1/children, 6) FROM b""")
def _(spark, sf):
    t = D.geo_points(spark, sf).select(T.floor_div(F.col("lon_as"), 4500).alias("lon8"), T.floor_div(F.col("lat_as"), 4500).alias("lat8")).distinct()
    return T.pyramid(t.withColumn("is_land", (F.col("lon8") + F.col("lat8")) % 3 == 0))


@query("t09_tiles_with_data", f"WITH {BOX_TILES}, g AS (SELECT DISTINCT {sql_tile_id('greatest(lon,-648000)', 'lat')} AS tile FROM c) SELECT tile FROM g WHERE tile IN (SELECT {PT} FROM geo_points WHERE pt_id%2=0)")
def _(spark, sf):
    grid = T.tiles_in_bbox(boxes(spark, sf)).select("tile").distinct()
    return T.tiles_with_data(grid, T.assign_tiles(D.geo_points(spark, sf)).where("pt_id%2=0"))


@query("t10_prechop", f"WITH {BOX_TILES} SELECT DISTINCT box_id, {sql_tile_id('greatest(lon,-648000)', 'lat')} AS tile FROM c")
def _(spark, sf):
    return T.tiles_in_bbox(T.prechop(boxes(spark, sf), margin=0)).distinct()


@query("t11_halo_windows", """WITH a AS (SELECT line_id, seq, x, y, unnest(range(CAST(floor((x-256)/512.0) AS BIGINT), CAST(floor((x+256)/512.0) AS BIGINT)+1)) AS wx FROM track_points),
 b AS (SELECT *, unnest(range(CAST(floor((y-256)/512.0) AS BIGINT), CAST(floor((y+256)/512.0) AS BIGINT)+1)) AS wy FROM a)
 SELECT wx, wy, count(*) AS n, sum(CASE WHEN wx=x//512 AND wy=y//512 THEN 1 ELSE 0 END)::BIGINT AS n_core FROM b GROUP BY 1,2""")
def _(spark, sf):
    return T.halo_windows(D.track_points(spark, sf)).groupBy("wx", "wy").agg(F.count("*").alias("n"), F.sum(F.col("in_core").cast("long")).alias("n_core"))
