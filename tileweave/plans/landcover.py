"""Queries of the land-cover operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tileweave.operators import landcover as L
from tileweave.registry import query
from tileweave.sources import derived as D

NAMES = ("urban", "dry crop", "irrigated crop", "mixed crop", "grass crop", "wood crop", "grass", "shrub", "mixed shrub", "savanna", "deciduous", "needle deciduous")


@query("l01_class_at", "WITH w AS (SELECT x, y, min(cls) AS cls FROM class_cells GROUP BY 1,2), p AS (SELECT pt_id, lon_as/36000.0 AS lon, lat_as/36000.0 AS lat FROM geo_points) SELECT pt_id, coalesce(cls, -1) AS cls FROM p LEFT JOIN w ON x = CAST(floor((lon+180)*4) AS BIGINT)%97 AND y = (180*4-CAST(floor((lat+90)*4) AS BIGINT))%97")
def _(spark, sf):
    # the grid repeats every 97 cells, so that some points fall outside of the 64 x 64 cells
    w = D.class_cells(spark, sf).groupBy("x", "y").agg(F.min("cls").alias("cls"))
    p = D.geo_points(spark, sf).selectExpr("pt_id", "lon_as/36000.0D AS lon", "lat_as/36000.0D AS lat")
    folded = p.selectExpr("pt_id", "(floor((lon+180)*4)%97)/4.0D-180 AS lon", "90-((180*4-floor((lat+90)*4))%97)/4.0D AS lat")
    return L.class_at(folded, w, 4).select("pt_id", "cls")


@query("l02_describe", "SELECT tile_no, x, y, cls, CASE cls " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES, 1)) + " END AS name FROM class_cells")
def _(spark, sf):
    names = spark.createDataFrame(list(enumerate(NAMES, 1)), "cls long, name string")
    return L.describe(D.class_cells(spark, sf), names).select("tile_no", "x", "y", "cls", "name")


OFF = "o AS (SELECT a.range-1 AS dx, b.range-1 AS dy, (a.range)*3+b.range AS n FROM range(3) a, range(3) b WHERE NOT (a.range=1 AND b.range=1))"


@query("l03_borrow_class", f"WITH {OFF}, f AS (SELECT c.tile_no, c.x, c.y, arg_min(k.cls, o.n) AS near FROM class_cells c, o, class_cells k WHERE c.cls=3 AND k.cls<>3 AND k.tile_no=c.tile_no AND k.x=c.x+o.dx AND k.y=c.y+o.dy GROUP BY 1,2,3) SELECT tile_no, x, y, coalesce(near, cls) AS cls FROM class_cells LEFT JOIN f USING (tile_no, x, y)")
def _(spark, sf):
    return L.borrow_class(D.class_cells(spark, sf), 3)


@query("l04_face_majority", "SELECT a.tile_no, a.x, a.y, CASE WHEN a.cls=b.cls OR a.cls=c.cls THEN a.cls WHEN b.cls=c.cls THEN b.cls ELSE d.cls END AS cls FROM class_cells a JOIN class_cells b ON b.tile_no=a.tile_no AND b.x=a.x+1 AND b.y=a.y JOIN class_cells c ON c.tile_no=a.tile_no AND c.x=a.x AND c.y=a.y+1 JOIN class_cells d ON d.tile_no=a.tile_no AND d.x=a.x+1 AND d.y=a.y+1")
def _(spark, sf):
    c = D.class_cells(spark, sf)
    at = lambda dx, dy, n: c.select("tile_no", (F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"), F.col("cls").alias(n))
    j = at(0, 0, "a").join(at(1, 0, "b"), L.AT).join(at(0, 1, "c"), L.AT).join(at(1, 1, "d"), L.AT)
    return j.select(*L.AT, L.face_majority(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("cls"))


def coarse(spark, sf):
    """Classes made few, so that areas of several cells form."""
    return D.class_cells(spark, sf).selectExpr("tile_no", "x", "y", "(cls*(1+x div 4 + y div 4))%5 AS cls")


@query("l05_components")
def _(spark, sf):
    return L.components(coarse(spark, sf)).groupBy("tile_no", "area", "cls").agg(F.count("*").alias("n"))


@query("l06_focal_mode", "WITH o AS (SELECT a.range-1 AS dx, b.range-1 AS dy FROM range(3) a, range(3) b), v AS (SELECT c.tile_no, c.x, c.y, k.cls, count(*) AS n FROM class_cells c, o, class_cells k WHERE k.tile_no=c.tile_no AND k.x=c.x+o.dx AND k.y=c.y+o.dy GROUP BY 1,2,3,4) SELECT tile_no, x, y, arg_min(cls, (-n, cls)) AS mode FROM v GROUP BY 1,2,3")
def _(spark, sf):
    return L.focal_mode(D.class_cells(spark, sf), 1).select(*L.AT, "mode")


@query("l06_fill_mode", "WITH h AS (SELECT tile_no, x, y, CASE WHEN (x*3+y)%11=0 THEN NULL ELSE cls END AS cls FROM class_cells), o AS (SELECT a.range-3 AS dx, b.range-3 AS dy FROM range(7) a, range(7) b), v AS (SELECT c.tile_no, c.x, c.y, k.cls, count(*) AS n FROM h c, o, h k WHERE c.cls IS NULL AND k.cls IS NOT NULL AND k.tile_no=c.tile_no AND k.x=c.x+o.dx AND k.y=c.y+o.dy GROUP BY 1,2,3,4), m AS (SELECT tile_no, x, y, arg_min(cls, (-n, cls)) AS mode FROM v GROUP BY 1,2,3) SELECT tile_no, x, y, coalesce(cls, mode) AS cls FROM h LEFT JOIN m USING (tile_no, x, y)")
def _(spark, sf):
    return L.fill_with_mode(D.class_cells(spark, sf).selectExpr("tile_no", "x", "y", "CASE WHEN (x*3+y)%11=0 THEN NULL ELSE cls END AS cls"))


@query("l07_reclass", "SELECT tile_no, x, y, CASE WHEN (x+y)%7=0 THEN 16 WHEN cls=5 THEN 1 WHEN cls=9 THEN 2 ELSE cls END AS cls FROM class_cells")
def _(spark, sf):
    c = D.class_cells(spark, sf)
    return L.reclass(c, {5: 1, 9: 2}, c.where("(x+y)%7=0"), 16)


@query("l08_absorb_small")
def _(spark, sf):
    return L.absorb_small(coarse(spark, sf), (4,)).groupBy("tile_no", "cls").agg(F.count("*").alias("n"))
