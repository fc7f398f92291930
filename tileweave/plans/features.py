"""Queries of the feature operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tileweave.functions.shared import shared_dir

from tileweave.operators import features as E
from tileweave.registry import query
from tileweave.sources import derived as D

BOXES = "SELECT poly_id, material, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM poly_verts GROUP BY 1,2"


def poly_boxes(spark, sf):
    return D.poly_verts(spark, sf).groupBy("poly_id", "material").agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))


@query("e01_attribute_filter", "SELECT p_partkey, p_type, p_size FROM part WHERE p_size > 20 AND p_type IN ('LARGE','PROMO') AND p_name LIKE '%ring%'")
def _(spark, sf):
    return E.where_attr(D.table(spark, sf, "part"), "p_size > 20 AND p_type IN ('LARGE','PROMO') AND p_name LIKE '%ring%'").select("p_partkey", "p_type", "p_size")


@query("e02_bbox_filter", f"SELECT * FROM ({BOXES}) b WHERE max_x >= 5000 AND min_x <= 20000 AND max_y >= 8000 AND min_y <= 30000")
def _(spark, sf):
    return E.where_bbox(poly_boxes(spark, sf), (5000, 8000, 20000, 30000))


@query("e03_skip_records", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey OFFSET 37")
def _(spark, sf):
    return E.skip_records(D.table(spark, sf, "customer"), 37, "c_custkey").select("c_custkey", "c_name")


@query("e04_area_type", "SELECT p_partkey, coalesce(CASE WHEN p_size%7=0 THEN NULL ELSE p_type END, 'Default') AS area_type FROM part")
def _(spark, sf):
    return E.area_type(D.table(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_size%7=0 THEN NULL ELSE p_type END AS t"), "t", "Default").select("p_partkey", "area_type")


@query("e05_reject_classes", "SELECT p_partkey, p_type FROM part WHERE p_type NOT IN ('SMALL','PROMO')")
def _(spark, sf):
    return E.reject_classes(D.table(spark, sf, "part"), "p_type", ("SMALL", "PROMO")).select("p_partkey", "p_type")


@query("e06_width_default", "SELECT line_id, seq, CASE WHEN width%4=0 THEN 50 ELSE width%4 END AS width FROM track_points")
def _(spark, sf):
    return D.track_points(spark, sf).select("line_id", "seq", E.width_or_default(F.col("width") % 4, 50).cast("long").alias("width"))


@query("e07_split_bad", "SELECT p_partkey, p_size NOT BETWEEN 5 AND 40 AS is_bad FROM part")
def _(spark, sf):
    good, bad = E.split_bad(D.table(spark, sf, "part"), F.expr("p_size NOT BETWEEN 5 AND 40"))
    return good.select("p_partkey", F.lit(False).alias("is_bad")).unionByName(bad.select("p_partkey", F.lit(True).alias("is_bad")))


@query("e08_explode_parts", "SELECT poly_id, ring AS part_no, count(*) AS n_points, CAST(sum(x+y) AS BIGINT) AS s FROM poly_verts GROUP BY 1,2")
def _(spark, sf):
    rings = D.poly_verts(spark, sf).groupBy("poly_id", "ring").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("pts"))
    multi = rings.groupBy("poly_id").agg(F.array_sort(F.collect_list(F.struct("ring", "pts"))).alias("rings"))
    one = E.explode_parts(multi, "rings").select("poly_id", "part_no", "part.pts")
    return one.select("poly_id", "part_no", F.size("pts").cast("long").alias("n_points"), F.aggregate("pts", F.lit(0).cast("long"), lambda a, p: a + p["x"] + p["y"]).alias("s"))


@query("e09_priority_join", "SELECT p_partkey, coalesce(priority, 65535) AS priority, category FROM (SELECT p_partkey, CASE WHEN p_size%9=0 THEN 'NOSUCH' ELSE p_type END AS material FROM part) p LEFT JOIN area_defs a ON a.name = p.material")
def _(spark, sf):
    p = D.table(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_size%9=0 THEN 'NOSUCH' ELSE p_type END AS material")
    return E.with_priority(p, D.area_defs(spark)).select("p_partkey", "priority", "category")


@query("e10_classify", "SELECT p_partkey, CASE WHEN p_type='LARGE' AND p_size>30 THEN 'v0_lake' WHEN p_type='LARGE' THEN 'v0_pond' WHEN p_name LIKE 'red%' THEN 'v0_urban' ELSE 'v0_landmass' END AS layer FROM part")
def _(spark, sf):
    rules = [("p_type='LARGE' AND p_size>30", "v0_lake"), ("p_type='LARGE'", "v0_pond"), ("p_name LIKE 'red%'", "v0_urban")]
    return E.classify(D.table(spark, sf, "part"), rules, "v0_landmass").select("p_partkey", "layer")


@query("e11_map_codes", "SELECT p_partkey, CASE p_size%5 WHEN 0 THEN 'water' WHEN 1 THEN 'ice' WHEN 2 THEN 'urban' WHEN 3 THEN 'forest' END AS layer FROM part")
def _(spark, sf):
    names = spark.createDataFrame([(0, "water"), (1, "ice"), (2, "urban"), (3, "forest")], "code int, name string")
    return E.map_codes(D.table(spark, sf, "part").selectExpr("p_partkey", "p_size%5 AS code"), names, "code").select("p_partkey", "layer")


@query("e12_to_wgs84", "SELECT poly_id, ring, seq, round(degrees(x*300/6378137.0), 6) AS lon, round(degrees(2*atan(exp(y*200/6378137.0)) - pi()/2), 6) AS lat FROM poly_verts")
def _(spark, sf):
    v = D.poly_verts(spark, sf).selectExpr("poly_id", "ring", "seq", "x*300 AS x", "y*200 AS y")
    return E.to_wgs84(v, "x", "y").select("poly_id", "ring", "seq", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("e13_categories", "SELECT material, count(*) AS n_rows FROM poly_verts GROUP BY 1")
def _(spark, sf):
    return E.categories(D.poly_verts(spark, sf), "material")


@query("e13_extracts", "SELECT material, count(*) AS n, CAST(sum(x) AS BIGINT) AS s FROM poly_verts GROUP BY 1")
def _(spark, sf):
    p = f"{shared_dir(spark).rstrip('/')}/extracts-{uuid.uuid4().hex}"
    v = D.poly_verts(spark, sf)
    E.extract_categories(v, "material", p)
    return spark.read.schema(v.schema).parquet(p).groupBy("material").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
