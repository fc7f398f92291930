"""Geographic tables derived from the star-schema tables, in integer units; and the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (priority, name, category) of the land-cover classes (fixed values).
AREA_DEFS = ((0, "SMALL", "hole"), (1, "STANDARD", "road"), (2, "LARGE", "lake"), (3, "MEDIUM", "stream"), (4, "ECONOMY", "other"), (5, "PROMO", "landmass"))

SQL = {
    "geo_points": """SELECT c_custkey AS pt_id, (c_custkey*7919)%1296000-648000 AS lon_as, (c_custkey*104729)%612000-306000 AS lat_as FROM customer""",
    "grid_cells": """SELECT vec_id//64 AS tile_no, CAST(j AS BIGINT) AS col, vec_id%64 AS row, CASE WHEN embedding[j+1] < -0.15 THEN NULL ELSE CAST(floor(CAST(embedding[j+1] AS DOUBLE)*1000) AS BIGINT) END AS elev FROM embeddings, range(64) t(j)""",
    "class_cells": """SELECT vec_id//64 AS tile_no, CAST(j AS BIGINT) AS x, vec_id%64 AS y, CAST(floor(abs(CAST(embedding[j+1] AS DOUBLE))*97) AS BIGINT)%24+1 AS cls FROM embeddings, range(64) t(j)""",
    "poly_verts": """SELECT id AS poly_id, material, 0 AS ring, false AS is_hole, s AS seq,
       CASE s WHEN 0 THEN cx-w WHEN 1 THEN cx+w WHEN 2 THEN cx+w-k ELSE cx-w+k END AS x, CASE s WHEN 0 THEN cy-h WHEN 1 THEN cy-h+k WHEN 2 THEN cy+h ELSE cy+h-k END AS y
FROM (SELECT p_partkey AS id, p_type AS material, (p_partkey*7919)%40000 AS cx, (p_partkey*6007)%40000 AS cy, 200+p_size*20 AS w, 150+p_size*11 AS h, (p_partkey%7)*10 AS k FROM part) p CROSS JOIN (SELECT CAST(range AS INT) s FROM range(4)) t
UNION ALL
SELECT id, material, 1, true, s, CASE s WHEN 0 THEN cx-(w//2) WHEN 1 THEN cx-(w//2) ELSE cx+(w//2) END, CASE s WHEN 1 THEN cy+(h//2) WHEN 2 THEN cy+(h//2) ELSE cy-(h//2) END
FROM (SELECT p_partkey AS id, p_type AS material, (p_partkey*7919)%40000 AS cx, (p_partkey*6007)%40000 AS cy, 200+p_size*20 AS w, 150+p_size*11 AS h FROM part) p CROSS JOIN (SELECT CAST(range AS INT) s FROM range(4)) t WHERE id%5=0""",
    "area_defs": "SELECT * FROM (VALUES " + ", ".join(f"({p}, '{n}', '{c}')" for p, n, c in AREA_DEFS) + ") t(priority, name, category)",
    "track_points": """SELECT user_id AS line_id, row_number() OVER (PARTITION BY user_id ORDER BY ts,event_id)-1 AS seq, (event_id*7919)%20000 AS x, (event_id*6007)%20000 AS y, 1+event_id%4 AS width, event_type AS kind FROM events""",
    "record_lines": """SELECT row_number() OVER (ORDER BY k,ln,a,b,txt)-1 AS line_no, txt FROM (
  SELECT o_orderkey AS k, 0 AS ln, 0::BIGINT AS a, 0::BIGINT AS b, concat('1 ',o_custkey%9000,' 0 0 K',o_orderkey,' Field ',o_orderkey) AS txt FROM orders
  UNION ALL SELECT l_orderkey, 1, l_partkey, l_suppkey, concat('100 ',10+l_linenumber*5,' ',l_linenumber%5+1,' ',(l_partkey*7919)%648000-324000,' ',(l_suppkey*6007)%1296000-648000,' ',(l_partkey*7919)%648000-324000+60,' ',(l_suppkey*6007)%1296000-648000+60) FROM lineitem
  UNION ALL SELECT max(o_orderkey)+1, 2, 0, 0, '99' FROM orders) u""",
    "tower_lines": """SELECT concat_ws('|','DE',c_custkey,'',25+c_custkey%24,c_custkey%60,(c_custkey*7)%60,
  CASE WHEN c_custkey%11=0 THEN 'S' WHEN c_custkey%3=0 THEN '' ELSE 'N' END,'',70+c_custkey%50,(c_custkey*3)%60,(c_custkey*13)%60,
  CASE WHEN c_custkey%13=0 THEN 'E' WHEN c_custkey%4=0 THEN ' ' ELSE 'W' END,'',(c_custkey*17)%900,(c_custkey*29)%400,(c_custkey*17)%900+(c_custkey*29)%400) AS line FROM customer""",
    "nav_master": """SELECT c_custkey AS line_no, concat('V',c_custkey%48) AS id, 10800+(c_custkey%25)*5 AS freq100, 2500+(c_custkey%48)*3 AS lat100, c_name AS name FROM customer""",
    "nav_detail": """SELECT p_partkey AS line_no, concat('V',p_partkey%54) AS id, 10800+(p_partkey%25)*5 AS freq100, 2500+(p_partkey%54)*3 AS lat100, (p_partkey*11)%360-180 AS magvar, p_type AS kind FROM part""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as Parquet."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def geo_points(spark: SparkSession, sf: str) -> DataFrame:
    """(pt_id, lon_as, lat_as): points over the world in arcseconds."""
    return table(spark, sf, "customer").selectExpr("c_custkey AS pt_id", "(c_custkey*7919)%1296000-648000 AS lon_as", "(c_custkey*104729)%612000-306000 AS lat_as")


def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    """(tile_no, col, row, elev): a 64 x 64 grid for each tile, null where void."""
    cells = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("j", "v"))
    return cells.selectExpr("vec_id div 64 AS tile_no", "cast(j AS bigint) AS col", "vec_id % 64 AS row", "CASE WHEN v < -0.15 THEN NULL ELSE cast(floor(cast(v AS double)*1000) AS bigint) END AS elev")


def class_cells(spark: SparkSession, sf: str) -> DataFrame:
    """(tile_no, x, y, cls): land-cover classes 1 to 24 on the same grid."""
    cells = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("j", "v"))
    return cells.selectExpr("vec_id div 64 AS tile_no", "cast(j AS bigint) AS x", "vec_id % 64 AS y", "cast(floor(abs(cast(v AS double))*97) AS bigint)%24+1 AS cls")


def poly_verts(spark: SparkSession, sf: str) -> DataFrame:
    """(poly_id, material, ring, is_hole, seq, x, y): quads, every fifth with a hole."""
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "p_type AS material", "(p_partkey*7919)%40000 AS cx", "(p_partkey*6007)%40000 AS cy", "200+p_size*20 AS w", "150+p_size*11 AS h", "(p_partkey%7)*10 AS k")
    outer = "array(struct(0, false, 0, cx-w, cy-h), struct(0, false, 1, cx+w, cy-h+k), struct(0, false, 2, cx+w-k, cy+h), struct(0, false, 3, cx-w+k, cy+h-k))"
    hole = "array(struct(1, true, 0, cx-w div 2, cy-h div 2), struct(1, true, 1, cx-w div 2, cy+h div 2), struct(1, true, 2, cx+w div 2, cy+h div 2), struct(1, true, 3, cx+w div 2, cy-h div 2))"
    return p.selectExpr("id AS poly_id", "material", f"explode(CASE WHEN id%5=0 THEN concat({outer}, {hole}) ELSE {outer} END) AS v").selectExpr("poly_id", "material", "v.col1 AS ring", "v.col2 AS is_hole", "v.col3 AS seq", "v.col4 AS x", "v.col5 AS y")


def area_defs(spark: SparkSession, sf: str = "") -> DataFrame:
    """(priority, name, category), a dimension of a few fixed rows."""
    return spark.createDataFrame(AREA_DEFS, "priority int, name string, category string")


def track_points(spark: SparkSession, sf: str) -> DataFrame:
    """(line_id, seq, x, y, width, kind): a polyline for each user."""
    return table(spark, sf, "events").selectExpr("user_id AS line_id", "cast(row_number() OVER (PARTITION BY user_id ORDER BY ts,event_id)-1 AS bigint) AS seq", "(event_id*7919)%20000 AS x", "(event_id*6007)%20000 AS y", "1+event_id%4 AS width", "event_type AS kind")


def record_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(line_no, txt): headers, details and an end mark in line order.

    Line numbers are given by range partitions: rows are sorted by key, counted for each partition, and numbered
    within it, so no task sees the whole file.
    """
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    heads = o.selectExpr("o_orderkey AS k", "0 AS ln", "0L AS a", "0L AS b", "concat('1 ',o_custkey%9000,' 0 0 K',o_orderkey,' Field ',o_orderkey) AS txt")
    details = li.selectExpr("l_orderkey AS k", "1 AS ln", "l_partkey AS a", "l_suppkey AS b", "concat('100 ',10+l_linenumber*5,' ',l_linenumber%5+1,' ',(l_partkey*7919)%648000-324000,' ',(l_suppkey*6007)%1296000-648000,' ',(l_partkey*7919)%648000-324000+60,' ',(l_suppkey*6007)%1296000-648000+60) AS txt")
    end = o.agg(F.max("o_orderkey").alias("k")).selectExpr("k+1 AS k", "2 AS ln", "0L AS a", "0L AS b", "'99' AS txt")
    return number_rows(heads.unionByName(details).unionByName(end), ["k"], ["k", "ln", "a", "b", "txt"], "line_no").select("line_no", "txt")


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df with gapless numbers from 0 in `order`, whose leading columns are `group`.

    Counts by group make running offsets over blocks of groups; only the block totals meet in one task.
    """
    from pyspark.sql import Window as W

    blocks = 512
    counts = df.groupBy(*group).count()
    key = group[0]
    span = counts.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    counts = counts.crossJoin(F.broadcast(span)).withColumn("__b", F.floor((F.col(key) - F.col("lo")) * blocks / (F.col("hi") - F.col("lo") + 1)))
    totals = counts.groupBy("__b").agg(F.sum("count").alias("__t")).withColumn("__before", F.sum("__t").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)))
    inside = F.sum("count").over(W.partitionBy("__b").orderBy(*group).rowsBetween(W.unboundedPreceding, -1))
    starts = counts.withColumn("__in", inside).join(F.broadcast(totals.select("__b", "__before")), "__b").select(*group, (F.coalesce("__before", F.lit(0)) + F.coalesce("__in", F.lit(0))).alias("__start"))
    return df.join(starts, group).withColumn(name, F.col("__start") + F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1).drop("__start")


def tower_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(line): towers as text with 16 fields."""
    return table(spark, sf, "customer").selectExpr("concat_ws('|','DE',c_custkey,'',25+c_custkey%24,c_custkey%60,(c_custkey*7)%60, CASE WHEN c_custkey%11=0 THEN 'S' WHEN c_custkey%3=0 THEN '' ELSE 'N' END,'',70+c_custkey%50,(c_custkey*3)%60,(c_custkey*13)%60, CASE WHEN c_custkey%13=0 THEN 'E' WHEN c_custkey%4=0 THEN ' ' ELSE 'W' END,'',(c_custkey*17)%900,(c_custkey*29)%400,(c_custkey*17)%900+(c_custkey*29)%400) AS line")


def nav_master(spark: SparkSession, sf: str) -> DataFrame:
    """(line_no, id, freq100, lat100, name)."""
    return table(spark, sf, "customer").selectExpr("c_custkey AS line_no", "concat('V',c_custkey%48) AS id", "10800+(c_custkey%25)*5 AS freq100", "2500+(c_custkey%48)*3 AS lat100", "c_name AS name")


def nav_detail(spark: SparkSession, sf: str) -> DataFrame:
    """(line_no, id, freq100, lat100, magvar, kind)."""
    return table(spark, sf, "part").selectExpr("p_partkey AS line_no", "concat('V',p_partkey%54) AS id", "10800+(p_partkey%25)*5 AS freq100", "2500+(p_partkey%54)*3 AS lat100", "(p_partkey*11)%360-180 AS magvar", "p_type AS kind")
