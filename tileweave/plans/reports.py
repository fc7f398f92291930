"""Queries of the report operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.functions.geo import sql_tile_dir, sql_tile_id, tile_dir, tile_id
from tileweave.operators import reports as U
from tileweave.registry import query
from tileweave.sources import derived as D

TOWERS = """towers AS (SELECT CAST(f[2] AS BIGINT) AS id, CASE WHEN trim(f[7]) IN ('','N') THEN 1 ELSE -1 END*(CAST(f[4] AS BIGINT)*3600+CAST(f[5] AS BIGINT)*60+CAST(f[6] AS BIGINT)) AS lat_as,
 CASE WHEN trim(f[12]) IN ('','W') THEN -1 ELSE 1 END*(CAST(f[9] AS BIGINT)*3600+CAST(f[10] AS BIGINT)*60+CAST(f[11] AS BIGINT)) AS lon_as, CAST(f[14] AS BIGINT) AS ground, CAST(f[15] AS BIGINT) AS height, CAST(f[16] AS BIGINT) AS top FROM (SELECT string_split(line,'|') AS f FROM tower_lines) l)"""
SIZE = "CASE WHEN height>=200 THEN 'tall' WHEN height>=100 THEN 'medium' ELSE 'short' END"


def towers(spark, sf):
    return U.parse_towers(D.tower_lines(spark, sf))


@query("u01_parse_dms", f"WITH {TOWERS} SELECT id, lat_as, lon_as FROM towers")
def _(spark, sf):
    return towers(spark, sf).select("id", "lat_as", "lon_as")


@query("u02_tower_classes", f"WITH {TOWERS} SELECT id, {SIZE} AS size, CASE WHEN height>=200 THEN 'radio-tall.xml' ELSE 'radio-medium.xml' END AS model, top+CASE WHEN height>=200 THEN -610 ELSE -200 END AS base_elev FROM towers WHERE height>=100")
def _(spark, sf):
    return U.classify_towers(towers(spark, sf)).select("id", "size", "model", "base_elev")


@query("u03_tower_summary", f"WITH {TOWERS} SELECT count(*) FILTER (height<100) AS n_short, count(*) FILTER (height>=100 AND height<200) AS n_medium, count(*) FILTER (height>=200) AS n_tall, round(avg(height),6) AS avg_height, min(height) AS min_height, max(height) AS max_height FROM towers")
def _(spark, sf):
    return U.tower_summary(towers(spark, sf))


@query("u04_tower_lines", f"WITH {TOWERS} SELECT {sql_tile_id('lon_as', 'lat_as')} AS tile, {sql_tile_dir('lon_as', 'lat_as')} AS tile_dir, concat('OBJECT_SHARED Models/Communications/', CASE WHEN height>=200 THEN 'radio-tall.xml' ELSE 'radio-medium.xml' END, ' ', lon_as, ' ', lat_as, ' ', top+CASE WHEN height>=200 THEN -610 ELSE -200 END, ' 0') AS line FROM towers WHERE height>=100")
def _(spark, sf):
    t = U.classify_towers(towers(spark, sf))
    return t.select(tile_id(F.col("lon_as"), F.col("lat_as")).alias("tile"), tile_dir(F.col("lon_as"), F.col("lat_as")).alias("tile_dir"), F.format_string("OBJECT_SHARED Models/Communications/%s %d %d %d 0", "model", "lon_as", "lat_as", "base_elev").alias("line"))


LAST = "last AS (SELECT id, freq100, lat100, arg_max(magvar, line_no) AS magvar, max(line_no) AS detail_line FROM nav_detail GROUP BY 1,2,3), first AS (SELECT id, freq100, lat100, min(line_no) AS line_no FROM nav_master GROUP BY 1,2,3)"


@query("u05_merge_details", f"WITH {LAST} SELECT m.*, l.magvar, l.detail_line FROM nav_master m LEFT JOIN first f USING (id, freq100, lat100, line_no) LEFT JOIN last l ON l.id=f.id AND l.freq100=f.freq100 AND l.lat100=f.lat100 AND f.line_no=m.line_no")
def _(spark, sf):
    return U.merge_details(D.nav_master(spark, sf), D.nav_detail(spark, sf))


@query("u06_duplicate_keys", "SELECT concat('V', line_no%6) AS id, freq100, 2500+(line_no%6)*3 AS lat100, count(*) AS n, max(line_no) AS last_line FROM nav_detail GROUP BY 1,2,3 HAVING count(*)>1")
def _(spark, sf):
    # few stations, so that keys repeat at every size
    return U.duplicate_keys(D.nav_detail(spark, sf).selectExpr("concat('V', line_no%6) AS id", "freq100", "2500+(line_no%6)*3 AS lat100", "line_no"))


@query("u07_unmatched", "SELECT line_no, id, freq100, lat100, CASE WHEN kind IN ('LARGE','STANDARD') THEN 'VOR' WHEN kind='MEDIUM' THEN 'VORTAC' ELSE 'NDB' END AS nav_type, kind='MEDIUM' AS has_dme FROM nav_detail d WHERE NOT EXISTS (SELECT 1 FROM nav_master m WHERE m.id=d.id AND m.freq100=d.freq100 AND m.lat100=d.lat100)")
def _(spark, sf):
    return U.unmatched(D.nav_master(spark, sf), D.nav_detail(spark, sf))


@query("u08_files_by_count", r"WITH f AS (SELECT regexp_replace(regexp_replace(url, '\?.*$', ''), '^.*/', '') AS file, count(*) AS n FROM pages GROUP BY 1) SELECT n, count(*) AS n_files, min(file) AS first_file, max(file) AS last_file FROM f GROUP BY 1")
def _(spark, sf):
    return U.files_by_count(D.table(spark, sf, "pages"), "url")


@query("u09_total_mb", "SELECT round(sum(n_chars)/1048576, 6) AS total_mb FROM documents")
def _(spark, sf):
    return U.total_mb(D.table(spark, sf, "documents"), "n_chars")


@query(
    "u10_next_fit",
    """WITH RECURSIVE it AS (SELECT source, doc_id, CAST(n_chars AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id, n_chars) AS k FROM documents),
fold AS (
  SELECT source, doc_id, size, k, CASE WHEN 5000+size>200000 THEN 1 ELSE 0 END AS disk, CASE WHEN 5000+size>200000 THEN size ELSE 5000+size END AS used FROM it WHERE k=1
  UNION ALL
  SELECT it.source, it.doc_id, it.size, it.k, CASE WHEN used>0 AND used+it.size>200000 THEN disk+1 ELSE disk END, CASE WHEN used>0 AND used+it.size>200000 THEN it.size ELSE used+it.size END
  FROM fold JOIN it ON it.source=fold.source AND it.k=fold.k+1)
SELECT source, doc_id, size, disk, used FROM fold""",
)
def _(spark, sf):
    d = D.table(spark, sf, "documents").selectExpr("source", "doc_id", "n_chars AS size")
    return U.next_fit(d, "source", "doc_id", "size", 200_000, 5_000)


@query("u11_chunk_names", f"WITH t AS (SELECT DISTINCT {sql_tile_dir('lon_as', 'lat_as')} AS d FROM geo_points), c AS (SELECT DISTINCT string_split(d,'/')[1] AS chunk FROM t), n AS (SELECT chunk, CASE WHEN chunk[1]='w' THEN -1 ELSE 1 END*CAST(chunk[2:4] AS INT) AS lon, CASE WHEN chunk[5]='s' THEN -1 ELSE 1 END*CAST(chunk[6:7] AS INT) AS lat FROM c) SELECT chunk, lon, lat, (lon+180)*2 AS map_x, (90-lat)*2 AS map_y FROM n")
def _(spark, sf):
    c = D.geo_points(spark, sf).select(F.split(tile_dir(F.col("lon_as"), F.col("lat_as")), "/")[0].alias("chunk")).distinct()
    return c.select("chunk", U.parse_chunk_name(F.col("chunk")).alias("p")).select("chunk", "p.*")


@query("u12_age_class", "SELECT event_id, CASE WHEN epoch(TIMESTAMP '2024-02-01 00:00:00')-floor(epoch(ts)) < 7*86400 THEN 'fresh' WHEN epoch(TIMESTAMP '2024-02-01 00:00:00')-floor(epoch(ts)) < 14*86400 THEN 'recent' ELSE 'old' END AS age FROM events")
def _(spark, sf):
    return D.table(spark, sf, "events").select("event_id", U.age_class(F.col("ts").cast("timestamp"), F.expr("timestamp'2024-02-01 00:00:00'")).alias("age"))


@query("u13_sexagesimal", "SELECT c_custkey, round(radians((c_custkey%24 + (c_custkey%60)/60.0 + (c_custkey*7%60)/3600.0)*15), 9) AS ra, round(radians(CASE WHEN c_custkey%2=0 THEN -1 ELSE 1 END*(c_custkey%90 + (c_custkey*3%60)/60.0 + (c_custkey*11%60)/3600.0)), 9) AS decl FROM customer")
def _(spark, sf):
    t = D.table(spark, sf, "customer").selectExpr("c_custkey", "concat_ws(' ', c_custkey%24, c_custkey%60, c_custkey*7%60) AS ra", "concat(CASE WHEN c_custkey%2=0 THEN '-' ELSE '' END, concat_ws(' ', c_custkey%90, c_custkey*3%60, c_custkey*11%60)) AS decl")
    return t.select("c_custkey", F.round(U.sexagesimal_radians(F.col("ra"), True), 9).alias("ra"), F.round(U.sexagesimal_radians(F.col("decl"), False), 9).alias("decl"))


@query("u14_boundaries", "SELECT o_orderkey, o_orderpriority, l_linenumber, l_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)-1 AS seg_no FROM orders JOIN lineitem ON o_orderkey=l_orderkey WHERE o_orderstatus='F'")
def _(spark, sf):
    o = D.table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderpriority", "o_orderstatus")
    li = D.table(spark, sf, "lineitem").selectExpr("l_orderkey AS o_orderkey", "l_linenumber", "l_partkey", "struct(l_linenumber, l_partkey, l_suppkey) AS s")
    return U.assemble_boundaries(o, li, "o_orderkey", "s", F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority", "l_linenumber", "l_partkey", "seg_no")


@query("u15_tile_runs", """WITH s AS (SELECT line_id, seq, ((x+lead(x) OVER w)//2)//2500*1000+((y+lead(y) OVER w)//2)//2500 AS tile FROM track_points WINDOW w AS (PARTITION BY line_id ORDER BY seq)),
 r AS (SELECT *, CASE WHEN lag(tile) OVER (PARTITION BY line_id ORDER BY seq) IS NOT DISTINCT FROM tile THEN 0 ELSE 1 END AS c FROM s WHERE tile IS NOT NULL), n AS (SELECT *, CAST(sum(c) OVER (PARTITION BY line_id ORDER BY seq) AS BIGINT)-1 AS run FROM r)
 SELECT line_id, run, min(tile) AS tile, min(seq) AS first_seq, max(seq) AS last_seq FROM n GROUP BY 1,2""")
def _(spark, sf):
    w = W.partitionBy("line_id").orderBy("seq")
    mid = lambda c: F.floor(F.floor((F.col(c) + F.lead(c).over(w)) / 2) / 2500)
    return U.tile_runs(D.track_points(spark, sf), "line_id", "seq", mid("x") * 1000 + mid("y"))


@query("u16_class_counters", "WITH c AS (SELECT substr(p_type,1,1) AS k, p_size FROM part), m AS (SELECT CASE WHEN k IN ('S','L','M','E','P') THEN k ELSE 'S' END AS k FROM c) SELECT count(*) FILTER (k='S') AS n_s, count(*) FILTER (k='L') AS n_l, count(*) FILTER (k='M') AS n_m, count(*) FILTER (k='E') AS n_e, count(*) FILTER (k='P') AS n_p FROM m")
def _(spark, sf):
    return U.letter_counters(D.table(spark, sf, "part").selectExpr("substr(p_type,1,1) AS k"), "k", "SLMEP", "S")


@query("u17_mean_position", "SELECT poly_id, round(avg(x),6) AS mean_x, round(avg(y),6) AS mean_y FROM poly_verts WHERE ring=0 GROUP BY 1")
def _(spark, sf):
    return D.poly_verts(spark, sf).where("ring=0").groupBy("poly_id").agg(F.round(F.avg("x"), 6).alias("mean_x"), F.round(F.avg("y"), 6).alias("mean_y"))


@query("u18_waypoint_selection", "SELECT p_partkey FROM part WHERE p_type IN ('LARGE','PROMO','ECONOMY') AND p_size%5<>0 AND (p_type<>'PROMO' OR EXISTS (SELECT 1 FROM supplier WHERE s_suppkey=p_partkey%200))")
def _(spark, sf):
    p = D.table(spark, sf, "part").where("p_type IN ('LARGE','PROMO','ECONOMY') AND p_size%5<>0").withColumn("s_suppkey", F.col("p_partkey") % 200)
    known = p.where("p_type='PROMO'").join(D.table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", "left_semi")
    return p.where("p_type<>'PROMO'").unionByName(known).select("p_partkey")


@query("u19_flag_counters", "SELECT count(*) FILTER (contains(p_name,'r')) AS has_r, count(*) FILTER (contains(p_name,'g')) AS has_g, count(*) FILTER (contains(p_name,'w')) AS has_w FROM part")
def _(spark, sf):
    return U.flag_counters(D.table(spark, sf, "part"), "p_name", "rgw")


@query("u20_frequency_display", "SELECT line_no, CASE WHEN freq100%2=0 THEN concat(CAST(freq100//100 AS VARCHAR),'.',lpad(CAST(freq100%100 AS VARCHAR),2,'0'),' MHz') ELSE concat(CAST(freq100 AS VARCHAR),' kHz') END AS freq FROM nav_detail WHERE magvar<>0")
def _(spark, sf):
    mhz = F.concat(F.floor(F.col("freq100") / 100).cast("string"), F.lit("."), F.lpad((F.col("freq100") % 100).cast("string"), 2, "0"), F.lit(" MHz"))
    return D.nav_detail(spark, sf).where("magvar<>0").select("line_no", F.when(F.col("freq100") % 2 == 0, mhz).otherwise(F.concat(F.col("freq100").cast("string"), F.lit(" kHz"))).alias("freq"))


@query("u21_components_pivot", "SELECT l_orderkey, min(l_partkey) FILTER (l_linenumber=1) AS outer_marker, min(l_partkey) FILTER (l_linenumber=2) AS middle_marker, min(l_partkey) FILTER (l_linenumber=3) AS inner_marker, min(l_partkey) FILTER (l_linenumber=4) AS glide FROM lineitem GROUP BY 1")
def _(spark, sf):
    wide = U.pivot_first(D.table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", [1, 2, 3, 4], "l_partkey")
    return wide.toDF("l_orderkey", "outer_marker", "middle_marker", "inner_marker", "glide")
