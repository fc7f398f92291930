"""Queries of the sources and sinks: each writes what it reads to the shared folder first, where it needs files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tileweave.functions.shared import shared_dir
from tileweave.operators.tiles import assign_tiles
from tileweave.plans.mesh import FACES, NF, node_faces
from tileweave.functions.geo import sql_tile_dir, sql_tile_id
from tileweave.registry import query
from tileweave.sources import derived as D
from tileweave.sources import io as X


def place(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}"


@query("x01_read_features", "SELECT 'part' AS layer, p_partkey AS k, p_type AS material FROM part UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier")
def _(spark, sf):
    f = X.read_features(spark, {n: f"{sf}/{n}.parquet" for n in ("part", "supplier", "region")}, ["part", "supplier"])
    return f.select("layer", F.coalesce("p_partkey", "s_suppkey").alias("k"), F.col("p_type").alias("material"))


@query("x02_height_sheets", "SELECT 'N' || lpad(CAST(tile_no%60 AS VARCHAR),2,'0') || 'W' || lpad(CAST(100+tile_no//60 AS VARCHAR),3,'0') AS sheet, -(100+tile_no//60) AS lon, tile_no%60 AS lat, row, count(elev) AS n, CAST(sum(elev*(col+1)) AS BIGINT) AS s FROM (SELECT tile_no, col, row, elev FROM grid_cells UNION ALL SELECT top//64, 0, unnest(range(top%64+1, 64)), NULL FROM (SELECT max(vec_id) AS top FROM embeddings) t) g GROUP BY tile_no, row")
def _(spark, sf):
    # the last sheet's missing rows are void
    top = D.table(spark, sf, "embeddings").agg(F.max("vec_id").alias("top")).where("top%64 < 63")
    rest = top.selectExpr("top div 64 AS tile_no", "explode(sequence(top%64+1, 63L)) AS row").selectExpr("tile_no", "explode(sequence(0L, 63L)) AS col", "row", "cast(null AS bigint) AS elev")
    g = D.grid_cells(spark, sf).unionByName(rest)
    word = F.lpad(F.hex(F.coalesce("elev", F.lit(X.VOID)).bitwiseAND(65535)), 4, "0")
    pages = g.groupBy("tile_no").agg(F.array_sort(F.collect_list(F.struct((-F.col("row")).alias("r"), "col", word.alias("h")))).alias("a"))
    name = F.format_string("sheets/N%02dW%03d.hgt", F.col("tile_no") % 60, F.floor(F.col("tile_no") / 60) + 100)
    files = pages.select(name.alias("path"), F.unhex(F.array_join(F.transform("a", lambda s: s["h"]), "")).alias("content"))
    cells = X.unpack_sheets(files, 64).select("sheet", "lon", "lat", "row", F.posexplode("elevs").alias("col", "e"))
    return cells.groupBy("sheet", "lon", "lat", "row").agg(F.count("e").alias("n"), F.sum(F.col("e").cast("long") * (F.col("col") + 1)).alias("s"))


@query("x03_record_lines", "SELECT line_no, CAST(string_split(txt,' ')[1] AS INT) AS code, len(string_split(txt,' ')) AS n_fields FROM record_lines")
def _(spark, sf):
    # ordered part files, written and read in parallel
    p = place(spark)
    D.record_lines(spark, sf).orderBy("line_no").select("txt").write.text(p)
    return X.record_rows(X.read_record_lines(spark, p, through=True)).select("line_no", "code", F.size("f").cast("long").alias("n_fields"))


@query("x04_delimited", "SELECT CAST(string_split(line,'|')[2] AS BIGINT) AS id, CAST(string_split(line,'|')[16] AS BIGINT) AS top FROM tower_lines")
def _(spark, sf):
    p = place(spark)
    D.tower_lines(spark, sf).write.text(p)
    return X.read_delimited(spark, p, "|", ", ".join(f"f{i} string" for i in range(16))).selectExpr("cast(f1 AS bigint) AS id", "cast(f15 AS bigint) AS top")


@query("x05_area_defs", "SELECT row_number() OVER (ORDER BY m)-3 AS priority, m AS name, 'c'||m AS category, CASE row_number() OVER (ORDER BY m) WHEN 1 THEN 'default' WHEN 2 THEN 'sliver' ELSE 'area' END AS role FROM (SELECT DISTINCT p_type AS m FROM part) t")
def _(spark, sf):
    t = D.table(spark, sf, "part").select("p_type").distinct()
    lines = t.selectExpr("p_type AS k", "concat(p_type, '  c', p_type, ' # note') AS txt").unionByName(t.selectExpr("concat(p_type, '#') AS k", "'# comment' AS txt")).selectExpr("k AS line_no", "txt")
    return X.area_defs_of(lines)


@query("x06_write_tiles", f"WITH f AS (SELECT {sql_tile_dir('lon_as', 'lat_as')} AS tile_dir, {sql_tile_id('lon_as', 'lat_as')} AS tile, CASE WHEN pt_id%2=0 THEN 'a' ELSE 'b' END AS material FROM geo_points) SELECT tile_dir, tile, material, count(*) AS n FROM f GROUP BY 1,2,3")
def _(spark, sf):
    p = place(spark)
    X.write_tiles(assign_tiles(D.geo_points(spark, sf)).withColumn("material", F.expr("CASE WHEN pt_id%2=0 THEN 'a' ELSE 'b' END")), p)
    return spark.read.schema("pt_id long, lon_as long, lat_as long, tile_dir string, tile long, material string").parquet(p).groupBy("tile_dir", "tile", "material").agg(F.count("*").alias("n"))


OBJ = f"obj AS (SELECT {sql_tile_id('lon_as', 'lat_as')} AS tile, CASE pt_id%4 WHEN 0 THEN concat('OBJECT m', pt_id%9, '.btg') WHEN 1 THEN concat('OBJECT_SHARED m', pt_id%9, '.btg ', lon_as, ' ', lat_as, ' ', pt_id%500, ' ', pt_id%360) WHEN 2 THEN concat('OBJECT_SIGN m', pt_id%9, '.btg ', lon_as, ' ', lat_as, ' ', pt_id%500, ' ', pt_id%360) ELSE concat('LINEAR_FEATURE m', pt_id%9, '.btg ', lon_as, ' ', lat_as) END AS line FROM geo_points)"


def objects(spark, sf):
    o = assign_tiles(D.geo_points(spark, sf)).selectExpr("tile", "CASE pt_id%4 WHEN 0 THEN 'object' WHEN 1 THEN 'shared' WHEN 2 THEN 'sign' ELSE 'lights' END AS kind", "concat('m', pt_id%9, '.btg') AS model", "lon_as", "lat_as", "pt_id%500 AS elev", "pt_id%360 AS heading")
    return X.object_index(o)


@query("x07_object_index", f"WITH {OBJ} SELECT * FROM obj")
def _(spark, sf):
    return objects(spark, sf)


@query("x08_tile_manifest", f"WITH {OBJ}, u AS (SELECT DISTINCT tile, 0 AS k, concat('OBJECT ', tile, '.btg') AS line FROM obj UNION ALL SELECT tile, 1, line FROM obj) SELECT tile, string_agg(line, chr(10) ORDER BY k, line) AS txt FROM u GROUP BY 1")
def _(spark, sf):
    o = objects(spark, sf)
    bases = o.select("tile").distinct().selectExpr("tile", "concat('OBJECT ', tile, '.btg') AS base")
    return X.tile_manifest(bases, o).select("tile", F.array_join("lines", "\n").alias("txt"))


@query("x09_mesh_to_rings", "WITH l AS (SELECT l_orderkey AS g, l_orderkey%3 AS kind, l_partkey AS node, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)-1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem), r AS (SELECT DISTINCT g, kind, unnest(range(CASE WHEN kind=0 THEN n//3 ELSE n-2 END)) AS ring FROM l), s AS (SELECT g, ring, c.range AS seq, CASE WHEN kind=0 THEN 3*ring+c.range WHEN kind=1 THEN CASE WHEN c.range=0 THEN 0 ELSE ring+c.range END WHEN ring%2=0 OR c.range=2 THEN ring+c.range ELSE ring+1-c.range END AS i FROM r, range(3) c) SELECT g AS group_id, ring, seq, node FROM s JOIN l USING (g, i)")
def _(spark, sf):
    li = D.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda s: s["l_partkey"]).alias("nodes"))
    return X.mesh_to_rings(li.selectExpr("l_orderkey AS group_id", "CASE l_orderkey%3 WHEN 0 THEN 'triangles' WHEN 1 THEN 'fan' ELSE 'strip' END AS kind", "nodes"))


@query("x10_stale", "SELECT o_orderkey AS name FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem WHERE l_linenumber<3 GROUP BY 1) l ON l_orderkey=o_orderkey WHERE m IS NULL OR o_orderdate > m")
def _(spark, sf):
    s = D.table(spark, sf, "orders").selectExpr("o_orderkey AS name", "o_orderdate AS mtime")
    o = D.table(spark, sf, "lineitem").where("l_linenumber<3").groupBy(F.col("l_orderkey").alias("name")).agg(F.max("l_shipdate").alias("mtime"))
    return X.stale(s, o).select("name")


@query("x11_stage", f"WITH {FACES}{NF} SELECT tile_no AS tile, count(*) AS n, CAST(sum(n1+n2+n3) AS BIGINT) AS s FROM nf GROUP BY 1")
def _(spark, sf):
    p = place(spark)
    X.save_stage(node_faces(spark, sf).select(F.col("tile_no").alias("tile"), "face_id", F.array("n1", "n2", "n3").alias("vidx"), F.array(F.lit(-1).cast("long")).alias("nidx"), F.array(F.lit(False)).alias("cons")), p)
    f = spark.read.schema(X.FACE_SCHEMA).parquet(p)
    return f.groupBy("tile").agg(F.count("*").alias("n"), F.sum(F.aggregate("vidx", F.lit(0).cast("long"), lambda a, v: a + v)).alias("s"))
