"""Hand-made edge cases, empty inputs, and invariants of the operators that have no SQL counterpart."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tileweave.functions.geo import tile_dir, tile_id
from tileweave.operators import features, graph, landcover, mesh, network, overlay, raster, records, reports, rings
from tileweave.operators import tiles as T
from tileweave.sources import derived as D
from tileweave.sources import io as X

SF = "/root/testdata/sf0.001"
RING = "poly_id long, ring int, seq int, x long, y long"


def ring(spark, points, poly_id=1):
    return spark.createDataFrame([(poly_id, 0, k, x, y) for k, (x, y) in enumerate(points)], RING)


def places(df):
    return [(r["x"], r["y"]) for r in df.orderBy("seq").collect()]


#: (longitude, latitude) in arcseconds and the tile's id, worked out by hand from the id's parts:
#: degrees east of -180, degrees north of -90, eighth of a degree north, column of that row.
TILES = {
    (-440549, 135427): (57 << 14) + (127 << 6) + (4 << 3) + 2,  # the airport of San Francisco, 942050
    (0, 0): (180 << 14) + (90 << 6),
    (-1, -1): (179 << 14) + (89 << 6) + (7 << 3) + 7,
    (449, 450): (180 << 14) + (90 << 6) + (1 << 3),
    (450, 79199): (180 << 14) + (111 << 6) + (7 << 3) + 1,
    (450, 79200): (180 << 14) + (112 << 6),
    (900, 79200): (180 << 14) + (112 << 6) + 1,
    (1800, 223200): (180 << 14) + (152 << 6) + 1,
    (3600, 273600): (181 << 14) + (166 << 6),
    (647999, 298800): (358 << 14) + (173 << 6),
    (-648000, 320400): (179 << 6),
    (-648000, -324000): 0,
}


def test_tile_ids_at_bands_and_poles(spark):
    df = spark.createDataFrame(list(TILES), "lon_as long, lat_as long")
    got = {(r["lon_as"], r["lat_as"]): r["t"] for r in df.withColumn("t", tile_id(F.col("lon_as"), F.col("lat_as"))).collect()}
    assert got == TILES
    d = spark.createDataFrame([(-439200 - 1800, 133200 + 10)], "lon_as long, lat_as long").select(tile_dir(F.col("lon_as"), F.col("lat_as")))
    assert d.first()[0] == "w130n30/w123n37"


def test_tile_bounds_hold_their_points(spark):
    p = T.assign_tiles(D.geo_points(spark, SF))
    b = T.tile_bounds(p).where("abs(lat_as) < 83*3600")
    assert b.where("NOT (lon_as >= west AND lon_as < west+width AND lat_as >= south AND lat_as < south+height)").count() == 0


def test_neighbors_are_mutual(spark):
    t = T.assign_tiles(D.geo_points(spark, SF)).where("abs(lat_as) < 80*3600").select("tile")
    n = T.tile_neighbors(t)
    back = T.tile_neighbors(n.select(F.col("neighbor").alias("tile")))
    assert n.join(back.select(F.col("tile").alias("neighbor"), F.col("neighbor").alias("tile")), ["tile", "neighbor"], "left_anti").count() == 0


def test_skip_records(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert features.skip_records(df, 990, "k").count() == 10
    with pytest.raises(ValueError):
        features.skip_records(df, 1000, "k")
    good, _ = features.split_bad(df, F.col("k") == 5, strict=True)
    with pytest.raises(Exception, match="unsupported geometry"):
        good.collect()


CELLS = "tile_no long, col long, row long, elev long"


def test_fill_of_void_and_zero_tiles(spark):
    void = spark.createDataFrame([(0, c, r, None) for c in range(3) for r in range(3)], CELLS)
    assert {r["elev"] for r in raster.fill_voids(void).collect()} == {0}
    one = spark.createDataFrame([(0, c, r, 7 if (c, r) == (1, 1) else None) for c in range(3) for r in range(3)], CELLS)
    assert {r["elev"] for r in raster.fill_voids(one).collect()} == {7}
    zero = spark.createDataFrame([(0, c, r, 0) for c in range(3) for r in range(3)], CELLS)
    assert raster.drop_zero_tiles(zero).count() == 0
    assert raster.fill_voids(zero.limit(0)).count() == 0


def test_selected_points_bound_the_error_and_count(spark):
    hill = spark.createDataFrame([(t, c, r, int(200 * math.sin(c / 5) * math.cos(r / 7)) if t else c + r) for t in range(2) for c in range(33) for r in range(33)], CELLS)
    p = raster.select_points(hill, 40, 20, 300)
    n = {r["tile_no"]: r["count"] for r in p.groupBy("tile_no").count().collect()}
    assert n[0] == 20 and 20 <= n[1] <= 300
    assert p.join(hill, ["tile_no", "col", "row", "elev"]).count() == p.count()


def test_slopes_are_limited(spark):
    z = spark.createDataFrame([(0, c, r, 1000 if (c, r) == (3, 3) else 0) for c in range(7) for r in range(7)], CELLS)
    out = raster.limit_slope(z, 10, 7)
    assert out.agg(F.max("elev")).first()[0] == 10
    assert raster.limit_slope(out, 10, 2).exceptAll(out).count() == 0


def test_surface_fits_a_cubic_exactly(spark):
    p = spark.createDataFrame([(1, u / 5, v / 5, 3 + u / 5 - 2 * (v / 5) ** 3 + (u / 5) ** 2 * (v / 5)) for u in range(-5, 6) for v in range(-5, 6)], "tile_no long, u double, v double, elev double")
    e = raster.eval_surface(p, raster.fit_surface(p))
    assert e.agg(F.max(F.abs(F.col("elev") - F.col("elev_fit")))).first()[0] < 1e-5


def test_components_and_absorption(spark):
    grid = ["aab", "bab", "bbb"]
    cells = spark.createDataFrame([(0, x, y, ord(c)) for y, line in enumerate(grid) for x, c in enumerate(line)], "tile_no long, x long, y long, cls long")
    assert landcover.components(cells).select("area").distinct().count() == 2
    assert landcover.absorb_small(cells, (4,)).select("cls").distinct().count() == 1


def test_connected_components_of_a_long_chain(spark):
    e = spark.range(200).selectExpr("id AS a", "id+1 AS b")
    assert {r["component"] for r in graph.connected_components(e).collect()} == {0}
    assert graph.connected_components(e.limit(0)).count() == 0


def test_ring_cleaning(spark):
    spike = ring(spark, [(0, 0), (10, 0), (30, 0), (10, 0), (10, 10), (0, 10)])
    assert (30, 0) not in places(rings.remove_spikes(spike))
    line = ring(spark, [(0, 0), (5, 0), (10, 0), (10, 10), (0, 10)])
    assert places(rings.remove_collinear(line)) == [(0, 0), (10, 0), (10, 10), (0, 10)]
    twice = ring(spark, [(0, 0), (0, 0), (10, 0), (10, 10), (0, 0)]).withColumn("z", F.col("seq"))
    out = rings.remove_duplicates(twice)
    assert places(out) == [(0, 0), (10, 0), (10, 10)] and out.agg(F.max("z")).first()[0] == 4
    assert rings.drop_small(ring(spark, [(0, 0), (1, 1)])).count() == 0


def test_figure_eight_splits(spark):
    out = rings.split_cycles(ring(spark, [(0, 0), (5, 5), (10, 0), (10, 10), (5, 5), (0, 10)]))
    parts = {r["cycle"]: r["n"] for r in out.groupBy("cycle").agg(F.count("*").alias("n")).collect()}
    assert sorted(parts.values()) == [3, 3]


def test_clip_across_a_corner(spark):
    r = ring(spark, [(-5, -5), (5, -5), (5, 5), (-5, 5)])
    out = rings.clip_rect(r, rings.RING, (F.lit(0), F.lit(100), F.lit(0), F.lit(100)))
    assert sorted(places(out)) == [(0, 0), (0, 5), (5, 0), (5, 5)]
    assert rings.clip_rect(r, rings.RING, (F.lit(50), F.lit(100), F.lit(0), F.lit(100))).count() == 0


def test_chopping_conserves_area(spark):
    v = D.poly_verts(spark, SF)
    a = {r["poly_id"]: r["area2"] for r in rings.polygon_areas(v).collect()}
    b = {}
    for r in rings.areas(rings.chop_to_tiles(v), ["tile", *rings.RING]).collect():
        b[r["poly_id"]] = b.get(r["poly_id"], 0) + (1 if r["ring"] == 0 else -1) * abs(r["area2"])
    # cut places are rounded to whole units, so an edge may turn by half a unit along its length
    around = {}
    for r in rings.around(rings.RING, "x", "y", df=v, back=False).collect():
        around[r["poly_id"]] = around.get(r["poly_id"], 0) + math.hypot(r["n_x"] - r["x"], r["n_y"] - r["y"])
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= around[k] for k in a)


@pytest.mark.parametrize("margin", [0, 1])
def test_chopping_by_chunks_equals_chopping_at_once(spark, margin):
    rng = np.random.default_rng(3)
    rows = []
    # a concave ring over longitude 0 and the band at 22 degrees, one among wide tiles at 83 degrees, and one inside a chunk
    for poly, cx, cy, rx, ry, n in ((1, 300, 79000, 6500, 4200, 240), (2, 20000, 299000, 16000, 2500, 60), (3, 1800, 1800, 900, 900, 12)):
        for k in range(n):
            r, a = rng.uniform(0.25, 1), 2 * math.pi * k / n
            rows.append((poly, 0, k, int(cx + rx * r * math.cos(a)), int(cy + ry * r * math.sin(a)), False, "m"))
    v = spark.createDataFrame(rows, RING + ", is_hole boolean, material string")
    whole, parts = [rings.chop_to_tiles(v, margin, chunk).persist() for chunk in (None, 3600)]
    area = lambda df: {(r["tile"], r["poly_id"]): r["area2"] for r in rings.areas(df, ["tile", *rings.RING]).collect() if r["area2"]}
    assert area(parts) == area(whole) and len(area(whole)) > 200

    def inner(df):
        # the vertices within a tile, in their order from the smallest; border stretches without width may differ
        b = T.tile_bounds(df).where(f"x > west-{margin} and x < west+width+{margin} and y > south-{margin} and y < south+height+{margin}")
        found = {}
        for r in b.orderBy("seq").collect():
            found.setdefault((r["tile"], r["poly_id"]), []).append((r["x"], r["y"]))
        return {k: p[p.index(min(p)) :] + p[: p.index(min(p))] for k, p in found.items()}

    assert inner(parts) == inner(whole)
    west, east = F.lit(0), F.lit(3600)
    thin = rings.thin_outside(v.where("poly_id = 1"), rings.RING, (west, east, F.lit(75600), F.lit(79200)))
    assert thin.count() < 150


def test_rasterized_cells_match_the_area(spark):
    square = ring(spark, [(0, 0), (100, 0), (100, 100), (0, 100)])
    assert overlay.rasterize(square, 10).count() == 100


def test_quads_have_the_width(spark):
    line = spark.createDataFrame([(1, 0, 0, 0, 4), (1, 1, 10, 0, 4), (1, 2, 10, 10, 4)], "line_id long, seq long, x long, y long, width long")
    got = {(r["seq"], r["corner"]): (r["x"], r["y"]) for r in rings.line_quads(line).collect()}
    assert got[0, 0] == (0.0, -2.0) and got[0, 3] == (0.0, 2.0)
    assert got[0, 1] == got[1, 0] == (12.0, -2.0)


def test_node_matching_is_symmetric(spark):
    a = spark.createDataFrame([("b", p) for p in (0, 100, 205, 400)], "border string, pos long")
    b = spark.createDataFrame([("b", p) for p in (0, 110, 203, 900)], "border string, pos long")
    ab = {(r["pos2"], r["kind"]) for r in mesh.match_edges(a, b, 4, 20).collect()}
    ba = {(r["pos2"], {"current": "neighbor", "neighbor": "current"}.get(r["kind"], r["kind"])) for r in mesh.match_edges(b, a, 4, 20).collect()}
    assert ab == ba
    assert ("merged" in {k for _, k in ab}) and (210, "merged") in ab


def test_clusters_leave_fixed_nodes(spark):
    n = spark.createDataFrame([(1, 0, 0, True), (2, 3, 0, False), (3, 100, 0, False), (4, 102, 0, False)], "node_id long, x long, y long, fixed boolean")
    got = {r["node_id"]: (r["cx"], r["cy"]) for r in mesh.cluster_nodes(n, 5).collect()}
    assert got[1] == got[2] == (0.0, 0.0) and got[3] == got[4] == (101.0, 0.0)


def test_normals_are_unit_and_degenerate_faces_point_up(spark):
    f = spark.createDataFrame([(0, 0, 0, 1, 1, 1, 2, 2, 2), (0, 0, 0, 10, 0, 0, 0, 10, 5)], ", ".join(f"{c}{k} long" for k in (1, 2, 3) for c in "xyz"))
    for r in mesh.face_normals(f).collect():
        assert abs(r["nx"] ** 2 + r["ny"] ** 2 + r["nz"] ** 2 - 1) < 1e-9
    assert mesh.face_normals(f).where("area = 0").first()["nz"] == 1.0


def test_antennas_are_peeled(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "a long, b long")
    assert sorted((r["a"], r["b"]) for r in mesh.peel_antennas(e, 3).collect()) == [(1, 2), (2, 3), (3, 1)]


def test_network_splits_at_a_crossing(spark):
    s = spark.createDataFrame([(1, 0, 0, 10, 10), (2, 0, 10, 10, 0), (3, 50, 50, 50, 50)], "seg_id long, ax long, ay long, bx long, by long")
    out = network.split_at_crossings(s, 4)
    assert {(r["seg_id"], r["part"]) for r in out.collect()} == {(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)}


def test_records_before_any_header_and_without_end(spark):
    lines = spark.createDataFrame([(0, "100 1 1 0 0 0 0"), (1, "# note"), (2, ""), (3, "1 10 0 0 KA Field A"), (4, "100 1 1 0 0 0 0"), (5, "99"), (6, "100 1 1 0 0 0 0")], "line_no long, txt string")
    got = {r["line_no"]: r["grp"] for r in records.assign_groups(records.parse_lines(lines), 2).collect()}
    assert got == {3: 3, 4: 3}
    open_end = records.assign_groups(records.parse_lines(lines.where("line_no < 5")), 2)
    assert open_end.count() == 2 and records.assign_groups(records.parse_lines(lines.limit(0))).count() == 0
    nodes = spark.createDataFrame([(1, 1, 113), (1, 2, 111), (1, 3, 115)], "grp long, line_no long, code int")
    assert [r["line_no"] for r in records.node_rings(nodes).orderBy("line_no").collect()] == [2, 3]


def test_next_fit_fills_in_order(spark):
    df = spark.createDataFrame([("g", k, s) for k, s in enumerate((60, 50, 40, 200, 10))], "g string, k long, s long")
    got = [(r["disk"], r["used"]) for r in reports.next_fit(df, "g", "k", "s", 100, 10).orderBy("k").collect()]
    assert got == [(0, 70), (1, 50), (1, 90), (2, 200), (3, 10)]


def test_sheets_of_a_wrong_size_raise(spark):
    f = spark.createDataFrame([("a/N37W122.hgt", bytearray(b"\x00\x01" * 4))], "path string, content binary")
    assert X.unpack_sheets(f, 2).first()["lon"] == -122
    with pytest.raises(Exception, match="N37W122"):
        X.unpack_sheets(f, 3).collect()


def test_record_lines_and_area_defs(spark, tmp_path):
    p = tmp_path / "areas.txt"
    p.write_text("# header\nDefault\nSliver\n\nRoad road # note\nLake lake\n")
    rows = {r["name"]: (r["priority"], r["role"]) for r in X.read_area_defs(spark, str(p)).collect()}
    assert rows["Default"][1] == "default" and rows["Sliver"][1] == "sliver" and rows["Lake"] == (1, "area")
    with pytest.raises(ValueError):
        X.read_features(spark, {"a": "x"}, ["b"])


def test_the_rest_does_not_import_the_subpackage():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = "import sys; sys.path.insert(0, %r); import tileweave.registry; print([m for m in sys.modules if m.startswith('tileweave.llm')])" % str(root)
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "[]"


def test_slopes_are_limited_over_a_whole_tile(spark):
    z = spark.createDataFrame([(0, c, r, 0 if c == 0 else 1000) for c in range(64) for r in range(3)], CELLS)
    out = raster.limit_slope(z, 10, 6)
    assert {(r["col"], r["elev"]) for r in out.collect()} == {(c, 10 * c) for c in range(64)}


def test_slopes_of_tiles_take_one_shuffle(spark):
    z = spark.createDataFrame([(0, 5, 5, 900), (0, 5, 5, 70), (0, 6, 5, 400), (0, 8, 5, 700), (0, 6, 6, None), (1, 6, 5, 0), (1, 5, 4, 300), (1, None, 4, 300)], CELLS)
    out = raster.limit_slope(z, 10, 6)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in out.collect()} == {(0, 5, 5, 90), (0, 6, 5, 80), (0, 8, 5, 700), (1, 6, 5, 0), (1, 5, 4, 10), (1, None, 4, 300)}


def test_a_long_chain_is_peeled(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), *[(k, k + 1) for k in range(3, 13)]], "a long, b long")
    assert sorted((r["a"], r["b"]) for r in mesh.peel_antennas(e).collect()) == [(1, 2), (2, 3), (3, 1)]


def test_clusters_are_stable(spark):
    # places that take four rounds until none changes its cluster
    p = np.unique(np.random.default_rng(30).integers(0, 170, (900, 2)), axis=0).tolist()
    n = spark.createDataFrame([(k, x, y, False) for k, (x, y) in enumerate(p)], "node_id long, x long, y long, fixed boolean")
    near = lambda a, x, y: (a[0] - x) ** 2 + (a[1] - y) ** 2
    got = {r["node_id"]: (r["cluster"], r["cx"], r["cy"]) for r in mesh.cluster_nodes(n, 5).collect()}
    centres = {c: (x, y) for c, x, y in got.values()}
    for k, (x, y) in enumerate(p):
        reached = min(near(m, x, y) for m in centres.values())
        assert reached > 25 or near(centres[got[k][0]], x, y) < reached + 0.01
    assert {r["node_id"]: r["cluster"] for r in mesh.cluster_nodes(n, 5, 2).collect()} != {k: v[0] for k, v in got.items()}


def test_nested_loops_split_into_simple_cycles(spark):
    # a ring of 3,000 vertices that visits one place at 500 and 2,500, and another at 1,000 and 1,500
    points = [(k, k * k % 7919) for k in range(3000)]
    points[2500], points[1500] = points[500], points[1000]
    out = rings.split_cycles(ring(spark, points))
    assert sorted(r["n"] for r in out.groupBy("cycle").agg(F.count("*").alias("n")).collect()) == [500, 1000, 1500]
    assert out.groupBy("cycle", "x", "y").count().where("count > 1").count() == 0 and out.count() == 3000
    # the same cuts in rings of unlike length, and loops one after another
    twice = ring(spark, [(0, 0), (1, 1), (2, 2), (1, 1), (3, 3), (1, 1), (4, 4)]).unionByName(ring(spark, [(9, 9), (8, 8), (9, 9), (7, 7)], 2))
    sizes = sorted((r["poly_id"], r["n"]) for r in rings.split_cycles(twice).groupBy("poly_id", "cycle").agg(F.count("*").alias("n")).collect())
    assert sizes == [(1, 2), (1, 2), (1, 3), (2, 2), (2, 2)]


def test_spikes_go_until_none_is_left(spark):
    # out and back over the same nine places
    out = [(0, 0), (100, 0), *[(100 + 10 * k, 0) for k in range(1, 10)], *[(100 + 10 * k, 0) for k in range(8, -1, -1)], (100, 100), (0, 100)]
    got = places(rings.remove_spikes(ring(spark, out), rounds=2))
    assert max(x for x, _ in got) <= 110 and {(0, 0), (100, 100), (0, 100)} <= set(got)


def test_towers_by_height_and_hemisphere(spark):
    line = lambda i, h, ns, ew: f"DE|{i}||10|30|0|{ns}||20|15|0|{ew}||0|{h}|{1000 + h}"
    t = reports.parse_towers(spark.createDataFrame([(line(1, 99, "", ""),), (line(2, 100, "N", " W "),), (line(3, 199, "S", "E"),), (line(4, 200, " ", "X"),), (line(5, 640, "X", "W"),)], "line string"))
    assert {r["id"]: (r["lat_as"], r["lon_as"]) for r in t.collect()} == {1: (37800, -72900), 2: (37800, -72900), 3: (-37800, 72900), 4: (37800, 72900), 5: (-37800, -72900)}
    assert {r["id"]: (r["size"], r["base_elev"]) for r in reports.classify_towers(t).collect()} == {2: ("medium", 900), 3: ("medium", 999), 4: ("tall", 590), 5: ("tall", 1030)}
    s = reports.tower_summary(t).first()
    assert (s["n_short"], s["n_medium"], s["n_tall"], s["min_height"], s["max_height"]) == (1, 2, 2, 99, 640)


def test_land_cover_rows_are_counted_from_the_south(spark):
    cells = spark.createDataFrame([(1, 21599, 7), (0, 21600, 8), (43199, 1, 9)], "x long, y long, cls long")
    p = spark.createDataFrame([(1, -179.99, -89.99), (2, -180.0, -90.0), (3, 179.995, 89.995), (4, 0.0, 91.0), (5, 180.5, 0.0)], "k int, lon double, lat double")
    assert {r["k"]: r["cls"] for r in landcover.class_at(p, cells).collect()} == {1: 7, 2: 8, 3: 9, 4: -1, 5: -1}
    grid = spark.createDataFrame([(0, 1, 1, 3), (0, 0, 2, 5), (0, 1, 0, 6)], "tile_no long, x long, y long, cls long")
    # column by column: the cell to the west comes before the one below
    assert landcover.borrow_class(grid, 3).where("x=1 AND y=1").first()["cls"] == 5


def test_profiles_are_cleaned_in_metres(spark):
    z = spark.createDataFrame([(0, 0, r, e) for r, e in enumerate((40000, 12000, 33000, 32000))], CELLS)
    assert [r["elev_m"] for r in raster.clean_profile(z).orderBy("row").collect()] == [0.0, 3657.6, 3657.6, 9753.6]


def test_samples_at_voids_take_the_nearest_cell(spark):
    z = spark.createDataFrame([(0, c, r, None if (c, r) == (1, 1) else 10 * c + r) for c in range(3) for r in range(3)], CELLS)
    p = spark.createDataFrame([(1, 0, 12, 9), (2, 0, 20, 20), (3, 0, 21, 0), (4, 0, 5, 0)], "pt_id long, tile_no long, x long, y long")
    assert {r["pt_id"]: r["elev"] for r in raster.sample_elevation(p, z, 3, 10).collect()} == {1: 21.0, 2: 22.0, 3: None, 4: 0.0}
    assert raster.sample_elevation(p, z, 3, 10, fallback=False).where("pt_id = 1").first()["elev"] is None


def test_curve_steps_by_length(spark):
    def steps(*nodes):
        df = spark.createDataFrame([(1, 0, k, *n) for k, n in enumerate(nodes)], "poly_id int, ring int, seq int, x double, y double, cx double, cy double")
        return rings.flatten_bezier(df, rings.RING).count()

    # there and back: both edges of each pair are alike
    assert steps((0.0, 0.0, None, None), (7.0, 0.0, None, None)) == 2
    assert steps((0.0, 0.0, None, None), (50.0, 0.0, None, None)) == 2
    assert steps((0.0, 0.0, None, None), (250.0, 0.0, None, None)) == 6
    assert steps((0.0, 0.0, None, None), (900.0, 0.0, None, None)) == 20
    assert steps((0.0, 0.0, 0.0, 100.0), (100.0, 0.0, None, None)) == 8 + 8  # one way by its own, one by the mirrored point
    assert steps((0.0, 0.0, 1.0, 1.0), (2.0, 0.0, None, None)) == 3 + 5
    assert steps((0.0, 0.0, 0.0, 600.0), (600.0, 0.0, None, None)) == 15 + 15


def test_lights_of_a_runway(spark):
    r = spark.createDataFrame([(1, 1000.0, 0.0, 0.0), (2, 1000.0, 150.0, 130.0), (3, 4.0, 0.0, 0.0)], "line_no long, length double, before double, beyond double")
    got = {}
    for x in records.edge_lights(r).where("side = 1").collect():
        got.setdefault((x["line_no"], x["colour"]), []).append(round(x["along"], 3))
    step = 1000 / 17
    assert sorted(got[1, "white"]) == [round(k * step, 3) for k in range(1, 9)] and sorted(got[1, "yellow"]) == [round(k * step, 3) for k in range(9, 17)]
    # 720 m between the thresholds: 13 steps; two red ones before, two yellow ones beyond
    step = 720 / 13
    assert sorted(got[2, "red"]) == [round(150 - 2 * step, 3), round(150 - step, 3)]
    assert sorted(got[2, "white"]) == [round(150 + k * step, 3) for k in range(1, 4)] and len(got[2, "yellow"]) == 9 + 2
    assert not [k for k in got if k[0] == 3]
    c = {}
    for x in records.centre_lights(r.where("line_no = 1")).orderBy("k").collect():
        c.setdefault(x["colour"], []).append(x["k"])
    # 67 steps: the first at 900 m left or less is number 7, the first at 300 m or less 47
    assert c["white"][:8] == list(range(8)) and c["red"][0] == 8 and c["white"][8] == 9 and c["red"][-20:] == list(range(47, 67))
    # 850 m behind a displaced threshold: 57 steps from there on
    along = [x["along"] for x in records.centre_lights(r.where("line_no = 2")).orderBy("k").collect()]
    assert len(along) == 57 and along[0] == 150.0 and round(along[-1], 3) == round(150 + 56 * 850 / 57, 3)
    box = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 250.0, 0.0), (1, 2, 250.0, 90.0), (1, 3, 0.0, 90.0)], "id int, corner int, cx double, cy double")
    assert {(b["edge"], b["k"], b["x"]) for b in records.buoys(box).collect()} == {(0, 1, 125.0), (0, 2, 250.0), (2, 1, 125.0), (2, 2, 0.0)}


def test_centres_count_pads(spark):
    runway = spark.createDataFrame([(1, 0, 0, 100, 200)], "grp long, lat1 long, lon1 long, lat2 long, lon2 long")
    pads = spark.createDataFrame([(1, 400, 350), (2, 8, 9)], "grp long, lon long, lat long")
    assert {r["grp"]: (r["lon_as"], r["lat_as"]) for r in records.group_centres(runway, pads).collect()} == {1: (250, 200), 2: (8, 9)}
    long_name = spark.createDataFrame([(0, "1 10 0 0 KA " + " ".join(map(str, range(300))))], "line_no long, txt string")
    assert records.header_fields(records.assign_groups(records.parse_lines(long_name))).first()["name"].endswith(" 299")


def test_next_fit_by_blocks_equals_a_fold(spark):
    import random

    r = random.Random(1)
    rows = [(g, k * 3, r.choice([0, 0, 1, 5, 30, 60, 99, 100, 101, 250, None])) for g, n in (("a", 700), (None, 200), ("c", 1)) for k in range(n)]
    rows += [("q", k, v) for k, v in enumerate((0, 150, 0, 0, 300, 5, 100, 0, 0, 101))]
    df = spark.createDataFrame(rows, "g string, k long, s long")
    for reserve, block_rows, fan in ((0, 200, 64), (10, 13, 2), (130, 300, 3)):
        want = {}
        for g in {x[0] for x in rows}:
            used, disk = reserve, 0
            for _, k, s in sorted((x for x in rows if x[0] == g), key=lambda x: x[1]):
                if used > 0 and used + (s or 0) > 100:
                    used, disk = 0, disk + 1
                used += s or 0
                want[g, k] = (disk, used)
        assert {(x["g"], x["k"]): (x["disk"], x["used"]) for x in reports.next_fit(df, "g", "k", "s", 100, reserve, block_rows, fan).collect()} == want


def test_next_fit_steps_are_few_and_compose():
    import random

    r = random.Random(7)

    def fold(sizes, used, capacity):
        begun = 0
        for x in sizes:
            if used > 0 and used + x > capacity:
                used, begun = 0, begun + 1
            used += x
        return used, begun

    for _ in range(300):
        capacity = r.choice([10, 100])
        parts = [[r.choice([0, 1, 3, 7, 10, 11, 40, 100, 250]) for _ in range(r.randrange(1, 25))] for _ in range(r.randrange(1, 6))]
        whole = reports.step_of(np.array(parts[0]), capacity)
        for p in parts[1:]:
            whole = whole.then(reports.step_of(np.array(p), capacity))
        for used in (*range(capacity + 1), capacity + 1, 3 * capacity):
            assert whole.after(used) == fold(sum(parts, []), used, capacity)
    # only the items that one disk holds make steps, and composing adds none beyond
    for sizes, most in ((np.full(100_000, 2_000), 101), (np.array([r.randrange(1, 90_000) for _ in range(100_000)]), 60), (np.full(100_000, 1), 100_001)):
        one = reports.step_of(sizes, 200_000)
        assert len(one.over) <= most and len(one.then(one).then(one).over) <= 2 * most


def test_next_fit_with_ties_over_several_blocks(spark):
    df = spark.createDataFrame([("g", 5, s) for s in (40, 70, 10, 20, 30) * 20], "g string, k long, s long")
    got = sorted((x["disk"], x["used"], x["s"]) for x in reports.next_fit(df, "g", "k", "s", 100, 0, 7, 2).collect())
    used, disk, want = 0, 0, []
    for s in sorted((40, 70, 10, 20, 30) * 20):
        if used > 0 and used + s > 100:
            used, disk = 0, disk + 1
        used += s
        want.append((disk, used, s))
    assert got == sorted(want) and reports.next_fit(df.where("false"), "g", "k", "s", 100).count() == 0


def test_record_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    for name, lines in (("b.txt", ["x", "", "y" * 50] * 40), ("a.txt", [f"line {k}" for k in range(500)]), ("c.txt", [])):
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        got = X.read_record_lines(spark, str(tmp_path)).collect()
        through = X.read_record_lines(spark, str(tmp_path), through=True).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    for name, n in (("a.txt", 500), ("b.txt", 120)):
        own = sorted((r["line_no"], r["txt"]) for r in got if r["file"].endswith(name))
        assert own == list(enumerate((tmp_path / name).read_text().splitlines())) and len(own) == n
    assert [r["line_no"] for r in through] == list(range(620)) and through[499]["txt"] == "line 499" and through[500]["txt"] == "x"


def test_points_are_chosen_down_to_single_cells(spark):
    # one cell sticks out of a plane on a grid of 2^6 + 1 cells
    flat = spark.createDataFrame([(0, c, r, 500 if (c, r) == (37, 22) else 0) for c in range(65) for r in range(65)], CELLS)
    p = raster.select_points(flat, 40, 4, 1000)
    assert p.where("col=37 AND row=22").count() == 1 and p.where("(col=0 OR col=64) AND (row=0 OR row=64)").count() == 4
    assert raster.select_points(flat.limit(0), 40).count() == 0


@pytest.mark.parametrize("name", ["g16_inherit_elevation", "o09_area_report", "g15_insert_on_edges", "g22_chop_to_tiles", "o01_priority_overlay", "o02_masks", "o08_face_class", "g24_points_in_polygons", "c10_sample_elevation", "c13_average_elevation", "c23_roughness"])
def test_exploded_sides_are_not_broadcast(spark, name):
    from tileweave import registry

    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the fixed table of classes may be
    assert all("name" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)


def test_nodes_on_edges_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    ends = [tuple(int(v) for v in rng.integers(-30, 31, 4) * rng.choice([1, 10, 60])) for _ in range(60)] + [(0, 0, 900, 0), (5, 700, 5, -700), (-300, -300, 300, 300), (600, -300, -600, 300), (7, 7, 7, 7)]
    nodes = sorted({(int(x), int(y)) for x, y in rng.integers(-40, 41, (900, 2)) * 10} | {(300, 300), (5, 0), (0, 0)})
    e = spark.createDataFrame([(k, *v) for k, v in enumerate(ends)], "k int, ax long, ay long, bx long, by long")
    got = rings.nodes_on_edges(e, spark.createDataFrame(nodes, "x long, y long"), 100).select("k", "x", "y").collect()
    on = lambda a, b, c, d, x, y: (x - a) * (d - b) == (y - b) * (c - a) and min(a, c) <= x <= max(a, c) and min(b, d) <= y <= max(b, d) and (x, y) not in ((a, b), (c, d))
    want = sorted((k, x, y) for k, v in enumerate(ends) for x, y in nodes if on(*v, x, y))
    assert len(want) > 100 and sorted(map(tuple, got)) == want


def test_nodes_on_edges_takes_edges_without_length(spark):
    ends = [(7, 7, 7, 7), (0, 0, 900, 0), (600, -300, -600, 300), (0, 0, 6, 9), (40, 40, 40, 40)]
    nodes = [(7, 7), (5, 0), (0, 0), (900, 0), (-2, 1), (200, -100), (2, 3), (4, 6), (40, 40)]
    e = spark.createDataFrame([(k, *v) for k, v in enumerate(ends)], "k int, ax long, ay long, bx long, by long")
    got = rings.nodes_on_edges(e, spark.createDataFrame(nodes, "x long, y long"), 100).select("k", "x", "y").collect()
    assert sorted(map(tuple, got)) == [(1, 5, 0), (2, -2, 1), (2, 0, 0), (2, 200, -100), (3, 2, 3), (3, 4, 6)]


def test_crossings_meet_in_cells_and_are_one_for_a_place(spark):
    rng = np.random.default_rng(11)
    boxes = [tuple(int(v) for v in (*rng.integers(-60, 60, 2), *rng.integers(1, 90, 3))) for _ in range(8)]
    verts = [(k, 0, n, x, y) for k, (x0, y0, w, h, d) in enumerate(boxes) for n, (x, y) in enumerate([(x0, y0), (x0 + w, y0 + d), (x0 + w - d, y0 + h), (x0 - d, y0 + h)])]
    segs = [tuple(int(v) for v in rng.integers(-150, 150, 4)) for _ in range(700)] + [(-100, 3, 100, 3)] * 3 + [(5, 5, 5, 5), (0, -100, 0, 100)]
    out = rings.insert_crossings(spark.createDataFrame(verts, "poly_id long, ring int, seq int, x long, y long"), spark.createDataFrame(segs, "ax long, ay long, bx long, by long"), 40)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan

    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    four = lambda v: math.copysign(math.floor(abs(v) * 10000 + 0.5), v) / 10000
    want = []
    for k in range(len(boxes)):
        corners = [v[3:] for v in verts if v[0] == k]
        ring = []
        for n, p in enumerate(corners):
            q, found = corners[(n + 1) % 4], {}
            for s in set(segs):
                c, d = s[:2], s[2:]
                if side(p, q, c) * side(p, q, d) < 0 and side(c, d, p) * side(c, d, q) < 0:
                    t = side(c, d, p) / (side(c, d, p) - side(c, d, q))
                    x, y = (four(p[m] + t * (q[m] - p[m])) for m in (0, 1))
                    at = (math.floor(x + 0.5), math.floor(y + 0.5))
                    found[at] = min(found.get(at, 1e18), (x - p[0]) ** 2 + (y - p[1]) ** 2)
            ring += [p, *sorted(found, key=found.get)]
        want += [(k, 0, n, *at) for n, at in enumerate(ring)]
    assert sorted(map(tuple, out.collect())) == sorted(want) and len(want) > 500
    assert rings.insert_crossings(spark.createDataFrame(verts, "poly_id long, ring int, seq int, x long, y long"), spark.createDataFrame([], "ax long, ay long, bx long, by long"), 40).count() == len(verts)


def test_points_of_one_place_are_looked_up_once(spark):
    v = spark.createDataFrame([(k, 0, n, x, y) for k, w in ((1, 10), (2, 30)) for n, (x, y) in enumerate([(0, 0), (w, 0), (w, w), (0, w)])], RING)
    # ids may be missing or repeated: each row is a point
    points = spark.createDataFrame([(k, 5, 5) for k in range(50)] + [(None, 5, 5), (None, 5, 5), (7, 5, 5), (60, 20, 20), (61, 40, 5), (62, None, 5)], "pt_id long, x long, y long")
    out = rings.points_in_polygons(points, v, 8)
    want = [(k, p) for k in [*range(50), -1, -1, 7] for p in (1, 2)] + [(60, 2)]
    assert sorted((-1 if r[0] is None else r[0], r[1]) for r in out.collect()) == sorted(want)
    # pairs with polygons are counted by place
    assert "Aggregate [px" in out._jdf.queryExecution().optimizedPlan().toString()


def test_split_segments_equal_brute_force_and_pairs_are_no_rows(spark):
    rng = np.random.default_rng(5)
    segs = [(int(a), int(b), int(a + c), int(b + d)) for a, b, c, d in np.c_[rng.integers(-80, 80, (120, 2)), rng.integers(-60, 61, (120, 2))]]
    segs += [(-50, 0, 50, 0), (-50, 0, 50, 0), (0, -50, 0, 50), (-50, -50, 50, 50), (9, 9, 9, 9)]
    out = network.split_at_crossings(spark.createDataFrame([(k, *v) for k, v in enumerate(segs)], "seg_id long, ax long, ay long, bx long, by long"), 200)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join" not in plan

    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    four = lambda v: math.copysign(math.floor(abs(v) * 10000 + 0.5), v) / 10000
    want = []
    for k, s in enumerate(segs):
        p, q, cuts = s[:2], s[2:], set()
        for c, d in ((o[:2], o[2:]) for o in segs):
            if side(p, q, c) * side(p, q, d) < 0 and side(c, d, p) * side(c, d, q) < 0:
                t = side(c, d, p) / (side(c, d, p) - side(c, d, q))
                x, y = (four(p[m] + t * (q[m] - p[m])) for m in (0, 1))
                cuts.add((four(abs(x - p[0]) + abs(y - p[1])), x, y))
        way = [p, *(c[1:] for c in sorted(cuts)), q]
        want += [(k, n, *map(float, (*a, *b))) for n, (a, b) in enumerate(zip(way, way[1:], strict=False))]
    assert sorted(map(tuple, out.collect())) == sorted(want) and len(want) > 500
    assert network.split_at_crossings(spark.createDataFrame([], "seg_id long, ax long, ay long, bx long, by long"), 200).count() == 0


def test_best_at_points_equals_points_in_polygons(spark):
    rng = np.random.default_rng(5)
    rows = []
    for p in range(60):
        x, y, w, h = (int(v) for v in rng.integers((0, 0, 20, 20), (900, 900, 700, 700)))
        rows += [(p, 0, s, x + a * w, y + b * h) for s, (a, b) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))]
        if p % 3 == 0:
            rows += [(p, 1, s, x + w // 3 + a * (w // 3), y + h // 3 + b * (h // 3)) for s, (a, b) in enumerate(((0, 0), (0, 1), (1, 1), (1, 0)))]
    v = spark.createDataFrame(rows, RING)
    polys = spark.createDataFrame([(p, p * 7 % 5) for p in range(60)], "poly_id long, priority int")
    points = spark.createDataFrame([(k, int(x), int(y)) for k, (x, y) in enumerate(rng.integers(-50, 1700, (2000, 2)))], "pt_id long, x long, y long")
    want = overlay.face_class(points.select("pt_id"), rings.points_in_polygons(points, v, 20), polys).where("poly_id is not null")
    got = overlay.best_at_points(points, v, polys, 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("pt_id", "poly_id").collect())) and want.count() > 500


def test_points_move_to_the_smallest_of_equal_edges(spark):
    rng = np.random.default_rng(9)
    ends = [tuple(int(v) for v in rng.integers(0, 3000, 4)) for _ in range(40)]
    edges = [(100 * c + k, *v) for c in (2, 1, 3) for k, v in enumerate(ends)]
    pts = [(k, int(x), int(y)) for k, (x, y) in enumerate(rng.integers(0, 3000, (200, 2)))] + [(999, ends[0][0], ends[0][1]), (1000, ends[0][0], ends[0][1])]
    got = mesh.move_to_edges(spark.createDataFrame(pts, "pt_id long, x long, y long"), spark.createDataFrame(edges, "edge_id long, ax long, ay long, bx long, by long"), 1000, 60)
    want = {}
    for p, x, y in pts:
        best = (61.0, None)
        for i, ax, ay, bx, by in edges:
            t = min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / max((bx - ax) ** 2 + (by - ay) ** 2, 1), 0.0), 1.0)
            d = round(math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y), 6)
            best = min(best, (d, i), key=lambda b: (b[0], b[1] or 0)) if d <= 60 else best
        want[p] = best[1]
    assert {r["pt_id"]: r["edge_id"] for r in got.collect()} == want and any(want.values())
    # equal edges and places are looked up once
    assert "min(edge_id" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("far", [40, 2000])
def test_hot_pixels_equal_brute_force(spark, far):
    from fractions import Fraction as Q

    rng = np.random.default_rng(far)
    at = rng.integers(0, 400, (50, 2))
    segs = [(k, int(x), int(y), int(x + dx), int(y + dy)) for k, ((x, y), (dx, dy)) in enumerate(zip(at, rng.integers(-far, far + 1, (50, 2)), strict=True))]
    px = lambda v: math.floor((2 * v + 16) / 32)
    want = {(px(s[i]), px(s[i + 1])) for s in segs for i in (1, 3)}
    for _, ax, ay, bx, by in segs:
        for _, cx, cy, dx, dy in segs:
            o = lambda p, q, r, s, t, u: (r - p) * (u - q) - (s - q) * (t - p)
            oa, ob, oc, od = o(cx, cy, dx, dy, ax, ay), o(cx, cy, dx, dy, bx, by), o(ax, ay, bx, by, cx, cy), o(ax, ay, bx, by, dx, dy)
            if oa * ob < 0 and oc * od < 0:
                want.add((px(ax + Q(oa, oa - ob) * (bx - ax)), px(ay + Q(oa, oa - ob) * (by - ay))))
    df = spark.createDataFrame(segs, "seg_id long, ax long, ay long, bx long, by long")
    assert {(r["kx"], r["ky"]) for r in mesh.hot_pixels(df, 16, 200).collect()} == want


def test_points_move_to_edges_of_several_blocks_and_squares(spark, monkeypatch):
    monkeypatch.setattr(mesh, "EDGES", 50)
    rng = np.random.default_rng(21)
    edges = [(k, *(int(v) for v in e)) for k, e in enumerate(rng.integers(-900, 900, (160, 4)))] + [(500, 30, 30, 30, 30), (501, -700, 0, 700, 0), (502, 0, -700, 0, 700)]
    pts = [(k, int(x), int(y)) for k, (x, y) in enumerate(rng.integers(-1100, 1100, (300, 2)))] + [(900, 30, 31), (901, None, 4), (902, 5000, 5000)]
    got = mesh.move_to_edges(spark.createDataFrame(pts, "pt_id long, x long, y long"), spark.createDataFrame(edges, "edge_id long, ax long, ay long, bx long, by long"), 100, 9.5)
    # an edge is a row for each square of two cells, not for each cell that the reach makes
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()
    want = {}
    for p, x, y in pts[:-2]:
        near = []
        for i, ax, ay, bx, by in edges:
            t = min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / max((bx - ax) ** 2 + (by - ay) ** 2, 1), 0.0), 1.0)
            u, v = ax + t * (bx - ax), ay + t * (by - ay)
            near.append((math.floor(math.sqrt((u - x) ** 2 + (v - y) ** 2) * 1e6 + 0.5) / 1e6, i, u, v))
        d, i, u, v = min(near)
        want[p] = (i, u, v) if d <= 9.5 else (None, x, y)
    rows = {r["pt_id"]: r for r in got.collect()}
    assert len(rows) == len(pts) and (rows[902]["edge_id"], rows[902]["x"], rows[901]["edge_id"], rows[901]["x"]) == (None, 5000.0, None, None)
    for p, (i, u, v) in want.items():
        assert rows[p]["edge_id"] == i and abs(rows[p]["x"] - u) < 1e-4 and abs(rows[p]["y"] - v) < 1e-4
    assert sum(i is not None for i, _, _ in want.values()) > 50
