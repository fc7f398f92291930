"""Chains, rings, floods and bridges against brute force, on random and hand-made input."""

import math
import random
from collections import Counter, defaultdict, deque
from fractions import Fraction

from pyspark.sql import functions as F

from tileweave.operators import graph, landcover, mesh, network, overlay, raster


def test_follow_long_chain_and_cycles(spark, monkeypatch):
    n, rounds = 5_000, []
    monkeypatch.setattr(graph, "drop", lambda df, real=graph.drop: (rounds.append(1), real(df)))
    links = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") < n - 1, F.col("id") + 1).alias("next"), F.lit(2).cast("long").alias("w"), F.col("id").alias("x"))
    got = graph.follow(links, w="sum", x="xor")
    assert got.agg(F.min("last"), F.max("last"), F.sum("steps"), F.sum("w")).first() == (n - 1, n - 1, n * (n + 1) // 2, n * (n + 1))
    assert len(rounds) <= 14
    x = 0
    for k in range(n - 3, n):
        x ^= k
    assert got.where(f"node = {n - 3}").first()["x"] == x
    loops = spark.createDataFrame([(5, 9), (9, 2), (2, 5), (7, 7), (1, 9), (30, 31), (31, None)], "node long, next long")
    found = {r["node"]: (r["last"], r["low"]) for r in graph.follow(loops).collect()}
    assert found[5] == found[9] == found[2] == (None, 2) and found[7] == (None, 7) and found[1][0] is None and found[30] == (31, 30)
    ranks = {r["node"]: (r["cycle"], r["pos"]) for r in graph.rank_cycles(loops.where("node in (5, 9, 2, 7)")).collect()}
    assert ranks == {2: (2, 0), 5: (2, 1), 9: (2, 2), 7: (7, 0)}
    assert graph.follow(loops.where("false")).count() == 0


def test_chain_distances_by_hand(spark):
    rows = [(1, 0, 0, 3, 4, "a"), (2, 3, 14, 3, 4, "a"), (3, 3, 14, 10, 14, "b"), (4, 50, 0, 60, 0, None), (5, 60, 0, 60, 10, None), (6, 60, 10, 50, 0, None), (7, 9, 9, 9, 9, "a"), (8, 60, 100, 70, 100, "a"), (9, 70, 100, 60, 100, "a")]
    got = {r["seg_id"]: tuple(r)[1:] for r in network.chain_distances(spark.createDataFrame(rows, "seg_id long, ax long, ay long, bx long, by long, kind string")).collect()}
    assert got[1] == (15.0, 5.0, 15.0, 2) and got[2] == (15.0, 10.0, 15.0, 2) and got[3] == (7.0, 7.0, 7.0, 1)
    assert all(got[k] == (None,) * 4 for k in (4, 5, 6, 8, 9)) and 7 not in got
    assert network.chain_distances(spark.createDataFrame([], "seg_id long, ax long, ay long, bx long, by long, kind string")).count() == 0


def squares(cells):
    """Rings of unit cells (poly_id, ring, seq, x, y, zone)."""
    return [(k, 0, s, i + dx, j + dy, 1) for k, (i, j) in enumerate(cells) for s, (dx, dy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])]


VERTS = "poly_id long, ring int, seq int, x long, y long, zone int"


def test_dissolve_with_hole_island_and_corner(spark):
    one = {(i, j) for i in range(7) for j in range(7)} - {(i, j) for i in range(1, 6) for j in range(1, 6)} | {(3, 3), (7, 7), (20, 20)}
    # an island with holes of its own that touch in a corner
    two = {(i, j) for i in range(11) for j in range(11)} - {(i, j) for i in range(1, 8) for j in range(1, 8)} | {(i, j) for i in range(2, 6) for j in range(2, 6)} - {(3, 3), (4, 4)}
    two -= {(9, 9)}
    verts = spark.createDataFrame([(1000 * z + k, ring, s, x, y, z) for z, c in ((1, one), (2, two)) for k, ring, s, x, y, _ in squares(sorted(c))], VERTS)
    got = {1: defaultdict(list), 2: defaultdict(list)}
    for x in sorted(overlay.dissolve_rings(verts, "zone", 10).collect(), key=lambda x: x["seq"]):
        got[x["zone"]][x["ring_id"], x["outer_id"], x["is_hole"], x["area2"]].append((x["x"], x["y"]))
    by_area = {k[3]: k for k in got[1]}
    assert sorted(k[3] for k in got[1]) == [-50, 2, 2, 2, 98]  # (7, 7) touches in a corner only
    assert by_area[-50][1] == by_area[98][0] and all(len(v) == 4 for v in got[1].values())
    assert sorted(got[1][by_area[98]]) == [(0, 0), (0, 7), (7, 0), (7, 7)]
    by_area = {k[3]: k for k in got[2]}
    assert sorted(by_area) == [-98, -4, -2, 28 + 4, 242]
    assert by_area[-4][1] == by_area[32][0] and by_area[-98][1] == by_area[-2][1] == by_area[242][0]
    assert overlay.dissolve_rings(verts.where("false"), "zone", 10).count() == 0


def parts_by_flood(cells):
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            c = todo.pop()
            part.add(c)
            for d in ((1, 0), (-1, 0), (0, 1), (0, -1)):
                n = (c[0] + d[0], c[1] + d[1])
                if n in left:
                    left.remove(n)
                    todo.append(n)
        out.append(part)
    return out


def test_cut_out_parts_and_their_rings(spark):
    r = random.Random(4)
    feature = [(p, i, j) for p in (1, 2) for i in range(-6, 12) for j in range(14) if r.random() < 0.75]
    cutter = [(i, j) for i in range(-6, 12) for j in range(14) if r.random() < 0.2]
    f, c = spark.createDataFrame(feature, "poly_id long, i long, j long"), spark.createDataFrame(cutter, "i long, j long")
    runs = overlay.cut_out_parts(f, c)
    got = defaultdict(set)
    for x in runs.collect():
        got[x["poly_id"], x["part_j"], x["part_i"]] |= {(i, x["j"]) for i in range(x["i0"], x["i1"])}
    want = {}
    for p in (1, 2):
        for part in parts_by_flood({(i, j) for q, i, j in feature if q == p} - set(cutter)):
            j, i = min((j, i) for i, j in part)
            want[p, j, i] = part
    assert got == want
    rings = overlay.run_rings(runs, ["poly_id", "part_i", "part_j"])
    area = rings.select("poly_id", "part_i", "part_j", "ring_id", "area2").distinct().groupBy("poly_id", "part_j", "part_i").agg(F.sum("area2").alias("a"), F.count("*").alias("n")).collect()
    assert {(x["poly_id"], x["part_j"], x["part_i"]): x["a"] for x in area} == {k: 2 * len(v) for k, v in want.items()}
    for x in area:  # one outer ring, and one ring for each hole: faces less inner edges plus inner corners
        p = want[x["poly_id"], x["part_j"], x["part_i"]]
        edges = sum((i + 1, j) in p for i, j in p) + sum((i, j + 1) in p for i, j in p)
        corners = sum({(i + 1, j), (i, j + 1), (i + 1, j + 1)} <= p for i, j in p)
        assert x["n"] == 2 - (len(p) - edges + corners)


def flooded(faces, neighbours):
    """{face: (domain, depth)} by a queue over domains, from outside."""
    domain = {}
    for start in [-1, *sorted(faces)]:
        if start in domain:
            continue
        todo = [start]
        domain[start] = start
        while todo:
            f = todo.pop()
            for n, cons in neighbours[f]:
                if not cons and n not in domain:
                    domain[n] = start
                    todo.append(n)
    depth, todo = {-1: 0}, deque([-1])
    while todo:
        d = todo.popleft()
        for f in [f for f in domain if domain[f] == d]:
            for n, _ in neighbours[f]:
                if domain[n] not in depth:
                    depth[domain[n]] = depth[d] + 1
                    todo.append(domain[n])
    return {f: (domain[f], depth[domain[f]]) for f in faces}


def test_flood_by_brute_force(spark):
    r = random.Random(6)
    side = 9
    node = lambda i, j: i * 100 + j
    faces = []
    for i in range(side):
        for j in range(side):
            faces += [(2 * (i * side + j), node(i, j), node(i + 1, j), node(i + 1, j + 1)), (2 * (i * side + j) + 1, node(i, j), node(i + 1, j + 1), node(i, j + 1))]
    sides = defaultdict(list)
    for f, *n in faces:
        for k in range(3):
            sides[tuple(sorted((n[k], n[k - 1])))].append(f)
    cons = {e for e in sorted(sides) if r.random() < (0.85 if min(e) < 450 else 0.5)}
    neighbours = defaultdict(list)
    for e, fs in sides.items():
        a, b = fs if len(fs) == 2 else (fs[0], -1)
        neighbours[a].append((b, e in cons))
        neighbours[b].append((a, e in cons))
    df = spark.createDataFrame(faces, "face_id long, n1 long, n2 long, n3 long")
    stage = mesh.face_neighbours(df, spark.createDataFrame(sorted(cons), "a long, b long"))
    one = stage.where("face_id = 0").first()
    assert one["vidx"] == [0, 100, 101] and one["nidx"][1] == 1 and len(one["cons"]) == 3
    got = mesh.flood_class(mesh.flood_domains(stage), df.selectExpr("face_id", "face_id*10 AS cls")).collect()
    want = flooded([f[0] for f in faces], neighbours)
    assert {x["face_id"]: (x["domain"], x["depth"]) for x in got} == want
    assert all(x["cls"] == (10 * x["domain"] if x["depth"] else None) for x in got)


def test_flood_joins_blocks(spark, monkeypatch):
    # a strip of squares of two faces, over many blocks; a constraint between each tenth square and the next
    n, met = 200, []
    monkeypatch.setattr(mesh, "BLOCK", 16)
    monkeypatch.setattr(mesh, "connected_components", lambda e, real=mesh.connected_components: (met.append(e.count()), real(e))[1])
    side = lambda f, g: (g if 0 <= g < n else None, min(f, g) % 20 == 19 or not 0 <= g < n)
    rows = [(f, *zip(side(f, f - 1), side(f, f + 1), (None, f != 150))) for f in range(n)]
    stage = spark.createDataFrame(rows, "face_id long, nidx array<long>, cons array<boolean>")
    got = {x["face_id"]: (x["domain"], x["depth"]) for x in mesh.flood_domains(stage).collect()}
    assert got == {f: (-1, 0) if f // 20 == 7 else (f // 20 * 20, 1) for f in range(n)}
    # of 200 faces' sides only those between the 13 blocks and the open one are left to be joined
    assert 0 < met[0] <= 30


def bridges_by_search(edges):
    """Edges whose removal parts their ends, by trying each."""
    out = set()
    for skip, a, b in edges:
        near = defaultdict(list)
        for e, p, q in edges:
            if e != skip:
                near[p].append(q)
                near[q].append(p)
        seen, todo = {a}, [a]
        while todo:
            for n in near[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        if b not in seen:
            out.add(skip)
    return out


def test_bridges_by_brute_force(spark):
    rows = []
    for k, (nodes, edges) in enumerate([(60, 66), (40, 30), (25, 60)]):
        r = random.Random(k)
        rows += [(k * 100 + m, 10_000 * k + r.randrange(nodes), 10_000 * k + r.randrange(nodes)) for m in range(edges)]
    rows += [(1000, 500, 501), (1001, 501, 502), (1002, 502, 500), (1003, 502, 503), (1004, 503, 504), (1005, 504, 505), (1006, 505, 503), (1007, 505, 506), (1008, 600, 601), (1009, 601, 600), (1010, 7, 7)]
    rows += [(2000 + k, 900, 901 + k) for k in range(40)]  # a star
    df = spark.createDataFrame(rows, "e long, a long, b long")
    assert {x["e"] for x in graph.bridges(df).collect()} == bridges_by_search(rows)
    assert graph.spanning_forest(df).count() == len({n for _, a, b in rows for n in (a, b)}) - len(parts(rows))


def parts(rows):
    find = {}
    def top(n):
        find.setdefault(n, n)
        while find[n] != n:
            n = find[n]
        return n
    for _, a, b in rows:
        find[top(a)] = top(b)
    return {top(n) for n in list(find)}


def test_antennas_between_cycles_go(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (6, 7), (8, 9), (2, 1), (5, 5)], "a long, b long")
    assert sorted(tuple(x) for x in mesh.remove_antennas(e).collect()) == [(1, 2), (1, 3), (2, 3), (4, 5), (4, 6), (5, 6)]
    assert mesh.remove_antennas(e.where("false")).count() == 0


def test_tags_around_cycles_by_contraction(spark):
    cycles = [[k * 100 + j * 7 % 13 for j in range(n)] for k, n in enumerate((1, 2, 5, 13, 12))]
    tags = {v: hash((v, 5)) for c in cycles for v in c[1:]}
    for c in cycles:
        tags[c[0]] = 0
        for v in c[1:]:
            tags[c[0]] ^= tags[v]
    ahead = {v: c[(k + 1) % len(c)] for c in cycles for k, v in enumerate(c)}
    links = spark.createDataFrame([(v, ahead[v], tags[v]) for v in ahead], "node long, next long, tag long")
    for few in (0, 6, 1000):
        x = {r["node"]: r["x"] for r in graph.potentials(links, few).collect()}
        assert x.keys() == ahead.keys() and all(x[v] == tags[v] ^ x[ahead[v]] for v in x)
        assert all(any(x[v] == 0 for v in c) for c in cycles)


def crossing(a, b, c, d):
    """The place where a-b and c-d cross properly, as fractions, or None."""
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if side(a, b, c) * side(a, b, d) >= 0 or side(c, d, a) * side(c, d, b) >= 0:
        return None
    t = Fraction(side(c, d, a), side(c, d, a) - side(c, d, b))
    return tuple(a[k] + t * (b[k] - a[k]) for k in (0, 1))


def passed(a, b, hot, p):
    """Hot pixels that a-b passes, in order: the stretch of a-b in each of them, cut by its four sides in fractions."""
    found = []
    for k in hot:
        lo, hi = (Fraction(0), True), (Fraction(1), True)  # place along a-b, and whether it belongs to the stretch
        for c in (0, 1):
            low, high, d = Fraction(2 * p * k[c] - p, 2), Fraction(2 * p * k[c] + p, 2), b[c] - a[c]
            if d == 0:
                if not low <= a[c] < high:
                    break
                continue
            s, e = ((low - a[c]) / d, True), ((high - a[c]) / d, False)
            s, e = (s, e) if d > 0 else (e, s)
            lo = max(lo, s, key=lambda v: (v[0], not v[1]))
            hi = min(hi, e)
        else:
            if lo[0] < hi[0] or (lo[0] == hi[0] and lo[1] and hi[1]):
                found.append((lo[0], hi[0], k))
    return [k for _, _, k in sorted(found)]


def test_snapped_segments_meet_in_ends_only(spark):
    rng, p = random.Random(5), 8
    rows = []
    for k in range(90):
        ax, ay = rng.randrange(-150, 150), rng.randrange(-150, 150)
        rows.append((k, ax, ay, ax + rng.randrange(-120, 121), ay + rng.randrange(-120, 121)))
    rows += [(200, -100, 4, 100, 4), (201, 4, -100, 4, 100), (202, 0, 0, 2, 2), (203, 0, 0, 64, 64), (204, 64, 64, 0, 0), (205, 0, 0, 64, 64), (206, 7, 7, 7, 7), (207, None, 0, 1, 1)]
    df = spark.createDataFrame(rows, "seg_id long, ax long, ay long, bx long, by long")
    got = mesh.snap_round_segments(df.withColumn("part", F.lit("x")), p, 40).collect()
    segs = {k: ((ax, ay), (bx, by)) for k, ax, ay, bx, by in rows if ax is not None}
    pixel = lambda q: tuple((2 * v + p) // (2 * p) for v in q)
    hot = {pixel(q) for s in segs.values() for q in s}
    hot |= {pixel(q) for i in segs for j in segs if i < j and (q := crossing(*segs[i], *segs[j]))}
    want = {}
    for k, (a, b) in segs.items():
        way, size = passed(a, b, hot, p), 0
        while size != len(way):
            size = len(way)
            way = way[:1] + [q for s, e in zip(way, way[1:]) for q in passed(s, e, hot, 1)[1:]]
        want[k] = [(s[0] * p, s[1] * p, e[0] * p, e[1] * p) for s, e in zip(way, way[1:])]
    found = defaultdict(list)
    for r in sorted(got):
        assert r["part"] == len(found[r["seg_id"]])
        found[r["seg_id"]].append((r["ax"], r["ay"], r["bx"], r["by"]))
    assert found == {k: v for k, v in want.items() if v} and 202 not in found and 206 not in found
    edges = {tuple(sorted([e[:2], e[2:]])) for v in found.values() for e in v}
    assert not any(crossing(*e, *f) for e in edges for f in edges)
    nodes = {q for e in edges for q in e}
    on = lambda q, a, b: (b[0] - a[0]) * (q[1] - a[1]) == (b[1] - a[1]) * (q[0] - a[0]) and a < q < b
    assert not any(on(q, *e) for q in nodes for e in edges)
    assert mesh.snap_round_segments(df.where("false"), p, 40).count() == 0


def test_clipped_parts_are_those_of_the_cells(spark):
    rng = random.Random(11)
    cells = [(k, i, j) for k in range(12) for i in range(9) for j in range(9) if rng.random() < 0.62]
    parts = overlay.cell_parts(spark.createDataFrame(cells, "poly_id long, i long, j long"), "poly_id")
    whole = overlay.run_rings(parts.withColumn("part", F.struct("part_i", "part_j")), ["poly_id", "part"])
    # all parts of one number are one polygon of many rings, with holes
    verts = whole.select("poly_id", F.col("ring_id").alias("ring"), "seq", "x", "y")
    got = overlay.clip_parts(verts, ["poly_id"], (F.col("poly_id") % 3, F.lit(6), F.lit(2), F.lit(8)))
    inside = [(k, i, j) for k, i, j in cells if k % 3 <= i < 6 and 2 <= j < 8]
    want = overlay.cell_parts(spark.createDataFrame(inside, "poly_id long, i long, j long"), "poly_id")
    want = overlay.run_rings(want.withColumn("part", F.struct("part_i", "part_j")), ["poly_id", "part"])
    rings = lambda df: sorted(tuple(r) for r in df.groupBy("poly_id", "ring_id", "area2", "is_hole").agg(F.min(F.struct("y", "x")).alias("low")).select("poly_id", "low", "area2", "is_hole").collect())
    assert rings(got) == rings(want) and len(rings(got)) > 20
    assert overlay.clip_parts(verts, ["poly_id"], (F.lit(50), F.lit(60), F.lit(0), F.lit(9))).count() == 0


def test_a_slanted_comb_falls_apart(spark):
    ring = [(0, 0), (100, 0), (97, 10), (20, 12), (20, 30), (90, 33), (95, 41), (0, 40)]
    verts = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate(ring)], "poly_id long, ring int, seq int, x long, y long")
    got = overlay.clip_parts(verts, ["poly_id"], (F.lit(50), F.lit(200), F.lit(-5), F.lit(200))).collect()
    assert len({r["ring_id"] for r in got}) == 2 and {r["x"] for r in got if r["x"] < 60} == {50} and not any(r["is_hole"] for r in got)


def surface_error(faces, height):
    """Mean distance in height between triangles (x1, y1, z1, ...) and height, over the places of whole x and y that they cover."""
    found = {}
    for x1, y1, z1, x2, y2, z2, x3, y3, z3 in faces:
        det = (y2 - y3) * (x1 - x3) + (x3 - x2) * (y1 - y3)
        if abs(det) < 1e-9:
            continue
        for x in range(math.ceil(min(x1, x2, x3)), math.floor(max(x1, x2, x3)) + 1):
            for y in range(math.ceil(min(y1, y2, y3)), math.floor(max(y1, y2, y3)) + 1):
                a = ((y2 - y3) * (x - x3) + (x3 - x2) * (y - y3)) / det
                b = ((y3 - y1) * (x - x3) + (x1 - x3) * (y - y3)) / det
                if min(a, b, 1 - a - b) > -1e-9:
                    found[x, y] = abs(a * z1 + b * z2 + (1 - a - b) * z3 - height(x, y))
    return sum(found.values()) / len(found), len(found)


def test_simplified_by_error_is_nearer_than_the_grid(spark):
    side = 33
    height = lambda x, y: round(40 * math.sin(x / 4.3) * math.cos(y / 5.1) + 3 * abs(x - 17) + 500)
    cells = spark.createDataFrame([(t, x, y, height(x, y) if t == 1 else 2 * x + 3 * y) for t in (1, 2) for x in range(side) for y in range(side)], "tile_no long, col long, row long, elev long")
    full = mesh.triangulate_grid(cells)
    got = [tuple(r) for r in mesh.simplify_by_error(full, 1 / 4, side, unit=10.0).collect()]
    near = [r[1:] for r in got if r[0] == 1]
    assert 0 < len(near) <= 2 * (side - 1) ** 2 / 4
    # a plane stays one
    flat, n = surface_error([r[1:] for r in got if r[0] == 2], lambda x, y: 2 * x + 3 * y)
    assert flat < 0.05 and n > 0.97 * side * side
    ends = {(x, y) for r in near for x, y in (r[0:2], r[3:5], r[6:8])}
    edge = {(x, y) for x in range(side) for y in range(side) if {x, y} & {0, side - 1}}
    assert edge <= ends and all(z == height(x, y) for r in near for x, y, z in (r[0:3], r[3:6], r[6:9]) if (x, y) in edge)
    error, n = surface_error(near, height)
    assert n > 0.97 * side * side
    # the plain grid that keeps the ratio is further off; a finer one is not, but has more faces than its smaller error is worth
    for g, keeps in ((2, False), (3, True)):
        plain = [tuple(r)[1:] for r in mesh.simplify(full.where("tile_no = 1"), 1 / g**2, F.lit(False), side).collect()]
        wide = [(x1, y1, height(x1, y1), x2, y2, height(x2, y2), x3, y3, height(x3, y3)) for x1, y1, x2, y2, x3, y3 in plain]
        other = surface_error(wide, height)[0]
        assert (len(plain) <= 2 * (side - 1) ** 2 / 4) == keeps and error * len(near) < other * len(plain)
        assert not keeps or error < other
    assert mesh.simplify_by_error(full.where("false"), 1 / 4, side).count() == 0


def test_worst_point_first(spark):
    import numpy as np

    r = random.Random(15)
    rows = [(c % 2 + 10, x, y, None if r.random() < 0.05 or (x, y) == (0, 0) else int(400 * math.exp(-((x - 9) ** 2 + (y - 14 - c) ** 2) / 40)) + r.randrange(12)) for c in (0, 1) for x in range(24) for y in range(20)]
    cells = spark.createDataFrame(rows, "tile_no long, col long, row long, elev long")
    got = raster.insert_points(cells, 40, 12, 200)
    halved = raster.select_points(cells, 40, 12, 200).groupBy("tile_no").count()
    for tile, n_halved in halved.collect():
        own = [t for t in rows if t[0] == tile and t[3] is not None]
        col, row, elev = (np.array([t[k] for t in own]) for k in (1, 2, 3))
        points, triangles, left = raster._worst_first(col, row, elev.astype(float), 40, 12, 200)
        assert sorted(map(tuple, points)) == sorted((float(p["col"]), float(p["row"]), p["elev"]) for p in got.where(f"tile_no = {tile}").collect())
        assert 12 <= len(points) < n_halved and left <= 40

        def off(c, e, points, triangles):
            for a, b, d in triangles:
                (ax, ay, az), (bx, by, bz), (dx, dy, dz) = points[a], points[b], points[d]
                area = (bx - ax) * (dy - ay) - (by - ay) * (dx - ax)
                v, w = ((c[0] - ax) * (dy - ay) - (c[1] - ay) * (dx - ax)) / area, ((bx - ax) * (c[1] - ay) - (by - ay) * (c[0] - ax)) / area
                if v >= -1e-12 and w >= -1e-12 and v + w <= 1 + 1e-12:
                    return abs(e - (az + v * (bz - az) + w * (dz - az)))

        errors = [off((x, y), e, points, triangles) for x, y, e in zip(col, row, elev, strict=True)]
        assert None not in errors and abs(max(errors) - left) < 1e-6
        area = sum((points[b][0] - points[a][0]) * (points[d][1] - points[a][1]) - (points[b][1] - points[a][1]) * (points[d][0] - points[a][0]) for a, b, d in triangles)
        assert area == 2 * 23 * 19
        for n in (4, 7, 11):  # the point that follows is the worst of all cells before it
            before, shape, _ = raster._worst_first(col, row, elev.astype(float), 0, 4, n)
            after = raster._worst_first(col, row, elev.astype(float), 0, 4, n + 1)[0][-1]
            assert abs(off(after[:2], after[2], before, shape) - max(off((x, y), e, before, shape) for x, y, e in zip(col, row, elev, strict=True))) < 1e-6
    flat = cells.where("tile_no = 10").withColumn("elev", F.lit(7).cast("long"))
    assert raster.insert_points(flat, 40, 4).count() == 4 and raster.insert_points(flat, 40, 6).count() == 6
    assert raster.insert_points(flat.where("col = 3"), 40, 4).count() >= 4 and raster.insert_points(flat.limit(0)).count() == 0


def test_void_corners_bend_no_block():
    import numpy as np
    import pytest

    col, row = (v.ravel() for v in np.meshgrid(np.arange(17), np.arange(17), indexing="ij"))
    plain = np.full(col.shape, 500.0)
    keep = ~((col == 0) & (row == 0))
    chosen = raster._tile_points(col[keep], row[keep], plain[keep], 40, 3, 1000)
    assert sorted(zip(col[keep][chosen].tolist(), row[keep][chosen].tolist(), strict=True)) == [(0, 16), (16, 0), (16, 16)]
    keep = ~(np.isin(col, (0, 16)) & np.isin(row, (0, 16)))
    chosen = raster._tile_points(col[keep], row[keep], plain[keep], 40, 3, 1000)
    assert {(8, 8), (0, 8), (8, 0), (16, 8), (8, 16)} == set(zip(col[keep][chosen].tolist(), row[keep][chosen].tolist(), strict=True))
    with pytest.raises(ValueError):
        raster._tile_points(col - 1, row, plain, 40, 3, 1000)


def test_tiles_are_written_to_few_files(spark, tmp_path):
    from tileweave.operators.tiles import assign_tiles
    from tileweave.sources import io

    p = spark.range(500).selectExpr("id AS pt_id", "id * 700 - 175000 AS lon_as", "id * 450 % 36000 AS lat_as")
    f = assign_tiles(p).withColumn("material", F.when(F.col("pt_id") % 2 == 0, "a").otherwise("b"))
    io.write_tiles(f, str(tmp_path / "all"))
    # a file for each of 10 regions, where tiles and materials are 500
    assert f.select("tile", "material").distinct().count() == 500
    assert len(list((tmp_path / "all").glob("region=*"))) == 10 and len(list((tmp_path / "all").rglob("*.parquet"))) == 10
    got = spark.read.parquet(str(tmp_path / "all"))
    assert got.drop("region").exceptAll(f.select(*got.drop("region").columns)).count() == 0 and got.count() == 500
    assert got.where("region <> substring_index(tile_dir, '/', 1)").count() == 0
    one = f.first()["tile"]
    io.write_tiles(f, str(tmp_path / "one"), one)
    assert spark.read.parquet(str(tmp_path / "one")).count() == f.where(F.col("tile") == one).count()


def areas_by_search(cells):
    """Area of each (tile, x, y) of cells {place: class}: the smallest number of its touching cells; null touches nothing."""
    out, number = {}, lambda p: p[0] * (1 << 40) + p[2] * (1 << 20) + p[1]
    for p in sorted(cells, key=number):
        if p in out:
            continue
        out[p], todo = number(p), [p]
        while todo:
            t, x, y = todo.pop()
            for q in ((t, x + 1, y), (t, x - 1, y), (t, x, y + 1), (t, x, y - 1)):
                if q in cells and q not in out and cells[q] is not None and cells[q] == cells[t, x, y]:
                    out[q] = number(p)
                    todo.append(q)
    return out


def absorbed_by_search(cells, least):
    area = areas_by_search(cells)
    size, border = Counter(area.values()), defaultdict(Counter)
    for (t, x, y), k in area.items():
        for q in ((t, x + 1, y), (t, x - 1, y), (t, x, y + 1), (t, x, y - 1)):
            if size[k] < least and q in area and area[q] != k:
                border[k][area[q], cells[q]] += 1
    low = lambda c: (c is not None, c or 0)
    new = {k: min(b.items(), key=lambda e: (-e[1], low(e[0][1])))[0][1] for k, b in border.items()}
    return {p: c if new.get(area[p]) is None else new[area[p]] for p, c in cells.items()}


def test_areas_over_blocks_by_brute_force(spark, monkeypatch):
    r = random.Random(5)
    cells = {(t, x, y): r.choice((1, 1, 1, 2, 2, 3, None)) for t in (0, 3) for x in range(-5, 75) for y in range(0, 70) if r.random() < 0.97}
    df = spark.createDataFrame([(*p, c) for p, c in cells.items()], "tile_no long, x long, y long, cls long")
    linked = []
    monkeypatch.setattr(landcover, "connected_components", lambda e, real=landcover.connected_components: (linked.append(e.count()), real(e))[1])
    got = landcover.components(df).collect()
    assert {tuple(x)[:3]: x["area"] for x in got} == areas_by_search(cells) and len(got) == len(cells)
    # only what crosses a block's side is linked by joins: two sides across, one along, in each tile
    assert 0 < linked[0] <= 2 * (2 * 70 + 80)
    assert {tuple(x)[:3]: x["cls"] for x in landcover.absorb_small(df, (3,)).collect()} == absorbed_by_search(cells, 3)
    lost = df.where("false").unionByName(spark.createDataFrame([(0, None, 1, 2)], df.schema))
    assert landcover.components(lost).collect() == [(0, None, 1, 2, None)]


def test_lights_as_runs(spark):
    from tileweave.operators import records

    r = random.Random(8)
    ways = [(i, r.choice((1.0, 3.0, 5.0, 10.0, 600.0, 900.0, 1220.0, 1800.0, r.uniform(1, 4000))) + 130 + 150, r.choice((0.0, 150.0)), r.choice((0.0, 130.0))) for i in range(300)]
    df = spark.createDataFrame(ways, "line_no long, length double, before double, beyond double")
    edge, centre = {}, {}
    for i, length, a, b in ways:
        d = length - a - b
        n = int(d // 60) + 1
        s = d / n
        for k in range(1, n + 1):
            left = d - k * s
            if left > 610 or left > length / 2 or left > 5:
                edge[i, k] = ("white" if left > 610 or left > length / 2 else "yellow", a + k * s)
        edge |= {(i, -k): ("red", a - k * s) for k in range(1, int(a // s) + 1 if a > s else 1)}
        edge |= {(i, n + k): ("yellow", a + (n + k - 1) * s) for k in range(1, int(b // s) + 1 if b > s else 1)}
        n = int((length - a) // 15) + 1
        s, turn = (length - a) / n, 0
        for k in range(n):
            rest = length - a - k * s
            colour = "white" if rest > 900 else "red" if rest <= 300 else ("white", "red")[turn % 2]
            turn += rest <= 900
            centre[i, k] = (colour, a + k * s)
    runs = records.edge_light_runs(df)
    for side in (-1, 1):
        assert {(x["line_no"], x["k"]): (x["colour"], x["along"]) for x in records.edge_lights(df).where(F.col("side") == side).collect()} == edge
    assert {(x["line_no"], x["k"]): (x["colour"], x["along"]) for x in records.centre_lights(df).collect()} == centre
    # a row for each colour's run, not for each light
    assert runs.agg(F.sum(F.expr("last - first + 1"))).first()[0] == 2 * len(edge) and runs.count() <= 8 * len(ways)
    assert runs.groupBy("line_no").agg(F.max("to_m").alias("m")).orderBy("line_no").first()["m"] == max(v[1] for k, v in edge.items() if k[0] == 0)
