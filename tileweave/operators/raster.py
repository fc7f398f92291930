"""Elevation rasters: cells (tile_no, col, row, elev), null where void."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.functions.shared import cut, spread

CELL = ["tile_no", "col", "row"]


def to_cells(rows: DataFrame) -> DataFrame:
    """cells from (tile_no, col, elevs ARRAY): one element a row."""
    return rows.select("tile_no", "col", F.posexplode("elevs").alias("row", "elev"))


def from_cells(cells: DataFrame) -> DataFrame:
    """(tile_no, col, elevs ARRAY) in row order; a column is bounded by the tile's height."""
    return cells.groupBy("tile_no", "col").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "elev"))), lambda s: s["elev"]).alias("elevs"))


def chop_cells(cells: DataFrame, size: int) -> DataFrame:
    """Cells at absolute (x, y) dealt to tiles (tx, ty) of size steps with closed extents: border cells belong to both.

    Tiles that don't have all (size + 1)^2 cells are left out.
    """
    span = lambda c: F.array_distinct(F.array(F.floor(F.col(c) / size), F.floor((F.col(c) - 1) / size)))
    dealt = cells.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y")))
    whole = dealt.groupBy("tx", "ty").count().where(F.col("count") == (size + 1) ** 2).select("tx", "ty")
    return dealt.join(whole, ["tx", "ty"], "left_semi")


def drop_zero_tiles(cells: DataFrame) -> DataFrame:
    """Cells of tiles that have an elevation other than zero short of their last column and row."""
    inner = cells.join(cells.groupBy("tile_no").agg(F.max("col").alias("__c"), F.max("row").alias("__r")), "tile_no").where("col < __c AND row < __r")
    some = inner.groupBy("tile_no").agg(F.bool_or(F.col("elev") != 0).alias("keep")).where("keep").select("tile_no")
    return cells.join(some, "tile_no", "left_semi")


def stitch_border(cells: DataFrame, size: int, across: int) -> DataFrame:
    """Cells with one more column and row, taken from the tiles to the east, north and north-east.

    Tiles are numbered `across` in a row of the world. A missing neighbour gives 0; at the world's edge the own last
    cells repeat.
    """
    last = size - 1
    take = lambda want, t, c, r: cells.where(want).select((F.col("tile_no") + t).alias("tile_no"), F.lit(c).cast("long").alias("col") if c is not None else F.col("col"), F.lit(r).cast("long").alias("row") if r is not None else F.col("row"), "elev")
    tiles = cells.select("tile_no").distinct()
    edge = (F.col("tile_no") % across == across - 1)
    found = take(F.col("col") == 0, -1, size, None).where(~edge).unionByName(take(F.col("row") == 0, -across, None, size)).unionByName(take((F.col("col") == 0) & (F.col("row") == 0), -across - 1, size, size).where(~edge))
    steps = F.sequence(F.lit(0).cast("long"), F.lit(size).cast("long"))
    border = tiles.select("tile_no", F.explode(F.array_distinct(F.concat(F.transform(steps, lambda r: F.struct(F.lit(size).cast("long").alias("col"), r.alias("row"))), F.transform(steps, lambda c: F.struct(c.alias("col"), F.lit(size).cast("long").alias("row")))))).alias("b")).select("tile_no", "b.*")
    own = cells.where((F.col("col") == last) | (F.col("row") == last)).select("tile_no", F.col("col").alias("oc"), F.col("row").alias("orow"), F.col("elev").alias("own"))
    b = border.join(found.withColumn("__has", F.lit(1)), CELL, "left").withColumn("oc", F.least("col", F.lit(last).cast("long"))).withColumn("orow", F.least("row", F.lit(last).cast("long"))).join(own, ["tile_no", "oc", "orow"], "left")
    world = edge & (F.col("col") == size)
    return cells.select(*CELL, "elev").unionByName(b.select(*CELL, F.when(F.col("__has") == 1, F.col("elev")).when(world, F.col("own")).otherwise(0).cast("long").alias("elev")))


def resample(targets: DataFrame, sources: DataFrame, step: int) -> DataFrame:
    """targets (tile_no, x, y) with elev of the nearest source cell on a grid of `step`; later sources win where valid.

    sources: (source, sx, sy, elev) with sx, sy in source steps.
    """
    best = sources.where("elev is not null").groupBy("sx", "sy").agg(F.max_by("elev", "source").alias("elev"))
    near = lambda c: F.floor((2 * F.col(c) + step) / (2 * step)).cast("long")
    return targets.withColumn("sx", near("x")).withColumn("sy", near("y")).join(best, ["sx", "sy"], "left").drop("sx", "sy")


def coverage_gate(cells: DataFrame, max_void_percent: int = 5, force: bool = False) -> DataFrame:
    """Cells of tiles with no more than so many percent of voids; force keeps all."""
    if force:
        return cells
    ok = cells.groupBy("tile_no").agg(F.count("*").alias("n"), F.count("elev").alias("v")).where((F.col("n") - F.col("v")) * 100 <= max_void_percent * F.col("n")).select("tile_no")
    return cells.join(ok, "tile_no", "left_semi")


def fill_from(cells: DataFrame, secondary: DataFrame) -> DataFrame:
    """Voids filled from another raster's cell; `filled` marks them."""
    s = secondary.select(*CELL, F.col("elev").alias("__e"))
    return cells.join(s, CELL, "left").select(*CELL, F.coalesce("elev", "__e").alias("elev"), (F.col("elev").isNull() & F.col("__e").isNotNull()).alias("filled"))


def fill_voids(cells: DataFrame, passes: int = 2) -> DataFrame:
    """Voids filled along columns, then along rows, with the value before or else the one after; what stays is 0."""
    out = cells
    for line, along in (("col", "row"), ("row", "col")) * passes:
        w = W.partitionBy("tile_no", line).orderBy(along)
        back, on = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
        out = out.withColumn("elev", F.coalesce(F.last("elev", True).over(back), F.first("elev", True).over(on)))
    return out.withColumn("elev", F.coalesce("elev", F.lit(0).cast("long")))


def clean_profile(cells: DataFrame, limit: int = 10000) -> DataFrame:
    """Feet become metres; values over the limit in metres take the last good value before them in their column, at first 0."""
    w = W.partitionBy("tile_no", "col").orderBy("row").rowsBetween(W.unboundedPreceding, 0)
    metres = F.col("elev") * 0.3048
    return cells.withColumn("elev_m", F.round(F.coalesce(F.last(F.when(metres <= limit, metres), True).over(w), F.lit(0.0)), 6))


def sample_elevation(points: DataFrame, cells: DataFrame, size: int, step: int, fallback: bool = True) -> DataFrame:
    """points (pt_id, tile_no, x, y) in the tile's fine units with elev interpolated in the cell's triangle.

    `step` fine units make one cell; pt_id tells rows apart. Outside, elev is null. Where a corner of the triangle is void,
    it is that of the nearest valid cell of the tile, or null without fallback.
    """
    inside = (F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") <= (size - 1) * step) & (F.col("y") <= (size - 1) * step)
    idx = lambda c: F.least(F.floor(F.col(c) / step), F.lit(size - 2)).cast("long")
    own = points.select("pt_id", "tile_no", "x", "y")
    p = own.withColumn("i", idx("x")).withColumn("j", idx("y")).withColumn("dx", F.col("x") - F.col("i") * step).withColumn("dy", F.col("y") - F.col("j") * step).withColumn("low", F.col("dx") > F.col("dy"))
    # the triangle's corners, in one join: the cell's first, the one beside or above it, the one across
    beside = F.when(F.col("low"), F.struct((F.col("i") + 1).alias("c"), F.col("j").alias("r"))).otherwise(F.struct(F.col("i").alias("c"), (F.col("j") + 1).alias("r")))
    corners = F.array(F.struct(F.col("i").alias("c"), F.col("j").alias("r")), beside, F.struct((F.col("i") + 1).alias("c"), (F.col("j") + 1).alias("r")))
    asked = p.where(inside).select("pt_id", "tile_no", "x", "y", "dx", "dy", "low", F.posexplode(corners).alias("k", "at")).select("*", F.col("at.c").alias("col"), F.col("at.r").alias("row")).drop("at")
    z = spread(asked).join(cells.where("elev is not null").select(*CELL, "elev"), CELL).groupBy("pt_id", "tile_no", "x", "y", "dx", "dy", "low").agg(*[F.max(F.when(F.col("k") == k, F.col("elev"))).alias(f"z{k + 1}") for k in range(3)])
    # over the triangle the surface is a plane: z1 + dx * slope in x + dy * slope in y
    sx = F.when(F.col("low"), F.col("z2") - F.col("z1")).otherwise(F.col("z3") - F.col("z2"))
    sy = F.when(F.col("low"), F.col("z3") - F.col("z2")).otherwise(F.col("z2") - F.col("z1"))
    whole = z.select("pt_id", F.round(F.col("z1") + (F.col("dx") * sx + F.col("dy") * sy) / step, 6).alias("elev"))
    sampled = points.join(spread(whole), "pt_id", "left").select(*points.columns, "elev")
    if not fallback:
        return sampled
    # computed once: the cells, which may be the end of a long plan, are read again only where points are left
    sampled = cut(sampled)
    rest = sampled.where("elev is null").where(inside).select("pt_id", "tile_no", "x", "y")
    if not rest.limit(1).count():
        return sampled
    near = nearest_valid(rest, cells, step).select("pt_id", F.col("elev").cast("double").alias("__near"))
    return sampled.join(spread(near), "pt_id", "left").select(*points.columns, F.coalesce("elev", "__near").alias("elev"))


def nearest_valid(points: DataFrame, cells: DataFrame, step: int, ring: int = 2) -> DataFrame:
    """points (pt_id, tile_no, x, y) with elev of the nearest cell that isn't void; ties by column, then row.

    Cells within `ring` of the point's are looked at first; points without one there look at their whole tile, which
    is bounded in size.
    """
    valid = cells.where("elev is not null")
    near = F.floor(F.col("x") / step), F.floor(F.col("y") / step)
    steps = F.sequence(F.lit(-ring).cast("long"), F.lit(ring + 1).cast("long"))
    cand = points.withColumn("col", F.explode(F.transform(steps, lambda k: near[0] + k))).withColumn("row", F.explode(F.transform(steps, lambda k: near[1] + k)))
    dist = (F.pow(F.col("col") * step - F.col("x"), 2) + F.pow(F.col("row") * step - F.col("y"), 2)).cast("long")
    best = lambda df: df.groupBy("pt_id", "tile_no", "x", "y").agg(F.min(F.struct(dist.alias("d"), "col", "row", "elev")).alias("b"))
    first = best(spread(cand).join(valid, CELL))
    # within the ring a hit is surely nearest when it is no farther than the ring reaches
    sure = first.where(F.col("b.d") <= (ring * step) ** 2)
    rest = points.join(spread(sure.select("pt_id")), "pt_id", "left_anti")
    return sure.unionByName(best(spread(rest).join(valid, "tile_no"))).select("pt_id", "tile_no", "x", "y", F.col("b.elev").alias("elev"))


def pick_source(sources: DataFrame) -> DataFrame:
    """Rows (source, tile_no, ...) of the first source, by rank, that has each tile."""
    chosen = sources.groupBy("tile_no").agg(F.min("rank").alias("rank"))
    return sources.join(chosen, ["tile_no", "rank"], "left_semi")


def average_elevation(points: DataFrame, group: str) -> DataFrame:
    """Mean of sampled points' elevations by group; nulls don't count."""
    return points.groupBy(group).agg(F.round(F.avg("elev"), 6).alias("avg_elev"), F.count("elev").alias("n"))


def mosaic(cells: DataFrame, origin_x: Column, origin_y: Column) -> DataFrame:
    """(x, y, elev) of one grid from tiles placed at their origins; the later tile wins where they overlap."""
    at = cells.withColumn("x", origin_x + F.col("col")).withColumn("y", origin_y + F.col("row"))
    return at.groupBy("x", "y").agg(F.max_by("elev", "tile_no").alias("elev"))


def _tile_points(col, row, elev, max_err: float, min_pts: int, max_pts: int):
    """Places in (col, row, elev) of the chosen cells of one tile."""
    import numpy as np

    if min(col.min(), row.min()) < 0:
        raise ValueError("cells are numbered from 0")
    n, side = len(col), 1 << max(0, int(max(col.max(), row.max(), 1) - 1).bit_length())
    at = np.full((side + 1, side + 1), -1, np.int64)
    at[col, row] = np.arange(n)
    z = np.where(at >= 0, elev[np.maximum(at, 0)], np.nan)
    worst, first = np.zeros(n), np.full(n, 99)
    over, level, s = np.ones((2, 2), bool), 0, side
    while True:
        bc, br, wide = col // s, row // s, side // s + 1
        mine = over[bc, br]
        if not mine.any():
            break
        c, r, e = col[mine], row[mine], elev[mine]
        bc, br = bc[mine], br[mine]
        corner = lambda dc, dr: z[np.minimum((bc + dc) * s, side), np.minimum((br + dr) * s, side)]
        z0, z1, z2, z3 = (corner(dc, dr) for dc, dr in ((0, 0), (1, 0), (0, 1), (1, 1)))
        # a void corner counts as high as the next one along the block's border; a block with void corners only is halved
        z0, z1, z2, z3 = (np.where(np.isnan(v), np.where(np.isnan(a), np.where(np.isnan(b), o, b), a), v) for v, a, b, o in ((z0, z1, z2, z3), (z1, z0, z3, z2), (z2, z0, z3, z1), (z3, z1, z2, z0)))
        u, v = c / s - bc, r / s - br
        off = np.abs(e - (z0 * (1 - u) * (1 - v) + z1 * u * (1 - v) + z2 * (1 - u) * v + z3 * u * v))
        off = np.where(np.isnan(off), np.inf, off)
        err = np.full((wide, wide), -1.0)
        np.maximum.at(err, (bc, br), off)
        i, j = np.nonzero(err >= 0)
        for dc in (0, 1):
            for dr in (0, 1):
                x, y = (i + dc) * s, (j + dr) * s
                ok = (x <= side) & (y <= side)
                k, d = at[x[ok], y[ok]], err[i[ok], j[ok]]
                np.maximum.at(worst, k[k >= 0], d[k >= 0])
                first[k[k >= 0]] = np.minimum(first[k[k >= 0]], level)
        if s == 1:
            break
        # a block that departs by more than max_err is halved
        over = np.repeat(np.repeat(err > max_err, 2, 0), 2, 1)
        level, s = level + 1, s // 2
    chosen = np.lexsort((row, col, -worst, first))[: min(int((first < 99).sum()), max_pts)]
    if len(chosen) < min_pts:
        spread = np.argsort((col * 73856093 ^ row * 19349663) % 1_000_003, kind="stable")
        chosen = np.concatenate([chosen, spread[~np.isin(spread, chosen)][: min_pts - len(chosen)]])
    return chosen


def select_points(cells: DataFrame, max_err: float, min_pts: int = 50, max_pts: int = 1000) -> DataFrame:
    """Grid points (tile_no, col, row, elev) that approximate each tile within max_err, between min_pts and max_pts.

    Square blocks are halved, down to single cells, while a cell departs by more than max_err from the plane blend of the
    block's corners; corners of the blocks that are reached so are the points. Where they are more than max_pts, those of
    the larger blocks and then of the larger errors stay; where they are fewer than min_pts, others spread over the tile
    are added. A tile's cells, which its grid bounds, meet in one task; only they are shuffled, once.
    """

    def choose(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks().sort_by([("col", "ascending"), ("row", "ascending")])
        col, row, elev = (t[c].to_numpy() for c in ("col", "row", "elev"))
        return t.take(pa.array(_tile_points(col.astype(np.int64), row.astype(np.int64), elev.astype(np.float64), max_err, min_pts, max_pts)))

    z = cells.where("elev is not null").select(*CELL, "elev")
    return z.groupBy("tile_no").applyInArrow(choose, z.schema)


def _worst_first(col, row, elev, max_err: float, min_pts: int, max_pts: int):
    """(points, triangles, error left) of one tile: points are (col, row, elev), triangles their places, counter-clockwise.

    Starts from the extent's corners, a void one with the elevation of the nearest cell. The cell farthest from its
    triangle (ties: column, then row) is inserted; triangles whose circle holds it make way, and their cells are dealt to the new ones.
    """
    import heapq

    import numpy as np

    x0, x1, y0, y1 = (int(v) for v in (col.min(), col.max(), row.min(), row.max()))
    points = []
    for x, y in dict.fromkeys([(x0, y0), (x1, y0), (x1, y1), (x0, y1)]):
        points.append((x, y, float(elev[np.argmin((col - x) ** 2 + (row - y) ** 2)])))
    free = np.flatnonzero(~(np.isin(col, (x0, x1)) & np.isin(row, (y0, y1))))
    triangles, cells_of, across, heap = {}, {}, {}, []
    side = lambda a, b, x, y: (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])

    def add(a, b, c, cells):
        """A new triangle takes those of cells that lie in it; the others are given back."""
        k = len(triangles) + len(gone)
        triangles[k] = (a, b, c)
        across.update({(a, b): k, (b, c): k, (c, a): k})
        p, q, r = points[a], points[b], points[c]
        x, y = col[cells], row[cells]
        wp, wq, wr = side(q, r, x, y), side(r, p, x, y), side(p, q, x, y)
        own = (wp >= 0) & (wq >= 0) & (wr >= 0)
        cells_of[k] = cells[own]
        if own.any():
            off = np.abs(elev[cells_of[k]] - (wp * p[2] + wq * q[2] + wr * r[2])[own] / side(p, q, r[0], r[1]))
            w = np.lexsort((row[cells_of[k]], col[cells_of[k]], -off))[0]
            at = int(cells_of[k][w])
            heapq.heappush(heap, (-float(off[w]), int(col[at]), int(row[at]), at, k))
        return cells[~own]

    def holds(k, x, y):
        """Whether (x, y) lies inside the circle through a triangle's corners, in whole numbers."""
        (ax, ay), (bx, by), (cx, cy) = ((points[i][0] - x, points[i][1] - y) for i in triangles[k])
        a, b, c = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        return ax * (by * c - b * cy) - ay * (bx * c - b * cx) + a * (bx * cy - by * cx) > 0

    gone: set[int] = set()
    add(0, 2, 3, add(0, 1, 2, free))
    while heap and len(points) < max_pts:
        worst, x, y, at, k = heap[0]
        if k in gone:
            heapq.heappop(heap)
            continue
        if -worst <= max_err and len(points) >= min_pts:
            break
        open_, cavity = [k], {k}
        while open_:
            a, b, c = triangles[open_.pop()]
            for twin in ((b, a), (c, b), (a, c)):
                other = across.get(twin)
                if other is not None and other not in cavity and holds(other, x, y):
                    cavity.add(other)
                    open_.append(other)
        rim = [(u, v) for t in sorted(cavity) for u, v in zip(triangles[t], triangles[t][1:] + triangles[t][:1], strict=True) if across.get((v, u)) not in cavity]
        left = np.concatenate([cells_of.pop(t) for t in sorted(cavity)])
        left = left[left != at]
        for t in cavity:
            a, b, c = triangles.pop(t)
            for e in ((a, b), (b, c), (c, a)):
                del across[e]
        gone |= cavity
        points.append((x, y, float(elev[at])))
        for u, v in rim:
            if side(points[u], points[v], x, y):
                left = add(u, v, len(points) - 1, left)
    error = max((-h[0] for h in heap if h[4] not in gone), default=0.0)
    return points, list(triangles.values()), error


def insert_points(cells: DataFrame, max_err: float = 40.0, min_pts: int = 50, max_pts: int = 1000) -> DataFrame:
    """Grid points (tile_no, col, row, elev, left) of each tile's surface of triangles, worst point first.

    From the tile's corners on, the cell that departs most from the surface becomes a point, and the triangles around it
    are drawn anew so that no circle through a triangle's corners holds a point, until no cell departs by more than max_err and there are
    min_pts points, or max_pts are reached, or cells run out; `left` is the largest departure then. Void cells are no points, but
    a void corner gets the nearest cell's elevation. Tiles of one row or column go to select_points' rule, `left` null. A tile's
    cells, which its grid bounds, meet in one task; only they are shuffled, once.
    """

    def choose(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks().sort_by([("col", "ascending"), ("row", "ascending")])
        col, row, elev = (t[c].to_numpy().astype(kind) for c, kind in (("col", np.int64), ("row", np.int64), ("elev", np.float64)))
        if np.ptp(col) and np.ptp(row):
            points, _, left = _worst_first(col, row, elev, max_err, min_pts, max_pts)
        else:
            points, left = [(col[i], row[i], elev[i]) for i in _tile_points(col, row, elev, max_err, min_pts, max_pts)], None
        values = [[t["tile_no"][0].as_py()] * len(points), *zip(*points, strict=True), [left] * len(points)]
        return pa.table({n: pa.array(v, pa.float64() if n in ("elev", "left") else t.schema.field(n).type) for n, v in zip(("tile_no", "col", "row", "elev", "left"), [list(map(float, v)) if i in (3,) else list(v) for i, v in enumerate(values)], strict=True)})

    z = cells.where("elev is not null").select(*CELL, "elev")
    kinds = dict(z.dtypes)
    return z.groupBy("tile_no").applyInArrow(choose, ", ".join([*(f"{c} {kinds[c]}" for c in CELL), "elev double", "left double"]))


def approx_error(cells: DataFrame, approx: DataFrame) -> DataFrame:
    """(tile_no, max_err, rms_err, n) of an approximation on the same cells; voids don't count."""
    a = approx.select(*CELL, F.col("elev").alias("a"))
    d = F.col("elev") - F.col("a")
    return cells.join(a, CELL).where(d.isNotNull()).groupBy("tile_no").agg(F.max(F.abs(d)).alias("max_err"), F.round(F.sqrt(F.avg(d * d)), 6).alias("rms_err"), F.count("*").alias("n"))


def subsample(cells: DataFrame, size: int, n: int) -> DataFrame:
    """Every cell that is on the regular n x n sub-grid of a size x size tile, ends included."""
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.floor((2 * k * (size - 1) + (n - 1)) / (2 * (n - 1))).cast("long"))
    return cells.where(F.array_contains(at, F.col("col")) & F.array_contains(at, F.col("row")))


def with_mask(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """cells with the mask (col, row, mark) of their place: select, ignore, or unknown where it has none."""
    return cells.join(mask, ["col", "row"], "left").withColumn("mark", F.coalesce("mark", F.lit("unknown")))


def block_mean(cells: DataFrame, mult: int) -> DataFrame:
    """Coarse grid of means over blocks of (mult + 1)^2 cells that share their borders; voids don't count."""
    span = lambda c: F.array_distinct(F.array(F.floor(F.col(c) / mult), F.greatest(F.lit(0), F.floor((F.col(c) - 1) / mult))))
    b = cells.withColumn("bc", F.explode(span("col"))).withColumn("br", F.explode(span("row")))
    return b.groupBy("tile_no", "bc", "br").agg(F.round(F.avg("elev"), 6).alias("mean_elev"))


def clamp(cells: DataFrame, spread: int = 100) -> DataFrame:
    """Elevations held within `spread` of the middle between the tile's lowest and highest."""
    mid = cells.groupBy("tile_no").agg(F.floor((F.min("elev") + F.max("elev")) / 2).alias("__m"))
    return cells.join(mid, "tile_no").withColumn("elev", F.least(F.greatest("elev", F.col("__m") - spread), F.col("__m") + spread)).drop("__m")


def limit_slope(cells: DataFrame, max_step: int, rounds: int = 8) -> DataFrame:
    """Elevations such that neighbours to the east, north and north-east differ by at most max_step.

    Each round lowers every cell at once to at most its lowest neighbour plus max_step, until none changes in `rounds` rounds, so the
    result doesn't depend on an order of cells. Neighbours are of one tile, whose cells, which its grid bounds, meet in one task; only they are
    shuffled, once. Of cells at one place the highest is lowered, by the lowest of its neighbours; cells without a place stay.
    """

    def lowered(t):
        import numpy as np
        import pyarrow as pa

        col, row, elev = (t[c].to_numpy() for c in ("col", "row", "elev"))
        span = int(np.ptp(row)) + 3
        place, at = np.unique((col - col.min()) * span + (row - row.min() + 1), return_inverse=True)
        cap, z = np.full(len(place), elev.max()), np.full(len(place), elev.min())
        np.minimum.at(cap, at, elev)
        np.maximum.at(z, at, elev)
        near = []
        for step in (span, 1, span + 1, -span, -1, -span - 1):
            k = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
            here = np.flatnonzero(place[k] == place + step)
            near.append((here, k[here]))
        while True:
            was = z.copy()
            for _ in range(rounds):
                for here, k in near:
                    z[here] = np.minimum(z[here], cap[k] + max_step)
                cap = z.copy()
            if (z == was).all():
                break
        return pa.table({"tile_no": pa.repeat(t["tile_no"][0], len(z)), "col": place // span + col.min(), "row": place % span - 1 + row.min(), "elev": z}).cast(pa.schema([t.schema.field(c) for c in (*CELL, "elev")]))

    z = cells.where("elev is not null").select(*CELL, F.col("elev").cast("double" if dict(cells.dtypes)["elev"] in ("float", "double") else "long").alias("elev"))
    kinds = dict(z.dtypes)
    placed = z.dropna(subset=["col", "row"]).groupBy("tile_no").applyInArrow(lowered, ", ".join(f"{c} {kinds[c]}" for c in (*CELL, "elev")))
    return placed.unionByName(z.where("col is null or row is null"))


MONOMIALS = [(i, j) for i in range(4) for j in range(4)]


def fit_surface(points: DataFrame, key: str = "tile_no", ridge: float = 1e-9) -> DataFrame:
    """(key, coeffs ARRAY of 16): least-squares bi-cubic surface over (u, v, elev), u and v from -1 to 1.

    The sums of the normal equations are one aggregation; only a 16 x 16 system for each key is solved in Python.
    """
    m = [F.pow("u", F.lit(i)) * F.pow("v", F.lit(j)) for i, j in MONOMIALS]
    powers = {(i, j): F.sum(F.pow("u", F.lit(i)) * F.pow("v", F.lit(j))) for i in range(7) for j in range(7)}
    sums = points.where("elev is not null").groupBy(key).agg(F.array(*[powers[k] for k in sorted(powers)]).alias("p"), F.array(*[F.sum(x * F.col("elev")) for x in m]).alias("b"))
    kind = dict(points.dtypes)[key]

    def solve(batches):
        import numpy as np

        at = {k: n for n, k in enumerate(sorted((i, j) for i in range(7) for j in range(7)))}
        for pdf in batches:
            out = []
            for p, b in zip(pdf["p"], pdf["b"], strict=True):
                a = np.array([[p[at[(i + k, j + n)]] for k, n in MONOMIALS] for i, j in MONOMIALS])
                out.append(np.linalg.solve(a + ridge * np.trace(a) * np.eye(16), np.array(b)).tolist())
            yield pdf[[key]].assign(coeffs=out)

    return sums.mapInPandas(solve, f"{key} {kind}, coeffs array<double>")


def eval_surface(points: DataFrame, surfaces: DataFrame, key: str = "tile_no") -> DataFrame:
    """points (key, u, v) with elev_fit of the key's surface; null outside -1 to 1."""
    z = sum((F.col("coeffs")[n] * F.pow("u", F.lit(i)) * F.pow("v", F.lit(j)) for n, (i, j) in enumerate(MONOMIALS)), F.lit(0.0))
    ok = (F.abs("u") <= 1) & (F.abs("v") <= 1)
    return points.join(surfaces, key, "left").withColumn("elev_fit", F.when(ok, z)).drop("coeffs")


def roughness(sampled: DataFrame, key: str) -> DataFrame:
    """(key, rough) of sampled vertices: (highest - lowest) / 50."""
    return sampled.groupBy(key).agg(F.round((F.max("elev") - F.min("elev")) / 50, 6).alias("rough"))


def raster_stats(cells: DataFrame, by: list[str]) -> DataFrame:
    """Lowest, highest, valid and all cells, and extent."""
    return cells.groupBy(*by).agg(F.min("elev").alias("min_elev"), F.max("elev").alias("max_elev"), F.count("elev").alias("n_valid"), F.count("*").alias("n_cells"), F.max("col").alias("max_col"), F.max("row").alias("max_row"))
