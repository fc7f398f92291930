"""Tiling: which tiles points and boxes lie in, tile geometry, neighbours, hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileweave.functions.geo import TILE_HEIGHT, floor_div, tile_dir, tile_id, tile_south, tile_west, tile_width, width8


def assign_tiles(points: DataFrame, lon: str = "lon_as", lat: str = "lat_as") -> DataFrame:
    """points with tile and tile_dir."""
    return points.withColumn("tile", tile_id(F.col(lon), F.col(lat))).withColumn("tile_dir", tile_dir(F.col(lon), F.col(lat)))


def tiles_in_bbox(boxes: DataFrame, key: str = "box_id", centre_only: bool = False) -> DataFrame:
    """(key, tile) for boxes (key, w, s, e, n) in arcseconds: every tile that a box meets.

    With centre_only, tiles whose centre is inside the box. A box becomes its latitude rows, and a row the tiles of
    that row's width, so nothing is joined.
    """
    rows = boxes.withColumn("__y", F.explode(F.sequence(floor_div(F.col("s"), TILE_HEIGHT), floor_div(F.col("n"), TILE_HEIGHT)))).withColumn("__lat", F.col("__y") * TILE_HEIGHT)
    rows = rows.withColumn("__w", width8(F.col("__lat")) * 450)
    cells = rows.withColumn("__x", F.explode(F.sequence(F.floor(F.col("w") / F.col("__w")), F.floor(F.col("e") / F.col("__w"))))).withColumn("__lon", F.col("__x") * F.col("__w"))
    out = cells.withColumn("tile", tile_id(F.greatest("__lon", F.lit(-648000).cast("long")), F.col("__lat")))
    if centre_only:
        cx, cy = 2 * F.col("__lon") + F.col("__w"), 2 * F.col("__lat") + TILE_HEIGHT
        out = out.where((cx >= 2 * F.col("w")) & (cx <= 2 * F.col("e")) & (cy >= 2 * F.col("s")) & (cy <= 2 * F.col("n")))
    return out.select(key, "tile").distinct()


def remove_tiles(tiles: DataFrame, gone: DataFrame) -> DataFrame:
    """tiles without those of gone."""
    return tiles.join(gone.select("tile").distinct(), "tile", "left_anti")


def tile_bounds(tiles: DataFrame) -> DataFrame:
    """tiles with west, south, width, height and doubled centre (cx2, cy2) in arcseconds."""
    t = F.col("tile")
    out = tiles.withColumn("west", tile_west(t)).withColumn("south", tile_south(t)).withColumn("width", tile_width(t)).withColumn("height", F.lit(TILE_HEIGHT).cast("long"))
    return out.withColumn("cx2", 2 * F.col("west") + F.col("width")).withColumn("cy2", 2 * F.col("south") + F.col("height"))


def tile_neighbors(tiles: DataFrame) -> DataFrame:
    """(tile, neighbor): the tiles that share an edge or corner; a row of other width may hold several."""
    b = tile_bounds(tiles.select("tile").distinct())
    rows = b.withColumn("__lat", F.explode(F.array(*[F.col("south") + k * TILE_HEIGHT for k in (-1, 0, 1)]))).where("__lat >= -324000 and __lat < 324000")
    rows = rows.withColumn("__w", width8(F.col("__lat")) * 450)
    x = F.sequence(F.floor((F.col("west") - 1) / F.col("__w")), F.floor((F.col("west") + F.col("width")) / F.col("__w")))
    cells = rows.withColumn("__x", F.explode(x)).withColumn("__lon", F.col("__x") * F.col("__w")).withColumn("__lon", F.pmod(F.col("__lon") + 648000, F.lit(1296000)) - 648000)
    return cells.select("tile", tile_id(F.col("__lon").cast("long"), F.col("__lat")).alias("neighbor")).where("tile <> neighbor").distinct()


#: Longitude and latitude factors from each level to the one below (fixed values).
FACTORS = ((2, 2), (3, 3), (2, 2))


def tile_parent(lon8: Column, lat8: Column, level: int) -> Column:
    """Box at `level` (0: finest) that holds a box given in eighths of a degree, as a struct of its corner and size."""
    w = h = 1
    for fx, fy in FACTORS[:level]:
        w, h = w * fx, h * fy
    return F.struct((floor_div(lon8, w) * w).alias("lon8"), (floor_div(lat8, h) * h).alias("lat8"), F.lit(w).alias("w8"), F.lit(h).alias("h8"), F.lit(level).alias("level"))


def pyramid(tiles: DataFrame, levels: int = 2) -> DataFrame:
    """(level, lon8, lat8, land, children, ratio) from (lon8, lat8, is_land): parents that hold land, level by level.

    Each level is rolled up from the one below; ratio is 1/children, by which a parent's mesh is simplified.
    """
    out, below = None, tiles.select("lon8", "lat8", F.col("is_land").cast("int").alias("land"))
    for level in range(1, levels + 1):
        p = tile_parent(F.col("lon8"), F.col("lat8"), level)
        now = below.select(p.alias("p"), "land").groupBy("p.lon8", "p.lat8").agg(F.sum(F.when(F.col("land") > 0, 1).otherwise(0)).alias("land"), F.count("*").alias("children")).where("land > 0")
        part = now.select(F.lit(level).alias("level"), "lon8", "lat8", "land", "children", F.round(1 / F.col("children"), 6).alias("ratio"))
        out, below = part if out is None else out.unionByName(part), now.select("lon8", "lat8", "land")
    return out


def tiles_with_data(grid: DataFrame, data: DataFrame) -> DataFrame:
    """Tiles of grid that data has rows of."""
    return grid.join(data.select("tile").distinct(), "tile", "left_semi")


def prechop(boxes: DataFrame, key: str = "box_id", margin: int = 2) -> DataFrame:
    """(key, w, s, e, n) cut into chunks of one degree, which bounds how many tiles a row can give.

    Chunks are wider by margin on all sides within the box; latitudes stay between the poles.
    """
    b = boxes.withColumn("__x", F.explode(F.sequence(floor_div(F.col("w"), 3600), floor_div(F.col("e"), 3600)))).withColumn("__y", F.explode(F.sequence(floor_div(F.col("s"), 3600), floor_div(F.col("n"), 3600))))
    lo = lambda c, g: F.greatest(F.col(c), F.col(g) * 3600 - margin)
    hi = lambda c, g: F.least(F.col(c), F.col(g) * 3600 + 3600 + margin)
    return b.select(key, lo("w", "__x").alias("w"), F.greatest(F.lit(-324000), lo("s", "__y")).alias("s"), hi("e", "__x").alias("e"), F.least(F.lit(323999), hi("n", "__y")).alias("n"))


def halo_windows(points: DataFrame, step: int = 512, halo: int = 256) -> DataFrame:
    """points (x, y) with each window (wx, wy) of a regular grid whose core or halo holds them; in_core marks the one."""
    span = lambda c: F.sequence(floor_div(F.col(c) - halo, step), floor_div(F.col(c) + halo, step))
    w = points.withColumn("wx", F.explode(span("x"))).withColumn("wy", F.explode(span("y")))
    return w.withColumn("in_core", (F.col("wx") == floor_div(F.col("x"), step)) & (F.col("wy") == floor_div(F.col("y"), step)))
