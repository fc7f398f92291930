"""Column functions over fixed-point coordinates: tile ids, names, bounds, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Arcseconds of a degree, of a tile's height, and the sphere's radius in metres (fixed values).
DEGREE, TILE_HEIGHT, RADIUS = 3600, 450, 6371008.8
#: (lower latitude, tile width in eighths of a degree), the first true one counts (fixed values).
BANDS = ((89, 2880), (88, 64), (86, 32), (83, 16), (76, 8), (62, 4), (22, 2), (-22, 1), (-62, 2), (-76, 4), (-83, 8), (-86, 16), (-88, 32), (-89, 64))


def floor_div(a: Column, b: int) -> Column:
    """Integer division that rounds down; exact for 64-bit integers."""
    b = F.lit(b).cast("long")
    return ((a - F.pmod(a, b)) / b).cast("long")


def width8(lat_as: Column) -> Column:
    """Width in eighths of a degree of the tiles at a latitude."""
    out = None
    for low, w in BANDS:
        cond = lat_as >= low * DEGREE
        out = F.when(cond, w) if out is None else out.when(cond, w)
    return out.otherwise(2880).cast("long")


def tile_id(lon_as: Column, lat_as: Column) -> Column:
    """Packed id of the tile that holds a point, by its latitude band."""
    fl, ft, w = floor_div(lon_as, DEGREE), floor_div(lat_as, DEGREE), width8(lat_as)
    y = floor_div(lat_as - ft * DEGREE, TILE_HEIGHT)
    x = F.floor((lon_as - fl * DEGREE) / (w * 450)).cast("long")
    deg = (w / 8).cast("long")
    east = (lon_as / (deg * DEGREE)).cast("long") * deg
    west = F.greatest(F.lit(-180).cast("long"), ((lon_as + DEGREE) / (deg * DEGREE)).cast("long") * deg - deg)
    base = F.when(w <= 8, fl).when(lon_as >= 0, east).otherwise(west)
    return F.shiftleft(base + 180, 14) + F.shiftleft(ft + 90, 6) + F.shiftleft(y, 3) + F.when(w <= 8, x).otherwise(F.lit(0).cast("long"))


def _corner(lon: Column, lat: Column) -> Column:
    return F.concat(F.when(lon < 0, "w").otherwise("e"), F.lpad(F.abs(lon).cast("string"), 3, "0"), F.when(lat < 0, "s").otherwise("n"), F.lpad(F.abs(lat).cast("string"), 2, "0"))


def tile_dir(lon_as: Column, lat_as: Column) -> Column:
    """Directory of a point's tile: ten-degree folder, one-degree folder."""
    fl, ft = floor_div(lon_as, DEGREE), floor_div(lat_as, DEGREE)
    return F.concat_ws("/", _corner(floor_div(fl, 10) * 10, floor_div(ft, 10) * 10), _corner(fl, ft))


def tile_south(tile: Column) -> Column:
    """Latitude in arcseconds of a tile's south edge."""
    return (F.shiftright(tile, 6).bitwiseAND(255) - 90) * DEGREE + F.shiftright(tile, 3).bitwiseAND(7) * TILE_HEIGHT


def tile_west(tile: Column) -> Column:
    """Longitude in arcseconds of a tile's west edge."""
    w = width8(tile_south(tile))
    return (F.shiftright(tile, 14) - 180) * DEGREE + F.when(w <= 8, tile.bitwiseAND(7) * w * 450).otherwise(0)


def tile_width(tile: Column) -> Column:
    """Width of a tile in arcseconds."""
    return width8(tile_south(tile)) * 450


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between two points given in degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial heading in degrees from north, 0 to 360."""
    dl = F.radians(lon2 - lon1)
    y = F.sin(dl) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


# The same formulas as DuckDB SQL, for the queries' counterparts.


def sql_width8(lat: str) -> str:
    return "CASE " + " ".join(f"WHEN {lat} >= {low * DEGREE} THEN {w}" for low, w in BANDS) + " ELSE 2880 END"


def sql_tile_id(lon: str, lat: str) -> str:
    fl, ft, w = f"CAST(floor({lon}/3600.0) AS BIGINT)", f"CAST(floor({lat}/3600.0) AS BIGINT)", f"({sql_width8(lat)})"
    base = f"CASE WHEN {w} <= 8 THEN {fl} WHEN {lon} >= 0 THEN ({lon}//({w}*450))*({w}//8) ELSE greatest(-180, (({lon}+3600)//({w}*450))*({w}//8)-({w}//8)) END"
    return f"((({base})+180)*16384 + ({ft}+90)*64 + (({lat}-{ft}*3600)//450)*8 + CASE WHEN {w} <= 8 THEN ({lon}-{fl}*3600)//({w}*450) ELSE 0 END)"


def sql_corner(lon: str, lat: str) -> str:
    return f"concat(CASE WHEN {lon} < 0 THEN 'w' ELSE 'e' END, lpad(CAST(abs({lon}) AS VARCHAR), 3, '0'), CASE WHEN {lat} < 0 THEN 's' ELSE 'n' END, lpad(CAST(abs({lat}) AS VARCHAR), 2, '0'))"


def sql_tile_dir(lon: str, lat: str) -> str:
    fl, ft = f"CAST(floor({lon}/3600.0) AS BIGINT)", f"CAST(floor({lat}/3600.0) AS BIGINT)"
    return f"concat({sql_corner(f'CAST(floor({fl}/10.0) AS BIGINT)*10', f'CAST(floor({ft}/10.0) AS BIGINT)*10')}, '/', {sql_corner(fl, ft)})"


def sql_south(t: str) -> str:
    return f"(((({t}) >> 6) & 255) - 90)*3600 + ((({t}) >> 3) & 7)*450"


def sql_west(t: str) -> str:
    return f"((({t}) >> 14) - 180)*3600 + CASE WHEN ({sql_width8(sql_south(t))}) <= 8 THEN (({t}) & 7)*({sql_width8(sql_south(t))})*450 ELSE 0 END"


def sql_width(t: str) -> str:
    return f"({sql_width8(sql_south(t))})*450"
