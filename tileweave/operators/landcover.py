"""Land cover: class cells (tile_no, x, y, cls)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tileweave.functions.shared import cut
from tileweave.operators.graph import connected_components, roots

AT = ["tile_no", "x", "y"]


def _offsets(reach: int, diag: bool = True) -> Column:
    """Offsets (dx, dy, n) of a square neighbourhood in scan order, column by column, the cell itself left out."""
    out, n = [], 0
    for dx in range(-reach, reach + 1):
        for dy in range(-reach, reach + 1):
            if (dx or dy) and (diag or not dx or not dy):
                out.append(F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy"), F.lit(n).alias("n")))
                n += 1
    return F.array(*out)


def class_at(points: DataFrame, cells: DataFrame, per_degree: int = 120) -> DataFrame:
    """points (lon, lat in degrees) with cls of their cell in a world grid that starts at -180, 90; outside -1.

    Both steps are cut off to whole numbers before the row is counted from the north, so row 180 * per_degree is that of
    the South Pole's own parallel.
    """
    whole = lambda c, low: F.when(F.col(c).between(-low, low), F.floor((F.col(c) + low) * per_degree))
    x, y = whole("lon", 180), 180 * per_degree - whole("lat", 90)
    return points.withColumn("x", x).withColumn("y", y).join(cells, ["x", "y"], "left").withColumn("cls", F.coalesce("cls", F.lit(-1).cast("long")))


def describe(cells: DataFrame, names: DataFrame) -> DataFrame:
    """cells with the name of their class; names (cls, name) is a small dimension."""
    return cells.join(names, "cls", "left")


def borrow_class(cells: DataFrame, default: int) -> DataFrame:
    """Cells of the default class take that of the first of their eight neighbours, in scan order, that isn't default."""
    lone = cells.where(F.col("cls") == default).withColumn("o", F.explode(_offsets(1)))
    lone = lone.select("tile_no", F.col("x").alias("cx"), F.col("y").alias("cy"), (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"), "o.n")
    found = lone.join(cells.where(F.col("cls") != default), AT).groupBy("tile_no", F.col("cx").alias("x"), F.col("cy").alias("y")).agg(F.min_by("cls", "n").alias("near"))
    return cells.join(found, AT, "left").withColumn("cls", F.coalesce("near", "cls")).drop("near")


def face_majority(a: Column, b: Column, c: Column, centre: Column) -> Column:
    """Class of a face: that of two or three of its corners, else of its centre."""
    return F.when((a == b) | (a == c), a).when(b == c, b).otherwise(centre)


#: Cells of a block's side: a block's areas are found in one group.
SIDE = 64


def _pairs(at: np.ndarray, steps: list[tuple[int, int]]):
    """For each step the pairs (a, b) of indices into the sorted cell numbers at, b being the step away from a."""
    for dx, dy in steps:
        to = at + dy * (1 << 20) + dx
        lo, hi = np.searchsorted(at, to, "left"), np.searchsorted(at, to, "right")
        for more in range(int((hi - lo).max(initial=0))):
            a = np.flatnonzero(lo + more < hi)
            yield a, lo[a] + more


def _numbers(table: pa.Table) -> np.ndarray:
    """The number of each cell."""
    tile, x, y = (table.column(c).to_numpy().astype(np.int64) for c in AT)
    return tile * (1 << 40) + y * (1 << 20) + x


def _codes(table: pa.Table) -> np.ndarray:
    """A number from 0 for each cell's class, in the classes' order, null first."""
    return pc.rank(table.column("cls"), null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64) - 1


def _block_areas(steps: list[tuple[int, int]]):
    """Cells of one block (tile_no, bx, by, x, y, cls, more) with k: the smallest cell number of their area within the block."""

    def areas(table: pa.Table) -> pa.Table:
        out = table.drop_columns(["bx", "by"])
        if any(table.column(c).null_count for c in AT):
            return out.append_column("k", pa.nulls(len(table), pa.int64()))
        number = _numbers(table)
        order = np.argsort(number, kind="stable")
        at, cls, known = number[order], _codes(table)[order], table.column("cls").is_valid().to_numpy()[order]
        a, b = (np.concatenate(e) for e in zip(*_pairs(at, [(0, 0), *steps]), strict=True))
        same = (cls[a] == cls[b]) & known[a] & known[b]
        low = np.empty(len(at), np.int64)
        low[order] = at[roots(a[same], b[same], len(at))]
        return out.append_column("k", pa.array(low, pa.int64()))

    return areas


def _by_block(cells: DataFrame):
    """cells grouped by blocks of SIDE x SIDE."""
    return cells.withColumns({f"b{c}": F.floor(F.col(c) / SIDE) for c in "xy"}).groupBy("tile_no", "bx", "by")


def _on_rim() -> Column:
    return F.pmod("x", F.lit(SIDE)).isin(0, SIDE - 1) | F.pmod("y", F.lit(SIDE)).isin(0, SIDE - 1)


def components(cells: DataFrame, diagonal: bool = False) -> DataFrame:
    """cells with area: the smallest cell number (y * 2^20 + x, within the tile) of the touching cells of one class.

    Areas are found within blocks of SIDE x SIDE cells first, one group each; then only the cells along the blocks' sides are
    linked with those of other blocks. A null class touches nothing.
    """
    steps = [(1, 0), (0, 1)] + ([(1, 1), (1, -1)] if diagonal else [])
    schema = T.StructType([*cells.schema.fields, T.StructField("k", T.LongType())])
    found = cut(_by_block(cells).applyInArrow(_block_areas(steps), schema))
    rim = found.where(_on_rim()).select(*AT, "cls", "k")
    o = F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy")) for dx, dy in steps])
    right = rim.withColumn("o", F.explode(o)).select("tile_no", "cls", F.col("k").alias("a"), F.col("x").alias("fx"), F.col("y").alias("fy"), (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))
    # only steps into another block
    right = right.where(" or ".join(f"floor({c} / {SIDE}) <> floor(f{c} / {SIDE})" for c in "xy"))
    edges = right.join(rim.select(*AT, "cls", F.col("k").alias("b")), [*AT, "cls"]).select("a", "b")
    joined = connected_components(edges).select(F.col("node").alias("k"), "component")
    return found.join(joined, "k", "left").select(*cells.columns, F.coalesce("component", "k").alias("area"))


def focal_mode(cells: DataFrame, reach: int, only: Column | None = None) -> DataFrame:
    """Cells with mode: the commonest class of the square around them, themselves included; ties take the lowest."""
    o = F.array_append(_offsets(reach), F.struct(F.lit(0).cast("long").alias("dx"), F.lit(0).cast("long").alias("dy"), F.lit(-1).alias("n")))
    want = cells if only is None else cells.where(only)
    near = want.withColumn("o", F.explode(o)).select("tile_no", F.col("x").alias("cx"), F.col("y").alias("cy"), (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))
    votes = near.join(cells.where("cls is not null").select(*AT, "cls"), AT).groupBy("tile_no", "cx", "cy", "cls").count()
    best = votes.groupBy("tile_no", F.col("cx").alias("x"), F.col("cy").alias("y")).agg(F.min(F.struct((-F.col("count")).alias("n"), "cls"))["cls"].alias("mode"))
    return want.join(best, AT, "left")


def fill_with_mode(cells: DataFrame, reach: int = 3) -> DataFrame:
    """Null classes take the mode of the square around them."""
    holes = focal_mode(cells, reach, F.col("cls").isNull()).select(*AT, "mode")
    return cells.join(holes, AT, "left").select(*AT, F.coalesce("cls", "mode").alias("cls"))


def reclass(cells: DataFrame, rules: dict[int, int], mask: DataFrame, masked_class: int) -> DataFrame:
    """Classes mapped by rules, others kept; cells of the mask (tile_no, x, y) get masked_class."""
    new = F.col("cls")
    for old, cls in sorted(rules.items()):
        new = F.when(F.col("cls") == old, cls).otherwise(new)
    m = mask.select(*AT).distinct().withColumn("__m", F.lit(True))
    return cells.join(m, AT, "left").select(*AT, F.when(F.col("__m"), masked_class).otherwise(new).cast("long").alias("cls"))


def _block_absorbed(least: int):
    """Cells of one block (tile_no, bx, by, x, y, cls, area) with new, the class that a small area within the block takes; open: whether the
    area reaches the block's side, so that it can't be told here; near: whether the cell or one beside it is of an open area."""

    def absorbed(table: pa.Table) -> pa.Table:
        out = table.drop_columns(["bx", "by"])
        if any(table.column(c).null_count for c in AT):
            return out.append_column("new", pa.nulls(len(table), table.column("cls").type)).append_column("open", pa.array(np.zeros(len(table), bool))).append_column("near", pa.array(np.zeros(len(table), bool)))
        number = _numbers(table)
        order = np.argsort(number, kind="stable")
        at, cls = number[order], _codes(table)[order]
        names, area, size = np.unique(table.column("area").to_numpy()[order], return_inverse=True, return_counts=True)
        x, y = (table.column(c).to_numpy()[order] % SIDE for c in "xy")
        open_area = np.zeros(len(names), bool)
        open_area[area[(x == 0) | (x == SIDE - 1) | (y == 0) | (y == SIDE - 1)]] = True
        a, b = (np.concatenate(e) for e in zip(*_pairs(at, [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)]), strict=True))
        near = open_area[area]
        near[b[open_area[area[a]]]] = True
        edge = (area[a] != area[b]) & (at[a] != at[b]) & (size[area[a]] < least) & ~open_area[area[a]]
        # by area: most border first, then the lowest class
        pair, n = np.unique(np.stack([area[a[edge]], area[b[edge]], cls[b[edge]]]), axis=1, return_counts=True)
        best = pair[:, np.lexsort((pair[2], -n, pair[0]))]
        won, first = np.unique(best[0], return_index=True)
        code = np.full(len(names), -1)
        code[won] = best[2][first]
        # a cell of each class gives the class itself
        cell_of = np.empty(cls.max() + 1, np.int64)
        cell_of[cls] = order
        took = code[area]
        source, flags = np.empty(len(at), np.int64), np.empty((2, len(at)), bool)
        source[order], flags[0, order], flags[1, order] = np.where(took < 0, -1, cell_of[took]), open_area[area], near
        new = table.column("cls").take(pa.array(source, mask=source < 0))
        return out.append_column("new", new).append_column("open", pa.array(flags[0])).append_column("near", pa.array(flags[1]))

    return absorbed


def absorb_small(cells: DataFrame, thresholds: tuple[int, ...]) -> DataFrame:
    """Areas of fewer cells than each rising threshold take the class of the neighbour that they share most border with.

    All small areas of a round change at once; ties go to the lowest class. Areas within a block of SIDE x SIDE cells are settled in the
    block's group; only those that reach a block's side are joined with the cells beside them.
    """
    now = cells
    for least in thresholds:
        a = components(now)
        schema = T.StructType([*a.schema.fields, T.StructField("new", a.schema["cls"].dataType), T.StructField("open", T.BooleanType()), T.StructField("near", T.BooleanType())])
        told = cut(_by_block(a).applyInArrow(_block_absorbed(least), schema))
        wide = told.where("open")
        small = wide.groupBy("area").count().where(F.col("count") < least).select("area")
        o = F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy")) for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))])
        rim = wide.join(small, "area").withColumn("o", F.explode(o)).select("area", "tile_no", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))
        other = told.where("near").select(*AT, F.col("area").alias("area2"), F.col("cls").alias("cls2"))
        border = rim.join(other, AT).where("area <> area2").groupBy("area", "area2", "cls2").count()
        best = border.groupBy("area").agg(F.min(F.struct((-F.col("count")).alias("n"), "cls2", "area2"))["cls2"].alias("wide"))
        settled = wide.join(best, "area", "left").select(*AT, F.coalesce("wide", "cls").alias("cls"))
        now = cut(told.where("not open").select(*AT, F.coalesce("new", "cls").alias("cls")).unionByName(settled))
    return now


def class_histogram(cells: DataFrame) -> DataFrame:
    """Cells of each class by tile, with the rank of the class in its tile."""
    n = cells.groupBy("tile_no", "cls").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(W.partitionBy("tile_no").orderBy(F.desc("n"), "cls")))
