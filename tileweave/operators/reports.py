"""Tabular reports: towers, navigation aids, file logs, packing, boundary assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.functions.shared import cut


def dms(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column, usual: str, negative: bool) -> Column:
    """Arcseconds. A blank hemisphere, or none, is the usual one; `negative`: whether that one, rather than any other, turns the sign."""
    size = degrees * 3600 + minutes * 60 + seconds
    is_usual = F.coalesce(F.regexp_replace(hemisphere, r"\s", ""), F.lit("")).isin("", usual)
    return F.when(is_usual, -size if negative else size).otherwise(size if negative else -size)


def parse_towers(lines: DataFrame) -> DataFrame:
    """(id, lat_as, lon_as, ground, height, top) from pipe-separated lines; a blank hemisphere is N or W, and any other letter than N turns the latitude."""
    f = F.split("line", r"\|")
    n = lambda i: F.get(f, F.lit(i)).cast("long")
    lat, lon = dms(n(3), n(4), n(5), F.get(f, F.lit(6)), "N", False), dms(n(8), n(9), n(10), F.get(f, F.lit(11)), "W", True)
    return lines.select(n(1).alias("id"), lat.alias("lat_as"), lon.alias("lon_as"), n(13).alias("ground"), n(14).alias("height"), n(15).alias("top"))


#: (least height, class, model, base elevation offset): tall first; lower towers are short (fixed values).
TOWER_CLASSES = ((200, "tall", "radio-tall.xml", -610), (100, "medium", "radio-medium.xml", -200))


def tower_class(height: Column) -> Column:
    """Struct of class, model and base offset by height."""
    short = F.struct(F.lit("short").alias("size"), F.lit("radio-short.xml").alias("model"), F.lit(-100).alias("base"))
    out = None
    for low, size, model, base in TOWER_CLASSES:
        s = F.struct(F.lit(size).alias("size"), F.lit(model).alias("model"), F.lit(base).alias("base"))
        out = F.when(height >= low, s) if out is None else out.when(height >= low, s)
    return out.otherwise(short)


def classify_towers(towers: DataFrame) -> DataFrame:
    """towers with size, model and base elevation; short ones are left out."""
    return towers.withColumn("c", tower_class(F.col("height"))).select(*towers.columns, "c.size", "c.model", (F.col("top") + F.col("c.base")).alias("base_elev")).where("size <> 'short'")


def tower_summary(towers: DataFrame) -> DataFrame:
    """Class counts and height statistics over all rows, short ones included."""
    c = tower_class(F.col("height"))["size"]
    return towers.agg(*[F.count_if(c == s).alias(f"n_{s}") for s in ("short", "medium", "tall")], F.round(F.avg("height"), 6).alias("avg_height"), F.min("height").alias("min_height"), F.max("height").alias("max_height"))


KEY = ["id", "freq100", "lat100"]


def merge_details(master: DataFrame, detail: DataFrame) -> DataFrame:
    """master with the magvar of its detail: the last detail row of a key counts, and only the first master row takes it."""
    last = detail.groupBy(*KEY).agg(F.max_by("magvar", "line_no").alias("magvar"), F.max("line_no").alias("detail_line"))
    first = master.groupBy(*KEY).agg(F.min("line_no").alias("line_no"))
    take = first.join(last, KEY).select("line_no", *KEY, "magvar", "detail_line")
    return master.join(take, ["line_no", *KEY], "left")


def duplicate_keys(detail: DataFrame) -> DataFrame:
    """Keys that several rows have: how many, and the line that counts."""
    return detail.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("line_no").alias("last_line")).where("n > 1")


def unmatched(master: DataFrame, detail: DataFrame) -> DataFrame:
    """Detail rows without a master row, with a derived type and whether they have distance measuring."""
    kind = F.when(F.col("kind").isin("LARGE", "STANDARD"), "VOR").when(F.col("kind") == "MEDIUM", "VORTAC").otherwise("NDB")
    return detail.join(master.select(*KEY).distinct(), KEY, "left_anti").select("line_no", *KEY, kind.alias("nav_type"), (kind == "VORTAC").alias("has_dme"))


def base_name(path: Column) -> Column:
    """Last part of a path, without query."""
    return F.regexp_replace(F.regexp_replace(path, r"\?.*$", ""), r"^.*/", "")


def files_by_count(paths: DataFrame, column: str) -> DataFrame:
    """(n, n_files, first_file, last_file): how many base names occur n times."""
    per = paths.groupBy(base_name(F.col(column)).alias("file")).agg(F.count("*").alias("n"))
    return per.groupBy("n").agg(F.count("*").alias("n_files"), F.min("file").alias("first_file"), F.max("file").alias("last_file"))


def total_mb(df: DataFrame, bytes_col: str) -> DataFrame:
    """Total size in MB."""
    return df.agg(F.round(F.sum(bytes_col) / 1048576, 6).alias("total_mb"))


def _disk_starts(sizes, capacity: int):
    """(P, nxt): running sums with a zero before them, and for a disk begun at each item the item that begins the next."""
    import numpy as np

    p = np.concatenate([[0], np.cumsum(sizes)])
    k = np.arange(len(sizes))
    nxt = np.maximum(np.searchsorted(p[1:], p[:-1] + capacity, side="right"), k + 1)
    # a disk that holds nothing yet takes what is too large for it
    return p, np.minimum(np.where(p[nxt] == p[k], nxt + 1, nxt), len(sizes))


def _first_start(p, used: int, capacity: int) -> int:
    """The first item that begins a disk where `used` is taken before the first one."""
    import numpy as np

    k = int(np.searchsorted(p[1:], capacity - used, side="right"))
    return min(k + 1 if k < len(p) - 1 and used + p[k] == 0 else k, len(p) - 1)


class Step:
    """What a stretch of items does to a disk that is `used` so full before it: how full the last disk is then, and how many begin.

    over falls: a disk that is fuller than over[k], and not than over[k - 1], ends at ends[k] with begun[k] disks begun. One
    that is fuller than none begins no disk and gains total. An empty one ends at zero: it takes an item larger than a disk.
    """

    __slots__ = ("begun", "ends", "over", "total", "zero")

    def __init__(self, over, ends, begun, total, zero):
        self.over, self.ends, self.begun, self.total, self.zero = over, ends, begun, total, zero

    def after(self, used: int) -> tuple[int, int]:
        from bisect import bisect_right

        if used == 0:
            return self.zero
        k = bisect_right(self.over, -used, key=lambda v: -v)  # the first over that is less than used
        return (self.ends[k], self.begun[k]) if k < len(self.over) else (used + self.total, 0)

    def then(self, other: Step) -> Step:
        """This stretch and another after it, as one."""
        rows = []
        for over, end, begun in zip(self.over, self.ends, self.begun, strict=True):
            last, more = other.after(end)
            rows.append((over, last, begun + more))
        if not self.over or self.over[-1] >= 0:  # some disks take all of this stretch
            least = self.over[-1] if self.over else None
            for over, end, begun in zip(other.over, other.ends, other.begun, strict=True):
                here = over - self.total
                rows.append((here if least is None else min(here, least), end, begun))
        last, more = other.after(self.zero[0])
        return Step.of(rows, self.total + other.total, (last, self.zero[1] + more))

    @staticmethod
    def of(rows: list[tuple[int, int, int]], total: int, zero: tuple[int, int]) -> Step:
        """Rows (over, end, begun), falling in over, without those that no disk meets or that do what the next does."""
        kept: list[tuple[int, int, int]] = []
        for row in rows:
            if kept and kept[-1][0] < 0:
                break  # every disk has met one by now
            if kept and kept[-1][0] == row[0]:
                continue  # nothing lies between
            if kept and kept[-1][1:] == row[1:]:
                kept[-1] = row
            else:
                kept.append(row)
        return Step(*([list(x) for x in zip(*kept, strict=True)] if kept else ([], [], [])), total, zero)


def step_of(sizes, capacity: int) -> Step:
    """The step of a stretch of items of these sizes, in order."""
    import numpy as np

    p, nxt = _disk_starts(sizes, capacity)
    m = len(nxt)
    ends, begun = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for k in range(m - 1, -1, -1):
        last = nxt[k] >= m
        ends[k], begun[k] = (p[m] - p[k], 1) if last else (ends[nxt[k]], 1 + begun[nxt[k]])
    # item k begins the first disk where more than capacity - p[k + 1] is used before; beyond `reach` no disk comes so far
    reach = min(int(np.searchsorted(p[1:], capacity, side="right")) + 1, m)
    rows = [(capacity - int(p[k + 1]), int(ends[k]), int(begun[k])) for k in range(reach) if k == 0 or p[k + 1] > p[k]]
    first = _first_start(p, 0, capacity)
    return Step.of(rows, int(p[m]), (int(p[m]), 0) if first >= m else (int(ends[first]), int(begun[first])))


_STEP = "b long, over array<bigint>, ends array<bigint>, begun array<bigint>, total long, zero_end long, zero_begun long"


def _step_table(rows: list[tuple], g, kind):
    import pyarrow as pa

    ints = pa.list_(pa.int64())
    cols = [[*x] for x in zip(*[(b, s.over, s.ends, s.begun, s.total, *s.zero) for b, s in rows], strict=True)]
    kinds = (pa.int64(), ints, ints, ints, pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array([g] * len(rows), kind), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["g", "b", "over", "ends", "begun", "total", "zero_end", "zero_begun"])


def _steps_in(t) -> list[tuple[int, Step]]:
    """(b, step) of a table's rows, by b."""
    rows = zip(*[t[c].to_pylist() for c in ("b", "over", "ends", "begun", "total", "zero_end", "zero_begun")], strict=True)
    return sorted(((b, Step(over, ends, begun, total, (ze, zb))) for b, over, ends, begun, total, ze, zb in rows), key=lambda x: x[0])


def next_fit(items: DataFrame, group: str, order: str, size: str, capacity: int, reserve: int = 0, block_rows: int = 100_000, fan: int = 64) -> DataFrame:
    """items (group, order, size) with disk (from 0) and used: the next disk is begun when an item doesn't fit.

    Items go in a fixed order for each group, ties by size. An item larger than a disk has one of its own; the first disk
    starts with `reserve` used; a null size counts 0. Rows are sorted into blocks of about `block_rows`, ties included. A
    block is a step function of how full the disk is before it (Step), whose steps are those of the items that one disk holds.
    Steps of up to `fan` neighbouring blocks are composed to one, in rounds, until a group has one; then, from the top down,
    every block learns how full its disk is at its beginning, and is packed from there. So no task holds more than a block's
    rows or `fan` steps, however large a group is.
    """
    kinds = dict(items.dtypes)
    kind = kinds[group]
    it = items.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("s"))
    n = max(1, -(-it.count() // block_rows))
    tie = it.withColumn("t", F.monotonically_increasing_id())
    dealt = cut(tie.repartitionByRange(n, "g", "o", "s", "t").select("g", "o", "s", F.spark_partition_id().cast("long").alias("b")))

    def steps(t):
        t = t.combine_chunks().sort_by([("o", "ascending"), ("s", "ascending")])
        return _step_table([(t["b"][0].as_py(), step_of(t["s"].to_numpy(), capacity))], t["g"][0].as_py(), t.schema.field("g").type)

    def compose(t):
        rows = _steps_in(t)
        whole = rows[0][1]
        for _, s in rows[1:]:
            whole = whole.then(s)
        return _step_table([(rows[0][0] // fan, whole)], t["g"][0].as_py(), t.schema.field("g").type)

    def descend(t):
        import pyarrow as pa

        used, disk, out = t["u0"][0].as_py(), t["d0"][0].as_py(), []
        for b, s in _steps_in(t):
            out.append((b, used, disk))
            used, more = s.after(used)
            disk += more
        a = list(zip(*out, strict=True))
        return pa.table([pa.array([t["g"][0].as_py()] * len(out), t.schema.field("g").type), *[pa.array(x, pa.int64()) for x in a]], names=["g", "b", "u0", "d0"])

    def packed(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks().sort_by([("o", "ascending"), ("s", "ascending")])
        p, nxt = _disk_starts(t["s"].to_numpy(), capacity)
        m, used = len(nxt), t["u0"][0].as_py()
        at, starts = _first_start(p, used, capacity), []
        while at < m:
            starts.append(at)
            at = int(nxt[at])
        begun = np.zeros(m, np.int64)
        begun[starts] = 1
        c = np.cumsum(begun)
        base = np.concatenate([[-used], p[starts]])[c]
        return pa.table([t["g"], t["o"], t["s"], pa.array((t["d0"][0].as_py() + c).astype(np.int32)), pa.array(p[1:] - base)], names=["g", "o", "s", "disk", "used"])

    def entered(df: DataFrame, starts: DataFrame, of: Column) -> DataFrame:
        """df with u0 and d0 of its group's block `of`."""
        e = starts.select(F.col("g").alias("eg"), F.col("b").alias("eb"), "u0", "d0")
        return df.withColumn("up", of).join(e, F.col("g").eqNullSafe(F.col("eg")) & (F.col("up") == F.col("eb"))).drop("eg", "eb")

    levels = [cut(dealt.groupBy("g", "b").applyInArrow(steps, f"g {kind}, {_STEP}"))]
    parent = F.floor(F.col("b") / fan)
    while n > 1:
        levels.append(cut(levels[-1].withColumn("up", parent).groupBy("g", "up").applyInArrow(compose, f"g {kind}, {_STEP}")))
        n = -(-n // fan)
    starts = levels[-1].select("g", "b", F.lit(reserve).cast("long").alias("u0"), F.lit(0).cast("long").alias("d0"))
    for level in reversed(levels[:-1]):
        starts = cut(entered(level, starts, parent).groupBy("g", "up").applyInArrow(descend, f"g {kind}, b long, u0 long, d0 long"))
    both = entered(dealt, starts, F.col("b")).select("g", "b", "o", "s", "u0", "d0")
    out = both.groupBy("g", "b").applyInArrow(packed, f"g {kinds[group]}, o {kinds[order]}, s long, disk int, used long")
    return out.select(F.col("g").alias(group), F.col("o").alias(order), F.col("s").alias(size), "disk", "used")


def parse_chunk_name(name: Column) -> Column:
    """Struct (lon, lat, map_x, map_y) of a chunk name such as w130n30; the map has its origin at the north-west."""
    lon = F.regexp_extract(name, r"([ew])(\d{3})([ns])(\d{2})", 2).cast("int") * F.when(F.regexp_extract(name, r"([ew])(\d{3})", 1) == "w", -1).otherwise(1)
    lat = F.regexp_extract(name, r"([ew])(\d{3})([ns])(\d{2})", 4).cast("int") * F.when(F.regexp_extract(name, r"([ns])(\d{2})", 1) == "s", -1).otherwise(1)
    return F.struct(lon.alias("lon"), lat.alias("lat"), ((lon + 180) * 2).alias("map_x"), ((90 - lat) * 2).alias("map_y"))


def age_class(ts: Column, now: Column) -> Column:
    """fresh under 7 days, recent under 14, else old."""
    days = (F.unix_seconds(now) - F.unix_seconds(ts)) / 86400
    return F.when(days < 7, "fresh").when(days < 14, "recent").otherwise("old")


def sexagesimal_radians(text: Column, hours: bool) -> Column:
    """Radians from 'a b c' (hours or degrees, minutes, seconds); minutes and seconds take the sign of the first part."""
    p = F.split(text, " ")
    n = lambda i: F.abs(F.get(p, F.lit(i)).cast("double"))
    sign = F.when(text.startswith("-"), -1.0).otherwise(1.0)
    return F.radians(sign * (n(0) + n(1) / 60 + n(2) / 3600) * (15.0 if hours else 1.0))


def assemble_boundaries(parents: DataFrame, segments: DataFrame, key: str, seg: str, where: Column) -> DataFrame:
    """Segments of the parents that satisfy `where`, with the parents' attributes and numbered within each boundary."""
    chosen = parents.where(where).dropDuplicates([key])
    return segments.join(chosen, key).withColumn("seg_no", F.row_number().over(W.partitionBy(key).orderBy(seg)) - 1)


def tile_runs(points: DataFrame, line: str, seq: str, tile: Column) -> DataFrame:
    """(line, run, tile, first_seq, last_seq): runs of steps of a chain whose midpoint is in one tile."""
    w = W.partitionBy(line).orderBy(seq)
    steps = points.withColumn("__tile", tile).where(F.col("__tile").isNotNull())
    runs = steps.withColumn("run", F.sum(F.when(F.lag("__tile").over(w).eqNullSafe(F.col("__tile")), 0).otherwise(1)).over(w) - 1)
    return runs.groupBy(line, "run").agg(F.first("__tile").alias("tile"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


def letter_counters(df: DataFrame, column: str, letters: str, default: str) -> DataFrame:
    """Counts of each letter; other values count as the default letter."""
    known = F.when(F.col(column).isin(*letters), F.col(column)).otherwise(default)
    return df.agg(*[F.count_if(known == x).alias(f"n_{x.lower()}") for x in letters])


def flag_counters(df: DataFrame, column: str, flags: str) -> DataFrame:
    """How many rows have each flag letter in a text of flags."""
    return df.agg(*[F.count_if(F.instr(F.col(column), x) > 0).alias(f"has_{x.lower()}") for x in flags])


def pivot_first(df: DataFrame, keys: list[str], kind: str, kinds: list, value: str) -> DataFrame:
    """One row for each key with a column for each kind: the smallest value of it."""
    return df.groupBy(*keys).pivot(kind, kinds).agg(F.min(value))
