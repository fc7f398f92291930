"""Hierarchical records: lines (line_no, txt) with a code first; headers start groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.functions.geo import bearing, haversine, tile_id

#: Codes of headers and of the end mark (fixed values).
HEADERS, END = (1, 16, 17), 99
#: Codes of nodes that go on, that close a ring, and that end a line (fixed values).
GO_ON, CLOSES, ENDS = (111, 112), (113, 114), (115, 116)


def parse_lines(lines: DataFrame) -> DataFrame:
    """(line_no, code, f ARRAY) without comments and blank lines."""
    t = F.trim("txt")
    return lines.where((t != "") & ~t.startswith("#")).select("line_no", F.split(t, r"\s+").alias("f")).select("line_no", F.get("f", F.lit(0)).cast("int").alias("code"), "f")


def assign_groups(records: DataFrame, block: int = 100_000) -> DataFrame:
    """records with grp: the line of the header before; lines before any header and from the end mark on are left out.

    Lines are dealt to blocks by number. Each block finds the last header within it by a window; what a block starts
    with is the last header of the blocks before, a running maximum over one row for each block.
    """
    head = F.when(F.col("code").isin(*HEADERS), F.col("line_no"))
    r = records.withColumn("__b", F.floor(F.col("line_no") / block))
    tops = r.groupBy("__b").agg(F.max(head).alias("t"), F.min(F.when(F.col("code") == END, F.col("line_no"))).alias("e"))
    w = W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select("__b", F.max("t").over(w).alias("__before"), F.min("e").over(w).alias("__ended"), F.col("e").alias("__own_end"))
    own = F.max(head).over(W.partitionBy("__b").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0))
    g = r.withColumn("grp", own).join(tops, "__b").withColumn("grp", F.coalesce("grp", "__before"))
    live = F.col("__ended").isNull() & (F.col("__own_end").isNull() | (F.col("line_no") < F.col("__own_end")))
    return g.where(live & F.col("grp").isNotNull()).drop("__b", "__before", "__ended", "__own_end")


def header_fields(groups: DataFrame) -> DataFrame:
    """(grp, kind, alt_m, ident, name) of header lines; feet become metres."""
    f = lambda i: F.get("f", F.lit(i))
    kind = F.when(F.col("code") == 1, "land").when(F.col("code") == 16, "water").otherwise("heli")
    return groups.where(F.col("code").isin(*HEADERS)).select("grp", kind.alias("kind"), F.round(f(1).cast("double") * 0.3048, 6).alias("alt_m"), f(4).alias("ident"), F.array_join(F.slice("f", 6, F.greatest(F.size("f") - 5, F.lit(0))), " ").alias("name"))


def runway_fields(groups: DataFrame) -> DataFrame:
    """(grp, line_no, width, surface, lat1, lon1, lat2, lon2) of runway lines; coordinates in arcseconds."""
    f = lambda i, n: F.get("f", F.lit(i)).cast("long").alias(n)
    return groups.where("code = 100").select("grp", "line_no", *[f(i, n) for i, n in enumerate(("width", "surface", "lat1", "lon1", "lat2", "lon2"), 1)])


def groups_in_bbox(runways: DataFrame, w: int, s: int, e: int, n: int) -> DataFrame:
    """Groups with an end of a runway in a rectangle."""
    inside = lambda k: F.col(f"lon{k}").between(w, e) & F.col(f"lat{k}").between(s, n)
    return runways.groupBy("grp").agg(F.bool_or(inside(1) | inside(2)).alias("k")).where("k").select("grp")


def select_groups(headers: DataFrame, wanted: list[str] | None, excluded: list[str]) -> DataFrame:
    """Headers of the wanted ids (None: all) that aren't excluded."""
    out = headers if wanted is None else headers.where(F.col("ident").isin(*wanted))
    return out.where(~F.col("ident").isin(*excluded)) if excluded else out


def group_summary(groups: DataFrame, codes: dict[int, str]) -> DataFrame:
    """(grp, a count for each named code)."""
    return groups.groupBy("grp").agg(*[F.count_if(F.col("code") == c).alias(n) for c, n in codes.items()])


def group_centres(runways: DataFrame, pads: DataFrame | None = None) -> DataFrame:
    """(grp, lon_as, lat_as, tile): mean of the runways' middles and of the pads (grp, lon, lat); groups without either are left out."""
    places = runways.select("grp", *[((F.col(f"{c}1") + F.col(f"{c}2")) / 2).alias(c) for c in ("lon", "lat")])
    if pads is not None:
        places = places.unionByName(pads.select("grp", *[F.col(c).cast("double").alias(c) for c in ("lon", "lat")]))
    c = places.groupBy("grp").agg(*[F.floor(F.avg(c)).cast("long").alias(f"{c}_as") for c in ("lon", "lat")])
    return c.withColumn("tile", tile_id(F.col("lon_as"), F.col("lat_as")))


def pad_fields(groups: DataFrame) -> DataFrame:
    """(grp, line_no, lat, lon) of helipad lines (code 102); coordinates in arcseconds."""
    f = lambda i, n: F.get("f", F.lit(i)).cast("long").alias(n)
    return groups.where("code = 102").select("grp", "line_no", f(2, "lat"), f(3, "lon"))


def node_rings(records: DataFrame) -> DataFrame:
    """(grp, ring, seq, line_no, code) of node lines in rings: a terminator ends one; one without nodes is left out."""
    nodes = records.where(F.col("code").isin(*GO_ON, *CLOSES, *ENDS))
    w = W.partitionBy("grp").orderBy("line_no")
    done = F.col("code").isin(*CLOSES, *ENDS).cast("int")
    r = nodes.withColumn("ring", F.coalesce(F.sum(done).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    k = W.partitionBy("grp", "ring")
    r = r.withColumn("seq", F.row_number().over(k.orderBy("line_no")) - 1).withColumn("__n", F.count("*").over(k))
    return r.where("__n > 1").select("grp", "ring", "seq", "line_no", "code")


def surface_material(df: DataFrame, surfaces: DataFrame, strict: bool = True) -> DataFrame:
    """df with the material of its surface code; an unknown one raises when read, or gives null."""
    j = df.join(surfaces, "surface", "left")
    return j.withColumn("material", F.coalesce("material", F.raise_error(F.lit("unknown surface")).cast("string"))) if strict else j


def heading_and_length(runways: DataFrame) -> DataFrame:
    """runways with heading in degrees and length in metres, on the sphere."""
    d = [F.col(c) / 3600 for c in ("lon1", "lat1", "lon2", "lat2")]
    return runways.withColumn("heading", F.round(bearing(*d), 4)).withColumn("length", F.round(haversine(*d), 3))


def _last(holds, guess: Column, lo: int, hi: Column) -> Column:
    """The last k from lo to hi for which holds(k), true up to some k and false from there on; lo - 1 if none. guess is at most one off."""
    g = F.coalesce(F.least(F.greatest(F.floor(guess), F.lit(lo - 1)), hi), F.lit(lo - 1)).cast("int")
    return F.when((g + 1 <= hi) & holds(g + 1), g + 1).when((g >= lo) & holds(g), g).otherwise(F.greatest(g - 1, F.lit(lo - 1)))


def _runs(*runs: tuple[str, Column, Column, int]) -> Column:
    """Runs (colour, first, last, by) as an array of those that hold a light, last being one."""
    out = [F.struct(F.lit(c).alias("colour"), lo.cast("int").alias("first"), (hi - F.pmod(hi - lo, F.lit(by))).cast("int").alias("last"), F.lit(by).alias("by")) for c, lo, hi, by in runs]
    return F.filter(F.array(*out), lambda r: r["first"] <= r["last"])


def edge_light_runs(runways: DataFrame, spacing: float = 60.0, caution: float = 610.0) -> DataFrame:
    """(line_no, side, colour, first, last, to_m, step, origin, back): lights of edge_lights at equal steps, k from first to last, as one row."""
    zero, one = F.lit(0.0), F.lit(1)
    r = runways.withColumn("__a", F.col("before") if "before" in runways.columns else zero).withColumn("__b", F.col("beyond") if "beyond" in runways.columns else zero)
    r = r.withColumn("__d", F.col("length") - F.col("__a") - F.col("__b")).withColumn("__n", F.floor(F.col("__d") / spacing).cast("int") + 1).withColumn("step", F.try_divide(F.col("__d"), F.col("__n")))
    d, n, s = F.col("__d"), F.col("__n"), F.col("step")
    extra = lambda c: F.when(F.col(c) > s, F.floor(F.try_divide(F.col(c), s))).otherwise(0).cast("int")
    r = r.withColumn("__limit", F.least(F.lit(caution), F.col("length") / 2))
    until = lambda limit: _last(lambda k: d - k * s > limit, F.try_divide(d - limit, s), 1, n)
    r = r.withColumn("__white", until(F.col("__limit"))).withColumn("__yellow", F.greatest("__white", until(F.lit(5.0))))
    w, y = F.col("__white"), F.col("__yellow")
    runs = _runs(("red", -extra("__a"), -one, 1), ("white", one, w, 1), ("yellow", w + 1, y, 1), ("yellow", F.greatest(n, F.lit(0)) + 1, n + extra("__b"), 1))
    l = r.where(n.isNotNull()).withColumn("__r", F.explode(runs)).withColumn("side", F.explode(F.array(F.lit(-1), F.lit(1))))  # noqa: E741
    # beyond the threshold the first light stands where the last step ended
    back = F.when(F.col("__r.first") > n, 1).otherwise(0)
    return l.select("line_no", "side", "__r.colour", "__r.first", "__r.last", (F.col("__a") + (F.col("__r.last") - back) * s).alias("to_m"), "step", F.col("__a").alias("origin"), back.alias("back"))


def edge_lights(runways: DataFrame, spacing: float = 60.0, caution: float = 610.0) -> DataFrame:
    """(line_no, k, side, along, colour): lights along both edges of runways (length; before, beyond: displaced thresholds or none).

    Between the thresholds int(length / spacing) + 1 equal steps have a light each at their end: white while more than
    `caution` or half the whole length is left, else yellow, and none in the last 5 m. Before a displaced threshold red ones
    go back from it by the same step (k < 0), beyond the far one yellow ones go on from the last place.
    """
    l = edge_light_runs(runways, spacing, caution).withColumn("k", F.explode(F.sequence("first", "last")))  # noqa: E741
    return l.select("line_no", "k", "side", (F.col("origin") + (F.col("k") - F.col("back")) * F.col("step")).alias("along"), "colour")


def centre_light_runs(runways: DataFrame, spacing: float = 15.0) -> DataFrame:
    """(line_no, colour, first, last, by, to_m, origin, step): lights of centre_lights, each `by`-th k from first to last, as one row."""
    before = F.col("before") if "before" in runways.columns else F.lit(0.0)
    r = runways.withColumn("origin", F.coalesce(before, F.lit(0.0))).withColumn("__l", F.col("length") - F.col("origin")).where("__l > 0")
    r = r.withColumn("__n", F.floor(F.col("__l") / spacing).cast("int") + 1).withColumn("step", F.col("__l") / F.col("__n"))
    left, step, end = F.col("__l"), F.col("step"), F.col("__n") - 1
    until = lambda holds, limit: _last(lambda k: holds(left - k * step), (left - limit) / step, 0, end)
    r = r.withColumn("__far", until(lambda rest: rest > 900, 900)).withColumn("__mid", until(lambda rest: rest > 300, 300))
    far, mid = F.col("__far"), F.col("__mid")
    l = r.withColumn("__r", F.explode(_runs(("white", F.lit(0), far, 1), ("white", far + 1, mid, 2), ("red", far + 2, mid, 2), ("red", mid + 1, end, 1))))  # noqa: E741
    return l.select("line_no", "__r.*", (F.col("origin") + F.col("__r.last") * step).alias("to_m"), "origin", "step")


def centre_lights(runways: DataFrame, spacing: float = 15.0) -> DataFrame:
    """(line_no, k, along, colour): lights along the middle of runways (length; before: a displaced threshold or none).

    From the displaced threshold to the far end, there is a light at the start of each of int(distance / spacing) + 1 equal
    steps: white while over 900 m are left; then white and red take turns, white first; red in the last 300 m.
    """
    l = centre_light_runs(runways, spacing).withColumn("k", F.explode(F.sequence("first", "last", "by")))  # noqa: E741
    return l.select("line_no", "k", (F.col("origin") + F.col("k") * F.col("step")).alias("along"), "colour")


def buoys(rects: DataFrame, spacing: float = 100.0) -> DataFrame:
    """(id, edge, k, x, y): int(side / spacing) places at equal steps along each side of rectangles (id, corner, cx, cy), from its end of the first step on."""
    w = W.partitionBy("id").orderBy("corner")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    e = rects.withColumns({f"n_{c}": F.coalesce(F.lead(c).over(w), F.first(c).over(whole)) for c in ("cx", "cy")})
    d = F.sqrt(F.pow(F.col("n_cx") - F.col("cx"), 2) + F.pow(F.col("n_cy") - F.col("cy"), 2))
    e = e.withColumn("__n", F.floor(d / spacing).cast("int")).where("__n > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    at = lambda c: F.col(c) + (F.col(f"n_{c}") - F.col(c)) * F.col("k") / F.col("__n")
    return e.select("id", F.col("corner").alias("edge"), "k", at("cx").alias("x"), at("cy").alias("y"))


def emit_objects(parts: dict[str, DataFrame], models: dict[str, str]) -> DataFrame:
    """(kind, model, x, y, z) of all parts (x, y, z) together."""
    out = None
    for kind, df in sorted(parts.items()):
        p = df.select(F.lit(kind).alias("kind"), F.lit(models[kind]).alias("model"), "x", "y", "z")
        out = p if out is None else out.unionByName(p)
    return out


def code_runs(chain: DataFrame, line: str, code: str) -> DataFrame:
    """(line, run, code, first_seq, last_seq) of equal codes in a row; code 0 is none."""
    w = W.partitionBy(line).orderBy("seq")
    r = chain.withColumn("run", F.sum(F.when(F.lag(code).over(w) == F.col(code), 0).otherwise(1)).over(w) - 1)
    return r.where(F.col(code) != 0).groupBy(line, "run").agg(F.first(code).alias(code), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def spaced_points(points: DataFrame, spacing: int, series: int = 1) -> DataFrame:
    """(line_id, k, x, y, series): places at equal steps along polylines, the rest of a step carried over vertices."""
    w = W.partitionBy("line_id").orderBy("seq")
    p = points.withColumns({"nx": F.lead("x").over(w), "ny": F.lead("y").over(w)})
    p = p.withColumn("d", F.coalesce(F.sqrt((F.pow(F.col("nx") - F.col("x"), 2) + F.pow(F.col("ny") - F.col("y"), 2)).cast("double")), F.lit(0.0))).withColumn("end", F.sum("d").over(w)).withColumn("start", F.col("end") - F.col("d"))
    lo, hi = F.ceil(F.col("start") / spacing).cast("long"), (F.ceil(F.col("end") / spacing) - 1).cast("long")
    s = p.where((F.col("d") > 0) & (lo <= hi)).withColumn("k", F.explode(F.sequence(lo, hi)))
    t = (F.col("k") * spacing - F.col("start")) / F.col("d")
    return s.select("line_id", "k", F.round(F.col("x") + t * (F.col("nx") - F.col("x")), 3).alias("x"), F.round(F.col("y") + t * (F.col("ny") - F.col("y")), 3).alias("y"), (F.col("k") % series).alias("series"))
