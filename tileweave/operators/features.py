"""Feature selection, projection and classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Classes that aren't features (fixed values), and the priority of unknown names.
REJECTED, UNKNOWN_PRIORITY = ("Ocean", "Void", "Null"), 65535


def where_attr(df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which a SQL predicate over attributes holds; pushed to the scan where the source can."""
    return df.where(F.expr(predicate))


def where_bbox(df: DataFrame, rect: tuple[int, int, int, int]) -> DataFrame:
    """Rows whose box (min_x, min_y, max_x, max_y) meets rect (west, south, east, north)."""
    w, s, e, n = rect
    return df.where((F.col("max_x") >= w) & (F.col("min_x") <= e) & (F.col("max_y") >= s) & (F.col("min_y") <= n))


def skip_records(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows from the n-th (from 0) in the order of a unique column; an error if there are no more than n rows.

    The n-th value is found by its quantile range instead of numbering all rows in one task: rows are counted for each
    of some ranges of the column, and only the range that holds the n-th row is ranked.
    """
    total = df.count()
    if n >= total:
        raise ValueError(f"start record {n} of {total}")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    width = (hi - lo) // 1024 + 1
    counts = sorted((r["b"], r["count"]) for r in df.groupBy(F.floor((F.col(order) - lo) / width).alias("b")).count().collect())
    before = 0
    for b, c in counts:
        if before + c > n:
            inside = df.where(F.floor((F.col(order) - lo) / width) == b).select(order)
            first = inside.orderBy(order).limit(n - before + 1).agg(F.max(order)).first()[0]
            return df.where(F.col(order) >= first)
        before += c
    raise AssertionError


def area_type(df: DataFrame, column: str | None, constant: str) -> DataFrame:
    """df with area_type: the row's own, or a constant where it has none."""
    return df.withColumn("area_type", F.coalesce(F.col(column), F.lit(constant)) if column else F.lit(constant))


def reject_classes(df: DataFrame, column: str, rejected: tuple[str, ...] = REJECTED) -> DataFrame:
    """Rows whose class isn't one of the rejected; null classes go too."""
    return df.where(~F.col(column).isin(*rejected))


def width_or_default(width: Column, default: int) -> Column:
    """width, or default where it is zero or missing."""
    return F.when(width.isNull() | (width == 0), F.lit(default)).otherwise(width)


def split_bad(df: DataFrame, bad: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows; strict: the first bad row raises when the good ones are read."""
    flag = F.coalesce(bad, F.lit(True))
    if strict:
        return df.where(F.when(flag, F.raise_error(F.lit("unsupported geometry")).cast("boolean")).otherwise(F.lit(True))), df.where(flag)
    return df.where(~flag), df.where(flag)


def explode_parts(df: DataFrame, parts: str) -> DataFrame:
    """One row for each part of a multi-geometry, with its number."""
    return df.select(*[c for c in df.columns if c != parts], F.posexplode(parts).alias("part_no", "part"))


def with_priority(df: DataFrame, areas: DataFrame, material: str = "material") -> DataFrame:
    """df with priority and category of its material; unknown names get the last priority. areas is a small dimension."""
    dim = areas.select(F.col("name").alias(material), "priority", "category")
    return df.join(dim, material, "left").withColumn("priority", F.coalesce("priority", F.lit(UNKNOWN_PRIORITY)))


def classify(df: DataFrame, rules: list[tuple[str, str]], default: str | None = None, out: str = "layer") -> DataFrame:
    """df with the layer of the first rule (predicate, layer) that holds."""
    col = F.lit(None).cast("string")
    for i, (predicate, layer) in enumerate(rules):
        col = F.when(F.expr(predicate), layer) if i == 0 else col.when(F.expr(predicate), layer)
    return df.withColumn(out, col.otherwise(F.lit(default)) if rules else F.lit(default))


def map_codes(df: DataFrame, names: DataFrame, code: str, out: str = "layer") -> DataFrame:
    """df with the name of its code; names (code, name) is a small dimension, unknown codes give null."""
    return df.join(names.select(F.col("code").alias(code), F.col("name").alias(out)), code, "left")


def categories(df: DataFrame, column: str) -> DataFrame:
    """Distinct categories with the number of rows that an extract of each would have."""
    return df.groupBy(column).count().withColumnRenamed("count", "n_rows")


def extract_categories(df: DataFrame, column: str, path: str) -> None:
    """Write one extract for each category, as partitions of one dataset."""
    df.repartition(column).write.partitionBy(column).mode("overwrite").parquet(path)


#: Metres of the sphere's radius in web-Mercator (fixed value).
MERCATOR_RADIUS = 6378137.0


def to_wgs84(df: DataFrame, x: str, y: str, source: str = "mercator") -> DataFrame:
    """df with lon and lat in degrees from projected metres: web-Mercator, or plate carree."""
    lon = F.degrees(F.col(x) / MERCATOR_RADIUS)
    lat = {"mercator": F.degrees(2 * F.atan(F.exp(F.col(y) / MERCATOR_RADIUS)) - F.lit(3.141592653589793) / 2), "plate_carree": F.degrees(F.col(y) / MERCATOR_RADIUS)}[source]
    return df.withColumn("lon", lon).withColumn("lat", lat)


def number(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """df numbered from 0 within groups."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1)
