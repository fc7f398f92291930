"""Operator 5: shards from sampled splitters.

Keys are drawn with probability in proportion to their rows' size; quantiles of the sample cut the key order into
fine ranges, ranges that turn out overfull are cut again by row, and consecutive ranges fill the shards to near equal
bytes. The order is (hash of the text, doc_id, size): equal texts are neighbours, so they share a shard unless the
group itself holds over half of a shard's bytes and rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tileweave.llm.common import cut, texts


def _spread(*cols: str) -> Column:
    """A number in [0, 1) from the hash of cols."""
    return (F.xxhash64(*cols).bitwiseAND((1 << 52) - 1)) / float(1 << 52)


def _range_of(key: Column, splitters: np.ndarray) -> Column:
    """Index of the range that key falls into: how many splitters are at or below it."""

    @F.pandas_udf("long")
    def at(k):
        import pandas as pd

        return pd.Series(np.searchsorted(splitters, k.to_numpy(), side="right"))

    return at(key)


def range_shards(rows: DataFrame, n_shards: int, ranges_per_shard: int = 64, draws_per_range: int = 24, rows_per_range: int = 2_000_000) -> DataFrame:
    """rows (key long, tie, uid long, size long >= 1, more) with shard int and slot long: near equal bytes in key order.

    tie: what orders the rows of a key; uid: any number that tells rows apart. A row's load is its share of all bytes and
    its share of all rows; ranges_per_shard fine ranges a shard, or more where a range would pass rows_per_range rows, hold
    near equal loads, so no task sorts more than a few times rows_per_range. The driver keeps the splitters and one sum for
    each range and piece, a number that grows with rows / rows_per_range. The rows of a key stay together, but for a hot key: one
    with over half of a shard's load, by bytes and rows together, or over rows_per_range rows. It is cut into pieces by a hash
    of tie and uid, so it spreads over tasks and shards.
    """
    stats = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n, total = stats["n"], stats["bytes"]
    if not n:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    pieced = _pieces(rows, n, total, max(n_shards * ranges_per_shard, math.ceil(n / rows_per_range)), draws_per_range, n_shards, rows_per_range)
    sums = pieced.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas().sort_values(["range", "piece"])
    ends = sums["bytes"].cumsum().to_numpy()
    shard = np.minimum((ends - sums["bytes"].to_numpy() / 2) * n_shards // total, n_shards - 1).astype(int)
    sums["shard"] = shard
    sums["first"] = sums.groupby("shard")["rows"].cumsum() - sums["rows"]
    place = rows.sparkSession.createDataFrame([(int(a), int(b), int(c), int(d)) for a, b, c, d in sums[["range", "piece", "shard", "first"]].itertuples(index=False)], "range long, piece int, shard int, first long")
    order = W.partitionBy("range", "piece").orderBy("key", "tie", "size", "uid")
    return pieced.withColumn("rank", F.row_number().over(order)).join(place, ["range", "piece"]).withColumn("slot", F.col("first") + F.col("rank") - 1).drop("range", "piece", "rank", "first")


def _pieces(rows: DataFrame, n: int, total: int, n_ranges: int, draws_per_range: int, n_shards: int, rows_per_range: int) -> DataFrame:
    """rows with range and piece (0: not cut), in key order by both; n and total: their number and bytes."""
    spark = rows.sparkSession
    share = 2 / n_ranges  # loads add up to 2
    load = F.col("size") / total + 1 / n
    weight = load * (n_ranges * draws_per_range / 2)
    drawn = rows.where(_spread("key", "tie", "size", "uid") < F.least(F.lit(1.0), weight)).select("key", F.greatest(F.lit(1.0), weight).alias("w"))
    sample = drawn.groupBy("key").agg(F.sum("w").alias("w")).toPandas().sort_values("key")
    at = np.interp(np.linspace(0, 1, n_ranges + 1)[1:-1], np.cumsum(sample["w"]) / max(sample["w"].sum(), 1e-9), np.arange(len(sample))) if len(sample) else []
    splitters = np.unique(sample["key"].to_numpy(np.int64)[np.ceil(at).astype(int)]) if len(sample) else np.array([], np.int64)
    ranged = rows.withColumn("range", _range_of(F.col("key"), splitters))
    full = [r["range"] for r in ranged.groupBy("range").agg(F.sum(load).alias("load")).where(F.col("load") > 2 * share).collect()]
    # in an overfull range, the rows of a hot key are cut into pieces of a range's share; there are fewer such keys than
    # two a shard and ranges
    hot = []
    if full:
        keys = ranged.where(F.col("range").isin(full)).groupBy("range", "key").agg(F.sum(load).alias("load"), F.count("*").alias("rows"))
        hot = keys.where((F.col("load") > max(share, 1 / n_shards)) | ((F.col("rows") > rows_per_range) & (F.col("load") > share))).collect()
    cuts = spark.createDataFrame([(int(r["range"]), int(r["key"]), math.ceil(r["load"] / share)) for r in hot], "range long, key long, pieces int")
    return ranged.join(cuts, ["range", "key"], "left").withColumn("piece", F.coalesce(1 + F.floor(_spread("tie", "uid") * F.col("pieces")), F.lit(0)).cast("int")).drop("pieces")


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text", text_out: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard (and text if text_out).

    size: UTF-8 bytes of the text plus 1; law `bytes`: the shards' sizes are near equal. slot runs gapless from 0 in
    each shard. Ids may have any type that sorts. A null text has size 1 and the crc32 of nothing, and stays null with
    text_out; a null doc_id sorts first and stays null; repeated rows each get a slot; an empty table gives an empty
    result. The digest table that the passes read is written once; text_out shuffles each different text once.
    """
    t = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    same = [F.xxhash64(t).alias("key"), F.xxhash64(F.col("doc_id"), F.col("text"), F.col("text").isNull()).alias("row"), F.crc32(t).alias("text_crc32")]
    source = texts(docs, id_col, text_col)
    rows = cut(source.select("doc_id", F.col("doc_id").alias("tie"), (F.octet_length(t) + 1).cast("long").alias("size"), *same, F.monotonically_increasing_id().alias("uid")))
    placed = range_shards(rows, n_shards)
    if text_out:
        # rows alike in id and text share the hashes, so each finds its own text
        found = source.select("text", *same).groupBy("key", "row", "text_crc32").agg(F.first("text").alias("text"))
        placed = placed.join(found, ["key", "row", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), *["text"] * text_out)


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write doc_id, slot and text of every row, as shard_documents places it, as one folder for each shard, several files each."""
    shard_documents(docs, n_shards, id_col, text_col, text_out=True).drop("law", "grown_shard").write.partitionBy("shard").parquet(path)
