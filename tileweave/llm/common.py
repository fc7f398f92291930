"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileweave.functions.shared import cut, drop, shared_dir

__all__ = ["cut", "crc_of_id", "drop", "map_texts", "row_hash", "sampled_ids", "shared_dir", "texts"]

#: Rows handed to Python code at once; texts may be long, so few.
SLICE = 256


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(doc_id, text, more): the only columns that an operator reads, so others can't clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c) for c in more])


def map_texts(df: DataFrame, each: Callable[[list], list[list]], schema: str, *carry: str) -> DataFrame:
    """mapInArrow over (doc_id, text, carry): each(texts) gives the columns of schema, which follow doc_id and carry.

    A null text counts as ''.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = each([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)], names=names)

    kinds = dict(df.dtypes)
    names = ["doc_id", *carry, *(x.strip().split(" ")[0] for x in schema.split(", "))]
    return df.select("doc_id", "text", *carry).mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in ("doc_id", *carry)), schema]))


def row_hash(df: DataFrame) -> Column:
    """A hash of all of a row's columns, but for maps, which Spark doesn't hash."""
    return F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def sampled_ids(labels: DataFrame, wanted: dict[int, int], label: str) -> DataFrame:
    """(doc_id, label): about wanted[v] rows of each label v, picked by a hash of doc_id; at most twice that many in all.

    The bound makes the result small enough to broadcast, whatever the size of labels.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.where(F.col("label").isin(list(wanted))).groupBy("label").count().collect()}
    pick = F.lit(False)
    for v, n in wanted.items():
        part = min(1.0, n / max(counts.get(v, 0), 1))
        pick = pick | ((F.col("label") == v) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)) + (part == 1.0)))
    picked = rows.where(pick).groupBy("doc_id").agg(F.max("label").alias("label"))
    return picked.limit(2 * sum(wanted.values()) + 1000)


def crc_of_id(mod: int):
    """crc32 of the decimal doc_id, modulo mod; a null doc_id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod
