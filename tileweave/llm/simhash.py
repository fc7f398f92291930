"""Operator 6: SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Of two fingerprints that differ in at most two bits, one half differs in
at most one. Each half is indexed by its 32 variants with one bit left out, and by which bit that was: halves that
differ in at most one bit share a variant, so an equality join finds every link, and bit counting verifies it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.functions.shared import spread
from tileweave.llm.common import cut, drop, map_texts, row_hash, texts
from tileweave.operators.graph import linked

SEED = 42


def _fingerprints(width: int):
    def each(values: list[str]) -> list:
        import xxhash

        digest = xxhash.xxh64_intdigest
        out = []
        for t in values:
            words = t.encode("utf-8", "surrogatepass").lower().split()
            if not words:
                out.append(0)
                continue
            n = max(1, len(words) - width + 1)
            ones = np.zeros(64, np.int64)
            for at in range(0, n, 1 << 16):
                some = words[at : at + (1 << 16) + width - 1]
                if len(words) < width:
                    parts = [b" ".join(words)]
                else:
                    parts = map(b" ".join, zip(*(some[k:] for k in range(width)), strict=False))
                h = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
                ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
            bits = 2 * ones > n
            out.append(int(np.packbits(bits, bitorder="little").view(np.int64)[0]))
        return [pa.array(out, pa.int64())]

    return each


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed 64-bit number.

    A-Z are lowered; shingles of `width` words, repeats included (fewer words: the whole sequence), are hashed by
    XXH64 with seed 42; a bit is 1 if set in over half the hashes. Null and empty texts have fingerprint 0.
    """
    return map_texts(texts(docs, id_col, text_col), _fingerprints(width), "fp long")


def _variants(fps: DataFrame) -> DataFrame:
    """(fp, sig): the 64 signatures of each fingerprint: half, bit left out, and the 31 bits that stay, in one number."""
    low, high = F.col("fp").bitwiseAND((1 << 32) - 1), F.shiftrightunsigned("fp", 32)
    sigs = []
    for side, half in ((0, low), (1, high)):
        for k in range(32):
            keep = ((1 << 32) - 1) ^ (1 << k)
            sigs.append(half.bitwiseAND(F.lit(keep).cast("long")).bitwiseOR(F.lit((side * 32 + k) << 32).cast("long")))
    return fps.select("fp", F.explode(F.array(*sigs)).alias("sig"))


def hamming_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): all pairs a < b of the distinct fingerprints in column fp that differ in at most max_bits (0 to 3) bits.

    Pairs are sought by equal signatures only; a fingerprint has at most 2080 others within two bits, so links grow
    in proportion to the fingerprints, however many documents share or nearly share one. Signatures are 64 times the
    fingerprints, so both sides are shuffled.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with one deletion reach 3 bits")
    sigs = _variants(fps.where("fp is not null").distinct())
    other = sigs.select(F.col("fp").alias("b"), "sig")
    pairs = spread(sigs.withColumnRenamed("fp", "a")).join(other, "sig").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return pairs.select("a", "b").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2, width: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fp, fingerprint (16 hex digits), component_id.

    component_id: the smallest doc_id reachable by links of at most max_bits bits, the row itself included. Documents
    with one fingerprint are one class; only classes are joined. Texts without words have fingerprint zero and are
    linked like any other. Rows whose doc_id is null have a fingerprint and take part in no group unless others of
    the class have an id; repeated rows each get a row. Empty table: empty result.
    """
    fps = cut(simhash(docs, id_col, text_col, width))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = linked(classes, hamming_links(classes.select("fp"), max_bits), "fp")
    lows = comp.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = comp.select("fp", "component").join(lows, "component").select("fp", "component_id")
    return fps.join(ids, "fp", "left").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2) -> DataFrame:
    """docs without all but one row of each group: the row with the smallest doc_id stays, in every column as it was.

    Groups are those of the texts, whatever the ids: rows of one doc_id with unlike texts may stand for two groups, and
    rows without an id are rows of their groups, chosen last. Ties under one doc_id fall to the row of the smallest hash of
    all columns; of rows alike in every column one stays. Null and empty texts are one group. Empty table: empty result.
    Texts are shuffled once, on the id and hash of the rows that stay.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_hash(docs).alias("row"))
    fps = cut(map_texts(rows, _fingerprints(3), "fp long", "row"))
    alike = fps.groupBy("doc_id", "row", "fp").agg(F.count("*").alias("n"))
    classes = alike.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n")).alias("low"))
    comp = linked(classes, hamming_links(classes.select("fp"), max_bits), "fp")
    keep = cut(comp.groupBy("component").agg(F.min("low").alias("low")).select(F.col("low.doc_id").alias("__id"), F.col("low.row").alias("__row"), F.col("low.n").alias("__n")))
    drop(fps)

    def kept(which: DataFrame) -> DataFrame:
        return docs.withColumn("__hash", row_hash(docs)).join(which, (F.col("__hash") == F.col("__row")) & F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")

    out = kept(keep.where("__n = 1")).drop("__hash")
    again = keep.where("__n > 1")
    if again.limit(1).count():
        # rows alike in every column: any one of them
        one = kept(again).groupBy(id_col, "__hash").agg(F.first(F.struct(*docs.columns)).alias("__one"))
        out = out.unionByName(one.select("__one.*"))
    return out
