"""Operator 7: variable-capacity best-fit packing.

Several sequence lengths are permitted, each with a cost: a part for every sequence, whatever its length, and a part that
grows faster than the length. Pieces go, longest first, into the open bin that they fill best; a piece that fits none
opens the bin size whose cost for each token that it can hold of what is still to pack is least; at the end each bin
shrinks to the smallest permitted length that holds its contents. A block is packed so with each choice of bin sizes that
may be opened, and the packing of least cost stands. Documents are dealt by a hash into blocks of bounded size, and each
block is packed by a task of its own, so hot keys don't matter.
"""

from __future__ import annotations

import bisect
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import cut

#: Permitted lengths.
CAPACITIES = (512, 1024, 2048)


def default_cost(capacity: int) -> float:
    """Cost of a sequence: 96 for itself, its tokens, and a share that grows with the square of the length, for attention."""
    return 96 + capacity * (1 + capacity / 16384)


def _packed(lengths: list[int], order: list[int], opened: tuple[int, ...], cost) -> tuple[list[int], list[int], list[int]]:
    """(bin of each length, its offset, used tokens of each bin), with bins of the sizes `opened`."""
    left = sum(lengths)
    rooms: list[int] = []  # sorted distinct rooms of open bins
    open_by: dict[int, list[int]] = {}
    bins, offsets, used = [0] * len(lengths), [0] * len(lengths), []
    for i in order:
        n = lengths[i]
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = open_by[room].pop()
            if not open_by[room]:
                del open_by[room], rooms[at]
        else:
            room = min((c for c in opened if c >= n), key=lambda c: (cost(c) / min(c, left), c))
            b = len(used)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left -= n
        if room > n:
            if room - n not in open_by:
                bisect.insort(rooms, room - n)
                open_by[room - n] = []
            open_by[room - n].append(b)
    return bins, offsets, used


def best_fit(lengths: list[int], capacities: tuple[int, ...], cost=default_cost) -> list[tuple[int, int, int]]:
    """(bin, capacity, offset) for each length; lengths must be 1 to the largest capacity.

    Longest first, ties by position. An open bin with the least room that suffices is taken, the youngest among equals.
    Of all sets of bin sizes that hold the longest piece, the one whose packing costs least after shrinking is used; ties
    take the set with fewer, smaller sizes.
    """
    if not lengths:
        return []
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    capacities = tuple(sorted(set(capacities)))
    best = None
    for size in range(1, len(capacities) + 1):
        for opened in combinations(capacities, size):
            if opened[-1] < lengths[order[0]]:
                continue
            bins, offsets, used = _packed(lengths, order, opened, cost)
            final = [capacities[bisect.bisect_left(capacities, u)] for u in used]
            total = sum(map(cost, final))
            if best is None or total < best[0] - 1e-9:
                best = total, bins, offsets, final
    _, bins, offsets, final = best
    return [(b, final[b], o) for b, o in zip(bins, offsets, strict=True)]


def pack(lengths: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", capacities: tuple[int, ...] = CAPACITIES, cost=default_cost, block_pieces: int = 60_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, capacity, bin_offset.

    A document longer than the largest capacity is cut into pieces of it and a rest; start is the piece's first token.
    Rows of null or non-positive length have no piece. Pieces are dealt into blocks by a hash of (id, piece, row
    content), so that blocks hold about block_pieces; bin_id is block * 2^32 + number in the block. Repeated rows are
    packed each; null ids too. Empty table: empty result. Bins hold at most their capacity; nothing is dropped.
    """
    most = max(capacities)
    n = F.col(length_col).cast("long")
    kind = dict(lengths.dtypes)[id_col]
    pieces = lengths.where(n > 0).select(F.col(id_col).alias("doc_id"), n.alias("n"), F.posexplode(F.expr(f"sequence(0L, (cast({length_col} as long) - 1) div {most})")).alias("piece", "k"))
    pieces = pieces.select("doc_id", F.col("piece").cast("long"), (F.col("k") * most).alias("start"), F.least(F.lit(most), F.col("n") - F.col("k") * most).cast("int").alias("length"))
    pieces = cut(pieces)  # lengths may be dear to compute, and three jobs read them
    total = pieces.count()
    blocks = max(1, math.ceil(total / block_pieces))
    # rows alike in id, piece and length share a hash: where they crowd a block, a seeded random number deals them anew
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(blocks)).cast("int"))
    crowded = [r["block"] for r in dealt.groupBy("block").count().where(F.col("count") > 3 * block_pieces).collect()]
    if crowded:
        extra = F.floor(F.rand(7) * blocks).cast("int")
        dealt = dealt.withColumn("block", F.when(F.col("block").isin(crowded), extra + blocks).otherwise(F.col("block")))

    def block(t: pa.Table) -> pa.Table:
        # Arrow, not pandas: a null id would turn the others into doubles
        t = t.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
        got = best_fit(t["length"].to_pylist(), capacities, cost)
        first = t["block"][0].as_py() << 32
        b, c, o = np.array(got, np.int64).reshape(-1, 3).T
        return pa.table([*(t[n] for n in ("doc_id", "piece", "start", "length")), pa.array(first + b), pa.array(c.astype(np.int32)), pa.array(o.astype(np.int32))], names=["doc_id", "piece", "start", "length", "bin_id", "capacity", "bin_offset"])

    return dealt.select("doc_id", "piece", "start", "length", "block").groupBy("block").applyInArrow(block, f"doc_id {kind}, piece long, start long, length int, bin_id long, capacity int, bin_offset int")
