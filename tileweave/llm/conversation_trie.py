"""Operator 11: the trie of conversation prefixes, by union-find over sorted-neighbour LCP edges.

Each conversation is the path of its prefixes' digests. Distinct paths are sorted; the longest common prefix (LCP) of
neighbours is an edge between them. Taking the edges in descending depth, every merge of components is a branching node,
and the nodes between two merges have the same members. Sorted input lets a stack take the edges in that order, in one pass
over a range of paths. What touches the range's ends stays open: a few components, contracted to one item each, which
are merged with those of the neighbouring ranges in the same way, round after round, until one root is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import cut, drop

#: Bytes of a digest; a path is one digest for each of its prefixes.
WIDE = 16
#: Rows handed to Python code at once; paths may be long, so few.
SLICE = 512

TURNS = "array<struct<digest:binary,size:bigint>>"


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (digest, size)) of conversations (conv_id, turn, role, text), in order of turn.

    Null turns come first; rows alike in turn go by role, size of the text and digest. A null role or text counts as
    empty. Rows without a conv_id belong to no conversation. size is the text's length in UTF-8 bytes. Texts are read
    once and not shuffled. A conversation is one row of 24 bytes for each turn.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    t = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), role.alias("role"), F.octet_length(text).cast("long").alias("size"), F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDE)).alias("digest")).alias("t"))
    rows = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return rows.select("conv_id", F.transform("ts", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns"))


def with_shared_heads(seqs: DataFrame, group: int = 5, cuts: int = 9) -> DataFrame:
    """seqs where conversation c has the first h turns of conversation c - c % group before its own turns after the first h.

    h is the unsigned crc32 of c's decimal form modulo `cuts`. All turns are taken where the head has fewer, none where it
    doesn't exist; a negative c has its head nearer to 0. Only heads of under `cuts` turns are joined.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % cuts).cast("int")
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("__head"), F.slice("turns", 1, cuts - 1).alias("__first"))
    both = seqs.withColumn("__head", F.col("conv_id") - F.col("conv_id") % group).join(heads, "__head", "left")
    first = F.coalesce(F.slice("__first", F.lit(1), h), F.array().cast(TURNS))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return both.select("conv_id", F.concat(first, own).alias("turns"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, path, end, sizes): the digest of each prefix, chained, and the last one."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            paths, ends, sizes = [], [], []
            for turns in part.column(1).to_pylist():
                now, out = b"", []
                for t in turns:
                    now = hashlib.blake2b(t["digest"], key=now, digest_size=WIDE).digest()
                    out.append(now)
                paths.append(b"".join(out))
                ends.append(now)
                sizes.append([t["size"] for t in turns])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.binary()), pa.array(ends, pa.binary()), pa.array(sizes, pa.list_(pa.int64()))], names=["conv_id", "path", "end", "sizes"])


class Part:
    """A component of the union-find: neighbouring paths alike in their first `depth` digests.

    conv, n: smallest member and members; kids: children of the node at `depth`; leaves, saved: of the nodes below it;
    ends: digest of the conversations that end there, if any.
    """

    __slots__ = ("conv", "depth", "ends", "kids", "lcp", "leaves", "n", "path", "saved", "sums")

    def __init__(self, lcp, depth, path, sums, conv, n, kids, leaves, saved, ends):
        self.lcp, self.depth, self.path, self.sums, self.conv, self.n = lcp, depth, path, sums, conv, n
        self.kids, self.leaves, self.saved, self.ends = kids, leaves, saved, ends

    def join(self, other: Part) -> None:
        """Take in what is known of the same node from elsewhere."""
        self.conv = other.conv if self.conv is None else self.conv if other.conv is None else min(self.conv, other.conv)
        self.n += other.n
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends


def common_depth(a: bytes, b: bytes) -> int:
    """Digests that two paths have in common from their start."""
    lo, hi = 0, min(len(a), len(b)) // WIDE
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[(mid - 1) * WIDE : mid * WIDE] == b[(mid - 1) * WIDE : mid * WIDE]:  # digests are chained: one stands for all before it
            lo = mid
        else:
            hi = mid - 1
    return lo


class Forest:
    """Merges parts that come in the order of their paths; `done` holds node rows of closed components.

    With `root`, all that is left closes into the root; without, `open_parts` gives what touches either end.
    """

    def __init__(self, root: bool):
        self.root, self.stack, self.left, self.floor, self.done, self.last = root, [], [], None, [], None
        if root:
            self.stack.append(Part(0, 0, b"", [], None, 0, 0, 0, 0, None))

    def add(self, part: Part, lcp: int | None = None) -> None:
        """The next part; lcp: its common depth with the one before, where that is known."""
        if self.last is None:
            lcp = 0
        elif lcp is None:
            lcp = common_depth(self.last, part.path)
        self.last = part.path
        if self.stack:
            self._close_to(lcp)
        if self.stack and part.depth == self.stack[-1].depth == lcp:
            self.stack[-1].join(part)
            return
        if not self.stack:
            self.floor = lcp if self.left else None
        self.stack.append(part)

    def _close_to(self, lcp: int) -> None:
        while self.stack and self.stack[-1].depth > lcp:
            c = self.stack.pop()
            if self.stack:
                top = max(lcp, self.stack[-1].depth)
            elif self.floor is None or c.depth == self.floor:
                c.lcp = self.floor  # it may go on before the first part
                self.left.append(c)
                return
            else:
                top = max(lcp, self.floor)
            parent = self.stack[-1] if self.stack and self.stack[-1].depth == top else None
            if parent is None:
                parent = Part(None, top, c.path[: top * WIDE], c.sums[:top], None, 0, 0, 0, 0, None)
                self.stack.append(parent)
            self._close(c, parent)

    def _close(self, c: Part, parent: Part | None) -> None:
        """Rows for c's nodes, from under the parent's depth to its own."""
        top = parent.depth if parent else -1
        leaves = c.leaves or 1
        bottom = c.sums[c.depth - 1] if c.depth else 0
        for d in range(c.depth, top, -1):
            here = d == c.depth
            above = c.sums[d - 2] if d > 1 else 0
            saved = c.saved + (c.n - 1) * (bottom - above) if d else c.saved
            up = c.path[(top - 1) * WIDE : top * WIDE] if d == top + 1 and d else None
            self.done.append((c.conv, d, c.n, c.kids if here else 1, leaves, saved, c.ends if here else None, up, c.path[(d - 1) * WIDE : d * WIDE] if here else None))
        if parent is not None:
            above = c.sums[top - 1] if top else 0
            parent.join(Part(None, top, b"", [], c.conv, c.n, 1, leaves, c.saved + (c.n - 1) * (bottom - above), None))

    def rows(self) -> list[tuple]:
        """The rows closed since the last call."""
        out, self.done = self.done, []
        return out

    def finish(self) -> list[Part]:
        """Close what can be closed; the parts left open, in order, with their common depth with the one before."""
        if self.root:
            self._close_to(0)
            if self.last is not None:
                self._close(self.stack.pop(), None)
            return []
        out = list(self.left)
        for k, c in enumerate(self.stack):
            c.lcp = self.stack[k - 1].depth if k else self.floor
            out.append(c)
        return out


NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, up binary, key binary"
OPEN = "block long, at long, lcp long, o_depth long, path binary, sums array<long>, conv long, n long, kids long, leaves long, saved long, o_ends string"
_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("up", pa.binary()), ("key", pa.binary())]
_OPEN = [("block", pa.int64()), ("at", pa.int64()), ("lcp", pa.int64()), ("o_depth", pa.int64()), ("path", pa.binary()), ("sums", pa.list_(pa.int64())), ("conv", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("o_ends", pa.string())]


def _table(nodes: list[tuple], parts: list[tuple]) -> pa.RecordBatch:
    """Closed nodes, then open parts; each has nulls in the other's columns."""
    cols = [[*(r[k] for r in nodes), *([None] * len(parts))] for k in range(len(_NODE))] + [[*([None] * len(nodes)), *(r[k] for r in parts)] for k in range(len(_OPEN))]
    kinds = _NODE + _OPEN
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds, strict=True)], names=[n for n, _ in kinds])


def _open_rows(forest: Forest, block: int) -> list[tuple]:
    return [(block, k, p.lcp, p.depth, p.path[: p.depth * WIDE], p.sums[: p.depth], p.conv, p.n, p.kids, p.leaves, p.saved, p.ends) for k, p in enumerate(forest.finish())]


def _running(sizes: list[int]) -> list[int]:
    out, total = [], 0
    for s in sizes:
        total += s
        out.append(total)
    return out


def _of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted range of distinct paths (block, path, sizes, conv, n, ends)."""
    forest, block = Forest(False), None
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            for b, path, sizes, conv, n, ends in zip(*[c.to_pylist() for c in part.columns], strict=True):
                block = b
                forest.add(Part(None, len(path) // WIDE, path, _running(sizes), conv, n, 0, 0, 0, ends))
            if rows := forest.rows():
                yield _table(rows, [])
    if block is not None:
        parts = _open_rows(forest, block)
        yield _table(forest.rows(), parts)


def _of_blocks(last: bool) -> Callable:
    """Merges the open parts of neighbouring blocks of one group."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, group, block = Forest(last), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for g, b, _, lcp, depth, path, sums, conv, n, kids, leaves, saved, ends in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if g != group and group is not None:
                        parts = _open_rows(forest, group)
                        yield _table(forest.rows(), parts)
                        forest = Forest(last)
                    new, group, block = b != block, g, b
                    forest.add(Part(None, depth, path, sums, conv, n, kids, leaves, saved, ends), None if new else lcp)
                if rows := forest.rows():
                    yield _table(rows, [])
        if group is not None:
            parts = _open_rows(forest, group)
            yield _table(forest.rows(), parts)

    return merge


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(end, first, ids): sorted ids of one end, joined by commas, in pieces of up to 4,096."""
    end, ids = None, []
    rows: list[tuple] = []
    for batch in batches:
        for e, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if ids and (e != end or len(ids) >= 4096):
                rows.append((end, ids[0], ",".join(map(str, ids))))
                ids = []
            end = e
            ids.append(c)
        if len(rows) >= 64:
            yield _chunk_batch(rows)
            rows = []
    if ids:
        rows.append((end, ids[0], ",".join(map(str, ids))))
    if rows:
        yield _chunk_batch(rows)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    a = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a[0], pa.binary()), pa.array(a[1], pa.int64()), pa.array(a[2], pa.string())], names=["end", "first", "ids"])


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(end, ends): SHA-256 over the pieces of each end, in order; no more than a batch is held."""
    end, h = None, None
    for batch in batches:
        out: list[tuple] = []
        for e, _, ids in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if h is None or e != end:
                if h is not None:
                    out.append((end, h.hexdigest()))
                end, h = e, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        if out:
            yield _end_batch(out)
    if h is not None:
        yield _end_batch([(end, h.hexdigest())])


def _end_batch(rows: list[tuple]) -> pa.RecordBatch:
    a = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a[0], pa.binary()), pa.array(a[1], pa.string())], names=["end", "ends"])


def _ends(convs: DataFrame, classes: DataFrame) -> DataFrame:
    """(end, ends): digest of the ids that end at each prefix where several do.

    Ids are sorted over ranges of (end, id), so a prefix that very many share is spread; each range joins its ids to pieces, and
    SHA-256, which is sequential, reads the pieces only.
    """
    many = convs.join(classes.where("n > 1").select("end"), "end", "left_semi").select("end", "conv_id")
    pieces = many.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(_chunks, "end binary, first long, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_hash_chunks, "end binary, ends string")


def prefix_trie(seqs: DataFrame, fan: int = 64) -> DataFrame:
    """seqs (conv_id, turns) -> one row for each distinct prefix, the empty one (the root) included.

    conv_id: smallest member; depth: turns; parent_conv_id: smallest member of the prefix one turn shorter (null for the
    root); n_convs: conversations that begin so; n_children: prefixes one turn longer; n_leaves: prefixes below that have no
    longer one, itself included; saved_tokens: sum over its subtree of (n_convs - 1) times the bytes of the last turn;
    ends_sha256: SHA-256 of the ids of the conversations that end here, ascending, joined by commas.

    conv_id must be unique in seqs and not null. Conversations alike in every turn are one path. Sorted ranges of paths are
    merged `fan` at a time. A conversation without turns is a member of the root alone. Empty table: empty result.
    """
    convs = cut(seqs.select("conv_id", "turns").mapInArrow(_paths, "conv_id long, path binary, end binary, sizes array<long>"))
    classes = cut(convs.groupBy("end").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n"), F.first("path").alias("path"), F.first("sizes").alias("sizes")))
    one = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    hashed = classes.join(_ends(convs, classes), "end", "left").withColumn("ends", F.coalesce("ends", one))
    ranges = hashed.repartitionByRange("path").sortWithinPartitions("path").select(F.spark_partition_id().cast("long").alias("block"), "path", "sizes", "conv", "n", "ends")
    found = cut(ranges.mapInArrow(_of_range, f"{NODE}, {OPEN}"))
    drop(convs)
    drop(classes)
    nodes = found.where("depth is not null")
    parts = found.where("o_depth is not null")
    blocks = parts.agg(F.max("block")).first()[0]
    names = [x[0] for x in _OPEN]
    while blocks is not None:
        last = blocks < fan
        g = F.floor(F.col("block") / fan)
        dealt = parts.select(g.alias("g"), *names).repartition("g").sortWithinPartitions("g", "block", "at")
        merged = cut(dealt.mapInArrow(_of_blocks(last), f"{NODE}, {OPEN}"))
        nodes = nodes.unionByName(merged.where("depth is not null"))
        parts = merged.where("o_depth is not null")
        blocks = None if last else blocks // fan
    return _with_parents(nodes.select([x[0] for x in _NODE]))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """nodes with parent_conv_id: where the parent has other members, it is found by its digest; the root's is one row."""
    root = nodes.where("depth = 0").select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
    parents = nodes.where("key is not null and depth > 0").select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
    inner = nodes.where("depth = 0 or up is null").withColumn("parent", F.expr("CASE WHEN depth > 0 THEN conv_id END"))
    first = nodes.where("depth = 1 and up is not null").join(F.broadcast(root), "up", "left").select(*nodes.columns, "parent")
    others = nodes.where("depth > 1 and up is not null").join(parents, "up", "left").select(*nodes.columns, "parent")
    none = F.sha2(F.lit("").cast("binary"), 256)
    out = inner.unionByName(first).unionByName(others)
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", none).alias("ends_sha256"))

