"""Operator 4: embedding near-duplicates by a robust-pruned flat graph.

Distinct vectors are dealt to regions, each to that of its nearest sampled centres, so regions overlap. A region's task
deals its vectors to overlapping cluster shards, builds a pruned neighbour graph on each and unites their adjacency
lists; then it searches for each vector that is at home in the region: greedily from the graph's medoids (and the vector's
own node) along the united lists, so across shards, and onward from every vector found in range until no new one is in
range. Found pairs are verified in double precision. Centres within the link radius of each other, as a large group of
near copies has, make one region; a region too large for a task is compared block against block. A sample's links are
counted by brute force to audit the recall of each round; where it is too low, regions overlap more, and where the
widest overlap is too low as well, all distinct vectors are compared block against block.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import cut, drop
from tileweave.operators.graph import connected_components

log = logging.getLogger(__name__)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of x at length one in double precision; scaled first, so no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


#: How near to the threshold a product of unit vectors is decided by the vectors themselves.
NEAR = 1e-9


def _raw(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as rows in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as unit rows."""
    return _unit(_raw(column)) if len(column) else np.zeros((0, 1))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """dot / sqrt(|a|^2 |b|^2) of the rows of a and b, summed from the first component to the last, whatever rows are compared.

    Rows are first brought near one by powers of two, which changes no digit and lets no square overflow.
    """
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        dot += a[:, k] * b[:, k]
        aa += a[:, k] * a[:, k]
        bb += b[:, k] * b[:, k]
    return dot / np.sqrt(aa * bb)


def _linked(product: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows a of left and b of right link: products of unit vectors tell, but near the threshold `cosines` does.

    So a pair has one answer, however it was found and in whatever block it was multiplied.
    """
    out = product >= threshold
    close = np.flatnonzero(np.abs(product - threshold) <= NEAR)
    for at in range(0, len(close), 65_536):
        some = close[at : at + 65_536]
        out[some] = cosines(left[a[some]], right[b[some]]) >= threshold
    return out


def robust_prune(x: np.ndarray, degree: int = 12, candidates: int = 28, alpha: float = 1.2) -> np.ndarray:
    """Edges (from, to) of each row of the unit vectors x: the nearest first, without those that a kept one is much closer to."""
    n = len(x)
    k = min(candidates, n - 1)
    if k < 1:
        return np.zeros((0, 2), np.int64)
    xs = x.astype(np.float32)
    dist = np.sqrt(np.maximum(2 - 2 * (xs @ xs.T), 0))
    np.fill_diagonal(dist, np.inf)
    cand = np.argpartition(dist, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(dist, axis=1)[:, :k]
    own = np.take_along_axis(dist, cand, 1)
    order = np.argsort(own, axis=1, kind="stable")
    cand, own = np.take_along_axis(cand, order, 1), np.take_along_axis(own, order, 1)
    np.fill_diagonal(dist, 0)
    alive, rows, edges = np.ones_like(cand, bool), np.arange(n), []
    for _ in range(min(degree, k)):
        at = alive.argmax(1)
        has = alive[rows, at]
        if not has.any():
            break
        star = cand[rows, at]
        edges.append(np.stack([rows[has], star[has]], 1))
        alive &= alpha * dist[star[:, None], cand] > own
        alive[rows, at] = False
    return np.concatenate(edges)


def united(x: np.ndarray, shard_rows: int, overlap: int = 2, width: int = 32) -> np.ndarray:
    """Adjacency lists of all rows as one matrix, filled with len(x): those of overlapping cluster shards, united.

    Edges lead both ways; of a row that very many lead to, its own and then the nearest stay, `width` in all.
    """
    n = len(x)
    k = max(1, math.ceil(n * overlap / shard_rows))
    edges = [np.zeros((0, 2), np.int64)]
    if k == 1:
        edges.append(robust_prune(x))
    else:
        centres = x[np.unique(np.linspace(0, n - 1, k).astype(np.int64))].astype(np.float32)
        near = _nearest(x.astype(np.float32), centres, min(overlap, len(centres)))
        for s in range(len(centres)):
            members = np.flatnonzero((near == s).any(1))
            for part in np.array_split(members, max(1, len(members) // (6 * shard_rows))):
                edges.append(part[robust_prune(x[part])])
    e = np.concatenate(edges)
    key, first = np.unique(np.concatenate([e[:, 0] * n + e[:, 1], e[:, 1] * n + e[:, 0]]), return_index=True)
    a, b, xs = key // max(n, 1), key % max(n, 1), x.astype(np.float32)
    order = np.lexsort((-np.einsum("kd,kd->k", xs[a], xs[b]), first >= len(e), a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, np.arange(n))[a]
    a, b, place = a[place < width], b[place < width], place[place < width]
    out = np.full((n, int(place.max(initial=0)) + 1), n, np.int64)
    out[a, place] = b
    return out


def _nearest(x: np.ndarray, centres: np.ndarray, top: int) -> np.ndarray:
    """Places of each row's `top` nearest centres, nearest first; many centres are searched by groups of them, so some may be missed."""
    k = len(centres)
    if k <= 2048:
        s = x @ centres.T
        at = np.argpartition(-s, top - 1, axis=1)[:, :top] if top < k else np.tile(np.arange(k), (len(x), 1))
        return np.take_along_axis(at, np.argsort(-np.take_along_axis(s, at, 1), axis=1, kind="stable"), 1)
    heads = centres[:: math.isqrt(k)]
    of = _nearest(centres, heads, 1)[:, 0]
    ways = _nearest(x, heads, min(8, len(heads)))
    best, score = np.full((len(x), top), -1), np.full((len(x), top), -9.0, np.float32)
    for h in np.unique(ways):
        rows, held = np.flatnonzero((ways == h).any(1)), np.flatnonzero(of == h)
        if len(held):
            s = np.hstack([score[rows], x[rows] @ centres[held].T])
            i = np.hstack([best[rows], np.tile(held, (len(rows), 1))])
            at = np.argsort(-s, axis=1, kind="stable")[:, :top]
            score[rows], best[rows] = np.take_along_axis(s, at, 1), np.take_along_axis(i, at, 1)
    return np.where(best < 0, best[:, :1], best)


def medoids(x: np.ndarray, adj: np.ndarray) -> np.ndarray:
    """The vector nearest to the mean, and the same of what can't be reached from it, until all can be."""
    n = len(x)
    near = x @ x.mean(0)
    seen, out = np.zeros(n + 1, bool), []
    seen[n] = True
    while not seen[:n].all():
        start = int(np.where(seen[:n], -np.inf, near).argmax())
        out.append(start)
        seen[start] = True
        front = np.array([start])
        while len(front):
            nxt = np.unique(adj[front])
            front = nxt[~seen[nxt]]
            seen[front] = True
    return np.array(out)


def range_search(x: np.ndarray, adj: np.ndarray, q: np.ndarray, entries: np.ndarray, own: np.ndarray | None, threshold: float, beam: int, raw: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Pairs (query, row) with cosine >= threshold that a range-expanding greedy search finds; unit vectors.

    adj: neighbours of each row, filled with len(x). own: each query's own row, an extra entry, or None. raw: the rows and
    queries before they were brought to length one, by which pairs at the threshold are decided.
    """
    n, m = len(x), len(q)
    xs = np.vstack([x, np.zeros((1, x.shape[1]))]).astype(np.float32)
    qs = q.astype(np.float32)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True
    first = np.tile(entries, (m, 1))
    if own is not None:
        first = np.hstack([np.where(first == own[:, None], n, first), own[:, None]])
    sims = np.where(first < n, np.einsum("mkd,md->mk", xs[first], qs), -2)
    np.put_along_axis(seen, first, True, 1)
    ids, done = first, np.zeros(first.shape, bool)
    hits = []

    def keep(rows: np.ndarray, nodes: np.ndarray, s: np.ndarray) -> None:
        inside = (s >= threshold - 1e-4) & (nodes < n)
        if inside.any():
            hits.append(np.stack([rows[inside], nodes[inside]], 1))

    keep(np.repeat(np.arange(m), first.shape[1]), first.ravel(), sims.ravel())
    active = np.arange(m)
    while len(active):
        open_ = np.where(done[active] | (ids[active] >= n), -3, sims[active])
        at = open_.argmax(1)
        go = open_[np.arange(len(active)), at] > -2
        active, at = active[go], at[go]
        if not len(active):
            break
        done[active, at] = True
        near = adj[ids[active, at]]
        fresh = ~np.take_along_axis(seen[active], near, 1)
        near = np.where(fresh, near, n)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        s = np.where(near < n, np.einsum("mkd,md->mk", xs[near], qs[active]), -2)
        seen[active[:, None], near] = True
        keep(np.repeat(active, near.shape[1]), near.ravel(), s.ravel())
        all_i, all_s = np.hstack([ids[active], near]), np.hstack([sims[active], s])
        all_d = np.hstack([done[active], np.zeros(near.shape, bool)])
        top = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        if ids.shape[1] < beam:
            grow = min(beam, all_i.shape[1]) - ids.shape[1]
            if grow > 0:
                ids = np.hstack([ids, np.full((m, grow), n)])
                sims = np.hstack([sims, np.full((m, grow), -2.0, sims.dtype)])
                done = np.hstack([done, np.zeros((m, grow), bool)])
        w = min(ids.shape[1], top.shape[1])
        ids[active, :w], sims[active, :w], done[active, :w] = (np.take_along_axis(v, top, 1)[:, :w] for v in (all_i, all_s, all_d))
        ids[active, w:] = n
    front = np.concatenate(hits) if hits else np.zeros((0, 2), np.int64)
    found = [front]
    expanded = np.zeros((m, n + 1), bool)
    while len(front):
        front = front[~expanded[front[:, 0], front[:, 1]]]
        expanded[front[:, 0], front[:, 1]] = True
        new = []
        for at in range(0, len(front), 20_000):
            part = front[at : at + 20_000]
            key = np.unique((part[:, :1] * (n + 1) + adj[part[:, 1]]).ravel())
            r, c = key // (n + 1), key % (n + 1)
            fresh = ~seen[r, c]
            r, c = r[fresh], c[fresh]
            seen[r, c] = True
            s = np.einsum("kd,kd->k", xs[c], qs[r])
            new.append(np.stack([r[s >= threshold - 1e-4], c[s >= threshold - 1e-4]], 1))
        front = np.concatenate(new) if new else np.zeros((0, 2), np.int64)
        found.append(front)
    pairs = np.concatenate(found)
    exact = np.concatenate([np.einsum("kd,kd->k", x[pairs[i : i + 100_000, 1]], q[pairs[i : i + 100_000, 0]]) for i in range(0, max(len(pairs), 1), 100_000)])
    raw, asked = (x, q) if raw is None else raw
    near = exact >= threshold - NEAR
    pairs, exact = pairs[near], exact[near]
    return np.unique(pairs[_linked(exact, pairs[:, 1], pairs[:, 0], raw, asked, threshold)], axis=0)


class _Union:
    """Smallest row reachable over pairs that come in parts."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            low, high = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root[:] = root[root]


def _hashed(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, h1, h2): the vector and two hashes of it, null where it links with nothing."""
    kind = dict(vectors.dtypes)[vec_col]
    v = F.col(vec_col) if kind in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("vec"))
    whole = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda e: e.isNotNull() & (F.abs(e) < float("inf"))) & F.exists("vec", lambda e: e != 0)
    # adding zero makes one zero of the two
    rows = rows.withColumn("vec", F.when(F.coalesce(whole, F.lit(False)), F.transform("vec", lambda e: (e + F.lit(0.0)).cast(kind[6:-1] if kind in ("array<float>", "array<double>") else "double"))))
    return rows.withColumn("h1", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))).withColumn("h2", F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(17), "vec")))


#: Columns of a distinct vector: its number, hashes, rows, smallest id, regions from the nearest on.
DEALT = "h1 long, h2 long, n long, low {id}, vec {vec}, regions array<int>"
PARTS = "cid long, links long, root long"


def _deal(rows: DataFrame, region_rows: int, threshold: float, most: int, max_centres: int = 16_384) -> DataFrame:
    """Distinct vectors (cid, h1, h2, n, low, vec, regions), written once: `most` regions each at most.

    The driver holds one centre for about region_rows / most vectors, max_centres at most; beyond that regions grow, and
    those that are too large for a task are compared block against block.
    """
    live = rows.where("vec is not null")
    total = live.select("h1", "h2").distinct().count()
    k = min(max_centres, max(1, math.ceil(total * most / region_rows)))
    part = int(min(1.0, 1.3 * k / max(total, 1)) * (1 << 30))
    drawn = live.where(F.pmod(F.xxhash64("h1", F.lit(5)), F.lit(1 << 30)) <= part).groupBy("h1", "h2").agg(F.first("vec").alias("vec")).limit(2 * k + 16).collect()
    drawn.sort(key=lambda r: (r["h1"], r["h2"]))
    centres: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    by_length: dict[int, list] = {}
    for at, r in enumerate(drawn):
        by_length.setdefault(len(r["vec"]), []).append((at, r["vec"]))
    for d, held in by_length.items():
        x = _unit(np.array([v for _, v in held]))
        near = _Union(len(x))
        for at in range(0, len(x), 1024):
            a, b = np.nonzero(x[at : at + 1024] @ x.T >= threshold)
            near.add(a + at, b)
        centres[d] = x.astype(np.float32), np.array([at for at, _ in held], np.int32)[near.root]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            vec = b.column(4)
            lengths = np.diff(np.asarray(vec.offsets)) if isinstance(vec, pa.ListArray) else np.array([len(v) for v in vec])
            regions = np.empty(b.num_rows, object)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                if d not in centres:
                    # no centre has this length: they are a region of their own
                    for i in at:
                        regions[i] = [-int(d)]
                    continue
                x, number = centres[d]
                found = number[_nearest(_matrix(vec.take(pa.array(at))).astype(np.float32), x, min(most, len(x)))]
                for i, f in zip(at, found.tolist(), strict=True):
                    regions[i] = list(dict.fromkeys(f))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(regions.tolist(), pa.list_(pa.int32()))], names=[*b.schema.names, "regions"])

    kinds = dict(rows.dtypes)
    classes = live.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"), F.first("vec").alias("vec"))
    return cut(classes.mapInArrow(assign, DEALT.format(id=kinds["vec_id"], vec=kinds["vec"])).withColumn("cid", F.monotonically_increasing_id()))


def _owned(region: int, a: np.ndarray, b: np.ndarray, cid: np.ndarray, home: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Whether a pair of rows counts in this region: it does in the home of the one with the smaller number, if the other
    is there too, else in the home of the other."""
    low, high = np.where(cid[a] < cid[b], a, b), np.where(cid[a] < cid[b], b, a)
    meets = (regions[high] == home[low][:, None]).any(1)
    return np.where(meets, home[low], home[high]) == region


def _padded(lists: pa.Array) -> np.ndarray:
    lists = lists.to_pylist()
    out = np.full((len(lists), max(map(len, lists), default=1)), -(1 << 31), np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _parts(links: np.ndarray, cid: np.ndarray, root: np.ndarray) -> pa.Table:
    at = np.flatnonzero(links)
    return pa.table({"cid": pa.array(cid[at], pa.int64()), "links": pa.array(links[at], pa.int64()), "root": pa.array(cid[root[at]], pa.int64())})


def _graph_search(region: int, t: pa.Table, shard_rows: int, threshold: float, beam: int) -> pa.Table:
    """Links of a region's vectors that the search of those at home finds."""
    t = t.combine_chunks().sort_by("cid")
    cid, n, raw = t["cid"].to_numpy(), t["n"].to_numpy(), _raw(t["vec"].combine_chunks())
    x = _unit(raw)
    regions = _padded(t["regions"])
    home = regions[:, 0]
    adj = united(x, shard_rows)
    entries, asked = medoids(x, adj), np.flatnonzero(home == region)
    links, roots = np.zeros(len(x), np.int64), _Union(len(x))
    kept = [np.zeros(0, np.int64)]
    for at in range(0, len(asked), 512):
        some = asked[at : at + 512]
        got = range_search(x, adj, x[some], entries, some, threshold, beam, (raw, raw[some]))
        a, b = some[got[:, 0]], got[:, 1]
        ok = (a != b) & _owned(region, a, b, cid, home, regions)
        kept.append(np.unique(np.minimum(a[ok], b[ok]) * len(x) + np.maximum(a[ok], b[ok])))
    pairs = np.unique(np.concatenate(kept))
    a, b = pairs // max(len(x), 1), pairs % max(len(x), 1)
    links += np.bincount(a, n[b], len(x)).astype(np.int64) + np.bincount(b, n[a], len(x)).astype(np.int64)
    roots.add(a, b)
    return _parts(links, cid, roots.root)


def _tile_search(region: int | None, i: int, j: int, t: pa.Table, threshold: float) -> pa.Table:
    """Links between two blocks of a region (or, without a region, of all vectors), every pair compared."""
    t = t.combine_chunks().sort_by("cid")
    cid, n, block = t["cid"].to_numpy(), t["n"].to_numpy(), t["block"].to_numpy()
    regions = _padded(t["regions"])
    home, lengths = regions[:, 0], pa.compute.list_value_length(t["vec"]).to_numpy()
    links, roots = np.zeros(len(cid), np.int64), _Union(len(cid))
    for d in np.unique(lengths):
        some = np.flatnonzero(lengths == d)
        raw = _raw(t["vec"].combine_chunks().take(pa.array(some)))
        x = _unit(raw)
        left, right = np.flatnonzero(block[some] == i), np.flatnonzero(block[some] == j)
        for at in range(0, len(left), 256):
            mine = left[at : at + 256]
            product = x[mine] @ x[right].T
            r, c = np.nonzero(product >= threshold - NEAR)
            ok = _linked(product[r, c], mine[r], right[c], raw, raw, threshold)
            r, c = r[ok], c[ok]
            a, b = some[mine[r]], some[right[c]]
            ok = (a < b) if i == j else (a != b)
            if region is not None:
                ok &= _owned(region, a, b, cid, home, regions)
            a, b = a[ok], b[ok]
            links += np.bincount(a, n[b], len(cid)).astype(np.int64) + np.bincount(b, n[a], len(cid)).astype(np.int64)
            roots.add(a, b)
    return _parts(links, cid, roots.root)


COLUMNS = ["cid", "n", "vec", "regions"]


def _tiles(members: DataFrame, threshold: float, block_rows: int, owned: bool) -> DataFrame:
    """_tile_search over all pairs of blocks of regions; members: region, its number of rows, and COLUMNS.

    A region has 6 blocks or more, for parallel work, and blocks of at most about block_rows; a vector goes to as many
    tiles as its region has blocks.
    """
    blocks = F.greatest(F.lit(1), F.least(F.lit(6), F.ceil(F.col("rows") / 512)), F.ceil(F.col("rows") / block_rows))
    placed = members.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def search(key: tuple, t: pa.Table) -> pa.Table:
        region, i, j = (k.as_py() for k in key)
        return _tile_search(region if owned else None, i, j, t, threshold)

    return tiles.select("region", "i", "j", "block", *COLUMNS).groupBy("region", "i", "j").applyInArrow(search, PARTS)


def _found(dealt: DataFrame, overlap: int, threshold: float, region_rows: int, shard_rows: int, beam: int, block_rows: int) -> DataFrame:
    """(cid, links, root) parts: links that a region owns, and the smallest vector linked with in it."""
    held = dealt.withColumn("regions", F.slice("regions", 1, overlap))
    members = held.withColumn("region", F.explode("regions")).select("region", *COLUMNS)
    crowded = cut(members.groupBy("region").agg(F.count("*").alias("rows")).where(F.col("rows") > 4 * region_rows))

    def search(key: tuple, t: pa.Table) -> pa.Table:
        return _graph_search(key[0].as_py(), t, shard_rows, threshold, beam)

    some = crowded.limit(1).count()
    small = members.join(crowded, "region", "left_anti") if some else members
    out = small.groupBy("region").applyInArrow(search, PARTS)
    if some:
        out = out.unionByName(_tiles(members.join(crowded, "region"), threshold, block_rows, True))
    out = cut(out)
    drop(crowded)
    return out


def _exact(dealt: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(cid, links, root) parts of every pair of distinct vectors, block against block, in double precision."""
    members = dealt.select(F.lit(0).alias("region"), F.lit(dealt.count()).alias("rows"), *COLUMNS)
    return cut(_tiles(members, threshold, block_rows, False))


def audit_recall(dealt: DataFrame, links: DataFrame, threshold: float = 0.9, sample: int = 256) -> float:
    """Share of the true links of about `sample` vectors, by brute force against all, that links (cid, links) has.

    The lesser of the share of all their links and the mean of each vector's share, so few links of many vectors count
    as well as the many of a large group.
    """
    total = max(dealt.count(), 1)
    some = dealt.where(F.pmod(F.xxhash64("cid", F.lit(9)), F.lit(1 << 30)) <= int(min(1.0, sample / total) * (1 << 30))).select("cid", "vec").limit(2 * sample + 16).collect()
    by_length: dict[int, list] = {}
    for r in some:
        by_length.setdefault(len(r["vec"]), []).append((r["cid"], r["vec"]))
    asked = {d: (np.array([c for c, _ in held]), np.array([v for _, v in held], np.float64)) for d, held in by_length.items()}
    ids = np.array([r["cid"] for r in some], np.int64)
    at = {c: k for k, c in enumerate(ids.tolist())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        truth = np.zeros(len(ids), np.int64)
        for b in batches:
            lengths = pa.compute.list_value_length(b.column(1)).to_numpy()
            for d in np.unique(lengths):
                if d in asked:
                    own, q = asked[d]
                    rows = np.flatnonzero(lengths == d)
                    raw = _raw(b.column(1).take(pa.array(rows)))
                    product = _unit(q) @ _unit(raw).T
                    i, j = np.nonzero((product >= threshold - NEAR) & (own[:, None] != b.column(0).to_numpy()[rows][None]))
                    ok = _linked(product[i, j], i, j, q, raw, threshold)
                    np.add.at(truth, np.array([at[c] for c in own.tolist()])[i[ok]], b.column(2).to_numpy()[rows[j[ok]]])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(truth)], names=["cid", "truth"])

    true = dealt.select("cid", "vec", "n").mapInArrow(count, "cid long, truth long").groupBy("cid").agg(F.sum("truth").alias("truth"))
    hits = F.least(F.coalesce("links", F.lit(0)), "truth")
    got = true.where("truth > 0").join(links.select("cid", "links"), "cid", "left").agg((F.sum(hits) / F.sum("truth")).alias("all"), F.avg(hits / F.col("truth")).alias("each")).first()
    return 1.0 if got["all"] is None else min(got["all"], got["each"])


def vector_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, overlap: int = 2, region_rows: int = 8192, shard_rows: int = 400, beam: int = 8, min_recall: float = 0.97, max_overlap: int = 4, block_rows: int = 32_768, max_centres: int = 16_384) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    n_links: other vectors with cosine >= threshold, by `cosines` where it is near; component_id: smallest vec_id reachable by links, itself included;
    kept: vec_id = component_id. Equal vectors are one class, are not compared with each other, but link. Null, empty,
    zero and non-finite vectors link with nothing; vectors link only with those of their own length. A row whose vec_id
    is null links like any other, and is never kept; its component is null where all of the component's ids are. Distinct
    vectors under one vec_id are rows of their own. Empty table: empty result. A region of over four times region_rows
    vectors is compared block against block, so a task's memory is bounded and no member is left out. The recall of every
    round is audited and logged. If it is less than min_recall, regions overlap by one more, up to max_overlap; if it is
    less there too, all distinct vectors are compared, which costs the square of their number.
    """
    rows = _hashed(vectors, id_col, vec_col)
    dealt = _deal(rows, region_rows, threshold, max_overlap, max_centres)
    while True:
        parts = _found(dealt, overlap, threshold, region_rows, shard_rows, beam, block_rows)
        links = parts.groupBy("cid").agg(F.sum("links").alias("links"))
        recall = audit_recall(dealt, links, threshold)
        log.info("recall of links %.4f where regions overlap %d times", recall, overlap)
        if recall >= min_recall:
            break
        drop(parts)
        if overlap >= max_overlap:
            parts = _exact(dealt, threshold, block_rows)
            links = parts.groupBy("cid").agg(F.sum("links").alias("links"))
            recall = audit_recall(dealt, links, threshold)
            log.info("recall of links %.4f where all are compared", recall)
            if recall < 1:
                raise RuntimeError(f"comparing all vectors found {recall} of a sample's links")
            break
        overlap += 1
    comp = connected_components(parts.select(F.col("cid").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("cid"), "component")
    info = dealt.select("cid", "h1", "h2", "n", "low").join(links, "cid", "left").join(comp, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    lows = info.groupBy("component").agg(F.min("low").alias("component_id"))
    info = info.join(lows, "component").select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("linked"))
    out = rows.select("vec_id", "h1", "h2").join(info, ["h1", "h2"], "left")
    component: Column = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
