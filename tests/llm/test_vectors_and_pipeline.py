"""Embedding groups against brute force, and the pipeline's stages against each other's rules."""

import math

import numpy as np
from pyspark.sql import functions as F

from tileweave.llm import vector_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, threshold=0.9):
    """n_links and component of each row (id, vector), compared with all."""
    ok = [k for k, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    n, c, root, linked = [0] * len(rows), [i for i, _ in rows], list(range(len(rows))), []
    for d in {len(rows[k][1]) for k in ok}:
        own = [k for k in ok if len(rows[k][1]) == d]
        x = np.array([rows[k][1] for k in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T >= threshold - 1e-15
        np.fill_diagonal(s, False)
        for k, r in zip(own, s, strict=True):
            n[k] = int(r.sum())
        linked += [(own[a], own[b]) for a, b in zip(*np.where(np.triu(s)), strict=True)]

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    low = {}
    for k in ok:
        r, i = find(k), rows[k][0]
        low[r] = i if low.get(r) is None else low[r] if i is None else min(low[r], i)
    for k in ok:
        c[k] = low[find(k)]
    return n, c


def grouped(df, **how):
    return sorted(((x["vec_id"], x["n_links"], x["component_id"], x["kept"]) for x in vector_dedup.vector_groups(df, **how).collect()), key=str)


def wanted(rows):
    n, c = brute(rows)
    return sorted(((i, a, b, i is not None and i == b) for (i, _), a, b in zip(rows, n, c, strict=True)), key=str)


SMALL = dict(region_rows=120, shard_rows=40)


def test_vector_groups_against_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + r.normal(size=8) * 0.12).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(30)] + [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0] * 7 + [None]), (404, [float("nan")] + [1.0] * 7), (405, [1.0, 2.0]), (406, [1.0, 2.1]), (407, [-1.0, 2.0]), (7, rows[7][1])]
    # rows without an id, rows of one id with unlike vectors, huge and tiny components, ids above 2^53
    rows += [(None, rows[9][1]), (None, [9.0, -9.0] * 4), (None, [9.0, -9.0] * 4), (8, rows[20][1]), (8, rows[21][1]), (410, [1e300] * 8), (411, [1e-300] * 8), (9007199254740993, [1e300] * 7 + [9e299]), (9007199254740995, [1e-300] * 8)]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, rep string, cid int")
    got, want = grouped(df, **SMALL), wanted(rows)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert sum(x[1] for x in got) >= 0.98 * sum(x[1] for x in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert np.mean([g[2:] == w[2:] for g, w in zip(got, want, strict=True)]) > 0.98
    assert grouped(df, **SMALL, min_recall=1.01, max_overlap=2) == want
    assert vector_dedup.vector_groups(df.limit(0)).count() == 0


def test_unlike_vectors_under_one_id_are_linked_for_themselves(spark):
    rows = [(7, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (8, [1.0, 0.1, 0.0]), (9, [0.0, 1.0, 0.1]), (None, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert grouped(df) == wanted(rows) == sorted([(7, 1, 7, True), (7, 2, 7, True), (8, 1, 7, False), (9, 2, 7, False), (None, 2, 7, False)], key=str)


def test_a_dense_group_is_compared_block_against_block(spark):
    # a third of the vectors around one hub: their region is larger than a task's
    r = np.random.default_rng(2)
    hub = r.normal(size=8)
    rows = [(i, (hub + r.normal(size=8) * 0.2 * np.linalg.norm(hub) / 8**0.5 if i % 3 == 0 else r.normal(size=8)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    dealt = vector_dedup._deal(vector_dedup._hashed(df, "vec_id", "embedding"), 60, 0.9, 4)
    parts = vector_dedup._found(dealt, 3, 0.9, 60, 30, 8, 100)
    found = {x["low"]: x["s"] for x in parts.groupBy("cid").agg(F.sum("links").alias("s")).join(dealt, "cid").collect()}
    n, _ = brute(rows)
    assert sum(n[::3]) > 100_000 and sum(found[k] for k in range(0, 1500, 3)) >= 0.97 * sum(n[::3])
    got, want = grouped(df, region_rows=60, shard_rows=30, block_rows=100), wanted(rows)
    assert sum(x[1] for x in got) >= 0.97 * sum(x[1] for x in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[2] != w[2] for g, w in zip(got, want, strict=True)) <= 15


def test_all_are_compared_where_the_audit_fails(spark, caplog):
    r = np.random.default_rng(3)
    base = r.normal(size=(30, 8))
    rows = [(i, (base[i % 30] + r.normal(size=8) * 0.25).tolist()) for i in range(400)] + [(500 + i, base[3].tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    with caplog.at_level("INFO"):
        got = grouped(df, region_rows=20, shard_rows=10, min_recall=1.01, max_overlap=2, block_rows=90)
    assert got == wanted(rows)
    assert "2 times" in caplog.text and "recall of links 1.0000 where all are compared" in caplog.text


def test_walks_go_across_shards(spark):
    # shards of a few rows: only the united lists lead from one to the next
    r = np.random.default_rng(5)
    x = np.concatenate([c + r.normal(size=(120, 16)) * 0.16 for c in r.normal(size=(5, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    adj = vector_dedup.united(x, 25)
    got = {tuple(p) for p in vector_dedup.range_search(x, adj, x, vector_dedup.medoids(x, adj), np.arange(len(x)), 0.9, 8)}
    want = {tuple(p) for p in np.argwhere(x @ x.T >= 0.9)}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_links_at_the_threshold_are_exact_in_every_way_of_search(spark):
    r = np.random.default_rng(1)
    rows = []
    for _ in range(30):  # eight vectors of ten ones, nine of them shared: every two have a cosine of exactly 0.9
        dims = r.permutation(64)[:17]
        for k in range(8):
            v = np.zeros(64)
            v[dims[:9]] = v[dims[9 + k]] = 1
            rows.append((len(rows), (v * 2.0 ** (k - 3)).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = {(k, 7, k - k % 8) for k in range(len(rows))}
    for more in ({}, {"min_recall": 1.01, "block_rows": 90}, {"min_recall": 1.01, "block_rows": 7}):
        assert {tuple(x)[:3] for x in vector_dedup.vector_groups(df, **more).collect()} == want
    # vectors of huge and of tiny numbers are decided by the same digits
    a, b = np.array([v for _, v in rows[:8]]), np.array([v for _, v in rows[1:9]])
    assert (vector_dedup.cosines(a * 1e300, b * 1e-300) == vector_dedup.cosines(a, b)).all()


def test_range_search_against_all():
    r = np.random.default_rng(3)
    x = r.normal(size=(500, 16))
    x[100:200] = x[0] + r.normal(size=(100, 16)) * 0.15
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    adj = vector_dedup.united(x, 500)
    got = {tuple(p) for p in vector_dedup.range_search(x, adj, x, vector_dedup.medoids(x, adj), None, 0.9, 64)}
    want = {tuple(p) for p in np.argwhere(x @ x.T >= 0.9)}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_nearest_of_many_centres():
    r = np.random.default_rng(6)
    c = r.normal(size=(3000, 4)).astype(np.float32)
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    x = c[:400] + r.normal(size=(400, 4)).astype(np.float32) * 0.01
    got = vector_dedup._nearest(x, c, 2)
    assert (got[:, 0] == (x @ c.T).argmax(1)).mean() > 0.97


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from tileweave.llm import quality_rules, simhash
    from tileweave.llm.common import cut

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES[:-1]:
        out.append(cut(stage(spark, out[-1], SF)))
        assert out[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in out]
    assert ids[1] == {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert ids[2] <= ids[1]
    assert ids[3] == {r["component_id"] for r in simhash.simhash_groups(out[2]).collect()}
    assert ids[4] == ids[3]
    assert not out[4].where("text rlike '(?i)token = \"[0-9a-f]{40}\"'").count()
    packed = cp.STAGES[-1][1](spark, out[4], SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids[4]
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, packed.collect()))
    none = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0
