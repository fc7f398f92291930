"""Operators 11 to 13 against brute force and DuckDB, with nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import math
import os
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tileweave.llm import conversation_trie as trie
from tileweave.llm import licenses
from tileweave.llm import periodic_runs as runs
from tileweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, depth int, end string, key binary, block long"


def rebuilt(rows):
    """{conv_id: [(role, text), ...]} as op11's contract has it."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", len((text or "").encode()), hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    own = {c: [(x[2], x[5]) for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def trie_by_hand(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        leaves = sum(not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), up, len(cs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    """Conversations that share beginnings of many lengths, with copies, prefixes, ties and nulls."""
    r = random.Random(seed)
    out = []
    for c in range(0, 160):
        if c % 17 == 4:
            continue
        n = r.choice([1, 1, 2, 3, 5, 9, 14])
        if c % 7 == 0:
            out += [(c, k, "user", f"same {k}") for k in range(n)]
        else:
            out += [(c, k, r.choice(["user", "assistant"]), r.choice(["a", "é", "bb", "", None])) for k in range(n)]
    out += [(500, None, "user", "first"), (500, 3, "user", "tie"), (500, 3, "user", "tie"), (500, 3, None, "t2"), (501, None, "user", "first"), (None, 0, "user", "nobody"), (-3, 0, "user", "same 0"), (900, 0, "user", "long " * 50_000)]
    out += [(700, k, "user", f"turn {k}") for k in range(300)] + [(701, k, "user", f"turn {k}") for k in range(280)]
    return out


@pytest.mark.parametrize(("seed", "parts", "fan"), [(1, 1, 64), (2, 4, 2), (3, 13, 2), (4, 40, 3), (5, 7, 64)])
def test_trie_by_brute_force(spark, seed, parts, fan):
    rows = conversations(seed)
    df = spark.createDataFrame([(*x, 1, "e", b"k", 2) for x in rows], TURNS).repartition(3)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = trie.prefix_trie(trie.with_shared_heads(trie.sequences(df)), fan).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(x) for x in got), key=str) == trie_by_hand(rebuilt(rows))


def test_trie_of_turnless_and_empty(spark):
    seqs = spark.createDataFrame([(3, []), (7, [(b"x" * 16, 5)]), (8, [])], f"conv_id long, turns {trie.TURNS}")
    got = {x["depth"]: x for x in trie.prefix_trie(seqs).collect()}
    assert sorted(got) == [0, 1] and got[0]["n_convs"] == 3 and got[0]["n_children"] == 1 and got[0]["n_leaves"] == 1
    assert got[0]["ends_sha256"] == hashlib.sha256(b"3,8").hexdigest() and got[1]["parent_conv_id"] == 3
    assert trie.prefix_trie(seqs.where("false")).count() == 0
    assert trie.prefix_trie(trie.sequences(spark.createDataFrame([], TURNS))).count() == 0
    only = trie.prefix_trie(seqs.where("conv_id <> 7")).collect()
    assert len(only) == 1 and only[0]["n_leaves"] == 1 and only[0]["parent_conv_id"] is None


def test_trie_of_one_very_common_conversation(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(20_000) for k in range(2)]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["depth"]: x for x in trie.prefix_trie(trie.sequences(convs)).collect()}
    assert [got[d]["n_convs"] for d in range(3)] == [20_000] * 3 and got[0]["saved_tokens"] == 19_999 * 4
    assert got[2]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()


def duck_rows(name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c.execute(ORACLES[name]).df()


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_license_scan"])
def test_equals_duckdb(spark, name):
    from test_oracles import rows

    got = QUERIES[name](spark, SF).toPandas()
    want = duck_rows(name)
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def license_texts():
    r = random.Random(5)
    filler = ["the", "license", "of", "and", "software", "under", "cc", "by", "general", "public", "all", "rights", "reserved", "été", "42", "x"]
    out = []
    for k in range(150):
        words = [r.choice(filler) for _ in range(r.randrange(0, 200))]
        for _ in range(r.randrange(0, 3)):
            t = licenses.words_of(r.choice(licenses.TEMPLATES)[1])
            for _ in range(r.randrange(0, 5)):  # words lost or changed, so that some stay and some miss the threshold
                t[r.randrange(len(t))] = r.choice(["zzz", t[0]])
            at = r.randrange(0, len(words) + 1)
            words[at:at] = t
        out.append((k, " ".join(w.upper() if r.random() < 0.1 else w for w in words)))
    return [*out, (None, "CC-BY"), (200, None), (201, ""), (202, "CC\x00bY cc by cc"), (203, "All rights\n\nreserved. " * 3000 + "Released under the MIT License"), (204, "Ä" * 5), (205, "ÉCC by"), (5, out[5][1])]


def licenses_by_hand(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        hit = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hit
        base |= {label} if hit else set()
    labels, score = set(base), 1.0 if base else 0.0
    sets = [(label, set(licenses.words_of(t))) for label, t in licenses.TEMPLATES]
    for b in range(0, len(words), licenses.SPAN):
        block = set(words[b : b + 2 * licenses.SPAN])
        for label, s in sets:
            if len(s & block) >= licenses.needed(len(s), licenses.THRESHOLD):
                labels.add(label)
                score = max(score, len(s & block) / len(s))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def test_licenses_by_brute_force(spark):
    rows = license_texts()
    docs = spark.createDataFrame([(i, t, ["w"], 1, 2) for i, t in rows], "doc_id long, text string, words array<string>, t int, met int").repartition(3)
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = [(x["doc_id"], *[x[c] for c in cols]) for x in licenses.license_scan(docs).collect()]
    want = [(i, *licenses_by_hand(t)) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({x[6] for x in got}) > 10 and any(0 < x[7] < 1 for x in got)
    assert licenses.license_scan(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        licenses.license_scan(docs, templates=[("x", "word " * 41)])


def test_licenses_stay_off_python(spark):
    plan = licenses.license_scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def cubic_by_hand(w):
    n, out = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i >= 2 * p:
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b, p) for (a, b), p in out.items())


def repeating(r):
    v, n, kind = r.choice([1, 2, 3, 8]), r.randrange(0, 150), r.randrange(3)
    w = []
    while len(w) < n:
        u = [r.randrange(v) for _ in range(r.randrange(1, 30))]
        if kind == 2:
            u = u[: r.randrange(1, 4)] * r.randrange(1, 9) + u[-2:]
        w += (u * r.randrange(1, 9))[: r.randrange(1, 9 * len(u))] if kind else u
    return w


def test_cubic_runs_by_brute_force():
    r = random.Random(11)
    for _ in range(1500):
        w = repeating(r)
        assert sorted(runs.cubic_runs(np.array(w, np.int64))) == cubic_by_hand(w), w


def run_row(i, text, made):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if made and i is not None and n and zlib.crc32(str(i).encode()) % 10 == 0:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = sorted((a, b - a, p) for a, b, p in cubic_by_hand(words) if b - a >= max(24, 3 * p))
    gone = {k for s, m, p in found for k in range(s + p, s + m)}
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    return (i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{p}\n" for s, m, p in found)), sha(kept))


@pytest.mark.parametrize("made", [False, True])
def test_periodic_runs_by_brute_force(spark, made):
    r = random.Random(2)
    rows = [(k, " ".join(f"w{x}" for x in repeating(r)) if k % 2 else "".join(r.choice("ab \t\n\x0b\x1céx") for _ in range(300))) for k in range(120)]
    rows += [(None, "a " * 30), (300, None), (301, ""), (302, " \n "), (303, "one"), (304, "x y " * 30 + "z " * 40), (3, rows[3][1])]
    docs = spark.createDataFrame([(*x, 1, "s") for x in rows], "doc_id long, text string, n_runs int, start string").repartition(3)
    got = runs.periodic_runs(docs, reword=runs.with_made_runs if made else runs.as_they_are).drop("runs").collect()
    assert sorted((tuple(x) for x in got), key=str) == sorted((run_row(i, t, made) for i, t in rows), key=str)
    assert sum(x["n_runs"] > 0 for x in got) > 10
    assert runs.periodic_runs(docs.where("false")).count() == 0


def test_runs_of_a_very_long_text_and_of_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "a b c d e " * 200_000), (2, "p " * 23), (3, "head " + "u v " * 20 + "tail")], "doc_id long, text string")
    got = {x["doc_id"]: x for x in runs.periodic_runs(docs, with_text=True).collect()}
    assert (got[1]["n_runs"], got[1]["period"], got[1]["length"], got[1]["collapsed"]) == (1, 5, 1_000_000, "a b c d e")
    assert got[2]["n_runs"] == 0 and got[3]["collapsed"] == "head u v tail" and [tuple(x) for x in got[3]["runs"]] == [(1, 40, 2)]


def test_queries_over_their_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((run_row(x["doc_id"], x["text"], True) for x in docs.where(F.length("text") < 1500).collect()), key=str)
    small = {x[0] for x in want}
    got = sorted((tuple(x) for x in QUERIES["op13_periodic_runs"](spark, SF).collect() if x["doc_id"] in small), key=str)
    assert got == want and len(want) > 50
