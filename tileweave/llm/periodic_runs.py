"""Operator 13: periodic runs of words, found by string synchronising sets.

A scale t (1, 2, 4, ...) looks for periods p with 1.5 t <= p < 3 t. Its synchronising set holds the places i whose window of t
words has, by a hash, the least value of the t + 1 windows from i on or of those up to i + t; so whether i belongs depends on the
2 t words from i only, and in a run of period p the set repeats every p words. Two places of the set with equal contexts (2 t
words) propose their distance as a period. Windows of a period of at most t / 3 are left out of the set, as they would fill it;
the runs that they belong to are known from the smaller scales, and period 1 is detected by itself. Every proposal is then
extended word by word, so hashes decide nothing.

All documents of a batch are one row of numbers, with numbers that stand once between them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tileweave.llm.common import SLICE, texts
from tileweave.llm.textstats import words_of

#: Shortest run, and fewest times that its period goes into it (fixed values).
SHORTEST, LEAST_TIMES = 24, 3
#: Characters of whole texts that are looked at together; a longer text is looked at by itself.
BATCH = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of at least `least` true values."""
    edge = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = hi - lo >= least
    return lo[long], hi[long]


def _reach(w: np.ndarray, at: int, p: int, step: int) -> int:
    """How many words from `at` on (step 1) or before it (-1) equal the word p farther on."""
    n, done, size = len(w) - p, 0, 32
    while True:
        if step > 0:
            lo, hi = at + done, min(at + done + size, n)
        else:
            lo, hi = max(at - done - size, 0), at - done
        if lo >= hi:
            return done
        other = np.flatnonzero(w[lo:hi] != w[lo + p : hi + p])
        if len(other):
            return done + int(other[0] if step > 0 else hi - lo - 1 - other[-1])
        done += hi - lo
        size *= 2


def _extended(w: np.ndarray, at: np.ndarray, p: int) -> list[tuple[int, int]]:
    """(begin, end) of the maximal runs of period p, three periods or longer, that hold one of the places `at` and the word p on."""
    if len(at) * 256 > len(w):
        lo, hi = _stretches(w[:-p] == w[p:], (LEAST_TIMES - 1) * p)
        return list(zip(lo.tolist(), (hi + p).tolist(), strict=True))
    out, k = [], 0
    while k < len(at):
        here = int(at[k])
        ahead = _reach(w, here, p, 1)
        if ahead:
            lo, hi = here - _reach(w, here, p, -1), here + ahead
            if hi - lo >= (LEAST_TIMES - 1) * p:
                out.append((lo, hi + p))
            k = int(np.searchsorted(at, hi))
        else:
            k += 1
    return out


def _synchronised(h: np.ndarray, t: int, left_out: np.ndarray) -> np.ndarray:
    """Places i where the least hash of windows i to i + t is that of i or of i + t."""
    n = len(h) - t
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.where(left_out[: len(h)], np.iinfo(np.uint64).max, _mixed(h) >> np.uint64(1))
    least, wide = key, 1
    while 2 * wide <= t:  # least of 2 ** k windows, and t is a power of two
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    low = np.minimum(least[:n], key[t : t + n])
    return np.flatnonzero((low != np.iinfo(np.uint64).max) & ((low == key[:n]) | (low == key[t : t + n])))


def cubic_runs(w: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal stretches of three periods or more, period the smallest; any length.

    longest: most words that a stretch can have, where w holds several texts.
    """
    n = len(w) if longest is None else longest
    found: dict[tuple[int, int], int] = {}
    if n < LEAST_TIMES:
        return []
    lo, hi = _stretches(w[:-1] == w[1:], LEAST_TIMES - 1)
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        found[(a, b + 1)] = 1
    h, t = _mixed(w.astype(np.uint64) * _MIX + np.uint64(1)), 1
    while 9 * t <= 2 * n:  # the shortest run of this scale has 4.5 t words
        left_out = np.zeros(len(h) + 1, np.int32)
        for (a, b), p in found.items():
            if 3 * p <= t <= b - a:  # windows a to b - t lie in a run of a small period
                left_out[a] += 1
                left_out[b - t + 1] -= 1
        at = _synchronised(h, t, np.cumsum(left_out[:-1]) > 0)
        pair = h[:-t] * _MIX + _mixed(h[t:])  # hash of the 2 t words from each place
        here = pair[at]
        proposed: dict[int, list[np.ndarray]] = {}
        k, near = 1, len(at) > 1
        first = -(-3 * t // 2)
        while near:
            gap = at[k:] - at[:-k]
            near = bool(len(gap)) and bool((gap < 3 * t).any()) and k + 1 < len(at)
            hit = np.flatnonzero((gap >= first) & (gap < 3 * t) & (here[k:] == here[:-k]))
            if len(hit):
                gaps, places = gap[hit], at[hit]
                order = np.argsort(gaps, kind="stable")
                gaps, places = gaps[order], places[order]
                for group in np.split(np.arange(len(gaps)), np.flatnonzero(np.diff(gaps)) + 1):
                    proposed.setdefault(int(gaps[group[0]]), []).append(places[group])
            k += 1
        for p, places in proposed.items():
            for run in _extended(w, np.unique(np.concatenate(places)), p):
                found[run] = min(found.get(run, p), p)
        h, t = _mixed(pair), 2 * t
    return [(a, b, p) for (a, b), p in found.items()]


def runs_of(documents: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of SHORTEST words and LEAST_TIMES periods in each list of words, by start, then period."""
    seen: dict = {}
    flat: list[int] = []
    starts = []
    for k, words in enumerate(documents):
        starts.append(len(flat))
        flat.extend(seen.setdefault(x, len(seen)) for x in words)
        flat.append(-1 - k)  # stands once, so no run passes it
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    begins = np.array(starts, np.int64)
    for a, b, p in cubic_runs(np.array(flat, np.int64), max(map(len, documents), default=0)):
        if b - a >= SHORTEST:
            d = int(np.searchsorted(begins, a, side="right")) - 1
            out[d].append((a - starts[d], b - a, p))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the greatest exact length / period; ties: smallest start, then period."""
    best = runs[0]
    for r in runs[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [x for x, g in zip(words, gone.tolist(), strict=True) if not g]


def as_they_are(doc_id: int | None, words: list) -> list:
    """The words of a text, unchanged."""
    return words


def with_made_runs(doc_id: int | None, words: list) -> list:
    """words of the documents whose crc32 h of the decimal doc_id is divisible by 10 with a repeated tail; others unchanged.

    With g = h // 10 and a = g % n, the words from a on are the first p = 1 + (n - a) // (3 + g % 8) of them, over and over.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>"


def _columns(ids: list, bodies: list[str | None], reword: Callable, with_text: bool) -> list[list]:
    documents = [reword(i, words_of(t or "")) for i, t in zip(ids, bodies, strict=True)]
    out: list[list] = [[] for _ in range(9)]
    for words, runs in zip(documents, runs_of(documents), strict=True):
        start, length, period = _strongest(runs) if runs else (None, None, None)
        kept = b" ".join(kept_words(words, runs))
        row = [len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), [{"start": s, "length": n, "period": p} for s, n, p in runs], kept.decode("utf-8", "surrogatepass") if with_text else None]
        for c, v in zip(out, row, strict=True):
            c.append(v)
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reword: Callable = as_they_are, with_text: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_runs, the strongest run (start, length, period, exponent_milli), digests, runs.

    Words are maximal runs of characters other than the six white-space ones, as `reword(doc_id, words)` gives them. A run is a
    stretch of words with smallest period q, at least 24 words and 3 q long, that no neighbouring word extends. The strongest
    has the greatest length / q (ties: smallest start, then period); without runs it is null. runs_sha256 is over every run's
    `start,length,period` and a line feed, collapsed_sha256 over the words that stay, joined by one space, where no run
    goes on beyond its first period. `runs` lists all of them; with_text adds the collapsed text as `collapsed`.

    Null and empty texts have no words and no run. Repeated rows each get a row, a null id stays null; other columns of docs
    are not read. Empty table: empty result. A text is looked at as a whole, in memory in proportion to it; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and end - at < SLICE and (end == at or size + len(bodies[end] or "") <= BATCH):
                    size += len(bodies[end] or "")
                    end += 1
                columns = _columns(ids[at:end], bodies[at:end], reword, with_text)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))], names=names)
                at = end

    kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
    schema = SCHEMA
    if with_text:
        kinds, names, schema = [*kinds, pa.string()], [*names, "collapsed"], schema + ", collapsed string"
    d = texts(docs, id_col, text_col)
    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, {schema}")
