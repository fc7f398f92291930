"""Operator 10: quality score by a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins. Cyclic boosting visits the features in turn and fits a shallow tree on
one of them at a time, whose leaves are added to that feature's lookup table; afterwards the same is done with trees of two
levels on pairs of features over a coarser grid, for the pairs that reduce the loss most. A score is the sum of one table entry for each
feature and pair, for all rows at once.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import map_texts, sampled_ids, texts
from tileweave.llm.textstats import CLASSES, base_counts, class_counts

FEATURES = ("log_words", "word_length", "repeat_share", "dup_lines", "symbol_share", "distinct_share", "longest_run", "lone_marks", "mark_runs", "line_words", "top_word", *(f"class_{c}" for c in CLASSES))

#: ASCII characters that are neither letters, digits nor spaces, and one of them two or more times in a row.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_MARK_RUN = re.compile(r"([!-/:-@\[-`{-~])\1+")


def features(text: str) -> list[float]:
    """One row of FEATURES; zeros for an empty text."""
    n_words, n_chars, n_symbols, n_dup, n_rep, words = base_counts(text)
    if not n_words:
        return [0.0] * len(FEATURES)
    lines = text.count("\n") + 1
    kinds = class_counts(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    run = max(sum(1 for _ in g) for _, g in groupby(words))
    lone = sum(not w.translate(None, _MARKS) for w in words)
    own = [math.log(n_words), n_chars / n_words, n_rep / n_words, n_dup / lines, n_symbols / n_words, len(counts) / n_words, math.log(run), lone / n_words, len(_MARK_RUN.findall(text)) / n_words, n_words / lines, max(counts.values()) / n_words]
    return own + (kinds / kinds.sum()).tolist()


@dataclass
class AdditiveModel:
    """Bin edges and tables of features and pairs."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x."""
        z = np.full(len(x), self.bias)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], "right")]
        coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.pair_edges)]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(x) else np.array([])


def _tree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, n: int, leaves: int, ridge: float) -> np.ndarray:
    """Leaf value of each bin of the best-first tree with so many leaves on ordered bins."""
    gs, hs = np.bincount(bins, g, n), np.bincount(bins, h, n)
    cg, ch = np.concatenate([[0], np.cumsum(gs)]), np.concatenate([[0], np.cumsum(hs)])
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)

    def split(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        at = np.arange(a + 1, b)
        gain = (cg[at] - cg[a]) ** 2 / (ch[at] - ch[a] + ridge) + (cg[b] - cg[at]) ** 2 / (ch[b] - ch[at] + ridge) - value(a, b)
        k = int(np.argmax(gain))
        return float(gain[k]), int(at[k])

    parts = [(*split(0, n), 0, n)]
    while len(parts) < leaves:
        best = max(range(len(parts)), key=lambda i: parts[i][0])
        gain, at, a, b = parts[best]
        if gain <= 1e-9:
            break
        parts[best : best + 1] = [(*split(a, at), a, at), (*split(at, b), at, b)]
    out = np.zeros(n)
    for *_, a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf value of each cell of the best tree of two levels: a cut of one feature, and of the other on either side."""
    best, out = -1.0, np.zeros(g.shape)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut_at in range(1, len(a)):
            gain, leaves = 0.0, np.zeros(a.shape)
            for rows in (slice(0, cut_at), slice(cut_at, len(a))):
                cg, ch = np.concatenate([[0], np.cumsum(a[rows].sum(0))]), np.concatenate([[0], np.cumsum(b[rows].sum(0))])
                left = cg**2 / (ch + ridge) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + ridge)
                k = int(left.argmax())
                gain += left[k]
                leaves[rows, :k] = cg[k] / (ch[k] + ridge)
                leaves[rows, k:] = (cg[-1] - cg[k]) / (ch[-1] - ch[k] + ridge)
            if gain > best:
                best, out = gain, leaves.T if turned else leaves
    return out


def train(x: np.ndarray, y: np.ndarray, rounds: int = 60, pair_rounds: int = 20, bins: int = 48, pair_bins: int = 6, n_pairs: int = 8, leaves: int = 4, rate: float = 0.15, ridge: float = 4.0) -> AdditiveModel:
    """A model by cyclic boosting of the logistic loss; with one label only, its prior everywhere."""
    m = x.shape[1]
    edges = [_edges(x[:, j], bins) for j in range(m)]
    coarse_edges = [_edges(x[:, j], pair_bins) for j in range(m)]
    rows = len(y)
    prior = (y.sum() + 0.5) / (rows + 1)
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges], [], coarse_edges, [], math.log(prior / (1 - prior)))
    if not rows or y.min() == y.max():
        return model
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    z = np.full(rows, model.bias)
    for _ in range(rounds):
        for j in range(m):
            p = 1 / (1 + np.exp(-z))
            step = rate * _tree(at[j], y - p, p * (1 - p), len(edges[j]) + 1, leaves, ridge)
            model.tables[j] += step
            z += step[at[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse_edges)]
    size = [len(e) + 1 for e in coarse_edges]
    p = 1 / (1 + np.exp(-z))

    def cells(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = coarse[a] * size[b] + coarse[b]
        return cell, np.bincount(cell, g, size[a] * size[b]), np.bincount(cell, h, size[a] * size[b])

    def gain(a: int, b: int) -> float:
        _, gs, hs = cells(a, b, y - p, p * (1 - p))
        return float((gs**2 / (hs + ridge)).sum())

    model.pairs = sorted(combinations(range(m), 2), key=lambda ab: (-gain(*ab), ab))[:n_pairs]
    model.pair_tables = [np.zeros((size[a], size[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-z))
            cell, gs, hs = cells(a, b, y - p, p * (1 - p))
            step = rate * _pair_tree(gs.reshape(size[a], size[b]), hs.reshape(size[a], size[b]), ridge)
            model.pair_tables[k] += step
            z += step.ravel()[cell]
    return model


def _rows(values: list[str]) -> list:
    return [pa.array([features(t) for t in values], pa.list_(pa.float64()))]


def train_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_rows: int = 6000, bad_rows: int = 4000) -> AdditiveModel:
    """train() on a bounded sample: about good_rows and bad_rows labelled documents, picked by a hash of their ids.

    labels: (doc_id, quality); rows with a null are ignored. Only features of the picked documents reach the driver.
    """
    # the picked ids are few by these bounds and so broadcast; of rows with one id, one counts
    ids = sampled_ids(labels, {1: good_rows, 0: bad_rows}, "quality")
    picked = texts(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").where("text is not null")
    one = picked.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = sorted((r["doc_id"], r["label"], r["x"]) for r in map_texts(one, _rows, "x array<double>", "label").collect())
    x = np.array([f for *_, f in found], float).reshape(-1, len(FEATURES))
    return train(x, np.array([v for _, v, _ in found], float))


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; null texts count as empty; repeated rows each get a row."""

    def each(values: list[str]) -> list:
        s = model.score(np.array([features(t) for t in values], float).reshape(-1, len(FEATURES)))
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

    return map_texts(texts(docs, id_col, text_col), each, "score double, predicted int")
