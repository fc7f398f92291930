"""Operator 8: toxicity by compression distance.

Two zstandard dictionaries come from labelled documents, one trained on windows of ordinary text and one on windows of toxic
text. A window of a few words that shrinks more with the second than with the first speaks for toxicity; ordinary text
shrinks alike with both. Byte cuts turn the saved bytes of all windows of the whole text into the features of a logistic
curve; cuts and curve are calibrated on labelled documents that the dictionaries were not made from.

Windows of toxic documents are ordinary text for the most part, so which of them train the toxic dictionary is picked by
compression itself, in rounds (`dictionaries`): those that the ordinary dictionary shrinks badly come first, then those that
a dictionary trained on other toxic documents shrinks better than the ordinary one does, while windows of ordinary documents
that it shrinks better, too, go to the ordinary dictionary.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import map_texts, sampled_ids, texts

#: Words in a window, and those that the next one shares with it.
WINDOW, SHARED = 8, 1
#: Stands before and after each window and at the end of both dictionaries: zstandard starts no match in the last eight bytes
#: of what it compresses, and stores what gains little as it is, so without it the last word of a window would never shrink.
LEAD = b"<0123456789 one long match before each window 9876543210>"
_EDGE = re.compile(r"[^\w\s]+")


def normal(text: str) -> list[str]:
    """Lowered words without marks."""
    return _EDGE.sub(" ", text.lower()).split()


def windows(words: list[str]) -> list[bytes]:
    """Overlapping windows that cover all words."""
    step = WINDOW - SHARED
    return [(" " + " ".join(words[i : i + WINDOW]) + " ").encode("utf-8", "surrogatepass") for i in range(0, max(1, len(words) - SHARED), step)] if words else []


def framed(window: bytes) -> bytes:
    return LEAD + window + LEAD


@lru_cache(4)
def _compressors(ordinary: bytes, toxic: bytes):
    import zstandard as z

    params = z.ZstdCompressionParameters.from_level(6, min_match=4, strategy=z.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False)
    out = []
    for content in (ordinary, toxic):
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)
    return out


FEATURES = 5


@dataclass
class CompressionModel:
    """Dictionaries and the fitted curve; small enough to travel with each task."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = 0.0
    mean: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    scale: list[float] = field(default_factory=lambda: [1.0] * FEATURES)
    #: Saved bytes from which a window counts as a weak and as a strong hit.
    cuts: tuple[int, int] = (2, 4)

    def saved(self, text: str) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, for each window."""
        plain, toxic = _compressors(self.ordinary, self.toxic)
        w = windows(normal(text))
        return np.fromiter((len(plain(x)) - len(toxic(x)) for x in map(framed, w)), np.int64, len(w))

    def features(self, text: str) -> list[float]:
        return self.features_of(self.saved(text))

    def features_of(self, d: np.ndarray) -> list[float]:
        if not len(d):
            return [0.0] * FEATURES
        weak, strong = (float((d >= k).sum()) for k in self.cuts)
        return [math.log1p(max(float(d.max()), 0.0)), math.log1p(weak), math.log1p(strong), strong / len(d), math.log1p(len(d))]

    def score(self, feats: np.ndarray) -> np.ndarray:
        z = ((feats - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, pen = np.zeros(a.shape[1]), np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + pen, a.T @ (y - p) - pen @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def trained(parts: list[bytes], size: int, k: int = 16) -> bytes:
    """Content of a dictionary that zstandard trains on parts, in segments of k bytes; the commonest parts where they are too few."""
    import zstandard as z

    try:
        if len(parts) >= 500:
            return z.train_dictionary(size, parts, k=k, d=6).as_bytes()
    except z.ZstdError:
        pass
    return b"".join(p for p, _ in Counter(parts).most_common(size // k))


def _lengths(content: bytes, parts: list[bytes]) -> np.ndarray:
    """Compressed bytes of each part with content as the dictionary; equal parts are compressed once."""
    shrink = _compressors(content + LEAD, content + LEAD)[0]
    known = {p: len(shrink(framed(p))) for p in dict.fromkeys(parts)}
    return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))


def dictionaries(toxic: list[list[bytes]], plain: list[list[bytes]], base: bytes, size: int = 24_000, rounds: int = 5, badly: float = 0.6) -> tuple[bytes, bytes]:
    """(ordinary, toxic) contents from each document's distinct windows of one word, starting from an ordinary `base`.

    Each round trains on the windows picked so far and on those of toxic documents without a picked one, of them the share
    that the ordinary dictionary shrinks worst (beyond the quantile `badly` of added bytes a byte). Documents of even and odd
    places are judged by dictionaries of the other half, so none picks what only it holds. The number of bytes from which a
    window is picked is the one that parts toxic documents from ordinary ones most clearly; ordinary windows that save about
    as many train the ordinary dictionary from then on.
    """

    def flat(docs: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
        return [x for d in docs for x in d], np.repeat(np.arange(len(docs)), [len(d) for d in docs])

    (ones, of), (zeros, of0) = flat(toxic), flat(plain)
    size_of = np.array([len(x) for x in ones], float)
    picked, against = np.zeros(len(ones), bool), np.zeros(len(zeros), bool)
    ordinary, extra = base, b""
    was, was0 = _lengths(ordinary, ones), _lengths(ordinary, zeros)
    for _ in range(rounds if ones else 0):
        marked = np.zeros(len(toxic), bool)
        marked[of[picked]] = True
        added = (was - _lengths(ordinary, [b" "])[0]) / size_of
        asked = ~marked[of] & (added >= np.quantile(added, badly))
        saved, saved0 = np.zeros(len(ones), np.int64), np.zeros(len(zeros), np.int64)
        for side in (0, 1):
            content = b"".join(trained([x for x, m, d in zip(ones, which, of, strict=True) if m and d % 2 == side], size) for which in (asked, picked))
            at, at0 = np.flatnonzero(of % 2 != side), np.flatnonzero(of0 % 2 != side)
            saved[at] = was[at] - _lengths(content + ordinary, [ones[i] for i in at])
            saved0[at0] = was0[at0] - _lengths(content + ordinary, [zeros[i] for i in at0])
        share = {k: ((saved >= k).mean(), (saved0 >= k).mean() if len(zeros) else 0.0) for k in range(1, 12)}
        cut_at = max(share, key=lambda k: (share[k][0] - share[k][1]) / math.sqrt(sum(share[k]) + 1e-9))
        picked, against = saved >= cut_at, against | (saved0 >= max(2, cut_at - 1))
        ordinary = trained([x for x, m in zip(zeros, against, strict=True) if m], 4 * size) + base
        was, was0 = _lengths(ordinary, ones), _lengths(ordinary, zeros)
        extra = trained([x for x, m in zip(ones, picked, strict=True) if m], size)
    return ordinary, extra + ordinary


def train(samples: list[tuple[str, int]], dict_bytes: int = 24_000, prior: float | None = None, held: int = 4) -> CompressionModel:
    """A model from (text, label) pairs, `prior` being the share of label 1 where it isn't that of the pairs; with no pairs of one label the score is that of the other everywhere.

    One in `held` pairs of each label makes no dictionary and calibrates cuts and curve instead: the pair of byte cuts whose
    curve fits these best is kept. Fewer than `held` pairs of a label calibrate and train both.
    """
    samples = list(dict.fromkeys(samples))
    by_label = {label: [t for t, y in samples if y == label] for label in (0, 1)}
    part = {v: ([t for i, t in enumerate(ts) if i % held] or ts, ts[::held] if len(ts) >= held else ts) for v, ts in by_label.items()}
    # the driver holds each window of one word once, however many documents have it
    base = trained([x for t in part[0][0] for x in windows(normal(t))], dict_bytes, 48)
    known: dict[bytes, bytes] = {}
    one = lambda w: known.setdefault(x := f" {w} ".encode("utf-8", "surrogatepass"), x)
    words = {v: [list(dict.fromkeys(map(one, normal(t)))) for t in part[v][0]] for v in part}
    ordinary, toxic = dictionaries(words[1], words[0], base, dict_bytes)
    del words, known
    model = CompressionModel(ordinary + LEAD, toxic + LEAD)
    if not by_label[1] or not by_label[0]:
        model.bias = 30.0 if by_label[1] else -30.0
        return model
    y = np.array([float(v) for v in (1, 0) for _ in part[v][1]])
    saved, best = [model.saved(t) for v in (1, 0) for t in part[v][1]], math.inf
    for cuts in combinations(range(1, 9), 2):
        tried = CompressionModel(model.ordinary, model.toxic, cuts=cuts)
        x = np.array([tried.features_of(d) for d in saved], float).reshape(-1, FEATURES)
        tried.mean, tried.scale = x.mean(0).tolist(), np.maximum(x.std(0), 1e-6).tolist()
        w, tried.bias = fit_logistic((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), y)
        tried.weights = w.tolist()
        p = np.clip(tried.score(x), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        if loss < best:
            best, model = loss, tried
    if prior and prior < 1:
        # the sample holds more toxic documents than there are; a score is to be a share of such documents all the same
        model.bias += math.log(prior / (1 - prior)) - math.log(y.sum() / (len(y) - y.sum()))
    return model


def train_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_rows: int = 2000, plain_rows: int = 3300, sample_chars: int = 20_000) -> CompressionModel:
    """train() on a bounded sample: about toxic_rows and plain_rows labelled documents, picked by a hash of their ids.

    labels: (doc_id, toxic); rows with a null are ignored; of rows of documents with one id, one counts. Of a sampled text
    longer than sample_chars ten even stretches of together that length are learned from, which bounds what the driver
    holds; scoring reads every text whole. The picked ids are few by these bounds and so broadcast; only sampled texts are
    shuffled.
    """
    ids = sampled_ids(labels, {1: toxic_rows, 0: plain_rows}, "toxic")
    picked = texts(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").where("text is not null")
    part = sample_chars // 10
    stretches = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.substring("text", (k * F.length("text") / 10).cast("int") + 1, F.lit(part))), " ")
    one = picked.withColumn("text", F.when(F.length("text") > sample_chars, stretches).otherwise(F.col("text"))).groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted((r["doc_id"], r["text"], r["label"]) for r in one.collect())
    share = labels.where("toxic is not null").agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return train([(t, y) for _, t, y in rows], prior=share)


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, n_windows, most_saved, score, predicted) of every whole text; texts without words score like clean ones.

    Null texts count as empty; repeated rows each get a row.
    """

    def each(values: list[str]) -> list:
        f = np.array([model.features(t) for t in values], float).reshape(-1, FEATURES)
        s = model.score(f)
        return [pa.array(np.rint(np.expm1(f[:, 4])).astype(np.int64)), pa.array(np.rint(np.expm1(f[:, 0]))), pa.array(s), pa.array((s >= threshold).astype(np.int32))]

    return map_texts(texts(docs, id_col, text_col), each, "n_windows long, most_saved double, score double, predicted int")


def drop_toxic(docs: DataFrame, model: CompressionModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs without the rows whose text scores at least threshold; each row is judged where it is, nothing is shuffled.

    Null and empty texts count as clean, unless the model knows toxic documents only; rows without an id and repeated rows
    are judged each; every column stays; empty table: empty result.
    """

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([model.features(t or "") for t in text], float).reshape(-1, FEATURES)) < threshold)

    return docs.where(clean(F.col(text_col)))
