"""Operator 1: quality rules with a distribution-divergence verdict.

A document's histogram of character classes and its histogram of common words are compared, by Jensen-Shannon
distance, with the references of each language. The references are sums over all distinct documents that pass the
base rules, by the documents' language column. A document is held against the language that its words are nearest
to, so a wrong or missing language column does no harm. Both rules have a minimum length below which they abstain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import SLICE, cut, map_texts, texts
from tileweave.llm.textstats import CLASSES, base_counts, class_counts

#: Common words by language (fixed values): what each language's word histogram counts.
COMMON = {
    "de": "der die das und in zu den ist von mit sich auf für nicht ein eine im dem des es er sie auch als an war wie bei oder aus",
    "en": "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ya este sí",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son ou mais comme",
}
WORDS = sorted({w for x in COMMON.values() for w in x.split()})
_AT = {w.encode(): i for i, w in enumerate(WORDS)}
_OF = {lang: np.array(sorted(_AT[w.encode()] for w in x.split())) for lang, x in COMMON.items()}

STATS = "text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<int>, common array<int>"


def _stats(values: list[str]) -> list:
    import xxhash

    rows = []
    for t in values:
        *base, words = base_counts(t)
        found = [_AT[x] for w in words if (x := w.lower().rstrip(b".,;:!?")) in _AT]
        rows.append((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63), *base, class_counts(t).tolist(), np.bincount(found, minlength=len(WORDS)).tolist() if found else [0] * len(WORDS)))
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())] * 2
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts and histograms) of every whole text; a null text counts as empty."""
    return map_texts(texts(docs, id_col, text_col), _stats, STATS)


def base_failed(min_words: int = 50, max_repeat_percent: int = 50):
    """The base rules on document_stats."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def language_references(stats: DataFrame, langs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang") -> dict[str, tuple[list, list]]:
    """lang -> (class counts, word counts), summed over distinct texts that pass the base rules.

    Only the languages of COMMON have a reference, so what comes to the driver is a row for each of these.
    """
    named = langs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang")).where(F.col("lang").isin(list(COMMON))).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    once = stats.where(~base_failed()).join(named, "doc_id").groupBy("text_hash").agg(F.min("lang").alias("lang"), F.first("classes").alias("classes"), F.first("common").alias("common"))
    n, m = len(CLASSES), len(WORDS)
    sums = [F.sum(F.col("classes")[i]) for i in range(n)] + [F.sum(F.col("common")[i]) for i in range(m)]
    rows = once.groupBy("lang").agg(F.array(*sums[:n]).alias("classes"), F.array(*sums[n:]).alias("common"))
    return {r["lang"]: (r["classes"], r["common"]) for r in rows.collect()}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of rows of p and the row q; a row of zeros is at distance 1."""
    total = p.sum(1, keepdims=True)
    p, q = p / np.maximum(total, 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(part / 2, 0, 1)), 1.0)


@dataclass
class Judge:
    """The verdict on documents whose counts are known."""

    references: dict[str, tuple[list, list]]
    min_words: int = 50
    max_repeat_percent: int = 50
    min_class_chars: int = 400
    min_common_words: int = 80
    max_class_distance: float = 0.17
    class_slack: float = 1.6
    max_word_distance: float = 0.42
    word_slack: float = 3.0

    def __call__(self, words: np.ndarray, repeats: np.ndarray, classes: np.ndarray, common: np.ndarray) -> tuple:
        """(base_failed, nearest language, word distance, class distance, kept)."""
        n = len(words)
        best, name, near, far = np.full(n, np.inf), np.full(n, None, object), np.zeros(n), np.zeros(n)
        for k in sorted(self.references):
            held = np.array(self.references[k][1], float)[_OF[k]]
            d = js_distance(common[:, _OF[k]], held)
            # the more of its words are the language's, the nearer: one chance hit doesn't decide
            rank = d - common[:, _OF[k]].sum(1) / np.maximum(words, 1)
            won = rank < best
            best, near = np.where(won, rank, best), np.where(won, d, near)
            name[won] = k
        for k in self.references:
            own = name == k
            if own.any():
                far[own] = js_distance(classes[own], np.array(self.references[k][0], float))
        bad = (words < self.min_words) | (100 * repeats > self.max_repeat_percent * words)
        chars = classes.sum(1)
        odd = (far > self.max_class_distance + self.class_slack / np.sqrt(np.maximum(chars, 1))) & (chars >= self.min_class_chars)
        odd |= (near > self.max_word_distance + self.word_slack / np.sqrt(np.maximum(words, 1))) & (words >= self.min_common_words)
        return bad, name, near, far, ~bad & ~(odd & bool(self.references))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_class_chars: int = 400,
    min_common_words: int = 80,
    max_class_distance: float = 0.17,
    class_slack: float = 1.6,
    max_word_distance: float = 0.42,
    word_slack: float = 3.0,
    references: dict[str, tuple[list, list]] | None = None,
) -> DataFrame:
    """One row per row of docs: doc_id, the base counts, base_failed, kept, nearest_lang, word_distance, class_distance.

    kept: the base rules hold and neither distance passes its limit, which is wider for short texts, as their histograms
    scatter: max_class_distance + class_slack / sqrt(characters), and likewise for words. The class rule abstains under min_class_chars
    characters, the word rule under min_common_words words; an abstaining rule keeps. A text in a language without a
    reference is held against the nearest one all the same, and rejected where it is far from it. Without any reference (an empty
    table, or no known language) only the base rules decide. Null texts count as empty and so fail the base rules; a
    null doc_id stays null; repeated rows each get a row. Statistics are written once to the shared folder.
    """
    stats = cut(document_stats(docs, id_col, text_col))
    refs = language_references(stats, docs, id_col, lang_col) if references is None else references
    judge = Judge(refs, min_words, max_repeat_percent, min_class_chars, min_common_words, max_class_distance, class_slack, max_word_distance, word_slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {f: b.column(i) for i, f in enumerate(b.schema.names)}
            wide = [np.array(col[c].flatten(), float).reshape(b.num_rows, -1) for c in ("classes", "common")]
            bad, name, near, far, kept = judge(np.array(col["n_words"]), np.array(col["n_repeat_words"]), *wide)
            out = [col[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(bad), pa.array(kept), pa.array(name, pa.string()), pa.array(near), pa.array(far)], names=names)

    kind = dict(stats.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, nearest_lang string, word_distance double, class_distance double"
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]
    return stats.mapInArrow(run, schema)


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs without the rows that quality_rules rejects, every column as it was.

    Rows are written once with their statistics, which give the references and then the verdict, so texts are counted
    once and not shuffled. Null and empty texts fail the base rules and go; rows without an id and repeated rows are judged
    each; empty table: empty result.
    """
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.schema.names.index(at[text_col])
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                yield pa.RecordBatch.from_arrays([*part.columns, *_stats([t or "" for t in part.column(text).to_pylist()])], names=names)

    schema = ", ".join([*(f"{c} {kind}" for c, kind in renamed.dtypes), STATS])
    names = [*renamed.columns, *(x.split(" ")[0] for x in STATS.split(", "))]
    wide = cut(renamed.mapInArrow(run, schema))
    ids = wide.withColumn("doc_id", F.col(at[id_col]))
    langs = wide.select(F.col(at[id_col]).alias(id_col), F.col(at[lang_col]).alias(lang_col))
    judge = Judge(language_references(ids, langs, id_col, lang_col))

    @F.pandas_udf("boolean")
    def keep(words: pd.Series, repeats: pd.Series, classes: pd.Series, common: pd.Series) -> pd.Series:
        wide = [np.array(c.tolist(), float).reshape(len(c), -1) for c in (classes, common)]
        return pd.Series(judge(words.to_numpy(), repeats.to_numpy(), *wide)[-1])

    return wide.where(keep("n_words", "n_repeat_words", "classes", "common")).select(*[F.col(at[c]).alias(c) for c in docs.columns])
