"""Operator 12: license scans by an exact set-similarity join of text blocks and templates.

A block is a window of 2 * SPAN words that begins at every SPAN-th word, so every passage of up to SPAN words lies whole in one.
A block meets a template if it holds at least t of the template's distinct words, t being THRESHOLD of them rounded up.

Words of templates are numbered by how many documents have them, rarest first. A block that meets a template of m words
holds one of the m - t + 1 rarest (prefix filter), has at least t words of templates (length filter), and from the rarest shared
word on both have enough words left (positional filter). What passes is counted exactly, so the filters lose nothing. The
prefixes are rare words, so nearly all documents end at the first test. Templates are a parameter of bounded size; texts aren't
shuffled, and nothing but the count of words leaves a task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import texts

#: Words in a step from block to block; a block has twice as many.
SPAN = 40
#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.85

#: What is no part of a word (fixed value).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose every place counts, and their labels (fixed values).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: (label, wording) of licenses' notices, none longer than SPAN words.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "No part of this publication may be reproduced, stored in a retrieval system, or transmitted in any form or by any means without the prior written permission of the publisher"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words_of(text: str) -> list[str]:
    """The words of a short text, A-Z lowered."""
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def needed(m: int, threshold: float) -> int:
    """Words of a template of m distinct ones that a block must hold."""
    return max(1, math.ceil(round(threshold * m, 9)))


def split_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words): the words of every whole text, A-Z lowered; a null text has none."""
    d = texts(docs, id_col, text_col)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.translate(F.coalesce("text", F.lit("")), upper, lower)
    return d.select("doc_id", F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("words"))


def frequency_order(words: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """vocabulary, rarest word first by the documents of `words` that have it; ties by the word."""
    held = F.array_intersect("words", F.array(*[F.lit(w) for w in sorted(set(vocabulary))]))
    counts = {r["w"]: r["count"] for r in words.select(F.explode(held).alias("w")).groupBy("w").count().collect()}
    return sorted(set(vocabulary), key=lambda w: (counts.get(w, 0), w))


def _phrase_places(phrase: str) -> Column:
    """Numbers of the words that begin a phrase."""
    parts = phrase.split()
    at = lambda i, k: F.get("words", i + k) == parts[k]
    hit = lambda w, i: F.when((w == parts[0]) & at(i, 1) & (at(i, 2) if len(parts) > 2 else F.lit(True)), i)
    places = F.filter(F.transform("words", hit), lambda i: i.isNotNull())
    return F.when(F.array_contains("words", parts[0]) & F.array_contains("words", parts[-1]), places).otherwise(F.array().cast("array<int>"))


def _matches(order: list[str], templates: Sequence[tuple[str, str]], span: int, threshold: float) -> Column:
    """array<struct<t: template, share>> of the templates that a block of `words` meets, one entry for each block and template."""
    rank = {w: k for k, w in enumerate(order)}
    sets = [sorted({rank[w] for w in words_of(text)}) for _, text in templates]
    need = [needed(len(s), threshold) for s in sets]
    #: for each rare word, the templates that it is a prefix word of, and its place in each
    prefix: dict[int, list[tuple[int, int]]] = {}
    for t, s in enumerate(sets):
        for place, r in enumerate(s[: len(s) - need[t] + 1]):
            prefix.setdefault(r, []).append((t, place))
    rare = sorted(prefix)
    if not rare:
        return F.array().cast("array<struct<t:int,share:double>>")
    ints = lambda xs: F.array(*[F.lit(x) for x in xs])
    all_sets, sizes, needs = F.array(*[ints(s) for s in sets]), ints(map(len, sets)), ints(need)
    lists = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("place")) for t, p in prefix[r]]) for r in rare])
    # where rare words stand: array_position finds a word's place in the short list, 0 for others
    names = ints([order[r] for r in rare])
    places = F.filter(F.transform("words", lambda w, i: F.struct(F.array_position(names, w).cast("int").alias("k"), i.alias("i"))), lambda x: x["k"] > 0)
    # a word lies in the block of its own step and in the one before
    step = lambda x: (x["i"] / span).cast("int")
    at_blocks = F.flatten(F.transform(places, lambda x: F.transform(F.when(step(x) > 0, F.array(step(x) - 1, step(x))).otherwise(F.array(step(x))), lambda b: F.struct(b.alias("b"), x["k"].alias("k")))))
    # ranks of the template words of a block, rarest first
    vocabulary = ints(order)
    ranks = lambda b: F.array_sort(F.transform(F.array_intersect(F.slice("words", b * span + 1, F.lit(2 * span)), vocabulary), lambda w: (F.array_position(vocabulary, w) - 1).cast("int")))
    blocks = F.transform(F.array_distinct(at_blocks), lambda x: F.struct(x["k"].alias("k"), ranks(x["b"]).alias("r")))

    def met(x: Column) -> Column:
        """Candidates of one block and one rare word: templates that pass the filters, counted."""
        own = F.array_position(x["r"], F.get(ints(rare), x["k"] - 1))  # from 1

        def passes(c: Column) -> Column:
            n, m = F.size(x["r"]), F.get(sizes, c["t"])
            left = F.least(m - c["place"], n - own.cast("int") + 1)
            return (n >= F.get(needs, c["t"])) & (left >= F.get(needs, c["t"]))

        counted = F.transform(F.filter(F.get(lists, x["k"] - 1), passes), lambda c: F.struct(c["t"].alias("t"), F.size(F.array_intersect(x["r"], F.get(all_sets, c["t"]))).alias("n")))
        return F.transform(F.filter(counted, lambda c: c["n"] >= F.get(needs, c["t"])), lambda c: F.struct(c["t"].alias("t"), (c["n"] / F.get(sizes, c["t"])).alias("share")))

    found = F.flatten(F.transform(blocks, met))
    return F.when(F.arrays_overlap("words", names), found).otherwise(F.array().cast("array<struct<t:int,share:double>>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, span: int = SPAN, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_matches.

    n_base counts the places of PHRASES, first_word and last_word are their smallest and largest start (null without any).
    labels are the phrases' and those of the templates that a block meets, distinct, sorted, comma-joined ('' if none). score is 1
    with a phrase, else the greatest share of a template that a block holds, where it is met, else 0. n_matches counts
    pairs of a template and a met block's rare word.

    Null and empty texts have no words and no labels. Repeated rows each get a row, a null id stays null; other columns of docs
    aren't read. Empty table: empty result. Texts of any length are looked at whole. A template may have span words at most.
    """
    for _, text in templates:
        if not 0 < len(words_of(text)) <= span:
            raise ValueError(f"a template must have 1 to {span} words: {text}")
    words = split_words(docs, id_col, text_col)
    order = frequency_order(words, [w for _, text in templates for w in words_of(text)])
    places = words.select("doc_id", F.size("words").cast("long").alias("n_words"), *[_phrase_places(p).alias(f"p{k}") for k, (p, _) in enumerate(PHRASES)], _matches(order, templates, span, threshold).alias("met"))
    return _summed(places, [label for label, _ in templates])


def _summed(places: DataFrame, labels: list[str]) -> DataFrame:
    every = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    none = F.array().cast("array<string>")
    base = F.array_sort(F.array_distinct(F.concat(*[F.when(F.size(f"p{k}") > 0, F.array(F.lit(label))).otherwise(none) for k, (_, label) in enumerate(PHRASES)])))
    names = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    more = F.transform("met", lambda x: F.get(names, x["t"]))
    best = F.coalesce(F.array_max(F.transform("met", lambda x: x["share"])), F.lit(0.0))
    join = lambda a: F.concat_ws(",", a)
    out = places.select("doc_id", "n_words", every.alias("every"), base.alias("base"), more.alias("more"), best.alias("best"), F.size("met").cast("long").alias("n_matches"))
    return out.select(
        "doc_id", "n_words", F.size("every").cast("long").alias("n_base"), F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"), join(F.col("base")).alias("base_labels"),
        join(F.array_sort(F.array_distinct(F.concat("base", "more")))).alias("labels"), F.when(F.size("base") > 0, 1.0).otherwise(F.col("best")).alias("score"), "n_matches",
    )
