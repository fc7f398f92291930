"""Operator 3: token counts by a linear longest-match automaton.

The vocabulary's trie gets failure links and, for each node, how many pieces its link pops. A word's greedy
longest-match length is then the pops of one walk over its characters; no piece is ever built.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tileweave.llm.bpe import byte_characters
from tileweave.llm.common import map_texts, texts

#: Words kept by a worker with their counts, and the longest one kept: bounds of a cache, not of the input.
CACHE, LONGEST = 300_000, 64
#: Word ends are one character in the trie, which no byte is shown as.
END = "\0"


class MatchAutomaton:
    """Greedy longest-match piece counts of words; pieces are strings over characters, END included where a word ends."""

    def __init__(self, pieces: Iterable[str]):
        child: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            at = 0
            for c in piece:
                nxt = child[at].get(c)
                if nxt is None:
                    nxt = child[at][c] = len(child)
                    child.append({})
                    whole.append(False)
                at = nxt
            whole[at] = True
        fail, pops = [-1] * len(child), [0] * len(child)
        level = [(0, c, v) for c, v in child[0].items()]
        while level:
            below = []
            for u, c, v in level:
                if whole[v]:
                    fail[v], pops[v] = 0, 1
                else:
                    z, n = fail[u], pops[u]
                    while z >= 0 and c not in child[z]:
                        n += pops[z]
                        z = fail[z]
                    if z >= 0:
                        fail[v], pops[v] = child[z][c], n
                below.extend((v, x, w) for x, w in child[v].items())
            level = below
        self.child, self.fail, self.pops = child, fail, pops

    def count(self, word: str) -> int:
        """Pieces of word by greedy longest match from the left, or -1 where some rest starts with no piece."""
        child, fail, pops = self.child, self.fail, self.pops
        at = n = 0
        for c in word:
            while (nxt := child[at].get(c)) is None:
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return -1
            at = nxt
        while at:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return -1
        return n


def greedy_count(word: str, pieces: set[str]) -> int:
    """What MatchAutomaton.count gives, by trying every prefix: for tests."""
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def vocabulary(path: str, end: str = "</w>") -> list[str]:
    """Pieces of a tokenizers file with word ends; the end mark becomes END."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return [p[: -len(end)] + END if p.endswith(end) else p for p in vocab if not p.startswith("<|")]


class WordCounter:
    """Counts for whole texts: words and single marks, lowered, as bytes shown as characters."""

    def __init__(self, path: str):
        self.automaton = MatchAutomaton(vocabulary(path))
        self.shown = str.maketrans({chr(b): c for b, c in byte_characters().items()})
        self.split = re.compile(r"\w+|[^\w\s]").findall
        self.kept: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = self.automaton.count(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.shown) + END)
        return 1 if n < 0 else n

    def text(self, text: str) -> tuple[int, int]:
        """(words, pieces); a word that can't be matched is one piece."""
        kept, words = self.kept, self.split(text.lower())
        if len(kept) > CACHE:
            kept.clear()
        total = 0
        for w in words:
            n = kept.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= LONGEST:
                    kept[w] = n
            total += n
        return len(words), total


@lru_cache(2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def token_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every whole text by greedy longest match.

    Texts are lowered and cut into words and single marks. Null and empty texts count 0; repeated rows each get a row.
    """

    def each(values: list[str]) -> list:
        c = counter(vocab_path)
        found = [c.text(t) for t in values]
        return [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]

    return map_texts(texts(docs, id_col, text_col), each, "n_pretokens long, n_tokens long")
