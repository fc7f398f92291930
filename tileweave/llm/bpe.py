"""Operator 9: byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Texts are cut by the pattern into pieces. The bytes of a piece become visible characters, one each, which the library's
BPE model turns into tokens with ids and offsets; a worker keeps the ids of pieces and words that it has met. Decoding looks every
id up in the byte table; a token may hold part of a character, so bytes are joined before they are read as UTF-8.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import map_texts, texts

#: Pieces kept by a worker, and the longest one kept, in characters: bounds of a cache, not of the input.
CACHE, LONGEST = 700_000, 64
#: The pattern for which words may be looked up whole (fixed value), and the white-space runs that rule it out.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RUN = re.compile(r" \s|\s |\s\s\s|\s\s\Z")


def byte_characters() -> dict[int, str]:
    """The visible character of each byte in byte-level vocabularies: itself if printable, else 256 and up in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class ByteCodec:
    """Encoder and decoder of one vocabulary: a file of base64 tokens and ranks, one pair a line."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        from tokenizers import models

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        to = byte_characters()
        self.characters = {b: to[b] for b in range(256)}
        self.table = {i: t for t, i in ranks.items()}
        self.decimal = {i: str(i) for i in self.table}
        shown = {t: "".join(map(to.__getitem__, t)) for t in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and (pair := self._halves(token, rank, ranks)):
                merges.append((shown[pair[0]], shown[pair[1]]))
        self.model = models.BPE({shown[t]: i for t, i in ranks.items()}, merges)
        self.pieces = regex.compile(pattern).findall
        self.plain = pattern == PLAIN
        self.kept: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _halves(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one: what lower-ranked merges leave of its bytes."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            low, at = min(((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(rank, 0))
            if low >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _shown(self, piece: str) -> str:
        """A visible character for each byte of a piece."""
        return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.characters)

    def _ids(self, kept: dict[str, bytes], key: str, pieces: list[str]) -> bytes:
        """Ids of pieces as 32-bit numbers, kept under key."""
        ids = array("i", [t.id for p in pieces for t in self.model.tokenize(self._shown(p))]).tobytes()
        if len(key) <= LONGEST:
            if len(kept) >= CACHE:
                kept.clear()
            kept[key] = ids
        return ids

    def encode_array(self, text: str) -> np.ndarray:
        """Ids of the whole text.

        Where the pattern is PLAIN and the text has no white-space runs but single characters and pairs without a space, no
        match reaches over a space or line feed from before it, so the text falls into words that are looked up whole.
        Other texts and patterns are looked up piece by piece.
        """
        first, kept, keys = [], self.kept, None
        if self.plain and not _RUN.search(text):
            kept = self.words
            head, *keys = text.replace("\n", " \n").split(" ")
            first = [self._ids({}, head, self.pieces(head))]
        else:
            keys = self.pieces(text)
        found = list(map(kept.get, keys))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    w = keys[k]
                    whole = [w] if kept is self.kept else self.pieces(w if w[:1] == "\n" else " " + w)
                    found[k] = kept.get(w) or self._ids(kept, w, whole)
        return np.frombuffer(b"".join(first + found), np.int32)

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text."""
        return self.encode_array(text).tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The bytes of ids; unknown ids raise KeyError."""
        return b"".join(map(self.table.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that aren't whole characters become the replacement character."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """For each id, the characters of text that it covers, by the library's offsets: [start, end); of a split character, all of its ids."""
        starts = [i for i, c in enumerate(text) for _ in c.encode("utf-8", "surrogatepass")]
        out, at = [], 0
        for p in self.pieces(text):
            shown = self._shown(p)
            # the library counts the UTF-8 bytes of the visible characters
            place = [k for k, c in enumerate(shown) for _ in c.encode()]
            out.extend((starts[at + place[t.offsets[0]]], starts[at + place[t.offsets[1] - 1]] + 1) for t in self.model.tokenize(shown))
            at += len(shown)
        return out


@lru_cache(2)
def codec(ranks_path: str, pattern: str) -> ByteCodec:
    return ByteCodec(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """(doc_id, ids, and starts and ends in characters if offsets): tokens of every whole text.

    Null and empty texts have empty lists; repeated rows each get a row, a null doc_id stays null; empty table: empty result.
    """

    def each(values: list[str]) -> list:
        c = codec(ranks_path, pattern)
        ids = [pa.array([c.encode_array(t) for t in values], pa.list_(pa.int32()))]
        if offsets:
            spans = [c.offsets(t) for t in values]
            ids += [pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int32())) for k in (0, 1)]
        return ids

    return map_texts(texts(docs, id_col, text_col), each, "ids array<int>" + ", starts array<int>, ends array<int>" * offsets)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the texts that the ids stand for; a null list gives a null text."""
    kind = dict(tokens.dtypes)[id_col]

    def run(batches):
        c = codec(ranks_path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else c.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    ids_sha256: of the decimal ids joined by one space; decoded_sha256: of the bytes that the ids decode to. Null and
    empty texts have no tokens and the digests of nothing; repeated rows each get a row.
    """

    def each(values: list[str]) -> list:
        c, out = codec(ranks_path, pattern), []
        for t in values:
            ids = c.encode(t)
            joined, raw = " ".join(map(c.decimal.__getitem__, ids)), c.decode_bytes(ids)
            out.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()))
        return [pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]

    return map_texts(texts(docs, id_col, text_col), each, "n_tokens long, ids_sha256 string, decoded_sha256 string")
