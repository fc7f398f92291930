"""Counts over one whole text, for the quality operators."""

from __future__ import annotations

import re

import numpy as np

#: Characters that count as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
#: White space that separates words (fixed value).
SPACE = "\t\n\x0b\x0c\r "
#: Character classes, in the order of the histogram.
CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "ascii_other", "letter_beyond", "other_beyond")

_DROP_SPACE = str.maketrans("", "", SPACE)
_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")


def _class_table() -> np.ndarray:
    """Class of every code point below 0x3000; the last entry stands for all beyond, which are letters mostly."""
    out = np.full(0x3001, 8, np.int64)
    for c in range(0x3000):
        x = chr(c)
        if x in SPACE:
            out[c] = 3
        elif x in SYMBOLS:
            out[c] = 5
        elif x in ".,;:!?'\"()-":
            out[c] = 4
        elif c < 128:
            out[c] = 0 if x.islower() else 1 if x.isupper() else 2 if x.isdigit() else 6
        elif x.isalpha():
            out[c] = 7
    out[-1] = 7
    return out


_TABLE = _class_table()


def class_counts(text: str) -> np.ndarray:
    """Characters of each class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_TABLE[np.minimum(points, 0x3000)], minlength=len(CLASSES))


def words_of(text: str) -> list[bytes]:
    """Maximal runs of characters other than the six of SPACE, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words that is found twice or more, its first place included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    v = len(seen)
    if v == n:
        return 0
    if v < 2_000_000:
        key = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # three ids don't fit 63 bits: number the pairs first
        pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        key = pair[:-1] * v + ids[2:]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= hit
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int, list[bytes]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words)."""
    words = words_of(text)
    lines = [x for x in text.split("\n") if x and not x.isspace()] if words else []
    if any(ord(x[0]) > 127 or "\x1c" <= x[0] <= "\x1f" for x in lines) or len(lines) != text.count("\n") + 1:
        # str.isspace() knows more white space than SPACE, so such lines are looked at again
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(words), len(text.translate(_DROP_SPACE)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated_words(words), words
