"""Words of whole texts in numpy: many texts at a time, no loop over words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

BLANK = re.compile(r"[\x09-\x0D\x20]")
#: Characters worked on at a time.
PIECE = 1 << 18
P = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def pieces(texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """``(joined text, starts, owners)``: pieces of about PIECE characters made of whole texts; a
    longer text makes several pieces, which end at white space."""
    parts, starts, owners, size = [], [], [], 0
    for i, t in enumerate(texts):
        start = 0
        while start < len(t):
            end = min(len(t), start + PIECE)
            if end < len(t):
                blank = BLANK.search(t, end)
                end = blank.start() if blank else len(t)
            parts.append(t[start:end])
            starts.append(size)
            owners.append(i)
            size += end - start + 1
            start = end
            if size >= PIECE:
                yield " ".join(parts), np.array(starts), np.array(owners)
                parts, starts, owners, size = [], [], [], 0
    if parts:
        yield " ".join(parts), np.array(starts), np.array(owners)


def lower(c: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 capitals, the rest unchanged (one code point each)."""
    capital = ((c >= 65) & (c <= 90)) | ((c >= 0xC0) & (c <= 0xDE) & (c != 0xD7))
    return np.where(capital, c + 32, c)


def hash_words(c: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words that begin at ``first`` in the letters ``c``."""
    powers = np.cumprod(np.full(int(length.max(initial=0)) + 1, P, dtype=np.uint64))
    within = np.arange(len(c)) - np.repeat(first, length)
    h = np.add.reduceat(c.astype(np.uint64) * powers[within], first) + length.astype(np.uint64)
    return (h ^ (h >> np.uint64(31))) * MIX


def lower_ascii(c: np.ndarray) -> np.ndarray:
    return np.where((c >= 65) & (c <= 90), c + 32, c)


def letters(c: np.ndarray, kind: Callable[[str], bool] = str.isalpha) -> np.ndarray:
    """Which code points are letters (or of another kind); each distinct one is looked up once."""
    present = np.flatnonzero(np.bincount(c)) if len(c) else np.zeros(1, dtype=np.int64)
    table = np.zeros(int(present[-1]) + 1, dtype=bool)
    table[present] = [kind(chr(x)) for x in present]
    return table[c]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def word_runs(c: np.ndarray, letter: np.ndarray, fold: Callable[[np.ndarray], np.ndarray] = lower) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters in lower case, first letter and length of each word, and its position in ``c``."""
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    at = np.flatnonzero(begins)
    low = fold(c[letter])
    first = np.cumsum(letter)[at] - 1
    return low, first, np.diff(np.append(first, len(low))), at


def hashed_words(texts: list[str], kind: Callable[[str], bool] = str.isalnum,
                 fold: Callable[[np.ndarray], np.ndarray] = lower) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, owners)`` of all words (runs of characters of a kind, case folded), text by text."""
    found = [(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))]
    for text, starts, owners in pieces(texts):
        c = code_points(text)
        low, first, length, at = word_runs(c, letters(c, kind), fold)
        if len(first):
            found.append((hash_words(low, first, length), owners[np.searchsorted(starts, at, side="right") - 1]))
    words, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    return words, owner


def hashed_shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one sequence."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        h = (h ^ words[j:j + n]) * P
        h ^= h >> np.uint64(32)
    return h * MIX
