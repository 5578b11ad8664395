"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from weblode.llm.common import mix64

_BYTES = np.arange(256)
#: Lower-cases A-Z and nothing else.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of words that white space (space, tab to carriage return) separates.
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: Bytes of words made of ASCII letters and digits and everything beyond ASCII.
ALNUM = (
    ((_BYTES >= 48) & (_BYTES <= 57))
    | ((_BYTES >= 65) & (_BYTES <= 90))
    | ((_BYTES >= 97) & (_BYTES <= 122))
    | (_BYTES >= 128)
)

_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words in text order. ``row`` is the text a word is of, ``first`` the
    index of each text's first word (one more entry than texts)."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def find_words(raw: np.ndarray, at: np.ndarray, of_word: np.ndarray) -> Words:
    """Maximal runs of bytes for which the table ``of_word`` is true; a word
    never crosses from one text to the next."""
    n = len(raw)
    inside = of_word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < n]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = at[1:][at[1:] > 0] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(start, end, row, first)


def hash_words(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    low = np.zeros(len(size), np.int64)
    np.cumsum(size[:-1], out=low[1:])
    within = np.arange(int(size.sum())) - np.repeat(low, size)
    bytes_ = raw[within + np.repeat(start, size)]
    values = _TABLE[LOWER[bytes_]] * _powers(int(size.max()))[within]
    return mix64(np.add.reduceat(values, low) + size.astype(np.uint64))


def chars_before(raw: np.ndarray) -> np.ndarray:
    """Code points before each byte, and in all at the end."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out
