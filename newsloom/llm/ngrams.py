"""Hashed character n-grams of whole texts, computed with numpy over code points."""

from __future__ import annotations

import numpy as np

#: Odd multipliers that mix the characters of an n-gram; fixed so that models stay readable.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)
SPACE = np.uint32(32)

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """True at every code point that is a letter; built once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def letter_codes(text: str | None) -> np.ndarray:
    """Lower-cased code points, each run of other characters as one blank, a blank at both ends.

    A text without a letter gives an empty array.
    """
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[raw]
    if not letters.any():
        return np.empty(0, dtype=np.uint32)
    before = np.empty_like(letters)
    before[0] = True
    before[1:] = letters[:-1]
    keep = letters | before
    codes = np.where(letters, raw, SPACE)[keep]
    return np.concatenate(([SPACE], codes, [SPACE]))


def grams(codes: np.ndarray, size: int, bits: int, whole_words: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Hash buckets of all n-grams of one size, and their start places if only some are kept.

    With `whole_words`, an n-gram may touch a blank at its ends but not cross one.
    """
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64) if whole_words else None
    mixed = np.full(n, size, dtype=np.uint32)
    for i in range(size):
        mixed ^= codes[i : i + n]
        mixed *= MIX[i]
        mixed ^= mixed >> np.uint32(15)
    buckets = (mixed >> np.uint32(32 - bits)).astype(np.int64)
    if not whole_words:
        return buckets, None
    blank = codes == SPACE
    crossed = np.zeros(n, dtype=bool)
    for i in range(1, size - 1):
        crossed |= blank[i : i + n]
    places = np.flatnonzero(~crossed)
    return buckets[places], places
