"""Words of a text: runs of digits, letters a-z (A-Z lower-cased) and everything beyond ASCII."""

from __future__ import annotations

import zlib

import numpy as np

#: The same definition as a regular expression, for SQL and for offsets; it applies after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b if b in _KEEP else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words as UTF-8. bytes.lower() changes A-Z only; UTF-8 keeps every byte of other letters at 0x80 or more."""
    return (text or "").encode("utf-8", "replace").lower().translate(_FOLD).split()


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, items), np.uint32, len(items)).astype(np.uint64)


_MUL = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and multiplications until every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive words (k of any size: logarithmically many passes)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, span = np.zeros(n, np.uint64), 0, word_hashes + np.uint64(1), 1
    power = mixed(power * _MUL)
    left = k
    while left:
        if left & 1:
            out = mixed(out * _MUL + power[done : done + n])
            done += span
        left >>= 1
        if left:
            power = mixed(power[:-span] * _MUL + power[span:])
            span *= 2
    return out
