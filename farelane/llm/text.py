"""Texts as arrays of code points, so that whole batches are handled at once."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points handled at a time; a longer text is cut after a letter that white space follows.
CHUNK = 1 << 18
#: Odd multiplier of the polynomial word hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point: letter (L*), number (N*), Unicode white space, other."""
    first = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((first.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    white = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[white] = SPACE
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def cut(text: str, most: int = CHUNK) -> Iterator[str]:
    """Pieces of a text; each but the first starts with white space that follows a letter."""
    at = 0
    while len(text) - at > most:
        end = at + most
        while end < len(text) and not (text[end].isspace() and text[end - 1].isalpha()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (text number, piece) of about ``most`` code points."""
    who: list[int] = []
    what: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        for piece in cut(text, most):
            if what and held + len(piece) > most:
                yield who, what
                who, what, held = [], [], 0
            who.append(i)
            what.append(piece)
            held += len(piece)
    if what:
        yield who, what


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(2)
def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(n, BASE), powers(n, INVERSE)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def span_hashes(cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of code points; equal spans have equal hashes."""
    size = 1 << max(10, int(len(cps)).bit_length())
    up, down = _power_table(size)
    total = np.zeros(len(cps) + 1, np.uint64)
    np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * up[: len(cps)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gather(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of all spans one after another."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - before, length)
