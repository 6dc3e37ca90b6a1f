"""Hashed character n-grams of many texts at once.

Texts are lower-cased and every character that is neither letter nor (optionally)
digit becomes a blank.  A gram may begin or end with a blank (a word's edge) but has
none inside, and none crosses texts.  Grams are hashed to ``2 ** bits`` buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_CHARS = 1 << 20
_KINDS: dict[bool, np.ndarray] = {}
_ODD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)


def _kept(digits: bool) -> np.ndarray:
    if digits not in _KINDS:
        test = str.isalnum if digits else str.isalpha
        ok = np.zeros(0x110000, dtype=bool)
        for low, high in ((0, 0xD800), (0xE000, 0x110000)):
            ok[low:high] = [test(chr(c)) for c in range(low, high)]
        _KINDS[digits] = ok
    return _KINDS[digits]


def text_blocks(texts: list[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts with about ``limit`` characters, at least one text each."""
    a = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def padded(texts: list[str | None], digits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(characters, offsets): each text lower-cased, cleaned, with a blank at both ends."""
    low = [" " + (t or "").lower() + " " for t in texts]
    chars = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    chars = np.where(_kept(digits)[chars], chars, np.uint32(32))
    sizes = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    return chars, np.append(0, np.cumsum(sizes))


def grams(chars: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, buckets) of all valid grams of length ``n``.

    Every text begins and ends with a blank, so a gram that crosses texts has two
    blanks in a row inside and is never valid.
    """
    size = len(chars) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = chars == 32
    ok = np.ones(size, dtype=bool)
    for j in range(1, n - 1):
        ok &= ~blank[j : j + size]
    if n <= 2:
        ok &= ~(blank[:size] & blank[n - 1 :][:size])
    else:
        pass  # the inner characters are letters already
    total = np.full(size, (n * 0x632BE59B) & 0xFFFFFFFF, dtype=np.uint32)
    for j in range(n):
        total *= np.uint32(_ODD[j % len(_ODD)])
        total += chars[j : j + size]
        total ^= total >> np.uint32(15)
    total *= np.uint32(0x2C1B3C6D)
    total ^= total >> np.uint32(13)
    at = np.flatnonzero(ok)
    return at, (total[at] >> np.uint32(32 - bits)).astype(np.int64)
