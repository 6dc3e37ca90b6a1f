"""Vectorised pre-tokenisation and byte-level BPE ids over cached pre-tokens.

The pattern of the public rank files cuts a text into pre-tokens that are encoded
independently.  ``boundaries`` finds the cuts of many texts at once with numpy
character classes; each distinct pre-token is then encoded once by the tokenizer
library and kept in a bounded cache.  Texts with characters beyond
``PLAIN_LIMIT`` are left to the library itself, so that its own Unicode tables
decide there.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable

import numpy as np

from .common import span_hashes

PLAIN_LIMIT = 0x250  # Basic Latin .. Latin Extended-B
CACHE_ENTRIES = 1_000_000  # distinct pre-tokens kept by a worker, about 80 bytes each
BLOCK_CHARS = 1 << 21  # characters worked on at once
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# White_Space code points below PLAIN_LIMIT (fixed values of the Unicode property).
_WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0)


def _classes() -> np.ndarray:
    out = np.full(PLAIN_LIMIT, _OTHER, dtype=np.uint8)
    for cp in range(PLAIN_LIMIT):
        kind = unicodedata.category(chr(cp))[0]
        out[cp] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    out[list(_WHITE)] = _SPACE
    return out


CLASSES = _classes()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def is_plain(cps: np.ndarray) -> bool:
    return len(cps) == 0 or int(cps.max()) < PLAIN_LIMIT


def boundaries(cps: np.ndarray, row_starts: np.ndarray | None = None) -> np.ndarray:
    """Start positions of all pre-tokens of concatenated plain texts.

    ``row_starts`` are the positions where a new text begins (no pre-token
    crosses them).
    """
    n = len(cps)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = CLASSES[cps]
    fresh = np.zeros(n + 1, dtype=bool)  # a new text begins here (or all have ended)
    fresh[0] = fresh[n] = True
    if row_starts is not None:
        fresh[row_starts] = True
    start = fresh[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    # a blank right before a word, number or symbol run belongs to that run
    space = cls == _SPACE
    last_space = space.copy()  # last white space of a run that is followed by something
    last_space[:-1] &= ~space[1:]
    last_space &= ~fresh[1:]
    glued = last_space & (cps == 0x20)
    after = np.flatnonzero(glued) + 1
    start[after] = False
    start |= last_space  # the last one leaves its run, glued or alone
    # after a lone last white space (not a blank) the class change already starts the run
    quote = np.flatnonzero((cps == 0x27) & start)
    if len(quote):
        at = lambda k: np.where(quote + k < n, cps[np.minimum(quote + k, n - 1)], 0)
        cut = lambda k: fresh[np.minimum(quote + k, n)]
        a, b = at(1), at(2)
        a = np.where(cut(1), 0, a)
        b = np.where(cut(1) | cut(2), 0, b)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))
        two |= (a == ord("l")) & (b == ord("l"))
        for hit, width in ((one, 2), (two & ~one, 3)):
            q = quote[hit]
            start[q + 1] = False
            if width == 3:
                start[q + 2] = False
            rest = q + width
            rest = rest[rest < n]
            # what follows a contraction begins anew unless it is a glued symbol run
            start[rest] = True
    return np.flatnonzero(start)


class PieceCache:
    """Token ids of distinct pre-tokens, found by a 64-bit key of their characters."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self._encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self._index()

    def _index(self) -> None:
        bits = max(16, int(len(self.keys) * 4).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        self.slots[(self.keys & self.mask).astype(np.int64)] = np.arange(len(self.keys))
        order = np.argsort(self.keys)
        self.sorted_keys, self.order = self.keys[order], order

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where unknown."""
        if len(self.keys) == 0:
            return np.full(len(keys), -1, np.int64)
        hit = self.slots[(keys & self.mask).astype(np.int64)].astype(np.int64)
        wrong = np.flatnonzero((hit < 0) | (self.keys[np.maximum(hit, 0)] != keys))
        if len(wrong):
            k = keys[wrong]
            pos = np.minimum(np.searchsorted(self.sorted_keys, k), len(self.sorted_keys) - 1)
            hit[wrong] = np.where(self.sorted_keys[pos] == k, self.order[pos], -1)
        return hit

    def add(self, keys: np.ndarray, pieces: list[str]) -> None:
        lists = self._encode(pieces)
        count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        ids = np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(count.sum()))
        first = len(self.ids) + np.cumsum(count) - count
        self.keys = np.concatenate([self.keys, keys])
        self.first = np.concatenate([self.first, first])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])
        self._index()


def piece_keys(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each pre-token; plain characters take two bytes."""
    return span_hashes(cps.astype("<u2").view(np.uint8), 2 * starts, 2 * ends)


def encode_plain(texts: list[str], cache: PieceCache) -> list[np.ndarray]:
    """Ids (uint32) of each plain text, through the cache of pre-tokens."""
    joined = "".join(texts)
    cps = code_points(joined)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    row_end = np.cumsum(sizes)
    row_start = row_end - sizes
    if len(cps) == 0:
        return [np.zeros(0, np.uint32) for _ in texts]
    starts = boundaries(cps, row_start[row_start < len(cps)])
    ends = np.append(starts[1:], len(cps))
    keys = piece_keys(cps, starts, ends)
    entry = cache.lookup(keys)
    missing = np.flatnonzero(entry < 0)
    if len(missing):
        new, where = np.unique(keys[missing], return_index=True)
        if len(cache.keys) + len(new) > CACHE_ENTRIES:  # start over with this block's own
            cache.clear()
            missing = np.arange(len(keys))
            new, where = np.unique(keys, return_index=True)
        cache.add(new, [joined[starts[i] : ends[i]] for i in missing[where]])
        entry = cache.lookup(keys)
    count = cache.count[entry]
    total = np.cumsum(count)
    out_first = total - count
    # token t of the block comes from cache.ids[first[entry] + (t - out_first)]
    shift = np.repeat(cache.first[entry] - out_first, count)
    ids = cache.ids[shift + np.arange(len(shift))]
    # pre-tokens before each row edge -> tokens before it
    upto = np.append(0, total)
    cut_a = upto[np.searchsorted(starts, row_start)]
    cut_b = upto[np.searchsorted(starts, row_end)]
    return [ids[a:b] for a, b in zip(cut_a, cut_b)]


def encode_texts(
    texts: list[str], cache: PieceCache, library: Callable[[str], list[int]]
) -> list[np.ndarray]:
    """Ids of each text: plain ones through the cache, the others by the library itself."""
    out: list[np.ndarray] = [None] * len(texts)
    run, size = [], 0
    for i, text in enumerate(texts):
        if text.isascii() or is_plain(code_points(text)):
            run.append(i)
            size += len(text)
        else:
            out[i] = np.asarray(library(text), dtype=np.uint32)
        if run and (size >= BLOCK_CHARS or i == len(texts) - 1):
            for k, ids in zip(run, encode_plain([texts[k] for k in run], cache)):
                out[k] = ids
            run, size = [], 0
    for k, ids in zip(run, encode_plain([texts[k] for k in run], cache) if run else []):
        out[k] = ids
    return out


def rank_table(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: one base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, file)}
