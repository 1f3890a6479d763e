"""Word boundaries and 64-bit word hashes of a batch of UTF-8 texts, vectorised in numpy.

All separators of the supported word patterns are ASCII, so words can be cut
on bytes: every byte of a multi-byte character is a word byte.
"""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Word bytes of ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Longer words are hashed one by one.
_LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser over uint64, a bijection."""
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z on bytes."""
    return _LOWER[raw]


def cut(data: np.ndarray, off: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte bounds of all words; document i has words ``first[i]:first[i+1]``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = word_bytes[data]
    st, en = w.copy(), w.copy()
    st[1:] &= ~w[:-1]
    en[:-1] &= ~w[1:]
    edge = off[(off > 0) & (off < len(data))]
    st[edge] = w[edge]
    en[edge - 1] = w[edge - 1]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    return starts, ends, np.searchsorted(starts, off)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = ends - starts
    h = n.astype(np.uint64) * _C1
    if not len(n):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    load = np.ndarray((len(data) + 1,), "<u8", buffer=padded.data, strides=(1,))
    live = np.arange(len(n))
    for k in range(0, min(int(n.max()), _LONG), 8):
        if k:
            live = live[n[live] > k]
        left = np.minimum(n[live] - k, 8).astype(np.uint64)
        v = load[starts[live] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        h[live] = mix((h[live] ^ v) * _C1 + _C2)
    for i in np.flatnonzero(n > _LONG):
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return h


_K = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(h: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)`` of all ``width``-word shingles by document, in text order.

    A document with fewer words, but not none, has its whole sequence as its
    only shingle; one without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    mult = _K[:width] if width <= len(_K) else mix(np.arange(1, width + 1, dtype=np.uint64) * _C1) | np.uint64(1)
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], count)
    out = np.zeros(len(at), np.uint64)
    short = np.repeat(n < width, count)
    whole = at[~short]
    for j in range(width):
        out[~short] += h[whole + j] * mult[j]
    for i in np.flatnonzero((n > 0) & (n < width)):
        part = h[first[i] : first[i + 1]]
        out[bounds[i]] = ((part * mult[: len(part)]).sum(keepdims=True) + np.array([len(part)], np.uint64) * _C3)[0]
    return mix(out), bounds
