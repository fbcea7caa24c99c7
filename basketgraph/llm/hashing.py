"""Vectorised 64-bit hashing of byte ranges.

``Ranges`` is a polynomial modulo 2 ** 64: quick, but texts can be built that collide under it, so it may only bring
things together that are compared afterwards. What decides whether two strings are equal goes by ``keyed``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

#: Key of the SipHash that decides equality; a user who expects texts built against it sets another one.
KEY = "basketgraph.2025"
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n."""
    if _POWERS.get("n", 0) < n:
        up, down = np.full(n, BASE), np.full(n, _INVERSE)
        up[0] = down[0] = 1
        _POWERS.update(n=n, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Ranges:
    """Hashes of any ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])]

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[begin]) * self.down[begin])


def keyed(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """SipHash under ``KEY`` of strings of ``size`` bytes that follow each other in ``flat``; each distinct string is hashed once."""
    if not len(size):
        return np.zeros(0, np.uint64)
    offsets = np.r_[0, np.cumsum(size)].astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()
    return keyed_strings(np.array(coded.dictionary.to_pylist(), dtype=object))[coded.indices.to_numpy(zero_copy_only=False)]


def keyed_strings(strings: np.ndarray) -> np.ndarray:
    """SipHash under ``KEY`` of an object array of bytes."""
    return hash_array(strings, hash_key=KEY, categorize=False)
