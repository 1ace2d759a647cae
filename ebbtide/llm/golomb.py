"""Golomb codes of sorted integers (with a power of two as divisor), by numpy.

The differences of n ascending values below ``width`` are divided by 2^k, with k
set from n and ``width`` alone, so that sender and receiver agree on it. First
come all quotients in unary (ones, ended by a zero), then all remainders in k
bits: the two streams let a list be decoded without a loop over its values.
"""

from __future__ import annotations

import numpy as np


def _k(n: int, width: int) -> int:
    return max(0, int(0.69 * width / n).bit_length() - 1)


def encode(values: np.ndarray, width: int) -> bytes:
    """The code of distinct ascending ``values`` from 0 to ``width`` - 1."""
    n = len(values)
    if not n:
        return b""
    k = _k(n, width)
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    ends = np.cumsum((gaps >> k) + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return np.packbits(np.concatenate([unary, rest.astype(np.uint8).ravel()])).tobytes()


def decode(code: bytes, n: int, width: int) -> np.ndarray:
    """The ``n`` values of a code made for ``width``."""
    if not n:
        return np.zeros(0, np.int64)
    k = _k(n, width)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    # n zeros end the quotients; padding and remainders come after them
    ends = np.flatnonzero(bits == 0)[:n] if k == 0 else _first_zeros(bits, n)
    quotients = np.diff(ends, prepend=-1) - 1
    at = int(ends[-1]) + 1
    rest = bits[at : at + n * k].reshape(n, k).astype(np.int64) @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum((quotients << k) + rest + 1) - 1


def _first_zeros(bits: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` zeros, without a search of all remainders."""
    size = 4 * n
    while True:
        found = np.flatnonzero(bits[:size] == 0)
        if len(found) >= n or size >= len(bits):
            return found[:n]
        size *= 2
