"""Golomb-Rice coding of sorted integers, vectorised.

Differences are split into a quotient, written in unary, and a remainder of
fixed width; the two streams are kept apart so that both decode without a
bit-by-bit loop."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBQ")  # how many, remainder bits, first value


def encode(values: np.ndarray) -> bytes:
    """``values``: sorted uint64, at most 2**32 - 1 of them."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0)
    steps = np.diff(values.astype(np.uint64))
    mean = int(values[-1] - values[0]) // max(1, n - 1)
    width = max(0, mean.bit_length() - 1)
    quotients = (steps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n - 1, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(width, dtype=np.uint64)
    rest = ((steps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return _HEAD.pack(n, width, int(values[0])) + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def decode(blob: bytes) -> np.ndarray:
    n, width, first = _HEAD.unpack_from(blob)
    if n == 0:
        return np.zeros(0, np.uint64)
    body = np.frombuffer(blob, np.uint8, offset=_HEAD.size)
    rest_bytes = ((n - 1) * width + 7) // 8
    ones = np.flatnonzero(np.unpackbits(body[: len(body) - rest_bytes]))[: n - 1]
    quotients = np.diff(np.concatenate([[-1], ones])) - 1
    steps = quotients.astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(body[len(body) - rest_bytes :])[: (n - 1) * width].reshape(n - 1, width)
        steps |= (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.concatenate([[np.uint64(first)], np.uint64(first) + np.cumsum(steps, dtype=np.uint64)])
