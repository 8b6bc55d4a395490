"""Lists of whole numbers in as few bytes as each number needs, seven bits a byte."""

from __future__ import annotations

import numpy as np


def packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of numbers from 0, and where each number ends in them; all but its last byte have the top bit set."""
    size = np.ones(len(numbers), np.uint8)
    for bits in range(7, 8 * numbers.itemsize - 1, 7):
        more = numbers >= 1 << bits
        if not more.any():
            break
        size += more
    ends = np.cumsum(size, dtype=np.int64)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for j in range(size.max(initial=0)):
        has = np.flatnonzero(size > j)
        out[ends[has] - size[has] + j] = (numbers[has] >> 7 * j & 127) | (size[has] > j + 1) << 7
    return out, ends


def unpacked(data: bytes) -> np.ndarray:
    """The numbers that ``packed`` made the bytes of."""
    found = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(found < 128) + 1
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(found)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((found & 127).astype(np.int64) << 7 * place, starts)
