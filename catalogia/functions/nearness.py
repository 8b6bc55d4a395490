"""Edit distance of a query to the windows of a text, bit-parallel over many windows at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Characters whose windows are compared at once.
CHUNK = 500_000
WORD = 64


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _by_words(text: np.ndarray, starts: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Myers' recurrence, one bit per character of a pattern of up to 64, one lane per window."""
    m, one = len(pattern), np.uint64(1)
    equal = np.zeros(len(text), np.uint64)
    for i, c in enumerate(pattern):
        equal[text == c] |= one << np.uint64(i)
    up, down = np.full(len(starts), ~np.uint64(0)), np.zeros(len(starts), np.uint64)
    score, top = np.full(len(starts), m, np.int64), np.uint64(m - 1)
    for i in range(m):
        eq = equal[starts + i]
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(horizontal | up), up & horizontal
        score += ((plus >> top) & one).astype(np.int64) - ((minus >> top) & one).astype(np.int64)
        plus, minus = (plus << one) | one, minus << one
        up, down = minus | ~(vertical | plus), plus & vertical
    return score


def _by_rows(text: np.ndarray, starts: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """The plain recurrence, one lane per window, for patterns of any length."""
    m = len(pattern)
    row = [np.full(len(starts), j, np.int64) for j in range(m + 1)]
    for i in range(m):
        c, before, row[0] = text[starts + i], row[0], np.full(len(starts), i + 1, np.int64)
        for j in range(1, m + 1):
            best = np.minimum(np.minimum(row[j], row[j - 1]) + 1, before + (c != pattern[j - 1]))
            before, row[j] = row[j], best
    return row[m]


def window_distances(text: np.ndarray, starts: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Edit distance of the pattern to ``text[s:s + len(pattern)]`` for each start."""
    if not len(pattern):
        return np.zeros(len(starts), np.int64)
    run, step = (_by_words, CHUNK) if len(pattern) <= WORD else (_by_rows, max(1, CHUNK // 16))
    parts = [run(text, starts[i:i + step], pattern) for i in range(0, len(starts), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def plain_distance(a: str, b: str, limit: int) -> bool:
    """Whether two short texts are within ``limit`` edits."""
    if abs(len(a) - len(b)) > limit:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1] <= limit


def near_windows(texts: list[str | None], query: str, limit: int, starts: list | None = None) -> np.ndarray:
    """Whether each text holds a window of the query's length within ``limit`` edits of it.

    A text shorter than the query is one window; ``starts`` narrows the windows of each text.
    """
    m, pattern = len(query), code_points(query)
    out, held, size = np.zeros(len(texts), bool), [], 0

    def flush():
        rows, parts, lanes, at = [], [], [], 0
        for i, points, own in held:
            lanes.append(own + at)
            rows.append(np.full(len(own), i))
            parts.append(points)
            at += len(points)
        if held:
            hit = window_distances(np.concatenate(parts), np.concatenate(lanes), pattern) <= limit
            out[np.concatenate(rows)[hit]] = True
        held.clear()

    for i, text in enumerate(texts):
        if text is None:
            continue
        points = code_points(text)
        if len(points) < m:
            out[i] = plain_distance(text, query, limit)
            continue
        own = np.arange(len(points) - m + 1)
        if starts is not None:
            own = np.unique(np.asarray(starts[i], np.int64))
            own = own[(own >= 0) & (own <= len(points) - m)]
        held.append((i, points, own))
        size += len(own)
        if size >= CHUNK:
            flush()
            size = 0
    flush()
    return out


def near_window(text: Column, query: str, limit: int) -> Column:
    """``near_windows`` as a boolean column over a text column; null is false."""
    @F.arrow_udf("boolean")
    def near(texts: pa.Array) -> pa.Array:
        return pa.array(near_windows(texts.to_pylist(), query, limit))

    return near(text)
