"""Similarity of texts by matching blocks (the ratio of Python's difflib), for many pairs at once.

The longest common block of a pair, then those to its left and right, and so on. All pairs go a step at a time: the
blocks sought in a wave are rows of one table, in which the lengths of common runs grow along the first text. Of equally long blocks
the one that begins first in the first text counts, then in the second. Characters that fill more than a hundredth of a second
text of 200 or more begin no block, they only extend one.
"""

from __future__ import annotations

import numpy as np

#: Cells of a wave's table, at most (but for single pairs of very long texts).
CELLS = 1 << 18
_NONE, _POPULAR = 0xFFFFFFFF, 0xFFFFFFFE
_LONG = 200


def _matrix(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    size = np.array([len(c) for c in codes], np.int64)
    out = np.full((len(codes), int(size.max(initial=0)) + 1), pad, np.uint32)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = np.concatenate(codes) if codes else 0
    return out, size


def _starters(b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The second texts without characters that begin no block."""
    out = b
    for k in np.flatnonzero(size >= _LONG).tolist():
        kinds, at, n = np.unique(b[k, : size[k]], return_inverse=True, return_counts=True)
        if (n > size[k] // 100 + 1).any():
            out = out.copy() if out is b else out
            out[k, : size[k]][(n > size[k] // 100 + 1)[at]] = _POPULAR
    return out


def _longest(a: np.ndarray, b: np.ndarray, start: np.ndarray, pair: np.ndarray, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, length) of the longest common block of each window."""
    width = int((bhi - blo).max())
    cols = blo[:, None] + np.arange(width)
    window = np.where(cols < bhi[:, None], start[pair[:, None], np.minimum(cols, b.shape[1] - 1)], _POPULAR)
    size, i_at, j_at = np.zeros(len(pair), np.int64), alo.copy(), blo.copy()
    height = int((ahi - alo).max())
    steps = alo[:, None] + np.arange(height)
    letters = np.ascontiguousarray(np.where(steps < ahi[:, None], a[pair[:, None], np.minimum(steps, a.shape[1] - 1)], _NONE).T)
    small = np.int8 if min(width, height) < 127 else np.int32
    run, now = (np.zeros((len(pair), width + 1), small) for _ in range(2))
    same = np.empty(window.shape, bool)
    for t in range(height):
        np.equal(window, letters[t][:, None], out=same)
        np.add(run[:, :-1], 1, out=now[:, 1:])
        np.multiply(now[:, 1:], same.view(np.int8), out=now[:, 1:])
        most = now.max(axis=1)
        more = np.flatnonzero(most > size)
        if len(more):
            size[more] = most[more]
            i_at[more] = alo[more] + t + 1 - size[more]
            j_at[more] = blo[more] + now[more].argmax(axis=1) - size[more]
        run, now = now, run
    while True:
        grow = (i_at > alo) & (j_at > blo) & (a[pair, i_at - 1] == b[pair, j_at - 1])
        if not grow.any():
            break
        i_at, j_at, size = i_at - grow, j_at - grow, size + grow
    while True:
        grow = (i_at + size < ahi) & (j_at + size < bhi) & (a[pair, np.minimum(i_at + size, a.shape[1] - 1)] == b[pair, np.minimum(j_at + size, b.shape[1] - 1)])
        if not grow.any():
            break
        size = size + grow
    return i_at, j_at, size


def _matched(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Characters in matching blocks."""
    start, total = _starters(b, lb), np.zeros(len(la), np.int64)
    todo = np.stack([np.arange(len(la)), np.zeros_like(la), la, np.zeros_like(lb), lb], axis=1)[(la > 0) & (lb > 0)]
    while len(todo):
        todo = todo[np.lexsort((todo[:, 2] - todo[:, 1], todo[:, 4] - todo[:, 3]))]
        wide, more, s = todo[:, 4] - todo[:, 3], [], 0
        while s < len(todo):
            e = min(len(todo), s + max(1, CELLS // int(wide[s])))
            e = s + max(1, min(e - s, CELLS // int(wide[e - 1])))
            pair, alo, ahi, blo, bhi = todo[s:e].T
            i, j, size = _longest(a, b, start, pair, alo, ahi, blo, bhi)
            np.add.at(total, pair, size)
            more.append(np.stack([pair, alo, i, blo, j], axis=1)[(size > 0) & (alo < i) & (blo < j)])
            more.append(np.stack([pair, i + size, ahi, j + size, bhi], axis=1)[(size > 0) & (i + size < ahi) & (j + size < bhi)])
            s = e
        todo = np.concatenate(more)
    return total


def ratios(first: list[str | None], second: list[str | None]) -> np.ndarray:
    """Whole-percent similarity, from 0 to 1, of each pair; 0 if a text is empty or null."""
    out = np.zeros(len(first))
    real = [k for k, (x, y) in enumerate(zip(first, second, strict=True)) if x and y]
    real.sort(key=lambda k: (len(second[k]), len(first[k])))
    s = 0
    while s < len(real):
        own, most = [], 0
        while s < len(real) and (not own or (len(own) + 1) * max(most, len(first[real[s]]) + len(second[real[s]])) <= 4 * CELLS):
            most = max(most, len(first[real[s]]) + len(second[real[s]]))
            own.append(real[s])
            s += 1
        a, la = _matrix([first[k] for k in own], _NONE)
        b, lb = _matrix([second[k] for k in own], _POPULAR)
        out[own] = np.rint(100 * (2.0 * _matched(a, la, b, lb) / (la + lb))) / 100
    return out
