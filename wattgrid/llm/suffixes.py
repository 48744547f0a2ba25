"""Two-stage suffix sorting of a bounded text, and common prefixes of neighbours.

Suffixes that are smaller than their successor are sorted directly; all others
are put in place by one scan over the buckets of first characters."""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix of ``text``: is it smaller than the one that starts one
    place later?  Equal characters take the answer of the next place; the last
    suffix is greater than the empty one."""
    n = len(text)
    up = np.zeros(n, bool)
    if n > 1:
        differs = np.append(text[:-1] != text[1:], True)
        # The next place at or after i whose character differs from its successor.
        at = np.where(differs, np.arange(n), n)
        at = np.minimum.accumulate(at[::-1])[::-1]
        up[:-1] = text[:-1] < text[1:]
        up = up[at]
    return up


def two_stage_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (uint8) in order of their first
    ``depth`` characters (suffixes that agree so far stand side by side, in any
    order).

    Direct stage: only suffixes smaller than their successor are compared.
    Bucket scan: going through the order from the left, the suffix one place
    before each is greater than it if it was not sorted directly, and among
    those with its first character it is the next; so it goes to the first free
    place of that character's bucket.  All that a stretch of a bucket puts into
    other buckets goes there in one step."""
    n = len(text)
    up = smaller_than_next(text)
    chars = text.tobytes().decode("latin-1")
    size = np.bincount(text, minlength=256)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    ups = np.bincount(text[up], minlength=256)
    tail = begin + size - ups          # where a bucket's directly sorted ones start
    out = np.empty(n, np.int64)
    # One bucket after the other, so that only its own keys are held.
    for c in np.flatnonzero(ups):
        direct = np.flatnonzero(up & (text == c))
        keys = [chars[i:i + depth] for i in direct.tolist()]
        out[tail[c]:tail[c] + ups[c]] = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    free = begin.copy()

    def place(starts: np.ndarray) -> None:
        before = starts - 1
        before = before[before >= 0]
        before = before[~up[before]]
        if len(before) == 0:
            return
        first = text[before]
        turn = np.argsort(first, kind="stable")
        before, first = before[turn], first[turn]
        count = np.bincount(first, minlength=256)
        rank = np.arange(len(first)) - np.concatenate([[0], np.cumsum(count)[:-1]])[first]
        out[free[first] + rank] = before
        np.add(free, count, out=free)

    if n:
        out[free[text[n - 1]]] = n - 1     # what the empty suffix puts in place
        free[text[n - 1]] += 1
    for c in np.flatnonzero(size):
        done = begin[c]
        while done < free[c]:              # runs of one character come in turns
            upto = free[c]
            place(out[done:upto])
            done = upto
        place(out[tail[c]:tail[c] + ups[c]])
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix of ``order`` but the first, how many characters it has
    in common with the one before it, at most ``limit`` (rounded up to whole
    words of eight) and not beyond the end of the text."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(limit + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded.data, 0, (1,))
    a, b = order[:-1], order[1:]
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for k in range(0, limit, 8):
        x = words[a[alive] + k] ^ words[b[alive] + k]
        same = x == 0
        out[alive[same]] += 8
        stopped, x = alive[~same], x[~same]
        if len(stopped):
            low = (x & (~x + np.uint64(1))).astype(np.float64)
            out[stopped] += (np.log2(low).astype(np.int64)) // 8
        alive = alive[same]
        if len(alive) == 0:
            break
    return np.minimum(out, n - np.maximum(a, b))


def repeated_starts(contexts: list[bytes], width: int) -> list[np.ndarray]:
    """For each context (a stretch of text) a mask of the places where a string
    of ``width`` bytes starts that also starts elsewhere in the contexts.

    The contexts are joined with a character below all others between them, so
    that no common prefix reaches over an end."""
    lengths = np.array([len(c) for c in contexts], np.int64)
    raw = np.frombuffer(b"\x00".join(contexts) + b"\x00", np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    text = np.where(raw == 255, 255, raw + np.uint8(1)).astype(np.uint8)  # 255 is in no UTF-8 text
    text[ends] = 0
    order = two_stage_sort(text, width)
    common = common_prefixes(text, order, width)
    left = ends[np.searchsorted(ends, order)] - order      # characters to the context's end
    twin = (common >= width) & (left[:-1] >= width) & (left[1:] >= width)
    hit = np.zeros(len(text), bool)
    hit[order[:-1][twin]] = True
    hit[order[1:][twin]] = True
    return [hit[e - n:e] for e, n in zip(ends, lengths, strict=True)]
