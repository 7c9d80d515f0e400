"""Anchors: places of a text that equal strings of it choose alike.

Every window of ``width`` bytes has one anchor, the start of its smallest ``GRAM``-byte
hash (the leftmost of equal ones), which depends on nothing outside the window. The
windows of one anchor are consecutive, so a text is told by its anchors' contexts: the
bytes from the first of its windows to the end of the last. Equal windows have their
anchor at one distance, so they lie in contexts whose anchors have equal hashes.
"""

from __future__ import annotations

import numpy as np
import xxhash

GRAM = 32
_PLACE = (1 << 30) - 1  # bits of a place in a slice, under those of its hash
_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Of every ``gram`` consecutive bytes, a mixed polynomial hash modulo 2^64."""
    n = len(data)
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_M_INVERSE, n), dtype=np.uint64)))
    h = (running[gram:] - running[:-gram]) * _powers(_M, n - gram + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Of every ``w`` consecutive values: the end of one block and the begin of the next."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    begin = np.minimum.accumulate(grid, axis=1).ravel()
    end = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(end[:n - w + 1], begin[w - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Of texts one after the other (``offsets``: where each begins, and the end), a row
    per anchor: ``text`` (which), ``start`` (of the first window, in ``data``),
    ``windows`` (how many), ``gram`` (the anchor's hash) and ``context`` (its context's
    hash). Neighbours with one context (a period) are one row: ``times``, and ``reach``,
    how far on the last one begins."""
    lengths = np.diff(offsets)
    long = lengths >= width
    names = ("text", "start", "windows", "gram", "context", "times", "reach")
    if not long.any():
        return {c: np.zeros(0, np.int64) for c in names}
    h = gram_hashes(data)
    keys = (h & ~np.uint64(_PLACE)) | np.arange(len(h), dtype=np.uint64)
    place = (sliding_minimum(keys, width - GRAM + 1) & np.uint64(_PLACE)).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int32)  # windows that end in the text they begin in
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - width + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[:len(place)] > 0)
    place = place[start]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))))
    begin, windows = start[first], np.diff(np.append(first, len(start)))
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    ends = (begin + windows + width - 1).tolist()
    context = np.fromiter((digest(view[s:e]) for s, e in zip(begin.tolist(), ends, strict=True)), np.uint64, len(begin))
    rows = {"text": np.searchsorted(offsets, begin, "right") - 1, "start": begin, "windows": windows,
            "gram": h[place[first]].view(np.int64), "context": context.view(np.int64)}
    new = np.ones(len(begin), bool)
    for c in ("text", "gram", "context"):
        new[1:] &= rows[c][1:] == rows[c][:-1]
    new[1:] = ~new[1:]
    run = np.flatnonzero(new)
    times = np.diff(np.append(run, len(new)))
    return {c: x[run] for c, x in rows.items()} | {"times": times, "reach": begin[run + times - 1] - begin[run]}
