"""Anchors: where equal windows of a corpus can lie.

The key of a window of W units (bytes or words) is the smallest hash of the
grams inside it.  Equal windows have equal keys, so a window can repeat only if
its key does.  Neighbouring windows mostly share their key: a document is a
short list of runs (key, first window, number of windows), about one per
(W - gram + 1) / 2 units.  The text under a run, its *context*, is what later
steps have to compare.  The selection is exact: it drops no repeated window.

A key that very many runs share (a common line) is split by the smallest hashes
under two more seeds; equal windows agree on those as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from .textarrays import gram_hashes, mix, sliding_min

PIECE = 1 << 20
SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_LOW = np.uint64((1 << 20) - 1)


class Runs:
    """Runs of one batch: text index, first window in its text, number of windows, key, distinct anchors."""

    def __init__(self, text, start, length, key, anchors, split_keys):
        self.text, self.start, self.length, self.key, self.anchors, self.split_keys = text, start, length, key, anchors, split_keys


def runs(units: Callable[[int, int], np.ndarray], offsets: np.ndarray, window: int, gram: int, split: bool = False) -> Iterator[Runs]:
    """Runs of texts laid end to end, in pieces of at most ``PIECE`` windows.

    ``units(a, b)`` gives the 64-bit codes of units a to b; ``offsets`` are the texts' bounds.
    With ``split`` runs also end where the extra keys change, and carry them combined.
    """
    total = int(offsets[-1])
    wide = window - gram + 1
    for a in range(0, max(total - window + 1, 0), PIECE):
        b = min(a + PIECE, total - window + 1)
        g = gram_hashes(units(a, b + window - 1), gram)
        place = np.arange(a, a + len(g), dtype=np.uint64) & _LOW
        low = sliding_min((g & ~_LOW) | place, wide)  # ties go to the first
        p = np.arange(a, b)
        at = p + ((low & _LOW).astype(np.int64) - p) % (1 << 20)
        key = g[at - a]
        text = np.searchsorted(offsets, p, side="right") - 1
        valid = p + window <= offsets[text + 1]
        change = np.ones(len(p), bool)
        change[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        extra = None
        if split:
            extra = np.zeros(len(p), np.uint64)
            for seed in SEEDS:
                m = sliding_min(mix(g ^ seed), wide)
                change[1:] |= m[1:] != m[:-1]
                extra = mix(extra + m)
        keep = np.flatnonzero(valid)
        if not len(keep):
            continue
        begin = np.flatnonzero(change[keep] | (np.diff(keep, prepend=keep[0] - 2) > 1))
        first = keep[begin]
        length = np.diff(np.append(begin, len(keep)))
        moved = np.ones(len(keep), np.int64)
        moved[1:] = low[keep[1:]] != low[keep[:-1]]
        moved[begin] = 1
        anchors = np.add.reduceat(moved, begin)
        yield Runs(text[first], p[first] - offsets[text[first]], length, key[first], anchors, None if extra is None else extra[first])


def runs_of_batch(units, offsets: np.ndarray, window: int, gram: int, split: bool = False) -> Runs:
    """All runs of a batch together."""
    parts = list(runs(units, offsets, window, gram, split))
    z = np.zeros(0, np.int64)
    if not parts:
        return Runs(z, z, z, z.astype(np.uint64), z, z.astype(np.uint64) if split else None)
    cat = lambda name: np.concatenate([getattr(x, name) for x in parts])
    return Runs(cat("text"), cat("start"), cat("length"), cat("key"), cat("anchors"), cat("split_keys") if split else None)


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as disjoint, non-adjacent ones in order."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    at = np.flatnonzero(new)
    return start[at], stop[np.append(at[1:] - 1, len(start) - 1)]
