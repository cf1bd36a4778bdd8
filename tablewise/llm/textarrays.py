"""Array views of text columns: bytes, words, hashes and sliding minima, without per-word Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def column_bytes(col: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, offsets) of an Arrow string column without nulls; no copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def white(raw: np.ndarray) -> np.ndarray:
    """Which bytes are white space (0x20, 0x09-0x0D)."""
    return _WHITE[raw]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words (runs without 0x20, 0x09-0x0D); words never cross a text's end."""
    inside = ~_WHITE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside])
    now = np.concatenate([inside, [False]])
    return np.flatnonzero(now & (~before | edge)), np.flatnonzero(before & (~now | edge))


_PIECE = 1 << 20
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))  # odd numbers are invertible modulo 2^64
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse, at least n of each."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_STEP, _INVERSE)):
            p = np.full(max(n, _PIECE), base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over byte codes, mixed with the length.

    Taken from prefix sums over pieces of about a megabyte, cut between words.
    """
    out = np.zeros(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        low = int(begins[at])
        stop = max(int(np.searchsorted(ends, low + _PIECE, side="right")), at + 1)
        piece = raw[low : int(ends[stop - 1])]
        up, down = _powers(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        b, e = begins[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[b]) * down[b]
        at = stop
    return mix(out + (ends - begins).astype(np.uint64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Mixed hash of the n values from each position on (len(h) - n + 1 of them), by doubling."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, width, done, power = None, 1, 0, int(_STEP)
    cur = h
    bits = n
    while bits:
        if bits & 1:
            # append the block of ``width`` values that begins ``done`` further on
            part = cur[done:] if done else cur
            if out is None:
                out = part
            else:
                m = min(len(out), len(part))
                out = out[:m] * np.uint64(power) + part[:m]
            done += width
        bits >>= 1
        if bits:
            cur = cur[:-width] * np.uint64(power) + cur[width:]
            power = power * power % (1 << 64)
            width *= 2
    return mix(out[: len(h) - n + 1])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` values, by doubling."""
    if len(v) < width:
        return v[:0]
    span, cur = 1, v
    while span * 2 <= width:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    rest = width - span
    return np.minimum(cur[: len(v) - width + 1], cur[rest : rest + len(v) - width + 1]) if rest else cur
