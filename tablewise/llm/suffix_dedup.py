"""Suffix-array dedup: remove every byte covered by a string that occurs elsewhere.

Windows that can repeat are found by :mod:`.repeats`; each task then sorts the
suffixes of its contexts, to a depth of one window, by deep-shallow sorting:
multikey quicksort on eight-byte characters orders the suffixes to a shallow
depth, and blind tries order the groups that are still equal.  A blind trie
keeps only branching depths and bytes: all members of a group are compared
once with one leaf, which gives the depth and byte where each leaves the
leaf's path, and the members of one branch are the next group.  All groups of
a task advance together as arrays.  Windows that stand next to an equal one in
suffix order repeat.

Defined cases: null text is empty; texts shorter than the window keep
everything; equal texts (repeated rows too) of at least one window lose
everything; periodic text loses what its own shifted copies cover; null ids
pass through; very long texts are taken whole; empty tables give empty results; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import save
from .textarrays import _BYTE, column_bytes

SHALLOW = 16
GRAM = 32


def bytes_units(window: int, gram: int = GRAM) -> repeats.Units:
    def of(column):
        raw, offsets = column_bytes(column)
        return (lambda a, b: _BYTE[raw[a:b]]), offsets, (lambda a, b: raw[a:b].tobytes())

    return repeats.Units(window, min(gram, window), of, overlaps_inside=True, plain_is_text=True)


def words8(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros after the end)."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    out = np.zeros(len(raw), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(raw)]
    return out


def _regroup(new: np.ndarray) -> np.ndarray:
    return np.cumsum(new) - 1


def deep_shallow_sort(raw: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(suffix starts in order of their first ``depth`` bytes, whether each equals the one before).

    Every suffix must have ``depth`` bytes.  Ties keep the order of ``starts``.
    """
    word = words8(raw)
    order = starts[np.argsort(word[starts], kind="stable")] if len(starts) else starts
    same = np.zeros(len(order), bool)
    if not len(order):
        return order, same
    # shallow: multikey quicksort, one eight-byte character per round
    w = word[order]
    bound = np.ones(len(order), bool)  # begins a group of suffixes that are equal so far
    bound[1:] = w[1:] != w[:-1]
    known = 8
    while known < min(shallow, depth - 7):
        live = np.flatnonzero(_open(bound))
        if not len(live):
            return order, same
        group, w = _regroup(bound[live]), word[order[live] + known]
        turn = np.lexsort((w, group))
        order[live], w, group = order[live][turn], w[turn], group[turn]
        bound[live[1:]] = (w[1:] != w[:-1]) | (group[1:] != group[:-1])
        known += 8
    # deep: blind tries
    live = np.flatnonzero(_open(bound))
    from_word = np.full(len(live), known, np.int64)
    while len(live):
        at = order[live]
        group = _regroup(bound[live])
        first = np.flatnonzero(bound[live])
        leaf = at[first][group]
        shared, branch, own = _leave(raw, word, at, leaf, int(from_word.min()), depth)
        equal = shared >= depth
        side = np.where(equal, 0, np.where(own < branch, -1, 1))
        # smaller ones leave the leaf's path from the top down, larger ones from the bottom up
        rank = np.where(side < 0, shared, np.where(side == 0, depth, 2 * depth - shared + 1))
        code = ((group.astype(np.uint64) << np.uint64(20)) | rank.astype(np.uint64)) << np.uint64(8) | np.where(equal, 0, own).astype(np.uint64)
        turn = np.argsort(code, kind="stable")
        code, equal, shared = code[turn], equal[turn], shared[turn]
        order[live] = at[turn]
        bound[live[1:]] = code[1:] != code[:-1]
        bound[live[0]] = True
        done = equal
        again = np.zeros(len(live), bool)
        again[1:] = code[1:] == code[:-1]
        same[live[done & again]] = True
        bound[live[done]] = True  # settled: never a group again
        rest = np.flatnonzero(~done)
        inside = rest[_open(bound[live[rest]], ends=_ends(live[rest], bound))]
        live, from_word = live[inside], (shared[inside] // 8) * 8
    return order, same


def _ends(live: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Whether the place after each live one begins a group or is not live."""
    after = np.ones(len(live), bool)
    after[:-1] = live[1:] != live[:-1] + 1
    nxt = np.minimum(live + 1, len(bound) - 1)
    return after | bound[nxt] | (live + 1 >= len(bound))


def _open(bound: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Members of groups of two or more."""
    if ends is None:
        ends = np.append(bound[1:], True)
    return ~(bound & ends)


def _leave(raw, word, at, leaf, from_word: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth at which each suffix leaves its leaf (``depth`` if it doesn't), the leaf's byte there and its own."""
    shared = np.full(len(at), depth, np.int64)
    left = np.flatnonzero(at != leaf)
    d = from_word
    while d < depth and len(left):
        a, b = at[left] + d, leaf[left] + d
        if d + 8 <= depth:
            step, apart = 8, word[a] != word[b]
        else:  # the last bytes one by one
            step, apart = 1, raw[a] != raw[b]
        out = left[apart]
        if len(out):
            x = word[at[out] + d] ^ word[leaf[out] + d]
            lead = np.zeros(len(out), np.int64)
            if step == 8:
                for j in range(1, 8):
                    lead += (x >> np.uint64(64 - 8 * j)) == 0
            shared[out] = d + lead
        left = left[~apart]
        d += step
    place = np.minimum(shared, depth - 1)
    return shared, raw[leaf + place], raw[at + place]


def repeated_windows(keys: np.ndarray, contexts: list[bytes], window: int) -> list[list[dict[str, int]]]:
    """Per context, spans of the window starts whose bytes also start elsewhere among the contexts."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])
    count = np.maximum(sizes - window + 1, 0)
    owner = np.repeat(np.arange(len(contexts)), count)
    first = np.cumsum(count) - count
    starts = base[:-1][owner] + (np.arange(int(count.sum())) - first[owner])
    order, same = deep_shallow_sort(raw, starts, window)
    hit = np.zeros(len(raw) + 1, bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    out: list[list[dict[str, int]]] = [[] for _ in contexts]
    flags = np.concatenate([[0], hit.astype(np.int8), [0]])
    edge = np.flatnonzero(np.diff(flags))
    begin, end = edge[::2], edge[1::2]
    # a marked run may cross from one context into the next
    for i, a, b in zip(np.searchsorted(base, begin, side="right") - 1, begin, end, strict=True):
        while a < b:
            stop = min(int(b), int(base[i + 1]))
            out[i].append({"start": int(a - base[i]), "stop": int(stop - base[i])})
            a, i = stop, i + 1
    return out


def remove_repeats(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, removed (spans in bytes), kept (bytes or null), text_digest.

    ``kept`` is filled where some but not all bytes go; null means the text is unchanged (n_removed = 0) or gone.
    """
    units = bytes_units(window)
    described = save(repeats.describe(docs, units, id_col, text_col), "suffix-described")
    texts = save(repeats.distinct_texts(described), "suffix-texts")
    rows = save(repeats.texts_with_repeats(docs, texts, id_col, text_col), "suffix-rows")
    found = save(repeats.contexts(rows, units), "suffix-contexts")
    decided = repeats.decide(
        found, lambda keys, ctx, _: repeated_windows(keys, ctx, window),
        cut=lambda x: [x[i : i + window] for i in range(len(x) - window + 1)], repeated=lambda mine, first, runs: runs > 1,
    )
    decided = save(decided, "suffix-decided")
    pieces = repeats.spans_by_text(found, decided, F.col("runs") > 1, window)
    cut = save(repeats.cut_texts(rows, pieces, units, b"".join), "suffix-cut").dropDuplicates(["text_key"])
    copies = texts.select("digest", "copies")
    gone = (F.col("copies") > 1) & (F.col("n_units") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_units").alias("stop")))
    none = F.lit([]).cast("array<struct<start:long,stop:long>>")
    spans = F.when(gone, whole).otherwise(F.coalesce("removed", none))
    return (
        described.drop("keys")
        .join(copies, "digest")
        .join(cut, "text_key", "left")
        .select(
            "doc_id",
            F.col("n_units").alias("n_bytes"),
            F.when(gone, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.size(spans).cast("long").alias("n_spans"),
            spans.alias("removed"),
            F.when(~gone, F.col("kept")).alias("kept"),
            F.col("digest").alias("text_digest"),
        )
    )
