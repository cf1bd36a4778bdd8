"""Periodic runs of words, found by seeds on the diagonals of a document with itself, and collapsed.

A run is a maximal stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least ``max(min_length, exponent * q)``.  On the
diagonal of lag q a run is a stretch of equal word pairs, and its length there, the
run's length less q, is at least a known number of words.  So the lags are taken scale
by scale: for each scale the words are indexed by k-grams, k being the smallest
overlap that any run of the scale's lags guarantees, and k is no less than the lags.
Occurrences of a gram are then linked to the next one in the same document alone: inside a run of period q
a gram of at least q words occurs again after exactly q words, never sooner
(its period is primitive), so no run is lost and no further pairs are needed.
Every pair within the scale's lags is a seed.  Seeds of one lag are
walked from left to right beside the place up to which that lag's diagonal has been followed; a
seed before that place is part of a stretch already extended and is skipped.  The others are extended
word by word (in growing blocks) to both sides.

Gram numbers are exact (ranks of pairs of ranks, by doubling), not hashes, and a
gram that occurs once is dropped before the next scale, since what holds it cannot repeat
either.  Work is O(n log n) for n words, memory a fixed number of
integers a word; a document is never split and never leaves its row, so nothing is shuffled.

Defined cases: a null text has no words; empty and blank texts have no runs and
collapse to an empty text; very long texts are taken whole; of overlapping runs each is reported, and a word
is dropped if any of them contains it after its first q words; null and repeated ids and
repeated rows each give their own row; further columns stay out, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, text_or_empty
from .textarrays import column_bytes, white, word_spans

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)
_SPACE = 0x20


def word_numbers(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, and only those, have equal numbers."""
    offsets = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=offsets[1:])
    letters = pa.py_buffer(raw[~white(raw)])
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), letters])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def scales(longest: int, min_length: int, exponent: int) -> Iterator[tuple[int, int]]:
    """(first lag, k) of each scale, whose last lag is k.

    A run with lag q overlaps itself on max(min_length - q, (exponent - 1) * q) words.  That falls
    up to q = min_length / exponent and rises from there, so its least value over all lags from ``low`` on is
    at ``low`` or there; k is the largest power of two within it and, the exponent being at
    least 3, at least ``low``."""
    low, turn = 1, min_length // exponent
    while max(min_length, exponent * low) <= longest:
        least = min(max(min_length - q, (exponent - 1) * q) for q in {low, max(low, turn), max(low, turn + 1)})
        k = 1 << (least.bit_length() - 1)
        yield low, k
        low = k + 1


def find_runs(words: np.ndarray, offsets: np.ndarray, min_length: int = 24, exponent: int = 3) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period; starts are positions in ``words``.

    ``words`` holds the word numbers of all documents, ``offsets`` where each begins and where the last ends."""
    if exponent < 3 or min_length < exponent:
        raise ValueError("runs need an exponent of at least 3 and a length of at least the exponent")
    sizes = np.diff(offsets)
    begin, stop = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    at = np.arange(len(words))
    # grams of different documents never share a number
    _, rank = np.unique(begin * (int(words.max(initial=0)) + 1) + words, return_inverse=True)
    width, out = 1, []
    for low, k in scales(int(sizes.max(initial=0)), min_length, exponent):
        order, same = np.arange(0), np.zeros(0, bool)
        while width < k:
            at = at[at + 2 * width <= stop[at]]
            at = at[(rank[at] >= 0) & (rank[at + width] >= 0)]
            code = rank[at] * len(words) + rank[at + width]
            order = np.argsort(code, kind="stable")
            code = code[order]
            same = code[1:] == code[:-1]
            rank = np.full(len(words), -1)
            rank[at[order]] = np.concatenate([[0], np.cumsum(~same)])[: len(at)]
            again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(at) else np.zeros(0, bool)
            rank[at[order[~again]]] = -1
            width *= 2
            linked = at[order]
            at = np.sort(linked[again])
        if not len(at):
            break
        first, lag = linked[:-1][same], np.diff(linked)[same]
        seed = (lag >= low) & (lag <= k)
        out += _extend(words, begin, stop, first[seed], lag[seed], k, min_length, exponent)
    runs = np.array(out, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _extend(words, begin, stop, first, lag, k, min_length, exponent) -> list[tuple[int, int, int]]:
    """The runs that the seeds (``first``, ``lag``) of ``k`` equal pairs lie in."""
    order = np.lexsort((first, lag))
    first, lag = first[order], lag[order]
    # seeds that begin within the one before them, on the same diagonal of the same document, are one stretch
    head = np.ones(len(first), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (first[1:] > first[:-1] + k) | (begin[first[1:]] != begin[first[:-1]])
    heads = np.flatnonzero(head)
    lasts = np.append(heads[1:], len(first))[: len(heads)] - 1
    covered: dict[int, int] = {}
    out = []
    for i, j, q in zip(first[heads].tolist(), (first[lasts] + k).tolist(), lag[heads].tolist(), strict=True):
        if i < covered.get(q, 0):
            continue
        low = i - _equal_back(words, i, q, int(begin[i]))
        high = j + _equal_on(words, j, q, int(stop[i]))
        covered[q] = high
        if high - low + q >= max(min_length, exponent * q):
            out.append((low, high - low + q, q))
    return out


def _equal_on(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """How many pairs (x, x + lag) from ``at`` on are equal, in growing blocks."""
    x, size = at, 16
    while x + lag < stop:
        end = min(x + size, stop - lag)
        differ = np.flatnonzero(words[x:end] != words[x + lag : end + lag])
        if len(differ):
            return x + int(differ[0]) - at
        x, size = end, size * 2
    return x - at


def _equal_back(words: np.ndarray, at: int, lag: int, begin: int) -> int:
    """How many pairs (x, x + lag) just before ``at`` are equal, in growing blocks."""
    x, size = at, 16
    while x > begin:
        low = max(x - size, begin)
        differ = np.flatnonzero(words[low:x] != words[low + lag : x + lag])
        if len(differ):
            return at - (low + int(differ[-1]) + 1)
        x, size = low, size * 2
    return at - x


def collapse(raw: np.ndarray, offsets: np.ndarray, begins: np.ndarray, ends: np.ndarray, doc: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts' kept words, joined by one space."""
    out = raw.copy()
    inner = ends < offsets[doc + 1]  # the byte after such a word is white space of its text
    out[ends[inner]] = _SPACE
    change = np.zeros(len(raw) + 2, np.int8)
    change[begins[kept]] += 1
    last = kept & ~np.concatenate([(doc[1:] == doc[:-1]) & _later(kept, doc)[1:], [False]]) if len(doc) else kept
    spaced = kept & inner & ~last
    tail = ends + spaced
    np.subtract.at(change, tail[kept], 1)
    take = np.cumsum(change[: len(raw)], dtype=np.int8).astype(bool)
    return out[take], np.concatenate([[0], np.cumsum(take, dtype=np.int64)])[offsets]


def _later(kept: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether word i or a later one of its document is kept."""
    n = len(doc)
    follow = np.where(kept, np.arange(n), n)
    nearest = np.minimum.accumulate(follow[::-1])[::-1]
    return (nearest < n) & (doc[np.minimum(nearest, n - 1)] == doc)


def collapse_runs(docs: DataFrame, min_length: int = 24, exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed text."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_batch(batch.column(1), min_length, exponent)], names=schema.names)

    return src.mapInArrow(releasing(run), schema)


def _batch(texts: pa.StringArray, min_length: int, exponent: int) -> list[pa.Array]:
    raw, offsets = column_bytes(texts)
    begins, ends = word_spans(raw, offsets)
    doc = np.searchsorted(offsets, begins, side="right") - 1
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs = find_runs(word_numbers(raw, begins, ends), bounds, min_length, exponent)
    change = np.zeros(len(begins) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.subtract.at(change, runs[:, 0] + runs[:, 1], 1)
    kept = np.cumsum(change[:-1]) == 0
    data, at = collapse(raw, offsets, begins, ends, doc, kept)
    owner = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    fields = [pa.array(runs[:, 0] - bounds[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    struct = pa.StructArray.from_arrays(fields, fields=[pa.field(f.name, pa.int64(), False) for f in RUNS.elementType.fields])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), struct)
    text = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
    return [pa.array(np.diff(bounds)), lists, text]
