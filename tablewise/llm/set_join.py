"""Candidates of a set similarity join: prefix tokens, rarest first, with length and positional bounds.

A pair of sets with ``100 * intersection >= percent * union`` shares at least ``ceil(percent * size / 100)`` members of
either set.  With all sets in one common order, the first common member therefore lies among the first
``size - that + 1`` members of both: their prefixes.  The order puts rare members first, so what many sets
have in common (a template, a licence) is in no prefix unless it decides the similarity.

Rarity is the count of a hash cell, over all sets, in ``CELLS`` cells (a table of proven size, broadcast): any
common order gives right results, a collision only makes a member look more frequent than it is.

Prefix members are joined with each other; a pair has to come from different groups (``root``), pass the length bound, and
leave enough members after the common place in both sets.  A prefix member that more than ``HOT`` sets share
pairs nothing here: its sets are returned by :func:`crowded` for another way to compare them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import releasing, save

#: cells of the rarity table: 2**CELL_BITS counts
CELL_BITS = 18
#: sets that may share a prefix member for its pairs to be joined; one row meets at most this many others
HOT = 64
_EMIT = 1 << 16


def _cells(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all codes of a binary column end to end, number of codes by row)."""
    raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
    return np.concatenate(raw) if raw else np.zeros(0, np.uint64), np.fromiter(map(len, raw), np.int64, len(raw))


def rarity(sets: DataFrame) -> np.ndarray:
    """Members of all ``codes`` by cell: 2**CELL_BITS counts, whatever the input's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            np.add.at(total, _cells(_codes(batch.column(0))[0]), 1)
        at = np.flatnonzero(total)
        for i in range(0, len(at), _EMIT):
            part = at[i : i + _EMIT]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part])], names=["cell", "n"])

    counted = sets.select("codes").mapInArrow(releasing(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << CELL_BITS, np.int64)
    out[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return out


def prefix_size(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def prefix_rows(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(token, node, root, size, place): the prefix members of every (node, root, codes) row."""
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            codes, sizes = _codes(batch.column(2))
            token, place, owner = [], [], []
            for i, (end, size) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)):
                x = codes[end - size : end]
                frequent = count[_cells(x)]
                first = np.lexsort((x, frequent))[: prefix_size(size, percent)]
                at = np.flatnonzero(frequent[first] > 1)  # the others are in no second set
                token.append(x[first[at]])
                place.append(at)
                owner.append(np.full(len(at), i))
            if token:
                who = np.concatenate(owner)
                columns = [pa.array(np.concatenate(token).view(np.int64)), batch.column(0).take(pa.array(who)), batch.column(1).take(pa.array(who)),
                           pa.array(sizes[who]), pa.array(np.concatenate(place))]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "root", "size", "place"])

    rows = sets.select("node", "root", "codes").mapInArrow(releasing(run), "token long, node binary, root binary, size long, place long")
    out = save(rows, "join-prefix")
    shared.destroy()
    return out


def shared_rows(prefix: DataFrame) -> DataFrame:
    """The prefix rows whose token is in sets of several groups, with ``sharing``, the number of its sets."""
    several = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("sharing"), F.min("root").alias("_l"), F.max("root").alias("_h"))
    return prefix.join(several.filter("_l <> _h").select("token", "sharing"), "token")


def _fits(percent: int) -> Column:
    """Length and positional bounds of a pair with a common member at these places."""
    x, y = F.col("x.size"), F.col("y.size")
    left = F.least(x - F.col("x.place"), y - F.col("y.place"))
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (left * (100 + percent) >= (x + y) * percent)


def candidates(shared: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of different groups that the bounds leave, from tokens of at most HOT sets."""
    rare = shared.filter(F.col("sharing") <= HOT)
    other = (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    pairs = rare.alias("x").join(rare.alias("y"), other & _fits(percent))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def crowded(shared: DataFrame) -> DataFrame:
    """Distinct ``node`` of the sets with a prefix member that more than HOT sets share."""
    return shared.filter(F.col("sharing") > HOT).select("node").distinct()
