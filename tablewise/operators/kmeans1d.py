"""k-means of single columns from prefix sums over their sorted values.

In one dimension the rows of a centre are an interval of the sorted values, so its mean is the difference of two
prefix sums.  The (field, value, count) table is sorted by ranges and cut into at most ``max_cells`` cells of equally
many values a field; a cell's bounds, count and sum go to the driver (a bounded table).  An iteration
searches the border between neighbouring centres among the cells: the cells before it count whole, and only a cell that a
border cuts is read, by its number, from the written table.  It is read once and kept, and borders soon
stay in the same cells, so late iterations start no job at all.  Where a field has at most ``max_cells`` values a cell
is one value and nothing is ever read again.  The result is exact at every size.

Defined cases: null and NaN are imputed before (:mod:`features`); a field with one value has one centre that holds it; a
centre without values stays where it is; values at the midpoint of two centres, as floating point has it, belong to the smaller one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import broadcast_if_small
from ..session import checkpoint

MAX_CELLS = 50_000


def value_cells(long: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """(field, cell, x, n): the distinct values of (field, x) rows with their counts, in cells of equally many values."""
    counts = long.groupBy("field", "x").agg(F.count(F.lit(1)).alias("n"))
    # written, so that ranges and places are those of one evaluation
    placed = checkpoint(
        counts.repartitionByRange("field", "x").sortWithinPartitions("field", "x")
        .select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_id"))
    )
    parts = placed.groupBy("field", "_range").agg(F.count(F.lit(1)).alias("_m"), F.min("_id").alias("_first"))
    by_field = Window.partitionBy("field")
    offsets = parts.select(  # a row a range and field
        "field", "_range", "_first", (F.sum("_m").over(by_field.orderBy("_range")) - F.col("_m")).alias("_before"),
        F.ceil(F.sum("_m").over(by_field) / max_cells).alias("_size"),
    )
    place = F.col("_id") - F.col("_first") + F.col("_before")
    return checkpoint(
        placed.join(broadcast_if_small(offsets, offsets.count()), ["field", "_range"])
        .select("field", F.floor(place / F.col("_size")).alias("cell"), "x", "n")
    )


@dataclass
class Prefix:
    """Sorted cells of one field with prefix sums; ``read`` fetches the values of cells that a border cuts."""

    values: DataFrame
    name: str
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    total: np.ndarray
    known: dict = field(default_factory=dict)
    reads: int = 0

    def __post_init__(self):
        self.origin = float(self.low[0])
        self.counts_before = np.concatenate([[0], np.cumsum(self.count)])
        self.totals_before = np.concatenate([[0.0], np.cumsum(self.total)])

    def _read(self, cells: list[int]) -> None:
        """At most one cell a border, each of bounded size."""
        rows = self.values.where((F.col("field") == self.name) & F.col("cell").isin(cells)).select("cell", "x", "n").toArrow().to_pandas()
        for cell, part in rows.sort_values(["cell", "x"]).groupby("cell"):
            x, n = part["x"].to_numpy(float), part["n"].to_numpy(np.int64)
            # sums are taken from the smallest value on, as those of the cells
            self.known[cell] = x, np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0.0], np.cumsum((x - self.origin) * n)])
        self.reads += 1

    def until(self, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, sum over the smallest value) of the values up to and with each border."""
        whole = np.searchsorted(self.high, borders, side="right")  # cells that lie before the border
        count, total = self.counts_before[whole].copy(), self.totals_before[whole].copy()
        inside = whole < len(self.low)
        inside[inside] = self.low[whole[inside]] <= borders[inside]
        cut = np.flatnonzero(inside)
        if missing := sorted({int(c) for c in whole[cut]} - self.known.keys()):
            self._read(missing)
        for i in cut:
            x, n, s = self.known[int(whole[i])]
            at = np.searchsorted(x, borders[i], side="right")
            count[i] += n[at]
            total[i] += s[at]
        return count, total


def prefixes(values: DataFrame) -> dict[str, Prefix]:
    """The cells of every field; the one table that goes to the driver, at most ``max_cells`` rows a field."""
    low = values.groupBy("field").agg(F.min("x").alias("_o"))  # a row a field
    cells = (
        values.join(F.broadcast(low), "field").groupBy("field", "cell")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n").alias("count"), F.sum((F.col("x") - F.col("_o")) * F.col("n")).alias("total"))
        .toArrow().to_pandas().sort_values(["field", "cell"])
    )
    return {
        name: Prefix(values, name, part["low"].to_numpy(float), part["high"].to_numpy(float), part["count"].to_numpy(np.int64), part["total"].to_numpy(float))
        for name, part in cells.groupby("field")
    }


def centres(prefix: Prefix, start: np.ndarray, threshold: float, max_iter: int) -> np.ndarray:
    """Lloyd's iterations from sorted ``start`` until the squared shift is at most ``threshold``."""
    now = np.asarray(start, float)
    everything = prefix.counts_before[-1], prefix.totals_before[-1]
    for _ in range(max_iter):
        count, total = prefix.until((now[1:] + now[:-1]) * 0.5)
        count, total = np.diff(count, prepend=0, append=everything[0]), np.diff(total, prepend=0.0, append=everything[1])
        new = np.where(count > 0, prefix.origin + total / np.maximum(count, 1), now)
        shift = float(np.sum((new - now) ** 2))
        now = new
        if shift <= threshold:
            break
    return now
