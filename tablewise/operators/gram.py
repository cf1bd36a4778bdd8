"""Pearson correlations of many columns from masked products of row blocks.

One pass: each task adds, over its rows and for all pairs at once, the products
that pairwise-complete moments need: with M the mask of present values and X the values (less a
shift of each column, 0 where missing), M'M, X'M, M'X, X²'M, M'X² and X'X.  They
are matrix products of blocks, so a thousand columns cost no wider plan than ten.  A task's shift is the
first value it sees of each column; sums with different shifts are brought to one when they are added.

The matrices travel as strips of ``STRIP`` columns and are added ``FAN_IN`` at a time, so no task
holds more than that many strips.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRIP, FAN_IN, BLOCK_ROWS = 64, 32, 4096
#: a variance below this part of the mean square about the shift is rounding
ROUNDING = 1e-11
_SUMS = "strip int, part long, sums binary, shift binary"
_KINDS = 7  # M'M, X'M, M'X, X²'M, M'X², X'X, pairs with a value that is not finite


def _add(total: np.ndarray, X: np.ndarray, M: np.ndarray, bad: np.ndarray) -> None:
    X2 = X * X
    xm, qm = X.T @ M, X2.T @ M
    bm = bad.T @ M
    for out, part in zip(total, (M.T @ M, xm, xm.T, qm, qm.T, X.T @ X, bm + bm.T), strict=True):
        out += part


def _moved(sums: np.ndarray, rows: slice, by: np.ndarray) -> np.ndarray:
    """The sums of a strip for a shift that is less by ``by``: every value grows by it."""
    n, x, y, xx, yy, xy, bad = sums
    a, b = by[rows][:, None], by[None, :]
    return np.stack([n, x + n * a, y + n * b, xx + 2 * a * x + n * a * a, yy + 2 * b * y + n * b * b, xy + a * y + b * x + n * a * b, bad])


def _strips(width: int) -> list[slice]:
    return [slice(i, min(i + STRIP, width)) for i in range(0, width, STRIP)]


def _joined(part: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and shift of one strip, of several partial ones."""
    rows = _strips(width)[int(part["strip"].iloc[0])]
    total = shift = None
    for s, c in sorted(zip(part["sums"], part["shift"], strict=True), key=lambda p: p[1]):  # in an order that only the sums decide
        sums, mine = np.frombuffer(s).reshape(_KINDS, -1, width), np.frombuffer(c)
        if total is None:
            total, shift = sums.copy(), mine.copy()
            continue
        new = np.isnan(shift) & ~np.isnan(mine)  # a column that has had no value yet
        shift[new] = mine[new]
        total += _moved(sums, rows, np.where(np.isnan(mine), 0.0, mine - shift))
    return total, shift


def _pearson(sums: np.ndarray) -> np.ndarray:
    n, x, y, xx, yy, xy, bad = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        mx, my, qx, qy = x / n, y / n, xx / n, yy / n
        vx, vy = qx - mx * mx, qy - my * my
        r = (xy / n - mx * my) / np.sqrt(vx * vy)
        r = np.where((n > 0) & (vx > ROUNDING * qx) & (vy > ROUNDING * qy), np.clip(r, -1.0, 1.0), np.nan)
    return np.where(bad > 0, np.inf, r)  # NaN becomes null on its way back, so the other case needs a sign of its own


def correlation_blocks(df: DataFrame, columns: list[str]) -> DataFrame:
    """field_a, field_b, r (not rounded; null without variance, NaN with values that are not finite) of every ordered pair; an empty table gives no rows."""
    width = len(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, total = np.full(width, np.nan), np.zeros((_KINDS, width, width))
        seen = False
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                M = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns], 1)
                raw = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in part.columns], 1)
                finite = np.isfinite(raw)
                use = M & finite
                first = use.argmax(axis=0)
                new = np.isnan(shift) & use.any(axis=0)
                shift[new] = raw[first[new], np.flatnonzero(new)]
                X = np.where(use, raw - np.where(np.isnan(shift), 0.0, shift), 0.0)
                _add(total, X, M.astype(float), (M & ~finite).astype(float))
                seen = True
        if seen:
            from pyspark import TaskContext

            part_number = TaskContext.get().partitionId()
            for k, rows in enumerate(_strips(width)):
                fields = ([k], [part_number], [total[:, rows].tobytes()], [shift.tobytes()])
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(fields, kinds, strict=True)], names=["strip", "part", "sums", "shift"])

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        sums, shift = _joined(part, width)
        return pd.DataFrame({"strip": part["strip"].iloc[:1].to_numpy(), "part": part["part"].iloc[:1].to_numpy() // FAN_IN, "sums": [sums.tobytes()], "shift": [shift.tobytes()]})

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        sums, _ = _joined(part, width)
        rows = _strips(width)[int(part["strip"].iloc[0])]
        a, b = np.meshgrid(np.arange(rows.start, rows.stop), np.arange(width), indexing="ij")
        return pd.DataFrame({"a": a.ravel().astype(np.int32), "b": b.ravel().astype(np.int32), "r": _pearson(sums).ravel()})

    parts = values.mapInArrow(partial, _SUMS)
    left = values.rdd.getNumPartitions()
    while left > FAN_IN:
        parts = parts.groupBy("strip", F.floor(F.col("part") / FAN_IN).alias("_group")).applyInPandas(combine, _SUMS)
        left = -(-left // FAN_IN)
    pairs = parts.groupBy("strip").applyInPandas(finish, "a int, b int, r double")
    names = F.array(*[F.lit(c) for c in columns])
    r = F.when(F.col("r") == float("inf"), float("nan")).otherwise(F.col("r"))
    return pairs.select(F.get(names, "a").alias("field_a"), F.get(names, "b").alias("field_b"), r.alias("r"))
