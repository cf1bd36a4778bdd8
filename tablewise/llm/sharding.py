"""Sharding by proportional stratified interleaving.

Rows are put in a seeded order within their source, given the fractional rank
(rank - 1/2) / (rows of the source), sorted by that fraction over all sources
and cut into contiguous runs whose lengths differ by one at most.  Every run
then has nearly the same share of every source.  Law: ``rows``.

Ranks are exact at any size without a window over a whole source: the seeded
hash is uniform, so rows fall into (source, hash bucket) cells of about
``cell_rows`` rows, the cells' counts are summed into offsets, and a row's
rank is its cell's offset plus its place in the cell.  A source with a third
of all rows is so many more cells.  The fractional rank is uniform too, and
the second sort uses the same construction.

Defined cases: a null source is a source of its own; a null text has size 1
and the CRC of no bytes; ties in the seeded hash (repeated ids) are ordered by
id, CRC and size, and rows equal in all of them are interchangeable; very long texts are
measured whole; other columns, also ones named like results, are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_key, save, text_or_empty


def _with_offsets(cells: DataFrame, by: list[str], bucket: str, out: str) -> DataFrame:
    """Add to each cell the number of rows in cells before it (within ``by``)."""
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn(out, F.coalesce(F.sum("_n").over(w), F.lit(0)))


def shard_rows(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cell_rows: int = 20_000,
) -> DataFrame:
    """Assign each row a shard and a slot.

    Returns doc_id, source, size (UTF-8 bytes + 1), text_crc32, source_rank,
    fraction, shard, slot.  Only these narrow columns are shuffled, never texts.
    """
    text = text_or_empty(text_col)
    rows = save(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            id_key(source_col).alias("_stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.md5(F.concat(F.lit(f"{seed}:"), id_key(id_col))).alias("_h"),
        ),
        "shard-rows",
    )
    total = rows.count()
    if total == 0:
        return rows.select(
            "doc_id", "source", "size", "text_crc32",
            F.lit(0).cast("long").alias("source_rank"), F.lit(0.0).alias("fraction"),
            F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
        )
    n_cells = total // cell_rows + 1
    place = F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / float(2**32)
    rows = rows.withColumn("_cell", F.floor(place * n_cells))
    cells = rows.groupBy("_stratum", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    sums = cells.groupBy("_stratum").agg(F.sum("_n").alias("_in_source"))
    cells = _with_offsets(cells, ["_stratum"], "_cell", "_before").join(sums, "_stratum").drop("_n")
    order = ["_h", "doc_id", "text_crc32", "size"]
    in_cell = Window.partitionBy("_stratum", "_cell").orderBy(*order)
    ranked = (
        rows.withColumn("_k", F.row_number().over(in_cell))
        .join(cells, ["_stratum", "_cell"])
        .withColumn("source_rank", F.col("_before") + F.col("_k"))
        .withColumn("fraction", (F.col("source_rank") - F.lit(0.5)) / F.col("_in_source"))
        .withColumn("_slice", F.floor(F.col("fraction") * n_cells))
        .drop("_cell", "_before", "_k", "_in_source")
    )
    ranked = save(ranked, "shard-ranked")
    slices = ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    slices = _with_offsets(slices.withColumn("_all", F.lit(0)), ["_all"], "_slice", "_before").drop("_n", "_all")
    in_slice = Window.partitionBy("_slice").orderBy("fraction", "_stratum", "source_rank")
    placed = (
        ranked.withColumn("_k", F.row_number().over(in_slice))
        .join(slices, "_slice")
        .withColumn("_pos", F.col("_before") + F.col("_k") - 1)
        .withColumn("shard", F.expr(f"CAST(_pos * {shards} DIV {total} AS INT)"))
        .withColumn("_first", F.expr(f"(CAST(shard AS BIGINT) * {total} + {shards - 1}) DIV {shards}"))
    )
    return placed.select(
        "doc_id", "source", "size", "text_crc32", "source_rank", "fraction", "shard",
        (F.col("_pos") - F.col("_first")).cast("long").alias("slot"),
    )
