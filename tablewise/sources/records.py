"""CSV records with line breaks inside quotes, from files that are read in blocks side by side (A1).

Whether a byte lies inside quotes depends on all quotes before it, but only through their
parity: a block turns the state it begins in into the one it ends in by an exclusive or.  So one aggregate
counts each block's quotes, a running sum over a file's blocks (one small row a
block) gives the state that each begins in, and then every block cuts its own lines into
records, knowing whether its first line begins one.  Only the records that cross a border of blocks,
at most two pieces a block, meet again by a group; all other rows stay where they were read.

A record ends at a line feed outside quotes; a carriage return before it is not part of it.
Quotes are doubled inside quoted fields, as RFC 4180 has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import broadcast_if_small

PIECE = "file string, block long, number long, text string, head boolean, tail boolean, valid boolean, first boolean"
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_())
_BLANK = " \t\r\n\ufeff"
_NAMES = ["file", "block", "number", "text", "head", "tail", "valid", "first"]


def quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (the byte at which the part of the file that a task reads begins) and value of every line, in order."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_states(lines_: DataFrame) -> DataFrame:
    """Per block: odd_lines, invalid_lines, whether it begins and ends inside quotes, and whether it holds its file's first line that is not blank."""
    q = quotes(F.col("value"))
    blocks = lines_.groupBy("file", "block").agg(
        F.sum(q).alias("_q"), F.count_if(q % 2 == 1).alias("odd_lines"), F.count_if(~F.is_valid_utf8("value")).alias("invalid_lines"),
        F.count_if(_filled(F.col("value"))).alias("_filled"),
    )
    so_far = Window.partitionBy("file").orderBy("block")
    until, filled = F.sum("_q").over(so_far), F.sum("_filled").over(so_far)
    return blocks.select(
        "file", "block", "odd_lines", "invalid_lines", ((until - F.col("_q")) % 2 == 1).alias("begins_inside"), (until % 2 == 1).alias("ends_inside"),
        ((filled == F.col("_filled")) & (F.col("_filled") > 0)).alias("has_first"),
    )


def _filled(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[\\t\\r\\n\ufeff]", " ")) != ""


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, and the pieces of records that its ends cut."""
    key, inside, head, number, held, valid, first = None, False, True, 0, [], True, False

    def piece(tail: bool) -> tuple:
        return (*key, number, "\n".join(held), head, tail, valid, first)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS, strict=True)], names=_NAMES)

    for batch in batches:
        files, blocks, values, odd, begins, firsts, ok = batch.columns
        n = batch.num_rows
        one_block = n and key == (files[0].as_py(), blocks[0].as_py()) == (files[n - 1].as_py(), blocks[n - 1].as_py())
        if one_block and not (inside or held or first or pc.any(odd).as_py()):  # nothing to join: the lines are the records
            true, false = pa.array([True] * n), pa.array([False] * n)
            count = pa.array(range(number, number + n), pa.int64())
            number += n
            yield pa.RecordBatch.from_arrays([files, blocks, count, values, true, true, ok, false], names=_NAMES)
            continue
        if one_block and not first:
            # lines to records by arrays: a record ends where the quotes so far are even
            inner = (np.cumsum(odd.to_numpy(zero_copy_only=False)) + inside) % 2 == 1
            ends, good = np.flatnonzero(~inner), ok.to_numpy(zero_copy_only=False)
            if len(ends):
                begin, stop = int(ends[0]) + 1, int(ends[-1]) + 1
                held += values[:begin].to_pylist()
                valid = bool(valid and good[:begin].all())
                rows = [piece(True)] if "".join(held).strip(_BLANK) else []  # a blank line is no record
                yield batch_of(rows)
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), values[begin:stop]), "\n")
                count = pa.array(np.arange(number + 1, number + len(ends)))
                true, false = (pa.array(np.full(len(texts), b)) for b in (True, False))
                fine = pa.array(np.logical_and.reduceat(good[begin:stop], ends[:-1] - ends[0])) if len(texts) else true
                name, at = pa.array([key[0]] * len(texts), pa.string()), pa.array(np.full(len(texts), key[1], np.int64))
                filled = pc.not_equal(pc.utf8_trim(texts, _BLANK), "")
                yield pa.RecordBatch.from_arrays([name, at, count, texts, true, true, fine, false], names=_NAMES).filter(filled)
                held, head, number = [], True, number + len(ends)
                valid = True
            else:
                stop = 0
            held += values[stop:].to_pylist()
            valid = bool(valid and good[stop:].all())
            inside = bool(inner[-1])
            continue
        rows: list[tuple] = []
        for file, block, value, flips, begin, holds_first, good in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (file, block):
                if held:
                    rows.append(piece(False))
                key, inside, head, number, held, valid, first = (file, block), begin, not begin, 0, [], True, holds_first
            held.append(value)
            valid &= good
            inside ^= flips
            if not inside:
                rows.append(piece(True))
                if "".join(held).strip(_BLANK):
                    first = False
                else:
                    rows.pop()  # a blank line is no record
                number, held, head, valid = number + 1, [], True, True
        yield batch_of(rows)
    if held:
        yield batch_of([piece(False)])


def records(lines_: DataFrame, states: DataFrame, joined: bool = True) -> DataFrame:
    """text of every record that is not blank, first (of its file), closed (its quotes are), valid (UTF-8).

    ``states`` are the block states of the same lines.  Without ``joined`` each line is a record, its
    quotes closed or not.  Text that is not UTF-8 has replacement characters."""
    told = states.where(F.col("begins_inside") | F.col("has_first") if joined else F.col("has_first"))
    told = told.select("file", "block", (F.col("begins_inside") & F.lit(joined)).alias("_begun"), F.col("has_first").alias("_first"))
    small = broadcast_if_small(told, told.count())
    src = lines_.withColumn("_at", F.monotonically_increasing_id()).join(small, ["file", "block"], "left")
    if small is told:  # too many to send round: a shuffle, after which the lines are put in order again
        src = src.repartition("file", "block").sortWithinPartitions("file", "block", "_at")
    value = F.col("value")
    src = src.select(
        "file", "block", F.make_valid_utf8(value).alias("value"), (quotes(value) % 2 == 1 if joined else F.lit(False)).alias("odd"),
        F.coalesce("_begun", F.lit(False)).alias("begins"), F.coalesce("_first", F.lit(False)).alias("firsts"), F.is_valid_utf8(value).alias("valid"),
    )
    pieces = src.mapInArrow(_pieces, PIECE)
    every = pieces.where("head AND tail").select("text", "first", "valid")
    if joined:
        # the other pieces in the order of the file: a head begins a record, the others go on with it
        order = Window.partitionBy("file").orderBy("block", "number")
        cut = pieces.where("NOT (head AND tail)").withColumn("_record", F.sum(F.col("head").cast("int")).over(order))
        whole = cut.groupBy("file", "_record").agg(
            F.sort_array(F.collect_list(F.struct("block", "number", "text"))).alias("_parts"), F.max("first").alias("first"), F.min("valid").alias("valid")
        )
        every = every.unionByName(whole.select(F.array_join(F.col("_parts.text"), "\n").alias("text"), "first", "valid"))
    text = F.regexp_replace(F.when(F.col("first"), F.ltrim("text", F.lit("\ufeff"))).otherwise(F.col("text")), r"\r\z", "")
    every = every.select(text.alias("text"), "first", "valid").where(_filled(F.col("text")))
    return every.select("text", "first", (quotes(F.col("text")) % 2 == 0).alias("closed"), "valid")


def field_count(text: Column, separator: str = ",") -> Column:
    """Number of fields of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(text, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
