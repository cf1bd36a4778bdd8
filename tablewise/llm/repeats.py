"""Shared plan of the two operators that remove repeated passages.

1. One scan describes each text: digest, keys of its runs (see
   :mod:`.anchors`).  Equal texts are then one row, so large groups of copies
   cost no more than one text from here on.
2. Keys are counted over the distinct texts; texts that hold a repeated key get
   the list of theirs by a join (texts without one leave the plan).
3. The contexts of those runs are written; equal contexts become one row.
4. Contexts are dealt out by key and each task decides which of their windows
   repeat, by the operator's own method.  A key that still has very many different contexts
   (a passage that a third of all texts share, with other surroundings in each) is
   never dealt to one task: its windows are compared by digest, one row a window.
5. Decisions go back to the texts as spans.

Every step is a join or group on a hash; no step drops, caps or samples rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import Runs, merge_spans, runs_of_batch
from .common import releasing, save, text_or_empty
from .textarrays import column_bytes

#: contexts dealt to one task
TASK_BYTES = 6_000_000
#: a key with more runs than this, whose contexts could outgrow a task, is split by further keys
HOT_RUNS = 16_000
#: a key with more different contexts than this, or a window digest that occurs more often, is never gathered in a task
HOT_CONTEXTS = 16_000


@dataclass(frozen=True)
class Units:
    """What a text is made of.

    ``of(column)`` gives, for an Arrow string column, (codes of units a to b,
    bounds of the texts in units, plain bytes of units a to b).
    """

    window: int
    gram: int
    of: Callable
    overlaps_inside: bool  # whether a window may repeat inside its own text
    plain_is_text: bool  # whether the plain bytes of all units are the text


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def describe(docs: DataFrame, units: Units, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_units, digest, plain_digest, text_key, keys.

    ``digest`` is the hex SHA-256 of the text, ``text_key`` its first 8 bytes,
    ``plain_digest`` that of the plain bytes of all units.  A key that has two
    anchors in the text is listed twice when that matters.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType(
        [src.schema["doc_id"], T.StructField("n_units", T.LongType()), T.StructField("digest", T.StringType()),
         T.StructField("plain_digest", T.StringType()), T.StructField("text_key", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                code, offsets, plain = units.of(part.column(1))
                found = runs_of_batch(code, offsets, units.window, units.gram)
                keys, bounds = _listed(found, len(offsets) - 1, units.overlaps_inside)
                raw, at = column_bytes(part.column(1))
                hashes = [hashlib.sha256(raw[a:b]) for a, b in pairwise(at.tolist())]
                first8 = np.frombuffer(b"".join(h.digest()[:8] for h in hashes), np.int64)
                full = [h.hexdigest() for h in hashes]
                bare = full if units.plain_is_text else [hashlib.sha256(plain(a, b)).hexdigest() for a, b in pairwise(offsets.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)), pa.array(full, pa.string()), pa.array(bare, pa.string()), pa.array(first8),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(_signed(keys)))],
                    names=schema.names,
                )

    return src.mapInArrow(releasing(run), schema)


def parts(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def _listed(found: Runs, texts: int, twice: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text, twice where the text alone has two anchors; and their bounds by text."""
    order = np.lexsort((found.key, found.text))
    text, key, anchors = found.text[order], found.key[order], found.anchors[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    copies = np.ones(len(at), np.int64)
    if twice and len(at):
        copies = np.minimum(np.add.reduceat(anchors, at), 2)
    owner = np.repeat(text[at], copies)
    return np.repeat(key[at], copies), np.searchsorted(owner, np.arange(texts + 1))


def distinct_texts(described: DataFrame) -> DataFrame:
    """One row per text: digest, text_key, keys, first_id (smallest doc_id, null only if all are), copies."""
    return described.groupBy("digest").agg(
        F.first("text_key").alias("text_key"), F.first("keys").alias("keys"),
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
    )


def wanted_keys(texts: DataFrame) -> DataFrame:
    """text_key, wanted (keys that repeat), hot (the part of them that very many runs share)."""
    listed = texts.select("text_key", F.explode("keys").alias("key"))
    again = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    mine = listed.distinct().join(again, "key")
    return mine.groupBy("text_key").agg(
        F.collect_list("key").alias("wanted"), F.collect_list(F.when(F.col("n") > HOT_RUNS, F.col("key"))).alias("hot")
    )


#: a null id counts as larger than any
LAST = (1 << 63) - 1


def texts_with_repeats(docs: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text_key, first_id, text, wanted, hot: one row per distinct text that holds a repeated key."""
    reps = texts.select("text_key", "first_id", "digest").join(wanted_keys(texts), "text_key")
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    src = src.withColumn("digest", F.sha2("text", 256))
    joined = src.join(reps, "digest").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    first = F.coalesce("first_id", F.lit(LAST)).alias("first_id")
    return joined.select("text_key", first, "text", "wanted", "hot")


CONTEXTS = "key long, text_key long, first_id long, at long, windows long, context_id binary, context binary"
_ARROW_CONTEXTS = pa.schema(
    [(c, pa.int64()) for c in ("key", "text_key", "first_id", "at", "windows")] + [(c, pa.binary()) for c in ("context_id", "context")]
)


def _among(found: Runs, lists: pa.ListArray) -> np.ndarray:
    """Whether each run's key is in the list of its text."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    if not len(flat) or not len(found.key):
        return np.zeros(len(found.key), bool)
    salt = np.uint64(0x9E3779B97F4A7C15)
    want = np.unique(flat + owner.astype(np.uint64) * salt)
    have = found.key + found.text.astype(np.uint64) * salt
    at = np.minimum(np.searchsorted(want, have), len(want) - 1)
    return want[at] == have


def contexts(rows: DataFrame, units: Units) -> DataFrame:
    """The contexts of all runs whose key repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 128):
                code, offsets, plain = units.of(part.column(2))
                keys, firsts = part.column(0).to_numpy(), part.column(1).to_numpy()
                any_hot = len(part.column(4).flatten()) > 0
                out: list[list] = [[] for _ in _ARROW_CONTEXTS]
                plain_runs = runs_of_batch(code, offsets, units.window, units.gram)
                wanted = _among(plain_runs, part.column(3))
                if any_hot:
                    wanted &= ~_among(plain_runs, part.column(4))
                _emit(out, plain_runs, plain_runs.key, np.flatnonzero(wanted), offsets, plain, keys, firsts, units)
                if any_hot:
                    with_hot = part.filter(pc.greater(pc.list_value_length(part.column(4)), 0))
                    code, offsets, plain = units.of(with_hot.column(2))
                    fine = runs_of_batch(code, offsets, units.window, units.gram, split=True)
                    pick = np.flatnonzero(_among(fine, with_hot.column(4)))
                    keys, firsts = with_hot.column(0).to_numpy(), with_hot.column(1).to_numpy()
                    _emit(out, fine, fine.key ^ fine.split_keys, pick, offsets, plain, keys, firsts, units)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in out[:5]] + [pa.array([x for y in c for x in y], pa.binary()) for c in out[5:]],
                        schema=_ARROW_CONTEXTS,
                    )

    return rows.mapInArrow(releasing(run), CONTEXTS)


def _emit(out: list[list], found: Runs, key: np.ndarray, pick: np.ndarray, offsets, plain, keys, firsts, units: Units) -> None:
    if not len(pick):
        return
    text, start, length = found.text[pick], found.start[pick], found.length[pick]
    begin = offsets[text] + start
    raw = [plain(a, b) for a, b in zip(begin.tolist(), (begin + length + units.window - 1).tolist(), strict=True)]
    columns = (_signed(key[pick]), keys[text], firsts[text], start, length)
    for c, v in zip(out, columns, strict=False):
        c.append(np.asarray(v, np.int64))
    out[5].append([hashlib.md5(x).digest() for x in raw])
    out[6].append(raw)


def distinct_contexts(found: DataFrame) -> DataFrame:
    """key, context_id, context, first_id (smallest), runs (how many have this context)."""
    return found.groupBy("key", "context_id").agg(
        F.first("context").alias("context"), F.min("first_id").alias("first_id"), F.count(F.lit(1)).alias("runs")
    )


DECIDED = "key long, context_id binary, first_id long, runs long, spans array<struct<start:long,stop:long>>"


def decide(found: DataFrame, judge: Callable, cut: Callable, repeated: Callable) -> DataFrame:
    """Deal the distinct contexts out by key and let ``judge`` say which of their windows repeat.

    ``judge(keys, contexts, first_ids)`` gives, per context, spans [start, stop) of window starts.
    Of keys with more than ``HOT_CONTEXTS`` contexts ``cut(context)`` gives the windows, and the condition
    ``repeated(mine, first, runs)`` says whether a window repeats: from the id it was found with, the smallest
    id of all places that have it, and how many those are.
    """
    grouped = save(distinct_contexts(found), "contexts")
    total = grouped.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    tasks = int(total // TASK_BYTES) + 1
    hot = save(grouped.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_CONTEXTS).select("key"), "hot-keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema(_ARROW_DISTINCT))
        if not table.num_rows:
            return
        spans = judge(table["key"].to_numpy(), table["context"].to_pylist(), table["first_id"].to_numpy())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        out = table.select(["key", "context_id", "first_id", "runs"]).append_column("spans", pa.array(spans, kind))
        yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    if hot.isEmpty():
        return grouped.repartition(tasks, "key").mapInArrow(releasing(run), DECIDED)
    # a hot key stands for HOT_CONTEXTS rows and more, so this list has at most that part of their number
    few = grouped.join(F.broadcast(hot), "key", "left_anti").repartition(tasks, "key").mapInArrow(releasing(run), DECIDED)
    return few.unionByName(_by_digest(grouped.join(F.broadcast(hot), "key", "left_semi"), cut, repeated))


def _by_digest(grouped: DataFrame, cut: Callable, repeated: Callable) -> DataFrame:
    """The decisions for contexts of hot keys: every window is a row with its digest, wherever it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                windows = [cut(x) for x in part.column(2).to_pylist()]
                sizes = np.fromiter(map(len, windows), np.int64, len(windows))
                owner = pa.array(np.repeat(np.arange(len(windows)), sizes))
                start = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                digest = pa.array([hashlib.md5(w).digest() for ws in windows for w in ws], pa.binary())
                rest = part.select(["key", "context_id", "first_id", "runs"]).take(owner)
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(start), digest], names=["key", "context_id", "first_id", "runs", "start", "window"])

    kind = "key long, context_id binary, first_id long, runs long, start long, window binary"
    windows = save(grouped.mapInArrow(releasing(run), kind), "hot-windows")
    counts = windows.groupBy("window").agg(F.min("first_id").alias("_first"), F.sum("runs").alias("_runs"), F.count(F.lit(1)).alias("_places"))
    counts = save(counts.filter("_runs > 1"), "window-counts")
    often = counts.filter(F.col("_places") > HOT_CONTEXTS)
    # frequent windows meet their counts by a broadcast (at most a row for HOT_CONTEXTS of theirs), the others by a shuffle
    hits = windows.join(F.broadcast(often), "window").unionByName(windows.join(counts.filter(F.col("_places") <= HOT_CONTEXTS), "window"))
    hits = hits.filter(repeated(F.col("first_id"), F.col("_first"), F.col("_runs")))
    spans = hits.groupBy("key", "context_id").agg(F.collect_list(F.struct("start", (F.col("start") + 1).alias("stop"))).alias("spans"))
    none = F.lit([]).cast("array<struct<start:long,stop:long>>")
    every = grouped.select("key", "context_id", "first_id", "runs").join(spans, ["key", "context_id"], "left")
    return every.withColumn("spans", F.coalesce("spans", none))


_ARROW_DISTINCT = [("key", pa.int64()), ("context_id", pa.binary()), ("context", pa.binary()), ("first_id", pa.int64()), ("runs", pa.int64())]


def spans_by_text(found: DataFrame, decided: DataFrame, all_windows, window: int) -> DataFrame:
    """text_key, pieces (array of start, stop in units): what the decisions cover in each text.

    ``all_windows`` is a condition on a run (first_id) and its context
    (context_first, runs) under which every window of the run repeats.
    """
    runs = found.select("key", "context_id", "text_key", "first_id", "at", "windows")
    d = decided.withColumnRenamed("first_id", "context_first")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("windows").alias("stop")))
    hit = runs.join(d, ["key", "context_id"]).withColumn("_spans", F.when(all_windows, whole).otherwise(F.col("spans")))
    cut = hit.select("text_key", "at", F.explode("_spans").alias("_s")).select(
        "text_key", F.struct((F.col("at") + F.col("_s.start")).alias("start"), (F.col("at") + F.col("_s.stop") + window - 1).alias("stop")).alias("p")
    )
    return cut.groupBy("text_key").agg(F.collect_list("p").alias("pieces"))


CUT = "text_key long, kept binary, n_removed long, removed array<struct<start:long,stop:long>>"


def cut_texts(rows: DataFrame, pieces: DataFrame, units: Units, join_kept: Callable) -> DataFrame:
    """Remove the pieces from the texts: kept bytes, number of units removed, maximal removed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 128):
                _, offsets, plain = units.of(part.column(1))
                kept, n, spans = [], [], []
                for i, cuts in enumerate(part.column(2).to_pylist()):
                    start, stop = merge_spans(np.array([c["start"] for c in cuts], np.int64), np.array([c["stop"] for c in cuts], np.int64))
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    edges = [0, *np.stack([start, stop], 1).ravel().tolist(), b - a]
                    kept.append(join_kept([plain(a + x, a + y) for x, y in zip(edges[::2], edges[1::2], strict=True) if y > x]))
                    n.append(int((stop - start).sum()))
                    spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(start, stop, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(n, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                    names=["text_key", "kept", "n_removed", "removed"],
                )

    return rows.select("text_key", "text").join(pieces, "text_key").mapInArrow(releasing(run), CUT)
