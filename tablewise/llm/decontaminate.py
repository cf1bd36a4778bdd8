"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of ``window`` consecutive words (one shorter
window if it has fewer words).  Each window is a set of shingles (runs of up to
``shingle`` words).  Shingles are counted over all documents; since a
contained window has all its shingles, the rarest one is a sufficient prefix.
Documents are joined with the prefix shingles only.  A hit passes the length
and positional bounds (the window must fit at the place its shingle's offset
gives) and is then verified word by word.

The benchmark is the query set: tasks cut its windows, make them distinct and deal them to blocks
of about ``block_words`` words (at most twice as many, measured).  The driver fetches one block at a time and
broadcasts it; all documents are streamed against each block.  Documents are never shuffled.

Defined cases: null text has no words; an item without words has no window;
items with equal windows are all named; a null item id is ignored; repeated
rows are judged each on its own; null ids pass through; very long texts are read
whole; other columns, whatever their names, are ignored unless kept; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, save, text_or_empty

WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b in WORD_BYTES else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of digits, a-z and code points from U+0080 on."""
    return text.encode("utf-8").translate(_FOLD).split() if text else []


#: items that one row of the window table names
OWNERS = 1024
_EMIT = 8192


class Block:
    """Distinct windows of a block, with exact integer word ids and shingle codes."""

    def __init__(self, windows: list[tuple[bytes, ...]], shingle: int):
        self.windows, self.shingle = windows, shingle
        self.vocab: dict[bytes, int] = {}
        for w in windows:
            for x in w:
                self.vocab.setdefault(x, len(self.vocab))
        self.base = len(self.vocab) + 1
        while self.base**self.shingle >= 2**62:  # codes stay exact
            self.shingle -= 1
        self.coded = [np.array([self.vocab[x] for x in w], np.int64) for w in windows]
        self.by_size: dict[int, np.ndarray] = {}
        sets: dict[int, set[int]] = defaultdict(set)
        for w in self.coded:
            k = min(self.shingle, len(w))
            sets[k].update(self.codes(w, k).tolist())
        self.by_size = {k: np.array(sorted(s), np.int64) for k, s in sets.items()}

    def codes(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Codes of the runs of k words; -1 where a word is unknown."""
        n = len(ids) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(k):
            part = ids[j : j + n]
            out = out * self.base + part
            known &= part >= 0
        return np.where(known, out, -1)

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def find(self, codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, places in the sorted table) of the codes that the table has."""
        at = np.searchsorted(table, codes)
        hit = np.flatnonzero(table[np.minimum(at, len(table) - 1)] == codes) if len(table) else np.zeros(0, np.int64)
        return hit, at[hit]


def _count_shingles(docs: DataFrame, shared) -> dict[tuple[int, int], int]:
    """Number of occurrences, over all documents, of the block's shingles (bounded by the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        total = {k: np.zeros(len(t), np.int64) for k, t in block.by_size.items()}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = block.ids(words_of(text))
                for k, table in block.by_size.items():
                    _, at = block.find(block.codes(ids, k), table)
                    np.add.at(total[k], at, 1)
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k), pa.int32()), pa.array(block.by_size[k][at], pa.int64()), pa.array(n[at], pa.int64())],
                names=["k", "code", "n"],
            )

    counted = docs.mapInArrow(releasing(run), "k int, code long, n long").groupBy("k", "code").agg(F.sum("n").alias("n"))
    return {(r.k, r.code): r.n for r in counted.collect()}


def _prefixes(block: Block, counts: dict[tuple[int, int], int]) -> dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]]:
    """Per shingle size: sorted prefix codes and, for each, its (window, offset of the shingle in it)."""
    chosen: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for i, w in enumerate(block.coded):
        k = min(block.shingle, len(w))
        codes = block.codes(w, k).tolist()
        rarest = min(range(len(codes)), key=lambda j: (counts.get((k, codes[j]), 0), codes[j], j))
        if counts.get((k, codes[rarest]), 0):  # else the window occurs nowhere
            chosen[k][codes[rarest]].append((i, rarest))
    return {k: (np.array(sorted(m), np.int64), [m[c] for c in sorted(m)]) for k, m in chosen.items()}


def _match(block: Block, prefixes: dict, ids: np.ndarray) -> tuple[set[int], np.ndarray]:
    """(windows that occur, hit flags of the words)."""
    n = len(ids)
    marks = np.zeros(n + 1, np.int64)
    seen: set[int] = set()
    for k, (table, owners) in prefixes.items():
        at, where = block.find(block.codes(ids, k), table)
        order = np.argsort(where, kind="stable")
        at, where = at[order], where[order]
        bounds = np.flatnonzero(np.diff(where, prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            for window, offset in owners[where[a]]:
                want = block.coded[window]
                begin = at[a:b] - offset
                begin = begin[(begin >= 0) & (begin + len(want) <= n)]  # positional and length bounds
                for j, w in enumerate(want):  # exact containment, word by word
                    if not len(begin):
                        break
                    begin = begin[ids[begin + j] == w]
                if len(begin):
                    seen.add(window)
                    marks[begin] += 1
                    np.add.at(marks, begin + len(want), -1)
    return seen, np.cumsum(marks[:-1]) > 0


def benchmark_windows(benchmark: DataFrame, window: int, block_words: int, item_col: str, text_col: str) -> DataFrame:
    """(block, words, items): the distinct windows of the benchmark, words joined by one space, with the ids of their items.

    Windows are cut, made distinct and dealt to blocks by tasks.  A window that more than OWNERS items have
    is several rows, so no row grows with the benchmark, and a block weighs at most about ``block_words``."""
    items = benchmark.filter(F.col(item_col).isNotNull()).select(text_or_empty(text_col).alias("t"), F.col(item_col).cast("string").alias("item"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                starts = range(max(len(words) - window, 0) + 1 if words else 0)
                for i in range(0, len(starts), _EMIT):
                    part = [b" ".join(words[s : s + window]) for s in starts[i : i + _EMIT]]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())], names=["words", "item"])

    pairs = save(items.mapInArrow(releasing(run), "words binary, item string").distinct(), "benchmark-pairs")
    wide = pairs.groupBy("words").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > OWNERS)
    share = F.pmod(F.xxhash64("item"), F.coalesce(F.ceil(F.col("_n") / OWNERS), F.lit(1)))
    owned = pairs.join(wide, "words", "left").withColumn("_share", share).groupBy("words", "_share").agg(F.collect_list("item").alias("items"))
    # long words and long lists of items weigh as several words do
    weighed = save(owned.withColumn("_weight", F.lit(window) + F.size("items") + F.floor(F.octet_length("words") / 8)), "benchmark-windows")
    total, rows = weighed.agg(F.sum("_weight"), F.count(F.lit(1))).first()
    blocks = max(1, -(-(total or 0) // block_words))
    while True:
        dealt = weighed.select(F.pmod(F.xxhash64("words", "_share"), F.lit(blocks)).alias("block"), "words", "items", "_weight")
        heaviest = dealt.groupBy("block").agg(F.sum("_weight").alias("w")).agg(F.max("w")).first()[0] or 0
        if heaviest <= 2 * block_words or blocks >= 2 * rows:  # beyond, single windows are heavier than a block
            return dealt.select("block", "words", "items")
        blocks *= 2


def benchmark_blocks(windows: DataFrame) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """Blocks of distinct windows with the ids of their items; the driver fetches one at a time, when it is asked for."""
    for number in sorted(r[0] for r in windows.select("block").distinct().collect()):  # a row a block
        block: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
        for batch in windows.filter(F.col("block") == number).select("words", "items").toArrow().to_batches():
            for w, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block[tuple(w.split(b" "))] += items
        yield block


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _spans(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _mark(rows: DataFrame, shared, with_text: bool) -> DataFrame:
    """Stream ``rows`` against one block (None: no block) and add its hits to spans and items."""
    fields = rows.schema.fields if with_text else [f for f in rows.schema.fields if f.name != "_text"]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, prefixes, owners = shared.value if shared is not None else (None, {}, [])
        for batch in batches:
            old = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n_words, spans, items = [], [], []
            for text, before, had in zip(old["_text"].to_pylist(), old["_spans"].to_pylist(), old["_items"].to_pylist(), strict=True):
                words = words_of(text)
                hit = np.zeros(len(words), bool)
                for s in before:
                    hit[s["start"] : s["stop"]] = True
                found = set(had)
                if block is not None:
                    seen, flags = _match(block, prefixes, block.ids(words))
                    hit |= flags
                    found.update(x for w in seen for x in owners[w])
                n_words.append(len(words))
                spans.append(_spans(hit))
                items.append(sorted(found))
            new = {"_n": pa.array(n_words, pa.int64()), "_spans": pa.array(spans, _ARROW_SPANS), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(f.name, old[f.name]) for f in fields], names=[f.name for f in fields])

    return rows.mapInArrow(releasing(run), schema)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shingle: int = 4,
    block_words: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, ``keep`` columns, n_words, n_hit, spans of hit words, item_ids (sorted strings).

    Blocks after the first read the rows that the one before has written to the
    shared folder, so one block at a time is in memory.
    """
    spark = docs.sparkSession
    texts = docs.select(text_or_empty(text_col).alias("_text"))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        text_or_empty(text_col).alias("_text"),
        F.lit(0).cast("long").alias("_n"),
        F.lit([]).cast(_SPANS).alias("_spans"),
        F.lit([]).cast("array<string>").alias("_items"),
    )
    shared = None
    for windows in benchmark_blocks(benchmark_windows(benchmark, window, block_words, item_col, item_text_col)):
        if shared is not None:
            rows = save(_mark(rows, shared, True), "decontaminate")
            shared.destroy()
        block = Block(list(windows), shingle)
        counting = spark.sparkContext.broadcast(block)
        counts = _count_shingles(texts, counting)
        counting.destroy()
        shared = spark.sparkContext.broadcast((block, _prefixes(block, counts), list(windows.values())))
    return _mark(rows, shared, False).select(
        F.col("_id").alias("doc_id"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        F.col("_n").alias("n_words"),
        F.aggregate("_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"]).alias("n_hit"),
        F.col("_spans").alias("spans"),
        F.col("_items").alias("item_ids"),
    )
