"""Near-duplicate documents: minima of many universal hashes, banding, verification, components.

1. Each text becomes its set of distinct word shingles (64-bit codes), a signature of
   ``bands * rows`` minima of universal hashes, and one code per band.  Equal sets are one
   row from here on, so exact and trivial copies cost no more than one document.
2. Sets that share a band code are candidates.  First, every member of a bucket is paired with
   the bucket's smallest set: one pair a member, whatever the bucket's size.
3. Pairs pass the signature check (estimated similarity, far below the threshold so that
   it drops no link) and are confirmed on the full sets.
4. After components of these links, only buckets that still span several components are looked
   at again.  Their members are compared across components by a join on rare shingles
   (:mod:`set_join`: prefixes, length and positional bounds), whose pairs are checked and confirmed as in 3.
   What many texts share, such as a template, is not rare and pairs nothing.  Only members with a prefix shingle
   that more than ``set_join.HOT`` sets share are compared block by block inside their buckets; each pair of
   blocks returns only links that join components, never all pairs.
   Together with 2 this examines every pair of candidates that could still join two components.
5. Components by alternating large-star and small-star.

At 0.8, 40 bands of 5 rows miss a linked pair with probability 1.3e-7.  The estimate
from 200 minima is below 0.6 at a true 0.8 with probability under 1e-10.

Defined cases: null or blank texts have an empty set, are linked with nothing and are their own
component; texts of fewer words than a shingle are one shingle; repeated rows share a
component; a null id is larger than any; very long texts have all their shingles in their set; other
columns, whatever their names, are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import set_join
from .common import id_key, releasing, save, text_or_empty
from .components import connected_components
from .textarrays import column_bytes, gram_hashes, lower_ascii, mix, word_hashes, word_spans

#: members of a bucket that one comparison block holds
BLOCK = 256
#: columns of shared shingles that one matrix product takes
COLUMNS = 4096
#: links have at least this estimated similarity (see the module text)
ESTIMATE = 0.6


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle codes of all texts end to end, bounds by text)."""
    raw, at = column_bytes(column)
    raw = lower_ascii(raw)
    begins, ends = word_spans(raw, at)
    h = word_hashes(raw, begins, ends)
    off = np.searchsorted(begins, at)
    n = len(off) - 1
    count = np.diff(off)
    grams = gram_hashes(h, words)
    place = np.arange(len(grams))
    owner = np.searchsorted(off, place, side="right") - 1
    inside = place + words <= off[owner + 1]
    code, text = grams[inside], owner[inside]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):  # the whole sequence is the one shingle; its length keeps it apart
        whole = [mix(gram_hashes(h[off[i] : off[i + 1]], int(count[i])) + np.uint64(count[i]))[0] for i in short]
        code, text = np.concatenate([code, np.array(whole, np.uint64)]), np.concatenate([text, short])
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return code[new], np.searchsorted(text[new], np.arange(n + 1))


def _coefficients(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 1 << 32, count, dtype=np.uint32)


def signatures(code: np.ndarray, bounds: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Minima of ``count`` universal hashes over each non-empty set: rows of uint32."""
    a, b = _coefficients(count, seed)
    x = (code >> np.uint64(32)).astype(np.uint32) ^ code.astype(np.uint32)
    out = np.empty((len(bounds) - 1, count), np.uint32)
    begin = bounds[:-1]
    for i in range(count):
        out[:, i] = np.minimum.reduceat(x * a[i] + b[i], begin)
    return out


def describe(docs: DataFrame, words: int, bands: int, rows: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, node (16-byte digest of the set; null if empty), bands (array), signature (binary)."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType(
        [src.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()),
         T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                code, bounds = shingle_sets(part.column(1), words)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                node: list[bytes | None] = [None] * len(size)
                band: list = [None] * len(size)
                sig: list[bytes | None] = [None] * len(size)
                if len(full):
                    s = signatures(code, np.append(bounds[full], bounds[-1]), bands * rows, seed)
                    wide = s.astype(np.uint64).reshape(len(full), bands, rows)
                    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(full), 1))
                    for r in range(rows):
                        keys = mix(keys ^ (wide[:, :, r] + np.uint64(r + 1)))
                    short = s.astype(np.uint16)
                    for j, i in enumerate(full.tolist()):
                        node[i] = hashlib.md5(code[bounds[i] : bounds[i + 1]]).digest()
                        band[i] = keys[j].view(np.int64)
                        sig[i] = short[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size), pa.array(node, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    names=schema.names,
                )

    return src.mapInArrow(releasing(run), schema)


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, codes binary) of the texts whose id is ``first_id`` of a wanted node."""
    src = docs.select(id_key(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    rows = src.join(wanted.select(id_key("first_id").alias("_id")), "_id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                code, bounds = shingle_sets(part.column(0), words)
                raw = [code[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(x).digest() for x in raw], pa.binary()), pa.array(raw, pa.binary())], names=["node", "codes"]
                )

    return rows.mapInArrow(releasing(run), "node binary, codes binary").join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _alike(a: pa.Buffer, b: pa.Buffer, count: int) -> float:
    return np.count_nonzero(np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)) / count


def _check_signatures(pairs: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """Pairs (a, b) whose signatures allow a link."""
    sig = nodes.select("node", "signature")
    joined = pairs.join(sig.select(F.col("node").alias("a"), F.col("signature").alias("_s")), "a").join(
        sig.select(F.col("node").alias("b"), F.col("signature").alias("_t")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            ok = pa.array([_alike(s.as_buffer(), t.as_buffer(), count) >= ESTIMATE for s, t in both], pa.bool_())
            yield batch.select([0, 1]).filter(ok)

    return joined.select("a", "b", "_s", "_t").mapInArrow(releasing(run), "a binary, b binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are linked: 100 * intersection >= percent * union."""
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("codes").alias("_x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("codes").alias("_y")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):  # views, no copies
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int(np.count_nonzero(x[at] == y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return joined.select("a", "b", "_x", "_y").mapInArrow(releasing(run), "a binary, b binary")


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's smallest set."""
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return buckets.join(heads, "bucket").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def _intersections(codes: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the left sets with the right ones, by products of 0/1 columns.

    Codes of one set alone cannot count and get no column."""
    size = np.fromiter(map(len, codes), np.int64, len(codes))
    _, col, count = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(codes)), size)
    shared = count[col] > 1
    place = np.cumsum(count > 1) - 1
    row, col = row[shared], place[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = int(count[count > 1].size)
    for begin in range(0, width, COLUMNS):
        a, b = np.searchsorted(col, [begin, begin + COLUMNS])
        part = np.zeros((len(codes), min(COLUMNS, width - begin)), np.float32)
        part[row[a:b], col[a:b] - begin] = 1.0
        out += part[left] @ part[right].T
    return out.astype(np.int64)


def _spanning(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of links that join components not joined by the ones before: at most one less than the components."""
    low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
    _, first = np.unique(low * (root.max() + 1) + high, return_index=True)
    parent = np.arange(root.max() + 1).tolist()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i in first.tolist():
        x, y = find(int(root[a[i]])), find(int(root[b[i]]))
        if x != y:
            parent[x] = y
            kept.append(i)
    return kept


def _open_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, n, node, root): members of the buckets which span several components."""
    tagged = buckets.join(labels.withColumnRenamed("vertex", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = tagged.groupBy("bucket").agg(F.min("root").alias("_l"), F.max("root").alias("_h"), F.count(F.lit(1)).alias("n"))
    # of a bucket of two, the one pair has been examined
    return tagged.join(open_.filter("_l <> _h AND n > 2").select("bucket", "n"), "bucket").select("bucket", "n", "node", "root")


def _cross_links(buckets: DataFrame, sets: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, count: int) -> DataFrame:
    """Links (a, b) that join components, among the members of buckets which span several of them."""
    members = save(_open_members(buckets, labels), "near-open")
    known = save(members.select("node", "root").distinct().join(sets, "node"), "near-open-sets")
    shared = save(set_join.shared_rows(set_join.prefix_rows(known, set_join.rarity(known), percent)), "near-shared")
    pairs = save(_check_signatures(set_join.candidates(shared, percent), nodes, count), "near-rare")
    crowded = save(set_join.crowded(shared), "near-crowded")
    links = _confirm(pairs, sets, percent)
    if crowded.isEmpty():
        return links
    # buckets keep only the members that need blocks, and their number of these
    rest = members.drop("n").join(crowded, "node", "left_semi")
    size = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("_l"), F.max("root").alias("_h"))
    return links.union(_block_links(rest.join(size.filter("_l <> _h").select("bucket", "n"), "bucket"), sets, percent)).distinct()


def _block_links(open_members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components inside buckets.

    Members are dealt to blocks and every pair of blocks is one group of at
    most about 2 * BLOCK sets, whatever the bucket's size.  A group compares all
    its cross-component pairs exactly and returns a spanning choice of the links."""
    members = (
        open_members.withColumn("_blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("_mine", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    )
    # a member goes once to every pair of blocks that holds its own
    spread = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "bucket", F.least("_mine", "_other").alias("_i"), F.greatest("_mine", "_other").alias("_j"), "_mine", "node", "root"
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = [np.frombuffer(x, np.uint64) for x in pdf["codes"]]
        size = np.fromiter(map(len, codes), np.int64, len(codes))
        root = pd.factorize(pdf["root"])[0]
        mine, node = pdf["_mine"].to_numpy(), pdf["node"].to_numpy()
        one, two = pdf["_i"].iloc[0], pdf["_j"].iloc[0]
        left, right = np.flatnonzero(mine == one), np.flatnonzero(mine == two)
        both = _intersections(codes, left, right)
        union = size[left][:, None] + size[right] - both
        linked = (100 * both >= percent * union) & (root[left][:, None] != root[right])
        x, y = np.nonzero(linked)
        x, y = left[x], right[y]
        if not len(x):
            return pd.DataFrame({"a": [], "b": []})
        return pd.DataFrame([(min(node[x[i]], node[y[i]]), max(node[x[i]], node[y[i]])) for i in _spanning(root, x, y)], columns=["a", "b"])

    return spread.join(sets, "node").groupBy("bucket", "_i", "_j").applyInPandas(compare, "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 5,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach), kept."""
    count = bands * rows
    described = save(describe(docs, words, bands, rows, seed, id_col, text_col), "near-described")
    nodes = save(
        described.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
        ),
        "near-nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    # only buckets with several members matter from here on
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    buckets = save(buckets.join(crowded, "bucket"), "near-buckets")
    sets = save(_sets(docs, buckets.select("node").distinct().join(nodes.select("node", "first_id"), "node"), words, id_col, text_col), "near-sets")
    pairs = save(_check_signatures(_first_pairs(buckets), nodes, count), "near-first")
    links = save(_confirm(pairs, sets, percent), "near-links")
    labels = save(connected_components(links), "near-labels")
    more = save(_cross_links(buckets, sets, labels, nodes, percent, count), "near-more")
    if not more.isEmpty():
        labels = save(connected_components(links.union(more)), "near-labels")
    place = nodes.select("node", "first_id").join(labels.withColumnRenamed("vertex", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = place.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = place.join(low, "root").select("node", "component_id")
    return (
        described.select("doc_id", "n_shingles", "node")
        .join(by_node, "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
