"""File and content fingerprints (A3, A4).

``file_fingerprint`` hashes whole files: short ones with the ``binaryFile`` source, longer ones part by
part, a task a part, which hands the state of the hash on to the next.  ``tree_fingerprint`` hashes files of any size: fixed chunks are
hashed side by side from byte ranges, and a file's hash is that of its chunks' hashes, by two levels.
``content_fingerprint`` is order-free and distributed: row count, the sum
(as an exact decimal) and the XOR of a per-row md5 prefix.  It is the guard
that the input did not change while a job ran.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


class InputChangedError(RuntimeError):
    pass


#: bytes of a file that one task reads for its SHA-256, and that it holds at a time
PART_BYTES, READ_BYTES = 256 << 20, 1 << 20


def file_fingerprint(spark: SparkSession, path_glob: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Name, size, modification time and SHA-256 of every file under the glob, of any size."""
    files = spark.read.format("binaryFile").load(path_glob)
    columns = [F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), F.col("sha256")]
    short = files.where(F.col("length") <= part_bytes).withColumn("sha256", F.sha2(F.col("content"), 256)).select(*columns)
    long = files.where(F.col("length") > part_bytes).select("path", "length", "modificationTime").collect()  # a row a file, no contents
    if not long:
        return short
    hashes = spark.createDataFrame(_long_hashes(spark, [(r["path"], r["length"]) for r in long], part_bytes), "path string, sha256 string")
    facts = files.where(F.col("length") > part_bytes).select("path", "length", "modificationTime")
    return short.unionByName(facts.join(hashes, "path").select(*columns))


def _libcrypto() -> ctypes.CDLL | None:
    """OpenSSL, whose SHA-256 state is plain memory, unlike that of hashlib."""
    name = ctypes.util.find_library("crypto")
    lib = ctypes.CDLL(name) if name else None
    return lib if lib is not None and hasattr(lib, "SHA256_Update") else None


_STATE_BYTES = 112  # of OpenSSL's SHA256_CTX


def _long_hashes(spark: SparkSession, files: list[tuple[str, int]], part_bytes: int) -> list[tuple[str, str]]:
    """(path, SHA-256) of files of more than one part.

    A SHA-256 goes through its file from the front, so the parts of a file follow each other, a job a round;
    the files of a round are hashed side by side.  Without OpenSSL the last task of a file reads all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _libcrypto()
        for batch in batches:
            found = []
            for path, length, start, state in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stop = min(start + part_bytes, length)
                plain = hashlib.sha256() if lib is None else None
                memory = ctypes.create_string_buffer(state or bytes(_STATE_BYTES), _STATE_BYTES)
                if lib is not None and start == 0:
                    lib.SHA256_Init(memory)
                at = start if lib is not None else 0 if stop == length else stop
                with _open(path) as file:
                    file.seek(at)
                    while at < stop:
                        data = file.read(min(READ_BYTES, stop - at))
                        if not data:
                            raise InputChangedError(f"{path} became shorter while it was read")
                        if lib is None:
                            plain.update(data)
                        else:
                            lib.SHA256_Update(memory, data, ctypes.c_size_t(len(data)))
                        at += len(data)
                digest = None
                if stop == length and lib is None:
                    digest = plain.hexdigest()
                elif stop == length:
                    out = ctypes.create_string_buffer(32)
                    lib.SHA256_Final(out, memory)
                    digest = out.raw.hex()
                found.append((path, length, stop, memory.raw, digest))
            if found:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=["path", "length", "start", "state", "sha256"])

    left, done = [(p, n, 0, None) for p, n in files], []
    while left:
        rows = spark.createDataFrame(spark.sparkContext.parallelize(left, len(left)), "path string, length long, start long, state binary")
        got = rows.mapInArrow(run, "path string, length long, start long, state binary, sha256 string").collect()
        done += [(r["path"], r["sha256"]) for r in got if r["sha256"] is not None]
        left = [(r["path"], r["length"], r["start"], bytes(r["state"])) for r in got if r["sha256"] is None]
    return done


#: bytes of one leaf of the tree hash, leaves below one inner node, and bytes that one task reads at a time
LEAF_BYTES, NODE_LEAVES, RANGE_BYTES = 1 << 20, 4096, 64 << 20


def _open(path: str) -> pa.NativeFile:
    """A file to read in places, by its address as Spark gives it."""
    if "://" not in path and not path.startswith("file:"):
        return pa.OSFile(path)
    address = urlsplit(path)
    if address.scheme == "file":
        return pa.OSFile(unquote(address.path))
    files, inner = fs.FileSystem.from_uri(path)
    return files.open_input_file(inner)


def leaf_hashes(spark: SparkSession, path_glob: str, leaf_bytes: int = LEAF_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, leaf, sha256 (binary) of every chunk of ``leaf_bytes``; a task holds one chunk at a time.

    Executors open the files themselves, through pyarrow's file systems."""
    step = max(1, range_bytes // leaf_bytes) * leaf_bytes
    sizes = spark.read.format("binaryFile").load(path_glob).select("path", "length")
    starts = sizes.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))).alias("start"))
    # ranges are dealt out evenly, however large their files are
    ranges = starts.repartition("path", "start").select("path", "start", F.least(F.col("start") + step, "length").alias("stop"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = []
                with _open(path) as file:
                    file.seek(start)
                    for at in range(start, stop, leaf_bytes):
                        data = file.read(min(leaf_bytes, stop - at))
                        if len(data) != min(leaf_bytes, stop - at):
                            raise InputChangedError(f"{path} became shorter while it was read")
                        found.append((path, at // leaf_bytes, hashlib.sha256(data).digest()))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["path", "leaf", "sha256"])

    return ranges.mapInArrow(run, "path string, leaf long, sha256 binary")


def tree_fingerprint(spark: SparkSession, path_glob: str, leaf_bytes: int = LEAF_BYTES, node_leaves: int = NODE_LEAVES,
                     range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A3: path, name, size_bytes, leaves, tree_sha256 of every file under the glob, of any size.

    A leaf is the SHA-256 of ``leaf_bytes`` bytes, a node that of the hexadecimal hashes of ``node_leaves``
    leaves in order, the tree's hash that of its nodes' hexadecimal hashes in order.  Spark lists no empty files."""
    def joined(order: str, value):
        return F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value.alias("h")))), lambda x: x["h"]), ""), 256)

    leaves = leaf_hashes(spark, path_glob, leaf_bytes, range_bytes).withColumn("node", F.floor(F.col("leaf") / node_leaves))
    nodes = leaves.groupBy("path", "node").agg(joined("leaf", F.lower(F.hex("sha256"))).alias("h"), F.count(F.lit(1)).alias("n"))
    trees = nodes.groupBy("path").agg(joined("node", F.col("h")).alias("tree_sha256"), F.sum("n").alias("leaves"))
    sizes = spark.read.format("binaryFile").load(path_glob).select("path", F.col("length").alias("size_bytes"))
    return sizes.join(trees, "path").select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "size_bytes", "leaves", "tree_sha256")


def row_hash(df: DataFrame, bits_hex: int = 15):
    """md5 of the row's text form, first ``bits_hex`` hex digits as a long.

    Every value carries its length, so no content can shift a field's border."""
    def field(c):
        v = F.col(c).cast("string")
        return F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("N"))

    text = F.concat_ws("|", *[field(c) for c in df.columns])
    return F.conv(F.substring(F.md5(text), 1, bits_hex), 16, 10).cast("long")


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint: row count, decimal sum and XOR of a 60-bit row hash."""
    h = row_hash(df)
    return df.select(h.alias("_h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("_h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("_h").alias("hash_xor"),
    )


def guard_unchanged(before: Row, after: Row) -> None:
    """A4: raise when two evaluated fingerprints differ."""
    if tuple(before) != tuple(after):
        raise InputChangedError("input changed while the job ran")


@contextmanager
def unchanged(open_input: Callable[[], DataFrame]) -> Iterator[DataFrame]:
    """A4: give the input to a job and raise if its content differs when the job ends.

    ``open_input`` opens the source anew for each of the two readings: an
    opened DataFrame keeps the file list of the moment it was opened."""
    df = open_input()
    before = content_fingerprint(df).first()
    yield df
    guard_unchanged(before, content_fingerprint(open_input()).first())
