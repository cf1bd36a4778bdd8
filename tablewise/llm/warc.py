"""WARC archives: distributed writing with revisit records, and a boundary-verified reader.

Writing.  Every page becomes a record.  Of pages with equal payloads the one
with the smallest id is a ``response`` (HTTP header and payload), the others
are ``revisit`` records that refer to it.  Digests are grouped with map-side
combination; records are written by Spark's text writer with the record
terminator as line separator, so commits are those of Spark's file committer.

Reading.  Spark's text reader with the record magic as line separator cuts an
archive into segments in parallel, also inside large files.  A segment start is
only a candidate record: the magic may occur in a payload.  Each task emits its
candidates with the offset of their successor (header length + Content-Length
+ terminator) and, by pointer jumping inside the split, the offset where
their chain leaves the split.  Pointer jumping over these exits from the file
start finds each split's true entry, and following the entry's chain marks the
reachable records; everything else is payload.  Records whose payload holds the
magic are put together from their segments in a second read of only those.

A file is sound if its chain ends at its last byte.  Where a chain breaks off, a record is cut short or
no record begins the file, ``read_archive`` raises :class:`ArchiveError` with the file and the two
offsets, or with ``broken="skip"`` gives the records up to there; ``problems`` lists such files.
Records of WARC 1.0 and 1.1 are read, 1.1 is written; compressed files are read by one task each.

Defined cases: null html is an empty payload; rows that repeat page_id and
payload are each a response; a null page_id is written as ``null``, counts as
larger than any other and reads back as null; CR and LF in a URL are
percent-encoded; very long payloads are whole; an empty table gives an empty result, an empty file no record; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import releasing, save, text_or_empty

MAGIC = "WARC/1.1\r\n"
#: what files are cut at: the magic of both versions up to its last digit
MARK = "WARC/1."
_VERSIONS = (b"0\r\n", b"1\r\n")
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: needed segments are broadcast up to this many rows (about 100 bytes each), joined by shuffle beyond
BROADCAST_SEGMENTS = 50_000


class ArchiveError(ValueError):
    """A file whose records do not reach its end."""


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 5 bytes are 8 digits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, html, digest, refers_to (null for a response)."""
    html = text_or_empty(html_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        payload_digest(F.encode(html, "utf-8")).alias("digest"),
    )
    first = (
        pages.select(F.col(id_col).alias("page_id"), payload_digest(F.encode(html, "utf-8")).alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("_first"))
    )
    return rows.join(first.hint("merge"), "digest").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    ).drop("_first")


def write_archive(
    pages: DataFrame,
    path: str,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = 100_000,
    compression: str = "none",
    id_col: str = "page_id",
    html_col: str = "html",
    url_col: str = "url",
) -> None:
    """Write ``pages`` as WARC files under ``path`` (a shared folder)."""
    rows = with_revisits(pages, id_col, html_col, url_col)
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    is_revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), url,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("_block").cast("string"), F.lit(END),
    )
    (
        rows.withColumn("_block", block)
        .select(F.concat(head, F.col("_block")).alias("value"))
        .write.option("lineSep", END)
        .option("compression", compression)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Archive bytes cut at the magic: file, split (its start), value; in order within a split."""
    return (
        spark.read.option("lineSep", MARK)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    )


def parse_block(block: bytes) -> tuple[int, bytes]:
    """(length of the HTTP header, payload) of a record's block; without header all is payload."""
    if block.startswith(b"HTTP/"):
        end = block.find(b"\r\n\r\n")
        if end >= 0:
            return end + 4, block[end + 4 :]
    return 0, block


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(segment: bytes) -> tuple[int, dict[str, str]] | None:
    """Header length after the mark and fields by lower-case name, or None if it is no record header."""
    end = segment.find(b"\r\n\r\n")
    if end < 0 or segment[:3] not in _VERSIONS:
        return None
    fields = {}
    for line in segment[3:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return end + 4, fields


_SEGMENT_SCHEMA = (
    "file string, split long, at long, size long, head int, length long, record_type string, record_id string, "
    "uri string, digest string, refers string, whole boolean, payload_bytes long, payload_digest string"
)
_ARROW = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("head", pa.int32()), ("length", pa.int64())]
    + [(c, pa.string()) for c in ("record_type", "record_id", "uri", "digest", "refers")]
    + [("whole", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Describe each segment: its place in the split, and the record that would start there.

    ``at`` is the offset of the segment's magic, relative to the split's first
    byte that no earlier split consumed; ``length`` runs to the successor.
    """
    here: tuple[str, int] | None = None
    at = 0
    for batch in batches:
        rows = []
        for file, split, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != here:
                here, at = (file, split), -len(MARK)
            row = [file, split, at, len(value) + len(MARK), None, None, None, None, None, None, None, None, None, None]
            at += len(value) + len(MARK)
            if got := _headers(value):
                head, fields = got
                size = int(fields["content-length"])
                if len(value) >= head + size + len(END) and not value.startswith(END.encode(), head + size):
                    got = None  # a record whose length is wrong is none
            if got:
                length = len(MARK) + head + size + len(END)
                whole = len(value) - head >= size
                digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
                row[4:12] = [head, length, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), digest, fields.get("warc-refers-to"), whole]
                if whole:
                    _, payload = parse_block(value[head : head + size])
                    row[12:] = [len(payload), base32_sha1(payload)]
            rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW) if rows else pa.RecordBatch.from_pylist([], _ARROW)


def _chain(off: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor among ``off`` (sorted), len(off) if outside."""
    at = np.searchsorted(off, nxt)
    inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == nxt) if len(off) else np.zeros(0, bool)
    return np.where(inside, at, len(off))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where each candidate's chain leaves the split (``leaves``), by pointer jumping."""
    pdf = pdf.sort_values("off").reset_index(drop=True)
    n = len(pdf)
    nxt = pdf["nxt"].to_numpy()
    step = _chain(pdf["off"].to_numpy(), nxt)
    up = np.where(step < n, step, np.arange(n))
    while True:
        far = up[up]
        if (far == up).all():
            break
        up = far
    return pdf.assign(leaves=nxt[up])


def _reached(pdf: pd.DataFrame) -> pd.DataFrame:
    """Offsets on the chain of the split's entries, by pointer jumping from them."""
    pdf = pdf.sort_values("off").reset_index(drop=True)
    n = len(pdf)
    jump = np.append(_chain(pdf["off"].to_numpy(), pdf["nxt"].to_numpy()), n)
    on = np.append(pdf["entry"].to_numpy(bool), False)
    while (jump[:-1] < n).any():
        on[jump[on]] = True
        on[n] = False
        jump = jump[jump]
    return pdf.loc[on[:-1], ["file", "off"]]


def scan_archive(spark: SparkSession, path: str) -> DataFrame:
    """All segments of the archive with absolute offsets (``off`` of the magic, ``nxt`` of the successor)."""
    found = save(_segments(spark, path).mapInArrow(releasing(_scan), _SEGMENT_SCHEMA), "warc-segments")
    used = found.groupBy("file", "split").agg(F.sum("size").alias("_used"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = used.withColumn("_base", F.coalesce(F.sum("_used").over(before), F.lit(0))).drop("_used")
    return (
        found.join(base.hint("merge"), ["file", "split"])
        .withColumn("off", F.col("at") + F.col("_base"))
        .withColumn("nxt", F.col("off") + F.col("length"))
        .drop("_base")
    )


def reachable(segments: DataFrame) -> DataFrame:
    """(file, off) of the records on the chain from each file's start."""
    links = segments.filter("nxt IS NOT NULL AND off >= 0").select("file", "split", "off", "nxt")
    links = save(
        links.groupBy("file", "split").applyInPandas(_exits, "file string, split long, off long, nxt long, leaves long"), "warc-links"
    )
    entries = links.filter("off = 0").select("file", "off")
    jumps = links.select("file", "off", F.col("leaves").alias("to"))
    known = entries.count()
    while known:
        ahead = entries.join(jumps.hint("merge"), ["file", "off"]).select("file", F.col("to").alias("off"))
        there = ahead.join(links.select("file", "off").hint("merge"), ["file", "off"], "left_semi")
        entries = save(entries.union(there).distinct(), "warc-entries")
        now = entries.count()
        if now == known:
            break
        known = now
        far = jumps.select("file", F.col("off").alias("to"), F.col("to").alias("_far"))
        jumps = save(jumps.join(far.hint("merge"), ["file", "to"], "left").select("file", "off", F.coalesce("_far", "to").alias("to")), "warc-jumps")
    marked = links.join(entries.withColumn("entry", F.lit(True)).hint("merge"), ["file", "off"], "left").select(
        "file", "split", "off", "nxt", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    return marked.groupBy("file", "split").applyInPandas(_reached, "file string, off long")


def _assemble(pieces: Column) -> Column:
    """Bytes of a record from its segments in order, the magic between them."""
    parts = F.transform(F.array_sort(pieces), lambda p: p["value"])
    return F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        F.element_at(parts, 1),
        lambda acc, x: F.concat(acc, F.lit(MARK).cast("binary"), x),
    )


_PAYLOAD_SCHEMA = "file string, off long, payload binary"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for raw in batch.column(2).to_pylist():
            head, fields = _headers(raw)
            out.append(parse_block(raw[head : head + int(fields["content-length"])])[1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["file", "off", "payload"])


def read_payloads(spark: SparkSession, path: str, segments: DataFrame, records: DataFrame) -> DataFrame:
    """(file, off, payload) of ``records`` (file, off): their segments are read again and joined in order."""
    on = records.select("file", "off").withColumn("_start", F.col("off"))
    order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        segments.join(reachable_starts(segments), ["file", "off"], "left")
        .withColumn("_owner", F.last("_true", ignorenulls=True).over(order))
        .join(on.select("file", F.col("_start").alias("_owner")), ["file", "_owner"], "left_semi")
        .select("file", "split", "at", "off", "_owner")
    )
    owned = save(owned, "warc-owned")
    if owned.count() <= BROADCAST_SEGMENTS:
        owned = F.broadcast(owned)
    pieces = _segments(spark, path).mapInArrow(releasing(_places), "file string, split long, at long, value binary").join(owned, ["file", "split", "at"])
    whole = pieces.groupBy("file", "_owner").agg(_assemble(F.collect_list(F.struct("off", "value"))).alias("raw"))
    return whole.select("file", F.col("_owner").alias("off"), "raw").mapInArrow(releasing(_payloads), _PAYLOAD_SCHEMA)


def reachable_starts(segments: DataFrame) -> DataFrame:
    return reachable(segments).withColumn("_true", F.col("off"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each segment's place in its split, counted as in :func:`_scan`."""
    here: tuple[str, int] | None = None
    at = 0
    for batch in batches:
        places = []
        sizes = pc.binary_length(batch.column(2)).to_pylist()
        for file, split, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes, strict=True):
            if (file, split) != here:
                here, at = (file, split), -len(MARK)
            places.append(at)
            at += size + len(MARK)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(places, pa.int64()), batch.column(2)], names=["file", "split", "at", "value"]
        )


def problems(segments: DataFrame, records: DataFrame) -> DataFrame:
    """file, file_bytes, verified_bytes of each file whose chain of ``records`` (file, off, nxt) does not end at its end."""
    ends = segments.groupBy("file").agg(F.max(F.col("off") + F.col("size")).alias("file_bytes"))
    sound = records.join(ends.hint("merge"), "file").where("nxt <= file_bytes").groupBy("file").agg(F.max("nxt").alias("verified_bytes"))
    found = ends.join(sound.hint("merge"), "file", "left").withColumn("verified_bytes", F.coalesce("verified_bytes", F.lit(0).cast("long")))
    return found.where("verified_bytes <> file_bytes")


def read_archive(spark: SparkSession, path: str, broken: str = "raise") -> DataFrame:
    """One row per record: file, off, record_type, record_id, uri, digest, refers, payload_bytes, payload_digest.

    A file that is not sound raises :class:`ArchiveError`; with ``broken="skip"`` its records up to the break are given.

    The last two are computed from the bytes read (null for a revisit, which
    has none); :func:`read_payloads` gives the bytes themselves.
    """
    segments = save(scan_archive(spark, path), "warc-scanned")
    records = save(segments.join(reachable(segments).hint("merge"), ["file", "off"]), "warc-records")
    bad = save(problems(segments, records), "warc-problems")
    if broken == "raise" and (first := bad.first()):
        raise ArchiveError(f"{first.file}: records reach byte {first.verified_bytes} of {first.file_bytes}; {bad.count()} such files")
    # only the last record of a file's chain can be cut short
    cut = bad.select("file", F.col("file_bytes").alias("_end"))
    records = records.join(cut.hint("merge"), "file", "left").where("_end IS NULL OR nxt <= _end").drop("_end")
    parted = records.filter("NOT whole").select("file", "off")
    if not parted.isEmpty():
        mended = read_payloads(spark, path, segments, parted)
        digests = mended.select(
            "file", "off", F.octet_length("payload").cast("long").alias("_bytes"), payload_digest(F.col("payload")).alias("_digest")
        )
        records = records.join(digests, ["file", "off"], "left").withColumns(
            {"payload_bytes": F.coalesce("_bytes", "payload_bytes"), "payload_digest": F.coalesce("_digest", "payload_digest")}
        )
    revisit = F.col("record_type") == "revisit"
    return records.select(
        "file", "off", "record_type", "record_id", "uri", "digest", "refers",
        F.when(~revisit, F.col("payload_bytes")).alias("payload_bytes"),
        F.when(~revisit, F.col("payload_digest")).alias("payload_digest"),
    )


def resolve(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit takes length and digest from the response it refers to.
    """
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) AS {id_type})")
    rows = records.withColumns({"page_id": page("record_id"), "refers_to": page("refers")})
    responses = rows.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("digest"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    ).dropDuplicates(["refers_to", "digest"])
    return rows.join(responses.hint("merge"), ["refers_to", "digest"], "left").select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
