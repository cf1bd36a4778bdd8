import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import types as T

from tablewise.llm import warc
from tablewise.llm.common import shared_path

PAGES = T.StructType([T.StructField(c, t) for c, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()), ("digest", T.StringType()), ("off", T.LongType()))])


def sequential(path):
    """A reader that walks each file from its start: (type, id, refers, payload)."""
    out = []
    for name in sorted(glob.glob(path.removeprefix("file://") + "/part-*")):
        raw = open(name, "rb").read()
        raw = gzip.decompress(raw) if name.endswith(".gz") else raw
        at = 0
        while at < len(raw):
            assert raw.startswith(b"WARC/1.1\r\n", at)
            end = raw.index(b"\r\n\r\n", at) + 4
            fields = dict(x.split(": ", 1) for x in raw[at:end].decode().split("\r\n")[1:-2])
            block = raw[end : end + int(fields["Content-Length"])]
            at = end + len(block) + 4
            assert raw[at - 4 : at] == b"\r\n\r\n"
            out.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), block.split(b"\r\n\r\n", 1)[1]))
    return out


def forged(i):
    inner = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
    return f"<p>before {i}</p>{inner}{inner}after WARC/1.1\r\n and WARC/1.1\r\nno header"


def pages(spark, htmls, ids=None):
    ids = list(range(len(htmls))) if ids is None else ids
    return spark.createDataFrame([(i, f"http://x/{i}\r\nA: b" if i == 3 else None if i == 4 else f"http://x/{i}", h, "d", 1) for i, h in zip(ids, htmls, strict=True)], PAGES)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip_with_magic_in_payloads(spark, compression):
    htmls = [f"<html>{i} é {'x' * (i * 37 % 900)}</html>" for i in range(60)]
    for i in (5, 17, 18, 40):
        htmls[i] = forged(i)
    htmls[30], htmls[31], htmls[7], htmls[9], htmls[50], htmls[41] = htmls[2], htmls[2], None, "", "y" * 60_000, forged(40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = shared_path(spark, "test-warc")
    try:
        warc.write_archive(pages(spark, htmls), path, compression=compression, records_per_file=25)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # many splits, also inside records
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        records = warc.read_archive(spark, path)
        got = {r.page_id: r for r in warc.resolve(records).collect()}
        walked = sequential(path)
        assert sorted((r.record_type, r.record_id, r.refers or "") for r in records.collect()) == sorted((a, b, c or "") for a, b, c, _ in walked)
        segments = warc.scan_archive(spark, path)
        whole = warc.read_payloads(spark, path, segments, records)
        assert sorted(bytes(r.payload) for r in whole.collect()) == sorted(p for *_, p in walked)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert set(got) == set(range(60))
    first = {}
    for i, h in enumerate(htmls):
        first.setdefault(h or "", i)
    for i, h in enumerate(htmls):
        is_first = first[h or ""] == i
        assert (got[i].payload_bytes, got[i].payload_digest) == (len((h or "").encode()), digest(h))
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if is_first else ("revisit", first[h or ""]))


def test_ties_null_ids_and_empty(spark):
    path = shared_path(spark, "test-warc")
    warc.write_archive(pages(spark, ["a", "a", "a", "b"], [2, 2, None, None]), path)
    out = sorted(((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in warc.resolve(warc.read_archive(spark, path)).collect()))
    assert out == [(False, 2, "response", None), (False, 2, "response", None), (True, 0, "response", None), (True, 0, "revisit", 2)]
    path = shared_path(spark, "test-warc")
    warc.write_archive(pages(spark, ["a"]).limit(0), path)
    assert warc.resolve(warc.read_archive(spark, path)).count() == 0


def record(i, payload, version="1.1", length=None):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: http://x/{i}\r\nContent-Length: {length or len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive(spark, data):
    path = shared_path(spark, "test-warc-file").removeprefix("file:")
    import os

    os.makedirs(path)
    with open(f"{path}/part-0", "wb") as fh:
        fh.write(data)
    return path


@pytest.mark.parametrize("version", ["1.0", "1.1"])
def test_both_versions_are_read(spark, version):
    path = archive(spark, b"".join(record(i, b"a WARC/1.0\r\n b %d" % i, version) for i in range(3)))
    got = sorted((r.page_id, r.payload_bytes) for r in warc.resolve(warc.read_archive(spark, path)).collect())
    assert got == [(i, len(b"a WARC/1.0\r\n b 0")) for i in range(3)]


@pytest.mark.parametrize(
    "data, verified, ids",
    [
        (record(1, b"abcd") + b"junk\r\n\r\n" + record(2, b"b") + record(3, b"c"), len(record(1, b"abcd")), [1]),
        (record(1, b"abcd") + record(2, b"efgh")[:-6], len(record(1, b"abcd")), [1]),
        (record(1, b"abcd")[:-2], 0, []),
        (record(1, b"abcd", length=7) + record(2, b"b"), 0, []),
        (b"no archive at all", 0, []),
        (b"junk before " + record(1, b"abcd"), 0, []),
    ],
    ids=["junk between", "cut record", "cut end", "wrong length", "foreign", "junk before"],
)
def test_files_that_are_not_sound_raise_or_are_read_up_to_the_break(spark, data, verified, ids):
    path = archive(spark, data)
    with pytest.raises(warc.ArchiveError, match=f"reach byte {verified} of {len(data)}"):
        warc.read_archive(spark, path)
    got = warc.read_archive(spark, path, broken="skip")
    rows = got.collect()
    assert [(r.record_id, r.payload_bytes) for r in rows] == [(f"<urn:page:{i}>", 4) for i in ids]


def test_an_empty_file_has_no_record(spark):
    assert warc.read_archive(spark, archive(spark, b"")).count() == 0
