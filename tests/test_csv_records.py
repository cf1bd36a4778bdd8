import csv
import io
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import types as T

from tablewise.sources import csv as csvsrc
from tablewise.sources import records


def folder():
    return tempfile.mkdtemp(prefix="tw-csv-", dir="/tmp")


def write(path, data):
    with open(path, "wb") as fh:
        fh.write(data)
    return path


@pytest.fixture
def split_size(spark):
    """Sets how many bytes of a file one task reads."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_size(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], n)

    yield set_size
    for n, v in before.items():
        if v is None:
            spark.conf.unset(n)
        else:
            spark.conf.set(n, v)


def random_file(rng, rows):
    """Bytes of a CSV and its rows as a sequential parser has them."""
    out = io.StringIO()
    out.write(rng.choice(["", "\n", "\ufeff", "\n \n"]))
    end = rng.choice(["\n", "\r\n"])
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", rng.choice(["a", 'a "b"', "a,\nb"]), "c"])
    pieces = ["x", "é", '"', ",", "\n", "\n\n", "long text " * 5, "\U0001f600", " "]
    for i in range(rows):
        a, c = ("".join(rng.choice(pieces) for _ in range(rng.randrange(rng.choice([1, 2, 9])))) for _ in range(2))
        writer.writerow([f"r{i}", f"<{a}", f"<{c}"])
        if rng.random() < 0.05:
            out.write(end)
    text = out.getvalue()
    lines = text.lstrip("\ufeff")
    parsed = [r for r in csv.reader(io.StringIO(lines, newline="")) if "".join(r).strip()]
    return text.encode(), parsed[0], parsed[1:]


@pytest.mark.parametrize("size", [64, 100, 1000, 1 << 20])
def test_records_equal_a_sequential_parser_at_every_split_size(spark, split_size, size):
    split_size(size)
    rng = random.Random(size)
    for rows in (1, 5, 60):
        data, header, want = random_file(rng, rows)
        path = write(os.path.join(folder(), "f.csv"), data)
        lines = records.lines(spark, path)
        if len(data) > 3 * size:
            assert lines.select("block").distinct().count() > 1
        got = csvsrc.csv_scan(spark, path, multiline=True)
        assert got.columns == header
        assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want)


def test_several_files_each_with_its_header(spark, split_size):
    split_size(128)
    rng, d, want = random.Random(8), folder(), []
    for i in range(4):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "text"])
        for j in range(rng.randrange(30)):
            want.append((f"{i}-{j}", "a\n\"b\" " * rng.randrange(1, 30)))
            writer.writerow(want[-1])
        write(os.path.join(d, f"{i}.csv"), out.getvalue().encode())
    assert sorted(map(tuple, csvsrc.csv_scan(spark, d, multiline=True).collect())) == sorted(want)


@pytest.mark.parametrize(
    "data",
    [b"a,b\n1,2\n2,b,c,d\n", b'a,b\n1,"open\n2,3\n', "a,b\n1,中文\n".encode("gbk"), b'a,b\n1,"x\ny"\n2,3,4\n', b'a,b\n1,"x\ny"\n2,"z\n', b"a\n1\n2,3\n"],
    ids=["extra", "open", "gbk", "extra beside line breaks", "open at the end", "one column"],
)
@pytest.mark.parametrize("multiline", [False, True])
def test_bad_files_raise(spark, data, multiline):
    with pytest.raises(csvsrc.DataLoadError):
        csvsrc.csv_scan(spark, write(os.path.join(folder(), "bad.csv"), data), multiline=multiline)


@pytest.mark.parametrize("multiline", [False, True])
def test_short_rows_end_in_nulls(spark, multiline):
    path = write(os.path.join(folder(), "short.csv"), b'a,b,c\n1,2,3\n4\n5,"6"\n' + (b'7,"x\ny",8\n' if multiline else b""))
    rows = sorted(map(tuple, csvsrc.csv_scan(spark, path, multiline=multiline).collect()))
    assert rows[:3] == ([(1, "2", 3), (4, None, None), (5, "6", None)] if multiline else [(1, 2, 3), (4, None, None), (5, 6, None)])


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])


def test_quarantine_tells_why(spark, split_size):
    split_size(64)
    bad = [b'3,"open,x', b"4,1.5,x,extra", b"five,1,x", b"6,one,x", "7,1,中".encode("gbk")]
    good = [(1, 1.5, "a"), (2, None, "say \"hi\""), (8, None, None), (9, 2.0, None)]
    data = b"\n".join([b"id,x,s", b"1,1.5,a", bad[0], b'2,,"say ""hi"""', *bad[1:], b"8", b"9,2,"])
    ok, out = csvsrc.csv_quarantine(spark, write(os.path.join(folder(), "q.csv"), data), SCHEMA)
    assert sorted(map(tuple, ok.collect())) == good
    rows = sorted((r["reason"], r["raw_record"][0]) for r in out.collect())
    assert rows == [("encoding", "7"), ("extra_fields", "4"), ("open_quote", "3"), ("type", "6"), ("type", "f")]
    assert out.columns == ["id", "x", "s", "raw_record", "reason"]


def test_quarantine_with_line_breaks_takes_an_open_quote_to_the_end(spark, split_size):
    split_size(64)
    data = b'id,x,s\n1,1,"two\nlines"\n2,2,b\n3,3,"open\n4,4,d\n5,5,e\n'
    ok, out = csvsrc.csv_quarantine(spark, write(os.path.join(folder(), "q.csv"), data), SCHEMA, multiline=True)
    assert sorted(map(tuple, ok.collect())) == [(1, 1.0, "two\nlines"), (2, 2.0, "b")]
    assert [(r["reason"], r["raw_record"]) for r in out.collect()] == [("open_quote", '3,3,"open\n4,4,d\n5,5,e')]


def test_more_blocks_than_a_broadcast_may_hold(spark, split_size, monkeypatch):
    split_size(64)
    monkeypatch.setattr(records, "broadcast_if_small", lambda df, n: df)
    data, _, want = random_file(random.Random(3), 40)
    path = write(os.path.join(folder(), "f.csv"), data)
    assert sorted(map(tuple, csvsrc.csv_scan(spark, path, multiline=True).collect())) == sorted(map(tuple, want))


def line_batches(rng, n, size):
    """Lines of random records of one block as ``records._pieces`` takes them, in batches of ``size``."""
    pa = pytest.importorskip("pyarrow")
    lines = []
    while len(lines) < n:
        rest = [rng.choice(["x", "", " ", "é,\"\"", "\ufeff"]) for _ in range(rng.randrange(5))]
        lines += ['a,"b', *rest, 'c"'] if rng.random() < 0.6 else [rng.choice(["plain", "", "  ", '"q"'])]
    odd, ok = [x.count('"') % 2 == 1 for x in lines], [rng.random() < 0.9 for _ in lines]
    out = []
    for a in range(0, len(lines), size):
        m = len(lines[a : a + size])
        columns = [["f"] * m, [0] * m, lines[a : a + size], odd[a : a + size], [False] * m, [False] * m, ok[a : a + size]]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_())
        out.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "block", "value", "odd", "begins", "firsts", "valid"]))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_records_do_not_depend_on_the_batches(size):
    for seed in range(6):
        want, got = (
            [r for b in records._pieces(iter(line_batches(random.Random(seed), 300, s))) for r in b.to_pylist() if r["text"].strip(" \ufeff")] for s in (10**6, size)
        )
        assert got == want and len(want) > 50


def test_lines_are_joined_by_arrays_not_one_by_one():
    def seconds(size):
        batches = line_batches(random.Random(1), 300_000, size)
        begun = time.perf_counter()
        for _ in records._pieces(iter(batches)):
            pass
        return time.perf_counter() - begun

    assert 2 * min(seconds(10_000) for _ in range(2)) < seconds(10**7)  # one batch holds the block's first line, which is taken by itself


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_small_batches_equal_a_sequential_parser(spark, split_size, size):
    split_size(size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rng = random.Random(size + 1)
        for rows in (5, 60):
            data, header, want = random_file(rng, rows)
            got = csvsrc.csv_scan(spark, write(os.path.join(folder(), "f.csv"), data), multiline=True)
            assert got.columns == header and sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
