import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablewise.operators import score
from tablewise.sources import csv as csvsrc

META = score.InputMetadata(("x", "category"), ("x",), ("category",), {"x": (-2.0, 2.0, "training_data")}, {"category": ("A", "B")})
GOOD = (0.5, "A")


@pytest.mark.parametrize(
    "row,code",
    [
        ((None, "A"), "missing:x"), ((0.5, None), "missing:category"), ((0.5, "  "), "missing:category"),
        ((float("nan"), "A"), "non_numeric:x"), ((float("inf"), "A"), "non_numeric:x"), ((3.0, "A"), "out_of_range:x"),
        ((-2.5, "A"), "out_of_range:x"), ((0.5, "C"), "invalid_option:category"), ((0.5, "a"), "invalid_option:category"),
    ],
)
def test_each_bad_record_rejected_with_reason(spark, row, code):
    df = spark.createDataFrame([(1, *GOOD), (2, *row)], "id long, x double, category string")
    out = {r["id"]: r for r in score.validate_records(df, "id", META).collect()}
    assert out[1]["is_valid"] is True
    assert out[2]["is_valid"] is False and code in out[2]["errors"].split(",")
    with pytest.raises(score.ValidationError):
        score.split_valid(df, "id", META, mode="strict")


def test_missing_column_raises(spark):
    df = spark.createDataFrame([(1, 0.5)], "id long, x double")
    with pytest.raises(score.ValidationError):
        score.validate_records(df, "id", META)


@pytest.mark.parametrize(
    "probs,violation",
    [((0.5, 0.6), "row_sum"), ((1.5, -0.5), "out_of_range"), ((float("nan"), 1.0), "non_finite"),
     ((float("inf"), 0.0), "non_finite"), ((0.3, 0.3), "row_sum"), ((None, 1.0), "non_finite")],
)
def test_probability_violations(spark, probs, violation):
    df = spark.createDataFrame([(1, *probs), (2, 0.25, 0.75)], "id long, p1 double, p2 double")
    got = {(r["id"], r["violation"]) for r in score.probability_violations(df, "id", ["p1", "p2"]).collect()}
    assert (1, violation) in got and not any(i == 2 for i, _ in got)


def test_columns_rules(spark):
    df = spark.createDataFrame([(1, 0.5, "A")], "id long, x double, category string")
    assert score.check_columns(df, META, "id") == []
    assert score.check_columns(df.withColumn("more", F.lit(1)), META, "id") == ["unknown_columns:more"]
    bare = score.InputMetadata(META.input_columns, META.numeric_columns, META.categorical_columns, {}, {"category": ()})
    assert score.check_columns(df, bare, "id") == ["missing_range:x", "missing_options:category"]
    with pytest.raises(score.ValidationError):
        score.split_valid(df.limit(0), "id", META, mode="strict")


def test_options_keep_any_text(spark):
    train = spark.createDataFrame([(1.0, "a|b"), (2.0, "c,d"), (3.0, None)], "x double, category string")
    meta = score.metadata_from_table(score.input_metadata(train, ["x"], ["category"]), ["x"], ["category"])
    assert meta.categorical_options == {"category": ("a|b", "c,d")} and meta.numeric_ranges["x"][:2] == (1.0, 3.0)


def test_probability_tolerance_and_shape(spark):
    df = spark.createDataFrame([(1, [0.5, 0.500009]), (2, [0.5, 0.50002]), (3, [1.0]), (4, None)], "id long, probability array<double>")
    got = {r["id"]: r["v"] for r in df.select("id", score.violations(F.col("probability"), 2).alias("v")).collect()}
    assert got == {1: [], 2: ["row_sum"], 3: ["class_count"], 4: ["class_count"]}
    with pytest.raises(score.ValidationError):
        score.check_probabilities(df.where("id = 1"), df.limit(2), "id", 2)


def test_argmax_takes_first_maximum(spark):
    df = spark.createDataFrame([(1, 0.4, 0.4, 0.2)], "id long, a double, b double, c double")
    r = score.assemble_predictions(df, "id", ["a", "b", "c"], ["A", "B", "C"]).first()
    assert r["predicted_class"] == "A" and r["probabilities"]["B"] == 0.4


def _write(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def test_bad_csv_inputs_raise_typed_errors(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-", dir="/tmp")
    empty, header_only, txt = (os.path.join(d, n) for n in ("empty.csv", "header.csv", "data.txt"))
    _write(empty, b"")
    _write(header_only, b"a,b\n")
    _write(txt, b"a,b\n1,2\n")
    for p in (empty, header_only):
        with pytest.raises(csvsrc.DataLoadError):
            csvsrc.csv_scan(spark, p, check_path=True)
    for p in (txt, os.path.join(d, "missing.csv"), d):
        with pytest.raises(csvsrc.DataLoadError):
            csvsrc.check_csv_path(p)
    gbk = os.path.join(d, "gbk.csv")
    _write(gbk, "a,b\n1,中文\n".encode("gbk"))
    assert csvsrc.invalid_utf8_lines(spark, gbk).count() == 1


def test_csv_quotes_and_line_breaks(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-", dir="/tmp")
    quoted, broken, open_quote = (os.path.join(d, n) for n in ("quoted.csv", "lines.csv", "open.csv"))
    _write(quoted, b'id,s\n1,"say ""hi"", ok"\n2,plain\n')
    assert [tuple(r) for r in csvsrc.csv_scan(spark, quoted).orderBy("id").collect()] == [(1, 'say "hi", ok'), (2, "plain")]
    _write(broken, b'id,s\n1,"two\nlines"\n2,b\n')
    assert [tuple(r) for r in csvsrc.csv_scan(spark, broken, multiline=True).orderBy("id").collect()] == [(1, "two\nlines"), (2, "b")]
    _write(open_quote, b'a,b\n"1,2\n')
    for path, multiline in ((broken, False), (open_quote, False), (open_quote, True)):
        with pytest.raises(csvsrc.DataLoadError):
            csvsrc.csv_scan(spark, path, multiline=multiline)


def test_csv_sink_round_trip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tw-csv-", dir="/tmp"), "out")
    rows = [(1, 'quote " and, comma'), (2, " spaces "), (3, None), (4, "plain")]
    csvsrc.write_csv(spark.createDataFrame(rows, "id long, s string"), path)
    assert [tuple(r) for r in csvsrc.csv_scan(spark, path).orderBy("id").collect()] == rows


def test_csv_scan_types_and_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-", dir="/tmp")
    p = os.path.join(d, "ok.csv")
    _write(p, b"id,x,s\n1,1.5,a\n2,NA,\n3,inf, b \n")
    df = csvsrc.csv_scan(spark, p)
    assert dict(df.dtypes) == {"id": "bigint", "x": "double", "s": "string"}
    rows = df.orderBy("id").collect()
    assert rows[1]["x"] is None and rows[1]["s"] is None and rows[2]["s"] == " b "
