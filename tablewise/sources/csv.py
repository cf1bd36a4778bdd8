"""CSV scan with pandas-compatible missing tokens and typed-error rejection (A1, A2).

One aggregate over the lines counts open quotes and bytes that are not UTF-8.  A file whose lines are
its records is read by Spark's CSV source; line breaks inside quotes are joined by
:mod:`.records`, block by block.  Every column is read as text, the
missing-value tokens become NULL, and a second aggregate over all columns counts rows with too many
fields and decides per column whether all values are integers, numbers or text, for
``try_cast``.  Rows with too few fields end in NULLs.  Spark's ``nullValue`` takes a single token, hence the list.
"""

from __future__ import annotations

import csv
import io
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import INF_TOKENS, NUMBER_RE
from ..session import checkpoint
from . import records

# The default missing-value tokens of pandas' CSV reader.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
INT_RE = r"^[+-]?[0-9]+$"
CORRUPT = "_corrupt_record"


class DataLoadError(ValueError):
    error_code = "data_load_error"


def check_csv_path(path: str) -> None:
    """Reject a missing path, a directory or a non-.csv extension (local/posix paths)."""
    if "://" in path:
        return  # object stores: existence is checked by the scan itself
    if not os.path.exists(path):
        raise DataLoadError(f"CSV file does not exist: {os.path.basename(path)}")
    if not os.path.isfile(path):
        raise DataLoadError(f"CSV path is not a regular file: {os.path.basename(path)}")
    if not path.lower().endswith(".csv"):
        raise DataLoadError(f"data file must have a .csv extension: {os.path.basename(path)}")


def _reader(spark: SparkSession, header: bool, multiline: bool):
    """CSV reader whose quotes are doubled inside quoted fields, as pandas and RFC 4180 have them."""
    return (
        spark.read.option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
    )


def check_lines(states: DataFrame, multiline: bool) -> bool:
    """Raise for bytes that are not UTF-8 and for quoted fields left open; whether any field has a line break.

    ``states`` are the block states of a file's lines.  Without ``multiline`` a field must
    close in its line."""
    r = states.groupBy("file").agg(
        F.sum("odd_lines").alias("odd"), F.sum("invalid_lines").alias("invalid"), F.max_by("ends_inside", "block").alias("open")
    ).agg(F.sum("odd").alias("odd"), F.sum("invalid").alias("invalid"), F.max("open").alias("open")).first()
    if r["invalid"]:
        raise DataLoadError("CSV is not valid UTF-8")
    if r["open"] or (r["odd"] and not multiline):
        raise DataLoadError("CSV has a quoted field that is not closed")
    return bool(r["odd"])


def read_text_columns(spark: SparkSession, path: str, header: bool = True, multiline: bool = False) -> DataFrame:
    """All columns as strings plus ``_corrupt_record`` (PERMISSIVE)."""
    probe = _reader(spark, header, multiline).option("inferSchema", False).csv(path)
    fields = [T.StructField(c, T.StringType(), True) for c in probe.columns]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        _reader(spark, header, multiline)
        .schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def _na_to_null(c: str):
    return F.when(~F.col(c).isin(*NA_TOKENS), F.col(c))


def _type_counts(columns: list[str]) -> list:
    """Per column the number of values, of integers and of numbers, as aggregates."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.trim(F.col(c))
        num = v.rlike(NUMBER_RE) | F.lower(v).isin(*INF_TOKENS)
        aggs += [
            F.count(F.col(c)).alias(f"n{i}"),
            F.count(F.when(v.rlike(INT_RE), 1)).alias(f"i{i}"),
            F.count(F.when(num, 1)).alias(f"d{i}"),
        ]
    return aggs


def _types_of(r, columns: list[str]) -> dict:
    """'bigint' if every value is an integer, 'double' if every value is a number (or an infinity spelling), else 'string'."""
    out = {}
    for i, c in enumerate(columns):
        n = r[f"n{i}"]
        if n > 0 and r[f"i{i}"] == n:
            out[c] = "bigint"
        elif n > 0 and r[f"d{i}"] == n:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def infer_types(df: DataFrame, columns: list[str]) -> dict:
    """Per column 'bigint', 'double' or 'string'.  One aggregation."""
    return _types_of(df.agg(*_type_counts(columns)).first(), columns)


def _fields(text, names: list[str]) -> list:
    """A record's fields as text columns; those it does not have are null."""
    schema = ", ".join(f"f{i} string" for i in range(len(names)))
    parsed = F.from_csv(text, schema, {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    return [parsed[f"f{i}"].alias(n) for i, n in enumerate(names)]


def _names(first: str, header: bool) -> list[str]:
    """Column names from the first record; unnamed ones and, with their number, repeated ones as Spark's source has them."""
    fields = next(csv.reader(io.StringIO(first, newline="")))
    lower = [f.lower() for f in fields]
    return [f"_c{i}" if not (header and f) else f"{f}{i}" if lower.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


_EXTRA = "_extra_fields"


def _text_rows(spark: SparkSession, path: str, header: bool, multiline: bool) -> tuple[DataFrame, list[str]]:
    """Rows of text fields and whether they have too many, and the column names."""
    lines = records.lines(spark, path)
    states = checkpoint(records.block_states(lines))  # a row a block
    broken = check_lines(states, multiline)
    if not broken:
        raw = read_text_columns(spark, path, header)
        cols = [c for c in raw.columns if c != CORRUPT]
        if not cols:
            raise DataLoadError("CSV has no columns")
        extra = F.coalesce(records.field_count(F.col(CORRUPT)) > len(cols), F.lit(False))
        return raw.select(*[_na_to_null(c).alias(c) for c in cols], extra.alias(_EXTRA)), cols
    found = records.records(lines, states)
    cols = _names(found.where("first").select("text").first()["text"], header)
    found = found.where("NOT first") if header else found
    rows = found.select(*_fields(F.col("text"), cols), (records.field_count(F.col("text")) > len(cols)).alias(_EXTRA))
    return rows.select(*[_na_to_null(c).alias(c) for c in cols], _EXTRA), cols


def csv_scan(spark: SparkSession, path: str, header: bool = True, check_path: bool = False, multiline: bool = False) -> DataFrame:
    """A1: read a CSV as pandas would: missing tokens -> NULL, inferred numeric types, short rows ending in NULLs.

    ``multiline`` allows line breaks inside quoted fields; such files are read in blocks all the
    same.  Without it a file that has such a field is rejected, never misread.
    Raises ``DataLoadError`` for empty or header-only input, for a quoted field left open, for bytes that
    are not UTF-8 and for rows with too many fields (the whole input is rejected)."""
    if check_path:
        check_csv_path(path)
    rows, cols = _text_rows(spark, path, header, multiline)
    # all columns are in this aggregate: the source would not see extra fields if any were pruned
    probe = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(_EXTRA).alias("extra"), *_type_counts(cols)).first()
    if probe["rows"] == 0:
        raise DataLoadError("CSV has no data rows")
    if probe["extra"]:
        raise DataLoadError("CSV has rows with too many fields")
    types = _types_of(probe, cols)
    return rows.select(*[F.col(c) if types[c] == "string" else F.trim(F.col(c)).try_cast(types[c]).alias(c) for c in cols])


def csv_quarantine(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                   multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """A2 (lenient form): typed scan; records that do not fit are returned
    separately with their raw text and the reason instead of failing the whole file.

    Reasons, the first that holds: ``encoding`` (not UTF-8; replacement characters stand in the raw text), ``open_quote``
    (without ``multiline`` a record is a line; with it, an open quote takes the rest of its
    file), ``extra_fields``, ``type`` (a value that is not of its column's type).  Missing
    fields and empty values are NULL; spellings of infinity are numbers, as in ``csv_scan``."""
    lines = records.lines(spark, path)
    found = records.records(lines, checkpoint(records.block_states(lines)), joined=multiline)
    found = found.where("NOT first") if header else found
    names, text = schema.fieldNames(), F.col("text")
    rows = found.select("*", F.struct(*_fields(text, [f"f{i}" for i in range(len(names))])).alias("_v"))
    value = [F.when(F.col("_v")[f"f{i}"] != "", F.col("_v")[f"f{i}"]) for i in range(len(names))]
    typed = [v if isinstance(f.dataType, T.StringType) else F.trim(v).try_cast(f.dataType) for v, f in zip(value, schema.fields)]
    misfit = F.array_contains(F.array(*[v.isNotNull() & t.isNull() for v, t in zip(value, typed)]), True)
    reason = (
        F.when(~F.col("valid"), "encoding").when(~F.col("closed"), "open_quote")
        .when(records.field_count(text) > len(names), "extra_fields").when(misfit, "type")
    )
    rows = rows.select(*[t.alias(n) for t, n in zip(typed, names)], text.alias("raw_record"), reason.alias("reason"))
    return rows.where(F.col("reason").isNull()).drop("raw_record", "reason"), rows.where(F.col("reason").isNotNull())


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV sink keeping whitespace and distinguishing NULL from empty text."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def invalid_utf8_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2: lines holding bytes that are not valid UTF-8.  The text source keeps
    each line's raw bytes, so ``is_valid_utf8`` sees them (the CSV reader would
    have replaced them with U+FFFD)."""
    return (
        spark.read.text(path)
        .select(F.input_file_name().alias("path"), F.col("value"))
        .where(~F.is_valid_utf8(F.col("value")))
    )
