import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import rows_of  # noqa: E402

# a few queries of every kind; tools/check_oracle.py compares all of them
COMPARED = [
    "target_summary", "field_profile", "numeric_summary", "duplicate_rows", "unexpected_values", "case_conflicts", "quality_issues",
    "iqr_outliers", "describe", "histogram", "boxplot_stats", "stratified_split", "confusion_matrix", "input_metadata", "validate_records",
    "probability_violations", "assemble_predictions", "content_fingerprint", "csv_scan", "softmax", "bin_quantile",
]


@pytest.fixture(scope="module")
def duck():
    from tablewise.plans.fixtures import BASE_TABLES

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_gives_the_numeric_summary(spark):
    rows = {r["field"]: r for r in entry.entry(spark).collect()}
    assert {"price", "price_txt"} <= set(rows) and rows["price"]["count"] > rows["price"]["finite_count"] > 0


def test_every_query_has_doc_and_oracle_keys_exist():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert all(f.__doc__ for f in qs.values())


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    got = rows_of(entry.queries()[name](spark, SF_SMALL).toPandas())
    assert got == rows_of(duck.execute(entry.oracle_sql()[name]).df())
