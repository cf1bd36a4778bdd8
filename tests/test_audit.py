"""Audit operators on an inventory of tools: own frames, expectations counted by hand."""

import math

import pytest

from tablewise.operators import audit
from tablewise.roles import Roles

SCHEMA = "sku string, price double, stock double, colour string, grade double, shelf string"
ROLES = Roles(
    key="sku", numeric=("price", "stock"), categorical=("colour", "grade"), target="shelf", excluded=("sku",),
    required=("sku", "price", "stock", "colour", "grade", "shelf"),
    ranges={"price": (0.5, 900.0)}, allowed={"colour": ("red", "blue", "dark green"), "grade": (1, 2)},
    allowed_targets=("top", "low"), imbalance_warning=3.0,
)
ROWS = [
    ("a", 12.0, 3.0, "red", 1.0, "top"),
    ("b", -2.0, 0.0, " red", 2.0, "top"),
    ("c", 950.0, math.inf, "Red", 1.0, "top"),
    ("d", math.nan, 7.0, "   ", 3.0, "top"),
    ("e", 0.0, -math.inf, "dark gren", None, "low"),
    ("e", 0.0, -math.inf, "dark gren", None, "low"),
    ("e", 0.0, -math.inf, "dark gren", None, "low"),
    ("f", 40.0, 5.0, None, 2.0, "bottom"),
]


@pytest.fixture(scope="module")
def tools(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_field(df):
    return {r["field"]: r for r in df.collect()}


def test_counts_of_the_table(tools):
    assert audit.dataset_summary(tools, ROLES).first()["row_count"] == 8
    assert audit.missing_total(tools).first()["total_missing"] == 1 + 1 + 3  # a NaN price, a colour, three grades
    dup = audit.duplicate_rows(tools).first()
    assert (dup["duplicate_row_count"], dup["duplicate_row_ratio"]) == (2, 0.25)
    groups = audit.duplicate_groups(tools).collect()
    assert [(g["sku"], g["multiplicity"]) for g in groups] == [("e", 3)]


def test_numeric_counters(tools):
    q = by_field(audit.numeric_quality(tools, ROLES))
    assert (q["price"]["negative_count"], q["price"]["zero_count"], q["price"]["outside_range_count"]) == (1, 3, 5)
    assert (q["stock"]["infinite_count"], q["stock"]["zero_count"], q["stock"]["unreasonable_zero_count"]) == (4, 1, 0)
    s = by_field(audit.numeric_summary(tools, ROLES))
    assert (s["stock"]["count"], s["stock"]["finite_count"]) == (8, 4)


def test_categories(tools):
    q = by_field(audit.categorical_quality(tools, ROLES))
    assert (q["colour"]["whitespace_count"], q["colour"]["empty_string_count"]) == (2, 1)
    assert [(r["field"], r["n_spellings"]) for r in audit.case_conflicts(tools, ROLES).collect()] == [("colour", 2)]
    near = {(r["left"], r["right"]) for r in audit.similar_values(tools, ROLES).collect()}
    assert ("dark gren", "dark green") in near and not any("blue" in p for p in near)


def test_allow_list_compares_values_in_the_columns_type(tools):
    got = {(r["field"], r["value"]) for r in audit.unexpected_values(tools, ROLES).collect()}
    assert got == {("grade", "3.0"), ("colour", " red"), ("colour", "Red"), ("colour", "   "), ("colour", "dark gren"), ("shelf", "bottom")}


def test_case_folding_is_full(spark):
    roles = Roles(key=None, numeric=(), categorical=("street",), target=None)
    df = spark.createDataFrame([("Straße",), ("STRASSE",), ("Weg",)], "street string")
    assert [r["spellings"] for r in audit.case_conflicts(df, roles).collect()] == ["STRASSE|Straße"]
    assert audit.similar_values(df, roles).count() == 0


def test_target_balance(tools):
    r = audit.target_summary(tools, ROLES).first()
    assert (r["class_count"], r["most_frequent"], r["least_frequent"], r["max_min_ratio"], r["is_imbalanced"]) == (3, "top", "bottom", 4.0, True)


def test_schema_rules(spark):
    df = spark.createDataFrame([("red", None, "a", 1)], "colour string, price double, sku string, depth int")
    roles = Roles(key="sku", numeric=("price",), categorical=("colour",), target="shelf")
    codes = {r["code"]: r["fields"] for r in audit.schema_issues(df, roles).collect()}
    assert codes == {"missing_columns": "shelf", "extra_columns": "depth", "column_order_mismatch": "", "all_null_columns": "price"}


@pytest.mark.parametrize("allowed", [False, True])
def test_invalid_schema_is_what_the_roles_do_not_allow(spark, allowed):
    df = spark.createDataFrame([("x", None), ("y", None)], "sku string, price double")
    roles = Roles(key="sku", numeric=("price",), categorical=(), target=None, allow_all_null=allowed)
    found = {r["code"] for r in audit.quality_issues(df, roles).collect()}
    assert ("schema_invalid" in found) is not allowed
    assert audit.schema_valid(df, roles) is allowed


def test_issue_list(tools):
    issues = {(r["code"], r["field"]): r for r in audit.quality_issues(tools, ROLES).collect()}
    assert issues[("duplicate_rows", None)]["detail"] == "2" and issues[("missing_values", None)]["detail"] == "5"
    assert "outside_range_count=5" in issues[("numeric_quality", "price")]["detail"]
    assert issues[("unexpected_target_values", "shelf")]["detail"] == "1"
    assert "case_conflicts=1" in issues[("categorical_quality", "colour")]["detail"]
    assert issues[("similar_values", "colour")]["detail"].startswith("similar_pairs=")
    assert ("schema_invalid", None) not in issues


def test_a_registered_issue_list_is_the_whole_one(spark):
    import __spark_entry__ as entry
    import bench
    from conftest import SF_SMALL

    rows = {k: {tuple(r) for r in entry.queries()[k](spark, SF_SMALL).collect()} for k in ("quality_issues", "similar_issues", "quality_issues_full")}
    assert rows["similar_issues"] and rows["quality_issues_full"] == rows["quality_issues"] | rows["similar_issues"]
    assert "quality_issues_full" in bench.HEADLINE
