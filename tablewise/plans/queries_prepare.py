"""Cleaning and splitting queries."""

from __future__ import annotations

from dataclasses import replace

from ..operators import prepare
from ..roles import ML_ORDERS, ORDERS_DIRTY
from .catalog import register
from .fixtures import SPLIT_SEED, TIER_CLASSES, duck_cte, spark_view

OD = duck_cte("orders_dirty")
ML = duck_cte("ml_orders")

# Roles for cleaning the dirty view: price is the numeric column, the raw
# price text is carried along untouched.
CLEAN_ROLES = replace(ORDERS_DIRTY, numeric=("price",), excluded=("o_orderkey", "price_txt"))
STATUS_TARGET = replace(ORDERS_DIRTY, target="status", categorical=())


def _od(spark, sf):
    return spark_view(spark, sf, "orders_dirty")


def _ml(spark, sf):
    return spark_view(spark, sf, "ml_orders")


def ml_split(spark, sf):
    """ml_orders with the seeded exact stratified split column."""
    return prepare.stratified_split(_ml(spark, sf), "row_id", "tier", (0.70, 0.15, 0.15), SPLIT_SEED)


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _blank_null(c: str) -> str:
    return f"CASE WHEN {_strip(c)} <> '' THEN {_strip(c)} END"


# Split oracle: quotas by largest remainder in SQL, rows ranked by md5 order.
SPLIT_BODY = f""", cc AS (SELECT tier, count(*) AS n_c FROM ml_orders GROUP BY tier),
tot AS (SELECT sum(n_c) AS n, floor(0.7 * sum(n_c)) AS n_tr FROM cc),
s1 AS (SELECT tier, n_c, n_c / n * n_tr AS cont, floor(n_c / n * n_tr) AS fl, n_tr FROM cc, tot),
s1r AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, tier) AS rr, n_tr - sum(fl) OVER () AS need FROM s1),
qt AS (SELECT tier, n_c, CAST(fl + CASE WHEN rr <= need THEN 1 ELSE 0 END AS BIGINT) AS q_tr FROM s1r),
tot2 AS (SELECT sum(n_c - q_tr) AS nr, floor(0.5 * sum(n_c - q_tr)) AS n_v FROM qt),
s2 AS (SELECT tier, n_c, q_tr, (n_c - q_tr) / nr * n_v AS cont, floor((n_c - q_tr) / nr * n_v) AS fl, n_v FROM qt, tot2),
s2r AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, tier) AS rr, n_v - sum(fl) OVER () AS need FROM s2),
quota AS (SELECT tier, q_tr, CAST(fl + CASE WHEN rr <= need THEN 1 ELSE 0 END AS BIGINT) AS q_v FROM s2r),
ranked AS (SELECT m.*, row_number() OVER (PARTITION BY tier ORDER BY md5(concat_ws(':', '{SPLIT_SEED}', CAST(row_id AS VARCHAR))), row_id) - 1 AS pos
           FROM ml_orders m),
split AS (SELECT r.row_id, r.price, r.balance, r.status, r.segment, r.tier,
  CASE WHEN pos < q_tr THEN 'train' WHEN pos < q_tr + q_v THEN 'validation' ELSE 'test' END AS split
  FROM ranked r JOIN quota q ON r.tier = q.tier)
"""


def split_cte(*views: str) -> str:
    """WITH clause: ml_orders (+ other views) and the oracle split table ``split``."""
    return duck_cte("ml_orders", *views) + SPLIT_BODY


SPLIT_CTE = split_cte()


@register(
    "clean",
    OD
    + f"""SELECT o_orderkey, price_txt, CASE WHEN isfinite(CAST(price AS DOUBLE)) THEN CAST(price AS DOUBLE) END AS price,
  {_blank_null('status')} AS status, {_blank_null('priority')} AS priority
FROM (SELECT DISTINCT * FROM orders_dirty) d""",
)
def q_clean(spark, sf):
    """Dedupe, numeric coercion with +-Inf -> NULL, stripped categories and target."""
    return prepare.clean(_od(spark, sf), CLEAN_ROLES)


@register(
    "clean_summary",
    OD
    + f"""SELECT (SELECT count(*) FROM orders_dirty) AS rows_before,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_dirty) d WHERE {_blank_null('priority')} IS NOT NULL) AS rows_after,
  (SELECT count(*) FROM orders_dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_dirty) d) AS duplicate_rows_removed,
  CAST(0 AS BIGINT) AS numeric_outliers_removed""",
)
def q_clean_summary(spark, sf):
    """Rows before and after cleaning and duplicates removed."""
    return prepare.clean_summary(_od(spark, sf), CLEAN_ROLES)


@register("deduplicate", OD + "SELECT DISTINCT * FROM orders_dirty")
def q_deduplicate(spark, sf):
    """Exact duplicate rows dropped."""
    return prepare.deduplicate(_od(spark, sf))


@register(
    "target_missing",
    OD + f"""SELECT o_orderkey, status AS raw_target FROM orders_dirty WHERE ({_blank_null('status')}) IS NULL""",
)
def q_target_missing(spark, sf):
    """Quarantine of rows whose target (here the status column) is missing after stripping."""
    return prepare.target_missing(_od(spark, sf), STATUS_TARGET)


@register("stratified_split", SPLIT_CTE + "SELECT row_id, tier, split FROM split")
def q_stratified_split(spark, sf):
    """G1: exact seeded stratified 70/15/15 split via distributed per-class cut points."""
    return ml_split(spark, sf).select("row_id", "tier", "split")


@register(
    "split_overlap",
    SPLIT_CTE
    + """SELECT CAST(0 AS BIGINT) AS overlapping_keys,
  (SELECT count(*) FROM ml_orders m WHERE NOT EXISTS (SELECT 1 FROM split s WHERE s.row_id = m.row_id)) AS unassigned_keys,
  count_if(split = 'train') AS train_rows, count_if(split = 'validation') AS validation_rows,
  count_if(split = 'test') AS test_rows, count(*) AS total_rows FROM split""",
)
def q_split_overlap(spark, sf):
    """The splits are disjoint and cover every row; sizes per split."""
    return prepare.split_overlap(ml_split(spark, sf), "row_id")


@register("split_select", SPLIT_CTE + "SELECT row_id, price, balance, status, segment, tier FROM split WHERE split = 'train'")
def q_split_select(spark, sf):
    """The train rows of the split."""
    return prepare.split_select(ml_split(spark, sf), "train")


_CLASSES_SQL = " UNION ALL ".join(f"SELECT '{c}' AS class" for c in TIER_CLASSES)


@register(
    "split_class_distribution",
    SPLIT_CTE
    + f""", cls AS ({_CLASSES_SQL}), sp AS (SELECT 'train' AS split UNION ALL SELECT 'validation' UNION ALL SELECT 'test'),
cells AS (SELECT split, tier AS class, count(*) AS count FROM split GROUP BY ALL),
tots AS (SELECT split, sum(count) AS sample_count FROM cells GROUP BY split)
SELECT sp.split, cls.class, CAST(coalesce(c.count, 0) AS BIGINT) AS count, CAST(coalesce(t.sample_count, 0) AS BIGINT) AS sample_count,
  round(coalesce(coalesce(c.count, 0) / t.sample_count, 0.0), 6) AS ratio
FROM sp JOIN cls ON TRUE LEFT JOIN cells c ON c.split = sp.split AND c.class = cls.class LEFT JOIN tots t ON t.split = sp.split""",
)
def q_split_class_distribution(spark, sf):
    """F8: sample count and class distribution per split over the declared classes."""
    return prepare.split_class_distribution(ml_split(spark, sf), "tier", list(TIER_CLASSES))


@register(
    "unseen_labels",
    SPLIT_CTE + "SELECT DISTINCT tier AS class FROM split WHERE tier NOT IN (SELECT tier FROM split WHERE split = 'train')",
)
def q_unseen_labels(spark, sf):
    """Classes that occur in the data but not in the train split."""
    return prepare.unseen_labels(ml_split(spark, sf), "tier")
