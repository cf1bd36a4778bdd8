"""Stand-in inputs built from the driver tables (FIXTURES.md part 2).

Each view is one SQL text in the dialect shared by Spark and DuckDB.  Spark
reads it with table names bound to ``parquet.`path``` sources; the DuckDB
oracles inline the very same text as CTEs.  The views only shape rows into
the schemas the jobs expect (dirt injection, a derived target); none of the
jobs' own work happens here.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# ---- fixed values of the fixtures (FIXTURES.md §2) -------------------------
STATUS_OPTIONS = ("F", "O", "P")
PRIORITY_OPTIONS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PRICE_RANGE = (1.0, 600000.0)
TIER_CLASSES = ("T1", "T2", "T3", "T4", "T5")  # T5 never occurs
SPLIT_SEED = 42
SPLIT_FRACTIONS = (0.70, 0.15, 0.15)
# ---------------------------------------------------------------------------

VIEWS: dict[str, str] = {}

VIEWS["orders_dirty"] = """
SELECT * FROM (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
         WHEN o_orderkey % 89 = 0 THEN 'inf'
         WHEN o_orderkey % 83 = 0 THEN ''
         WHEN o_orderkey % 79 = 0 THEN '-5.0'
         ELSE CAST(o_totalprice AS STRING) END AS price_txt,
    CASE WHEN o_orderkey % 89 = 0 THEN CAST('Infinity' AS DOUBLE)
         WHEN o_orderkey % 83 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN o_orderkey % 79 = 0 THEN CAST(-5 AS DOUBLE)
         WHEN o_orderkey % 73 = 0 THEN CAST(0 AS DOUBLE)
         ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 71 = 0 THEN concat(' ', o_orderstatus, ' ')
         WHEN o_orderkey % 67 = 0 THEN lower(o_orderstatus)
         WHEN o_orderkey % 61 = 0 THEN '  '
         WHEN o_orderkey % 59 = 0 THEN CAST(NULL AS STRING)
         ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 53 = 0 THEN '1-URGNT'
         WHEN o_orderkey % 47 = 0 THEN '3-MEDIUMM'
         ELSE o_orderpriority END AS priority
  FROM {orders}
) d
UNION ALL
SELECT * FROM (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
         WHEN o_orderkey % 89 = 0 THEN 'inf'
         WHEN o_orderkey % 83 = 0 THEN ''
         WHEN o_orderkey % 79 = 0 THEN '-5.0'
         ELSE CAST(o_totalprice AS STRING) END AS price_txt,
    CASE WHEN o_orderkey % 89 = 0 THEN CAST('Infinity' AS DOUBLE)
         WHEN o_orderkey % 83 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN o_orderkey % 79 = 0 THEN CAST(-5 AS DOUBLE)
         WHEN o_orderkey % 73 = 0 THEN CAST(0 AS DOUBLE)
         ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 71 = 0 THEN concat(' ', o_orderstatus, ' ')
         WHEN o_orderkey % 67 = 0 THEN lower(o_orderstatus)
         WHEN o_orderkey % 61 = 0 THEN '  '
         WHEN o_orderkey % 59 = 0 THEN CAST(NULL AS STRING)
         ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 53 = 0 THEN '1-URGNT'
         WHEN o_orderkey % 47 = 0 THEN '3-MEDIUMM'
         ELSE o_orderpriority END AS priority
  FROM {orders}
  WHERE o_orderkey % 101 = 0
) r
"""

VIEWS["ml_orders"] = """
SELECT row_id, price, balance, status, segment,
  CASE WHEN z < 0.35 THEN 'T1' WHEN z < 0.60 THEN 'T2'
       WHEN z < 0.90 THEN 'T3' ELSE 'T4' END AS tier
FROM (
  SELECT o_orderkey AS row_id, o_totalprice AS price, c_acctbal AS balance,
         o_orderstatus AS status, c_mktsegment AS segment,
         o_totalprice / 500000.0 + c_acctbal / 50000.0
           + CASE WHEN o_orderstatus = 'F' THEN 0.25 ELSE 0.0 END AS z
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
) j
"""

VIEWS["predictions"] = """
SELECT row_id, tier AS y,
  CASE WHEN row_id % 7 = 0 THEN
         CASE tier WHEN 'T1' THEN 'T2' WHEN 'T2' THEN 'T3'
                   WHEN 'T3' THEN 'T4' ELSE 'T1' END
       WHEN row_id % 11 = 0 THEN 'T2'
       ELSE tier END AS p
FROM {ml_orders} m
"""

VIEWS["probabilities"] = """
SELECT row_id,
  CASE WHEN row_id % 211 = 0 THEN 1.5 ELSE w1 / (w1 + w2 + w3 + w4) END AS p1,
  w2 / (w1 + w2 + w3 + w4) AS p2,
  w3 / (w1 + w2 + w3 + w4) AS p3,
  w4 / (w1 + w2 + w3 + w4) AS p4
FROM (
  SELECT row_id,
    CAST(1 + (row_id * 3) % 11 AS DOUBLE) AS w1,
    CAST(1 + (row_id * 5) % 13 AS DOUBLE) AS w2,
    CAST(1 + (row_id * 7) % 17 AS DOUBLE) AS w3,
    CAST(1 + (row_id * 2) % 7 AS DOUBLE) AS w4
  FROM {ml_orders} m
) w
"""

VIEWS["records"] = """
SELECT row_id,
  CASE WHEN row_id % 109 = 0 THEN CAST(9e9 AS DOUBLE) ELSE price END AS price,
  CASE WHEN row_id % 113 = 0 THEN CAST(NULL AS DOUBLE) ELSE balance END AS balance,
  CASE WHEN row_id % 107 = 0 THEN 'Z' WHEN row_id % 103 = 0 THEN ' ' ELSE status END AS status,
  segment
FROM {ml_orders} m
"""

# Per-"model" scored rows derived from ml_orders: four rule-based scorers of
# different quality stand in for trained models so that ranking, selection
# and candidate choice run over metrics computed from the whole table.
VIEWS["scored_models"] = """
SELECT 'rule_exact' AS model, row_id, tier AS y, tier AS p FROM {ml_orders} m
UNION ALL
SELECT 'rule_shift7' AS model, row_id, tier AS y,
  CASE WHEN row_id % 7 = 0 THEN CASE tier WHEN 'T1' THEN 'T2' WHEN 'T2' THEN 'T3'
       WHEN 'T3' THEN 'T4' ELSE 'T1' END ELSE tier END AS p FROM {ml_orders} m
UNION ALL
SELECT 'rule_price' AS model, row_id, tier AS y,
  CASE WHEN price < 100000 THEN 'T1' WHEN price < 200000 THEN 'T2'
       WHEN price < 300000 THEN 'T3' ELSE 'T4' END AS p FROM {ml_orders} m
UNION ALL
SELECT 'rule_balance' AS model, row_id, tier AS y,
  CASE WHEN balance < 1000 THEN 'T1' WHEN balance < 4000 THEN 'T2'
       WHEN balance < 7000 THEN 'T3' ELSE 'T4' END AS p FROM {ml_orders} m
"""

# Epoch histories derived from lineitem: one "model" per return flag, one
# epoch per ship year; losses are per-year means of table columns.  Flag 'N'
# carries only a validation score, as sklearn-style models report.
VIEWS["epochs"] = """
SELECT model, epoch, train_loss,
  CASE WHEN model = 'N' THEN CAST(NULL AS DOUBLE) ELSE val_loss END AS val_loss,
  val_score, max_epochs
FROM (
  SELECT l_returnflag AS model,
    CAST(year(l_shipdate) - 1991 AS INTEGER) AS epoch,
    round(avg(l_discount) * 10, 3) AS train_loss,
    round(avg(l_tax) * 10, 3) AS val_loss,
    round(avg(l_quantity) / 50, 3) AS val_score,
    CAST(10 AS INTEGER) AS max_epochs
  FROM {lineitem}
  GROUP BY l_returnflag, year(l_shipdate)
) e
"""


def _refs_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def render(name: str, table_ref) -> str:
    """Expand a view's SQL, resolving nested views and base-table references."""
    sql = VIEWS[name]
    out = sql
    for ref in _refs_in(sql):
        if ref in VIEWS:
            out = out.replace("{" + ref + "}", "(" + render(ref, table_ref) + ")")
        else:
            out = out.replace("{" + ref + "}", table_ref(ref))
    return out


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a fixture view over the parquet tables in ``sf_dir``."""
    sf = sf_dir.rstrip("/")
    sql = render(name, lambda t: f"parquet.`{sf}/{t}.parquet`")
    return spark.sql(sql)


def duck_cte(*names: str) -> str:
    """``WITH`` clause defining the named views for a DuckDB oracle."""
    done: list[str] = []

    def visit(n: str) -> None:
        for ref in _refs_in(VIEWS[n]):
            if ref in VIEWS and ref not in done:
                visit(ref)
        if n not in done:
            done.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in done:
        body = VIEWS[n]
        for ref in _refs_in(body):
            body = body.replace("{" + ref + "}", ref)
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
