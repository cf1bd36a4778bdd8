"""Source/sink queries and small lookups (B14, B15, softmax).

Sinks write into a fresh folder under the session's checkpoint root (the
shared folder named by ``spark.checkpoint.dir`` on a cluster); the data
written is always derived by Spark from the driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import explore, select
from ..session import scratch_path
from ..sources import csv as csvsrc
from ..sources import files, results
from .catalog import register
from .fixtures import duck_cte, spark_view
from .queries_prepare import split_cte
from ..functions.exprs import broadcast_if_small

OD = duck_cte("orders_dirty")
ML = duck_cte("ml_orders")
_NA = ", ".join("'" + t.replace("'", "''") + "'" for t in csvsrc.NA_TOKENS)


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"tablewise-io/{name}-{uuid.uuid4().hex[:12]}")


def _dirty_csv(spark, sf) -> str:
    path = _scratch(spark, "orders_dirty_csv")
    csvsrc.write_csv(spark_view(spark, sf, "orders_dirty"), path)
    return path


@register(
    "csv_scan",
    OD
    + f"""SELECT o_orderkey,
  CASE WHEN price_txt IS NULL OR price_txt IN ({_NA}) THEN NULL ELSE CAST(trim(price_txt) AS DOUBLE) END AS price_txt,
  CASE WHEN isnan(price) THEN NULL ELSE price END AS price,
  CASE WHEN status IN ({_NA}) THEN NULL ELSE status END AS status,
  CASE WHEN priority IN ({_NA}) THEN NULL ELSE priority END AS priority
FROM orders_dirty""",
)
def q_csv_scan(spark, sf):
    """A1: CSV written from orders_dirty, scanned back with missing tokens and inferred types."""
    return csvsrc.csv_scan(spark, _dirty_csv(spark, sf))


DIRTY_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("price_txt", T.DoubleType()),
    T.StructField("price", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("priority", T.StringType()),
])


@register("csv_quarantine")
def q_csv_quarantine(spark, sf):
    """A2: typed scan of the dirty CSV; rows whose price text is not a number are quarantined."""
    _, bad = csvsrc.csv_quarantine(spark, _dirty_csv(spark, sf), DIRTY_SCHEMA)
    return bad


@register(
    "csv_quarantine_reasons",
    OD + """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, status, priority, 'type' AS reason FROM orders_dirty
WHERE trim(price_txt) <> '' AND TRY_CAST(trim(price_txt) AS DOUBLE) IS NULL""",
)
def q_csv_quarantine_reasons(spark, sf):
    """A2: key and reason of every record of the dirty CSV that does not fit its schema."""
    _, bad = csvsrc.csv_quarantine(spark, _dirty_csv(spark, sf), DIRTY_SCHEMA)
    return bad.select("o_orderkey", "status", "priority", "reason")


@register(
    "csv_records",
    OD + """SELECT CAST(o_orderkey AS BIGINT) AS id, 'line one of ' || o_orderkey || chr(10) || 'says "' || coalesce(status, '') || '", and' || chr(10) || chr(10) || 'ends' AS note
FROM orders_dirty""",
)
def q_csv_records(spark, sf):
    """A1: a CSV whose second field has line breaks, quotes and commas, read back in blocks."""
    note = F.concat(
        F.lit("line one of "), F.col("o_orderkey").cast("string"), F.lit('\nsays "'), F.coalesce("status", F.lit("")), F.lit('", and\n\nends')
    )
    path = _scratch(spark, "notes_csv")
    csvsrc.write_csv(spark_view(spark, sf, "orders_dirty").select(F.col("o_orderkey").alias("id"), note.alias("note")), path)
    return csvsrc.csv_scan(spark, path, multiline=True)


@register("file_tree_fingerprint")
def q_file_tree_fingerprint(spark, sf):
    """A3: name, size, number of chunks and tree hash of every driver table file, of any size."""
    return files.tree_fingerprint(spark, f"{sf.rstrip('/')}/*.parquet").drop("path")


@register("file_fingerprint")
def q_file_fingerprint(spark, sf):
    """A3: name, size, modification time and SHA-256 of every driver table file."""
    return files.file_fingerprint(spark, f"{sf.rstrip('/')}/*.parquet")


@register(
    "content_fingerprint",
    """SELECT count(*) AS row_count, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM (
  SELECT CAST(('0x' || substr(md5(concat_ws('|', """
    + ", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
    + """)), 1, 15)) AS BIGINT) AS h FROM orders) z""",
)
def q_content_fingerprint(spark, sf):
    """A4: order-free content fingerprint of the orders table (unchanged-input guard)."""
    return files.content_fingerprint(spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet"))


def _oracle_of(key: str) -> str:
    from . import catalog

    return catalog.ORACLES[key]


@register("result_json", _oracle_of("numeric_summary"))
def q_result_json(spark, sf):
    """Audit result written as JSON lines (non-finite -> null) and scanned back with its schema."""
    from ..operators import audit
    from ..roles import ORDERS_DIRTY

    res = audit.numeric_summary(spark_view(spark, sf, "orders_dirty"), ORDERS_DIRTY)
    path = _scratch(spark, "numeric_summary_json")
    results.write_json(res, path)
    return results.read_results(spark, path, results.json_safe(res).schema)


@register("results_scan", _oracle_of("model_ranking"))
def q_results_scan(spark, sf):
    """Per-model result files (one folder per model) scanned back as one ranked table."""
    from .queries_eval import model_results

    res = model_results(spark, sf)
    path = _scratch(spark, "model_results")
    results.write_json(res, path, partition_by=["model"])
    csvsrc.write_csv(res, _scratch(spark, "model_results_csv"), single_file=True)
    schema = T.StructType([f for f in res.schema.fields if f.name != "model"] + [T.StructField("model", T.StringType())])
    back = results.read_results(spark, path, schema)
    return select.model_ranking(back)


def _prepared_sink_sql() -> str:
    from .queries_features import TRAIN, _edges_sql

    return (
        TRAIN + _edges_sql()
        + """SELECT split, count(*) AS rows,
  2 + (SELECT count(DISTINCT status) FROM tr) + (SELECT count(DISTINCT segment) FROM tr) + (SELECT count(*) FROM edges) - 2 AS feature_count
FROM split GROUP BY split"""
    )


@register("prepared_sink", _prepared_sink_sql())
def q_prepared_sink(spark, sf):
    """Prepared rows written partitioned by split with feature metadata, read back per split."""
    from .queries_features import Prep

    prep = Prep(spark, sf)
    f = prep.fitted
    path = _scratch(spark, "prepared")
    out = prep.prepared.select("row_id", "split", F.col("label"), F.col("features"))
    results.write_prepared(out, path, {"features": f.feature_names(), "classes": f.classes, "fit_scope": "training_only"})
    rows, meta = results.read_prepared(spark, path)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).withColumn("feature_count", F.lit(len(meta["features"])).cast("long"))


@register("model_bundle")
def q_model_bundle(spark, sf):
    """The chosen logistic model saved as a bundle, reloaded, and used to score the test rows' raw columns."""
    from ..operators import metrics
    from ..operators.predictor import Predictor, bundle_of
    from .queries_model import Trained

    t = Trained(spark, sf)
    path = _scratch(spark, "bundle")
    results.save_bundle(spark, path, bundle_of("spark_logistic", t.fitted, t.meta), t.logistic[1])
    saved = Predictor(spark, path)
    test = t.rows("test")
    done, _ = saved.predict(test.select("row_id", *saved.meta.input_columns), "row_id", mode="quarantine")
    pred = done.join(test.select("row_id", F.col("tier").alias("y")), "row_id").select("y", F.col("predicted_class").alias("p"))
    return metrics.evaluate(pred, "y", "p", saved.classes).withColumn("model", F.lit(saved.name))


@register("example_row", ML + "SELECT row_id, price, balance, status, segment FROM ml_orders WHERE row_id = (SELECT min(row_id) FROM ml_orders)")
def q_example_row(spark, sf):
    """One example input row fetched by key (the smallest key)."""
    ml = spark_view(spark, sf, "ml_orders")
    first_key = ml.agg(F.min("row_id")).first()[0]
    return ml.where(F.col("row_id") == first_key).select("row_id", "price", "balance", "status", "segment")


# Display labels for the tier codes (fixed values); T4 is left out on purpose
# so that its code is shown as is.
TIER_LABELS = {"T1": "Tier 1 (lowest)", "T2": "Tier 2", "T3": "Tier 3"}


@register(
    "label_lookup",
    ML
    + ", dim AS (" + " UNION ALL ".join(f"SELECT '{k}' AS code, '{v}' AS label" for k, v in TIER_LABELS.items()) + ")\n"
    + """SELECT d.class, coalesce(dim.label, d.class) AS display, d.count FROM (
  SELECT tier AS class, count(*) AS count FROM ml_orders GROUP BY tier) d LEFT JOIN dim ON dim.code = d.class""",
)
def q_label_lookup(spark, sf):
    """Class distribution with display labels (fallback to the code) via a broadcast dimension."""
    dim = spark.createDataFrame(list(TIER_LABELS.items()), "code string, label string")
    dist = explore.target_distribution(spark_view(spark, sf, "ml_orders"), "tier").select("class", "count")
    return dist.join(broadcast_if_small(dim, len(TIER_LABELS)), dist["class"] == dim["code"], "left").select(
        "class", F.coalesce("label", "class").alias("display"), "count"
    )


def softmax_expr(cols):
    """Stable row softmax over columns, as array<double> (JVM higher-order functions)."""
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    mx = F.array_max(arr)
    ex = F.transform(arr, lambda v: F.exp(v - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, v: a + v)
    return F.transform(ex, lambda v: v / tot)


@register(
    "softmax",
    duck_cte("ml_orders")
    + """, w AS (SELECT row_id, price / 100000.0 AS s1, balance / 2000.0 AS s2, 0.0 AS s3 FROM ml_orders),
m AS (SELECT *, greatest(s1, s2, s3) AS mx FROM w)
SELECT row_id, round(exp(s1 - mx) / (exp(s1 - mx) + exp(s2 - mx) + exp(s3 - mx)), 6) AS q1,
  round(exp(s2 - mx) / (exp(s1 - mx) + exp(s2 - mx) + exp(s3 - mx)), 6) AS q2,
  round(exp(s3 - mx) / (exp(s1 - mx) + exp(s2 - mx) + exp(s3 - mx)), 6) AS q3 FROM m""",
)
def q_softmax(spark, sf):
    """Scalar softmax: stable row softmax of three scores derived from each order."""
    ml = spark_view(spark, sf, "ml_orders").select(
        "row_id", (F.col("price") / 100000.0).alias("s1"), (F.col("balance") / 2000.0).alias("s2"), F.lit(0.0).alias("s3")
    )
    sm = softmax_expr(["s1", "s2", "s3"])
    return ml.select("row_id", *[F.round(sm[i], 6).alias(f"q{i + 1}") for i in range(3)])


def _records_source(spark, sf) -> tuple[str, T.StructType]:
    """Write the records view as a few parquet files: the stream's input folder."""
    rec = spark_view(spark, sf, "records")
    path = _scratch(spark, "records_stream_src")
    rec.repartition(4).write.mode("overwrite").parquet(path)
    return path, rec.schema


@register("stream_score")
def q_stream_score(spark, sf):
    """Streaming M11: records arrive as files; valid rows are scored by the chosen model, exactly once per file."""
    from ..streaming.scoring import stream_score
    from .queries_model import Trained

    src, schema = _records_source(spark, sf)
    t = Trained(spark, sf)
    out = _scratch(spark, "stream_out")
    scored, _rejected = stream_score(spark, src, schema, "row_id", t.meta, t.fitted, t.logistic[1], out)
    return spark.read.parquet(scored)


@register(
    "stream_rule_counts",
    split_cte("records")
    + """, tr AS (SELECT * FROM split WHERE split = 'train'),
meta AS (SELECT min(price) AS plo, max(price) AS phi, min(balance) AS blo, max(balance) AS bhi FROM tr),
e AS (SELECT list_filter([
  CASE WHEN price IS NULL THEN 'missing:price' END, CASE WHEN balance IS NULL THEN 'missing:balance' END,
  CASE WHEN status IS NULL OR trim(regexp_replace(status, '\\s', ' ', 'g')) = '' THEN 'missing:status' END,
  CASE WHEN segment IS NULL OR trim(regexp_replace(segment, '\\s', ' ', 'g')) = '' THEN 'missing:segment' END,
  CASE WHEN price IS NOT NULL AND NOT isfinite(price) THEN 'non_numeric:price' END,
  CASE WHEN isfinite(price) AND (price < plo OR price > phi) THEN 'out_of_range:price' END,
  CASE WHEN balance IS NOT NULL AND NOT isfinite(balance) THEN 'non_numeric:balance' END,
  CASE WHEN isfinite(balance) AND (balance < blo OR balance > bhi) THEN 'out_of_range:balance' END,
  CASE WHEN status IS NOT NULL AND status NOT IN (SELECT DISTINCT status FROM tr) THEN 'invalid_option:status' END,
  CASE WHEN segment IS NOT NULL AND segment NOT IN (SELECT DISTINCT segment FROM tr) THEN 'invalid_option:segment' END
  ], lambda x: x IS NOT NULL) AS errs FROM records, meta)
SELECT split_part(x, ':', 1) AS rule, split_part(x, ':', 2) AS field, count(*) AS rejected_rows FROM (SELECT unnest(errs) AS x FROM e) u GROUP BY ALL""",
)
def q_stream_rule_counts(spark, sf):
    """Streaming B9: running rejected-row counts per rule over a file stream of records."""
    from ..streaming.scoring import stream_rule_counts
    from .queries_eval import _records_meta

    src, schema = _records_source(spark, sf)
    out = _scratch(spark, "stream_counts")
    return spark.read.parquet(stream_rule_counts(spark, src, schema, _records_meta(spark, sf), out))
