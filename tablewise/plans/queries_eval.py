"""Evaluation, selection and scoring-validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, score, select
from .catalog import register
from .fixtures import TIER_CLASSES, duck_cte, spark_view
from .queries_prepare import ml_split, split_cte

CLASSES5 = list(TIER_CLASSES)  # declared classes incl. the absent T5
CLASSES4 = [c for c in TIER_CLASSES if c != "T5"]
PRED = duck_cte("predictions")
PROB = duck_cte("probabilities")
REC = duck_cte("records", "ml_orders")
EPO = duck_cte("epochs")

# Stored training seconds of the stand-in models (fixed values of the fixture)
# and their fixed model order; everything else is computed from the tables.
MODEL_TRAIN_S = {"rule_exact": 0.4, "rule_shift7": 0.8, "rule_price": 0.3, "rule_balance": 0.6}
MODEL_ORDER = ["rule_exact", "rule_shift7", "rule_price", "rule_balance"]
MODEL_FAMILY = {"rule_exact": "label_rules", "rule_shift7": "label_rules", "rule_price": "threshold_rules", "rule_balance": "threshold_rules"}


def _pred(spark, sf):
    return spark_view(spark, sf, "predictions")


# ---------------------------------------------------------------- SQL generators
def _cls_sql(classes) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS c" for c in classes)


def per_class_sql(src: str, classes, by: list[str]) -> str:
    """CTE ``pc``: per (group, class) tp/support/predicted and p/r/f1."""
    b = "".join(f"{x}, " for x in by)
    gb = "".join(f", {x}" for x in by)
    return f""", cls AS ({_cls_sql(classes)}),
cells AS (SELECT {b}CAST(y AS VARCHAR) AS y, CAST(p AS VARCHAR) AS p, count(*) AS n FROM {src} GROUP BY ALL),
grp AS (SELECT DISTINCT {b}1 AS one FROM cells),
pc0 AS (SELECT {''.join(f'g.{x}, ' for x in by)}cls.c AS class,
  coalesce(sum(CASE WHEN y = cls.c AND p = cls.c THEN n END), 0) AS tp,
  coalesce(sum(CASE WHEN y = cls.c THEN n END), 0) AS support,
  coalesce(sum(CASE WHEN p = cls.c THEN n END), 0) AS predicted
  FROM grp g JOIN cls ON TRUE LEFT JOIN cells x ON TRUE {''.join(f'AND x.{v} = g.{v} ' for v in by)}
  GROUP BY {''.join(f'g.{x}, ' for x in by)}cls.c),
pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM pc0),
pc AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM pc1)
"""


def summary_sql(by: list[str]) -> str:
    """SELECT list producing accuracy/macro/weighted metrics per group from ``pc``."""
    b = "".join(f"{x}, " for x in by)
    gb = ("GROUP BY " + ", ".join(by)) if by else ""
    return f"""SELECT {b}round(sum(tp) / sum(support), 6) AS accuracy,
  round(avg(prec), 6) AS macro_precision, round(avg(rec), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round(sum(prec * support) / sum(support), 6) AS weighted_precision,
  round(sum(rec * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1
FROM pc {gb}"""


# ---------------------------------------------------------------- metrics on `predictions`
@register(
    "confusion_matrix",
    PRED
    + f""", cls AS ({_cls_sql(CLASSES5)}), cells AS (SELECT y, p, count(*) AS n FROM predictions GROUP BY ALL)
SELECT a.c AS true_class, b.c AS pred_class, CAST(coalesce(n, 0) AS BIGINT) AS count
FROM cls a JOIN cls b ON TRUE LEFT JOIN cells ON y = a.c AND p = b.c""",
)
def q_confusion_matrix(spark, sf):
    """Dense 5x5 confusion matrix over the declared classes (T5 absent)."""
    return metrics.confusion_matrix(_pred(spark, sf), "y", "p", CLASSES5)


@register("accuracy", PRED + "SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM predictions")
def q_accuracy(spark, sf):
    """accuracy of the predictions."""
    return metrics.accuracy(_pred(spark, sf), "y", "p")


@register(
    "classification_report",
    PRED + per_class_sql("predictions", CLASSES5, [])
    + "SELECT class, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc",
)
def q_classification_report(spark, sf):
    """per-class precision, recall, F1, support (zero division -> 0)."""
    return metrics.classification_report(_pred(spark, sf), "y", "p", CLASSES5)


@register(
    "macro_metrics",
    PRED + per_class_sql("predictions", CLASSES5, [])
    + "SELECT round(avg(prec), 6) AS macro_precision, round(avg(rec), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM pc",
)
def q_macro_metrics(spark, sf):
    """macro precision/recall/F1 over all declared classes (absent class counts 0)."""
    return metrics.macro_metrics(_pred(spark, sf), "y", "p", CLASSES5)


@register(
    "weighted_metrics",
    PRED + per_class_sql("predictions", CLASSES5, [])
    + """SELECT round(sum(prec * support) / sum(support), 6) AS weighted_precision,
  round(sum(rec * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM pc""",
)
def q_weighted_metrics(spark, sf):
    """support-weighted precision/recall/F1."""
    return metrics.weighted_metrics(_pred(spark, sf), "y", "p", CLASSES5)


@register(
    "report_table",
    PRED + per_class_sql("predictions", CLASSES5, [])
    + """SELECT class, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc""",
)
def q_report_table(spark, sf):
    """classification report table with macro and weighted rows."""
    return metrics.report_table(_pred(spark, sf), "y", "p", CLASSES5)


@register(
    "largest_confusion",
    PRED
    + f""", cls AS (SELECT c, row_number() OVER (ORDER BY c) AS i FROM ({_cls_sql(CLASSES5)}) z),
cells AS (SELECT y, p, count(*) AS n FROM predictions GROUP BY ALL)
SELECT a.c AS true_class, b.c AS pred_class, CAST(coalesce(n, 0) AS BIGINT) AS count
FROM cls a JOIN cls b ON a.c <> b.c LEFT JOIN cells ON y = a.c AND p = b.c
ORDER BY coalesce(n, 0) DESC, a.i, b.i LIMIT 1""",
)
def q_largest_confusion(spark, sf):
    """most frequent misclassification (row-major first on ties)."""
    return metrics.largest_confusion(_pred(spark, sf), "y", "p", CLASSES5)


@register(
    "log_loss",
    duck_cte("probabilities", "ml_orders")
    + """SELECT round(-avg(ln(least(greatest(CASE tier WHEN 'T1' THEN p1 WHEN 'T2' THEN p2 WHEN 'T3' THEN p3 ELSE p4 END, 1e-12), 1.0))), 6) AS log_loss
FROM probabilities JOIN ml_orders USING (row_id)""",
)
def q_log_loss(spark, sf):
    """mean cross-entropy of the probability table against the true tier."""
    probs = spark_view(spark, sf, "probabilities")
    ml = spark_view(spark, sf, "ml_orders").select("row_id", "tier")
    idx = F.array_position(F.array(*[F.lit(c) for c in CLASSES4]), F.col("tier")) - 1
    j = probs.join(ml, "row_id").withColumn("_y", idx)
    return metrics.log_loss(j, ["p1", "p2", "p3", "p4"], "_y")


# ---------------------------------------------------------------- model results and selection
def model_results(spark, sf):
    """Validation and test metrics of each stand-in model over the exact split."""
    scored = spark_view(spark, sf, "scored_models")
    sp = ml_split(spark, sf).select("row_id", "split").where(F.col("split") != "train")
    ev = metrics.evaluate(scored.join(sp, "row_id"), "y", "p", CLASSES4, by=["model", "split"])

    def pick(split, col):
        return F.max(F.when(F.col("split") == split, F.col(col)))

    res = ev.groupBy("model").agg(
        pick("validation", "macro_f1").alias("val_macro_f1"),
        pick("validation", "accuracy").alias("val_accuracy"),
        pick("test", "macro_f1").alias("test_macro_f1"),
        pick("test", "accuracy").alias("test_accuracy"),
    )
    train_s = F.create_map(*[x for k, v in MODEL_TRAIN_S.items() for x in (F.lit(k), F.lit(v))])
    order = F.create_map(*[x for i, k in enumerate(MODEL_ORDER) for x in (F.lit(k), F.lit(i))])
    fam = F.create_map(*[x for k, v in MODEL_FAMILY.items() for x in (F.lit(k), F.lit(v))])
    return res.select(
        "model", "val_macro_f1", "val_accuracy", "test_macro_f1", "test_accuracy",
        train_s[F.col("model")].alias("train_s"), order[F.col("model")].alias("fixed_order"), fam[F.col("model")].alias("family"),
    )


def _results_sql() -> str:
    ts = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MODEL_TRAIN_S.items())
    fo = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(MODEL_ORDER))
    fa = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_FAMILY.items())
    return (
        split_cte("scored_models")
        + ", ev_src AS (SELECT s.model, sp.split, s.y, s.p FROM scored_models s JOIN split sp ON s.row_id = sp.row_id WHERE sp.split <> 'train')"
        + per_class_sql("ev_src", CLASSES4, ["model", "split"])
        + ", ev AS (" + summary_sql(["model", "split"]) + ")"
        + f""", res AS (SELECT model,
  max(CASE WHEN split = 'validation' THEN macro_f1 END) AS val_macro_f1, max(CASE WHEN split = 'validation' THEN accuracy END) AS val_accuracy,
  max(CASE WHEN split = 'test' THEN macro_f1 END) AS test_macro_f1, max(CASE WHEN split = 'test' THEN accuracy END) AS test_accuracy
  FROM ev GROUP BY model),
results AS (SELECT *, CASE model {ts} END AS train_s, CASE model {fo} END AS fixed_order, CASE model {fa} END AS family FROM res)
"""
    )


RESULTS = _results_sql()


@register("model_results", RESULTS + "SELECT model, val_macro_f1, val_accuracy, test_macro_f1, test_accuracy, train_s, fixed_order, family FROM results")
def q_model_results(spark, sf):
    """M9 input: per model validation/test accuracy and macro-F1 computed over the split."""
    return model_results(spark, sf)


_SEL = "(SELECT model FROM results ORDER BY val_macro_f1 DESC, val_accuracy DESC, train_s, fixed_order LIMIT 1)"


@register(
    "select_model",
    RESULTS + "SELECT model AS selected_model, val_macro_f1, val_accuracy FROM results ORDER BY val_macro_f1 DESC, val_accuracy DESC, train_s, fixed_order LIMIT 1",
)
def q_select_model(spark, sf):
    """Deployment choice on validation metrics only (tie-breakers: accuracy, time, fixed order)."""
    return select.select_model(model_results(spark, sf))


@register(
    "model_ranking",
    RESULTS
    + f"""SELECT row_number() OVER (ORDER BY test_macro_f1 DESC, test_accuracy DESC, model) AS rank, model, val_macro_f1, val_accuracy,
  test_macro_f1, test_accuracy, train_s, model = {_SEL} AS selected_for_deployment FROM results""",
)
def q_model_ranking(spark, sf):
    """Test ranking table with the validation-based deployment flag."""
    return select.model_ranking(model_results(spark, sf))


@register(
    "select_candidate",
    RESULTS
    + """SELECT model, val_macro_f1, val_accuracy, test_macro_f1, test_accuracy, train_s, fixed_order, family, candidate_index FROM (
  SELECT *, fixed_order AS candidate_index, row_number() OVER (PARTITION BY family ORDER BY val_macro_f1 DESC, val_accuracy DESC, train_s, fixed_order) AS r
  FROM results) z WHERE r = 1""",
)
def q_select_candidate(spark, sf):
    """Best candidate per model family on validation metrics."""
    res = model_results(spark, sf).withColumn("candidate_index", F.col("fixed_order"))
    return select.select_candidate(res, "family")


@register(
    "best_epoch",
    EPO
    + """, g AS (SELECT model, count(val_loss) AS nvl, count(val_score) AS nvs, count(*) AS trained_epochs, max(max_epochs) AS max_epochs FROM epochs GROUP BY model),
e AS (SELECT e.*, nvl, nvs, trained_epochs, g.max_epochs AS mx,
  CASE WHEN nvl > 0 THEN val_loss WHEN nvs > 0 THEN -val_score ELSE train_loss END AS m FROM epochs e JOIN g USING (model))
SELECT model, epoch AS best_epoch, CASE WHEN nvl > 0 THEN 'val_loss' WHEN nvs > 0 THEN 'val_score' ELSE 'train_loss' END AS criterion,
  trained_epochs, trained_epochs < mx AS early_stopped
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY m, epoch) AS r FROM e WHERE m IS NOT NULL) z WHERE r = 1""",
)
def q_best_epoch(spark, sf):
    """Best epoch per model (first min val loss, else first max val score, else min train loss)."""
    return select.best_epoch(spark_view(spark, sf, "epochs"))


@register(
    "ranked_probabilities",
    PROB
    + """SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY p DESC, i) AS INTEGER) AS rank, class, round(p, 6) AS probability FROM (
  SELECT row_id, 0 AS i, 'T1' AS class, p1 AS p FROM probabilities UNION ALL SELECT row_id, 1, 'T2', p2 FROM probabilities
  UNION ALL SELECT row_id, 2, 'T3', p3 FROM probabilities UNION ALL SELECT row_id, 3, 'T4', p4 FROM probabilities) u""",
)
def q_ranked_probabilities(spark, sf):
    """Classes of each row ranked by probability."""
    return select.ranked_probabilities(spark_view(spark, sf, "probabilities"), "row_id", ["p1", "p2", "p3", "p4"], CLASSES4)


# ---------------------------------------------------------------- scoring validation
def _train_rows(spark, sf):
    return ml_split(spark, sf).where(F.col("split") == "train")


def _records_meta(spark, sf):
    meta_df = score.input_metadata(_train_rows(spark, sf), ["price", "balance"], ["status", "segment"])
    return score.metadata_from_table(meta_df, ["price", "balance"], ["status", "segment"])


@register(
    "input_metadata",
    split_cte()
    + """, tr AS (SELECT * FROM split WHERE split = 'train')
SELECT 'price' AS field, 'numeric' AS kind, min(price) AS minimum, max(price) AS maximum, 'training_data' AS source, CAST(NULL AS VARCHAR) AS options FROM tr
UNION ALL SELECT 'balance', 'numeric', min(balance), max(balance), 'training_data', NULL FROM tr
UNION ALL SELECT 'status', 'categorical', NULL, NULL, 'training_data', CAST(to_json(list(DISTINCT status ORDER BY status)) AS VARCHAR) FROM tr
UNION ALL SELECT 'segment', 'categorical', NULL, NULL, 'training_data', CAST(to_json(list(DISTINCT segment ORDER BY segment)) AS VARCHAR) FROM tr""",
)
def q_input_metadata(spark, sf):
    """Scoring contract from the train rows: numeric min/max and sorted category options (as JSON)."""
    meta = score.input_metadata(_train_rows(spark, sf), ["price", "balance"], ["status", "segment"])
    return meta.withColumn("options", F.to_json("options"))


def _rules_sql() -> str:
    m = "(SELECT min(price) AS plo, max(price) AS phi, min(balance) AS blo, max(balance) AS bhi FROM tr)"
    return (
        split_cte("records")
        + f""", tr AS (SELECT * FROM split WHERE split = 'train'), meta AS {m}, e AS (SELECT row_id, list_filter([
  CASE WHEN price IS NULL THEN 'missing:price' END,
  CASE WHEN balance IS NULL THEN 'missing:balance' END,
  CASE WHEN status IS NULL OR trim(regexp_replace(status, '\\s', ' ', 'g')) = '' THEN 'missing:status' END,
  CASE WHEN segment IS NULL OR trim(regexp_replace(segment, '\\s', ' ', 'g')) = '' THEN 'missing:segment' END,
  CASE WHEN price IS NOT NULL AND NOT isfinite(price) THEN 'non_numeric:price' END,
  CASE WHEN isfinite(price) AND (price < plo OR price > phi) THEN 'out_of_range:price' END,
  CASE WHEN balance IS NOT NULL AND NOT isfinite(balance) THEN 'non_numeric:balance' END,
  CASE WHEN isfinite(balance) AND (balance < blo OR balance > bhi) THEN 'out_of_range:balance' END,
  CASE WHEN status IS NOT NULL AND status NOT IN (SELECT DISTINCT status FROM tr) THEN 'invalid_option:status' END,
  CASE WHEN segment IS NOT NULL AND segment NOT IN (SELECT DISTINCT segment FROM tr) THEN 'invalid_option:segment' END
  ], lambda x: x IS NOT NULL) AS errs FROM records, meta)
"""
    )


@register("validate_records", _rules_sql() + "SELECT row_id, array_to_string(errs, ',') AS errors, len(errs) = 0 AS is_valid FROM e")
def q_validate_records(spark, sf):
    """Per-row rule violations (missing, non-numeric, out of range, invalid option) and validity."""
    return score.validate_records(spark_view(spark, sf, "records"), "row_id", _records_meta(spark, sf))


@register(
    "rejected_by_rule",
    _rules_sql() + "SELECT split_part(x, ':', 1) AS rule, split_part(x, ':', 2) AS field, count(*) AS rejected_rows FROM (SELECT unnest(errs) AS x FROM e) u GROUP BY ALL",
)
def q_rejected_by_rule(spark, sf):
    """Number of rejected rows per rule and field."""
    return score.rejected_by_rule(spark_view(spark, sf, "records"), "row_id", _records_meta(spark, sf))


@register(
    "probability_violations",
    PROB
    + """, v AS (SELECT row_id, NOT (isfinite(p1) AND isfinite(p2) AND isfinite(p3) AND isfinite(p4)) AS nf,
  (p1 < 0 OR p1 > 1 OR p2 < 0 OR p2 > 1 OR p3 < 0 OR p3 > 1 OR p4 < 0 OR p4 > 1) AS oor,
  abs(p1 + p2 + p3 + p4 - 1.0) > 1e-6 + 1e-5 AS bs FROM probabilities)
SELECT row_id, 'non_finite' AS violation FROM v WHERE nf
UNION ALL SELECT row_id, 'out_of_range' FROM v WHERE NOT nf AND oor
UNION ALL SELECT row_id, 'row_sum' FROM v WHERE NOT nf AND bs""",
)
def q_probability_violations(spark, sf):
    """Rows of the probability table that are non-finite, outside [0,1] or do not sum to 1."""
    return score.probability_violations(spark_view(spark, sf, "probabilities"), "row_id", ["p1", "p2", "p3", "p4"])


@register(
    "assemble_predictions",
    PROB
    + """SELECT row_id, CASE WHEN p1 >= greatest(p2, p3, p4) THEN 'T1' WHEN p2 >= greatest(p3, p4) THEN 'T2' WHEN p3 >= p4 THEN 'T3' ELSE 'T4' END AS predicted_class,
  round(greatest(p1, p2, p3, p4), 6) AS highest_probability, c.class, round(c.p, 6) AS probability
FROM probabilities, unnest([{'class': 'T1', 'p': p1}, {'class': 'T2', 'p': p2}, {'class': 'T3', 'p': p3}, {'class': 'T4', 'p': p4}]) AS u(c)""",
)
def q_assemble_predictions(spark, sf):
    """Argmax class (first maximum), highest probability and the class -> probability map in long form."""
    out = score.assemble_predictions(spark_view(spark, sf, "probabilities"), "row_id", ["p1", "p2", "p3", "p4"], CLASSES4)
    long = out.select("row_id", "predicted_class", "highest_probability", F.explode("probabilities").alias("class", "probability"))
    return long.withColumn("probability", F.round("probability", 6))
