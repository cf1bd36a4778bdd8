"""Composite jobs: the public commands of the reference as Spark jobs.

Each job reads a DataFrame, writes tidy result tables under ``out_dir``
(parquet; JSON for small summaries) and returns the written paths.  ``run_all``
takes the input's content fingerprint before and after, so it fails if the
input changed while it ran (A4).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, explore, features, metrics, predictor, prepare, score, select
from ..operators import train as tr
from ..roles import Roles
from ..session import checkpoint
from ..sources import files, results
from .grids import LOGISTIC_CANDIDATES, MLP_CANDIDATES


def _write(tables: dict, out_dir: str) -> dict:
    paths = {}
    for name, df in tables.items():
        p = f"{out_dir}/{name}"
        results.write_json(df, p)
        paths[name] = p
    return paths


def audit_job(df: DataFrame, roles: Roles, out_dir: str) -> dict:
    """audit-data: schema check, profile, quality counters, issues."""
    tables = {
        "dataset_summary": audit.dataset_summary(df, roles),
        "schema_issues": audit.schema_issues(df, roles),
        "field_profile": audit.field_profile(df, roles),
        "missing_total": audit.missing_total(df),
        "duplicate_rows": audit.duplicate_rows(df),
        "numeric_summary": audit.numeric_summary(df, roles),
        "numeric_quality": audit.numeric_quality(df, roles),
        "iqr_outliers": audit.iqr_outliers(df, roles),
        "categorical_quality": audit.categorical_quality(df, roles),
        "case_conflicts": audit.case_conflicts(df, roles),
        "similar_values": audit.similar_values(df, roles),
        "unexpected_values": audit.unexpected_values(df, roles),
        "value_distribution": audit.value_distribution(df, [*roles.categorical, roles.target]),
        "target_summary": audit.target_summary(df, roles),
        "quality_issues": audit.quality_issues(df, roles),
    }
    return _write(tables, out_dir)


def prepare_job(df: DataFrame, roles: Roles, out_dir: str, fractions=(0.7, 0.15, 0.15), seed: int = 42,
                n_bins: int = 20, strategy: str = "quantile"):
    """prepare-data: clean, split, fit features on train, persist prepared rows."""
    cleaned = prepare.clean(df, roles)
    split = checkpoint(prepare.stratified_split(cleaned, roles.key, roles.target, fractions, seed))
    train = split.where(F.col("split") == "train")
    unseen = prepare.unseen_labels(split, roles.target).limit(1).collect()
    if unseen:
        raise ValueError(f"train split misses target classes, e.g. {unseen[0][0]}")
    fitted = features.fit_features(train, list(roles.numeric), list(roles.categorical), roles.target, n_bins, strategy)
    prepared = fitted.transform(split, keep=[roles.key, "split"])
    results.write_prepared(prepared, f"{out_dir}/prepared", {"features": fitted.feature_names(), "classes": fitted.classes})
    meta_table = score.input_metadata(
        train, list(roles.numeric), list(roles.categorical), {c: r for c, r in roles.ranges.items() if c in roles.numeric})
    paths = _write({
        "clean_summary": prepare.clean_summary(df, roles),
        "split_class_distribution": prepare.split_class_distribution(split, roles.target, fitted.classes),
        "input_metadata": meta_table,
    }, out_dir)
    return paths, fitted, score.metadata_from_table(meta_table, list(roles.numeric), list(roles.categorical))


def eda_job(df: DataFrame, roles: Roles, out_dir: str) -> dict:
    """run-eda: descriptive statistics of all cleaned rows (images are out of scope)."""
    num, cat, t = list(roles.numeric), list(roles.categorical), roles.target
    return _write({
        "describe": explore.describe(df, num),
        "correlation_matrix": explore.correlation_matrix(df, num),
        "strongest_pair": explore.strongest_pair(df, num),
        "group_means": explore.group_means(df, t, num),
        "classes_by_mean": explore.classes_by_mean(df, t, num, num[0]),
        "widest_feature": explore.widest_feature(df, t, num),
        "group_medians": explore.group_medians(df, t, num),
        "target_distribution": explore.target_distribution(df, t),
        "crosstab_ratio": explore.crosstab_ratio(df, t, cat),
        "group_mean_range": explore.group_mean_range(df, t, num),
        "histogram": explore.histogram(df, num),
        "category_frequencies": explore.category_frequencies(df, cat),
        "boxplot_stats": explore.boxplot_stats(df, t, num),
        **({"scatter": explore.scatter_sample(df, roles.key, t, num[0], num[1], num[0])} if len(num) > 1 and roles.key else {}),
    }, out_dir)


MODEL_ORDER = ("spark_logistic", "spark_mlp", "softmax_gd", "mlp_gd")
METRICS = "model string, split string, accuracy double, macro_precision double, macro_recall double, macro_f1 double, weighted_f1 double"


def _predictions(probs: DataFrame, classes: list[str]) -> DataFrame:
    """True and predicted class names from ``label`` and ``probability``."""
    names = F.array(*[F.lit(c) for c in classes])
    p = F.col("probability")
    return probs.select(
        F.element_at(names, F.col("label").cast("int") + 1).alias("y"), F.element_at(names, F.array_position(p, F.array_max(p)).cast("int")).alias("p")
    )


def train_job(prepared: DataFrame, fitted, meta, out_dir: str, grid: dict | None = None) -> dict:
    """train: the four model families on the train rows, candidates chosen on
    validation macro-F1; candidates, epoch histories, times and a bundle of each
    chosen model are written.  ``grid`` holds the families' parameters; without it all
    default candidates are fitted."""
    spark = prepared.sparkSession
    default = {
        "logistic": tuple((c["C"], c["class_weight"] == "balanced") for c in LOGISTIC_CANDIDATES), "mlp": MLP_CANDIDATES,
        "mlp_args": {}, "softmax": {}, "mlp_gd": {},
    }
    grid = default | (grid or {})
    classes = fitted.classes
    train, val = (checkpoint(prepared.where(F.col("split") == s)) for s in ("train", "validation"))
    n = float(train.count())
    rows, fits = [], []
    weighted = tr.with_balanced_weights(train, train)
    for i, (C, balanced) in enumerate(grid["logistic"]):
        begun = time.perf_counter()
        model = tr.logistic_estimator(C, n, balanced).fit(weighted if balanced else train)
        ev = metrics.evaluate(tr.predict_labels(model, val, classes), "y", "p", classes).first()
        rows.append(("spark_logistic", i, json.dumps({"C": C, "balanced": balanced}), ev["macro_f1"], ev["accuracy"], time.perf_counter() - begun))
        fits.append((model, None))
    if grid["mlp"]:
        for i, (params, run) in enumerate(zip(grid["mlp"], tr.train_mlp_grid(train, list(grid["mlp"]), **grid["mlp_args"]))):
            result = tr.GDResult({"network": run.recipe.network, "theta": run.stop.kept}, [h[:3] for h in run.history], run.stop.best_epoch, len(run.history), run.seconds)
            ev = metrics.evaluate(_predictions(tr.gd_probabilities(val, result, len(classes)), classes), "y", "p", classes).first()
            rows.append(("spark_mlp", i, json.dumps(params), ev["macro_f1"], ev["accuracy"], run.seconds))
            fits.append((None, result))
    for name, fit, args in (("softmax_gd", tr.train_softmax_gd, grid["softmax"]), ("mlp_gd", tr.train_mlp_gd, grid["mlp_gd"])):
        result = fit(train, val, **args)
        ev = metrics.evaluate(_predictions(tr.gd_probabilities(val, result, len(classes)), classes), "y", "p", classes).first()
        rows.append((name, 0, json.dumps(args), ev["macro_f1"], ev["accuracy"], result.train_seconds))
        fits.append((None, result))
    schema = "family string, candidate_index int, parameters string, val_macro_f1 double, val_accuracy double, train_s double"
    table = spark.createDataFrame(rows, schema)
    chosen = {r["family"]: r["candidate_index"] for r in select.select_candidate(table, "family").collect()}
    history = None
    for (family, i, *_), (model, result) in zip(rows, fits):
        if chosen[family] == i:
            results.save_bundle(spark, f"{out_dir}/bundles/{family}", predictor.bundle_of(family, fitted, meta, result), model)
            if result is not None:
                h = result.history_frame(spark, family, len(result.history))
                history = h if history is None else history.unionByName(h)
    picked = table.where(reduce(lambda a, b: a | b, [(F.col("family") == f) & (F.col("candidate_index") == i) for f, i in chosen.items()]))
    return _write({"candidates": table, "chosen": picked, "history": history}, out_dir) | {"bundles": f"{out_dir}/bundles"}


def evaluate_job(prepared: DataFrame, train_dir: str, out_dir: str) -> dict:
    """evaluate: every bundle of a train job scored once on validation and test rows:
    metrics, confusion matrices, class reports, the ranking on test and the model
    chosen on validation for deployment."""
    spark = prepared.sparkSession
    chosen = {r["family"]: r["train_s"] for r in spark.read.json(f"{train_dir}/chosen").collect()}
    rows, compared, reports, matrices = [], [], [], []
    for order, name in enumerate(m for m in MODEL_ORDER if m in chosen):
        model = predictor.Predictor(spark, f"{train_dir}/bundles/{name}")
        ev = {}
        for split in ("validation", "test"):
            df = prepared.where(F.col("split") == split)
            if model.model is not None:
                pred = tr.predict_labels(model.model, df, model.classes).select("y", "p")
            else:
                pred = _predictions(tr.gd_probabilities(df, model.result, len(model.classes)), model.classes)
            pred = checkpoint(pred)
            ev[split] = e = metrics.evaluate(pred, "y", "p", model.classes).first()
            rows.append((name, split, *[float(e[c]) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")]))
            if split == "test":
                reports.append(metrics.classification_report(pred, "y", "p", model.classes).withColumn("model", F.lit(name)))
                matrices.append(metrics.confusion_matrix(pred, "y", "p", model.classes).withColumn("model", F.lit(name)))
        v, t = ev["validation"], ev["test"]
        compared.append((name, float(v["macro_f1"]), float(v["accuracy"]), float(t["macro_f1"]), float(t["accuracy"]), float(chosen[name]), order))
    res = spark.createDataFrame(
        compared, "model string, val_macro_f1 double, val_accuracy double, test_macro_f1 double, test_accuracy double, train_s double, fixed_order int"
    )
    return _write({
        "metrics": spark.createDataFrame(rows, METRICS),
        "classification_report": reduce(DataFrame.unionByName, reports),
        "confusion_matrix": reduce(DataFrame.unionByName, matrices),
        "model_comparison": select.model_ranking(res),
        "deployment": select.select_model(res),
    }, out_dir)


def score_job(df: DataFrame, key: str, bundle_path: str, out_dir: str, mode: str = "strict") -> dict:
    """score: validate new rows, predict with a saved bundle, check the probabilities, write predictions (and rejected rows)."""
    done, rejected = predictor.Predictor(df.sparkSession, bundle_path).predict(df, key, mode)
    tables = {"predictions": done}
    if rejected is not None:
        tables["rejected"] = rejected.select(key, F.array_join("errors", ",").alias("errors"))
    return _write(tables, out_dir)


def run_all(open_input: Callable[[], DataFrame], roles: Roles, out_dir: str, grid: dict | None = None) -> dict:
    """run-all: audit -> prepare -> eda -> train -> evaluate under the unchanged-input guard.

    ``open_input`` opens the source; it is opened again at the end, so a change
    made meanwhile is seen."""
    with files.unchanged(open_input) as df:
        out = {"audit": audit_job(df, roles, f"{out_dir}/audit")}
        out["prepare"], fitted, meta = prepare_job(df, roles, f"{out_dir}/prepare")
        out["eda"] = eda_job(prepare.clean(df, roles), roles, f"{out_dir}/eda")
        prepared, _ = results.read_prepared(df.sparkSession, f"{out_dir}/prepare/prepared")
        out["train"] = train_job(prepared, fitted, meta, f"{out_dir}/train", grid)
        out["evaluate"] = evaluate_job(prepared, f"{out_dir}/train", f"{out_dir}/evaluate")
    return out
