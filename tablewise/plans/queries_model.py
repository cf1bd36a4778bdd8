"""Training, candidate search and batch scoring queries."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics, score, select
from ..operators import train as tr
from ..session import checkpoint
from .catalog import register
from .fixtures import spark_view
from .grids import LOGISTIC_CANDIDATES, MLP_CANDIDATES
from .queries_features import Prep
from .queries_prepare import split_cte

MLP_MAX_ITER = 350
MLP_TOL = 1e-4  # the reference library's default tolerance
SOFTMAX_GD = dict(lr=0.08, l2=0.0005, max_epochs=300, patience=25, tol=1e-5)
MLP_GD = dict(hidden=48, lr=0.01, l2=0.0005, max_epochs=220, batch=256, patience=25, tol=1e-5, seed=42)


def _gd_predictions(df, results, classes) -> DataFrame:
    """Number of the result, true and predicted class of prepared rows by networks or softmax results."""
    names = F.array(*[F.lit(c) for c in classes])
    name = lambda c: F.element_at(names, F.col(c) + 1)
    return tr.gd_predictions(df, results).select("model", name("label").alias("y"), name("predicted").alias("p"))


def _gd_eval(df, result, classes) -> DataFrame:
    """Metrics of a network or softmax result on prepared rows."""
    return metrics.evaluate(_gd_predictions(df, [result], classes), "y", "p", classes)


def _eval_rows(model, df, classes, by_value: dict) -> DataFrame:
    ev = metrics.evaluate(tr.predict_labels(model, df, classes), "y", "p", classes)
    for k, v in by_value.items():
        ev = ev.withColumn(k, F.lit(v))
    return ev


class Trained(Prep):
    """Models of one query, each trained when first asked for."""

    @property
    def classes(self) -> list[str]:
        return self.fitted.classes

    @cached_property
    def logistic(self):
        """M1/M6: every logistic candidate fitted on train and scored on validation: (table, best model, its index)."""
        train = self.part("train").cache()
        n = train.count()
        weighted = tr.with_balanced_weights(train, train).cache()

        def fit_one(i_cand):
            i, cand = i_cand
            balanced = cand["class_weight"] == "balanced"
            t0 = time.perf_counter()
            model = tr.logistic_estimator(cand["C"], float(n), balanced).fit(weighted if balanced else train)
            secs = time.perf_counter() - t0
            ev = _eval_rows(model, self.part("validation"), self.classes, {}).first()
            return (i, float(cand["C"]), cand["class_weight"] or "none", float(ev["macro_f1"]), float(ev["accuracy"]), secs, "logistic"), model

        # candidates are independent jobs over the same cached input: run them concurrently
        with ThreadPoolExecutor(max_workers=len(LOGISTIC_CANDIDATES)) as pool:
            done = list(pool.map(fit_one, enumerate(LOGISTIC_CANDIDATES)))
        weighted.unpersist()
        train.unpersist()
        res = self.spark.createDataFrame(
            [r for r, _ in done],
            "candidate_index int, C double, class_weight string, val_macro_f1 double, val_accuracy double, train_s double, family string",
        )
        best = select.select_candidate(res, "family").first()["candidate_index"]
        return res, done[best][1], best

    @cached_property
    def mlp(self):
        """M2/M6: every perceptron candidate fitted (Adam, hold-out early stop) and compared on validation:
        (table, best result, its index)."""
        runs = tr.train_mlp_grid(self.part("train"), MLP_CANDIDATES, MLP_MAX_ITER, MLP_TOL)
        found = [tr.GDResult({"network": run.recipe.network, "theta": run.stop.kept}, [], run.stop.best_epoch, len(run.history), run.seconds) for run in runs]
        evaluated = metrics.evaluate(_gd_predictions(self.part("validation"), found, self.classes), "y", "p", self.classes, ["model"]).collect()
        evaluated, rows = {r["model"]: r for r in evaluated}, []  # a row a candidate
        for i, ((hidden, act, alpha, lr), run) in enumerate(zip(MLP_CANDIDATES, runs)):
            ev = evaluated[i]
            rows.append((i, "-".join(map(str, hidden)), act, float(alpha), float(lr), float(ev["macro_f1"]), float(ev["accuracy"]),
                         float(run.seconds), len(run.history), "mlp"))
        table = self.spark.createDataFrame(
            rows, "candidate_index int, hidden string, activation string, alpha double, learning_rate double, "
            "val_macro_f1 double, val_accuracy double, train_s double, epochs int, family string"
        )
        best = select.select_candidate(table, "family").first()["candidate_index"]
        return table, found[best], best

    @cached_property
    def softmax(self) -> tr.GDResult:
        return tr.train_softmax_gd(self.part("train"), self.part("validation"), **SOFTMAX_GD)

    @cached_property
    def mlp_gd(self) -> tr.GDResult:
        return tr.train_mlp_gd(self.part("train"), self.part("validation"), **MLP_GD)

    def side_by_side(self, *families: str) -> dict:
        """The named families, trained at the same time (the loops leave cores idle between their jobs);
        both gradient-descent models train on the same blocks."""
        train, val = self.part("train"), self.part("validation")
        blocks = tr.Blocks(train, val)
        makers = {
            "softmax_gd": lambda: tr.train_softmax_gd(train, val, **SOFTMAX_GD, blocks=blocks),
            "mlp_gd": lambda: tr.train_mlp_gd(train, val, **MLP_GD, blocks=blocks),
            "spark_mlp": lambda: self.mlp,
            "spark_logistic": lambda: self.logistic,
        }
        with ThreadPoolExecutor(len(families)) as pool:
            begun = {name: pool.submit(makers[name]) for name in families}
            done = {name: future.result() for name, future in begun.items()}
        blocks.unpersist()
        return done


@register("candidate_search")
def q_candidate_search(spark, sf):
    """M6: logistic candidates (C, class weight) fitted on train and compared on validation macro-F1."""
    res, _, best = Trained(spark, sf).logistic
    return res.withColumn("selected", F.col("candidate_index") == F.lit(best))


@register("train_logistic")
def q_train_logistic(spark, sf):
    """M1: the chosen multinomial logistic model's validation and test metrics (test scored once)."""
    t = Trained(spark, sf)
    _, model, _ = t.logistic
    parts = [_eval_rows(model, t.part(s), t.classes, {"split": s}) for s in ("validation", "test")]
    return reduce(DataFrame.unionByName, parts).withColumn("model", F.lit("spark_logistic"))


@register("train_mlp")
def q_train_mlp(spark, sf):
    """M2: the 20 perceptron candidates, each fitted, compared on validation macro-F1."""
    res, _, best = Trained(spark, sf).mlp
    return res.withColumn("selected", F.col("candidate_index") == F.lit(best))


@register("train_softmax_gd")
def q_train_softmax_gd(spark, sf):
    """M3/M5: distributed full-batch softmax regression; per-epoch train/validation loss history."""
    return Trained(spark, sf).softmax.history_frame(spark, "softmax_gd", SOFTMAX_GD["max_epochs"])


@register(
    "train_first_step",
    split_cte()
    + """, c AS (SELECT tier AS class, count(*) AS train_rows FROM split WHERE split = 'train' GROUP BY tier),
t AS (SELECT sum(train_rows) AS n, count(*) AS k FROM c)
SELECT class, train_rows, round(ln(k), 9) AS start_loss, round(train_rows / n - 1 / k, 9) AS bias FROM c, t""",
)
def q_train_first_step(spark, sf):
    """M3/M5: the loss that softmax regression starts with and its biases after one full step at rate 1, per class."""
    t = Trained(spark, sf)
    done = tr.train_softmax_gd(t.part("train"), t.part("validation"), lr=1.0, l2=0.0, max_epochs=1)
    counts = t.part("train").groupBy("label").count()
    rows = [(i, c, float(done.history[0][1]), float(b)) for i, (c, b) in enumerate(zip(t.classes, done.params["b"]))]
    facts = spark.createDataFrame(rows, "label int, class string, start_loss double, bias double")
    return counts.join(facts, counts["label"] == facts["label"]).select(
        "class", F.col("count").alias("train_rows"), F.round("start_loss", 9).alias("start_loss"), F.round("bias", 9).alias("bias")
    )


@register("train_mlp_gd")
def q_train_mlp_gd(spark, sf):
    """M4/M5: one-hidden-layer ReLU net, mini-batch steps over all rows; loss history."""
    return Trained(spark, sf).mlp_gd.history_frame(spark, "mlp_gd", MLP_GD["max_epochs"])


@register("gd_model_metrics")
def q_gd_model_metrics(spark, sf):
    """M3/M4 evaluation: validation and test metrics of both gradient-descent models."""
    t = Trained(spark, sf)
    out = []
    for name, r in t.side_by_side("softmax_gd", "mlp_gd").items():
        for split in ("validation", "test"):
            out.append(_gd_eval(t.part(split), r, t.classes).withColumn("model", F.lit(name)).withColumn("split", F.lit(split)))
    return reduce(DataFrame.unionByName, out)


@register("score_batch")
def q_score_batch(spark, sf):
    """Validate new records, transform with the fitted features, score with the
    chosen logistic model, check and assemble the probabilities (invalid rows quarantined):
    one row per record and class."""
    t = Trained(spark, sf)
    _, model, _ = t.logistic
    valid, _rejected = score.split_valid(spark_view(spark, sf, "records"), "row_id", t.meta, mode="quarantine")
    # written once: the checks and the map would otherwise evaluate the model again for each use
    probs = checkpoint(model.transform(t.fitted.transform(valid, keep=["row_id"])).select("row_id", vector_to_array("probability").alias("_p")))
    ok = probs.where(F.size(score.violations(F.col("_p"), len(t.classes))) == 0)
    done = score.assemble_predictions(ok, "row_id", "_p", t.classes, model_name="spark_logistic")
    return done.select("row_id", "predicted_class", "highest_probability", "model_name", F.explode("probabilities").alias("class", "probability"))


# Fixed order of the four model families (used as the last tie-breaker).
FAMILY_ORDER = ["spark_logistic", "spark_mlp", "softmax_gd", "mlp_gd"]


@register("model_comparison")
def q_model_comparison(spark, sf):
    """M9 on the trained models: the chosen logistic and perceptron candidates and the
    two gradient-descent models ranked by test macro-F1, deployment chosen on validation."""
    t = Trained(spark, sf)
    done = t.side_by_side("spark_mlp", "spark_logistic", "softmax_gd", "mlp_gd")
    res, model, best = done.pop("spark_logistic")
    secs = {"spark_logistic": res.where(F.col("candidate_index") == best).first()["train_s"]}
    results = done | {"spark_mlp": done["spark_mlp"][1]}
    secs |= {k: r.train_seconds for k, r in results.items()}
    rows = []
    for i, name in enumerate(FAMILY_ORDER):
        v, e = (
            (_gd_eval(t.part(s), results[name], t.classes) if name in results else _eval_rows(model, t.part(s), t.classes, {})).first()
            for s in ("validation", "test")
        )
        rows.append((name, v["macro_f1"], v["accuracy"], e["macro_f1"], e["accuracy"], float(secs[name]), i))
    table = spark.createDataFrame(rows, "model string, val_macro_f1 double, val_accuracy double, test_macro_f1 double, "
                                        "test_accuracy double, train_s double, fixed_order int")
    return select.model_ranking(table)
