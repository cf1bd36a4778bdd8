import uuid

import pytest
from conftest import SF_SMALL

from tablewise.operators import score
from tablewise.plans import jobs
from tablewise.plans.fixtures import spark_view
from tablewise.roles import ML_ORDERS
from tablewise.session import scratch_path
from tablewise.sources import files, results

GRID = {
    "logistic": ((0.5, False), (1.0, True)), "mlp": (([8], "tanh", 1e-4, 0.01), ([6, 4], "relu", 1e-3, 0.01)), "mlp_args": {"max_iter": 8},
    "softmax": {"max_epochs": 20}, "mlp_gd": {"max_epochs": 10, "lr": 0.05},
}


@pytest.fixture(scope="module")
def done(spark):
    out = scratch_path(spark, f"test-jobs-{uuid.uuid4().hex}")
    return out, jobs.run_all(lambda: spark_view(spark, SF_SMALL, "ml_orders"), ML_ORDERS, out, GRID)


def test_run_all_writes_every_stage(spark, done):
    _, paths = done
    assert set(paths) == {"audit", "prepare", "eda", "train", "evaluate"}
    rows = spark.read.json(paths["evaluate"]["metrics"]).collect()
    assert {(r["model"], r["split"]) for r in rows} == {(m, s) for m in jobs.MODEL_ORDER for s in ("validation", "test")}
    ranked = spark.read.json(paths["evaluate"]["model_comparison"]).collect()
    assert sum(r["selected_for_deployment"] for r in ranked) == 1 and all(r["train_s"] > 0 for r in ranked)
    assert max(r["test_accuracy"] for r in ranked) > 0.8
    assert spark.read.json(paths["train"]["candidates"]).count() == 6


@pytest.mark.parametrize("model", jobs.MODEL_ORDER)
def test_score_job_with_each_bundle(spark, done, model):
    out, paths = done
    rows = spark_view(spark, SF_SMALL, "records").select("row_id", "price", "balance", "status", "segment")
    got = jobs.score_job(rows, "row_id", f"{paths['train']['bundles']}/{model}", f"{out}/score-{model}", mode="quarantine")
    scored, rejected = spark.read.json(got["predictions"]), spark.read.json(got["rejected"])
    assert scored.count() + rejected.count() == rows.count() and rejected.count() > 0
    r = scored.first()
    assert r["model_name"] == model and abs(sum(r["probabilities"].asDict().values()) - 1) < 1e-6
    with pytest.raises(score.ValidationError):
        jobs.score_job(rows, "row_id", f"{paths['train']['bundles']}/{model}", f"{out}/strict", mode="strict")


def test_strict_inputs(spark, done):
    _, paths = done
    from tablewise.operators.predictor import Predictor

    p = Predictor(spark, f"{paths['train']['bundles']}/softmax_gd")
    good = spark_view(spark, SF_SMALL, "ml_orders").select("row_id", "price", "balance", "status", "segment").limit(20)
    lo, hi, _ = p.meta.numeric_ranges["price"]
    good = good.where(f"price BETWEEN {lo} AND {hi}")
    assert p.predict(good.selectExpr("row_id", "price", "1.0D AS balance", "status", "segment"), "row_id")[0].count() == good.count()
    for bad in (good.limit(0), good.drop("price"), good.selectExpr("*", "1 AS depth"), good.selectExpr("row_id", "price", "balance", "'?' AS status", "segment")):
        with pytest.raises(score.ValidationError):
            p.predict(bad, "row_id")


def test_bundle_contract(spark, done):
    out, paths = done
    b = results.load_bundle(spark, f"{paths['train']['bundles']}/mlp_gd")
    for key in results.BUNDLE_KEYS:
        with pytest.raises(results.ResultReadError):
            results.check_bundle({k: v for k, v in b.items() if k != key})
    for change in ({"required_columns": ["price"]}, {"numeric_columns": ["price"]}, {"mode": "other"}):
        with pytest.raises(results.ResultReadError):
            results.check_bundle(b | change)
    with pytest.raises(results.ResultReadError):
        results.load_bundle(spark, f"{out}/nowhere")


def test_guard_sees_rows_added_meanwhile(spark):
    path = scratch_path(spark, f"test-guard-{uuid.uuid4().hex}")
    spark.range(10).write.parquet(path)

    def open_input():
        return spark.read.parquet(path)

    with files.unchanged(open_input) as df:
        assert df.count() == 10
    with pytest.raises(files.InputChangedError):
        with files.unchanged(open_input):
            spark.range(1).write.mode("append").parquet(path)


def test_fingerprint_keeps_field_borders_apart(spark):
    one = spark.createDataFrame([("a|b", "c"), ("1:", None)], "x string, y string")
    two = spark.createDataFrame([("a", "b|c"), ("1:", None)], "x string, y string")
    assert tuple(files.content_fingerprint(one).first()) != tuple(files.content_fingerprint(two).first())
