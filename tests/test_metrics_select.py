"""Metrics against a direct count, and the selection rules on tables where each rule decides."""

import random

import pytest

from tablewise.operators import metrics, select

CLASSES = ["ant", "bee", "cat", "dog"]  # "dog" never occurs


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(31)
    out = []
    for _ in range(240):
        y = rng.choice(CLASSES[:3])
        out.append((y, y if rng.random() < 0.6 else rng.choice(CLASSES[:3])))
    return out


def counted(pairs, c):
    tp = sum(y == p == c for y, p in pairs)
    said, real = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
    precision, recall = tp / said if said else 0.0, tp / real if real else 0.0
    return precision, recall, 2 * precision * recall / (precision + recall) if tp else 0.0


def test_metrics_against_a_direct_count(spark, pairs):
    df = spark.createDataFrame(pairs, "y string, p string")
    want = {c: counted(pairs, c) for c in CLASSES}
    for r in metrics.classification_report(df, "y", "p", CLASSES).collect():
        if r["class"] in want:
            assert (r["precision"], r["recall"], r["f1"]) == pytest.approx(want[r["class"]], abs=1e-6)
    right = sum(y == p for y, p in pairs) / len(pairs)
    assert metrics.accuracy(df, "y", "p").first()["accuracy"] == pytest.approx(right, abs=1e-6)
    macro = metrics.macro_metrics(df, "y", "p", CLASSES).first()["macro_f1"]
    assert macro == pytest.approx(sum(f for *_, f in want.values()) / 4, abs=1e-6)
    cells = {(r["true_class"], r["pred_class"]): r["count"] for r in metrics.confusion_matrix(df, "y", "p", CLASSES).collect()}
    assert len(cells) == 16 and all(n == sum((y, p) == k for y, p in pairs) for k, n in cells.items())


SCHEMA = "model string, val_macro_f1 double, val_accuracy double, test_macro_f1 double, test_accuracy double, train_s double, fixed_order int"
BASE = {"model": "", "val_macro_f1": 0.61, "val_accuracy": 0.64, "test_macro_f1": 0.5, "test_accuracy": 0.5, "train_s": 9.0, "fixed_order": 5}


def table(spark, *changes):
    return spark.createDataFrame([tuple((BASE | c).values()) for c in changes], SCHEMA)


@pytest.mark.parametrize(
    "rule",
    [{"val_macro_f1": 0.62}, {"val_accuracy": 0.65}, {"train_s": 8.5}, {"fixed_order": 4}],
)
def test_each_rule_decides_the_deployment(spark, rule):
    res = table(spark, {"model": "x", "fixed_order": 6}, {"model": "winner"} | rule, {"model": "y", "fixed_order": 7, "test_macro_f1": 0.99})
    assert select.select_model(res).first()["selected_model"] == "winner"


def test_ranking_is_by_test_and_flags_the_validation_choice(spark):
    res = table(
        spark,
        {"model": "p", "test_macro_f1": 0.71, "test_accuracy": 0.70},
        {"model": "q", "test_macro_f1": 0.71, "test_accuracy": 0.73, "fixed_order": 6},
        {"model": "r", "test_macro_f1": 0.33, "val_macro_f1": 0.9, "fixed_order": 7},
        {"model": "o", "test_macro_f1": 0.71, "test_accuracy": 0.70, "fixed_order": 8},
    )
    ranked = select.model_ranking(res).orderBy("rank").collect()
    assert [r["model"] for r in ranked] == ["q", "o", "p", "r"]
    assert [r["model"] for r in ranked if r["selected_for_deployment"]] == ["r"]


def test_best_epoch(spark):
    rows = [("loss", e, 3.0 - e, v, None, 9) for e, v in ((1, 2.0), (2, 1.25), (3, 1.5), (4, 1.25))]
    rows += [("score", e, 1.0 / e, None, v, 3) for e, v in ((1, 0.2), (2, 0.4), (3, 0.4))]
    rows += [("train", e, v, None, None, 4) for e, v in ((1, 0.9), (2, 0.8), (3, 0.85))]
    df = spark.createDataFrame(rows, "model string, epoch int, train_loss double, val_loss double, val_score double, max_epochs int")
    got = {r["model"]: (r["best_epoch"], r["criterion"], r["early_stopped"]) for r in select.best_epoch(df).collect()}
    assert got == {"loss": (2, "val_loss", True), "score": (2, "val_score", False), "train": (2, "train_loss", True)}
