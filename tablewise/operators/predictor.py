"""Scoring with a saved model bundle: load, validate, transform, predict, check, assemble."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint
from ..sources import results
from . import nets, score
from . import train as tr
from .features import FittedFeatures


def bundle_of(name: str, fitted: FittedFeatures, meta: score.InputMetadata, result: tr.GDResult | None = None) -> dict:
    """Bundle of a fitted model: a GD result travels as parameters, an MLlib model in its own folder."""
    if result is None:
        mode, model = "mllib", "model"
    elif "network" in result.params:
        net = result.params["network"]
        mode, model = "parameters", {"sizes": list(net.sizes), "activation": net.activation, "theta": result.params["theta"].tolist()}
    else:
        mode, model = "parameters", {k: result.params[k].tolist() for k in ("W", "b")}
    columns = list(meta.input_columns)
    return {
        "model_name": name, "mode": mode, "model": model, "label_encoder": list(fitted.classes),
        "input_columns": columns, "required_columns": columns,
        "numeric_columns": list(meta.numeric_columns), "categorical_columns": list(meta.categorical_columns),
        "numeric_ranges": {c: {"minimum": lo, "maximum": hi, "source": src} for c, (lo, hi, src) in meta.numeric_ranges.items()},
        "categorical_options": {c: list(v) for c, v in meta.categorical_options.items()},
        "features": fitted.to_json(),
    }


class Predictor:
    """A loaded bundle."""

    def __init__(self, spark: SparkSession, path: str):
        b = results.load_bundle(spark, path)
        self.name, self.classes = b["model_name"], list(b["label_encoder"])
        self.fitted = FittedFeatures.from_json(b["features"])
        self.meta = score.InputMetadata(
            tuple(b["input_columns"]), tuple(b["numeric_columns"]), tuple(b["categorical_columns"]),
            {c: (r.get("minimum"), r.get("maximum"), r.get("source")) for c, r in b["numeric_ranges"].items()},
            {c: tuple(v) for c, v in b["categorical_options"].items()},
        )
        self.model = LogisticRegressionModel.load(f"{path}/model") if b["mode"] == "mllib" else None
        self.result = None if self.model else self._result(b["model"])

    @staticmethod
    def _result(params: dict) -> tr.GDResult:
        if "theta" in params:
            net = nets.Network(tuple(params["sizes"]), params["activation"])
            return tr.GDResult({"network": net, "theta": np.array(params["theta"])})
        return tr.GDResult({k: np.array(v) for k, v in params.items()})

    def probabilities(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, probability array) of valid rows."""
        x = self.fitted.transform(rows, keep=[key])
        if self.model is not None:
            return self.model.transform(x).select(key, vector_to_array("probability").alias("probability"))
        return tr.gd_probabilities(x, self.result, len(self.classes)).select(key, "probability")

    def predict(self, rows: DataFrame, key: str, mode: str = "strict") -> tuple[DataFrame, DataFrame | None]:
        """(predictions, rejected rows).  ``strict`` raises on the first bad input or
        probability; ``quarantine`` returns rejected rows with their rule codes."""
        valid, rejected = score.split_valid(rows, key, self.meta, mode)
        # written once: the checks and the map would otherwise evaluate the model again for each use
        probs = checkpoint(self.probabilities(valid, key))
        if mode == "strict":
            score.check_probabilities(probs, valid, key, len(self.classes))
        else:
            probs = probs.where(F.size(score.violations(F.col("probability"), len(self.classes))) == 0)
        return score.assemble_predictions(probs, key, "probability", self.classes, self.name), rejected
