"""Feature preparation fitted on the train rows only.

``fit_features`` runs a few aggregations over the train rows and keeps the
fitted parameters on the driver: medians, modes, means/stds, category lists
and bin edges -- sizes bounded by the column count and the categories, never
by the rows.  ``FittedFeatures.transform`` is then a single projection of
column expressions (whole-stage codegen, no shuffle, no UDF) that can be
applied to any split or to new data, batch or streaming.

Semantics follow the reference preprocessor:
  numeric: median imputation -> standardise with the population std (zero std -> 1)
  categorical: most-frequent imputation (ties -> smallest) -> one-hot over sorted
               train categories, unknown -> all zeros
  binned numeric: median imputation -> 20 quantile bins (linear-interpolated
               edges, near-equal edges merged) -> one-hot
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach_scalars
from . import kmeans1d
from .orderstats import DEFAULT_MAX_SORT_ROWS, quantiles_wide

EDGE_TOL = 1e-8


@dataclass
class FittedFeatures:
    numeric: list[str]
    categorical: list[str]
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    bin_edges: dict = field(default_factory=dict)
    bin_strategy: str = "quantile"
    classes: list = field(default_factory=list)
    label: str | None = None

    # ---------------------------------------------------------------- names
    def feature_names(self) -> list[str]:
        names = [*self.numeric]
        for c in self.categorical:
            names += [f"{c}_{v}" for v in self.categories[c]]
        for c in self.numeric:
            if c in self.bin_edges:
                names += [f"{c}_bin{i}" for i in range(len(self.bin_edges[c]) - 1)]
        return names

    # ---------------------------------------------------------------- exprs
    def _imputed(self, c: str):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        return F.coalesce(x, F.lit(float(self.medians[c])))

    def _prepare(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """First projection: imputed numerics, imputed categories and bin indexes,
        each computed once so the feature expressions stay small."""
        cols = [F.col(k) for k in keep]
        for c in self.numeric:
            cols.append(self._imputed(c).alias(f"_x_{c}"))
        for c in self.categorical:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c])).alias(f"_v_{c}"))
        if self.label and self.label in df.columns:
            cols.append(self.label_index().alias("label"))
        pre = df.select(*cols)
        bins = []
        for c in self.numeric:
            if c in self.bin_edges:
                edges = self.bin_edges[c]
                x = F.col(f"_x_{c}")
                idx = F.lit(0)
                for e in edges[1:-1]:
                    idx = idx + F.when(x >= F.lit(float(e)), 1).otherwise(0)
                bins.append(F.least(F.greatest(idx, F.lit(0)), F.lit(len(edges) - 2)).alias(f"_b_{c}"))
        return pre.select("*", *bins)

    def feature_columns(self) -> list:
        """Feature expressions over the columns made by ``_prepare``."""
        cols = []
        for c in self.numeric:
            cols.append(((F.col(f"_x_{c}") - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(c))
        for c in self.categorical:
            v = F.col(f"_v_{c}")
            for cat in self.categories[c]:
                cols.append(F.when(v == F.lit(cat), 1.0).otherwise(0.0).alias(f"{c}_{cat}"))
        for c in self.numeric:
            if c in self.bin_edges:
                b = F.col(f"_b_{c}")
                for i in range(len(self.bin_edges[c]) - 1):
                    cols.append(F.when(b == i, 1.0).otherwise(0.0).alias(f"{c}_bin{i}"))
        return cols

    def label_index(self, col: str | None = None):
        """Index of the label among the train classes; a label that train has not seen raises."""
        lab = F.col(col or self.label).cast("string")
        at = F.array_position(F.array(*[F.lit(c) for c in self.classes]), lab)
        unseen = F.raise_error(F.concat(F.lit("label not seen in the train rows: "), F.coalesce(lab, F.lit("NULL"))))
        return F.when(at > 0, (at - 1).cast("double")).otherwise(unseen.cast("double"))

    def transform(self, df: DataFrame, keep: list[str] | None = None, vector: bool = True) -> DataFrame:
        """Append ``features`` (Spark ML vector, or array<double>) and ``label``."""
        keep = list(keep or [])
        pre = self._prepare(df, keep)
        arr = F.array(*self.feature_columns())
        feats = array_to_vector(arr) if vector else arr
        out = [*[F.col(k) for k in keep], feats.alias("features")]
        if "label" in pre.columns:
            out.append(F.col("label"))
        return pre.select(*out)

    def long_form(self, df: DataFrame, key: str, of: list[str] | None = None) -> DataFrame:
        """(key, feature, value) rows of the transformed matrix, for inspection and SQL checks.

        ``of`` keeps the one-hot features of these categorical columns only."""
        pre = self._prepare(df, [key])
        wanted = None if of is None else {f"{c}_{v}" for c in of for v in self.categories[c]}
        pairs = [(n, e) for n, e in zip(self.feature_names(), self.feature_columns()) if wanted is None or n in wanted]
        arr = F.array(*[F.struct(F.lit(n).alias("feature"), e.alias("value")) for n, e in pairs])
        return pre.select(key, F.explode(arr).alias("_kv")).select(key, "_kv.feature", F.round("_kv.value", 6).alias("value"))

    # ---------------------------------------------------------------- persistence
    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FittedFeatures":
        return cls(**json.loads(text))


# -------------------------------------------------------------------- fitting
def fit_medians(train: DataFrame, numeric: list[str], max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> dict:
    """Exact median (average of the two middles) of each numeric column."""
    q = quantiles_wide(train, [], numeric, [0.5], max_sort_rows).collect()
    return {r["field"]: r["quantile"] for r in q}


def fit_modes(train: DataFrame, categorical: list[str]) -> dict:
    """Most frequent value per column; ties -> smallest value."""
    long = train.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in categorical])).alias("_kv")
    ).select("_kv.*").where(F.col("v").isNotNull())
    counts = long.groupBy("field", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("field").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))
    return {r["field"]: r["mode"] for r in best.collect()}


def fit_scaler(train: DataFrame, numeric: list[str], medians: dict) -> tuple[dict, dict]:
    """Mean and population std of the imputed train values (zero std -> 1)."""
    aggs = []
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        x = F.coalesce(F.when(~F.isnan(x), x), F.lit(float(medians[c])))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    r = train.agg(*aggs).first()
    means = {c: float(r[f"m{i}"]) for i, c in enumerate(numeric)}
    scales = {}
    for i, c in enumerate(numeric):
        s = r[f"s{i}"]
        scales[c] = 1.0 if (s is None or s == 0.0 or not math.isfinite(s)) else float(s)
    return means, scales


def fit_categories(train: DataFrame, categorical: list[str], modes: dict) -> dict:
    """T4: sorted distinct train categories after most-frequent imputation."""
    long = train.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit(modes.get(c))).alias("v")) for c in categorical])).alias("_kv")
    ).select("_kv.*").where(F.col("v").isNotNull())
    rows = long.distinct().collect()  # distinct categories: bounded by column cardinality
    out: dict = {c: [] for c in categorical}
    for r in rows:
        out[r["field"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def merge_close_edges(edges) -> list[float]:
    """Drop an edge within EDGE_TOL of the edge before it (first edge always kept)."""
    e = np.asarray(edges, dtype=float)
    keep = np.ediff1d(e, to_begin=np.inf) > EDGE_TOL
    return [float(x) for x in e[keep]]


def fit_quantile_edges(train: DataFrame, numeric: list[str], medians: dict, n_bins: int = 20,
                       max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> dict:
    """T5: linearly interpolated percentile edges at 0, 1/n, ..., 1, near-equal edges merged."""
    imputed = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))).alias(c) for c in numeric])
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = quantiles_wide(imputed, [], numeric, probs, max_sort_rows).collect()
    raw: dict = {c: {} for c in numeric}
    for r in q:
        raw[r["field"]][r["prob"]] = r["quantile"]
    return {c: merge_close_edges([raw[c][p] for p in sorted(raw[c])]) for c in numeric}


def fit_uniform_edges(train: DataFrame, numeric: list[str], medians: dict, n_bins: int = 20) -> dict:
    """Equal-width edges between the train min and max."""
    aggs = []
    for i, c in enumerate(numeric):
        x = F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c])))
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    r = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(numeric):
        out[c] = merge_close_edges(np.linspace(r[f"lo{i}"], r[f"hi{i}"], n_bins + 1))
    return out


def fit_kmeans_edges(train: DataFrame, numeric: list[str], medians: dict, n_bins: int = 20,
                     max_iter: int = 300, tol: float = 1e-4, max_cells: int = kmeans1d.MAX_CELLS) -> dict:
    """1-D k-means bins.  Centres start at the uniform-bin midpoints; edges are the midpoints of
    the final centres plus the min and max.  All columns share one sorted value table (see :mod:`kmeans1d`)."""
    if not numeric:
        return {}
    imputed = [F.coalesce(F.when(~F.isnan(x), x), F.lit(float(medians[c]))) for c, x in ((c, F.col(c).cast("double")) for c in numeric)]
    long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), x.alias("x")) for c, x in zip(numeric, imputed)])).alias("_kv")).select("_kv.*")
    values = kmeans1d.value_cells(long, max_cells)
    spread = {r["field"]: r["var"] for r in values.groupBy("field").agg(_weighted_variance("x", "n").alias("var")).collect()}
    out = {}
    for c, prefix in kmeans1d.prefixes(values).items():
        lo, hi = float(prefix.low[0]), float(prefix.high[-1])
        uniform = np.linspace(lo, hi, n_bins + 1)
        found = kmeans1d.centres(prefix, (uniform[1:] + uniform[:-1]) * 0.5, tol * spread[c], max_iter)
        out[c] = merge_close_edges([lo, *(found[1:] + found[:-1]) * 0.5, hi])
    return {c: out[c] for c in numeric if c in out}


def _weighted_variance(x: str, n: str):
    mean = F.sum(F.col(x) * F.col(n)) / F.sum(n)
    return F.greatest(F.sum(F.col(x) * F.col(x) * F.col(n)) / F.sum(n) - mean * mean, F.lit(0.0))


def fit_features(train: DataFrame, numeric: list[str], categorical: list[str], label: str | None = None,
                 n_bins: int = 20, strategy: str = "quantile", binning: bool = True,
                 max_sort_rows: int = DEFAULT_MAX_SORT_ROWS) -> FittedFeatures:
    """Fit every transformer on the train rows only."""
    from concurrent.futures import ThreadPoolExecutor

    def label_classes():
        if not label:
            return []
        return sorted(r[0] for r in train.select(F.col(label).cast("string")).distinct().collect())

    # independent small jobs run concurrently (Spark schedules them side by side)
    with ThreadPoolExecutor(max_workers=3) as pool:
        f_med = pool.submit(lambda: fit_medians(train, numeric, max_sort_rows) if numeric else {})
        f_mode = pool.submit(lambda: fit_modes(train, categorical) if categorical else {})
        f_cls = pool.submit(label_classes)
        medians, modes, classes = f_med.result(), f_mode.result(), f_cls.result()

    def edges_job():
        if not (binning and numeric):
            return {}
        if strategy == "quantile":
            return fit_quantile_edges(train, numeric, medians, n_bins, max_sort_rows)
        if strategy == "uniform":
            return fit_uniform_edges(train, numeric, medians, n_bins)
        if strategy == "kmeans":
            return fit_kmeans_edges(train, numeric, medians, n_bins)
        raise ValueError(f"unknown binning strategy {strategy}")

    with ThreadPoolExecutor(max_workers=3) as pool:
        f_sc = pool.submit(lambda: fit_scaler(train, numeric, medians) if numeric else ({}, {}))
        f_cat = pool.submit(lambda: fit_categories(train, categorical, modes) if categorical else {})
        f_edge = pool.submit(edges_job)
        (means, scales), cats, edges = f_sc.result(), f_cat.result(), f_edge.result()
    return FittedFeatures(list(numeric), list(categorical), medians, modes, means, scales, cats, edges, strategy, classes, label)


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced class weights n / (k * n_c) from the train rows."""
    counts = train.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
    j = attach_scalars(counts, tot)
    return j.select("class", F.round(F.col("_n") / (F.col("_k") * F.col("n_c")), 6).alias("weight"))


def nonfinite_features(transformed: DataFrame, col: str = "features") -> DataFrame:
    """Rows whose feature vector holds NaN or +-Inf (must be zero)."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(col)) if dict(transformed.dtypes)[col] != "array<double>" else F.col(col)
    bad = F.exists(arr, lambda v: F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return transformed.agg(F.count(F.when(bad, 1)).alias("nonfinite_rows"), F.count(F.lit(1)).alias("rows"))
