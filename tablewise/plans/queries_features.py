"""Feature-preparation queries, fitted on the train split."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import dictionary
from ..operators import features as feat
from ..operators import score
from ..session import checkpoint
from .catalog import register
from .fixtures import spark_view
from .queries_prepare import ml_split, split_cte

NUM = ["price", "balance"]
CAT = ["status", "segment"]
N_BINS = 20


class Prep:
    """Split, fitted features and prepared rows of ``ml_orders`` for one query.

    The split is written to the checkpoint folder once and everything is
    fitted and transformed from there.  Nothing outlives the object: a query
    on changed tables fits anew."""

    def __init__(self, spark, sf, strategy: str = "quantile"):
        self.spark, self.sf, self.strategy = spark, sf, strategy

    @cached_property
    def split(self):
        return checkpoint(ml_split(self.spark, self.sf))

    def rows(self, name: str):
        return self.split.where(F.col("split") == name)

    @cached_property
    def fitted(self) -> feat.FittedFeatures:
        return feat.fit_features(self.rows("train"), NUM, CAT, "tier", N_BINS, self.strategy)

    @cached_property
    def prepared(self):
        """All rows with split, features vector and label (fitted on train only)."""
        return checkpoint(self.fitted.transform(self.split, keep=["row_id", "split"]))

    def part(self, name: str):
        return self.prepared.where(F.col("split") == name)

    @cached_property
    def meta(self) -> score.InputMetadata:
        """Scoring contract from the train rows."""
        return score.metadata_from_table(score.input_metadata(self.rows("train"), NUM, CAT), NUM, CAT)


def fitted(spark, sf, strategy: str = "quantile") -> feat.FittedFeatures:
    return Prep(spark, sf, strategy).fitted


TRAIN = split_cte() + ", tr AS (SELECT * FROM split WHERE split = 'train'),\nmed AS (SELECT quantile_cont(price, 0.5) AS m_price, quantile_cont(balance, 0.5) AS m_balance FROM tr)\n"


@register(
    "impute_median",
    TRAIN + "SELECT 'price' AS field, round(m_price, 6) AS median FROM med UNION ALL SELECT 'balance', round(m_balance, 6) FROM med",
)
def q_impute_median(spark, sf):
    """Exact train medians used to impute numeric columns."""
    f = fitted(spark, sf)
    return spark.createDataFrame([(c, float(f.medians[c])) for c in NUM], "field string, median double").select(
        "field", F.round("median", 6).alias("median")
    )


def _mode_sql(c: str) -> str:
    return f"SELECT '{c}' AS field, v AS mode FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM tr WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1) z"


@register("impute_mode", TRAIN + " UNION ALL ".join(f"SELECT * FROM ({_mode_sql(c)})" for c in CAT))
def q_impute_mode(spark, sf):
    """Most frequent train value per categorical column (smallest on ties)."""
    f = fitted(spark, sf)
    return spark.createDataFrame([(c, f.modes[c]) for c in CAT], "field string, mode string")


@register(
    "standardize",
    TRAIN
    + """SELECT 'price' AS field, round(avg(coalesce(price, m_price)), 6) AS mean,
  round(CASE WHEN stddev_pop(coalesce(price, m_price)) = 0 THEN 1.0 ELSE stddev_pop(coalesce(price, m_price)) END, 6) AS scale FROM tr, med
UNION ALL SELECT 'balance', round(avg(coalesce(balance, m_balance)), 6),
  round(CASE WHEN stddev_pop(coalesce(balance, m_balance)) = 0 THEN 1.0 ELSE stddev_pop(coalesce(balance, m_balance)) END, 6) FROM tr, med""",
)
def q_standardize(spark, sf):
    """Train mean and population standard deviation of each imputed numeric column."""
    f = fitted(spark, sf)
    rows = [(c, float(f.means[c]), float(f.scales[c])) for c in NUM]
    return spark.createDataFrame(rows, "field string, mean double, scale double").select(
        "field", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale")
    )


def _edges_sql() -> str:
    parts = []
    for c in NUM:
        for i in range(N_BINS + 1):
            parts.append(f"SELECT '{c}' AS field, {i} AS i, quantile_cont(coalesce({c}, m_{c}), {i / N_BINS!r}) AS e FROM tr, med")
    return (
        ", eraw AS (" + " UNION ALL ".join(parts) + "),\n"
        "ekeep AS (SELECT field, i, e FROM (SELECT *, e - lag(e) OVER (PARTITION BY field ORDER BY i) AS d FROM eraw) z WHERE d IS NULL OR d > 1e-8),\n"
        "edges AS (SELECT field, row_number() OVER (PARTITION BY field ORDER BY i) - 1 AS k, e, count(*) OVER (PARTITION BY field) AS ne FROM ekeep)\n"
    )


@register("bin_quantile", TRAIN + _edges_sql() + "SELECT field, CAST(k AS INTEGER) AS edge_index, round(e, 6) AS edge FROM edges")
def q_bin_quantile(spark, sf):
    """T5: 20-quantile bin edges (interpolated, near-equal edges merged) from train."""
    f = fitted(spark, sf)
    rows = [(c, i, float(e)) for c in NUM for i, e in enumerate(f.bin_edges[c])]
    return spark.createDataFrame(rows, "field string, edge_index int, edge double").select("field", "edge_index", F.round("edge", 6).alias("edge"))


@register(
    "bin_uniform",
    TRAIN
    + ", r AS (" + " UNION ALL ".join(f"SELECT '{c}' AS field, min(coalesce({c}, m_{c})) AS lo, max(coalesce({c}, m_{c})) AS hi FROM tr, med" for c in NUM) + ")\n"
    + f"SELECT field, CAST(i AS INTEGER) AS edge_index, round(CASE WHEN i = {N_BINS} THEN hi ELSE i * ((hi - lo) / {N_BINS}) + lo END, 6) AS edge FROM r, range(0, {N_BINS + 1}) t(i)",
)
def q_bin_uniform(spark, sf):
    """20 equal-width bin edges between the train min and max."""
    f = fitted(spark, sf, "uniform")
    rows = [(c, i, float(e)) for c in NUM for i, e in enumerate(f.bin_edges[c])]
    return spark.createDataFrame(rows, "field string, edge_index int, edge double").select("field", "edge_index", F.round("edge", 6).alias("edge"))


@register("bin_kmeans")
def q_bin_kmeans(spark, sf):
    """1-D k-means bin edges (borders searched in prefix sums over the sorted values)."""
    f = fitted(spark, sf, "kmeans")
    rows = [(c, i, float(e)) for c in NUM for i, e in enumerate(f.bin_edges[c])]
    return spark.createDataFrame(rows, "field string, edge_index int, edge double").select("field", "edge_index", F.round("edge", 6).alias("edge"))


def _modes_cte() -> str:
    return ", modes AS (" + " UNION ALL ".join(f"SELECT * FROM ({_mode_sql(c)})" for c in CAT) + "),\n" + (
        "cats AS (" + " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS field, coalesce(CAST({c} AS VARCHAR), (SELECT mode FROM modes WHERE field = '{c}')) AS v FROM tr" for c in CAT
        ) + ")\n"
    )


@register(
    "one_hot",
    split_cte("records") + ", tr AS (SELECT * FROM split WHERE split = 'train')" + _modes_cte()
    + " UNION ALL ".join(
        f"SELECT r.row_id, '{c}_' || cats.v AS feature FROM records r JOIN cats ON cats.field = '{c}' "
        f"AND coalesce(CAST(r.{c} AS VARCHAR), (SELECT mode FROM modes WHERE field = '{c}')) = cats.v"
        for c in CAT
    ),
)
def q_one_hot(spark, sf):
    """One-hot columns set for new records (unknown categories -> all zeros)."""
    f = fitted(spark, sf)
    rec = spark_view(spark, sf, "records")
    return f.long_form(rec, "row_id", of=CAT).where(F.col("value") == 1.0).select("row_id", "feature")


@register(
    "label_encode",
    split_cte() + """SELECT m.row_id, m.tier, CAST((SELECT count(DISTINCT tier) FROM split s WHERE s.split = 'train' AND s.tier < m.tier) AS DOUBLE) AS label FROM ml_orders m""",
)
def q_label_encode(spark, sf):
    """Label index of each row from the sorted train classes."""
    f = fitted(spark, sf)
    ml = spark_view(spark, sf, "ml_orders")
    return ml.select("row_id", "tier", f.label_index("tier").alias("label"))


@register(
    "class_weights",
    split_cte() + """, c AS (SELECT tier AS class, count(*) AS n_c FROM split WHERE split = 'train' GROUP BY tier)
SELECT class, round((SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c), 6) AS weight FROM c""",
)
def q_class_weights(spark, sf):
    """Balanced class weights n / (k * n_c) on the train split."""
    train = ml_split(spark, sf).where(F.col("split") == "train")
    return feat.class_weights(train, "tier")


def _matrix_sql(te_source: str = "SELECT * FROM split WHERE split = 'test'", extra_views: tuple = ()) -> str:
    num = " UNION ALL ".join(
        f"SELECT te.row_id, '{c}' AS feature, round((coalesce(te.{c}, m_{c}) - s.mean) / s.scale, 6) AS value FROM te, med, "
        f"(SELECT avg(coalesce({c}, m_{c})) AS mean, CASE WHEN stddev_pop(coalesce({c}, m_{c})) = 0 THEN 1.0 ELSE stddev_pop(coalesce({c}, m_{c})) END AS scale FROM tr, med) s"
        for c in NUM
    )
    cat = " UNION ALL ".join(
        f"SELECT te.row_id, '{c}_' || cats.v AS feature, CASE WHEN coalesce(CAST(te.{c} AS VARCHAR), (SELECT mode FROM modes WHERE field = '{c}')) = cats.v THEN 1.0 ELSE 0.0 END AS value "
        f"FROM te JOIN cats ON cats.field = '{c}'"
        for c in CAT
    )
    binned = " UNION ALL ".join(
        f"SELECT te.row_id, '{c}' AS field, (SELECT count(*) FROM edges e WHERE e.field = '{c}' AND e.k BETWEEN 1 AND e.ne - 2 AND coalesce(te.{c}, m_{c}) >= e.e) AS b FROM te, med"
        for c in NUM
    )
    return (
        (split_cte(*extra_views) + TRAIN[len(split_cte()):] if extra_views else TRAIN) + _edges_sql() + _modes_cte()
        + f", te AS ({te_source}),\n"
        + f"nb AS (SELECT field, max(k) AS nb FROM edges GROUP BY field), bi AS ({binned}),\n"
        + "bo AS (SELECT bi.row_id, bi.field || '_bin' || CAST(j AS VARCHAR) AS feature, CASE WHEN least(greatest(bi.b, 0), nb.nb - 1) = j THEN 1.0 ELSE 0.0 END AS value "
        + "FROM bi JOIN nb ON bi.field = nb.field JOIN range(0, 1000) t(j) ON j < nb.nb)\n"
        + f"SELECT * FROM ({num}) UNION ALL SELECT * FROM ({cat}) UNION ALL SELECT row_id, feature, value FROM bo"
    )


@register("feature_matrix", _matrix_sql())
def q_feature_matrix(spark, sf):
    """The full fitted feature matrix of the test split in long form (row, feature, value)."""
    prep = Prep(spark, sf)
    return prep.fitted.long_form(prep.rows("test"), "row_id")


@register("transform_test", _matrix_sql("SELECT * FROM records", ("records",)))
def q_transform_test(spark, sf):
    """Fitted transform applied to new records (nulls imputed, unknown categories zeroed,
    out-of-range values clipped to the end bins), in long form (row, feature, value)."""
    f = fitted(spark, sf)
    rec = spark_view(spark, sf, "records")
    return f.long_form(rec, "row_id")


@register("nonfinite_features", split_cte() + "SELECT CAST(0 AS BIGINT) AS nonfinite_rows, count(*) AS rows FROM split")
def q_nonfinite_features(spark, sf):
    """The transformed matrix of every split must be finite (count of bad rows)."""
    prep = Prep(spark, sf)
    return feat.nonfinite_features(prep.fitted.transform(prep.split, keep=["row_id"], vector=False))


_DICTIONARY_SQL = TRAIN + """, kv AS (SELECT 'status' AS field, CAST(status AS VARCHAR) AS value FROM tr UNION ALL SELECT 'segment', CAST(segment AS VARCHAR) FROM tr),
dict AS (SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS index, count(*) AS count FROM kv WHERE value IS NOT NULL GROUP BY field, value)
"""


@register("category_dictionary", _DICTIONARY_SQL + "SELECT field, value, index, count FROM dict")
def q_category_dictionary(spark, sf):
    """T4: the train categories of every field, numbered in order, with their counts."""
    return dictionary.fit_dictionary(Prep(spark, sf).rows("train"), CAT).table


@register(
    "category_indexes",
    _DICTIONARY_SQL + """SELECT s.row_id, a.index AS status_index, b.index AS segment_index FROM split s
LEFT JOIN dict a ON a.field = 'status' AND a.value = s.status LEFT JOIN dict b ON b.field = 'segment' AND b.value = s.segment""",
)
def q_category_indexes(spark, sf):
    """Every row's category indexes by a join with the dictionary of the train rows."""
    prep = Prep(spark, sf)
    return dictionary.fit_dictionary(prep.rows("train"), CAT).indexed(prep.split).select("row_id", "status_index", "segment_index")


@register(
    "dictionary_features",
    _DICTIONARY_SQL + """, n AS (SELECT count(*) AS n FROM dict WHERE field = 'status'),
w AS (SELECT s.row_id, a.index AS place FROM split s JOIN dict a ON a.field = 'status' AND a.value = s.status
  UNION ALL SELECT s.row_id, b.index + n FROM split s JOIN dict b ON b.field = 'segment' AND b.value = s.segment, n)
SELECT row_id, CAST(count(*) AS INT) AS places_set, CAST(sum(place) AS BIGINT) AS place_sum, CAST(max(place) AS BIGINT) AS place_max FROM w GROUP BY row_id""",
)
def q_dictionary_features(spark, sf):
    """One-hot vectors of all categories; how many places are set in each row, their sum and the largest."""
    prep = Prep(spark, sf)
    rows = dictionary.fit_dictionary(prep.rows("train"), CAT).transform(prep.split)
    on = F.transform(vector_to_array("features"), lambda v, i: F.when(v == 1.0, i.cast("long")))
    on = F.filter(on, lambda i: i.isNotNull())
    total = F.aggregate(on, F.lit(0).cast("long"), lambda a, i: a + i)
    return rows.select("row_id", F.size(on).alias("places_set"), total.alias("place_sum"), F.array_max(on).alias("place_max")).where("places_set > 0")
