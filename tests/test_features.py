import numpy as np
import pandas as pd
import pytest

from tablewise.operators import features as feat

ROWS = [(i, float(i % 17) if i % 11 else None, float((i * 7) % 23), ["a", "b", "c"][i % 3], "xyz"[i % 2]) for i in range(120)]
SCHEMA = "id long, x double, z double, cat string, tgt string"


def test_fit_on_train_matches_numpy(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    f = feat.fit_features(df, ["x", "z"], ["cat"], "tgt", n_bins=20)
    pdf = pd.DataFrame(ROWS, columns=["id", "x", "z", "cat", "tgt"])
    med = pdf["x"].median()
    assert f.medians["x"] == med
    xi = pdf["x"].fillna(med).to_numpy()
    assert abs(f.means["x"] - xi.mean()) < 1e-12 and abs(f.scales["x"] - xi.std()) < 1e-12
    edges = np.percentile(xi, np.linspace(0, 100, 21))
    keep = np.ediff1d(edges, to_begin=np.inf) > 1e-8
    assert np.allclose(f.bin_edges["x"], edges[keep])
    assert f.categories["cat"] == ["a", "b", "c"] and f.classes == ["x", "y"]


def test_unknown_category_and_null_give_finite_same_width(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    f = feat.fit_features(df, ["x", "z"], ["cat"], None, n_bins=5)
    new = spark.createDataFrame([(1, None, 3.0, "zzz", "x"), (2, 1e9, -1e9, None, "y")], SCHEMA)
    out = f.transform(new, keep=["id"], vector=False).orderBy("id").collect()
    width = len(f.feature_names())
    for r in out:
        assert len(r["features"]) == width and np.isfinite(r["features"]).all()
    names = f.feature_names()
    first = dict(zip(names, out[0]["features"]))
    assert sum(first[f"cat_{c}"] for c in "abc") == 0.0  # unknown -> all zeros
    assert feat.nonfinite_features(f.transform(new, vector=False)).first()["nonfinite_rows"] == 0


def test_uniform_and_kmeans_edges(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fu = feat.fit_features(df, ["z"], [], None, n_bins=4, strategy="uniform")
    assert np.allclose(fu.bin_edges["z"], np.linspace(0, 22, 5))
    fk = feat.fit_features(df, ["z"], [], None, n_bins=3, strategy="kmeans")
    z = np.array([r[2] for r in ROWS])
    centres = np.linspace(0, 22, 4)[:-1] + 22 / 6
    for _ in range(300):  # Lloyd's rule, value by value
        near = np.abs(z[:, None] - centres).argmin(1)
        new = np.array([z[near == k].mean() for k in range(3)])
        if ((new - centres) ** 2).sum() <= 1e-4 * z.var():
            centres = new
            break
        centres = new
    centres.sort()
    assert np.allclose(fk.bin_edges["z"], [0, *(centres[1:] + centres[:-1]) / 2, 22])


def test_unseen_label_raises(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    f = feat.fit_features(df, ["x"], ["cat"], "tgt")
    other = spark.createDataFrame([(1, 1.0, 1.0, "a", "never")], SCHEMA)
    with pytest.raises(Exception, match="label not seen"):
        f.transform(other).collect()
