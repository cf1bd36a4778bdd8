"""Near-duplicate spellings: Ratcliff-Obershelp ratio over candidate pairs.

The ratio 2M/T (``difflib.SequenceMatcher.ratio``) has no Spark built-in and
is not symmetric, so it is computed in an Arrow-batched pandas UDF, but only
for candidate pairs.  Candidates come from an exact *prefix filter* join:

* matched characters M never exceed the multiset character overlap O of the
  two (case-folded) strings, so ratio >= t implies Dice(O) = 2O/T >= t;
* Dice >= t implies O >= ceil(t*|x|/(2-t)) for either string x;
* with characters tokenised as (char, occurrence) and ordered globally
  rarest-first, two strings with overlap >= a share a token within their
  first |x| - a + 1 tokens.

* with overlap >= a >= 2 they share two tokens within their first |x| - a + 2.

So a value emits the *pairs* of its prefix tokens (single tokens only where a
short partner may share just one), and candidates are produced by an equi-join
on (field, key) with a length-band filter.  A pair of rare tokens is far less
common than one letter, so no key comes near all values of a column, and no
pair with ratio >= t is missed.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


EPS = 1e-9


@F.pandas_udf(T.DoubleType())
def ro_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """SequenceMatcher(None, a.casefold(), b.casefold()).ratio(), row-wise on a batch."""
    out = [
        SequenceMatcher(None, x.casefold(), y.casefold()).ratio() if x is not None and y is not None else None
        for x, y in zip(a, b)
    ]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Python's full case folding, applied to distinct values only."""
    return s.map(lambda x: x.casefold() if x is not None else None)


def ro_ratio_py(a: str, b: str) -> float:
    return SequenceMatcher(None, a.casefold(), b.casefold()).ratio()


def similar_pairs(vals: DataFrame, field: str, value: str, threshold: float = 0.8) -> DataFrame:
    """Ordered pairs (left, right) of distinct values of the same field with ratio >= threshold.

    ``vals`` has ``field, value`` and any extra tag columns; tags are returned
    prefixed ``l`` / ``r`` (e.g. ``_legal`` -> ``l_legal``).  Both orders of a
    pair are returned, each with its own (asymmetric) ratio.
    """
    t = float(threshold)
    tags = [c for c in vals.columns if c not in (field, value)]
    v = vals.select(F.col(field).alias("_f"), F.col(value).alias("_s"), *tags).withColumn(
        "_low", casefold("_s")
    ).withColumn("_len", F.length("_low"))
    chars = v.select("_f", "_s", "_len", F.posexplode(F.split("_low", "")).alias("_pos", "_ch")).where(
        F.col("_ch") != ""
    )
    occ = Window.partitionBy("_f", "_s", "_ch").orderBy("_pos")
    tok = chars.withColumn("_tok", F.concat(F.col("_ch"), F.lit("\u0001"), F.row_number().over(occ).cast("string")))
    freq = tok.groupBy("_f", "_tok").agg(F.count(F.lit(1)).alias("_freq"))
    ranked = tok.join(freq, ["_f", "_tok"])
    order = Window.partitionBy("_f", "_s").orderBy("_freq", "_tok")
    # bounds are made conservative by EPS: float error must never drop a pair
    need = F.ceil(F.lit(t) * F.col("_len") / F.lit(2.0 - t) - F.lit(EPS))
    prefix = ranked.withColumn("_r", F.row_number().over(order)).withColumn("_need", need).where(
        F.col("_r") <= F.col("_len") - F.col("_need") + 2
    )
    ratio_lo = t / (2.0 - t)
    shortest = F.ceil(F.col("_len") * ratio_lo - EPS)  # the shortest partner, and whether one shared token may do for it
    single = F.ceil(F.lit(t) * shortest / F.lit(2.0 - t) - F.lit(EPS)) < 2
    toks = prefix.groupBy("_f", "_s", "_len", "_need").agg(F.array_sort(F.collect_list(F.struct("_r", "_tok"))).alias("_toks"))
    names = F.transform("_toks", lambda x: x["_tok"])
    two = F.flatten(F.transform(names, lambda x, i: F.transform(
        F.filter(names, lambda y, j: j > i), lambda y: F.concat(F.least(x, y), F.lit("\u0002"), F.greatest(x, y)))))
    ones = F.when(single, F.slice(names, F.lit(1), F.greatest(F.col("_len") - F.col("_need") + 1, F.lit(0)).cast("int"))).otherwise(F.array().cast("array<string>"))
    keys = F.concat(F.when(F.col("_need") >= 2, two).otherwise(F.array().cast("array<string>")), ones)
    prefix = toks.select("_f", "_s", "_len", F.explode(keys).alias("_tok"))
    a = prefix.alias("a")
    b = prefix.alias("b")
    cand = (
        a.join(b, (F.col("a._f") == F.col("b._f")) & (F.col("a._tok") == F.col("b._tok")))
        .where(
            (F.col("a._s") != F.col("b._s"))
            & (F.col("b._len") >= F.col("a._len") * ratio_lo - EPS)
            & (F.col("a._len") >= F.col("b._len") * ratio_lo - EPS)
        )
        .select(F.col("a._f").alias("_f"), F.col("a._s").alias("left"), F.col("b._s").alias("right"))
        .distinct()
    )
    lt = v.select("_f", F.col("_s").alias("left"), *[F.col(c).alias("l" + c) for c in tags])
    rt = v.select("_f", F.col("_s").alias("right"), *[F.col(c).alias("r" + c) for c in tags])
    scored = cand.withColumn("_ratio", ro_ratio("left", "right")).where(F.col("_ratio") >= t)
    return (
        scored.join(lt, ["_f", "left"])
        .join(rt, ["_f", "right"])
        .select(
            F.col("_f").alias("field"),
            "left",
            "right",
            F.round("_ratio", 3).alias("similarity"),
            *["l" + c for c in tags],
            *["r" + c for c in tags],
        )
    )
