"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that operators use inside
        T.StructField("digest", T.StringType()),
        T.StructField("_id", T.LongType()),
        T.StructField("key", T.DoubleType()),
        T.StructField("score", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("node", T.IntegerType()),
    ]
)


def documents(spark, texts, ids=None, sources=None):
    """A documents table; ids default to 0, 1, 2, ..."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or [f"s{i % 3}" if i % 7 else None for i in range(len(texts))]
    rows = [(i, t, "en", s, "x", 5, 1.5, "high", None, 3) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows_by_id(df, id_col="doc_id"):
    out = {}
    for r in df.collect():
        assert r[id_col] not in out
        out[r[id_col]] = r
    return out
