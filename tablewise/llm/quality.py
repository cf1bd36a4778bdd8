"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text has two kinds of terms.  Shapes: n-grams of collapsed character classes
(case, digits, each punctuation mark, run lengths) and word repetition.  Words: its
lower-cased words, and characters and pairs of them in scripts written without spaces.  Each kind
is hashed, weighted by log frequency and inverse document frequency of the training rows, and
projected by a truncated SVD of its own.  A cosine is the mean of the two kinds'
cosines; the share of the words in it is the one of ``SHARES`` with which the training rows, each
left out in turn, are voted best (no words unless they help).

At most ``max_labelled`` labelled rows are fitted.  Their terms are counted, the Gram matrices
summed and decomposed, and their vectors built by tasks; the driver receives the projections
and the vectors (``2 * dims`` floats a row, a fixed bound), which are broadcast.  Every
document's cosines with all of them are computed in blocks, and the labels
of the ``neighbours`` nearest are averaged with weights that grow with similarity.

Labels, language, source and id are never inputs of a score.

Defined cases: null and blank texts have no terms and score the share of label
1 in the training rows; without training rows every score is 0.5; rows with a null
id or label do not train; a document with several labels trains on their mean, an id with several
texts on the smallest of them; repeated rows score alike; very long texts are taken
whole, piece by piece; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, save, text_or_empty
from .textarrays import mix

#: hashed terms of each kind
TERMS = 2048
KINDS = 2
#: shares of the words in a cosine to choose from, and how much less error makes a larger one better
SHARES, GAIN = (0.0, 0.25, 0.5, 0.75), 0.01
#: partitions of the training rows while their Gram matrices are summed
GRAM_PARTS = 2
#: rows of a Gram matrix that travel together
GRAM_ROWS = 64
PIECE_CHARS, SHORT_POWERS = 1 << 18, 1 << 14
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x2028, 0x2029, 0x3000], np.uint32)


def _class_table() -> np.ndarray:
    """Classes of code points below 0x3000: 0 white, 1 lower, 2 upper, 3 digit, others by themselves."""
    t = np.full(0x3000, 1, np.uint32)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isupper():
            t[c] = 2
        elif ch.isdigit():
            t[c] = 3
        elif not ch.isalpha():
            t[c] = 16 + c
    t[_SPACES[_SPACES < 0x3000]] = 0
    return t


_CLASS = _class_table()


def term_counts(text: str) -> np.ndarray:
    """Hashed term counts of one whole text, taken piece by piece: those of its shapes, then those of its words."""
    out = np.zeros(KINDS * TERMS, np.float32)
    for i in range(0, len(text), PIECE_CHARS):
        out += _piece_counts(text[i : i + PIECE_CHARS])
    return out


def _bins(terms: list[np.ndarray]) -> np.ndarray:
    return np.bincount((np.concatenate(terms) % np.uint64(TERMS)).astype(np.int64), minlength=TERMS).astype(np.float32)


def _piece_counts(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = np.where(cp < 0x3000, _CLASS[np.minimum(cp, 0x2FFF)], 1)
    edge = np.ones(len(cls), bool)
    edge[1:] = cls[1:] != cls[:-1]
    at = np.flatnonzero(edge)
    run = cls[at].astype(np.uint64)
    length = np.diff(np.append(at, len(cls)))
    plain = (run == 1) | (run == 3)
    sym = run * np.uint64(4) + np.where(plain, 0, np.minimum(length, 3)).astype(np.uint64)
    terms = [mix(sym + np.uint64(1 << 40))]
    code = sym
    for n in (2, 3, 4):
        if len(sym) >= n:
            code = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + sym[n - 1 :]
            terms.append(mix(code + (np.uint64(n) << np.uint64(50))))
    # words: does one repeat the one or two before it
    white = cls == 0
    begin = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    if len(begin) > 2:
        end = np.append(np.flatnonzero(white[1:] & ~white[:-1]) + 1, len(cls) if not white[-1] else [])[: len(begin)].astype(np.int64)
        sums = _sums(mix((cp | np.uint32(0x20)).astype(np.uint64)))
        word = sums[end] - sums[begin]
        for back in (1, 2):
            again = word[back:] == word[:-back]
            terms.append(mix((np.uint64(back) << np.uint64(56)) + again.astype(np.uint64)))
            level = (back << 8) + min(int(again.mean() * 8), 7)
            terms.append(np.repeat(mix(np.array([(1 << 61) + level], np.uint64)), max(len(word) // 4, 1)))
        distinct = len(np.unique(word)) / len(word)
        scale = int(min(distinct * 8, 7)) * 8 + int(min(np.log2(len(word)), 14) / 2)
        terms.append(np.repeat(mix(np.array([(1 << 60) + scale], np.uint64)), max(len(word) // 4, 1)))
    return np.concatenate([_bins(terms), _bins(_word_terms(text))])


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values, modulo 2^64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def _word_terms(text: str) -> list[np.ndarray]:
    """Lower-cased words, and from U+3000 on characters and pairs of neighbouring ones."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.where(cp < 0x3000, (_CLASS[np.minimum(cp, 0x2FFF)] >= 1) & (_CLASS[np.minimum(cp, 0x2FFF)] <= 3), False)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], letter.view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    # a polynomial over the characters of each word, from prefix sums
    up, down = _powers(len(cp))
    sums = _sums(mix(cp.astype(np.uint64) + np.uint64(1)) * up)
    words = mix((sums[end] - sums[begin]) * down[begin]) if len(begin) else np.zeros(0, np.uint64)
    wide = cp >= 0x3000
    pair = np.flatnonzero(wide[1:] & wide[:-1])
    single = mix(cp[wide].astype(np.uint64) + np.uint64(1 << 32))
    return [words, single, mix(cp[pair].astype(np.uint64) << np.uint64(32) | cp[pair + 1])]


_STEP = 0x9E3779B97F4A7C15


@lru_cache(1)
def _all_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_STEP, pow(_STEP, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the step and of its inverse modulo 2^64; only short ones stay in memory."""
    if n > SHORT_POWERS:
        return _all_powers.__wrapped__(n)
    up, down = _all_powers(SHORT_POWERS)
    return up[:n], down[:n]


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "utf-8")) % folds == 0, F.lit(False))


@dataclass
class Model:
    """Bounded: KINDS * TERMS weights, KINDS projections of TERMS x dims, at most max_labelled vectors and labels."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    sharpness: float
    share: float = 0.0

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of both kinds side by side, KINDS * dims floats a row."""
        x = weighted(counts, self.idf)
        kinds = [x[:, k * TERMS : (k + 1) * TERMS] @ self.basis[k] for k in range(KINDS)]
        return np.hstack([z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12) for z in kinds])

    def mixed(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors whose products are the mean cosines; without the words where they have no share."""
        dims = self.basis.shape[2]
        shapes, words = vectors[:, :dims], vectors[:, dims:]
        return shapes if self.share == 0 else np.hstack([shapes * np.float32(1 - self.share), words * np.float32(self.share)])

    def vote(self, near: np.ndarray) -> np.ndarray:
        """Labels of the nearest, weighted by similarity; ``near`` has a row of cosines a document."""
        k = min(self.neighbours, near.shape[1])
        top = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        cos = np.take_along_axis(near, top, 1).astype(np.float64)
        weight = np.exp(self.sharpness * (cos - cos.max(1, keepdims=True)))
        return np.clip((weight * self.labels[top]).sum(1) / weight.sum(1), 0.0, 1.0)

    def cosines(self, vectors: np.ndarray) -> np.ndarray:
        dims = self.basis.shape[2]
        return self.mixed(vectors) @ (self.vectors[:, :dims] if self.share == 0 else self.vectors).T

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        have = np.flatnonzero(counts.sum(1) > 0)
        if len(self.labels) and len(have):
            # whole slices, filled up with copies, and ten places: equal texts get equal scores, whatever their place in a product of floats
            rows = np.concatenate([have, np.repeat(have[:1], -len(have) % 256)])
            out[have] = np.round(self.vote(self.cosines(self.embed(counts[rows])))[: len(have)], 10)
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log counts times idf, each kind of unit length."""
    x = np.log1p(counts) * idf
    for k in range(KINDS):
        part = x[:, k * TERMS : (k + 1) * TERMS]
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    return x


TRAINING = "id string, y double, at array<int>, n array<float>"


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_labelled: int, folds: int, id_col: str, text_col: str) -> DataFrame:
    """id, y, and the terms (``at``) and counts (``n``) of at most ``max_labelled`` labelled documents, in the order of a hash of the id."""
    train = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col, folds))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_labelled)
    )
    src = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    rows = src.join(F.broadcast(train), "_id").groupBy("_id").agg(F.min("y").alias("y"), F.min("text").alias("text")).select("_id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t) for t in batch.column(2).to_pylist()]
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(1),
                    pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                    pa.array([c[a] for c, a in zip(counts, at, strict=True)], pa.list_(pa.float32())),
                ],
                names=["id", "y", "at", "n"],
            )

    return rows.mapInArrow(releasing(run), TRAINING)


def _dense(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of term counts of a batch of training rows."""
    at, n = batch.column(batch.schema.get_field_index("at")), batch.column(batch.schema.get_field_index("n"))
    out = np.zeros((batch.num_rows, KINDS * TERMS), np.float32)
    out[np.repeat(np.arange(batch.num_rows), np.diff(at.offsets)), at.flatten()] = n.flatten()
    return out


def _bases(rows: DataFrame, idf: np.ndarray, dims: int) -> np.ndarray:
    """The first ``dims`` right singular vectors of each kind's weighted terms, from Gram matrices summed and decomposed by tasks."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((TERMS, TERMS), np.float32) for _ in range(KINDS)]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                x = weighted(_dense(batch.slice(i, 256)), idf)
                for k in range(KINDS):
                    part = x[:, k * TERMS : (k + 1) * TERMS]
                    sums[k] += part.T @ part
        for k in range(KINDS):
            for i in range(0, TERMS, GRAM_ROWS):  # in small pieces, which no heap minds
                piece = sums[k][i : i + GRAM_ROWS].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([i], pa.int32()), pa.array([piece], pa.binary())], names=["kind", "first", "gram"])

    def decompose(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((TERMS, TERMS), np.float32)
        for i, g in zip(part["first"], part["gram"], strict=True):
            total[i : i + GRAM_ROWS] += np.frombuffer(g, np.float32).reshape(-1, TERMS)
        _, vectors = np.linalg.eigh(total)
        top = np.ascontiguousarray(vectors[:, ::-1][:, :dims]).astype(np.float32)
        return pd.DataFrame({"kind": part["kind"].iloc[:1].to_numpy(), "basis": [top.tobytes()]})

    parts = rows.select("at", "n").coalesce(GRAM_PARTS).mapInArrow(releasing(grams), "kind int, first int, gram binary")
    found = parts.groupBy("kind").applyInPandas(decompose, "kind int, basis binary").collect()
    return np.stack([np.frombuffer(r.basis, np.float32).reshape(TERMS, -1) for r in sorted(found, key=lambda r: r.kind)])


def _share(rows: DataFrame, model: Model, ids: list[str]) -> float:
    """The share of the words with which the training rows are voted best when each is left out."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((model, {x: i for i, x in enumerate(ids)}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                vectors, y = model.embed(_dense(part)), part.column(1).to_numpy()
                own = [place[x] for x in part.column(0).to_pylist()]
                errors = []
                for share in SHARES:
                    near = replace(model, share=share).cosines(vectors)
                    near[np.arange(len(own)), own] = -np.inf
                    errors.append(pa.array((model.vote(near) - y) ** 2))
                yield pa.RecordBatch.from_arrays(errors, names=[f"e{j}" for j in range(len(SHARES))])

    errors = rows.mapInArrow(releasing(run), ", ".join(f"e{j} double" for j in range(len(SHARES)))).agg(*[F.avg(f"e{j}") for j in range(len(SHARES))]).first()
    shared.destroy()
    best = 0
    for j in range(1, len(SHARES)):
        if errors[j] < errors[best] - GAIN:
            best = j
    return SHARES[best]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    max_labelled: int = 6000,
    dims: int = 48,
    neighbours: int = 25,
    sharpness: float = 20.0,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit on at most ``max_labelled`` labelled rows outside the held-out fold, taken in the order of a hash of the id."""
    rows = save(training_rows(docs, labels, label_col, max_labelled, folds, id_col, text_col), "training")
    size, prior = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
    if not size:
        z = np.zeros((KINDS, TERMS, 1), np.float32)
        return Model(np.zeros(KINDS * TERMS, np.float32), z, np.zeros((0, KINDS), np.float32), np.zeros(0), 0.5, neighbours, sharpness)
    frequency = np.zeros(KINDS * TERMS)
    for term, n in rows.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # at most KINDS * TERMS rows
        frequency[term] = n
    idf = (np.log((1 + size) / (1 + frequency)) + 1).astype(np.float32)
    model = Model(idf, _bases(rows, idf, dims), np.zeros((0, KINDS), np.float32), np.zeros(0), float(prior), neighbours, sharpness)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [v.tobytes() for v in shared.value.embed(_dense(part)).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, pa.binary())], names=["id", "y", "vector"])

    got = sorted(rows.mapInArrow(releasing(vectors), "id string, y double, vector binary").collect())  # at most max_labelled rows
    shared.destroy()
    model.vectors = np.stack([np.frombuffer(r.vector, np.float32) for r in got])
    model.labels = np.array([r.y for r in got])
    if size > 1:
        model.share = _share(rows, model, [r.id for r in got])
    if model.share == 0:
        model.vectors = np.ascontiguousarray(model.vectors[:, : model.basis.shape[2]])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, ``keep`` columns, score (0 to 1, higher: label 1 likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    fields = [f for f in src.schema.fields if f.name != "_text"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                counts = np.stack([term_counts(t) for t in part.column(1).to_pylist()])
                scores = pa.array(shared.value.score(counts), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], scores], names=schema.names)

    return src.mapInArrow(releasing(run), schema).select(
        F.col("_id").alias("doc_id"), *[F.col(f"_keep_{c}").alias(c) for c in keep], "score"
    )
