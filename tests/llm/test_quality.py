import math
import random
import zlib
from dataclasses import replace

import numpy as np
import pytest
from helpers import documents, rows_by_id, words
from pyspark.sql import functions as F

from tablewise.llm import quality


def corpus(n=400):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        w = words(rng, rng.randrange(20, 120))
        good = rng.random() < 0.75
        if not good:
            kind = rng.randrange(4)
            w = [[x.upper() + "!!" for x in w], [x + rng.choice(["***", "$$$", "###"]) for x in w], [x + " |" for x in w], [w[0]] * len(w)][kind]
        else:
            w = [x.capitalize() if j % 9 == 0 else x + "." if j % 9 == 8 else x for j, x in enumerate(w)]
        texts.append(" ".join(w))
        labels.append((i, int(good), 0))
    return texts, labels


def test_held_out_accuracy_and_fold(spark):
    texts, labels = corpus()
    docs = documents(spark, texts)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, text int"), max_labelled=200)
    assert len(model.labels) <= 200 and model.vectors.shape[0] == len(model.labels)
    got = rows_by_id(quality.score(docs, model).withColumn("held", quality.held_out("doc_id")))
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in got.items() if r.held)
    right = [(got[i].score >= 0.3) == bool(labels[i][1]) for i in held]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_corpus_whose_halves_differ_in_words_only(spark):
    """Shapes tell nothing here, so the words get a share; scripts without spaces count by character pairs."""
    rng = random.Random(9)
    pools = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)] for n in (60, 60, 200)]
    texts, labels = [], []
    for i in range(500):
        good = i % 2
        if i % 5 == 0:
            texts.append("".join(chr((0x4E00 if good else 0x5E00) + rng.randrange(40)) for _ in range(60)))
        else:
            # words of one length, from one pool for both halves and one for each
            texts.append(" ".join(rng.choice(pools[good if rng.random() < 0.4 else 2]) for _ in range(40)))
        labels.append((i, good, 0))
    docs = documents(spark, texts)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = rows_by_id(quality.score(docs, model))
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(got[i].score >= 0.5) == bool(labels[i][1]) for i in held]
    assert len(held) > 60 and sum(right) / len(right) >= 0.9
    assert quality.term_counts("你好世界你好").tolist() != quality.term_counts("abcdab").tolist()


def test_words_get_no_share_where_shapes_tell_all(spark):
    texts, labels = corpus()
    model = quality.fit(documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.share in quality.SHARES and model.vectors.shape[1] == model.basis.shape[2] * (1 if model.share == 0 else quality.KINDS)


@pytest.mark.parametrize("share", [0.0, 0.5])
def test_scores_equal_a_plain_vote_over_all_cosines(spark, share):
    texts, labels = corpus(150)
    docs = documents(spark, [*texts, *texts[:9]])
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(docs, frame)
    dims = model.basis.shape[2]
    train = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5]
    counts = np.stack([quality.term_counts(texts[i]) for i in sorted(train, key=str)])
    model = replace(model, share=share, vectors=model.embed(counts) if share else model.embed(counts)[:, :dims])

    def unit(v):
        return v / max(np.linalg.norm(v), 1e-12)

    def vector(text):
        c = np.log1p(quality.term_counts(text).astype(np.float64)) * model.idf
        return [unit(unit(c[k * quality.TERMS :][: quality.TERMS]) @ model.basis[k].astype(np.float64)) for k in range(quality.KINDS)]

    known = [(vector(texts[i]), labels[i][1]) for i in sorted(train, key=str)]
    got = quality.score(docs, model).collect()
    assert len(got) == len(texts) + 9
    for r in got[::7]:
        mine = vector([*texts, *texts[:9]][r.doc_id])
        near = sorted((((1 - share) * float(a[0] @ mine[0]) + share * float(a[1] @ mine[1])), y) for a, y in known)
        top = near[-model.neighbours :]
        weights = [math.exp(model.sharpness * (c - top[-1][0])) for c, _ in top]
        want = sum(w * y for w, (_, y) in zip(weights, top, strict=True)) / sum(weights)
        tied = near[-model.neighbours - 1][0] > top[0][0] - 1e-6
        assert abs(r.score - want) < (0.05 if tied else 1e-4)


def test_repeated_ids_in_documents_train_on_one_text(spark):
    texts, labels = corpus(60)
    ids = [*range(60), *range(60)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    twice = [*texts, *[t + " zz!!" for t in texts]]
    a = quality.fit(documents(spark, twice, ids), frame, max_labelled=30)
    b = quality.fit(documents(spark, twice, ids).repartition(7), frame, max_labelled=30)
    assert len(a.labels) == 30 and np.allclose(np.abs(a.vectors @ a.vectors.T), np.abs(b.vectors @ b.vectors.T), atol=1e-4)


def test_the_driver_receives_vectors_not_terms(spark):
    texts, labels = corpus(120)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality.training_rows(documents(spark, texts), frame, "quality", 6000, 5, "doc_id", "text")
    model = quality.fit(documents(spark, texts), frame)
    assert model.vectors.nbytes + model.basis.nbytes < 4 * (rows.count() * 2 * 48 + 2 * quality.TERMS * 48) + 1


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    texts, labels = corpus(120)
    docs = documents(spark, texts)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, 0) for i, y, _ in labels]
    a = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    b = quality.fit(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert np.allclose(a.vectors @ a.vectors.T, b.vectors @ b.vectors.T, atol=1e-5) and (a.labels == b.labels).all()


def test_score_depends_on_the_text_alone(spark):
    texts, labels = corpus(120)
    model = quality.fit(documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    a = {r.doc_id: r.score for r in quality.score(documents(spark, texts), model).collect()}
    b = {r.doc_id: r.score for r in quality.score(documents(spark, texts).withColumn("source", F.lit("z")).repartition(5), model).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_nulls_long_text_no_labels_and_empty(spark):
    texts, labels = corpus(80)
    docs = documents(spark, [*texts, None, "", "  ", "word " * 300_000, texts[0]])
    frame = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (0, 1 - labels[0][1], 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, frame)
    got = rows_by_id(quality.score(docs, model))
    assert got[80].score == got[81].score == model.prior and got[84].score == got[0].score and 0 <= got[83].score <= 1
    none = quality.fit(docs, frame.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0
