import random

import corpus_pipeline
import public_tokenizers
import test_decontaminate
import test_exact_dedup
import test_near_dup
import tiktoken
from helpers import words

from tablewise.llm import bpe
from tablewise.llm.queries import QUERIES


def tables(spark, folder):
    rng = random.Random(8)
    rows, labels, items = [], [], [(i, " ".join(words(rng, 20)), 0) for i in range(5)]
    for i in range(260):
        w = words(rng, rng.randrange(25, 90), 5000)
        if i % 6 == 0:
            w = [x.upper() + "!!" for x in w]
        elif i % 17 == 1 and rows:
            w = rows[-1][1].split(" ")
        elif i % 13 == 2 and rows:
            w = [*rows[-1][1].split(" "), "more"]
        elif i % 11 == 3:
            w = w[:9] + items[i % 5][1].split(" ")[2:14] + w[9:]
        rows.append((i, " ".join(w), "en", f"s{i % 3}", i))
        labels.append((i, int("!!" not in rows[-1][1]), 0))
    rows += [(900, None, "en", None, 0), (901, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(i, t) for i, t, _ in items], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{i}")
        docs = spark.read.parquet(f"{tmp_path}/out{i}")
        out.append({r.doc_id: r for r in docs.collect()})
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    scored = {i for i, t, *_ in rows if "!!" not in (t or "")}
    assert set(out[0]) == scored
    left = {i: t for i, t, *_ in rows if i in scored}
    groups = test_exact_dedup.brute(list(left.items()))
    left = {i: t for i, t in left.items() if groups[(i, test_exact_dedup.digest(t))][0] == i}
    assert set(out[1]) == set(left)
    low = test_near_dup.brute(list(left), list(left.values()), 5)
    left = {i: t for i, t in left.items() if low[i][1] == i}
    assert set(out[2]) == set(left)
    found = test_decontaminate.brute(list(left.values()), [(i, t) for i, t, _ in items], 10)
    left = {i: t for (i, t), (_, hit, _) in zip(left.items(), found, strict=True) if not hit}
    assert set(out[3]) == set(left) and all(out[3][i].text == t for i, t in left.items())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {i: r.ids for i, r in out[4].items()} == {i: library.encode_ordinary(t or "") for i, t in left.items()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(left)


def test_clashing_columns_null_texts_and_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path))
    rows = [(1, "Plain words that nobody else has said before now.", 0.5, 3, "r", "x"), (2, None, None, None, None, None), (None, "", 1.0, 1, "q", "y")]
    schema = "doc_id long, text string, score double, n_hit long, row string, _text string"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        want = docs.columns
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == want
        left = docs.collect()
        assert len(left) in (0, 2) and all(r in [tuple(x) for x in rows] for r in map(tuple, left))
        assert corpus_pipeline.token_stage(spark, docs, str(tmp_path)).count() == len(left)


def test_near_stage_tells_null_and_repeated_ids_apart(spark):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(words(rng, 40, 5000)) for _ in range(5))
    rows = [
        (3, a), (None, a + " more"),  # the copy without an id goes ...
        (None, b), (None, None), (None, ""),  # ... and no other row without one
        (None, c), (None, c + " more"), (None, c + " again"),  # one of three stays
        (5, d), (7, d + " more"), (7, e),  # only the copy under id 7 goes
        (8, e + " more"), (8, e + " again"),  # the smallest id of the component stays
    ]
    kept = [tuple(r) for r in corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    of_c = [r for r in kept if r[1] and r[1].startswith(c)]
    assert len(of_c) == 1 and of_c[0] in rows[5:8]
    assert sorted(map(str, set(kept) - set(of_c))) == sorted(map(str, [rows[0], rows[2], rows[3], rows[4], rows[8], rows[10]])) and len(kept) == 7


def test_every_operator_has_its_query():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
