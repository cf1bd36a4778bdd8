import random
import re
import string

import pytest
from helpers import documents, rows_by_id, words
from pyspark.sql import types as T

from tablewise.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.LongType())])


def split(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(texts, items, window):
    wins = {}
    for i, t in items:
        w = split(t)
        if i is not None and w:
            n = min(window, len(w))
            for p in range(len(w) - n + 1):
                wins.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, ids = split(t), set(), set()
        for n in {len(k) for k in wins}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p : p + n])) in wins:
                    hit.update(range(p, p + n))
                    ids |= wins[k]
        out.append((len(w), len(hit), sorted(ids)))
    return out


def case():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, rng.randrange(11, 40)))) for i in range(12)]
    items += [(50, items[0][1]), (51, "The"), (52, "Solo Words Here"), (53, None), (54, "!!"), (None, "the the the"), (10, "ab " * 15)]
    texts = []
    for _ in range(60):
        w = split(rng.choice(items[:13])[1])
        a = rng.randrange(len(w))
        texts.append("; ".join(words(rng, rng.randrange(20)) + [x.upper() if rng.random() < 0.3 else x for x in w[a : a + rng.randrange(25)]] + words(rng, 5)))
    texts += [None, "", "THE the", "x solo-words.here y", "ab " * 40, "É é ünï", "the " * 30_000, texts[0]]
    return texts, items


@pytest.mark.parametrize("block_words", [1_000_000, 300])
def test_against_brute_force(spark, block_words):
    texts, items = case()
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = rows_by_id(decontaminate.find_contamination(documents(spark, texts), benchmark, block_words=block_words, keep=("text", "source")))
    for i, (n, hit, ids) in enumerate(brute(texts, items, 10)):
        r = got[i]
        assert (r.n_words, r.n_hit, r.item_ids) == (n, hit, ids), texts[i]
        assert sum(s.stop - s.start for s in r.spans) == hit and r.text == texts[i]


def test_empty_tables_and_repeated_rows(spark):
    benchmark = spark.createDataFrame([(1, "a b c", 1)], ITEMS)
    docs = documents(spark, ["x a b c", "x a b c", None], [1, 1, None])
    out = sorted((r.n_words, r.n_hit) for r in decontaminate.find_contamination(docs, benchmark).collect())
    assert out == [(0, 0), (4, 3), (4, 3)]
    assert [r.n_hit for r in decontaminate.find_contamination(docs, benchmark.limit(0)).collect()] == [0, 0, 0]
    assert decontaminate.find_contamination(docs.limit(0), benchmark).count() == 0


def test_windows_of_many_items_and_bounded_blocks(spark, monkeypatch):
    """A window that every item has is several rows of bounded size; blocks keep to their weight; nothing is lost."""
    monkeypatch.setattr(decontaminate, "OWNERS", 8)
    shared = "a b c d e f g h i j"
    items = [(i, f"{shared} x{i} y{i}") for i in range(60)] + [(60, "long " + "q" * 4000)]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    table = decontaminate.benchmark_windows(benchmark, 10, 400, "item_id", "text").collect()
    cells = {}
    for r in table:
        assert len(r["items"]) <= 24  # hashed shares of 8 on average
        cells[r.block] = cells.get(r.block, 0) + 10 + len(r["items"]) + len(r["words"]) // 8
    assert len(cells) > 3 and max(cells.values()) <= 800
    assert sorted(i for r in table if bytes(r["words"]) == shared.encode() for i in r["items"]) == sorted(str(i) for i in range(60))
    got = rows_by_id(decontaminate.find_contamination(documents(spark, [f"z {shared} z", "long " + "Q" * 4000, "long"]), benchmark, block_words=400))
    assert (got[0].n_hit, got[0].item_ids) == (10, sorted(str(i) for i in range(60)))
    assert (got[1].n_hit, got[1].item_ids, got[2].n_hit) == (2, ["60"], 0)
