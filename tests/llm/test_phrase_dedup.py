import hashlib
import random
import re

import pytest
from helpers import documents, rows_by_id, words

from tablewise.llm import phrase_dedup, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """rows: (id, text); a null id is larger than any."""
    order = lambda i: (1, 0) if i is None else (0, i)
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < order(i):
                gone.update(range(p, p + window))
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def compare(spark, texts, window, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    got = rows_by_id(phrase_dedup.remove_phrases(documents(spark, texts, ids).repartition(3), window))
    for i, t, (n, removed, kept) in zip(ids, texts, brute(list(zip(ids, texts, strict=True)), window), strict=True):
        r = got[i]
        assert (r.n_words, r.n_removed) == (n, removed), (i, t)
        mine = r.plain_digest if r.n_removed == 0 else hashlib.sha256(bytes(r.kept or b"")).hexdigest()
        assert mine == hashlib.sha256(kept.encode()).hexdigest()


def corpus(rng, window):
    shared = [words(rng, rng.randrange(window, 3 * window)) for _ in range(5)]
    texts = [" ".join(words(rng, rng.randrange(0, 3 * window))) for _ in range(20)]
    for _ in range(40):
        s = rng.choice(shared)
        a = rng.randrange(len(s))
        mixed = words(rng, rng.randrange(9)) + s[a : a + rng.randrange(2 * window)] + words(rng, rng.randrange(9)) + rng.choice(shared)
        texts.append(rng.choice([" ", "\n", " \t "]).join(mixed))
    rep = "la " * (2 * window)
    return texts + [None, "", "  \n", texts[30], texts[30] + " ", "x" + texts[31], rep, rep + "end", "solo word   x"]


@pytest.mark.parametrize("hot", [repeats.HOT_RUNS, 2])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    monkeypatch.setattr(repeats, "TASK_BYTES", 4000)
    rng = random.Random(hot)
    texts = corpus(rng, 12)
    ids = rng.sample(range(1000), len(texts))
    compare(spark, texts, 12, ids)


@pytest.mark.parametrize("bound", [1, 3])
def test_keys_with_many_contexts_are_decided_by_window(spark, monkeypatch, bound):
    monkeypatch.setattr(repeats, "HOT_RUNS", 2)
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", bound)
    rng = random.Random(bound)
    texts = corpus(rng, 12)
    compare(spark, texts, 12, rng.sample(range(1000), len(texts)))


def test_two_code_points_a_word(spark, monkeypatch):
    monkeypatch.setattr(phrase_dedup, "ALPHABET", 7)
    contexts = [b"a b c d e f g h i", b"x b c d e y z q w", b"b c d e"]
    import numpy as np

    got = phrase_dedup.recurring_windows(np.array([1, 1, 1]), contexts, np.array([5, 3, 9]), 4)
    assert got == [[{"start": 1, "stop": 2}], [], [{"start": 0, "stop": 1}]]


def test_window_of_50_long_text(spark):
    rng = random.Random(9)
    passage = words(rng, 70)
    long = words(rng, 9000, 100_000)
    texts = [" ".join(long[:4000] + passage + long[4000:]), " ".join(words(rng, 30) + passage[:49]), " ".join(words(rng, 5) + passage[4:]), " ".join(long[3000:3100])]
    compare(spark, texts, 50)


def test_null_and_repeated_ids_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [t, t, t + " z", t], [4, 4, 9, None])
    out = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in phrase_dedup.remove_phrases(docs, 10).collect())
    assert out == [(False, 4, 30, 0), (False, 4, 30, 0), (False, 9, 31, 30), (True, 0, 30, 30)]
    assert phrase_dedup.remove_phrases(docs.limit(0), 10).count() == 0
