import hashlib
import random
import re
import zlib

import pytest
from helpers import documents

from tablewise.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=24, exponent=3):
    """All maximal stretches with smallest period q, lag by lag."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q):
                part = words[i : j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {x for s, length, q in runs for x in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, count):
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "a " * 24, "a " * 23, "a b " * 12, "a b " * 11, "\x0b".join(["x　y"] * 30), "é " * 40 + "e " * 40]
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(6)):
            unit = [rng.choice("abcdé") for _ in range(rng.randrange(1, 50 if rng.random() < 0.3 else 9))]
            words += (unit * 9)[: rng.randrange(1, 8) * len(unit) + rng.randrange(len(unit))] if rng.random() < 0.7 else unit
        out.append(rng.choice(["", "\t"]) + rng.choice([" ", " \n"]).join(words) + rng.choice(["", " "]))
    # a run of runs, and a text whose halves repeat
    out.append(" ".join((["a"] * 30 + ["b"]) * 5))
    out.append(" ".join((list("abc") * 10 + list("xyzw") * 8) * 4))
    return out


@pytest.mark.parametrize("min_length, exponent", [(24, 3), (6, 3), (40, 5), (3, 3)])
def test_runs_and_texts_equal_brute_force(spark, min_length, exponent):
    values = texts(min_length, 150)
    got = {r.doc_id: r for r in periodic_runs.collapse_runs(documents(spark, values), min_length, exponent).collect()}
    assert len(got) == len(values)
    found = 0
    for i, text in enumerate(values):
        words = WORD.findall(text or "")
        runs = brute_runs(words, min_length, exponent)
        found += len(runs)
        assert [tuple(r) for r in got[i].runs] == runs
        assert got[i].n_words == len(words) and got[i].collapsed == collapsed(words, runs)
    assert found > 50


def test_null_and_repeated_ids_repeated_rows_and_an_empty_table(spark):
    df = documents(spark, ["a " * 30] * 4 + ["b"], [None, None, 3, 3, 3])
    rows = periodic_runs.collapse_runs(df).collect()
    assert sorted((str(r.doc_id), len(r.runs), r.collapsed) for r in rows) == sorted([("None", 1, "a")] * 2 + [("3", 1, "a")] * 2 + [("3", 0, "b")])
    assert periodic_runs.collapse_runs(df.limit(0)).collect() == []


def test_a_very_long_text_of_one_word_and_one_with_a_long_period(spark):
    rng = random.Random(1)
    unit = [f"w{rng.randrange(10**9)}" for _ in range(50_000)]
    values = ["w " * 400_000, " ".join(["x", *unit * 4, "y"])]
    got = {r.doc_id: r for r in periodic_runs.collapse_runs(documents(spark, values)).collect()}
    assert [tuple(r) for r in got[0].runs] == [(0, 400_000, 1)] and got[0].collapsed == "w"
    assert [tuple(r) for r in got[1].runs] == [(1, 200_000, 50_000)] and got[1].collapsed == " ".join(["x", *unit, "y"])


def test_seeds_are_linear_in_the_words():
    """Each gram is linked to its next occurrence alone, and a stretch is extended once."""
    import numpy as np

    calls = []
    kept = periodic_runs._equal_on
    periodic_runs._equal_on = lambda *a: calls.append(a) or kept(*a)
    try:
        words = np.tile(np.arange(7), 20_000)
        runs = periodic_runs.find_runs(words, np.array([0, len(words)]))
    finally:
        periodic_runs._equal_on = kept
    assert runs.tolist() == [[0, 140_000, 7]] and len(calls) == 1


def test_parameters_are_checked():
    import numpy as np

    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(3, np.int64), np.array([0, 3]), 24, 2)


def test_query_equals_brute_force(spark, tmp_path):
    """The registered query, repeated tails and digests included."""
    values = [t for t in texts(3, 200)] + [" ".join(f"v{random.Random(i).randrange(300)}" for _ in range(i)) for i in range(1, 120)]
    ids = [i * 37 for i in range(len(values))]
    documents(spark, values, ids).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text in zip(ids, values, strict=True):
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 20
