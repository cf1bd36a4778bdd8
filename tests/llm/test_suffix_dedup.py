import hashlib
import random

import numpy as np
import pytest
from helpers import documents, rows_by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewise.llm import repeats, suffix_dedup


def brute(texts, window):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for d, raw in enumerate(raws):
        for p in range(len(raw) - window + 1):
            seen.setdefault(raw[p : p + window], []).append((d, p))
    gone = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p : p + window] = b"\x01" * window
    out = []
    for raw, g in zip(raws, gone, strict=True):
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        out.append((len(raw), sum(g), spans, bytes(c for c, x in zip(raw, g, strict=True) if not x)))
    return out


def compare(spark, texts, window):
    got = rows_by_id(suffix_dedup.remove_repeats(documents(spark, texts).repartition(3), window))
    for i, (n, removed, spans, kept) in enumerate(brute(texts, window)):
        r = got[i]
        mine = (texts[i] or "").encode() if r.n_removed == 0 else bytes(r.kept or b"")
        assert (r.n_bytes, r.n_removed, r.n_spans, mine) == (n, removed, spans, kept), i
        assert r.text_digest == hashlib.sha256((texts[i] or "").encode()).hexdigest()


def corpus(rng, window):
    letter = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [letter(rng.randrange(window, 3 * window)) for _ in range(6)]
    texts = [letter(rng.randrange(0, 4 * window)) for _ in range(25)]
    for _ in range(40):
        s = rng.choice(shared)
        a = rng.randrange(len(s))
        texts.append(letter(rng.randrange(30)) + s[a : a + rng.randrange(2 * window)] + letter(rng.randrange(30)) + rng.choice(shared)[: rng.randrange(2 * window)])
    texts += [None, "", texts[30], texts[30], "a" * (window - 1), "b" * (3 * window), "xy" * window + "z" * 10, shared[0], "c" * window]
    return texts


@pytest.mark.parametrize("hot", [repeats.HOT_RUNS, 2])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    monkeypatch.setattr(repeats, "TASK_BYTES", 1500)
    compare(spark, corpus(random.Random(hot), 60), 60)


@pytest.mark.parametrize("bound", [1, 3])
def test_keys_with_many_contexts_are_decided_by_window(spark, monkeypatch, bound):
    monkeypatch.setattr(repeats, "HOT_RUNS", 2)
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", bound)
    monkeypatch.setattr(repeats, "TASK_BYTES", 1500)
    compare(spark, corpus(random.Random(bound), 60), 60)


def test_a_passage_that_all_texts_share_meets_in_no_task(spark, monkeypatch):
    """Every text has the passage, each with surroundings of its own."""
    rng = random.Random(7)
    monkeypatch.setattr(repeats, "HOT_RUNS", 20)
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", 20)
    passage = "".join(rng.choice("abcdefgh") for _ in range(70))
    texts = ["".join(rng.choice("ijklmnop") for _ in range(90)) + passage + "".join(rng.choice("qrstuvwx") for _ in range(90)) for _ in range(300)]
    judged = suffix_dedup.repeated_windows

    def bounded(keys, contexts, window):
        assert not len(keys) or np.unique(keys, return_counts=True)[1].max() <= 20
        return judged(keys, contexts, window)

    monkeypatch.setattr(suffix_dedup, "repeated_windows", bounded)
    compare(spark, texts, 60)


def test_window_of_200_and_long_text(spark):
    rng = random.Random(5)
    line = "".join(rng.choice("abcdef ") for _ in range(250))
    long = "".join(rng.choice("abcdef ") for _ in range(30_000))
    compare(spark, [long[:20_000] + line, line + "!", "q" + line[:199], "q" + line[3:203], long[10_000:], "p" * 1000], 200)


def test_window_under_the_gram(spark):
    compare(spark, ["abcabc", "xabcx", "é" * 9, "zz"], 3)


def test_repeated_rows_null_ids_and_empty(spark):
    docs = documents(spark, ["k" * 5 + "abcdefgh" * 9] * 2 + [None, "short"], [1, 1, None, None])
    out = suffix_dedup.remove_repeats(docs, 20).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(0, 0), (5, 0), (77, 77), (77, 77)]
    assert suffix_dedup.remove_repeats(docs.limit(0), 20).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=8).map(lambda b: bytes(x % 3 for x in b) * 6), min_size=1, max_size=12), st.integers(9, 41))
def test_deep_shallow_order(parts, depth):
    raw = np.frombuffer(b"".join(parts) + bytes(depth), np.uint8)
    starts = np.arange(len(raw) - depth + 1)
    order, same = suffix_dedup.deep_shallow_sort(raw, starts, depth)
    text = raw.tobytes()
    cut = [text[i : i + depth] for i in order]
    assert cut == sorted(text[i : i + depth] for i in starts)
    assert sorted(order.tolist()) == starts.tolist()
    assert same.tolist() == [i > 0 and cut[i] == cut[i - 1] for i in range(len(cut))]
