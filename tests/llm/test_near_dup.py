import random
import re
import string

import numpy as np
import pytest
from helpers import documents, rows_by_id, words

from tablewise.llm import components, near_dup, set_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(t, n):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(ids, texts, n, percent=80):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(sets[i]), low[find(i)]) for i, d in enumerate(ids)}


def corpus(rng):
    """Groups around the threshold, a chain whose ends are far apart, a group of many copies."""
    texts = []
    for _ in range(14):
        base = words(rng, rng.randrange(25, 120), 5000)
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 18)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    chain = words(rng, 120, 5000)
    for i in range(12):  # neighbours are linked, the ends share little
        chain[i * 9 : i * 9 + 2] = [f"c{i}", f"d{i}"]
        texts.append(" ".join(chain))
    hot = words(rng, 80, 5000)
    for i in range(60):
        w = list(hot)
        w[rng.randrange(80)] = f"h{i}"
        texts.append(" ".join(w))
    return texts + [None, "", " \n", "one", "One", "two words", "three small words", "three small", texts[0], texts[0].upper(), "r " * 5000, "r " * 4000]


@pytest.mark.parametrize("n, hot", [(4, 64), (5, 64), (4, 2), (5, 1)])
def test_against_brute_force(spark, monkeypatch, n, hot):
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    monkeypatch.setattr(set_join, "HOT", hot)
    rng = random.Random(n)
    texts = corpus(rng)
    ids = rng.sample(range(10_000), len(texts))
    got = rows_by_id(near_dup.near_duplicates(documents(spark, texts, ids).repartition(3), words=n))
    want = brute(ids, texts, n)
    for d in ids:
        r = got[d]
        assert (r.n_shingles, r.component_id, r.kept) == (*want[d], want[d][1] == d), texts[ids.index(d)]


def test_null_and_repeated_ids_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [t, t, t + " z", t, None], [4, 4, 9, None, None])
    out = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect() if r.n_shingles)
    assert out == [(False, 4, 36, 4, True), (False, 4, 36, 4, True), (False, 9, 37, 4, False), (True, 0, 36, 4, False)]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300), (400, 401), (401, 400)]
    rng.shuffle(edges)
    got = {r.vertex: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 80)} | {200 + i: 200 for i in range(1, 9)} | {401: 400}
    assert got == want


def sets_table(spark, sets, roots):
    rows = [(i.to_bytes(16, "big"), r.to_bytes(16, "big"), bytearray(np.sort(x).tobytes())) for i, (x, r) in enumerate(zip(sets, roots))]
    return spark.createDataFrame(rows, "node binary, root binary, codes binary").repartition(4)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_rare_member_join_has_every_link(spark, monkeypatch, percent):
    """Every pair of different groups at or above the threshold is a candidate or has both sets in the crowded list."""
    monkeypatch.setattr(set_join, "HOT", 6)
    rng = np.random.default_rng(percent)
    common, sets = rng.integers(0, 2**64, 40, np.uint64), []
    for _ in range(60):
        base = np.concatenate([rng.choice(common, rng.integers(0, 25), replace=False), rng.integers(0, 2**64, rng.integers(1, 60), np.uint64)])
        for _ in range(rng.integers(1, 5)):
            keep = base[rng.random(len(base)) > rng.choice([0.0, 0.02, 0.1])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**64, rng.integers(0, 3), np.uint64), base[:1]])))
    roots = [int(x) for x in rng.integers(0, 150, len(sets))]
    df = sets_table(spark, sets, roots)
    shared = set_join.shared_rows(set_join.prefix_rows(df, set_join.rarity(df), percent))
    pairs = {(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in set_join.candidates(shared, percent).collect()}
    slow = {int.from_bytes(r.node, "big") for r in set_join.crowded(shared).collect()}
    both = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i + 1, len(sets)) if roots[i] != roots[j]}
    links = {p for p, n in both.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    assert len(links) > 20 and all(p in pairs or set(p) <= slow for p in links)
    assert links & pairs and len(pairs) < len(both) / 10


def test_shared_template_below_the_threshold_pairs_nothing(spark):
    """Pages of one template (similarity 0.64) meet in buckets, but in no rare shingle: no candidates, no blocks."""
    rng = np.random.default_rng(2)
    template = rng.integers(0, 2**64, 78, np.uint64)
    df = sets_table(spark, [np.concatenate([template, rng.integers(0, 2**64, 22, np.uint64)]) for _ in range(3_000)], range(3_000))
    shared = set_join.shared_rows(set_join.prefix_rows(df, set_join.rarity(df), 80))
    assert set_join.candidates(shared, 80).count() == 0 and set_join.crowded(shared).count() == 0


def test_signatures_and_bands_find_pairs_at_the_threshold():
    """2,000 pairs of sets at exactly 0.8: all share a band and are estimated above the check's bound."""
    rng = np.random.default_rng(3)
    missed = low = 0
    for size in rng.integers(1, 50, 2_000) * 9:
        x = np.unique(rng.integers(0, 2**64, size * 10 // 9, np.uint64))  # 8/9 of each set in common: 8 / 10
        cut = len(x) // 10
        x = x[: cut * 10]
        a, b = x[: cut * 9], np.concatenate([x[: cut * 8], x[cut * 9 :]])
        s = near_dup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 200, 7)
        missed += not (s[0] == s[1]).reshape(40, 5).all(1).any()
        low += np.count_nonzero(s[0].astype(np.uint16) == s[1].astype(np.uint16)) < near_dup.ESTIMATE * 200
    assert missed == 0 and low == 0
