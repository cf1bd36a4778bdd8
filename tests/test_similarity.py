import itertools

from tablewise.functions.similarity import ro_ratio_py, similar_pairs


def test_prefix_filter_join_misses_no_pair(spark):
    vocab = ["Female", "Femail", "female", "Male", "males", "tide", "diet", "Walking", "Walkin", "Bike", "Bikes",
             "Public_Transportation", "Public_Transport", "Automobile", "Automobil", "Sometimes", "Sometime",
             "Frequently", "Frequent", "Always", "Alway", "abcdefgh", "hgfedcba", "x", "xy"]
    vals = spark.createDataFrame([("f", v) for v in vocab], "field string, value string")
    got = {(r["left"], r["right"]): r["similarity"] for r in similar_pairs(vals, "field", "value", 0.8).collect()}
    brute = {}
    for a, b in itertools.permutations(vocab, 2):
        r = ro_ratio_py(a, b)
        if r >= 0.8:
            brute[(a, b)] = round(r, 3)
    assert got == brute


def test_ratio_is_asymmetric():
    assert ro_ratio_py("tide", "diet") != ro_ratio_py("diet", "tide")
    assert round(ro_ratio_py("femail", "female"), 3) == 0.833


def test_random_vocabulary_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    vocab = sorted({"".join(rnd.choice("abcdeAB") for _ in range(rnd.randint(2, 9))) for _ in range(120)})
    vals = spark.createDataFrame([("f", v) for v in vocab], "field string, value string")
    for t in (0.8, 0.6):
        got = {(r["left"], r["right"]) for r in similar_pairs(vals, "field", "value", t).collect()}
        brute = {(a, b) for a, b in itertools.permutations(vocab, 2) if ro_ratio_py(a, b) >= t}
        assert got == brute
