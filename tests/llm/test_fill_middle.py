import hashlib
import random

import pytest
from helpers import documents

from tablewise.llm import fill_middle
from tablewise.llm.fill_middle import Settings


def brute(doc_id, text, s):
    text = text or ""
    digest = hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(m in text for m in (s.prefix, s.suffix, s.middle)) or h3 % 100 >= s.rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, x = text[:a], text[a:b], text[b:]
    if h4 % 100 < s.spm_rate:
        return n, "spm", a, b - a, s.suffix + x + s.prefix + p + s.middle + m
    return n, "psm", a, b - a, s.prefix + p + s.suffix + x + s.middle + m


def texts():
    rng = random.Random(11)
    special = [None, "", " ", "a", "<P>x", "y<S", "S>", "<M>", "<", "><", "line\nline\r\n", "\\1 $1 ${x}", "\U0001f926\U0001f3fc‍♂️é́", "\0a\0", "%d %s", "\x85 "]
    parts = ["<", ">", "P", "S", "M", "a", "é", "\U0001f600", "\n", "$2", "\\E"]
    many = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    return special + many + ["same text"] * 20 + ["x\U0001f600" * 300_000]


def check(spark, settings, values, ids=None):
    df = documents(spark, values, ids)
    out = fill_middle.transform(df, settings, keep=("digest", "_id"))
    assert out.columns == ["doc_id", "digest", "_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = sorted(
        (str(r.doc_id), r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)
        for r in out.withColumn("restored", fill_middle.restore("output", "form", settings)).collect()
    )
    want = sorted((str(i), t or "", *brute(i, t, settings), t or "") for i, t in zip(ids or range(len(values)), values, strict=True))
    key = [tuple(map(repr, r)) for r in want]
    assert [tuple(map(repr, r)) for r in got] == key
    return want


def test_every_text_equals_brute_force_and_is_rebuilt(spark):
    forms = {r[3] for r in check(spark, Settings(), texts())}
    assert forms == {"plain", "psm", "spm"}


def test_null_and_repeated_ids_and_other_settings(spark):
    values = ["one two three", "one two three", None, "four", "five"]
    check(spark, Settings(), values, [None, 7, None, 7, 7])
    check(spark, Settings("[[pre]]", "[[suf]]", "[[mid]]", seed=9, rate=100, spm_rate=50), texts())


def test_units_other_than_code_points(spark):
    settings = Settings(unit=r"\S+\s*", rate=100)
    rows = fill_middle.transform(documents(spark, ["one two  three four"] * 30), settings).collect()
    for r in rows:
        assert r.n == 4 and r.prefix_chars + r.middle_chars <= 4
        if r.form == "psm":
            prefix, rest = r.output.removeprefix("<P>").split("<S>")
            assert len(prefix.split()) == r.prefix_chars and len(rest.split("<M>")[1].split()) == r.middle_chars


def test_empty_table(spark):
    assert fill_middle.transform(documents(spark, []).limit(0)).collect() == []


@pytest.mark.parametrize("bad", [("aba", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("ab", "bc", "<M>"), ("", "<S>", "<M>"), ("$1", "<S>", "<M>"), ("xaby", "ab", "<M>")])
def test_markers_that_could_be_confused_are_refused(bad):
    with pytest.raises(ValueError):
        Settings(*bad)


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = fill_middle.transform(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
