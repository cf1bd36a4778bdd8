import hashlib
import string

from helpers import documents, rows_by_id

from tablewise.llm import exact_dedup
from tablewise.llm.common import shared_path

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(digest(t), []).append(i)
    return {(i, digest(t)): (max(groups[digest(t)]), len(groups[digest(t)])) for i, t in rows}


def test_batch_against_brute_force(spark):
    texts = ["Hello", "hELLO", None, "", "É", "é", "x" * 200_000, "X" * 200_000, "solo"]
    rows = list(enumerate(texts))
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), buckets=4)
    got = rows_by_id(exact_dedup.dedup_batch(documents(spark, texts), index))
    want = brute(rows)
    for i, t in rows:
        keep, size = want[(i, digest(t))]
        assert (got[i].digest, got[i].keep_id, got[i].group_size, got[i].kept) == (digest(t), keep, size, i == keep)


def test_index_persists_between_batches(spark):
    path = shared_path(spark, "test-digests")
    one = exact_dedup.dedup_batch(documents(spark, ["a", "b"], [1, 2]), exact_dedup.DigestIndex(spark, path, 4))
    assert sorted(r.doc_id for r in one.filter("kept").collect()) == [1, 2]
    two = exact_dedup.dedup_batch(documents(spark, ["A", "c", "c"], [7, 8, 9]), exact_dedup.DigestIndex(spark, path, 4))
    got = rows_by_id(two)
    assert not got[7].kept and got[7].keep_id == 1
    assert (got[8].kept, got[9].kept, got[8].keep_id) == (False, True, 9)
    assert exact_dedup.DigestIndex(spark, path, 4).rows().count() == 3


def test_a_batch_sent_again(spark):
    path = shared_path(spark, "test-digests")
    docs = documents(spark, ["a", "b", "B"], [1, 2, 3])
    index = exact_dedup.DigestIndex(spark, path, 4)

    def kept(batch=None, frame=docs):
        return sorted(r.doc_id for r in exact_dedup.dedup_batch(frame, index, batch=batch).filter("kept").collect())

    assert kept("monday") == [1, 3]
    assert kept("monday") == [1, 3]  # the same batch retried: the same answers
    assert kept("tuesday") == kept() == []  # the same rows as a new batch: nothing is new
    # a batch that had stored a part of its rows before it failed
    index.append(exact_dedup.digest_groups(exact_dedup.digests(documents(spark, ["c"], [7]))), "wednesday")
    assert kept("wednesday", documents(spark, ["C", "d", "a"], [7, 8, 9])) == [7, 8]
    assert index.rows().count() == 4


def test_compaction_keeps_the_rows(spark):
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), 4)
    for i in range(3):
        exact_dedup.dedup_batch(documents(spark, [f"t{j}" for j in range(i * 5, i * 5 + 8)], range(i * 10, i * 10 + 8)), index, batch=f"b{i}")
    less = index.compacted(shared_path(spark, "test-digests"), bucket_rows=9)
    assert less.buckets == 2 and sorted(less.rows().collect()) == sorted(index.rows().collect())
    assert len(less.rows().inputFiles()) <= 2 < len(index.rows().inputFiles())
    assert exact_dedup.dedup_batch(documents(spark, ["T3", "new"], [90, 91]), less).filter("kept").first().doc_id == 91


def test_anti_join_is_sort_merge(spark):
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), 4)
    plan = index.new_only(exact_dedup.digest_groups(exact_dedup.digests(documents(spark, ["a"]))))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_repeated_rows_and_null_ids(spark):
    docs = documents(spark, ["a", "a", "a", "b", None], [5, 5, None, None, None])
    out = exact_dedup.dedup_batch(docs, exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), 4)).collect()
    assert len(out) == 5
    by = {}
    for r in out:
        by.setdefault(r.digest, []).append(r)
    assert [sum(r.kept for r in by[digest(t)]) for t in ("a", "b", "")] == [1, 1, 1]
    assert {r.keep_id for r in by[digest("a")]} == {5}
    kept = exact_dedup.keep_first(docs, exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), 4))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.text or "") for r in kept.collect()) == [(False, "a"), (True, ""), (True, "b")]


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "test-digests"), 4)
    assert exact_dedup.dedup_batch(docs, index).count() == 0 and index.rows().count() == 0
