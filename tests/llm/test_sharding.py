import hashlib
import zlib
from collections import Counter

from helpers import documents, rows_by_id
from pyspark.sql import functions as F

from tablewise.llm import sharding


def brute(rows, shards, seed):
    """rows: (id, text, source). Ranks by a sort of each source, then one sort of all."""
    by = {}
    for i, t, s in rows:
        key = "null" if i is None else f"={i}"
        raw = (t or "").encode()
        by.setdefault("null" if s is None else "=" + s, []).append((hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), i, zlib.crc32(raw), len(raw) + 1))
    placed = []
    for s, group in by.items():
        for k, row in enumerate(sorted(group), 1):
            placed.append(((k - 0.5) / len(group), s, k, row))
    placed.sort()
    n, slots, out = len(placed), Counter(), {}
    for pos, (_, _, _, (_, i, crc, size)) in enumerate(placed):
        shard = pos * shards // n
        out[i] = (shard, slots[shard], crc, size)
        slots[shard] += 1
    return out


def test_against_brute_force(spark):
    texts = [None if i % 11 == 0 else "é" * (i % 5) + f"text {i // 3}" for i in range(203)]
    sources = ["hot" if i % 3 == 0 else None if i % 10 == 1 else f"s{i % 4}" for i in range(203)]
    docs = documents(spark, texts, sources=sources)
    got = rows_by_id(sharding.shard_rows(docs, shards=8, cell_rows=10))
    want = brute([(i, t, s) for i, (t, s) in enumerate(zip(texts, sources, strict=True))], 8, 17)
    assert {i: (r.shard, r.slot, r.text_crc32, r.size) for i, r in got.items()} == want
    counts = Counter(r.shard for r in got.values())
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(8):
        assert sorted(r.slot for r in got.values() if r.shard == shard) == list(range(counts[shard]))
        for source, n in Counter(sources).items():  # mixture: within one row of the proportional share, per cut
            mine = sum(r.shard == shard and r.source == source for r in got.values())
            assert abs(mine - n / 8) <= 2


def test_same_at_other_partitions_and_cells(spark):
    docs = documents(spark, [f"t{i}" for i in range(90)])
    one = {i: (r.shard, r.slot) for i, r in rows_by_id(sharding.shard_rows(docs, 5, cell_rows=7)).items()}
    two = {i: (r.shard, r.slot) for i, r in rows_by_id(sharding.shard_rows(docs.repartition(9, F.rand(3)), 5)).items()}
    assert one == two


def test_repeated_rows_fewer_rows_than_shards_and_empty(spark):
    docs = documents(spark, ["a", "a", None], [1, 1, None], ["x", "x", None])
    out = sharding.shard_rows(docs, 8).collect()
    assert len(out) == 3 and len({(r.shard, r.slot) for r in out}) == 3
    empty = sharding.shard_rows(docs.limit(0), 8)
    assert empty.count() == 0 and "slot" in empty.columns


def test_very_long_text_and_columns_named_like_results(spark):
    docs = documents(spark, ["é" * 2_000_000, "b", None]).withColumn("slot", F.lit("x")).withColumn("shard", F.lit(9.5)).withColumn("size", F.lit(None).cast("int"))
    docs = docs.withColumn("_h", F.lit("h")).withColumn("_cell", F.lit(1)).withColumn("fraction", F.lit(True))
    got = rows_by_id(sharding.shard_rows(docs, 2))
    assert {i: (r.size, r.text_crc32) for i, r in got.items()} == {
        0: (4_000_001, zlib.crc32(("é" * 2_000_000).encode())), 1: (2, zlib.crc32(b"b")), 2: (1, 0)
    }
    assert sorted((r.shard, r.slot) for r in got.values()) == [(0, 0), (0, 1), (1, 0)]
