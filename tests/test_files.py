import hashlib
import os
import random
import resource
import tempfile

import pytest

from tablewise.sources import files


def tree(data, leaf, node):
    leaves = [hashlib.sha256(data[i : i + leaf]).hexdigest() for i in range(0, len(data), leaf)]
    nodes = [hashlib.sha256("".join(leaves[i : i + node]).encode()).hexdigest() for i in range(0, len(leaves), node)]
    return len(leaves), hashlib.sha256("".join(nodes).encode()).hexdigest()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tw-files-", dir="/tmp")


@pytest.mark.parametrize("leaf, node, step", [(7, 3, 21), (64, 4, 64), (1000, 2, 10), (1 << 20, 4096, 64 << 20)])
def test_tree_hash_equals_a_sequential_one(spark, folder, leaf, node, step):
    rng, want = random.Random(leaf), {}
    for i, size in enumerate((1, 6, 7, 8, 21, 640, 5000, 1 << 21)):
        if size > 5000 and leaf < 1000:
            continue
        data = rng.randbytes(size)
        name = f"file {i} é%.bin"
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
        want[size] = tree(data, leaf, node)
    got = {r["size_bytes"]: (r["leaves"], r["tree_sha256"]) for r in files.tree_fingerprint(spark, folder, leaf, node, step).collect()}
    assert got == want


def test_one_byte_and_the_order_of_chunks_matter(spark, folder):
    seen = set()
    for data in (b"aaaabbbb", b"bbbbaaaa", b"aaaabbbc", b"aaaabbbbb"):
        with open(os.path.join(folder, "f"), "wb") as fh:
            fh.write(data)
        seen.add(files.tree_fingerprint(spark, folder, 4, 2).first()["tree_sha256"])
    assert len(seen) == 4


def test_a_file_beyond_two_gigabytes_in_bounded_memory(spark, folder):
    size = (5 << 30) + 3
    with open(os.path.join(folder, "large"), "wb") as fh:
        fh.truncate(size)  # a sparse file takes no room
    r = files.tree_fingerprint(spark, folder).first()
    zero = hashlib.sha256(bytes(1 << 20)).hexdigest()
    leaves = [zero] * 5120 + [hashlib.sha256(bytes(3)).hexdigest()]
    nodes = [hashlib.sha256("".join(leaves[i : i + 4096]).encode()).hexdigest() for i in (0, 4096)]
    assert (r["size_bytes"], r["leaves"], r["tree_sha256"]) == (size, 5121, hashlib.sha256("".join(nodes).encode()).hexdigest())
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss < 8 << 20  # kilobytes


@pytest.mark.parametrize("part", [1, 64, 700, 1 << 20])
def test_file_hashes_by_parts_equal_whole_ones(spark, folder, part, monkeypatch):
    rng, want = random.Random(part), {}
    for i, size in enumerate((0, 1, 2, 5) if part == 1 else (1, 63, 64, 65, 700, 701, 3000)):
        data = rng.randbytes(size)
        with open(os.path.join(folder, f"file {i} é%.bin"), "wb") as fh:
            fh.write(data)
        want[f"file {i} é%.bin"] = (size, hashlib.sha256(data).hexdigest())
    got = files.file_fingerprint(spark, folder, part)
    assert got.columns == ["name", "size_bytes", "modified", "sha256"]
    rows = {r["name"]: (r["size_bytes"], r["sha256"]) for r in got.collect()}
    assert sorted(v for v in rows.values() if v[0]) == sorted(v for v in want.values() if v[0])


def test_hash_of_a_file_beyond_two_gigabytes(spark, folder):
    size, plain = (2 << 30) + 5, hashlib.sha256()
    with open(os.path.join(folder, "large"), "wb") as fh:
        fh.truncate(size)  # a sparse file takes no room
    for _ in range(2048):
        plain.update(bytes(1 << 20))
    plain.update(bytes(5))
    r = files.file_fingerprint(spark, folder).first()
    assert (r["name"], r["size_bytes"], r["sha256"]) == ("large", size, plain.hexdigest())
