import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, rows_by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), bpe.class_table(*bpe.class_runs()), cache_pieces=1000)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def check(codec, library, texts):
    ids, offsets, per_text = codec.encode(texts)
    at = 0
    for t, n in zip(texts, per_text.tolist(), strict=True):
        mine = ids[at : at + n].tolist()
        assert mine == library.encode_ordinary(t), repr(t)
        raw = t.encode()
        assert codec.decode(np.array(mine, np.int64)) == raw
        place = offsets[at : at + n].tolist()
        assert place == [0, *np.cumsum([len(codec.bytes_of[i]) for i in mine[:-1]]).tolist()][:n]
        at += n
    assert at == len(ids)


NASTY = ["'s", "'t", "'re", "'ve", "'ll", "'m", "'d", "'", "''", "'x", "'S", " ", "  ", "\n", "\t", " ", "　", "a", "B", "é", "1", "²", "½", "!", "?", "$", "中", "😀", "́", "​", "\x00", "\x85", "lll", "rev"]


def test_awkward_strings(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    check(codec, library, texts + ["", " ", "\n\n", "x" * 3000, " " * 700, "ab" * 900, "'" * 50])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(codec, library, texts):
    check(codec, library, texts)


def test_blocks_of_the_scan_meet_anywhere(codec, library):
    rng = random.Random(2)
    for n in (bpe.BLOCK - 1, bpe.BLOCK, bpe.BLOCK + 1, 5 * bpe.BLOCK + 3):
        check(codec, library, ["".join(rng.choice(NASTY) for _ in range(n))])


def test_frame(spark, library):
    texts = ["Hello there, it's 2024!", None, "", "naïve   café\n", "z" * 50_000, "Hello there, it's 2024!"]
    vocabulary = bpe.broadcast_vocabulary(spark, PATH)
    rows = rows_by_id(bpe.decode(bpe.encode(documents(spark, texts), vocabulary), vocabulary))
    for i, t in enumerate(texts):
        assert rows[i].ids == library.encode_ordinary(t or "")
        assert hashlib.sha256(rows[i].decoded).digest() == hashlib.sha256((t or "").encode()).digest()
        assert len(rows[i].offsets) == len(rows[i].ids)
    assert bpe.encode(documents(spark, ["a"]).limit(0), vocabulary).count() == 0
