"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without regular expressions.  Each code point gets a
class from a table, classes and their right neighbours give a symbol, and an
eight-state transducer over the symbols says where a piece starts.  The
transducer is evaluated as an associative scan: every symbol is a function
from state to state, blocks of symbols are composed side by side, the block
functions are scanned by doubling, and a last pass inside the blocks emits
the boundaries.  Pieces are byte slices; their merges are cached; the byte
offset of every token is returned for alignment and decoding.

The class table is read off the tokenizer library's own ``\\p{L}``, ``\\p{N}``
and ``\\s`` once on the driver and broadcast as run lengths (a few thousand
integers); the ranks (one vocabulary file) are broadcast too.  Both sizes are
fixed by the vocabulary, not by the data.

Defined cases: a null text encodes like the empty text, to no tokens; other
columns never take part; null ids pass through; repeated rows are encoded
each on its own.  A text of any length is one row; rows are taken in groups
of about ``CHUNK_CHARS`` characters, so memory is bounded by the longest text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, releasing, text_or_empty
from .textarrays import word_hashes

CHUNK_CHARS = 400_000
CACHE_PIECES = 150_000
BLOCK = 128
SHORT = 64  # bytes of a piece that is cached and merged by list
NONE = (1 << 31) - 1

# classes of code points
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# states: what the code point before belongs to
FRESH, IN_L, IN_N, IN_O, IN_SP, IN_WS, TAKE_2, TAKE_1 = range(8)
# symbols: class of a code point together with what follows it
S_L, S_N, S_O, S_A2, S_A3, S_SP, S_WLAST, S_WMID, N_SYM = range(9)
IDENTITY = 2 * N_SYM  # padding


def _transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a piece), indexed [state, symbol]; symbols from N_SYM on begin a text."""
    nxt = np.zeros((8, 2 * N_SYM + 1), np.uint8)
    cut = np.ones((8, 2 * N_SYM + 1), bool)
    for state in range(8):
        for sym, into, joins in (
            (S_L, IN_L, {IN_L, IN_SP}),
            (S_N, IN_N, {IN_N, IN_SP}),
            (S_O, IN_O, {IN_O, IN_SP}),
            (S_SP, IN_SP, set()),
            (S_WLAST, FRESH, set()),
            (S_WMID, IN_WS, {IN_WS}),
        ):
            nxt[state, sym], cut[state, sym] = into, state not in joins
        for sym, into in ((S_A2, TAKE_1), (S_A3, TAKE_2)):  # an apostrophe opens a contraction only at a piece's start
            joined = state in (IN_O, IN_SP)
            nxt[state, sym], cut[state, sym] = (IN_O if joined else into), not joined
        if state in (TAKE_2, TAKE_1):  # the letters of a contraction
            nxt[state, S_L], cut[state, S_L] = (TAKE_1 if state == TAKE_2 else FRESH), False
    nxt[:, N_SYM:IDENTITY] = nxt[FRESH, :N_SYM]
    nxt[:, IDENTITY] = np.arange(8)
    cut[:, IDENTITY] = False
    return nxt, cut


NEXT, CUT = _transducer()


def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """Run starts and classes of all code points, as the tokenizer library's patterns see them."""
    import tiktoken

    cps = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, cps.tolist()))
    table = np.zeros(0x110000, np.uint8)
    single = {bytes([i]): i for i in range(256)}
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = enc.decode(enc.encode_ordinary(every))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = cls
    starts = np.flatnonzero(np.diff(table, prepend=255))
    return starts.astype(np.int32), table[starts]


def class_table(starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.repeat(classes, np.diff(np.append(starts, 0x110000)))


def symbols(cp: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbols of concatenated texts; ``first`` marks the first code point of each text."""
    n = len(cp)
    cls = table[cp]
    ends = np.ones(n, bool)
    ends[:-1] = first[1:]
    follows = np.full(n, SPACE, np.uint8)  # the end of a text behaves like white space
    follows[:-1] = cls[1:]
    follows[ends] = SPACE
    sym = np.array([S_O, S_L, S_N, S_WMID], np.uint8)[cls]
    last = (cls == SPACE) & (follows != SPACE)
    sym[last] = S_WLAST
    sym[last & (cp == 0x20)] = S_SP
    quotes = np.flatnonzero(cp == 0x27)
    if len(quotes):
        begins = np.flatnonzero(first)
        stop = np.append(begins, n)[np.searchsorted(begins, quotes, side="right")]
        one = np.where(quotes + 1 < stop, cp[np.minimum(quotes + 1, n - 1)], 0)
        two = np.where(quotes + 2 < stop, cp[np.minimum(quotes + 2, n - 1)], 0)
        # 're 've 'll before the single letters cannot clash: no single letter begins one of the pairs
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        sym[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = S_A2
        sym[quotes[pair]] = S_A3
    sym[first] += N_SYM
    return sym


_WIDE = 32  # symbols per state in the packed table; eight states fill a byte
_STEP_TO = np.zeros(256, np.uint8)
_CUT_AT = np.zeros(256, bool)
for _s in range(8):
    _STEP_TO[_s * _WIDE : _s * _WIDE + NEXT.shape[1]] = NEXT[_s] * _WIDE
    _CUT_AT[_s * _WIDE : _s * _WIDE + NEXT.shape[1]] = CUT[_s]


def piece_starts(sym: np.ndarray) -> np.ndarray:
    """Positions where a piece starts, by a blocked associative scan of transition functions.

    A function is eight bytes: for each state, the next state times ``_WIDE``."""
    n = len(sym)
    if n == 0:
        return np.zeros(0, np.int64)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, IDENTITY, np.uint8)
    padded[:n] = sym
    cols = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    # 1. compose the functions of each block, all blocks side by side
    fn = np.repeat(np.arange(8, dtype=np.uint8) * _WIDE, rows).reshape(8, rows)
    for c in cols:
        fn = _STEP_TO[fn + c]
    # 2. inclusive scan over blocks by doubling: later after earlier
    step = 1
    while step < rows:
        fn[:, step:] = np.take_along_axis(fn[:, step:], (fn[:, :-step] // _WIDE).astype(np.int64), axis=0)
        step *= 2
    # 3. emit inside the blocks from each block's entry state
    state = np.zeros(rows, np.uint8)
    state[1:] = fn[FRESH, :-1]
    marks = np.empty((BLOCK, rows), bool)
    for i, c in enumerate(cols):
        at = state + c
        marks[i] = _CUT_AT[at]
        state = _STEP_TO[at]
    return np.flatnonzero(marks.T.ravel()[:n])


class PairTable:
    """Id of two neighbouring tokens merged, for arrays of pairs: an open-addressing hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, ids = [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ids.append(i)
        self.bits = max(4, (4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.key = np.full(size + 64, -1, np.int64)
        self.id = np.full(size + 64, NONE, np.int32)
        key, value = np.array(keys, np.int64), np.array(ids, np.int32)
        slot = self._slot(key)
        while len(key):  # place the first of those that want a slot, move the others on
            free = self.key[slot] < 0
            _, at = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            at = at[free[at]]
            self.key[slot[at]], self.id[slot[at]] = key[at], value[at]
            rest = np.ones(len(key), bool)
            rest[at] = False
            key, value, slot = key[rest], value[rest], slot[rest] + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids of the merged pairs, ``NONE`` where there is no such token."""
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        there = self.key[slot]
        out = self.id[slot]
        ask = np.flatnonzero((there != key) & (there >= 0))
        out[there < 0] = NONE
        step = 0
        while len(ask):
            step += 1
            at = slot[ask] + step
            there = self.key[at]
            out[ask] = np.where(there == key[ask], self.id[at], NONE)
            ask = ask[(there != key[ask]) & (there >= 0)]
        return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], table: np.ndarray, cache_pieces: int = CACHE_PIECES):
        self.ranks, self.table, self.cache_pieces = ranks, table, cache_pieces
        self.cache: dict[bytes, tuple[int, ...]] = {}
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        tokens = sorted((i, b) for b, i in ranks.items())
        size = tokens[-1][0] + 1
        self.bytes_of: list[bytes] = [b""] * size
        for i, b in tokens:
            self.bytes_of[i] = b
        self.length = np.fromiter(map(len, self.bytes_of), np.int64, size)
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    @cached_property
    def pairs(self) -> PairTable:
        return PairTable(self.ranks)  # decoding never needs it

    def pair(self, a: int, b: int) -> int:
        return self.ranks.get(self.bytes_of[a] + self.bytes_of[b], NONE)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece: merge the pair of lowest rank, leftmost first, until none is left.

        Short pieces of similar length advance together, one merge each a round."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            got = self.ranks.get(piece)
            if got is not None:
                out[i] = (got,)
            elif len(piece) > SHORT:
                out[i] = self._merge_long(piece)
            else:
                by_width.setdefault(max(8, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in by_width.items():
            for i, ids in zip(members, self._merge_rows([pieces[i] for i in members], width), strict=True):
                out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_id[raw]
        final, length = ids.copy(), size.copy()
        col = np.arange(width)
        ranks = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        ranks[col[:-1] >= (size - 1)[:, None]] = NONE
        live = np.arange(len(pieces))
        while True:
            at = ranks.argmin(axis=1)
            row = np.arange(len(live))
            low = ranks[row, at]
            stop = low == NONE
            if stop.any():
                final[live[stop]], length[live[stop]] = ids[stop], size[stop]
                go = ~stop
                live, ids, ranks, size, at, low = live[go], ids[go], ranks[go], size[go], at[go], low[go]
                row = np.arange(len(live))
            if not len(live):
                break
            moved = np.minimum(col + (col > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, moved, 1)
            ids[row, at] = low
            shift = np.minimum(col[:-1] + (col[:-1] >= at[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, shift, 1)
            size = size - 1
            ranks[row, np.maximum(size - 1, 0)] = NONE  # the row is one pair shorter
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.pairs.get(ids[has, at[has] - 1], low[has])
            has = np.flatnonzero(at + 1 < size)
            ranks[has, at[has]] = self.pairs.get(low[has], ids[has, at[has] + 1])
        return [tuple(r[:n]) for r, n in zip(final.tolist(), length.tolist(), strict=True)]

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap, for long pieces."""
        n, pair = len(piece), self.pair
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        stop = list(range(1, n + 1))  # where the token that begins here ends; 0 when merged away
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(ids[i], ids[i + 1])) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, end = heapq.heappop(heap)
            j = stop[i]
            if not j or j >= n or stop[j] != end:
                continue  # one of the two has changed since
            ids[i], stop[i], stop[j] = r, end, 0
            if end < n:
                left[end] = i
                if (x := pair(r, ids[end])) != NONE:
                    heapq.heappush(heap, (x, i, stop[end]))
            if (h := left[i]) >= 0 and (x := pair(ids[h], r)) != NONE:
                heapq.heappush(heap, (x, h, end))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = stop[i]
        return tuple(out)

    def _distinct(self, raw: bytes, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first piece of each distinct one, which distinct one each piece is).

        Two independent 64-bit hashes and the length decide; a piece that agrees with
        its group in the first hash alone becomes a group of its own."""
        data = np.frombuffer(raw, np.uint8)
        one, two = word_hashes(data, cuts[:-1], cuts[1:]), word_hashes(data ^ np.uint8(0x5A), cuts[:-1], cuts[1:])
        _, first, which = np.unique(one, return_index=True, return_inverse=True)
        odd = np.flatnonzero((two != two[first[which]]) | (np.diff(cuts) != np.diff(cuts)[first[which]]))
        which[odd] = len(first) + np.arange(len(odd))
        return np.append(first, odd), which

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, byte offset of each token in its text, tokens per text)."""
        joined = "".join(texts)
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begin = np.concatenate([[0], np.cumsum(chars)])
        first = np.zeros(len(cp), bool)
        first[begin[:-1][chars > 0]] = True
        starts = piece_starts(symbols(cp, first, self.table))
        width = (1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(width)])
        raw = joined.encode("utf-8")
        cuts = np.append(at[starts], len(raw))
        if not len(starts):
            z = np.zeros(0, np.int64)
            return z.astype(np.int32), z, np.zeros(len(texts), np.int64)
        lead, which = self._distinct(raw, cuts)
        cache = self.cache
        if len(cache) > self.cache_pieces:
            cache.clear()
        pieces = [raw[a:b] for a, b in zip(cuts[lead].tolist(), cuts[lead + 1].tolist(), strict=True)]
        out = list(map(cache.get, pieces))
        miss = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(miss, self.merge([pieces[i] for i in miss]), strict=True):
            out[i] = ids
            if len(pieces[i]) <= SHORT:
                cache[pieces[i]] = ids
        # lay the ids of the distinct pieces out for every piece
        size = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int32, int(size.sum()))
        ids = flat[_ranges((np.cumsum(size) - size)[which], size[which])]
        before = np.concatenate([[0], np.cumsum(size[which])])  # tokens before each piece
        token_begin = before[np.searchsorted(starts, begin)]
        per_text = np.diff(token_begin)
        offsets = np.cumsum(self.length[ids]) - self.length[ids]
        offsets -= np.repeat(at[begin[:-1]], per_text)
        return ids, offsets, per_text

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[_ranges(self.begin[ids], self.length[ids])].tobytes()


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices begin, begin + 1, ... (size of them) of all ranges end to end."""
    total = int(size.sum())
    stop = np.cumsum(size)
    return np.arange(total) + np.repeat(begin - stop + size, size)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 token and rank per line (read on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_CODECS: dict[int, tuple[object, Codec]] = {}


def broadcast_vocabulary(spark: SparkSession, path: str):
    bounded_batches(spark)
    return spark.sparkContext.broadcast((read_ranks(path), class_runs()))


def _codec(shared) -> Codec:
    """One codec per Python worker and broadcast; the entry holds the broadcast, so its id stays taken."""
    if id(shared) not in _CODECS:
        _CODECS.clear()
        ranks, runs = shared.value
        _CODECS[id(shared)] = (shared, Codec(ranks, class_table(*runs)))
    return _CODECS[id(shared)][1]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK_CHARS:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def encode(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids array<int>, offsets array<int>): tokens and their byte offsets in the text."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType(
        [src.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                ids, offsets, per_text = codec.encode(texts[a:b])
                bounds = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())),
                        pa.ListArray.from_arrays(bounds, pa.array(offsets.astype(np.int32))),
                    ],
                    names=["doc_id", "ids", "offsets"],
                )
        codec.cache.clear()  # idle workers keep no pieces

    return src.mapInArrow(releasing(run), schema)


def _arrays(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of a list column as arrays, null as empty."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.asarray(lists.value_lengths().fill_null(0))
    stop = np.cumsum(size)
    for a, b in zip(stop - size, stop, strict=True):
        yield flat[a:b]


def decode(encoded: DataFrame, vocabulary) -> DataFrame:
    """Add ``decoded`` (binary) to rows with ``ids``; null ids decode to no bytes."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [codec.decode(x) for x in _arrays(part.column(at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(releasing(run), schema)
