"""Substring dedup by repeated-phrase automata.

A window of ``window`` words is removed from a document when the same word
sequence starts in a document with a smaller id.  :mod:`.repeats` finds where
windows can repeat and deals those contexts out by key, so all occurrences of
a window reach one shard.  A shard confirms the recurring phrases (windows of
more than one document), compiles them into an Aho-Corasick automaton and streams
its contexts through the automaton, which locates every occurrence; the
smallest document of each phrase is the one that keeps it.

Defined cases: null text has no words; texts under ``window`` words keep all;
of equal texts the one with the smallest id is judged by the others' texts,
the rest lose all words (if they have a window); rows that repeat id and text
count as one document; a null id is larger than any; very long texts are taken whole; empty tables
give empty results; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import pairwise

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import save
from .textarrays import column_bytes, gram_hashes, mix, word_hashes, word_spans

GRAM = 8
#: words of the contexts that one automaton serves
SHARD_WORDS = 200_000
#: code points that can stand for words; beyond, a word is two of them
ALPHABET = 0xD000


def word_units(window: int, gram: int = GRAM) -> repeats.Units:
    def of(column):
        raw, at = column_bytes(column)
        begins, ends = word_spans(raw, at)
        h = word_hashes(raw, begins, ends)
        offsets = np.searchsorted(begins, at)
        size = ends - begins
        place = np.concatenate([[0], np.cumsum(size + 1)])
        joined = np.full(int(place[-1]), 0x20, np.uint8)
        word = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(word)) - (np.cumsum(size) - size)[word]
        joined[place[word] + within] = raw[begins[word] + within]

        def plain(a: int, b: int) -> bytes:
            return joined[place[a] : place[b] - 1].tobytes() if b > a else b""

        return (lambda a, b: h[a:b]), offsets, plain

    return repeats.Units(window, min(gram, window), of, overlaps_inside=False, plain_is_text=False)


def _symbols(contexts: list[list[bytes]]) -> tuple[list[str], int]:
    """Each context as a string with one symbol per word (``width`` code points each)."""
    ids: dict[bytes, int] = {}
    numbered = [[ids.setdefault(w, len(ids)) for w in c] for c in contexts]
    if len(ids) <= ALPHABET:
        return ["".join(map(chr, [i + 1 for i in c])) for c in numbered], 1
    return ["".join(chr(i // ALPHABET + 1) + chr(i % ALPHABET + 1) for i in c) for c in numbered], 2


def _recurring(strings: list[str], width: int, first_ids: np.ndarray, window: int) -> list[str]:
    """Phrases (windows as strings) that occur in contexts of more than one document."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) // width
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), np.maximum(sizes - window + 1, 0))
    if not len(owner):
        return []
    at = np.concatenate([np.arange(b, b + max(n - window + 1, 0)) for b, n in zip(begin, sizes, strict=True)])
    every = gram_hashes(mix(codes + np.uint64(1)), window * width)[at * width]
    order = np.lexsort((first_ids[owner], every))
    h, who = every[order], first_ids[owner[order]]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(h)) - 1
    several = who[head] != who[last]  # sorted by document inside a hash
    out = set()
    group = np.cumsum(new) - 1
    for i in order[several[group]].tolist():  # every occurrence: equal hashes of different phrases stay apart
        c = int(owner[i])
        p = int(at[i] - begin[c]) * width
        out.add(strings[c][p : p + window * width])
    return list(out)


def _locate(contexts: list[list[bytes]], first_ids: np.ndarray, window: int) -> list[list[dict[str, int]]]:
    strings, width = _symbols(contexts)
    phrases = _recurring(strings, width, first_ids, window)
    if not phrases:
        return [[] for _ in contexts]
    automaton = ahocorasick.Automaton()
    for i, p in enumerate(phrases):
        automaton.add_word(p, i)
    automaton.make_automaton()
    smallest = np.full(len(phrases), repeats.LAST, np.int64)
    found = []
    for s, doc in zip(strings, first_ids.tolist(), strict=True):
        hits = [(end, i) for end, i in automaton.iter(s) if (end + 1) % width == 0]
        ends, which = np.array(hits, np.int64).reshape(-1, 2).T
        np.minimum.at(smallest, which, doc)
        found.append(((ends + 1) // width - window, which))
    out = []
    for (start, which), doc in zip(found, first_ids.tolist(), strict=True):
        begin = np.sort(start[smallest[which] < doc])
        cut = np.flatnonzero(np.diff(begin, prepend=-2, append=1 << 60) != 1)
        out.append([{"start": int(begin[a]), "stop": int(begin[b - 1]) + 1} for a, b in pairwise(cut.tolist())])
    return out


def recurring_windows(keys: np.ndarray, contexts: list[bytes], first_ids: np.ndarray, window: int) -> list[list[dict[str, int]]]:
    """Per context, spans of the window starts that also start in a smaller document; shards are sets of keys."""
    words = [c.split(b" ") for c in contexts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(keys, kind="stable")
    out: list[list[dict[str, int]]] = [[] for _ in contexts]
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = keys[order[1:]] != keys[order[:-1]]
    begin = filled = 0
    for a, b in pairwise(np.flatnonzero(new).tolist()):  # whole keys go into a shard
        filled += int(size[order[a:b]].sum())
        if filled >= SHARD_WORDS or b == len(order):
            pick = order[begin:b]
            for i, spans in zip(pick.tolist(), _locate([words[j] for j in pick.tolist()], first_ids[pick], window), strict=True):
                out[i] = spans
            begin, filled = b, 0
    return out


def remove_phrases(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (spans in words), kept (bytes or null), plain_digest.

    ``kept`` (words joined by a space) is filled where some words go; null means unchanged or gone.
    ``plain_digest`` is the SHA-256 of all words joined by a space.
    """
    units = word_units(window)
    described = save(repeats.describe(docs, units, id_col, text_col), "phrase-described")
    texts = save(repeats.distinct_texts(described), "phrase-texts")
    rows = save(repeats.texts_with_repeats(docs, texts, id_col, text_col), "phrase-rows")
    found = save(repeats.contexts(rows, units), "phrase-contexts")

    def cut(context: bytes) -> list[bytes]:
        words = context.split(b" ")
        return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]

    decided = repeats.decide(
        found, lambda keys, ctx, ids: recurring_windows(keys, ctx, ids, window), cut=cut, repeated=lambda mine, first, runs: first < mine
    )
    decided = save(decided, "phrase-decided")
    pieces = repeats.spans_by_text(found, decided, F.col("first_id") > F.col("context_first"), window)
    cut = save(repeats.cut_texts(rows, pieces, units, b" ".join), "phrase-cut").dropDuplicates(["text_key"])
    firsts = texts.select("digest", "first_id")
    gone = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n_units") >= window)
    judged = F.col("doc_id").eqNullSafe(F.col("first_id"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_units").alias("stop")))
    none = F.lit([]).cast("array<struct<start:long,stop:long>>")
    return (
        described.drop("keys")
        .join(firsts, "digest")
        .join(cut, "text_key", "left")
        .select(
            "doc_id",
            F.col("n_units").alias("n_words"),
            F.when(gone, F.col("n_units")).when(judged, F.coalesce("n_removed", F.lit(0))).otherwise(0).alias("n_removed"),
            F.when(gone, whole).when(judged, F.coalesce("removed", none)).otherwise(none).alias("removed"),
            F.when(judged, F.col("kept")).alias("kept"),
            "plain_digest",
        )
    )
