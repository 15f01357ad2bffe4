"""Packing by minimum bin slack.

Every document's ids are cut into whole windows, each a sequence of its own,
and a remainder.  The remainders are known by their lengths alone: a histogram
of at most ``window - 1`` counts, whatever the corpus.  Minimum bin slack fills
a window from that multiset: the longest remaining length is put in, and a
bitset subset-sum dynamic program over the other lengths finds the fill
closest to capacity; walking back through the saved bitsets gives how many of
each length it uses.  One such pattern is repeated as often as the counts
allow, so the driver solves for patterns, not for windows.  Spark then numbers
the remainders of each length and reads off window and offset.

Defined cases: a null or empty text is its end id alone; repeated rows are
packed one by one; an empty table gives an empty result.  Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise

WINDOW = 2048
END_ID = 1
#: words whose ids a worker keeps; beyond it the older half goes
CACHE_WORDS = 200_000
#: characters of text that a worker cuts into words at a time
CHUNK_CHARS = 4_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

_PUNCTUATION = ".,!?;:%&$#*\"()"
#: white space to Python alone, and what opens a special token: such texts go to the tokenizer whole
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


class WordIds:
    """Ids of whole texts by the vocabulary file, with a bounded cache of words.

    White space ends a token here, so a text's ids are its words' ids in turn;
    only words not seen yet reach the tokenizer, many at a time, and its answer
    is cut into words again at the ids that end one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # small Latin letters alone need no normalising and no pattern to cut them
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.end = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.end[i] = piece.endswith("</w>")
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _encode(self, text: str, tokenizer=None) -> bytes:
        ids = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Letters-only words go to the tokenizer in one string and are cut
        apart at the ids that end a word; the rest go alone."""
        plain, letters, cache = [], [], self.new
        for w in words:
            if not w.isalpha():
                cache[w] = self._encode(w)
            elif w == w.lower() and max(w) < "\u0180":
                plain.append(w)
            else:
                letters.append(w)
        for group, tokenizer in ((plain, self.plain), (letters, self.tokenizer)):
            raw = self._encode(" ".join(group), tokenizer)
            ends = 4 * (np.flatnonzero(self.end[np.frombuffer(raw, dtype="<u4")]) + 1)
            if len(ends) != len(group):  # a letter that the vocabulary's pattern takes otherwise
                cache.update((w, self._encode(w)) for w in group)
                continue
            at = 0
            for w, to in zip(group, ends.tolist()):
                cache[w] = raw[at:to]
                at = to

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, from the cache or learned now."""
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {"": b""}
        cache, old = self.new, self.old
        fresh = []
        for w in words:
            if w not in cache:
                if w in old:
                    cache[w] = old[w]
                else:
                    fresh.append((w, w.rstrip(_PUNCTUATION)))
        parts = {core for _, core in fresh} | {w[len(core):] for w, core in fresh}
        self._learn([p for p in parts if p not in cache])
        for w, core in fresh:
            if w not in cache:
                whole = core and core[-1].isalnum()  # then what follows starts a new token
                cache[w] = cache[core] + cache[w[len(core):]] if whole else self._encode(w)
        return [cache[w] for w in words]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text.  Arrow cuts the texts and numbers
        their distinct words; only those are looked up one by one."""
        odd = [any(x in t for x in _ODD) for t in texts]
        cut_up = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.large_string())))
        numbered = cut_up.flatten().dictionary_encode()
        ids = self._ids_of(numbered.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(ids), dtype="<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(length) - length
        at = numbered.indices.to_numpy()
        n = length[at]
        before = np.concatenate([[0], np.cumsum(n)])
        flat = pool[np.repeat(start[at] - before[:-1], n) + np.arange(before[-1])].tobytes()
        edges = (4 * before[cut_up.offsets.to_numpy() - cut_up.offsets[0].as_py()]).tolist()
        return [self._encode(t) if o else flat[a:b] for t, o, a, b in zip(texts, odd, edges, edges[1:])]


_loaded: dict[str, WordIds] = {}


def _tokenizer(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def cut(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: whole windows of a document's ids, then its remainder."""
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _tokenizer(vocabulary)
        tail = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            # about as many characters at a time, whatever the length of a text
            upto = np.cumsum([len(t) for t in texts]) // CHUNK_CHARS
            for i in np.unique(upto):
                some, out = np.flatnonzero(upto == i), []
                for row, ids in zip(some, encode([texts[k] for k in some])):
                    ids += tail
                    n = len(ids) // 4
                    for s in range(0, n, window):
                        out.append((batch["doc_id"].iat[row], s, min(window, n - s),
                                    zlib.crc32(ids[4 * s:4 * (s + window)]), n))
                frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                frame["doc_id"] = pd.array(frame["doc_id"], dtype="Int64")
                yield frame
        encode.old = {}  # a worker may go on to other work
        pa.default_memory_pool().release_unused()
    return docs.select("doc_id", "text").mapInPandas(pieces, PIECES)


def fill(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack over a multiset of lengths: (pattern, times) until
    nothing is left.

    The longest length opens a window.  ``reach`` is a bitset of the sums that
    the other lengths can make; a length of count c is added in binary parts
    (1, 2, 4, ...), and the bitset before each part is kept, so walking back
    from the largest sum tells how many of each length were used.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        first = max(left)
        room = window - first
        mask = (1 << (room + 1)) - 1
        reach, kept = 1, []
        for n in sorted(left, reverse=True):
            spare = min(left[n] - (n == first), room // n)
            part = 1
            while spare > 0:
                k = min(part, spare)
                kept.append((n, k, reach))
                reach |= (reach << (n * k)) & mask
                spare, part = spare - k, part * 2
            if reach >> room & 1:
                break
        at = reach.bit_length() - 1
        pattern = {first: 1}
        for n, k, before in reversed(kept):
            if not before >> at & 1:
                pattern[n] = pattern.get(n, 0) + k
                at -= n * k
        times = min(left[n] // k for n, k in pattern.items())
        out.append((pattern, times))
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset.

    The histogram and the pattern table are bounded by the window (at most
    ``window - 1`` lengths, each pattern uses one of them up), so both may go
    through the driver; the pieces never do.
    """
    spark = docs.sparkSession
    pieces = materialise(cut(docs, vocabulary, window, end_id), "pack-pieces")
    counts = {r.length: r.n for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # numbers within a length: its pieces are dealt into about sqrt(count) cells,
    # numbered there and shifted by the counts of the cells before
    dealt = spark.createDataFrame([(n, math.isqrt(c) + 1) for n, c in counts.items()] or [(0, 1)],
                                  "length long, cells long")
    pieces = (pieces.join(F.broadcast(dealt), "length")
              .withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), "cells")))
    sums = pieces.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32")
    bins, used, at = [], {}, 0
    if counts.get(window):  # whole windows: nothing to choose
        bins.append((window, 0, counts[window], 0, 1, 0))
        at = counts.pop(window)
    for pattern, times in fill(counts, window):
        offset = 0
        for n, k in pattern.items():
            u = used.get(n, 0)
            bins.append((n, u, u + k * times, at, k, offset))
            used[n] = u + k * times
            offset += n * k
        at += times
    table = spark.createDataFrame(
        bins or [(0, 0, 0, 0, 1, 0)],
        "length long, rank_from long, rank_to long, first_sequence long, per_sequence long, first_offset long")
    ranked = (pieces.withColumn("nth", F.row_number().over(order) - 1)
              .join(sums, ["length", "cell"])
              .withColumn("rank", F.col("base") + F.col("nth")))
    into = ((ranked["length"] == table["length"]) & (F.col("rank") >= F.col("rank_from"))
            & (F.col("rank") < F.col("rank_to")))
    nth = F.col("rank") - F.col("rank_from")
    return (ranked.join(F.broadcast(table), into)
            .select("doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
                    (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
                    (F.col("first_offset") + F.pmod(nth, F.col("per_sequence")) * ranked["length"])
                    .alias("offset")))
