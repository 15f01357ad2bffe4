"""Phrase collocations by dynamic itemset counting.

Phrases of one to MAX_WORDS words are counted per language, exactly, by
cyclic scans of the corpus in which all lengths are counted at once:

1. one pass over the texts lower-cases A-Z, cuts pieces and words, and writes
   them as packed rows of word numbers with their own small vocabulary, dealt into
   ``shards``;
2. each step scans one shard, in turn and over again.  A word is active from the
   first step.  A longer phrase becomes active with the step after both its
   subphrases (without the last and without the first word) have reached the
   least count in what has been scanned so far, is counted for one full cycle of the
   shards, and is then complete;
3. after each step its counts are added to those so far, which are kept dealt by phrase and
   not exchanged again, and its shuffle files freed; complete phrases below the least count
   are forgotten.  The scans end when a full cycle has activated nothing;
4. until then a phrase is 128 bits of hash; a last scan spells those that were found.

Which phrases have reached the count, and when, is told to the tasks by a table
of bytes indexed by the phrase's hash (the first step at which a phrase of this
hash was known).  It is sized by the corpus and never larger than MAX_CELLS (64 MB).
Two phrases in one cell can only activate a phrase too early: it is
then counted for a full cycle all the same, so counts are exact whatever the
table's size.

A phrase's occurrences lie within occurrences of its parts, so every phrase with the
least count is found, and all parts of a candidate have counts.  Scores are whole
numbers of up to 38 digits.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated
rows count each; an empty table gives an empty result.  Columns other than
``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import delete_path, free_shuffles, materialise, materialise_dealt, scratch_path

MAX_WORDS = 5
LEAST = 100
TOP = 2000
SHARDS = 4
#: words that a task numbers together (a longer document makes a longer row)
CHUNK_WORDS = 250_000
MAX_CELLS = 1 << 26
NEVER = 255  # steps are at most MAX_WORDS * shards

#: fixed values of the contract: what ends a piece
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_PIECE_ENDS + b"\t", b"\n" * len(_PIECE_ENDS) + b" ")
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

CHUNKS = "lang string, shard int, n long, words binary, hashes binary, ids binary"
#: a phrase goes by 96 bits of hash over its language and words (k1, k2)
COUNTS = "k1 long, k2 int, size int, start int, n long"
TEXTS = "k1 long, k2 int, lang string, phrase string"
#: words that a scanning task adds up before it hands its counts on, about and not more
TASK_WORDS = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    """The text's words in turn with b"\\n" between pieces."""
    flat = (text or "").encode("utf-8", "replace").lower().translate(_TABLE)
    return [w for w in flat.replace(b"\n", b" \n ").split(b" ") if w]


class _Numbers:
    """Words of one language by number, and the texts so far in numbers."""

    def __init__(self) -> None:
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[b"\n"]  # 0 ends a piece
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        words.append(b"\n")
        self.texts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, lang: str, shard: int) -> pa.RecordBatch:
        ids, words = np.concatenate(self.texts), list(self.number)
        return pa.RecordBatch.from_pydict({
            "lang": [lang], "shard": pa.array([shard], pa.int32()), "n": [int((ids != 0).sum())],
            "words": pa.array([b" ".join(words)], pa.binary()),
            "hashes": pa.array([_hashes(lang, words).tobytes()], pa.binary()), "ids": pa.array([_planes(ids)], pa.binary())})


def _planes(ids: np.ndarray) -> bytes:
    """First bytes of all numbers, then the second and so on: high ones are mostly 0
    and compress to nothing."""
    return ids.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(packed) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


def encode(docs: DataFrame, shards: int, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Rows of word numbers: lang, shard, n (words), words (by number), hashes
    (128 bits each) and ids, the last three packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        turn = TaskContext.get().partitionId()
        held: dict[str, _Numbers] = defaultdict(_Numbers)
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                if not words:
                    continue
                held[lang].add(words)
                size += len(words)
                # of many languages, all are written out before they fill the worker
                for full in [lang] if held[lang].size >= chunk_words else [*held] if size >= 4 * chunk_words else []:
                    turn += 1
                    size -= held[full].size
                    yield held.pop(full).row(full, turn % shards)
        for lang, numbers in held.items():
            turn += 1
            yield numbers.row(lang, turn % shards)
        pa.default_memory_pool().release_unused()

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, CHUNKS)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Two columns of 64 bits."""
    import xxhash
    seed = xxhash.xxh3_64_intdigest(lang.encode()) & 0xFFFFFFFF
    both = b"".join(xxhash.xxh3_128_digest(w, seed=seed) for w in words)
    return np.frombuffer(both, dtype="<u8").reshape(-1, 2)


def _longer(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last and that of the last."""
    out = first * _MIX
    out ^= out >> np.uint64(32)  # before the last word comes in: order counts
    out = (out + last) * _MIX2
    return out ^ (out >> np.uint64(29))


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(31))) & np.uint64(cells - 1)).astype(np.int64)


def cell_of(k1: Column, cells: int) -> Column:
    """The same in Spark."""
    return k1.bitwiseXOR(F.call_function("shiftrightunsigned", k1, F.lit(31))).bitwiseAND(F.lit(cells - 1))


def _distinct(ids: np.ndarray, at: np.ndarray, size: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each different phrase of this size that starts at ``at``: which of
    ``at`` is one of its places, and their number."""
    key, most = ids[at].astype(np.int64), words
    for i in range(1, size):
        if most > (1 << 62) // words:  # number the phrases so far anew
            _, key = np.unique(key, return_inverse=True)
            most = len(at)
        key, most = key * words + ids[at + i], most * words
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return order[starts], np.diff(np.append(starts, len(key)))


def walk(ids: np.ndarray, hashes: np.ndarray, since: np.ndarray, max_words: int = MAX_WORDS):
    """For each size: (size, places of the phrases all whose parts are known, their
    first hash, the step at which the parts were known, and the one at which the phrase
    itself was).  ``hashes`` are the words', by number."""
    known = since[_cells(hashes, len(since))]
    known[0] = NEVER  # no phrase crosses the end of a piece
    at = np.flatnonzero(ids)
    hashed, reached, later = hashes[ids[at]], known[ids[at]], np.zeros(len(at), dtype=np.uint8)
    yield 1, at, hashed, later, reached
    for size in range(2, max_words + 1):
        # one part starts at this place and one at the next
        both = (at[1:] - at[:-1] == 1) & (reached[1:] != NEVER) & (reached[:-1] != NEVER)
        here = np.flatnonzero(both)
        if not len(here):
            return
        later = np.maximum(reached[here], reached[here + 1])
        at, hashed = at[here], _longer(hashed[here], hashes[ids[at[here] + size - 1]])
        own = since[_cells(hashed, len(since))]
        reached = np.where(own == NEVER, own, np.maximum(own, later))
        yield size, at, hashed, later, reached


def active_phrases(ids: np.ndarray, hashes: np.ndarray, since: np.ndarray, step: int, shards: int,
                   max_words: int = MAX_WORDS):
    """(size, places of different phrases, their first hash, counts, first step) of
    the phrases that are active at this step: the ``shards`` after the one at which
    their parts were known."""
    for size, at, hashed, later, _ in walk(ids, hashes, since, max_words):
        now = np.flatnonzero((later < step) & (later >= max(step - shards, 0)))
        if len(now):
            some, counts = _distinct(ids, at[now], size, len(hashes))
            some = now[some]
            yield size, at[some], hashed[some], counts, later[some].astype(np.int64) + 1


def known_phrases(ids: np.ndarray, hashes: np.ndarray, since: np.ndarray, wanted: np.ndarray,
                  max_words: int = MAX_WORDS):
    """(size, places of different phrases, their first hash) of the known phrases in wanted cells."""
    for size, at, hashed, _, reached in walk(ids, hashes, since, max_words):
        now = np.flatnonzero((reached != NEVER) & wanted[_cells(hashed, len(wanted))])
        if len(now):
            some = now[_distinct(ids, at[now], size, len(hashes))[0]]
            yield size, at[some], hashed[some]


def _unpacked(batches: Iterator[pa.RecordBatch]):
    """lang, words (packed), their two hashes and ids of each row."""
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words, hashes, ids = (batch.column(c)[i] for c in ("lang", "words", "hashes", "ids"))
            both = np.frombuffer(hashes.as_buffer(), dtype="<u8").reshape(-1, 2)
            yield (lang.as_py(), words, np.ascontiguousarray(both[:, 0]), both[:, 1],
                   _from_planes(ids.as_buffer()))


def _second(ids: np.ndarray, places: np.ndarray, size: int, second: np.ndarray) -> np.ndarray:
    out = second[ids[places]]
    for k in range(1, size):
        out = _longer(out, second[ids[places + k]])
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _count(table, step: int, shards: int, max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, hashes, second, ids in _unpacked(batches):
            for size, places, first, counts, starts in active_phrases(ids, hashes, table.value, step, shards, max_words):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(_second(ids, places, size, second)),
                     pa.array(np.full(len(places), size, np.int32)), pa.array(starts.astype(np.int32)),
                     pa.array(counts.astype(np.int64))], names=["k1", "k2", "size", "start", "n"])
        pa.default_memory_pool().release_unused()
    return run


def _spell(table, cells, max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(cells.value).view(bool)
        for lang, words, hashes, second, ids in _unpacked(batches):
            words = pa.array(words.as_py().split(b" "), pa.binary()).cast(pa.string())
            for size, places, first in known_phrases(ids, hashes, table.value, wanted, max_words):
                parts = [words.take(pa.array(ids[places + k])) for k in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(_second(ids, places, size, second)),
                     pa.array([lang] * len(places), pa.string()),
                     parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")], names=["k1", "k2", "lang", "phrase"])
        pa.default_memory_pool().release_unused()
    return run


def add_counts(state: DataFrame, counted: DataFrame) -> DataFrame:
    """The counts of a step added to those so far; both have a phrase once.  The
    ``state`` is dealt by phrase, so only ``counted`` is exchanged."""
    new = counted.select("k1", "k2", *[F.col(c).alias(f"_{c}") for c in ("size", "start", "n")])
    return state.join(new, ["k1", "k2"], "full_outer").select(
        "k1", "k2", F.greatest("size", "_size").alias("size"), F.greatest("start", "_start").alias("start"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"), "known")


def frequent_phrases(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS, shards: int = SHARDS,
                     max_cells: int = MAX_CELLS, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, size and n (count) of every phrase of up to
    ``max_words`` words with at least ``least`` occurrences, and lang and n
    (all words)."""
    if not 0 < shards * max_words < NEVER:
        raise ValueError(f"shards * max_words must be below {NEVER}")
    spark = docs.sparkSession
    chunks_path = scratch_path(spark, "phrases-chunks")
    encode(docs, shards, chunk_words).write.option("compression", "zstd").partitionBy("shard").parquet(chunks_path)
    chunks = spark.read.schema(CHUNKS).parquet(chunks_path)
    totals = materialise(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    all_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = 1 << 16
    while cells < max_cells and cells < 8 * all_words // least:
        cells *= 2
    tasks = max(1, -(-all_words // (shards * TASK_WORDS)))

    def scan(shard: int) -> DataFrame:
        return chunks.filter(F.col("shard") == shard).select("lang", "words", "hashes", "ids").coalesce(tasks)

    since = np.full(cells, NEVER, dtype=np.uint8)
    state, state_path, step, last_new = None, None, 0, 0
    while step < shards or step < last_new + shards:
        step += 1
        table = spark.sparkContext.broadcast(since)
        counted = (scan(step % shards).mapInArrow(_count(table, step, shards, max_words), COUNTS)
                   .groupBy("k1", "k2").agg(F.max("size").alias("size"), F.max("start").alias("start"), F.sum("n").alias("n")))
        added = (counted.withColumn("known", F.lit(None).cast("int")) if state is None
                 else add_counts(state, counted))
        added = (added.withColumn("known", F.when(F.col("n") >= least, F.coalesce("known", F.lit(step))))
                 .filter(F.col("known").isNotNull() | (F.col("start") + (shards - 1) > step)))
        path = scratch_path(spark, "phrases-counts")
        added = materialise_dealt(added, ["k1", "k2"], "phrases_counts", path)
        table.unpersist()
        if state_path:
            delete_path(spark, state_path)
        state, state_path = added, path
        del added, counted
        free_shuffles(spark)  # this step's, before the next makes its own
        # two numbers of 32 and 8 bits a cell at most
        new = (state.filter(F.col("known") == step).groupBy(cell_of(F.col("k1"), cells).alias("cell"))
               .agg(F.min("size").alias("size")).toArrow())
        at, size = new["cell"].to_numpy(), new["size"].to_numpy()
        unknown = since[at] == NEVER
        since = since.copy()
        since[at[unknown]] = step
        if (size[unknown] < max_words).any():  # the longest activate nothing
            last_new = step
    # spelled shard by shard: few phrases are left after the first
    table, nameless = spark.sparkContext.broadcast(since), state
    phrases = spark.createDataFrame([], "lang string, phrase string, size int, n long")
    for shard in range(shards):
        left = nameless.select(cell_of(F.col("k1"), cells).alias("cell")).distinct().toArrow()["cell"].to_numpy()
        if not len(left):
            break
        wanted = np.zeros(cells, dtype=bool)
        wanted[left] = True
        wanted = spark.sparkContext.broadcast(np.packbits(wanted))
        texts = scan(shard).mapInArrow(_spell(table, wanted, max_words), TEXTS).distinct()
        named = materialise(nameless.join(texts, ["k1", "k2"], "left")
                            .select("k1", "k2", "lang", "phrase", "size", "n"), "phrases-named")
        del texts
        free_shuffles(spark)
        phrases = phrases.unionByName(named.filter("phrase is not null").select("lang", "phrase", "size", "n"))
        nameless = named.filter("phrase is null").select("k1", "k2", "size", "n")
    delete_path(spark, chunks_path)
    delete_path(spark, state_path)
    return phrases, totals


def score_of(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)) in whole numbers of up to 38 digits."""
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = F.lit(1000).cast("decimal(4,0)") * whole(a, 19) * whole(n, 15)
    return F.call_function("div", whole(above, 38), whole(whole(left, 19) * whole(right, 19), 38))


def collocations(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP,
                 shards: int = SHARDS, **scan) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases
    of two words and more that have at least ``least`` occurrences."""
    phrases, totals = frequent_phrases(docs, least, max_words, shards, **scan)
    counted = phrases.select("lang", "phrase", F.col("n").alias("count"))
    longer = phrases.filter("size > 1")
    words = F.split("phrase", " ", -1)
    # not in a longer candidate as often: one word longer is enough, since counts only fall
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    inner = longer.filter("size > 2").select("lang", F.col("n").alias("a"), F.explode(F.array(
        part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase")).distinct()
    kept = (longer.withColumnRenamed("n", "a")
            .join(inner, ["lang", "phrase", "a"], "left_anti"))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
        part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"))
    scored = (cuts.join(counted.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l")), ["lang", "left"])
              .join(counted.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r")), ["lang", "right"])
              .join(totals, "lang"))
    least_cut = (scored.withColumn("score", score_of(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).groupBy("lang", "phrase", "a", "n")
                 .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
                 .select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
                         F.col("best.score").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (least_cut.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
