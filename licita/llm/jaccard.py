"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct word n-grams, as 64-bit hashes (that two of
them collide in a corpus of a billion n-grams has a chance of a few percent,
and would have to turn a verified count).  Documents with equal sets are one
class.  Over the classes:

1. each set is ordered rare first: by the number of classes that hold an n-gram,
   counted exactly over the whole corpus in Spark.  Only n-grams of a part of
   the vocabulary, chosen by hash and ``SPREAD`` times as large as a prefix, are
   counted; the others come behind them, by hash (any order that all sets share
   is a right one).  By it two sets at least as alike as the threshold share one
   of their first ``n - ceil(t n) + 1`` n-grams;
2. classes meet at the n-grams of their prefixes.  In the first round each is
   paired only with the least class of the n-gram: a star, not all pairs;
3. pairs pass the length filter, the positional filter (what the two sets can
   still share beyond this n-gram) and the suffix filter (parities and counts
   by hash range: their differences bound the sets' difference from below), and
   each is verified once on the whole sets;
4. components of the links so far.  Where an n-gram's classes are still in
   several components, a few of the classes are paired with those of other
   components, as long as such rounds join much; then all pairs across components
   are taken, filtered and verified alike.  Pairs within a component need no
   look: they add no connection.

So no link between components is lost, and a group of thousands of near copies
costs a star and not its square.

Defined cases: a null or empty text, or one without words, has an empty set
and links with nothing (component: its own doc_id); fewer than n words make one
n-gram of the whole sequence; repeated rows share a class; a null doc_id is
carried, and is a component's id only if all of its doc_ids are null; an empty
table gives an empty result.  Columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import delete_path, free_shuffles, materialise, scratch_path
from .graph import connected_components, extended

#: the counted part of the vocabulary, as a multiple of a prefix
SPREAD = 3
SUFFIX_PARTS = 16
WANTED_BITS = 20
#: an n-gram of so many classes is crowded; rounds before all pairs across components are
#: taken, classes asked in each, and classes outside the largest component that need none
CROWD, MAX_TURNS, LEADERS, OUTSIDERS = 256, 6, 6, 64
#: pairs of a component that are verified before all
NEAREST = 4
PARITY_BITS = 512
POST = ["own_key", "own_size", "own_at", *[f"own_odd{i}" for i in range(PARITY_BITS // 64)]]
OWN = [*POST, "own_home"]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the text's n-grams: A-Z lower-cased,
    words cut at ASCII white space, the n words' hashes mixed by place."""
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = (out ^ h[i:len(words) - n + 1 + i]) * _MIX
        out ^= out >> np.uint64(29)
    out = out * _MIX2
    return np.unique(out ^ (out >> np.uint64(32)))


def set_key(ngrams: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(ngrams.tobytes())).astype(np.int64))


def counted(grams: np.ndarray, percent: int) -> np.ndarray:
    """Whether each n-gram belongs to the part of the vocabulary that is counted."""
    return (grams & np.uint64(0xFFFF)).astype(np.int64) * 100 < SPREAD * (100 - percent) << 16


def prefix_length(size: int, percent: int) -> int:
    """So many of a set's first n-grams are enough to meet every set alike enough."""
    return size - -(-percent * size // 100) + 1


def signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row: doc_id, text_hash, key (of its set; null when empty), size, ranked
    (its counted n-grams), late (as many of the others, by hash, as a prefix may
    need besides), parts (counts of the whole set by hash range) and odd (a bit
    for each of 512 other ranges: whether its count is odd)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                grams = ngram_set(text, n)
                size = len(grams)
                if not size:
                    rows.append((doc_id, text_hash, None, 0, None, None, None, None))
                    continue
                ours = counted(grams, percent)
                late = grams[~ours][:max(0, prefix_length(size, percent) - int(ours.sum()))]
                parts = np.bincount((grams >> np.uint64(60)).astype(np.int64), minlength=SUFFIX_PARTS)
                odd = np.bincount((grams >> np.uint64(40)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
                rows.append((doc_id, text_hash, set_key(grams), size, grams[ours].astype(np.int64), late.astype(np.int64),
                             parts.astype(np.int32), np.packbits(odd.astype(np.uint8)).view(np.int64)))
            frame = pd.DataFrame(rows, columns=["doc_id", "text_hash", "key", "size", "ranked", "late", "parts", "odd"])
            frame["doc_id"] = pd.array(frame["doc_id"], dtype="Int64")
            frame["key"] = pd.array(frame["key"], dtype="Int64")
            yield frame
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(
        sign, "doc_id long, text_hash long, key long, size long, ranked array<long>, late array<long>, "
              "parts array<int>, odd array<long>")


def prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(gram, key, size, at): the n-grams that a class has in its prefix, with
    their place in its order, of those that two classes have.

    ``classes``: key, size, ranked, late.  N-grams of one class meet nothing, so
    they are only counted: they fill a set's first places and go no further.  The
    others are placed from the end of the counted ones, the most frequent last.
    """
    posts = (classes.select(F.explode("ranked").alias("gram"), "key", F.lit(-1).alias("late_at"))
             .unionByName(classes.select(F.posexplode("late").alias("late_at", "gram"), "key")))
    # counted and written first: the shuffle of the count is freed before that of the join is made
    often = materialise(posts.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "jaccard-often")
    free_shuffles(classes.sparkSession)
    own = classes.select("key", "size", F.size("ranked").alias("n_ranked"))
    back = Window.partitionBy("key").orderBy(F.col("late_at"), F.desc("often"), F.desc("gram"))
    place = F.when(F.col("late_at") < 0, F.col("n_ranked") - F.row_number().over(back)).otherwise(
        F.col("n_ranked") + F.col("late_at"))
    return (posts.join(often, "gram").join(own, "key").withColumn("at", place)
            .filter(F.expr(f"at < size - ({percent} * size + 99) div 100 + 1"))
            .select("gram", "key", "size", "at"))


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least intersection of two sets of these sizes that are alike enough."""
    return F.ceil((a + b) * percent / (100 + percent))


def _apart(left: str, right: str) -> Column:
    """Number of ranges in which the parities of two sets differ."""
    return reduce(add, [F.bit_count(F.col(f"{left}_odd{i}").bitwiseXOR(F.col(f"{right}_odd{i}")))
                        for i in range(PARITY_BITS // 64)])


def _may_link(left: str, right: str, percent: int) -> Column:
    """Length, positional and suffix filter for two prefix rows that share an
    n-gram.  Every range whose parity differs holds an n-gram that one set lacks."""
    a, b = F.col(f"{left}_size"), F.col(f"{right}_size")
    rest = F.least(a - F.col(f"{left}_at"), b - F.col(f"{right}_at"))
    apart = _apart(left, right)
    return ((F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (rest >= _needed(a, b, percent))
            & (apart <= a + b - 2 * _needed(a, b, percent)))


def _meet(own: DataFrame, other: DataFrame, tried: DataFrame, percent: int, when: Column | None = None,
          closely: bool = False) -> DataFrame:
    """Pairs (a, b) of classes that share an n-gram, pass the filters on their
    prefixes and have not been tried; ``closely``: with their components (h, k)
    and the number of ranges in which they differ (apart)."""
    both = own.join(other, "gram").filter((F.col("own_key") != F.col("o_key")) & _may_link("own", "o", percent))
    if when is not None:
        both = both.filter(when)
    pair = [F.least("own_key", "o_key").alias("a"), F.greatest("own_key", "o_key").alias("b")]
    if closely:
        pair += [F.least("own_home", "o_home").alias("h"), F.greatest("own_home", "o_home").alias("k"),
                 _apart("own", "o").alias("apart")]
    return both.select(*pair).distinct().join(tried, ["a", "b"], "left_anti")


def _open(shared: DataFrame, home: DataFrame) -> DataFrame:
    """The rows of ``shared`` whose n-gram is in classes of several components,
    with their component (own_home), the largest there (main), its number of
    classes (n_main) and that of all."""
    own = (shared.join(home.withColumnRenamed("node", "own_key"), "own_key", "left")
           .withColumn("own_home", F.coalesce("component", "own_key")).drop("component"))
    per_home = own.groupBy("gram", "own_home").agg(F.count(F.lit(1)).alias("n"))
    most = (per_home.groupBy("gram").agg(
        F.max(F.struct("n", "own_home")).alias("m"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("homes"))
        .filter("homes > 1").select("gram", F.col("m.own_home").alias("main"), F.col("m.n").alias("n_main"), "all"))
    return materialise(own.join(most, "gram"), "jaccard-open")


def _wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of the documents in ``wanted`` (key, first_id).

    A broadcast of the hash buckets that are wanted (2^20 of them at most)
    spares the texts of other documents the shuffle; the join then decides.
    """
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << WANTED_BITS)).cast("int")
    buckets = wanted.select(bucket("first_id").alias("__bucket")).distinct()
    near = (docs.select("doc_id", "text").withColumn("__bucket", bucket("doc_id"))
            .join(F.broadcast(buckets), "__bucket", "left_semi"))
    return near.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("key", "text")


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are alike enough.

    The suffix filter runs on 16 counts a class; only the sets of classes in
    pairs that are left are made again from their texts.
    """
    meta = classes.select("key", "size", "parts")
    both = (pairs.join(meta.select(F.col("key").alias("a"), F.col("size").alias("a_size"), F.col("parts").alias("a_parts")), "a")
            .join(meta.select(F.col("key").alias("b"), F.col("size").alias("b_size"), F.col("parts").alias("b_parts")), "b"))
    apart = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    size = F.col("a_size") + F.col("b_size")
    left = materialise(both.filter(apart <= size - 2 * _needed(F.col("a_size"), F.col("b_size"), percent))
                       .select("a", "b"), "jaccard-pairs")
    wanted = materialise(
        left.select(F.col("a").alias("key")).unionByName(left.select(F.col("b").alias("key"))).distinct()
        .join(classes.select("key", F.col("doc_id").alias("first_id")), "key"), "jaccard-wanted")

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = set()  # repeated rows of a document: once a task
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"]):
                if key not in made:
                    grams = ngram_set(text, n)
                    if len(grams) and set_key(grams) == key:  # a doc_id may name other texts too
                        rows.append((key, grams.astype(np.int64)))
                        made.add(key)
            yield pd.DataFrame(rows, columns=["key", "grams"])
        pa.default_memory_pool().release_unused()

    path = scratch_path(docs.sparkSession, "jaccard-sets")
    (_wanted_texts(docs, wanted).mapInPandas(rebuild, "key long, grams array<long>").write.parquet(path))
    sets = docs.sparkSession.read.parquet(path)
    common = F.size(F.array_intersect("x", "y"))
    links = materialise(
        left.join(sets.select(F.col("key").alias("a"), F.col("grams").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("grams").alias("y")), "b")
        .select("a", "b", common.alias("common"), (F.size("x") + F.size("y") - common).alias("together"))
        .filter(F.col("common") * 100 >= F.col("together") * percent).select("a", "b").distinct(), "jaccard-links")
    delete_path(docs.sparkSession, path)
    return links


def _linked(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (doc_id, text_hash, key, size) and the classes (key,
    doc_id, class_size, home: the name of its component)."""
    spark = docs.sparkSession
    whole = scratch_path(spark, "jaccard-signed")
    signatures(docs, n, percent).write.parquet(whole)
    signed = spark.read.parquet(whole)
    rows = materialise(signed.select("doc_id", "text_hash", "key", "size"), "jaccard-rows")
    # rows of a class agree in all but the doc_id
    posted = scratch_path(spark, "jaccard-classes")
    (signed.filter("key is not null").groupBy("key")
     .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("class_size"),
          *[F.first(c).alias(c) for c in ("size", "ranked", "late", "parts", "odd")]).write.parquet(posted))
    delete_path(spark, whole)  # all that follows reads the classes
    free_shuffles(spark)
    classes = spark.read.parquet(posted)
    first = materialise(prefixes(classes, percent), "jaccard-prefixes")
    free_shuffles(spark)
    common = first.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    odd = classes.select(F.col("key").alias("own_key"), *[F.col("odd")[i].alias(f"own_odd{i}")
                                                          for i in range(PARITY_BITS // 64)])
    shared = materialise(first.join(common, "gram").select(
        "gram", F.col("key").alias("own_key"), F.col("size").alias("own_size"), F.col("at").alias("own_at"))
        .join(odd, "own_key").select("gram", *POST), "jaccard-shared")
    classes = materialise(classes.drop("ranked", "late", "odd"), "jaccard-meta")
    delete_path(spark, posted)
    free_shuffles(spark)
    heads = shared.groupBy("gram").agg(F.min(F.struct("own_size", "own_key", *POST[2:])).alias("head")).select(
        "gram", *[F.col(f"head.{c}").alias(c.replace("own_", "o_")) for c in POST])
    star = materialise(_meet(shared, heads, spark.createDataFrame([], "a long, b long"), percent), "jaccard-star")
    free_shuffles(spark)
    links = _verify(docs, classes, star, n, percent)
    free_shuffles(spark)
    home = connected_components(links.toDF("u", "v"))

    # n-grams whose classes are not all in one component yet.  In crowded ones a few of the
    # classes, by hash, meet all in other components, as long as that joins many; then
    # every pair across components is taken, one end of which is outside the largest
    open_, tried, before = _open(shared, home), star, None
    crowded = open_.filter(F.col("all") >= CROWD)
    for turn in range(MAX_TURNS):
        rows_here, outside = crowded.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("all") - F.col("n_main")), F.lit(0))).first()
        if outside <= OUTSIDERS * rows_here or (before is not None and outside > 0.8 * before):
            break
        before = outside
        order = [F.min(F.struct(F.xxhash64("own_key", F.lit(turn), F.lit(k)).alias("order"),
                                *[F.col(c).alias(c.replace("own_", "o_")) for c in OWN])).alias(f"l{k}")
                 for k in range(LEADERS)]
        leaders = (crowded.groupBy("gram").agg(*order)
                   .select("gram", F.explode(F.array(*[f"l{k}" for k in range(LEADERS)])).alias("l"))
                   .select("gram", *[F.col("l." + c.replace("own_", "o_")) for c in OWN]))
        pairs = materialise(_meet(crowded.select("gram", *OWN), leaders, tried, percent,
                                  F.col("own_home") != F.col("o_home")), "jaccard-turn")
        home = extended(home, _verify(docs, classes, pairs, n, percent).toDF("u", "v"))
        tried = materialise(tried.unionByName(pairs), "jaccard-tried")
        crowded = _open(crowded.select("gram", *POST), home)
    if before is not None:
        open_ = _open(open_.select("gram", *POST), home)
    few = open_.filter("own_home != main").select("gram", *OWN)
    other = open_.select("gram", *[F.col(c).alias(c.replace("own_", "o_")) for c in OWN])
    across = materialise(_meet(few, other, tried, percent, F.col("own_home") != F.col("o_home"), True), "jaccard-across")
    # a component's pairs that look closest go first: mostly they link, and join so much
    # that few of the others are left to look at
    ends = across.select(F.col("h").alias("end"), "a", "b", "apart").unionByName(
        across.select(F.col("k").alias("end"), "a", "b", "apart"))
    closest = Window.partitionBy("end").orderBy("apart", "a", "b")
    nearest = ends.withColumn("nth", F.row_number().over(closest)).filter(F.col("nth") <= NEAREST).select("a", "b").distinct()
    nearest = materialise(nearest, "jaccard-nearest")
    home = extended(home, _verify(docs, classes, nearest, n, percent).toDF("u", "v"))
    left = across.join(nearest, ["a", "b"], "left_anti").select("a", "b")
    for c in ("a", "b"):
        left = (left.join(home.toDF(c, f"{c}_new"), c, "left").withColumn(f"{c}_new", F.coalesce(f"{c}_new", c)))
    left = materialise(left.filter("a_new != b_new").select("a", "b"), "jaccard-left")
    home = extended(home, _verify(docs, classes, left, n, percent).toDF("u", "v"))
    return rows, classes.join(home.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc_id", "class_size", F.coalesce("component", "key").alias("home"))


def join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the
    least doc_id that links reach, itself included) and class_size (rows with
    the same set).  Sets link when 100 x common >= percent x together."""
    rows, grouped = _linked(docs, n, percent)
    least = grouped.groupBy("home").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(least, "home").select("key", "class_size", "component_id")
    return (rows.select("doc_id", F.col("size").alias("n_shingles"), "key").join(named, "key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("class_size", F.lit(1)).alias("class_size")))


def keep_first(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id (null
    last), and of its texts that of the least hash; of rows equal in both any
    one.  Rows without words all stay."""
    rows, grouped = _linked(docs, n, percent)
    one = (rows.join(grouped.select("key", "home"), "key").groupBy("home")
           .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one"))
           .select(F.col("one.doc_id").alias("__kept"), F.col("one.text_hash").alias("__kept_text")))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = (docs.filter(words).withColumn("__text", F.xxhash64("text"))
            .join(one, F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.col("__text") == F.col("__kept_text")), "left_semi"))
    return (kept.dropDuplicates(["doc_id", "__text"]).select(*docs.columns)
            .unionByName(docs.filter(~words)))
