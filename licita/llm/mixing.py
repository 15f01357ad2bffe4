"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash of its id.  A source's budget is turned into a hash
threshold: words are summed by source and hash bucket, the running sums find
the bucket in which the budget ends, only that bucket is split again, and so
on until it holds a single hash value.  The documents below the threshold are
then a plain filter: nothing is sorted, and a larger budget always takes a
superset of a smaller one's documents (nested thresholds).

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; documents of size 0 follow the same filter and take 0 words;
rows with the same doc_id have the same hash and are taken or left together;
an empty table gives an empty result.  Input columns other than ``doc_id``,
``text`` and ``source`` are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

HASH_BITS = 60
#: hash bits per refinement: 1,024 buckets a source, whatever the input
LEVEL_BITS = 10
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of other than ASCII white space; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def id_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the id's decimal text (null: empty text)."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def water_fill(sizes: dict, weights: dict, max_repeats: int = MAX_REPEATS) -> dict:
    """Targets that share the whole of ``sizes`` by weight, none above
    ``max_repeats`` times its size: what is cut off is shared again by weight
    among the others until none is above.  Sums stay whole numbers."""
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(max_repeats * sizes[s] for s in capped)
        open_weight = sum(weights[s] for s in sizes if s not in capped)
        over = {s for s in sizes if s not in capped
                and rest * weights[s] > max_repeats * sizes[s] * open_weight}
        if not over:
            break
        capped |= over
    return {s: float(max_repeats * sizes[s]) if s in capped
            else float(rest * weights[s]) / float(open_weight) for s in sizes}


def thresholds(sized: DataFrame, budgets: dict) -> dict:
    """Per source the hash below which documents are taken, for budgets in words.

    ``sized`` has source, size and hash.  Each pass sums words by source and
    bucket (at most 1,024 rows a source) but reads the rows of the boundary
    buckets alone; the last document is taken if that comes closer to the
    budget.  The result is exact to one hash value.
    """
    spark = sized.sparkSession
    open_at = {s: (0, 0) for s, b in budgets.items() if b > 0}  # prefix so far, words below it
    done = {s: 0 for s, b in budgets.items() if b <= 0}
    shift = HASH_BITS
    while open_at:
        bounds = spark.createDataFrame([(s, p) for s, (p, _) in open_at.items()],
                                       "t_source string, prefix long")
        bounds = F.broadcast(bounds)  # a row for each source
        low = shift - LEVEL_BITS
        inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("t_source"))
                            & (F.shiftright("hash", shift) == F.col("prefix")))
        sums = (inside.groupBy("source", F.shiftright("hash", low).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
                .collect())
        by_source: dict = {s: [] for s in open_at}
        for r in sums:
            by_source[r.source].append((r.bucket, r.words, r.lo, r.hi))
        nxt = {}
        for s, rows in by_source.items():
            below, budget = open_at[s][1], budgets[s]
            end = None
            for bucket, words, lo, hi in sorted(rows):
                if below + words <= budget:
                    below += words
                    continue
                if lo == hi:  # a single hash value: in if that comes closer
                    end = hi + 1 if below + words - budget <= budget - below else lo
                else:
                    nxt[s] = (bucket, below)
                break
            else:
                end = (open_at[s][0] + 1) << shift
            if s not in nxt:
                done[s] = end
        open_at, shift = nxt, low
    return done


def source_plan(docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS,
                ) -> tuple[DataFrame, DataFrame]:
    """The sized documents (doc_id, source, size, hash) and one row a source:
    __mix_source, source_size, target, __mix_whole copies of every document,
    one more of those whose hash is under __mix_below.

    The driver holds one row a source and 1,024 sums a source.
    """
    spark = docs.sparkSession
    sized = materialise(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("hash")),
        "mix-sizes")
    found = {r.source: r.size for r in
             sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    order = sorted(s for s in found if s is not None) + [s for s in found if s is None]
    share = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets = water_fill(found, share, max_repeats)
    whole = {s: int(targets[s] // found[s]) if found[s] else 0 for s in found}
    limit = thresholds(sized, {s: targets[s] - whole[s] * found[s] for s in found})
    return sized, spark.createDataFrame(
        [(s, found[s], targets[s], whole[s], limit[s]) for s in order],
        "__mix_source string, source_size long, target double, __mix_whole int, __mix_below long")


def plan_mix(docs: DataFrame, **params) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken."""
    sized, per_source = source_plan(docs, **params)
    copies = F.col("__mix_whole") + F.when(F.col("hash") < F.col("__mix_below"), 1).otherwise(0)
    return (sized.join(F.broadcast(per_source), F.col("source").eqNullSafe(F.col("__mix_source")))
            .select("doc_id", "source", "size", "source_size", "target",
                    copies.cast("int").alias("copies"), (F.col("size") * copies).alias("taken")))


def apply_mix(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0: gone), all its
    columns kept.  One broadcast row a source; the texts are not shuffled."""
    _, per_source = source_plan(docs, **params)
    per_source = per_source.select("__mix_source", "__mix_whole", "__mix_below")
    joined = docs.join(F.broadcast(per_source), docs["source"].eqNullSafe(F.col("__mix_source")))
    copies = F.col("__mix_whole") + F.when(id_hash(docs["doc_id"]) < F.col("__mix_below"), 1).otherwise(0)
    return (joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
            .select(*docs.columns))
