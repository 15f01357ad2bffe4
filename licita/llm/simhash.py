"""SimHash fingerprints and their search, in DataFrame expressions alone.

Every occurrence of a word votes on the 64 bits of a fingerprint, for a bit
that is set in the word's hash and against one that is not, with a weight of
the word's length in characters (15 at most), so that short common words say
little.  A bit of the fingerprint is set if more weight is for it than against.

Votes are summed four bits to a long (16-bit lanes), over at most 2,048 words
at a time: 2,048 x 15 fits a signed lane, whatever the length of the text.

``neighbours`` finds all fingerprints within a Hamming radius r: the 64 bits
are cut into ``blocks`` blocks, and fingerprints that differ in at most r bits
agree in at least ``blocks - r`` of them.  There is one table for each choice
of blocks, keyed by their bits (the permuted block tables); each pair is met
in the first table that has it.

Defined cases: null and empty text have the fingerprint of no votes, all
zeros; equal texts have equal fingerprints; repeated rows are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

BITS = 64
LANES = 16
#: words whose votes share a set of lanes
LANE_WORDS = 2048
MAX_WEIGHT = 15
#: cuts of the ids that the driver holds
MAX_BLOCKS = 20_000
#: bit 0 of each of the four 16-bit lanes of a long
LANE_MASK = 0x0001_0001_0001_0001


def vote(text_frame: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fingerprint`` (long) of the text of every row; the keys
    must tell the rows apart."""
    words = F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+")
    one = (text_frame.select(*keys, F.posexplode(words).alias("__at", "__word"))
           .withColumn("__w", F.least(F.length("__word"), F.lit(MAX_WEIGHT)).cast("long"))
           .withColumn("__h", F.xxhash64("__word"))
           .withColumn("__part", F.floor(F.col("__at") / LANE_WORDS)))
    lanes = [F.sum(F.col("__w") * F.shiftrightunsigned("__h", k).bitwiseAND(F.lit(LANE_MASK))).alias(f"__l{k}")
             for k in range(LANES)]
    parts = one.groupBy(*keys, "__part").agg(F.sum("__w").alias("__all"), *lanes)

    def lane(k: int, j: int) -> Column:
        return F.shiftrightunsigned(f"__l{k}", 16 * j).bitwiseAND(F.lit(0xFFFF))

    bits = [F.sum(lane(k, j)).alias(f"__b{k + 16 * j}") for j in range(4) for k in range(LANES)]
    sums = parts.groupBy(*keys).agg(F.sum("__all").alias("__all"), *bits)
    fingerprint = F.lit(0).cast("long")
    for b in range(BITS):
        fingerprint = fingerprint.bitwiseOR(
            F.when(2 * F.col(f"__b{b}") > F.col("__all"), F.shiftleft(F.lit(1).cast("long"), b))
            .otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fingerprint.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits in which two fingerprints agree."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def shown(fingerprint: Column) -> Column:
    """16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def neighbours(prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """All pairs (a, b, distance) of different values of ``fingerprint`` at most
    ``radius`` bits apart, a < b as signed numbers; equal ones are one value.

    With 5 blocks and radius 3 there are 10 tables keyed by about 25 bits.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("blocks must be more than the radius")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    signed = [sum(m) - (1 << 64) * (sum(m) >> 63) for m in
              (tuple(masks[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius))]
    values = prints.filter("fingerprint is not null").select("fingerprint").distinct()
    tables = values.select("fingerprint", F.posexplode(F.array(*[
        F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed])).alias("table", "key"))
    a = tables.select(F.col("fingerprint").alias("a"), "table", "key")
    b = tables.select(F.col("fingerprint").alias("b"), "table", "key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(len(signed))
    for i, m in reversed(list(enumerate(signed))):
        first = F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)).otherwise(first)
    return (a.join(b, ["table", "key"])
            .filter((F.col("a") < F.col("b")) & (F.bit_count(differ) <= radius) & (F.col("table") == first))
            .select("a", "b", F.bit_count(differ).alias("distance")))


def blocks_of_ids(docs: DataFrame, blocks: int) -> Column:
    """Column expression: the block of consecutive ids a row's doc_id falls in.

    The cuts are quantiles of doc_id over all rows: ``blocks`` numbers on the
    driver, found again per row in two steps of about sqrt(blocks) comparisons.
    """
    found = docs.approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.5 / blocks) \
        if blocks > 1 else []
    cuts = sorted({int(x) for x in found})
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    id_ = F.col("doc_id")
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    upto = F.size(F.filter(heads, lambda x: x <= id_))
    tables = F.array(*[F.array(*[F.lit(c).cast("long") for c in g]) for g in groups])
    return F.when(id_.isNull() | (upto == 0), F.lit(0)).otherwise(
        (upto - 1) * step + F.size(F.filter(F.element_at(tables, F.greatest(upto, F.lit(1))), lambda x: x <= id_)))


def with_next(docs: DataFrame, rows_per_block: int = 128) -> DataFrame:
    """doc_id, text and next_text: the text of the next row by doc_id (nulls
    first, ties by text); the last row's next is the first.  Also block and nth, which
    together name the row.

    Rows are dealt by block of ids, one shuffle of the texts; only the first
    text of each block crosses into the block before.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = base.count()
    blocks = max(1, min(total // rows_per_block, MAX_BLOCKS))
    at = F.coalesce("doc_id", F.lit(-(1 << 63)))  # nulls first
    base = base.withColumn("block", blocks_of_ids(base, blocks)).withColumn("at", at)
    order = Window.partitionBy("block").orderBy("at", "text")
    rows = (base.withColumn("nth", F.row_number().over(order))
            .withColumn("following", F.lead("text").over(order)))
    # a row a block: the block after it (the first after the last) and that one's first text
    ring = Window.orderBy("block")
    starts = base.groupBy("block").agg(F.min("at").alias("at"))
    ends = starts.select("at", F.coalesce(F.lag("block").over(ring),
                                          F.max("block").over(Window.partitionBy())).alias("before"))
    heads = (base.select("at", "text").join(F.broadcast(ends), "at")
             .groupBy("before").agg(F.min("text").alias("head_text")))
    return (rows.join(heads, rows["block"] == heads["before"], "left")
            .select("doc_id", "text", "block", "nth",
                    F.coalesce("following", "head_text").alias("next_text")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint and next_fingerprint (longs).

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many (or all) of the next row's text.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn("edited", F.concat(
        F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"),
        F.substring("next_text", F.lit(1), half)))
    both = rows.select(
        "block", "nth", "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                          F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("v"))
    both = both.select("block", "nth", "doc_id", "n_chars", "edited_sha256", "v.kind", "v.t")
    keys = ["block", "nth", "doc_id", "n_chars", "edited_sha256"]
    voted = vote(both, [*keys, "kind"], "t")
    pairs = materialise(voted.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint")),
        "simhash")
    order = Window.partitionBy("block").orderBy("nth")
    heads = pairs.filter("nth = 1").select("block", F.col("fingerprint").alias("head"))
    ring = Window.orderBy("block")
    heads = F.broadcast(heads.select(  # a row a block
        "block", F.coalesce(F.lead("head").over(ring), F.min_by("head", "block").over(Window.partitionBy())).alias("head")))
    return (pairs.withColumn("following", F.lead("fingerprint").over(order))
            .join(heads, "block")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    F.coalesce("following", "head").alias("next_fingerprint")))
