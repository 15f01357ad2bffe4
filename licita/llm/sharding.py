"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Groups larger than an eighth of a
shard, of which there are less than 8 x shards, are given their shards first,
the largest first: a group goes whole to the fullest shard that has room for
all of it.  Only a group that fits nowhere whole, such as one larger than a
shard, is cut, and into as few parts as the room allows: it fills the emptiest
shards and its rest goes on as before.  The driver plans with the sizes of
these groups; their rows are numbered in cells, so no task holds a group.

The other linked documents start in the shard their hash names, of those with
room; then, in rounds of Spark joins, the documents of a group move to the
shard where most of their neighbours are, as far as the room left allows, so
that few links are cut.  The state is counts by (group, first shard), not
documents, so a round moves little.  At the end every shard holds the floor
or the ceiling of rows / shards: documents beyond a quota, and then documents
without links, fill what is left, by numbers.

Defined cases: a null text counts as empty; rows with a null or repeated
doc_id are placed one by one; an empty table gives an empty result.  Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise

SHARDS = 24
ROUNDS = 6
#: hash buckets by which a full shard decides whom to admit
ADMIT_BUCKETS = 256


def numbered(rows: DataFrame, group: str, count: int, order: list[str], name: str) -> DataFrame:
    """``rows`` with a gapless number from 0 within ``group`` (a column of few
    values, such as the shard).

    About sqrt(count) cells by hash are numbered each on its own and shifted
    by the counts of the cells before, so that no task holds a whole group.
    """
    cells = math.isqrt(count) + 1
    dealt = rows.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    sums = dealt.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy(group, "__cell").orderBy(*order)
    return (dealt.withColumn("__nth", F.row_number().over(within) - 1)
            .join(sums, [group, "__cell"])
            .withColumn(name, (F.col("__base") + F.col("__nth")).cast("long"))
            .drop("__cell", "__nth", "__base"))


def propagate(cells: DataFrame, quota: dict[int, int], rounds: int = ROUNDS) -> DataFrame:
    """Balanced label propagation over ``cells`` (part, first, n): the linked
    documents of a part that started in shard ``first``.

    Returns part, first, shard.  In each round a part looks for the shard with
    room in which most of it is (ties: the lower shard) and its other cells ask
    to move there.  A shard admits all that ask, or, when its room is short,
    the hash buckets of them that fit, those of the largest parts (by powers of
    two) first.  Room, demand and buckets are sums of at most shards x 256
    numbers a power on the driver.
    """
    spark = cells.sparkSession
    state = cells.withColumn("shard", F.col("first"))
    for turn in range(rounds):
        load = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [(s, max(0, q - load.get(s, 0))) for s, q in quota.items()]
        with_room = spark.createDataFrame([r for r in room if r[1]] or [(-1, 0)], "shard int, room long")
        held = (state.groupBy("part", "shard").agg(F.sum("n").alias("held"))
                .join(F.broadcast(with_room), "shard", "left"))
        # a part may stay where it is even if that shard is full
        best = held.groupBy("part").agg(
            F.sum("held").alias("whole"),
            F.max(F.struct("held", (-F.col("shard")).alias("minus"), F.col("room").isNotNull().alias("open"))).alias("most"),
            F.max(F.when(F.col("room").isNotNull(), F.struct("held", (-F.col("shard")).alias("minus")))).alias("open"))
        best = (best.withColumn("goal", -F.coalesce(F.col("open.minus"), F.col("most.minus")))
                .select("part", "goal", F.floor(F.log2("whole")).alias("power")))
        asked = (state.join(best, "part")
                 .withColumn("asks", F.col("goal") != F.col("shard"))
                 .withColumn("bucket", F.pmod(F.xxhash64("part", F.lit(turn)), F.lit(ADMIT_BUCKETS))
                             - F.col("power") * ADMIT_BUCKETS))
        demand = (asked.filter("asks").groupBy("goal", "bucket").agg(F.sum("n").alias("n")).collect())
        if not demand:
            break
        free, fits = dict(room), []
        for r in sorted(demand, key=lambda r: (r.goal, r.bucket)):
            if r.n <= free[r.goal]:
                free[r.goal] -= r.n
                fits.append((r.goal, r.bucket))
        if not fits:
            break
        admitted = spark.createDataFrame(fits, "goal int, bucket long").withColumn("yes", F.lit(True))
        state = materialise(
            asked.join(F.broadcast(admitted), ["goal", "bucket"], "left")
            .select("part", "first", "n",
                    F.when(F.col("asks") & F.coalesce("yes", F.lit(False)), F.col("goal"))
                    .otherwise(F.col("shard")).alias("shard")), "shard-state")
    return state.select("part", "first", "shard")


def place(sizes: list[int], room: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Pieces (group, from, to, shard) of groups of these sizes, largest first;
    takes what they need from ``room``."""
    pieces = []
    for group, members in enumerate(sizes):
        at = 0
        while at < members:
            fits = [s for s, r in room.items() if r >= members - at]
            shard = min(fits, key=lambda s: (room[s], s)) if fits else max(room, key=lambda s: (room[s], -s))
            taken = min(room[shard], members - at)
            pieces.append((group, at, at + taken, shard))
            room[shard] -= taken
            at += taken
    return pieces


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Per document: doc_id, size (UTF-8 bytes of the text plus 8), text_crc32,
    shard and slot (its place there, gapless from 0).

    The law is ``rows``: counts of two shards differ by one at most.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
        .withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    same = ["text_hash", "text_crc32", "size"]
    columns = ["row", "doc_id", "size", "text_crc32"]
    groups = materialise(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "shard-groups")
    eighth = total // (8 * shards)
    # less than 8 x shards groups: their rows meet them by broadcast
    sizes = groups.filter(F.col("members") > eighth).orderBy(F.desc("members"), *same).collect()
    room = dict(quota)
    pieces = spark.createDataFrame(place([r.members for r in sizes], room), "group int, from long, to long, shard int")
    large = F.broadcast(spark.createDataFrame(
        [(*[r[c] for c in same], i) for i, r in enumerate(sizes)],
        "text_hash long, text_crc32 long, size long, group int"))
    settled = materialise(
        numbered(rows.join(large, same), "group", sizes[0].members if sizes else 1, ["row"], "nth")
        .join(F.broadcast(pieces), "group").filter("nth >= `from` and nth < `to`").select(*columns, "shard"),
        "shard-settled")
    rows = rows.join(large.select(*same), same, "left_anti")

    # the first shard is drawn in proportion to the room that is left
    drawn = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(1, sum(room.values()))))
    first, below = F.lit(None), sum(room.values())
    for s, r in reversed(room.items()):
        below -= r
        first = F.coalesce(first, F.when(drawn >= below, F.lit(s))) if r else first
    linked = materialise(
        rows.join(groups.filter(F.col("members") <= eighth), same)
        .select("row", F.xxhash64(*same).alias("part"), first.cast("int").alias("first")), "shard-linked")
    cells = linked.groupBy("part", "first").agg(F.count(F.lit(1)).alias("n"))
    home = propagate(cells, room, rounds)
    placed = linked.join(home, ["part", "first"]).select("row", F.col("shard").alias("wish"))
    rows = rows.select(*columns).join(placed, "row", "left")

    # linked documents keep their shard up to its room; the others fill the rest
    wished = numbered(rows.filter("wish is not null"), "wish", total // shards, ["row"], "nth")
    rooms = spark.createDataFrame(list(room.items()), "wish int, room long")
    wished = materialise(wished.join(F.broadcast(rooms), "wish")
                         .withColumn("shard", F.when(F.col("nth") < F.col("room"), F.col("wish"))),
                         "shard-wished")
    kept = {r.shard: r.n for r in wished.filter("shard is not null").groupBy("shard")
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    spans, at = [], 0
    for s, r in room.items():
        free = r - kept.get(s, 0)
        spans.append((at, at + free, s))
        at += free
    spans = spark.createDataFrame(spans, "from long, to long, fill int").withColumn("pool", F.lit(0))
    pool = (rows.filter("wish is null").select(*columns)
            .unionByName(wished.filter("shard is null").select(*columns)).withColumn("pool", F.lit(0)))
    filled = (numbered(pool, "pool", total, ["row"], "nth")
              .join(F.broadcast(spans), "pool")
              .filter("nth >= `from` and nth < `to`")
              .select(*columns, F.col("fill").alias("shard")))
    done = settled.unionByName(wished.filter("shard is not null").select(*columns, "shard")).unionByName(filled)
    return (numbered(done, "shard", max(1, total // shards), ["row"], "slot")
            .select("doc_id", "size", "text_crc32", "shard", "slot"))
