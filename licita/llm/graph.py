"""Connected components by alternating large and small stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its least neighbour (or itself) to its larger
    neighbours (large star), or to its smaller ones and itself (small star).

    The least neighbour is an aggregate that combines before the shuffle, and
    the join back can be split by AQE, so a node with many edges is no hot task.
    """
    if large:
        pairs = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v: longs); the component
    is its least node.

    Each round is written to the shared folder, so a lost executor costs one
    round.  It ends when a round leaves the edges as they were: then every
    edge joins a node to the least of its component.
    """
    state = materialise(edges.filter("u is not null and v is not null and u != v")
                        .select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "cc")

    def mark(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = mark(state)
    for _ in range(max_rounds):
        if not last[0]:
            break
        state = materialise(_star(_star(state, True), False), "cc")
        now = mark(state)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components not found within {max_rounds} rounds")
    labelled = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return labelled.unionByName(roots)


def extended(home: DataFrame, links: DataFrame) -> DataFrame:
    """``home`` (node, component) after ``links`` (u, v) are added: the search runs
    on the names of the components that links join, not on all links again."""
    ends = links.select("u", "v")
    for c in ("u", "v"):
        ends = (ends.join(home.toDF(c, "__name"), c, "left").withColumn("__end", F.coalesce("__name", c))
                .drop(c, "__name").withColumnRenamed("__end", c))
    joined = connected_components(ends)
    named = joined.toDF("component", "__name")
    known = (home.join(named, "component", "left")
             .select("node", F.coalesce("__name", "component").alias("component")))
    return materialise(known.unionByName(joined.join(home.select("node"), "node", "left_anti")), "cc-home")
