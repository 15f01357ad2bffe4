"""Reconciliation of two tables by digests of key ranges (DQ-8, J-12, DQ-12).

A table's keys are dealt into ranges by the leading bits of their hash.  The digest
of a range is its number of rows and the sum and the exclusive or of its rows'
hashes: one aggregate that combines before the shuffle, of at most 2^bits rows
whatever the table.  Equal tables agree by their digests alone; where ranges
differ, finer digests are taken of those ranges only, and rows are joined only
in the finest ranges that differ.  Digests can be written beside a table, so that
it need not be read again to be compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Where a key was found.
ONLY_LEFT, ONLY_RIGHT, DIFFERENT = "SOLO_ORIGEN", "SOLO_DESTINO", "DISTINTO"
#: leading bits of the key's hash at each level
LEVELS = (8, 16)


def key_range(keys: Sequence[str], bits: int) -> Column:
    """The range of a key: the leading bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _row(columns: Sequence[str]) -> Column:
    # a NULL is passed over by the hash: say where it stood
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def digest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = LEVELS[0]) -> DataFrame:
    """RANGO, FILAS, SUMA and O_EXCLUSIVO of every range of keys that has rows."""
    row = _row(columns)
    return df.groupBy(key_range(keys, bits).alias("RANGO")).agg(
        F.count(F.lit(1)).alias("FILAS"), F.sum(row.cast("decimal(38,0)")).alias("SUMA"), F.bit_xor(row).alias("O_EXCLUSIVO"))


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """RANGO of the ranges whose two digests are not the same."""
    parts = ["FILAS", "SUMA", "O_EXCLUSIVO"]
    l, r = (d.select("RANGO", F.struct(*parts).alias(n)) for d, n in ((left, "l"), (right, "r")))
    return l.join(r, "RANGO", "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select("RANGO")


def _within(df: DataFrame, keys: Sequence[str], bits: int, ranges: DataFrame) -> DataFrame:
    """The rows in these ranges, of which there are at most 2^bits."""
    return df.withColumn("_rango", key_range(keys, bits)).join(
        F.broadcast(ranges.withColumnRenamed("RANGO", "_rango")), "_rango", "left_semi").drop("_rango")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
              levels: Sequence[int] = LEVELS) -> DataFrame:
    """The keys whose rows are not the same on both sides, and which way (ESTADO).

    A key may have several rows: they are compared as a bag, by number and hashes.
    """
    keys = list(keys)
    columns = list(columns or left.columns)
    if max(levels) > 16:
        raise ValueError("at most 2^16 ranges are handed to the tasks")
    for bits in levels:
        ranges = materialise(differing_ranges(digest(left, keys, columns, bits), digest(right, keys, columns, bits)), "digest-ranges")
        if not ranges.limit(1).count():
            return left.select(*keys).limit(0).withColumn("ESTADO", F.lit(DIFFERENT))
        left, right = (_within(df, keys, bits, ranges) for df in (left, right))
    row = _row(columns)
    bag = [F.count(F.lit(1)).alias("_n"), F.sum(row.cast("decimal(38,0)")).alias("_s"), F.bit_xor(row).alias("_x")]
    l = left.groupBy(*keys).agg(*bag).select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.struct("_n", "_s", "_x").alias("_l"))
    r = right.groupBy(*keys).agg(*bag).select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.struct("_n", "_s", "_x").alias("_r"))
    on = [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    state = F.when(F.col("_r").isNull(), ONLY_LEFT).when(F.col("_l").isNull(), ONLY_RIGHT).otherwise(DIFFERENT)
    return (l.join(r, on, "full_outer").filter(~F.col("_l").eqNullSafe(F.col("_r")))
            .select(*[F.when(F.col("_l").isNull(), F.col(f"_r_{k}")).otherwise(F.col(f"_l_{k}")).alias(k) for k in keys],
                    state.alias("ESTADO")))
