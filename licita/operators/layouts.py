"""F-10: one date layout per file and column, found by a vote.

``03/04/2024`` reads two ways.  A column of one file was written by one program,
so the values that only one layout can parse (``25/03/2024``, ``03/25/2024``)
decide for all of that column there.  The votes are sums by file (they combine
before the shuffle, however large a file is); the decision is joined back and
every value is parsed by it.  Without a deciding value, or at a tie, the day
comes first.  A value that the decided layout cannot parse is NULL and is counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D

DAY_FIRST, MONTH_FIRST = "DIA", "MES"


def _votes(c: Column) -> dict[str, Column]:
    """Which way a value can be read; NULL and other layouts have no vote."""
    s = F.trim(c.cast("string"))
    pair = s.rlike(D.PAIR_SHAPE)
    day = pair & D.parse_pair(s, F.lit(False)).isNotNull()
    month = pair & D.parse_pair(s, F.lit(True)).isNotNull()
    return {"DIA_PRIMERO": day & ~month, "MES_PRIMERO": month & ~day, "AMBIGUAS": day & month,
            "IMPOSIBLES": pair & ~day & ~month}


def layout_votes(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per file (``keys``) and COLUMNA: the values that only a day-first or only a
    month-first layout parses, those that both or neither do, and the DISPOSICION."""
    kinds = list(_votes(F.lit(None)))
    sums = df.groupBy(*keys).agg(*[
        F.struct(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in _votes(F.col(c)).items()]).alias(c)
        for c in columns])
    per_column = F.explode(F.array(*[F.struct(F.lit(c).alias("COLUMNA"), *[F.col(c)[k].alias(k) for k in kinds])
                                     for c in columns]))
    votes = sums.select(*keys, per_column.alias("v")).select(*keys, "v.*")
    return votes.withColumn("DISPOSICION", F.when(F.col("MES_PRIMERO") > F.col("DIA_PRIMERO"), MONTH_FIRST)
                            .otherwise(DAY_FIRST))


def parse_dates(df: DataFrame, keys: Sequence[str], columns: Sequence[str], votes: DataFrame) -> DataFrame:
    """``df`` with ``columns`` parsed, each by its file's layout.  Only the files
    with a month-first column are joined back."""
    month = (votes.filter(F.col("DISPOSICION") == MONTH_FIRST).groupBy(*keys)
             .agg(F.collect_set("COLUMNA").alias("_mes")))  # at most the columns' names
    month = month.select(*[F.col(k).alias(f"_clave_{k}") for k in keys], "_mes")
    same = [F.col(k).eqNullSafe(F.col(f"_clave_{k}")) for k in keys]
    first = {c: F.coalesce(F.array_contains("_mes", c), F.lit(False)) for c in columns}
    return df.join(month, same, "left").select(
        *[D.parse_date_by(F.col(f"`{c}`"), first[c]).alias(c) if c in first else F.col(f"`{c}`") for c in df.columns])
