"""Quality controls: named indicators, orphans, duplicates, gates.

Indicators are computed as single-pass aggregates per table (one scan, many
counters) and unpivoted into INDICADOR / VALOR rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "OK"
REVIEW = "REVISAR"


def indicator_rows(df: DataFrame, exprs: dict[str, Column], start: int = 0) -> DataFrame:
    """One aggregate pass over ``df``; one (ORDEN, INDICADOR, VALOR) row per expression."""
    cols = [e.cast("bigint").alias(f"v{i}") for i, e in enumerate(exprs.values())]
    agg = df.agg(*cols)
    names = list(exprs)
    pairs = [F.struct(F.lit(start + i).alias("ORDEN"), F.lit(n).alias("INDICADOR"),
                      F.col(f"v{i}").alias("VALOR")) for i, n in enumerate(names)]
    return agg.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str,
            within: Sequence[str] = ()) -> DataFrame:
    """J-7: rows of ``child`` with a non-NULL FK and no parent (anti join).  ``within``:
    columns of both that the key determines; rows dealt by them stay where they are."""
    c = child.select(*within, F.col(fk).alias("_fk")).filter(F.col("_fk").isNotNull())
    p = parent.select(*within, F.col(pk).alias("_fk"))
    return c.join(p, [*within, "_fk"], "left_anti").agg(F.count(F.lit(1)).alias("HUERFANOS")) \
        .select(F.lit(relation).alias("RELACION"), "HUERFANOS")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-15: ``GROUP BY keys HAVING count(*) > 1``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("REPETICIONES")) \
        .filter(F.col("REPETICIONES") > 1)


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-6: rows of ``left`` with no partner in ``right`` (anti join)."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def distinct_count(df: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """One row ``n``: the number of non-NULL keys (``within``: see ``orphans``)."""
    return df.select(*within, key).filter(F.col(key).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n"))


def status(ok: Column) -> Column:
    return F.when(ok, F.lit(OK)).otherwise(F.lit(REVIEW))


def gate(checks: DataFrame, flag: str = "CUMPLE") -> DataFrame:
    """AGG-20: all checks true -> OK, else REVISAR (no checks -> OK)."""
    return checks.agg(F.coalesce(F.bool_and(F.col(flag)), F.lit(True)).alias("_all")) \
        .select(status(F.col("_all")).alias("ESTADO_GENERAL"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-16: row count per table as TABLA / FILAS rows (one aggregate each)."""
    return union_all([df.agg(F.count(F.lit(1)).alias("FILAS"))
                      .select(F.lit(name).alias("TABLA"), "FILAS") for name, df in tables.items()])
