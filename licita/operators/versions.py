"""Current-version selection and duplicate detection.

``latest_by`` is ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ...) = 1``.
Spark plans a *partial* WindowGroupLimit before the shuffle for this shape,
so every key -- however hot -- reaches the exchange as at most one row per
input partition, and the reduce side sorts one row per key and partition.
Ties on the order are broken by the remaining orderable columns
(descending), which makes the choice total and deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..session import materialise


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _orderable(dt) -> bool:
    if isinstance(dt, MapType):
        return False
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence, *,
              drop_null_keys: bool = True, within: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest ``order`` (each item DESC NULLS LAST).

    Remaining orderable columns act as the final tie-break (DESC NULLS LAST,
    in column order).  Rows whose key has a NULL part are dropped first (the
    reference's ``WHERE key IS NOT NULL``), which also lets Catalyst push the
    predicate into the scan.  ``within`` names columns that the key determines:
    rows dealt by them need no further exchange.
    """
    keys = list(keys)
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.filter(cond)
    tie = [F.col(f.name).desc_nulls_last() for f in df.schema.fields
           if f.name not in keys and _orderable(f.dataType)]
    w = Window.partitionBy(*within, *keys).orderBy(*[_as_col(o).desc_nulls_last() for o in order], *tie)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def last_non_null(value: str | Column, order: Column, name: str | None = None) -> Column:
    """Aggregate: value of the greatest ``order`` among rows where it is set.

    Equals DuckDB ``arg_max(v, o)`` (which skips NULL values) when ``order``
    is unique within the group; plain ``max_by`` would return the NULL of the
    newest row.
    """
    v = _as_col(value)
    picked = F.max(F.when(v.isNotNull(), F.struct(order.alias("o"), v.alias("v"))))
    out = picked.getField("v")
    return out.alias(name) if name else out


def duplicate_flag(df: DataFrame, keys: Sequence[str], name: str = "ES_DUPLICADO_CLAVE",
                   written: bool = False) -> DataFrame:
    """WIN-5: every member of a key that occurs more than once is flagged.

    Counted with a (map-side partial) aggregate and joined back on the key
    instead of a window, so a hot key never has to be buffered in one task;
    AQE splits a skewed join partition.  NULL keys are never duplicates.
    ``written``: the keys that repeat are written and read back; where they are few,
    as their size then tells, the rows are not exchanged for the join.
    """
    keys = list(keys)
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > 1).select(*keys, F.lit(True).alias("_dup")))
    out = df.join(materialise(counts, "repeated-keys") if written else counts, on=keys, how="left")
    return out.withColumn(name, F.coalesce(F.col("_dup"), F.lit(False))).drop("_dup")


def extra_copy_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-7: count(*) - count(distinct key) as a one-row DataFrame."""
    k = F.struct(*[F.col(c) for c in keys])
    return df.agg((F.count(F.lit(1)) - F.count_distinct(k)).alias("FILAS_DUPLICADAS"))
