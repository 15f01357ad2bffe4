"""Incremental load (the daily-update specification): hash-based upsert,
version history, bridge rebuild, soft delete, proration, idempotence.

Everything is expressed as joins and aggregates on the business key; the
target is a table snapshot (a new version is written, then published), so no
table format with MERGE is required.  NULL-safe comparisons throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Change actions and flags.
INSERT = "INSERTAR"
UPDATE = "ACTUALIZAR"
UNCHANGED = "SIN_CAMBIO"
ABSENT = "AUSENTE"
DEFAULT_CONFIRMATIONS = 2


def classify_changes(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     hash_col: str = "HASH_FILA") -> DataFrame:
    """INC-4: one row per key with the action new / changed / same / absent.

    A full outer join on the key (the only place a full outer join is
    needed); absent keys are reported, never deleted (INC-8).
    """
    keys = list(keys)
    t = target.select(*keys, F.col(hash_col).alias("_h_old"), F.lit(True).alias("_in_old"))
    s = source.select(*keys, F.col(hash_col).alias("_h_new"), F.lit(True).alias("_in_new"))
    j = t.join(s, keys, "full_outer")
    action = (F.when(F.col("_in_old").isNull(), F.lit(INSERT))
              .when(F.col("_in_new").isNull(), F.lit(ABSENT))
              .when(F.col("_h_old").eqNullSafe(F.col("_h_new")), F.lit(UNCHANGED))
              .otherwise(F.lit(UPDATE)))
    return j.select(*keys, action.alias("ACCION"))


def apply_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New target snapshot: source rows win for their keys; target rows whose
    key is absent from the source are kept (no physical delete)."""
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.select(*target.columns).unionByName(kept)


def action_counts(classified: DataFrame) -> DataFrame:
    """DQ-9 / INC-12 counters: rows per action, every action present."""
    actions = classified.sparkSession.createDataFrame(
        [(a,) for a in (INSERT, UPDATE, UNCHANGED, ABSENT)], "ACCION string")
    n = classified.groupBy("ACCION").agg(F.count(F.lit(1)).alias("FILAS"))
    return actions.join(n, "ACCION", "left").select(
        "ACCION", F.coalesce("FILAS", F.lit(0)).cast("bigint").alias("FILAS"))


def scd2(history: DataFrame, source: DataFrame, keys: Sequence[str], run_id: int,
         as_of: Column, hash_col: str = "HASH_FILA", valid_from: str = "FECHA_DESDE",
         valid_to: str = "FECHA_HASTA", run_col: str = "EJECUCION_ID") -> DataFrame:
    """INC-5: close the open version of changed keys at ``as_of`` and open the
    new one; new keys get an open version; unchanged and absent keys keep
    their open version; closed versions are carried over untouched."""
    keys = list(keys)
    is_open = F.col(valid_to).isNull()
    closed = history.filter(~is_open)
    open_ = history.filter(is_open)
    actions = classify_changes(open_, source, keys, hash_col)
    changed = actions.filter(F.col("ACCION").isin(UPDATE, INSERT)).select(*keys)
    to_close = open_.join(changed, keys, "left_semi").withColumn(valid_to, as_of)
    still_open = open_.join(changed, keys, "left_anti")
    attrs = [c for c in history.columns if c not in (valid_from, valid_to, run_col)]
    new_rows = (source.join(changed, keys, "left_semi").select(*attrs)
                .withColumn(valid_from, as_of)
                .withColumn(valid_to, F.lit(None).cast(history.schema[valid_to].dataType))
                .withColumn(run_col, F.lit(run_id).cast(history.schema[run_col].dataType)))
    return closed.unionByName(to_close).unionByName(still_open).unionByName(
        new_rows.select(*history.columns))


SEEN = "VISTOS"


def merge_versions(history: DataFrame | None, source: DataFrame, keys: Sequence[str], run_id: int, as_of: Column,
                   hash_col: str = "HASH_FILA", valid_from: str = "FECHA_DESDE", valid_to: str = "FECHA_HASTA",
                   run_col: str = "EJECUCION_ID") -> DataFrame:
    """INC-5 with late deliveries: batches applied in any order give the same
    history.  Each version keeps when (and by which run) it was seen (SEEN), so a batch
    whose date lies before open versions is put between them: it splits a
    version that was seen on both sides of it, and only confirms one of the same hash.

    Only the keys of the batch are worked on; a key has as many rows as times it
    was seen.  Two batches of one date: the higher run counts.  ``history`` None: the
    first batch.
    """
    keys, attrs = list(keys), list(source.columns)
    columns = [*attrs, valid_from, valid_to, run_col, SEEN]
    batch = source.select(*attrs, as_of.cast("date").alias("_dia"), F.lit(run_id).cast("int").alias("_ejecucion"))
    seen = batch
    if history is not None:
        mine = batch.select(*keys).distinct()
        seen = batch.unionByName(history.join(mine, keys, "left_semi").select(*attrs, F.explode(SEEN).alias("_v")).select(
            *attrs, F.col("_v.dia").alias("_dia"), F.col("_v.ejecucion").alias("_ejecucion")))
    latest = Window.partitionBy(*keys, "_dia").orderBy(F.desc("_ejecucion"), hash_col)
    by_day = Window.partitionBy(*keys).orderBy("_dia")
    seen = seen.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")
    seen = seen.withColumn("_cambia", F.when(F.lag("_dia").over(by_day).isNotNull()
                                             & F.col(hash_col).eqNullSafe(F.lag(hash_col).over(by_day)), 0).otherwise(1))
    seen = seen.withColumn("_version", F.sum("_cambia").over(by_day))
    rest = [c for c in attrs if c not in keys]
    versions = seen.groupBy(*keys, "_version").agg(
        F.min_by(F.struct(*rest), "_dia").alias("_a"), F.min("_dia").alias(valid_from),
        F.array_sort(F.collect_list(F.struct(F.col("_dia").alias("dia"), F.col("_ejecucion").alias("ejecucion")))).alias(SEEN))
    made = versions.select(*keys, *[F.col(f"_a.{c}").alias(c) for c in rest], valid_from,
                           F.lead(valid_from).over(Window.partitionBy(*keys).orderBy(valid_from)).alias(valid_to),
                           F.col(SEEN)[0]["ejecucion"].alias(run_col), SEEN).select(*columns)
    return made if history is None else made.unionByName(history.join(mine, keys, "left_anti").select(*columns))


def upsert_balance(classified: DataFrame, source: DataFrame) -> DataFrame:
    """DQ-9: inserted + updated + unchanged keys against the rows processed."""
    n = lambda a: F.count_if(F.col("ACCION") == a)
    counts = classified.agg(n(INSERT).alias("INSERTADAS"), n(UPDATE).alias("ACTUALIZADAS"), n(UNCHANGED).alias("SIN_CAMBIO"))
    rows = source.agg(F.count(F.lit(1)).alias("PROCESADAS"))
    return rows.join(counts, F.lit(True)).select(  # one row each
        "*", (F.col("INSERTADAS") + F.col("ACTUALIZADAS") + F.col("SIN_CAMBIO") == F.col("PROCESADAS")).alias("CUADRA"))


def rebuild_bridge(old_bridge: DataFrame, new_bridge: DataFrame, affected: DataFrame,
                   key: str) -> DataFrame:
    """INC-6: relations of affected contracts are replaced by the current list;
    other contracts keep theirs.  Supplier dimension rows are untouched."""
    aff = affected.select(key).distinct()
    return (old_bridge.join(aff, key, "left_anti")
            .unionByName(new_bridge.join(aff, key, "left_semi")))


def soft_delete(state: DataFrame, present: DataFrame, key: str,
                counter: str = "AUSENCIAS_CONSECUTIVAS", flag: str = "VIGENTE",
                confirmations: int = DEFAULT_CONFIRMATIONS) -> DataFrame:
    """INC-8: absent keys count consecutive absences; a key is marked not
    current only after ``confirmations`` runs; present keys reset to 0.
    Nothing is deleted; keys seen for the first time enter with 0."""
    p = present.select(key).distinct().withColumn("_here", F.lit(True))
    j = state.select(key, counter).join(p, key, "full_outer")
    n = (F.when(F.col("_here").isNotNull(), F.lit(0))
         .otherwise(F.coalesce(F.col(counter), F.lit(0)) + 1)).cast("int")
    return j.select(key, n.alias(counter), (n < confirmations).alias(flag))


def prorate(contracts: DataFrame, links: DataFrame, key: str, amount: str, partner: str,
            scale: int = 4) -> DataFrame:
    """INC-7: equal-weight split of each contract amount over its partners.

    Each share is the amount / n rounded to ``scale`` decimals; the rounding
    remainder goes to the smallest partner key, so shares add up exactly to
    the amount (DQ-10).  Counts and the remainder holder come from an
    aggregate joined back on the key (partial aggregation, skew-safe), not
    from a window over a possibly huge contract.
    """
    dec = f"decimal(28,{scale})"
    pairs = links.select(key, partner).distinct()
    per = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(partner).alias("_first"))
    base = contracts.select(key, F.col(amount).cast(dec).alias("_amt")).join(per, key, "inner")
    share = F.round(F.col("_amt") / F.col("_n"), scale).cast(dec)
    base = base.withColumn("_share", share).withColumn(
        "_rest", (F.col("_amt") - F.col("_share") * F.col("_n")).cast(dec))
    j = pairs.join(base, key, "inner")
    amt = F.when(F.col(partner) == F.col("_first"),
                 (F.col("_share") + F.col("_rest")).cast(dec)).otherwise(F.col("_share"))
    return j.select(key, partner, (F.lit(1.0) / F.col("_n")).alias("PESO"),
                    amt.alias("MONTO_PRORRATEADO"), F.col("_amt").alias("MONTO_ORIGINAL"))


def proration_check(prorated: DataFrame, key: str) -> DataFrame:
    """DQ-10: per contract, prorated sum minus original amount (must be 0)."""
    return prorated.groupBy(key).agg(
        (F.sum("MONTO_PRORRATEADO") - F.first("MONTO_ORIGINAL")).alias("DIFERENCIA"))


def future_rows(df: DataFrame, date_col: str, as_of: Column) -> DataFrame:
    """DQ-11: rows dated after the as-of date, set aside for review."""
    return df.filter(F.col(date_col) > as_of)


def batch_compare(previous: DataFrame, current: DataFrame, dims: Sequence[str]) -> DataFrame:
    """DQ-12: counts by dimensions in two batches, side by side (full outer)."""
    dims = list(dims)
    a = previous.groupBy(*dims).agg(F.count(F.lit(1)).alias("FILAS_ANTERIOR"))
    b = current.groupBy(*dims).agg(F.count(F.lit(1)).alias("FILAS_ACTUAL"))
    j = a.join(b, dims, "full_outer")
    return j.select(*dims, F.coalesce("FILAS_ANTERIOR", F.lit(0)).alias("FILAS_ANTERIOR"),
                    F.coalesce("FILAS_ACTUAL", F.lit(0)).alias("FILAS_ACTUAL"),
                    (F.coalesce("FILAS_ACTUAL", F.lit(0)) - F.coalesce("FILAS_ANTERIOR", F.lit(0)))
                    .alias("DIFERENCIA"))
