"""Incremental-load queries (INC-1..INC-9, DQ-9..DQ-12) on two snapshots
derived from the whole ``orders`` table: the current batch is every order; the
previous load is every order too, every tenth with another price and the odd
ones under a key of their own (the negative), so that they are absent now and
the odd orders are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import incremental as I
from ..operators import digests as DG
from ..operators import warehouse as W
from ..sources import manifest as M
from .adapters import Tables

AS_OF = "1998-08-02"


def _snapshot(spark, sf_dir, previous: bool) -> DataFrame:
    o = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                               "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    if previous:
        price = F.when(k % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        o = o.withColumns({"MONTO": price, "o_orderkey": F.when(k % 2 == 0, k).otherwise(-k)})
    else:
        o = o.withColumn("MONTO", F.col("o_totalprice"))
    h = K.row_hash(k, F.col("o_custkey"), F.col("MONTO"), F.col("o_orderstatus"),
                   F.col("o_orderdate"), F.lit(None), F.lit(None), F.lit(None))
    return o.select("o_orderkey", "o_custkey", "MONTO", "o_orderstatus", "o_orderdate",
                    h.alias("HASH_FILA"))


def upsert(spark, sf_dir) -> DataFrame:
    """INC-4: per key INSERTAR / ACTUALIZAR / SIN_CAMBIO / AUSENTE."""
    return I.classify_changes(_snapshot(spark, sf_dir, True), _snapshot(spark, sf_dir, False),
                              ["o_orderkey"])


def upsert_idempotence(spark, sf_dir) -> DataFrame:
    """INC-12 + DQ-9: the same batch applied a second time changes nothing."""
    old, new = _snapshot(spark, sf_dir, True), _snapshot(spark, sf_dir, False)
    first = I.apply_upsert(old, new, ["o_orderkey"])
    return I.action_counts(I.classify_changes(first, new, ["o_orderkey"]))


def scd2_history(spark, sf_dir) -> DataFrame:
    """INC-5: version history after applying the current batch on 1999-01-01."""
    old = _snapshot(spark, sf_dir, True)
    k = F.col("o_orderkey")
    open_ = old.select("*", F.lit("1998-01-01").cast("date").alias("FECHA_DESDE"),
                       F.lit(None).cast("date").alias("FECHA_HASTA"),
                       F.lit(1).alias("EJECUCION_ID"))
    prior = (old.filter(k % 20 == 0)
             .withColumn("MONTO", F.col("MONTO") - 5)
             .withColumn("HASH_FILA", F.md5(F.concat(F.col("HASH_FILA"), F.lit("v0"))))
             .select("*", F.lit("1997-01-01").cast("date").alias("FECHA_DESDE"),
                     F.lit("1998-01-01").cast("date").alias("FECHA_HASTA"),
                     F.lit(0).alias("EJECUCION_ID")))
    history = open_.unionByName(prior)
    return I.scd2(history, _snapshot(spark, sf_dir, False), ["o_orderkey"], 2,
                  F.lit("1999-01-01").cast("date"))


def late_versions(spark, sf_dir) -> DataFrame:
    """INC-5, late deliveries: the batch of 1999 first, then that of 1998, then
    one of 1997 that has two thirds of the orders, as they were in 1999."""
    now, old = _snapshot(spark, sf_dir, False), _snapshot(spark, sf_dir, True)
    day = lambda d: F.lit(d).cast("date")
    history = I.merge_versions(None, now, ["o_orderkey"], 1, day("1999-01-01"))
    history = I.merge_versions(history, old, ["o_orderkey"], 2, day("1998-01-01"))
    return I.merge_versions(history, now.filter(F.col("o_custkey") % 3 != 0), ["o_orderkey"], 3, day("1997-01-01")).drop(I.SEEN)


def upsert_balance(spark, sf_dir) -> DataFrame:
    """DQ-9: every processed order is inserted, updated or unchanged."""
    new = _snapshot(spark, sf_dir, False)
    return I.upsert_balance(I.classify_changes(_snapshot(spark, sf_dir, True), new, ["o_orderkey"]), new)


def digest_reconcile(spark, sf_dir) -> DataFrame:
    """DQ-8 / DQ-12 by digests: the orders that differ between the last load and
    this one, found through the key ranges whose digests differ."""
    return DG.reconcile(_snapshot(spark, sf_dir, True), _snapshot(spark, sf_dir, False), ["o_orderkey"],
                        ["o_orderkey", "o_custkey", "MONTO", "o_orderstatus", "o_orderdate"])


def digest_agreement(spark, sf_dir) -> DataFrame:
    """The lines of orders against the same lines dealt out anew, each price of
    every 500th part off by a cent: per state the keys (order and line)."""
    l = Tables(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    off = l.withColumn("l_extendedprice", F.when(F.col("l_partkey") % 500 == 0, F.col("l_extendedprice") + 0.01)
                       .otherwise(F.col("l_extendedprice"))).repartition("l_suppkey")
    return DG.reconcile(l, off, ["l_orderkey", "l_linenumber"])


def _links(spark, sf_dir, previous: bool = False) -> DataFrame:
    """Order-supplier relations; in the previous load those of lines beyond the
    third had suppliers of their own."""
    l = Tables(spark, sf_dir)("lineitem")
    supplier = F.col("l_suppkey")
    if previous:
        supplier = F.when(F.col("l_linenumber") > 3, -supplier).otherwise(supplier)
    return l.select(F.col("l_orderkey").alias("o_orderkey"), supplier.alias("l_suppkey")).distinct()


def bridge_rebuild(spark, sf_dir) -> DataFrame:
    """INC-6: relations of new/changed orders replaced by the current list."""
    affected = upsert(spark, sf_dir).filter(F.col("ACCION").isin(I.INSERT, I.UPDATE))
    return I.rebuild_bridge(_links(spark, sf_dir, previous=True), _links(spark, sf_dir), affected,
                            "o_orderkey")


def soft_delete(spark, sf_dir) -> DataFrame:
    """INC-8: consecutive-absence counter and current flag (never deleted)."""
    old = _snapshot(spark, sf_dir, True)
    state = old.select("o_orderkey", (F.floor(F.abs("o_orderkey") / 2) % 3)
                       .cast("int").alias("AUSENCIAS_CONSECUTIVAS"))
    return I.soft_delete(state, _snapshot(spark, sf_dir, False), "o_orderkey")


def prorated_amount(spark, sf_dir) -> DataFrame:
    """INC-7: order amount split across its suppliers, exact to the cent."""
    o = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_totalprice")
    p = I.prorate(o, _links(spark, sf_dir), "o_orderkey", "o_totalprice", "l_suppkey")
    return p.select("o_orderkey", "l_suppkey", "PESO",
                    F.col("MONTO_PRORRATEADO").cast("string").alias("MONTO_PRORRATEADO"),
                    F.col("MONTO_ORIGINAL").cast("string").alias("MONTO_ORIGINAL"))


def proration_check(spark, sf_dir) -> DataFrame:
    """DQ-10: prorated sums equal the original amounts (differences by value)."""
    o = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_totalprice")
    p = I.prorate(o, _links(spark, sf_dir), "o_orderkey", "o_totalprice", "l_suppkey")
    return I.proration_check(p, "o_orderkey").groupBy(
        F.col("DIFERENCIA").cast("string").alias("DIFERENCIA")).agg(
        F.count(F.lit(1)).alias("CONTRATOS"))


def future_dates(spark, sf_dir) -> DataFrame:
    """DQ-11: orders dated after the as-of date go to review."""
    o = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return I.future_rows(o, "o_orderdate", F.lit(AS_OF).cast("timestamp_ntz"))


def batch_compare(spark, sf_dir) -> DataFrame:
    """DQ-12: counts by year and status, previous load versus current batch."""
    def dims(df):
        return df.select(F.year("o_orderdate").alias("ANIO"), "o_orderstatus")
    return I.batch_compare(dims(_snapshot(spark, sf_dir, True)),
                           dims(_snapshot(spark, sf_dir, False)), ["ANIO", "o_orderstatus"])


def dimension_upsert(spark, sf_dir) -> DataFrame:
    """INC-9 + S-7 + J-14: stored keys kept, new members numbered after the max."""
    t = Tables(spark, sf_dir)
    clave = F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    old = (t("customer").filter(F.col("c_custkey") % 2 == 0)
           .select(clave.alias("CLAVE_CLIENTE"),
                   ((F.col("c_custkey") / 2).cast("bigint") + 1).alias("CLIENTE_KEY")))
    used = t("orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    dim = t("customer").join(used, "c_custkey", "left_semi").select(
        clave.alias("CLAVE_CLIENTE"), F.col("c_name").alias("NOMBRE"))
    return W.with_surrogate(dim, "CLAVE_CLIENTE", "CLIENTE_KEY", existing=old)


def manifest_changes(spark, sf_dir) -> DataFrame:
    """INC-1 + F-25: documents as landing files; content hash vs previous manifest."""
    d = Tables(spark, sf_dir)("documents").select("doc_id", "source", "text")
    ruta = F.concat(F.lit("landing/"), F.col("source"), F.lit("/"),
                    F.col("doc_id").cast("string"), F.lit(".txt"))
    cur = d.select(ruta.alias("RUTA"), F.sha2(F.col("text"), 256).alias("SHA256"))
    prev = d.filter(F.col("doc_id") % 4 != 0).select(
        ruta.alias("RUTA"),
        F.sha2(F.when(F.col("doc_id") % 10 == 1, F.concat(F.col("text"), F.lit("x")))
               .otherwise(F.col("text")), 256).alias("SHA256"))
    return M.changed_inputs(cur, prev)


def package_changes(spark, sf_dir) -> DataFrame:
    """INC-2: daily packages (events by day) skipped when the publication
    timestamp is unchanged and the package was already processed."""
    e = Tables(spark, sf_dir)("events").select("ts")
    day = F.to_date("ts")
    pk = e.groupBy(day.alias("DIA")).agg(F.max("ts").alias("TIMESTAMP"))
    pk = pk.select(F.concat(F.lit("pkg-"), F.date_format("DIA", "yyyyMMdd")).alias("RUTA"),
                   F.date_format("TIMESTAMP", "yyyy-MM-dd HH:mm:ss").alias("SHA256"),
                   F.dayofmonth("DIA").alias("_d"))
    state = pk.filter(F.col("_d") % 5 != 0).select(
        "RUTA", F.when(F.col("_d") % 3 == 0, F.lit("1900-01-01 00:00:00"))
        .otherwise(F.col("SHA256")).alias("SHA256"))
    out = M.changed_inputs(pk.drop("_d"), state)
    return out.withColumnRenamed("RUTA", "PAQUETE").withColumnRenamed("SHA256", "TIMESTAMP_API")


QUERIES = {
    "upsert": upsert,
    "upsert_idempotence": upsert_idempotence,
    "scd2_history": scd2_history,
    "late_versions": late_versions,
    "upsert_balance": upsert_balance,
    "digest_reconcile": digest_reconcile,
    "digest_agreement": digest_agreement,
    "bridge_rebuild": bridge_rebuild,
    "soft_delete": soft_delete,
    "prorated_amount": prorated_amount,
    "proration_check": proration_check,
    "future_dates": future_dates,
    "batch_compare": batch_compare,
    "dimension_upsert": dimension_upsert,
    "manifest_changes": manifest_changes,
    "package_changes": package_changes,
}
