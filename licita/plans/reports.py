"""Report and quality queries over the curated star (section 7.4 names)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import reports as R
from .curated import DIM_COLUMNS, PROCESS, curated_star, written_star

# Indicator names of the curated quality control, in order.
CURATED_INDICATORS = [
    "Filas staging contratos", "Contratos actuales", "Claves de contrato únicas",
    "Contratos sin entidad", "Contratos con respaldo por OCID",
    "Contratos sin registro relacionado", "Relaciones contrato-proveedor",
    "Contratos con proveedor", "Organizaciones únicas", "Entidades únicas",
    "Proveedores únicos", "Organizaciones con ubicación", "Entidades con ubicación",
    "Proveedores con ubicación", "Ubicaciones únicas", "Monedas", "Categorías",
    "Métodos de contratación"]


def annual_summary(spark, sf_dir) -> DataFrame:
    """Flagship (section 7.1): current contract value per year with entity,
    ordered by year (S-3; a handful of rows after aggregation)."""
    return R.annual_summary(curated_star(spark, sf_dir)["fact"]).orderBy("ANIO")


def monthly_summary(spark, sf_dir) -> DataFrame:
    """AGG-7 over all contract versions."""
    st = curated_star(spark, sf_dir)
    return R.monthly_summary(st["stg_contratos"], "CLAVE_CONTRATO",
                             ["FECHA_FIRMA", "DESCRIPCION_CONTRATO", "MONEDA_CONTRATO"])


def geo_counts(spark, sf_dir) -> DataFrame:
    """AGG-5 for entities and suppliers."""
    st = written_star(spark, sf_dir)
    return R.geo_counts(st["dim_entidad"], "ENTIDAD").unionByName(
        R.geo_counts(st["dim_proveedor"], "PROVEEDOR"))


def geo_ranking(spark, sf_dir) -> DataFrame:
    """S-2: departments by number of organisations, most first (ties: by name),
    with their rank.  The ordered rows are one a department and role."""
    from pyspark.sql import Window
    per = (geo_counts(spark, sf_dir).groupBy("ROL", "DEPARTAMENTO").agg(F.sum("CANTIDAD").alias("CANTIDAD")))
    order = Window.partitionBy("ROL").orderBy(F.desc("CANTIDAD"), "DEPARTAMENTO")
    return per.withColumn("RANGO", F.row_number().over(order))


def supplier_list_per_contract(spark, sf_dir) -> DataFrame:
    """AGG-8 + AGG-9."""
    st = curated_star(spark, sf_dir)
    return R.supplier_list(st["contrato_actual"], st["bridge"])


def indicators(spark, sf_dir) -> DataFrame:
    """AGG-4: the 18 curated indicators as INDICADOR / VALOR rows."""
    st = written_star(spark, sf_dir, "TIPO_RELACION_REGISTRO", *DIM_COLUMNS,
                      bridge_columns=["CLAVE_CONTRATO", "CLAVE_PROVEEDOR"])
    n = F.count(F.lit(1))
    names = CURATED_INDICATORS

    def cnt_if(c):
        return F.count_if(c)
    parts = [
        Q.indicator_rows(st["stg_contratos"], {names[0]: n}, 0),
        Q.indicator_rows(st["fact"], {
            names[1]: n}, 1),
        Q.indicator_rows(Q.distinct_count(st["fact"], "CLAVE_CONTRATO", PROCESS), {names[2]: F.sum("n")}, 2),
        Q.indicator_rows(st["fact"], {
            names[3]: cnt_if(F.col("CLAVE_ENTIDAD").isNull()),
            names[4]: cnt_if(F.col("TIPO_RELACION_REGISTRO") == "RESPALDO_OCID"),
            names[5]: cnt_if(F.col("TIPO_RELACION_REGISTRO") == "SIN_REGISTRO")}, 3),
        Q.indicator_rows(st["bridge"], {names[6]: n}, 6),
        Q.indicator_rows(Q.distinct_count(st["bridge"], "CLAVE_CONTRATO", PROCESS), {names[7]: F.sum("n")}, 7),
        Q.indicator_rows(st["dim_organizacion"], {
            names[8]: n, names[11]: cnt_if(F.col("CLAVE_UBICACION").isNotNull())}, 8),
        Q.indicator_rows(st["dim_entidad"], {
            names[9]: n, names[12]: cnt_if(F.col("CLAVE_UBICACION").isNotNull())}, 10),
        Q.indicator_rows(st["dim_proveedor"], {
            names[10]: n, names[13]: cnt_if(F.col("CLAVE_UBICACION").isNotNull())}, 12),
        Q.indicator_rows(st["dim_ubicacion"], {names[14]: n}, 14),
        Q.indicator_rows(st["dim_moneda"], {names[15]: n}, 15),
        Q.indicator_rows(st["dim_categoria"], {names[16]: n}, 16),
        Q.indicator_rows(st["dim_metodo"], {names[17]: n}, 17),
    ]
    return Q.union_all(parts).select("INDICADOR", "VALOR")


def coverage_profile(spark, sf_dir) -> DataFrame:
    """AGG-11 over the parties staging."""
    return R.coverage_profile(curated_star(spark, sf_dir)["stg_partes"])


def role_frequency(spark, sf_dir) -> DataFrame:
    """AGG-12 + F-22."""
    return R.role_frequency(curated_star(spark, sf_dir)["stg_partes"])


def orphans_and_anti(spark, sf_dir) -> DataFrame:
    """J-6 + J-7 on the test tables and on the star."""
    from .adapters import Tables
    t = Tables(spark, sf_dir)
    st = written_star(spark, sf_dir, bridge_columns=["CLAVE_CONTRATO"])
    parts = [
        Q.orphans(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", "lineitem->orders"),
        Q.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey", "orders->customer"),
        Q.orphans(t("lineitem"), "l_suppkey", t("supplier"), "s_suppkey", "lineitem->supplier"),
        Q.orphans(st["fact"], "CLAVE_ENTIDAD", st["dim_organizacion"], "CLAVE_ORGANIZACION",
                  "fact->dim_entidad"),
        Q.orphans(st["bridge"], "CLAVE_CONTRATO", st["fact"], "CLAVE_CONTRATO",
                  "bridge->fact", PROCESS),
        Q.orphans(st["dim_organizacion"], "CLAVE_UBICACION", st["dim_ubicacion"],
                  "CLAVE_UBICACION", "organizacion->ubicacion"),
        Q.without_match(t("orders").select("o_orderkey"),
                        t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")),
                        ["o_orderkey"]).agg(F.count(F.lit(1)).alias("HUERFANOS"))
        .select(F.lit("orders sin lineitem").alias("RELACION"), "HUERFANOS"),
        Q.without_match(t("customer").select("c_custkey"),
                        t("orders").select(F.col("o_custkey").alias("c_custkey")),
                        ["c_custkey"]).agg(F.count(F.lit(1)).alias("HUERFANOS"))
        .select(F.lit("customer sin orders").alias("RELACION"), "HUERFANOS"),
        Q.without_match(st["fact"].select(*PROCESS, "CLAVE_CONTRATO"), st["bridge"], [*PROCESS, "CLAVE_CONTRATO"])
        .agg(F.count(F.lit(1)).alias("HUERFANOS"))
        .select(F.lit("contratos sin proveedor").alias("RELACION"), "HUERFANOS"),
    ]
    return Q.union_all(parts)


def review_samples(spark, sf_dir) -> DataFrame:
    """S-4: review samples (LIMIT 1000 is the feature), ordered for determinism."""
    st = written_star(spark, sf_dir, "ID_CONTRATO", "MONTO_CONTRATO", "TIPO_RELACION_REGISTRO")
    f = st["fact"]
    no_entity = (f.filter(F.col("CLAVE_ENTIDAD").isNull())
                 .select(F.lit("SIN_ENTIDAD").alias("MUESTRA"), "CLAVE_CONTRATO", "OCID",
                         "ID_CONTRATO", "MONTO_CONTRATO", "TIPO_RELACION_REGISTRO")
                 .orderBy("CLAVE_CONTRATO").limit(1000))
    # the keys alone are matched; the 1000 that are shown then fetch their rows
    keys = (Q.without_match(f.select("CLAVE_CONTRATO"), st["bridge"], ["CLAVE_CONTRATO"])
            .orderBy("CLAVE_CONTRATO").limit(1000))
    no_sup = (f.join(F.broadcast(keys), "CLAVE_CONTRATO")
              .select(F.lit("SIN_PROVEEDOR").alias("MUESTRA"), "CLAVE_CONTRATO", "OCID",
                      "ID_CONTRATO", "MONTO_CONTRATO", "TIPO_RELACION_REGISTRO")
              .orderBy("CLAVE_CONTRATO").limit(1000))
    return no_entity.unionByName(no_sup)


QUERIES = {
    "annual_summary": annual_summary,
    "monthly_summary": monthly_summary,
    "geo_counts": geo_counts,
    "geo_ranking": geo_ranking,
    "supplier_list_per_contract": supplier_list_per_contract,
    "indicators": indicators,
    "coverage_profile": coverage_profile,
    "role_frequency": role_frequency,
    "orphans_and_anti": orphans_and_anti,
    "review_samples": review_samples,
}
