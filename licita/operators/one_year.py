"""One-year contract model (the earlier, string-typed variant of the star).

Differences from the curated star, kept on purpose: every column stays a
string, versions are "last by (month, file)", the bridge key includes
ID_ENTREGA, supplier lists are embedded in the fact, and the entity falls
back to the buyer with a three-way origin label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reports import LIST_SEP
from ..session import materialise
from .versions import latest_by

# Labels of the one-year model.
YES, NO = "SI", "NO"
ORIGIN_ENTITY = "ENTIDAD_CONTRATANTE"
ORIGIN_BUYER = "COMPRADOR_RESPALDO"
ORIGIN_NONE = "SIN_ENTIDAD"
QUALITY_NAMES = ["Total de contratos", "Claves de contrato únicas", "Filas duplicadas por clave",
                 "Contratos sin registro relacionado", "Contratos sin entidad",
                 "Contratos sin proveedor", "Contratos con varios proveedores",
                 "Relaciones contrato-proveedor", "Proveedores únicos", "Entidades únicas"]


class CardinalityError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], label: str = "") -> None:
    """J-11: the declared-unique side of a merge must be unique; raises with
    (up to 20) offending keys.  The check is an aggregate; only offending
    keys, if any, reach the driver."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1)
    bad = dup.limit(20).collect()
    if bad:
        raise CardinalityError(f"{label}: claves repetidas {[tuple(r)[:-1] for r in bad]}")


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                 validate: str) -> DataFrame:
    """J-11: join with a declared cardinality (one_to_one, many_to_one,
    one_to_many, many_to_many)."""
    if validate in ("one_to_one", "one_to_many"):
        assert_unique(left, on, "izquierda")
    if validate in ("one_to_one", "many_to_one"):
        assert_unique(right, on, "derecha")
    return left.join(right, list(on), how)


def last_by_period(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-6: sort by (month number, file) and keep the last row per key."""
    return latest_by(df, keys, [F.col("MES_ARCHIVO").try_cast("int"), F.col("ARCHIVO_ORIGEN")])


def fact(contracts: DataFrame, records: DataFrame, suppliers: DataFrame
         ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fact, bridge, supplier dimension, entity dimension)."""
    # written once: the cardinality checks and the joins read the same rows
    cur = materialise(last_by_period(contracts, ["CLAVE_CONTRATO"]), "one-year-contracts")
    reg = materialise(last_by_period(records, ["OCID", "ID_ENTREGA"]), "one-year-records")
    sup = last_by_period(suppliers, ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR"])
    reg_cols = ["OCID", "ID_ENTREGA", "ID_LICITACION", "ID_ENTIDAD_CONTRATANTE",
                "NOMBRE_ENTIDAD_CONTRATANTE", "ID_COMPRADOR", "NOMBRE_COMPRADOR",
                "METODO_CONTRATACION", "CATEGORIA_PRINCIPAL"]
    f = checked_join(cur, reg.select(*reg_cols), ["OCID", "ID_ENTREGA"], "left", "many_to_one")
    f = f.withColumns({
        "REGISTRO_RELACIONADO": F.when(F.col("ID_LICITACION").isNotNull(), YES).otherwise(NO),
        "ID_ENTIDAD_MODELO": F.coalesce("ID_ENTIDAD_CONTRATANTE", "ID_COMPRADOR"),
        "NOMBRE_ENTIDAD_MODELO": F.coalesce("NOMBRE_ENTIDAD_CONTRATANTE", "NOMBRE_COMPRADOR"),
        "ORIGEN_ENTIDAD_MODELO": F.when(F.col("ID_ENTIDAD_CONTRATANTE").isNotNull(), ORIGIN_ENTITY)
        .when(F.col("ID_COMPRADOR").isNotNull(), ORIGIN_BUYER).otherwise(ORIGIN_NONE),
    })
    keys = f.select("CLAVE_CONTRATO", "OCID", "ID_ENTREGA", "ID_ADJUDICACION").distinct()
    b = keys.join(sup.select("OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR",
                             "NOMBRE_PROVEEDOR", "MES_ARCHIVO", "ARCHIVO_ORIGEN"),
                  ["OCID", "ID_ENTREGA", "ID_ADJUDICACION"], "inner")
    bridge = last_by_period(b, ["CLAVE_CONTRATO", "ID_PROVEEDOR"])

    def joined(c):
        v = F.nullif(F.trim(F.col(c)), F.lit(""))
        return F.array_join(F.array_sort(F.collect_set(v)), LIST_SEP)
    summary = bridge.groupBy("CLAVE_CONTRATO").agg(
        F.count_distinct("ID_PROVEEDOR").alias("CANTIDAD_PROVEEDORES"),
        joined("ID_PROVEEDOR").alias("IDS_PROVEEDORES"),
        joined("NOMBRE_PROVEEDOR").alias("NOMBRES_PROVEEDORES"))
    f = checked_join(f, summary, ["CLAVE_CONTRATO"], "left", "one_to_one")
    n = F.coalesce(F.col("CANTIDAD_PROVEEDORES"), F.lit(0)).cast("int")
    f = f.withColumns({"CANTIDAD_PROVEEDORES": n,
                       "TIENE_PROVEEDOR": F.when(n > 0, YES).otherwise(NO)})
    dim_sup = last_by_period(sup.filter(F.col("ID_PROVEEDOR").isNotNull()), ["ID_PROVEEDOR"]) \
        .select("ID_PROVEEDOR", "NOMBRE_PROVEEDOR")
    ent = reg.withColumns({
        "ID_ENTIDAD_MODELO": F.coalesce("ID_ENTIDAD_CONTRATANTE", "ID_COMPRADOR"),
        "NOMBRE_ENTIDAD_MODELO": F.coalesce("NOMBRE_ENTIDAD_CONTRATANTE", "NOMBRE_COMPRADOR"),
        "ORIGEN_ENTIDAD_MODELO": F.when(F.col("ID_ENTIDAD_CONTRATANTE").isNotNull(), ORIGIN_ENTITY)
        .otherwise(ORIGIN_BUYER)})
    dim_ent = last_by_period(ent.filter(F.col("ID_ENTIDAD_MODELO").isNotNull()),
                             ["ID_ENTIDAD_MODELO"]) \
        .select("ID_ENTIDAD_MODELO", "NOMBRE_ENTIDAD_MODELO", "ORIGEN_ENTIDAD_MODELO")
    return f, bridge, dim_sup, dim_ent


def quality(f: DataFrame, bridge: DataFrame, dim_sup: DataFrame, dim_ent: DataFrame) -> DataFrame:
    """AGG-18 + WIN-7: the ten quality indicators (INDICADOR / CANTIDAD)."""
    fa = f.agg(F.count(F.lit(1)).alias("a"), F.count_distinct("CLAVE_CONTRATO").alias("b"),
               F.count_if(F.col("ID_LICITACION").isNull()).alias("d"),
               F.count_if(F.col("ID_ENTIDAD_MODELO").isNull()).alias("e"),
               F.count_if(F.col("CANTIDAD_PROVEEDORES") == 0).alias("g"),
               F.count_if(F.col("CANTIDAD_PROVEEDORES") > 1).alias("h"))
    vals = [fa.select(F.lit(0).alias("o"), F.col("a").alias("v")),
            fa.select(F.lit(1).alias("o"), F.col("b").alias("v")),
            fa.select(F.lit(2).alias("o"), (F.col("a") - F.col("b")).alias("v")),
            fa.select(F.lit(3).alias("o"), F.col("d").alias("v")),
            fa.select(F.lit(4).alias("o"), F.col("e").alias("v")),
            fa.select(F.lit(5).alias("o"), F.col("g").alias("v")),
            fa.select(F.lit(6).alias("o"), F.col("h").alias("v")),
            bridge.agg(F.lit(7).alias("o"), F.count(F.lit(1)).alias("v")),
            dim_sup.agg(F.lit(8).alias("o"), F.count(F.lit(1)).alias("v")),
            dim_ent.agg(F.lit(9).alias("o"), F.count(F.lit(1)).alias("v"))]
    u = vals[0]
    for v in vals[1:]:
        u = u.unionByName(v)
    names = F.array(*[F.lit(n) for n in QUALITY_NAMES])
    return u.select(F.element_at(names, F.col("o") + 1).alias("INDICADOR"),
                    F.col("v").cast("bigint").alias("CANTIDAD"))
