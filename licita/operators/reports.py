"""Summary reports over staging / curated tables (AGG-5..13, AGG-17..21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator of concatenated supplier lists.
LIST_SEP = " | "


def exact_sum(c: Column, scale: int = 4) -> Column:
    """Order-independent money total: exact decimal sum, reported as double."""
    return F.sum(c.cast(f"decimal(24,{scale})")).cast("double")


def annual_summary(fact: DataFrame) -> DataFrame:
    """AGG-6: year = coalesce(year(signature), file year); count; amount total."""
    anio = F.coalesce(F.year("FECHA_FIRMA"), F.col("ANIO_ARCHIVO")).cast("int")
    return (fact.groupBy(anio.alias("ANIO"))
            .agg(F.count(F.lit(1)).alias("CONTRATOS"),
                 exact_sum(F.coalesce(F.col("MONTO_CONTRATO"), F.lit(0.0))).alias("MONTO_TOTAL")))


def monthly_summary(df: DataFrame, key: str, nonnull: Sequence[str],
                    year: str = "ANIO_ARCHIVO", month: str = "MES_ARCHIVO") -> DataFrame:
    """AGG-7: rows, distinct keys and non-NULL counts per period (NULL groups kept)."""
    return df.groupBy(year, month).agg(
        F.count(F.lit(1)).alias("FILAS"),
        F.count_distinct(key).alias("CLAVES_UNICAS"),
        *[F.count(c).alias(f"CON_{c}") for c in nonnull])


def geo_counts(dim: DataFrame, label: str) -> DataFrame:
    """AGG-5: organisations with a location, counted by geography."""
    return (dim.filter(F.col("CLAVE_UBICACION").isNotNull())
            .groupBy("DEPARTAMENTO", "REGION", "LOCALIDAD")
            .agg(F.count(F.lit(1)).alias("CANTIDAD"))
            .withColumn("ROL", F.lit(label)))


def supplier_list(contracts: DataFrame, bridge: DataFrame) -> DataFrame:
    """AGG-8 + AGG-9: sorted distinct supplier names joined by ' | ' ('' when
    none) and the distinct supplier count (0 when none) per contract.

    ``collect_set`` is partial on the map side and holds distinct names only,
    so its size is bounded by the suppliers of one contract, not its rows.
    """
    name = F.nullif(F.trim(F.col("NOMBRE_PROVEEDOR_ORIGINAL")), F.lit(""))
    per = bridge.groupBy("CLAVE_CONTRATO").agg(
        F.array_join(F.array_sort(F.collect_set(name)), LIST_SEP).alias("_lst"),
        F.count_distinct("ID_PROVEEDOR").alias("_n"))
    return (contracts.select("CLAVE_CONTRATO").join(per, "CLAVE_CONTRATO", "left")
            .select("CLAVE_CONTRATO",
                    F.coalesce("_lst", F.lit("")).alias("PROVEEDORES"),
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("CANTIDAD_PROVEEDORES")))


def coverage_profile(partes: DataFrame) -> DataFrame:
    """AGG-11: coverage counters per file period over all partitions."""
    def n(c: Column) -> Column:
        return F.count_if(c)
    return partes.groupBy("ANIO_ARCHIVO", "MES_ARCHIVO").agg(
        F.count(F.lit(1)).alias("FILAS"),
        n(F.col("RUC_ORGANIZACION").isNotNull()).alias("CON_RUC"),
        n(F.col("RUC_VALIDO") == F.lit(True)).alias("RUC_VALIDOS"),
        n(F.col("DEPARTAMENTO_ESTANDAR").isNotNull()).alias("CON_DEPARTAMENTO"),
        n(F.col("REGION_ESTANDAR").isNotNull()).alias("CON_REGION"),
        n(F.col("LOCALIDAD_ESTANDAR").isNotNull()).alias("CON_LOCALIDAD"),
        n(F.col("DIRECCION_ESTANDAR").isNotNull()).alias("CON_DIRECCION"),
        n(F.col("ES_COMPRADOR_O_ENTIDAD")).alias("COMPRADORES_O_ENTIDADES"),
        n(F.col("ES_PROVEEDOR")).alias("PROVEEDORES"))


def role_frequency(partes: DataFrame) -> DataFrame:
    """AGG-12: frequency of standardised role strings (partial/final agg)."""
    return partes.groupBy("ROLES_ESTANDAR").agg(F.count(F.lit(1)).alias("FRECUENCIA"))
