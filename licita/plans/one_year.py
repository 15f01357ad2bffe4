"""One-year model queries: one year's packages of the adapted tables, all strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import one_year as OY
from . import adapters as A

MODEL_YEAR = 1998


class _YearTables(A.Tables):
    """The tables with a date range on the raw columns, which the scan takes.
    Records are published again a month later, so orders start a month before."""

    def __init__(self, spark, sf_dir, year: int):
        super().__init__(spark, sf_dir)
        self.ranges = {"lineitem": ("l_shipdate", f"{year}-01-01", f"{year + 1}-01-01"),
                       "orders": ("o_orderdate", f"{year - 1}-12-01", f"{year + 1}-01-01")}

    def __call__(self, name: str) -> DataFrame:
        df = super().__call__(name)
        if name not in self.ranges:
            return df
        c, lo, hi = self.ranges[name]
        return df.filter((F.col(c) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(c) < F.lit(hi).cast("timestamp_ntz")))


def _inputs(spark, sf_dir, year: int):
    t = _YearTables(spark, sf_dir, year)
    yr = F.col("ANIO_ARCHIVO") == year

    def strings(df, cols):
        return df.filter(yr).select(*[F.col(c).cast("string").alias(c) for c in cols])
    c = strings(A.stg_contratos(t), ["CLAVE_CONTRATO", "OCID", "ID_ENTREGA", "ID_CONTRATO",
                                     "ID_ADJUDICACION", "MONTO_CONTRATO", "MONEDA_CONTRATO",
                                     "MES_ARCHIVO", "ARCHIVO_ORIGEN"])
    r = A.stg_registros(t).withColumnsRenamed({
        "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL": "NOMBRE_ENTIDAD_CONTRATANTE",
        "NOMBRE_COMPRADOR_ORIGINAL": "NOMBRE_COMPRADOR"})
    r = strings(r, ["OCID", "ID_ENTREGA", "ID_LICITACION", "ID_ENTIDAD_CONTRATANTE",
                    "NOMBRE_ENTIDAD_CONTRATANTE", "ID_COMPRADOR", "NOMBRE_COMPRADOR",
                    "METODO_CONTRATACION", "CATEGORIA_PRINCIPAL", "MES_ARCHIVO", "ARCHIVO_ORIGEN"])
    p = A.stg_proveedores(t).withColumnRenamed("NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR")
    p = strings(p, ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR", "NOMBRE_PROVEEDOR",
                    "MES_ARCHIVO", "ARCHIVO_ORIGEN"])
    return c, r, p


def one_year_fact(spark, sf_dir, year: int = MODEL_YEAR) -> DataFrame:
    """WIN-6 + J-11 + J-13 + AGG-8/9 + PRJ-12/13: the one-year contract fact."""
    f, _, _, _ = OY.fact(*_inputs(spark, sf_dir, year))
    return f.select("CLAVE_CONTRATO", "OCID", "ID_ENTREGA", "MONTO_CONTRATO", "MES_ARCHIVO",
                    "REGISTRO_RELACIONADO", "ID_ENTIDAD_MODELO", "NOMBRE_ENTIDAD_MODELO",
                    "ORIGEN_ENTIDAD_MODELO", "CANTIDAD_PROVEEDORES", "IDS_PROVEEDORES",
                    "NOMBRES_PROVEEDORES", "TIENE_PROVEEDOR")


def one_year_quality(spark, sf_dir, year: int = MODEL_YEAR) -> DataFrame:
    """AGG-18 + WIN-7: quality table of the one-year model."""
    return OY.quality(*OY.fact(*_inputs(spark, sf_dir, year)))


QUERIES = {"one_year_fact": one_year_fact, "one_year_quality": one_year_quality}
