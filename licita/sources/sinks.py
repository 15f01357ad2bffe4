"""Sinks: partition replacement, curated export, pipe CSVs, history, dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from ..functions import text as T

MAX_ROWS_PER_FILE = 5_000_000
# Pipe-CSV dialect of the curated export.
PIPE_OPTIONS = {"sep": "|", "quote": '"', "escape": '"', "header": "true"}


def _typed(df: DataFrame) -> DataFrame:
    """Trap: an all-NULL column must not be written as Parquet NULL type."""
    return df.select(*[F.col(f.name).cast("string") if isinstance(f.dataType, NullType)
                       else F.col(f.name) for f in df.schema.fields])


def write_months(df: DataFrame, path: str) -> None:
    """SNK-1: replace only the months present in ``df`` (dynamic partition
    overwrite; other months untouched), partitioned anio=YYYY/mes=MM."""
    out = _typed(df).withColumns({
        "anio": F.col("ANIO_ARCHIVO").cast("string"),
        "mes": F.lpad(F.col("MES_ARCHIVO").cast("string"), 2, "0")})
    # no shuffle into one task per month (a month can be terabytes): each task
    # clusters its rows by month and writes bounded files for the months it holds
    (out.sortWithinPartitions("anio", "mes").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
     .partitionBy("anio", "mes").option("compression", "snappy").parquet(path))


def export_table(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """SNK-2 (+ SNK-3 when ``csv_path``): ZSTD Parquet, optional pipe CSV."""
    t = _typed(df)
    t.write.mode("overwrite").option("compression", "zstd").parquet(path)
    if csv_path:
        t.write.mode("overwrite").options(**PIPE_OPTIONS).csv(csv_path)


def one_column_lines(df: DataFrame, cols: Sequence[str] | None = None,
                     name: str = "FILA") -> DataFrame:
    """SNK-4 + F-29 + PRJ-7: every row as one ``a|b|c`` cell; empty rows dropped."""
    cols = list(cols or df.columns)
    cells = [T.cell_for_line(F.col(c)) for c in cols]
    nonempty = F.greatest(*[F.length(c) for c in cells]) > 0 if len(cells) > 1 else F.length(cells[0]) > 0
    return df.filter(nonempty).select(F.concat_ws("|", *cells).alias(name))


def write_one_column_csv(df: DataFrame, path: str, header: str) -> None:
    """SNK-4: quote-all single-column CSV.  The joined header line is written
    to ``{path}/cabecera`` and the rows, in parallel part files, to
    ``{path}/filas`` (concatenate cabecera + filas for a single file); no
    single task carries the whole table."""
    spark = df.sparkSession
    spark.createDataFrame([(header,)], "FILA string").write.mode("overwrite") \
        .option("quoteAll", True).csv(f"{path}/cabecera")
    df.select("FILA").write.mode("overwrite").option("quoteAll", True).csv(f"{path}/filas")


def append_history(df: DataFrame, path: str) -> None:
    """SNK-6: one row per run appended."""
    _typed(df).write.mode("append").parquet(path)


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """SNK-10: column name and type per table, from schemas (metadata only)."""
    rows = [(t, i + 1, f.name, f.dataType.simpleString())
            for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "TABLA string, ORDEN int, COLUMNA string, TIPO string")


# Relationships of the curated star (from, to, key, cardinality).
RELATIONSHIPS = [
    ("fact_contrato_actual", "dim_entidad", "CLAVE_ENTIDAD = CLAVE_ORGANIZACION", "N:1"),
    ("fact_contrato_actual", "dim_ubicacion", "CLAVE_UBICACION_ENTIDAD = CLAVE_UBICACION", "N:1"),
    ("fact_contrato_actual", "dim_moneda", "CLAVE_MONEDA", "N:1"),
    ("fact_contrato_actual", "dim_categoria", "CLAVE_CATEGORIA", "N:1"),
    ("fact_contrato_actual", "dim_metodo", "CLAVE_METODO", "N:1"),
    ("fact_contrato_actual", "dim_fecha", "FECHA_FIRMA_KEY = FECHA_KEY", "N:1"),
    ("bridge_contrato_proveedor", "fact_contrato_actual", "CLAVE_CONTRATO", "N:1"),
    ("bridge_contrato_proveedor", "dim_proveedor", "CLAVE_PROVEEDOR = CLAVE_ORGANIZACION", "N:1"),
    ("dim_proveedor", "dim_ubicacion", "CLAVE_UBICACION", "N:1"),
]


def relationships(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RELATIONSHIPS, "DESDE string, HACIA string, LLAVE string, "
                                 "CARDINALIDAD string")
