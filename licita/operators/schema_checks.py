"""Schema checks on sheet headers and tables (PRJ-10, PRJ-11, SRC-6/11,
SNK-11, DQ-2, AGG-13, AGG-19).

Headers are metadata: they are compared as small DataFrames (one row per
column name), so the checks use the same join operators as the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compare_name, normalize_header

# Severities of missing columns.
SEV_ERROR = "ERROR"
SEV_WARNING = "ADVERTENCIA"


def missing_columns(spark: SparkSession, actual: Sequence[str], expected: Sequence[str],
                    sheet: str, mandatory: bool) -> DataFrame:
    """PRJ-10: expected columns absent from ``actual`` (case-insensitive,
    whitespace-normalised); ERROR for mandatory sheets, else ADVERTENCIA."""
    a = spark.createDataFrame([(compare_name(c),) for c in actual], "k string")
    e = spark.createDataFrame([(compare_name(c), normalize_header(c)) for c in expected],
                              "k string, COLUMNA string")
    sev = SEV_ERROR if mandatory else SEV_WARNING
    return e.join(a, "k", "left_anti").select(F.lit(sheet).alias("HOJA"), "COLUMNA",
                                              F.lit(sev).alias("SEVERIDAD"))


def require_columns(df: DataFrame, required: Sequence[str], label: str = "") -> DataFrame:
    """SRC-11: fail when any required column is missing from ``df``."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{label}: faltan columnas obligatorias {missing}")
    return df


def header_key(name) -> str:
    """PRJ-11 normal form: stripped, upper case, spaces to underscores."""
    return normalize_header(name).upper().replace(" ", "_")


def header_differences(spark: SparkSession, headers: dict[str, Sequence[str]]) -> DataFrame:
    """PRJ-11: positional comparison of every file's header with the first
    file's (the base); one row per differing position.  Headers are schema
    metadata (a few dozen names per file), compared on the driver."""
    files = list(headers)
    base = [header_key(c) for c in headers[files[0]]]
    rows = []
    for f in files[1:]:
        cols = [header_key(c) for c in headers[f]]
        for i in range(max(len(base), len(cols))):
            b = base[i] if i < len(base) else None
            c = cols[i] if i < len(cols) else None
            if b != c:
                rows.append((f, i + 1, b, c))
    return spark.createDataFrame(rows, "ARCHIVO string, POSICION int, ESPERADA string, "
                                       "ENCONTRADA string")


def append_checked(frames: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """SNK-11: strict header equality across files, then union, blank rows
    dropped; returns (rows, per-file read/written/blank counts)."""
    spark = next(iter(frames.values())).sparkSession
    diffs = header_differences(spark, {f: df.columns for f, df in frames.items()})
    if diffs.limit(1).count():
        bad = diffs.limit(20).collect()
        raise ValueError(f"encabezados distintos: {[tuple(r) for r in bad]}")
    tagged = None
    for f, df in frames.items():
        d = df.toDF(*[header_key(c) for c in df.columns]).withColumn("ARCHIVO_ORIGEN", F.lit(f))
        tagged = d if tagged is None else tagged.unionByName(d)
    data_cols = [c for c in tagged.columns if c != "ARCHIVO_ORIGEN"]
    blank = F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in data_cols]).isNull()
    counts = tagged.groupBy("ARCHIVO_ORIGEN").agg(
        F.count(F.lit(1)).alias("FILAS_LEIDAS"), F.count_if(~blank).alias("FILAS_ESCRITAS"),
        F.count_if(blank).alias("FILAS_VACIAS"))
    return tagged.filter(~blank), counts


def nonempty_rows(df: DataFrame) -> DataFrame:
    """DQ-2: data rows that are not entirely empty, per sheet file."""
    data_cols = [c for c in df.columns if c not in ("ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN")]
    return df.na.drop(how="all", subset=data_cols).groupBy("ARCHIVO_ORIGEN").agg(
        F.count(F.lit(1)).alias("FILAS_DATOS"))


def partition_summary(inventory: DataFrame) -> DataFrame:
    """AGG-13: files and rows per staging table."""
    return inventory.groupBy("TABLA").agg(F.count(F.lit(1)).alias("ARCHIVOS"),
                                          F.sum("FILAS").alias("FILAS"))


def run_summary(results: DataFrame, rows: DataFrame) -> DataFrame:
    """AGG-19: files found / processed / skipped / with errors per dataset, with the
    rows read, written, discarded and quarantined (``rows``: one row per dataset
    with FILAS_LEIDAS, FILAS_ESCRITAS, FILAS_CUARENTENA, CLAVES_DUPLICADAS) and
    whether they add up (DQ-9)."""
    counts = ["FILAS_LEIDAS", "FILAS_ESCRITAS", "FILAS_DESCARTADAS", "FILAS_CUARENTENA", "CLAVES_DUPLICADAS"]
    files = results.groupBy("DATASET").agg(
        F.count(F.lit(1)).alias("ARCHIVOS_ENCONTRADOS"),
        F.count_if(F.col("PROCESADO")).alias("ARCHIVOS_PROCESADOS"),
        F.count_if(~F.col("PROCESADO") & (F.col("ESTADO") != "ERROR")).alias("ARCHIVOS_OMITIDOS"),
        F.count_if(F.col("ESTADO") == "ERROR").alias("ARCHIVOS_CON_ERROR"))
    return files.join(rows, "DATASET", "left").select(
        *files.columns, *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts],
        (F.coalesce("FILAS_LEIDAS", F.lit(0)) == F.coalesce("FILAS_ESCRITAS", F.lit(0))
         + F.coalesce("FILAS_DESCARTADAS", F.lit(0)) + F.coalesce("FILAS_CUARENTENA", F.lit(0))).alias("CUADRA"))
