"""Package catalog and landing checks (SRC-7, PRJ-17..20, SET-5/6, S-8, F-28/30,
AGG-17, AGG-21, DQ-1/DQ-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .versions import latest_by

# Format preference, downloadable extensions, contract keywords.
PREFERRED_FORMATS = ["xlsx_es", "xlsx"]
DOWNLOAD_EXTENSIONS = [".json", ".csv", ".xlsx", ".xls", ".zip", ".gz", ".sha", ".txt"]
CONTRACT_KEYWORDS = ["contrato", "contracts", "award", "adjudic", "ocds"]
# Landing month states and observations.
MISSING = "FALTANTE"
ERROR = "ERROR"
WARNING = "ADVERTENCIA"
OK = "OK"
OBS_MISSING = "No existe un archivo XLSX extraído para este mes."
OBS_MISSING_COLUMNS = "Existen columnas críticas faltantes."


def package_urls(packages: DataFrame, id_col: str = "id") -> DataFrame:
    """F-30: (package, format, url) for every http(s) value of the files map."""
    e = packages.select(F.col(id_col).alias("PAQUETE_ID"),
                        F.explode_outer("files").alias("FORMATO", "URL"))
    return e.filter(F.col("URL").rlike("^https?://"))


def choose_format(packages: DataFrame, prefs: Sequence[str] = PREFERRED_FORMATS) -> DataFrame:
    """PRJ-18: first available preferred format; packages without one are dropped."""
    fmt = F.coalesce(*[F.when(F.col("files")[p].isNotNull() & (F.col("files")[p] != ""),
                              F.lit(p)) for p in prefs])
    url = F.coalesce(*[F.when(F.col("files")[p] != "", F.col("files")[p]) for p in prefs])
    return packages.withColumns({"FORMATO_ELEGIDO": fmt, "URL_DESCARGA": url}) \
        .filter(F.col("FORMATO_ELEGIDO").isNotNull())


def package_id(id_col: str = "id") -> Column:
    """SET-6: the package id, or ``source-year-month`` when absent."""
    return F.coalesce(F.nullif(F.col(id_col), F.lit("")),
                      F.concat_ws("-", F.col("source"), F.col("year"), F.col("month")))


def dedup_packages(packages: DataFrame, order: Sequence[Column]) -> DataFrame:
    """SET-6: one package per id, the last one listed wins (``order`` = listing order)."""
    p = packages.withColumn("PAQUETE_ID", package_id())
    return latest_by(p, ["PAQUETE_ID"], list(order))


def select_packages(packages: DataFrame, year, source: str) -> DataFrame:
    """PRJ-18 + S-8: packages of one year and source with a chosen format,
    ordered by month number."""
    p = packages.filter((F.col("year").cast("string") == F.lit(str(year)))
                        & (F.col("source") == source))
    return choose_format(p).orderBy(F.col("month").try_cast("int"), "PAQUETE_ID")


def looks_downloadable(url: Column) -> Column:
    """PRJ-19: URL path (lower case) ends with a known file extension."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    return F.coalesce(F.greatest(*[path.endswith(e) for e in DOWNLOAD_EXTENSIONS]), F.lit(False))


def looks_like_contracts(name: Column) -> Column:
    """PRJ-19: file name contains a contract keyword (case-insensitive)."""
    n = F.lower(name)
    return F.coalesce(F.greatest(*[n.contains(k) for k in CONTRACT_KEYWORDS]), F.lit(False))


def expected_months(spark, years: Sequence[int], as_of: Column) -> DataFrame:
    """PRJ-17 + GEN-2: closed years 12 months, the as-of year up to its month,
    future years none."""
    y = spark.createDataFrame([(int(v),) for v in years], "ANIO int")
    last = (F.when(F.col("ANIO") < F.year(as_of), F.lit(12))
            .when(F.col("ANIO") == F.year(as_of), F.month(as_of)).otherwise(F.lit(0)))
    return y.select("ANIO", F.explode(F.sequence(F.lit(1), last)).alias("MES")) \
        .filter(F.col("MES") >= 1)


def month_status(expected: DataFrame, files: DataFrame) -> DataFrame:
    """PRJ-20 + AGG-21 + F-28: per expected month the file count, the largest
    file, its size in MB and rows, and OK / ADVERTENCIA / ERROR / FALTANTE.

    ``files``: ANIO, MES, ARCHIVO, BYTES, COLUMNAS_FALTANTES, FILAS_CONTRATOS.
    """
    per = files.groupBy("ANIO", "MES").agg(
        F.count(F.lit(1)).alias("CANTIDAD_ARCHIVOS"),
        F.max_by(F.struct("ARCHIVO", "BYTES", "COLUMNAS_FALTANTES", "FILAS_CONTRATOS"),
                 F.struct("BYTES", "ARCHIVO")).alias("p"))
    j = expected.join(per, ["ANIO", "MES"], "left")
    n = F.coalesce(F.col("CANTIDAD_ARCHIVOS"), F.lit(0))
    missing_cols = F.col("p.COLUMNAS_FALTANTES") > 0
    status = (F.when(n == 0, F.lit(MISSING)).when(missing_cols, F.lit(ERROR))
              .when(n > 1, F.lit(WARNING)).otherwise(F.lit(OK)))
    obs = (F.when(n == 0, F.lit(OBS_MISSING))
           .otherwise(F.concat_ws(" ",
                                  F.when(n > 1, F.concat(F.lit("Se encontraron "), n.cast("string"),
                                                         F.lit(" archivos XLSX."))),
                                  F.when(missing_cols, F.lit(OBS_MISSING_COLUMNS)))))
    return j.select("ANIO", "MES", n.cast("bigint").alias("CANTIDAD_ARCHIVOS"),
                    F.coalesce(F.col("p.ARCHIVO"), F.lit("")).alias("ARCHIVO_PRINCIPAL"),
                    F.coalesce(F.round(F.col("p.BYTES") / 1048576, 2), F.lit(0.0)).alias("TAMANO_MB"),
                    F.col("p.FILAS_CONTRATOS").alias("FILAS_CONTRATOS"),
                    status.alias("ESTADO"), obs.alias("OBSERVACION"))


def unexpected_months(expected: DataFrame, files: DataFrame) -> DataFrame:
    """PRJ-17 (other direction): periods present in landing but not expected."""
    return files.select("ANIO", "MES").distinct().join(expected, ["ANIO", "MES"], "left_anti")


def landing_summary(status: DataFrame) -> DataFrame:
    """AGG-17: months per state and total contract rows (non-numeric as 0)."""
    s = status.agg(
        F.count(F.lit(1)).alias("Meses esperados"),
        F.count_if(F.col("ESTADO") == OK).alias("Meses OK"),
        F.count_if(F.col("ESTADO") == WARNING).alias("Meses con advertencia"),
        F.count_if(F.col("ESTADO") == ERROR).alias("Meses con error"),
        F.count_if(F.col("ESTADO") == MISSING).alias("Meses faltantes"),
        F.sum(F.coalesce(F.col("FILAS_CONTRATOS").try_cast("bigint"), F.lit(0)))
        .alias("Filas de contratos"))
    names = s.columns
    rows = [F.struct(F.lit(n).alias("INDICADOR"), F.col(f"`{n}`").cast("bigint").alias("VALOR"))
            for n in names]
    return s.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
