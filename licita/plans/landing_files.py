"""Queries over landing files: sheets written from the whole test tables as
monthly CSV files, some of their lines broken, and read back through the
staging job (SRC-2, INC-3, INC-10, AGG-19, DQ-9, F-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layouts as LY
from ..session import scratch_path
from ..sources import schemas as SC
from . import jobs as J
from .adapters import Tables

HEADER = ["Open Contracting ID", "Entrega compilada:ID de Entrega", "Entrega compilada:Contratos:ID del Contrato",
          "Entrega compilada:Contratos:Valor:Monto", "Entrega compilada:Contratos:Fecha de firma"]
FIRST_YEAR = 1990  # the test tables begin before the packages do


def write_landing(spark: SparkSession, lines: DataFrame, root: str, sheet: str, header: list[str]) -> None:
    """(anio, mes, linea) as ``{root}/{YYYY}/{MM}/extraido/paquete_{sheet}.csv``: a
    file a month, its header first.  A CSV file is written by one task."""
    months = lines.select("anio", "mes").distinct().select("anio", "mes", F.lit(0).alias("orden"), F.lit(",".join(header)).alias("linea"))
    aside = scratch_path(spark, "landing-lines")
    (lines.select("anio", "mes", F.lit(1).alias("orden"), "linea").unionByName(months)
     .repartition("anio", "mes").sortWithinPartitions("anio", "mes", "orden").select("anio", "mes", "linea")
     .write.partitionBy("anio", "mes").text(aside))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.globStatus(hadoop.Path(f"{aside}/anio=*/mes=*/part-*")):  # names alone: files are moved, not read
        year, month = (part.getPath().getParent().getParent().getName()[5:], part.getPath().getParent().getName()[4:])
        folder = hadoop.Path(f"{root}/{year}/{int(month):02d}/extraido")
        fs.mkdirs(folder)
        fs.rename(part.getPath(), hadoop.Path(folder, f"paquete_{sheet}.csv"))


def firm_date(ship: Column) -> Column:
    """Signature date as the programs of different months wrote it: month first
    in every third month, else day first."""
    return F.when(F.month(ship) % 3 == 0, F.date_format(ship, "MM/dd/yyyy")).otherwise(F.date_format(ship, "dd/MM/yyyy"))


def contract_lines(t: Tables) -> DataFrame:
    """Every lineitem as a line of its month's file.  Some are broken: cut off
    after two cells, with a cell too many, or with bytes that are no text."""
    ship, k, pk = F.col("l_shipdate"), F.col("l_orderkey").cast("string"), F.col("l_partkey")
    cells = [k, F.col("l_linestatus"), F.col("l_linenumber").cast("string"),
             F.col("l_quantity").cast("bigint").cast("string"), firm_date(ship)]
    whole = F.concat_ws(",", *cells)
    line = (F.when(pk % 97 == 0, F.concat_ws(",", *cells[:2])).when(pk % 89 == 0, F.concat(whole, F.lit(",sobra")))
            .when(pk % 83 == 0, F.concat(whole, F.lit("�"))).otherwise(whole))
    return t("lineitem").select(F.year(ship).alias("anio"), F.month(ship).alias("mes"), line.alias("linea"))


def staged_landing(spark: SparkSession, sf_dir: str) -> str:
    """Runs the staging job on the landing files and gives its folder."""
    root, staging = scratch_path(spark, "landing"), scratch_path(spark, "staging")
    write_landing(spark, contract_lines(Tables(spark, sf_dir)), root, SC.SHEETS["contratos"], HEADER)
    J.run_staging(spark, root, staging, multi_line=False, first_year=FIRST_YEAR)
    return staging


def quarantined_rows(spark, sf_dir) -> DataFrame:
    """INC-3 + INC-10: the broken lines with their file's month, the reason and the
    text; the rest of their files is staged."""
    return spark.read.parquet(f"{staged_landing(spark, sf_dir)}/_cuarentena").select(
        "DATASET", "ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN", "MOTIVO", "REGISTRO")


def run_summary(spark, sf_dir) -> DataFrame:
    """AGG-19 + DQ-9: files and rows of the staging run, from observed totals."""
    return spark.read.parquet(f"{staged_landing(spark, sf_dir)}/_ejecucion").drop("INICIO", "FIN", "FORZADO")


def landing_controls(spark, sf_dir) -> DataFrame:
    """AGG-10 over landing files: read, staged, discarded and quarantined rows a file."""
    return spark.read.parquet(f"{staged_landing(spark, sf_dir)}/_control").drop("PROCESADO_EN")


def date_layouts(spark, sf_dir) -> DataFrame:
    """F-10: layout votes by month's file and column, and every date parsed by
    its file's layout (first and last, and how many are dates)."""
    l = Tables(spark, sf_dir)("lineitem")
    ship, receipt = F.col("l_shipdate"), F.expr("timestampadd(DAY, CAST(l_quantity AS INT), l_shipdate)")
    pk = F.col("l_partkey")
    raw = l.select(F.year(ship).alias("ANIO_ARCHIVO"), F.month(ship).alias("MES_ARCHIVO"),
                   # one line in 50 was typed the other way round
                   F.when(pk % 50 == 0, F.date_format(ship, "M-d-yyyy HH:mm:ss")).otherwise(firm_date(ship)).alias("FECHA_FIRMA"),
                   F.when(F.month(ship) % 2 == 0, F.date_format(receipt, "M.d.yyyy"))
                   .when(pk % 7 == 0, F.lit("31/31/1999")).otherwise(F.date_format(receipt, "yyyy-MM-dd")).alias("FECHA_FIN"))
    keys, columns = ["ANIO_ARCHIVO", "MES_ARCHIVO"], ["FECHA_FIRMA", "FECHA_FIN"]
    votes = LY.layout_votes(raw, keys, columns)
    parsed = LY.parse_dates(raw, keys, columns, votes)
    per = F.explode(F.array(*[F.struct(F.lit(c).alias("COLUMNA"), F.col(c).alias("f")) for c in columns]))
    seen = parsed.select(*keys, per.alias("v")).groupBy(*keys, F.col("v.COLUMNA").alias("COLUMNA")).agg(
        F.count("v.f").alias("FECHAS"), F.min("v.f").alias("PRIMERA"), F.max("v.f").alias("ULTIMA"))
    return votes.join(seen, [*keys, "COLUMNA"])


QUERIES = {"quarantined_rows": quarantined_rows, "run_summary": run_summary, "landing_controls": landing_controls,
           "date_layouts": date_layouts}
