"""Landing files: listing (SRC-1), sheet scans by header name (SRC-2), lineage
from the path (PRJ-5), staging scans (SRC-3/5), catalog JSON (SRC-7).

Landing layout: ``{root}/{YYYY}/{MM}/extraido/{name}``, one tabular file per
sheet (CSV with header, or Parquet); spreadsheet decoding is not rebuilt.
"""

from __future__ import annotations

import csv
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from . import schemas as SC

PATH_PERIOD = r"/([0-9]{4})/([0-9]{1,2})/"


def list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """SRC-1: files under ``root`` matching ``glob`` (recursive), spreadsheet
    lock files (``~$``) skipped, sorted; content is never read here."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.filter(~name.startswith("~$")).withColumn("ARCHIVO", name).orderBy("path")


def valid_period(p: Column, first_year: int = SC.FIRST_YEAR, last_year: int | None = None) -> Column:
    """PRJ-5 check: the path holds a year from ``first_year`` (to ``last_year``,
    when given) and a month 1..12."""
    yi = F.regexp_extract(p, PATH_PERIOD, 1).try_cast("int")
    mi = F.regexp_extract(p, PATH_PERIOD, 2).try_cast("int")
    ok = (yi >= first_year) & mi.between(1, 12)
    if last_year is not None:
        ok = ok & (yi <= last_year)
    return F.coalesce(ok, F.lit(False))


def with_lineage(df: DataFrame, path_col: Column | None = None, first_year: int = SC.FIRST_YEAR,
                 last_year: int | None = None) -> DataFrame:
    """PRJ-5: ANIO_ARCHIVO / MES_ARCHIVO from the path, file name; a path
    without a valid year and month fails the job."""
    p = path_col if path_col is not None else F.col("_metadata.file_path")
    y = F.regexp_extract(p, PATH_PERIOD, 1)
    m = F.regexp_extract(p, PATH_PERIOD, 2)
    yi, mi = y.try_cast("int"), m.try_cast("int")
    ok = valid_period(p, first_year, last_year)
    return df.withColumns({
        "ANIO_ARCHIVO": F.when(ok, yi).otherwise(
            F.raise_error(F.concat(F.lit("periodo invalido en la ruta: "), p)).cast("int")),
        "MES_ARCHIVO": mi,
        # the regular expression ([^/]+)$ tries every place of every folder's name, row by row
        "ARCHIVO_ORIGEN": F.substring_index(p, "/", -1),
    })


def headers(spark: SparkSession, paths: list[str], fmt: str = "csv") -> tuple[dict, dict]:
    """Column names by path, and what went wrong by path for files that cannot
    be read.  The first lines of all CSV files come from one distributed pass
    (a header, never a row, reaches the driver); Parquet names are in the
    footers."""
    found: dict[str, tuple] = {}
    errors: dict[str, str] = {}
    if fmt == "csv":
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
            "value", F.monotonically_increasing_id().alias("i")).filter("at = 0")
        for r in lines.groupBy("path").agg(F.min_by("value", "i").alias("line")).collect():
            cells = next(csv.reader([r.line.lstrip("\ufeff")]), [])
            if "\ufffd" in r.line or "\x00" in r.line or not any(c.strip() for c in cells):
                errors[r.path] = "encabezado ilegible"
            else:
                found[r.path] = tuple(cells)
    else:
        for p in paths:
            try:
                found[p] = tuple(spark.read.format(fmt).load(p).columns)
            except Exception as e:  # noqa: BLE001  recorded by the caller, file by file
                errors[p] = str(e).splitlines()[0][:500]
    seen = {_plain(p) for p in (*found, *errors)}
    errors.update({p: "archivo vacio" for p in paths if _plain(p) not in seen})
    return found, errors


def _plain(path: str) -> str:
    """A path in one spelling of its scheme, to compare paths by."""
    return re.sub(r"^file:/+", "/", path)


BAD, PATH = "_MALA", "_RUTA"


def _field_names(header: tuple) -> list[str]:
    """Header cells as unique column names (blank and repeated ones numbered)."""
    seen: dict[str, int] = {}
    for c in header:
        seen[c.lower()] = seen.get(c.lower(), 0) + 1
    return [f"_c{i}" if not c.strip() else f"{c}{i}" if seen[c.lower()] > 1 else c for i, c in enumerate(header)]


def read_sheet(spark: SparkSession, paths: list[str], fmt: str = "csv", multi_line: bool = True,
               found: dict | None = None, keep_bad: bool = False, **period) -> DataFrame:
    """SRC-2: all-string rows of a sheet from many files with lineage.

    Files are grouped by header (names, not positions), each group is one
    scan, and groups are united by name (missing columns NULL, SET-4).
    ``multi_line`` allows line breaks inside quoted cells, at the price of one
    task a file; without it large files are split.  ``found`` passes headers
    that :func:`headers` has already given.

    ``keep_bad`` adds the file's path (PATH) and, for a CSV line that has not as many
    cells as the header, its text (BAD; NULL for good lines).  Such a frame
    must be written before it is queried for its bad lines alone.
    """
    if not paths:
        raise FileNotFoundError("no landing files")
    if found is None:
        found, errors = headers(spark, paths, fmt)
        if errors:
            raise ValueError(f"archivos ilegibles: {errors}")
    wanted = {_plain(p) for p in paths}
    groups: dict[tuple, list[str]] = {}
    for p, cols in found.items():
        if _plain(p) in wanted:
            groups.setdefault(cols, []).append(p)
    frames = []
    for cols, ps in groups.items():
        names = _field_names(cols) if fmt == "csv" else list(cols)
        df = _reader(spark, fmt, multi_line, names if keep_bad else None).load(ps)
        bad = F.col(BAD) if BAD in df.columns else F.lit(None).cast("string")
        extra = [bad.alias(BAD), F.col("_metadata.file_path").alias(PATH)] if keep_bad else []
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(T.normalize_header(c)) for c in df.columns if c != BAD],
                       *extra, F.col("_metadata.file_path").alias("_path"))
        frames.append(with_lineage(df, F.col("_path"), **period).drop("_path"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _reader(spark: SparkSession, fmt: str, multi_line: bool = True, names: list[str] | None = None):
    r = spark.read.format(fmt)
    if fmt == "csv":
        # every column a string: no inference
        r = r.option("header", True).option("inferSchema", False).option("multiLine", multi_line) \
            .option("encoding", "UTF-8")
        if names is not None:  # a line with other cells than these is handed on whole in BAD
            fields = [StructField(n, StringType()) for n in (*names, BAD)]
            r = r.schema(StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
    return r


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: all monthly partitions united by column name; fails when empty."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if not df.columns:
        raise FileNotFoundError(f"staging vacio: {path}")
    return df


def partition_inventory(spark: SparkSession, path: str, table: str) -> DataFrame:
    """SRC-5 + AGG-13: rows per partition file (footer counts when no column is read)."""
    df = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_name")
    return (df.groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("FILAS"))
            .select(F.lit(table).alias("TABLA"),
                    F.regexp_extract("file_path", r"anio=([0-9]+)", 1).cast("int").alias("ANIO"),
                    F.regexp_extract("file_path", r"mes=([0-9]+)", 1).cast("int").alias("MES"),
                    F.col("file_name").alias("ARCHIVO"), "FILAS",
                    F.when(F.col("FILAS") > 0, "OK").otherwise("VACIO").alias("ESTADO")))


CATALOG_SCHEMA = ("results array<struct<id:string, year:string, month:string, monthName:string,"
                  " source:string, timestamp:string, files:map<string,string>>>,"
                  " pagination struct<page:int, num_pages:int, total_results:int,"
                  " has_next:boolean, next_page_number:int>")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: package objects (files map + year + month + source) from catalog pages."""
    pages = spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path)
    pk = pages.select(F.explode("results").alias("p")).select("p.*")
    return pk.filter(F.col("files").isNotNull() & F.col("year").isNotNull()
                     & F.col("month").isNotNull() & F.col("source").isNotNull())
