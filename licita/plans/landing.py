"""Landing, catalog and export queries over the whole test tables.

* package catalog <- events (one listed package per event; ids repeat, some
  are missing; the files map depends on the event's JSON ``props``)
* landing files   <- documents grouped by (lang, source): one monthly
  workbook each, year from the language, month from the source number
* URLs            <- pages.url
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..sources import sinks as SK
from ..sources.schemas import FIRST_YEAR
from .adapters import Tables

AS_OF = "2026-06-30"
YEAR, SOURCE = 2022, "click"


def packages(t: Tables) -> DataFrame:
    e = t("events").select("event_id", "ts", "user_id", "event_type", "props")
    k = F.from_json("props", "k int").getField("k")
    year = (F.lit(2020) + F.col("event_id") % 5).cast("string")
    month = F.lpad((F.lit(1) + F.col("user_id") % 12).cast("string"), 2, "0")
    src = F.col("event_type")

    def url(fmt, scheme="https"):
        return F.concat(F.lit(f"{scheme}://datos.example.org/api/v1/file/"), src, F.lit(f"/{fmt}/"),
                        year, F.lit("/"), month, F.lit("/"))
    entries = F.array(
        F.struct(F.lit("csv").alias("key"), url("csv").alias("value")),
        F.struct(F.lit("xlsx").alias("key"), F.when(k % 2 == 0, url("xlsx")).alias("value")),
        F.struct(F.lit("xlsx_es").alias("key"),
                 F.when(k % 3 != 0, F.concat(url("xlsx"), F.lit("es"))).alias("value")),
        F.struct(F.lit("sha").alias("key"), F.when(k % 4 == 0, url("sha", "ftp")).alias("value")))
    files = F.map_from_entries(F.filter(entries, lambda x: x["value"].isNotNull()))
    return e.select(
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat_ws("-", src, year, month)).alias("id"),
        files.alias("files"), year.alias("year"), month.alias("month"), src.alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "ts", "event_id")


def catalog_formats(spark, sf_dir) -> DataFrame:
    """SRC-7 + F-30: every http(s) download URL of every listed package."""
    p = packages(Tables(spark, sf_dir)).withColumn("id", C.package_id())
    return C.package_urls(p)


def package_selection(spark, sf_dir) -> DataFrame:
    """SET-6 + PRJ-18 + S-8: dedup by id (last listed wins), one year and
    source, preferred format, ordered by month."""
    p = packages(Tables(spark, sf_dir))
    d = C.dedup_packages(p, [F.col("ts"), F.col("event_id")])
    return C.select_packages(d, YEAR, SOURCE).select(
        "PAQUETE_ID", "month", "timestamp", "FORMATO_ELEGIDO", "URL_DESCARGA")


def url_predicate(spark, sf_dir) -> DataFrame:
    """PRJ-19: downloadable-extension and contract-keyword predicates."""
    pg = Tables(spark, sf_dir)("pages").select("page_id", "url")
    name = F.regexp_extract(F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")),
                            r"([^/]*)$", 1)
    return pg.select("page_id", "url", C.looks_downloadable(F.col("url")).alias("DESCARGABLE"),
                     C.looks_like_contracts(F.concat(name, F.lit(" "), F.col("url")))
                     .alias("PARECE_CONTRATOS"))


def landing_files(t: Tables) -> DataFrame:
    d = t("documents").select("doc_id", "lang", "source", "n_chars")
    anio = (F.when(F.col("lang") == "en", 2022).when(F.col("lang") == "fr", 2023)
            .when(F.col("lang") == "de", 2024).when(F.col("lang") == "es", 2025))
    mes = F.lit(1) + F.regexp_extract("source", r"([0-9]+)$", 1).cast("int") % 14
    return d.groupBy(anio.alias("ANIO"), mes.alias("MES"), "lang", "source").agg(
        F.sum("n_chars").alias("BYTES"),
        F.count_if(F.col("n_chars") < 200).alias("COLUMNAS_FALTANTES"),
        F.count(F.lit(1)).cast("string").alias("FILAS_CONTRATOS")) \
        .withColumn("ARCHIVO", F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit(".xlsx")))


def landing_months(spark, sf_dir) -> DataFrame:
    """PRJ-17 + PRJ-20 + AGG-21 + F-28 + DQ-1: status of every expected month."""
    exp = C.expected_months(spark, range(FIRST_YEAR, int(AS_OF[:4]) + 1), F.lit(AS_OF).cast("date"))
    return C.month_status(exp, landing_files(Tables(spark, sf_dir)))


def landing_summary(spark, sf_dir) -> DataFrame:
    """AGG-17: months per state and total contract rows."""
    return C.landing_summary(landing_months(spark, sf_dir))


def unexpected_months(spark, sf_dir) -> DataFrame:
    """PRJ-17: landing periods that are not expected (invalid or future months)."""
    exp = C.expected_months(spark, range(FIRST_YEAR, int(AS_OF[:4]) + 1), F.lit(AS_OF).cast("date"))
    return C.unexpected_months(exp, landing_files(Tables(spark, sf_dir)))


def ordered_outputs(spark, sf_dir) -> DataFrame:
    """S-1/S-2/S-6 + F-15/F-17: top-10 orders by amount (the limit is the
    report) and a per-nation rank of customers by balance, total order."""
    from pyspark.sql import Window
    t = Tables(spark, sf_dir)
    top = (t("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
           .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10)
           .select(F.lit("TOP_PEDIDOS").alias("REPORTE"), F.col("o_orderkey").alias("CLAVE"),
                   F.col("o_totalprice").alias("VALOR"), F.year("o_orderdate").alias("ANIO"),
                   F.lit(None).cast("string").alias("GRUPO"), F.lit(None).cast("int").alias("RANGO")))
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), F.col("c_custkey"))
    ranked = (t("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
              .withColumn("RANGO", F.row_number().over(w)).filter(F.col("RANGO") <= 3)
              .select(F.lit("TOP_CLIENTES_NACION").alias("REPORTE"), F.col("c_custkey").alias("CLAVE"),
                      F.col("c_acctbal").alias("VALOR"), F.lit(None).cast("int").alias("ANIO"),
                      F.upper(F.trim(F.col("c_mktsegment"))).alias("GRUPO"), "RANGO"))
    return top.unionByName(ranked)


def random_sample(spark, sf_dir) -> DataFrame:
    """S-5: 20 contracts drawn at random with a fixed seed (sampling is the
    feature): by the hash of seed and key, so partitions do not matter."""
    drawn = F.md5(F.concat(F.lit("20260101|"), F.col("o_orderkey").cast("string")))
    return (Tables(spark, sf_dir)("orders").select("o_orderkey", "o_totalprice")
            .orderBy(drawn, "o_orderkey").limit(20))


def pipe_row_export(spark, sf_dir) -> DataFrame:
    """SNK-4 + F-29 + PRJ-7: every document as one ``a|b|c|d`` line (whole text)."""
    d = Tables(spark, sf_dir)("documents").select("doc_id", "lang", "source", "text")
    return SK.one_column_lines(d)


def separator_audit(spark, sf_dir) -> DataFrame:
    """F-27: cells containing the separator, per column (counted per cell)."""
    d = Tables(spark, sf_dir)("documents").select("doc_id", "lang", "source", "text")
    cols = d.columns
    agg = d.agg(*[F.count_if(F.col(c).cast("string").contains("|")).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("COLUMNA"), F.col(c).alias("CELDAS_CON_SEPARADOR")) for c in cols]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


QUERIES = {
    "catalog_formats": catalog_formats,
    "package_selection": package_selection,
    "url_predicate": url_predicate,
    "landing_months": landing_months,
    "landing_summary": landing_summary,
    "unexpected_months": unexpected_months,
    "ordered_outputs": ordered_outputs,
    "random_sample": random_sample,
    "pipe_row_export": pipe_row_export,
    "separator_audit": separator_audit,
}
