"""Scalar-function queries (F-1..F-11) over whole test tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import ruc as R
from ..functions import text as T
from .adapters import Tables


def clean_text(spark, sf_dir) -> DataFrame:
    """F-1 and F-2 over every document's full text."""
    d = Tables(spark, sf_dir)("documents").select("doc_id", "text")
    return d.select("doc_id",
                    T.clean_text(F.col("text")).alias("TEXTO_LIMPIO"),
                    T.clean_text_keep_inner(F.col("text")).alias("TEXTO_RECORTADO"))


def _id_variant(k: Column, v: Column) -> Column:
    ks = k.cast("string")
    return (F.when(v == 1, F.concat(ks, F.lit(".0")))
            .when(v == 2, F.concat(F.lit(" "), ks, F.lit(".0\t")))
            .when(v == 3, F.concat(ks, F.lit(".5")))
            .when(v == 4, F.lit("nan"))
            .when(v == 5, F.concat(F.lit("00"), ks))
            .when(v == 6, F.lit("  "))
            .otherwise(ks))


def normalize_id(spark, sf_dir) -> DataFrame:
    """F-3: spreadsheet ids ('123.0', padded, tokens) normalised, all lineitems."""
    l = Tables(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber")
    raw = _id_variant(F.col("l_orderkey"), F.col("l_linenumber"))
    return l.select("l_orderkey", "l_linenumber", raw.alias("ID_CRUDO"),
                    T.normalize_id(raw).alias("ID_NORMALIZADO"))


def standard_name(spark, sf_dir) -> DataFrame:
    """F-4 and F-5 over every document's full text."""
    d = Tables(spark, sf_dir)("documents").select("doc_id", "text")
    return d.select("doc_id", T.standard_name(F.col("text")).alias("NOMBRE_ESTANDAR"),
                    T.catalog_value(F.col("text")).alias("VALOR_CATALOGO"))


def _ruc_raw(k: Column) -> Column:
    r = F.concat(F.lit("20"), F.lpad(k.cast("string"), 9, "0"))
    v = k % 7
    return (F.when(v == 0, r)
            .when(v == 1, F.concat(F.lit("PE-RUC-"), r))
            .when(v == 2, F.concat(F.substring(r, 1, 2), F.lit("-"), F.substring(r, 3, 4),
                                   F.lit("."), F.substring(r, 7, 5)))
            .when(v == 3, F.concat(r, F.lit(".0")))
            .when(v == 4, F.concat(F.lit("1"), r))
            .when(v == 5, F.concat(F.lit("RUC "), r, F.lit(" / ALT 10"), r))
            .otherwise(F.lit(None).cast("string")))


def ruc_extract_validate(spark, sf_dir) -> DataFrame:
    """F-6..F-8 on taxpayer ids written seven ways, one per customer."""
    c = Tables(spark, sf_dir)("customer").select("c_custkey")
    raw = _ruc_raw(F.col("c_custkey"))
    ident = T.normalize_id(raw)
    fallback = F.concat(F.lit("ORG-"), F.lpad(F.col("c_custkey").cast("string"), 11, "7"))
    ruc = R.extract_ruc(ident)
    return c.select("c_custkey", raw.alias("IDENTIFICADOR"), ruc.alias("RUC"),
                    R.validate_ruc(ruc).alias("RUC_VALIDO"),
                    R.ruc_from(ident, fallback).alias("RUC_CON_RESPALDO"))


def _amount_text(x: Column, style: Column) -> Column:
    cents = F.round(x * 100).cast("bigint")
    ip = (cents / 100).cast("bigint")
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.format_number(ip, 0)
    return (F.when(style == 1, F.concat(grouped, F.lit("."), frac))
            .when(style == 2, F.concat(F.replace(grouped, F.lit(","), F.lit(".")), F.lit(","), frac))
            .when(style == 3, F.concat(F.lit("S/ "), ip.cast("string"), F.lit("."), frac))
            .when(style == 4, F.concat(F.lit("$"), grouped, F.lit(" ")))
            .when(style == 5, F.concat(ip.cast("string"), F.lit(","), frac))
            .when(style == 6, F.lit("sin monto"))
            .otherwise(F.lit("")))


def parse_number(spark, sf_dir) -> DataFrame:
    """F-9 + F-11: every line's amount written in seven local styles."""
    l = Tables(spark, sf_dir)("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    txt = _amount_text(F.col("l_extendedprice"), F.col("l_linenumber"))
    return l.select("l_orderkey", "l_linenumber", txt.alias("MONTO_TEXTO"),
                    N.parse_number(txt).alias("MONTO"),
                    N.to_number(F.col("l_returnflag"), "int").alias("BANDERA_NUMERO"))


def parse_date(spark, sf_dir) -> DataFrame:
    """F-10: every order date written in seven layouts, plus invalid text."""
    o = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_orderdate")
    v = F.col("o_orderkey") % 8
    od = F.col("o_orderdate")
    txt = (F.when(v == 0, F.date_format(od, "yyyy-MM-dd"))
           .when(v == 1, F.date_format(od, "dd/MM/yyyy"))
           .when(v == 2, F.date_format(od, "yyyy-MM-dd HH:mm:ss"))
           .when(v == 3, F.date_format(od, "yyyyMMdd"))
           .when(v == 4, F.lit("sin fecha"))
           .when(v == 5, F.concat(F.date_format(od, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
           .when(v == 6, F.concat(F.date_format(od, "yyyy-MM-dd HH:mm:ss"), F.lit(".250")))
           .otherwise(F.concat(F.date_format(od, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))))
    parsed = D.parse_date(txt)
    return o.select("o_orderkey", txt.alias("FECHA_TEXTO"), parsed.alias("FECHA"),
                    D.date_key(parsed).alias("FECHA_KEY"))


QUERIES = {
    "clean_text": clean_text,
    "normalize_id": normalize_id,
    "standard_name": standard_name,
    "ruc_extract_validate": ruc_extract_validate,
    "parse_number": parse_number,
    "parse_date": parse_date,
}
