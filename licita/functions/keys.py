"""Business keys, dimension keys and row hashes (F-12..F-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key prefixes and separators.
SEP = "|"
RUC_PREFIX = "RUC|"
ID_PREFIX = "ID|"
CURRENCY_PREFIX = "MONEDA|"
NO_CURRENCY = "MONEDA|SIN_MONEDA"


def pipe_key(*cols: Column) -> Column:
    """F-12: ``a|b|c``; any NULL part makes the key NULL (unlike concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SEP))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def hash_input(*cols: Column) -> Column:
    """F-14: fixed-arity ``concat_ws('|', coalesce(x, ''), ...)``."""
    return F.concat_ws(SEP, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def org_key(ruc: Column, ident: Column) -> Column:
    """'RUC|'+ruc, else 'ID|'+id, else NULL (a name never makes a key)."""
    return (F.when(ruc.isNotNull(), F.concat(F.lit(RUC_PREFIX), ruc))
            .when(ident.isNotNull(), F.concat(F.lit(ID_PREFIX), ident.cast("string")))
            .otherwise(F.lit(None).cast("string")))


def location_key(pais: Column, dep: Column, reg: Column, loc: Column) -> Column:
    """md5 of pais|departamento|region|localidad when any part is present."""
    anyv = pais.isNotNull() | dep.isNotNull() | reg.isNotNull() | loc.isNotNull()
    return F.when(anyv, F.md5(hash_input(pais, dep, reg, loc)))


def currency_key(code: Column, name: Column) -> Column:
    v = F.coalesce(code, name)
    return (F.when(v.isNotNull(), F.concat(F.lit(CURRENCY_PREFIX), F.upper(F.trim(v))))
            .otherwise(F.lit(NO_CURRENCY)))


def category_key(cat: Column) -> Column:
    return F.when(cat.isNotNull(), F.md5(F.upper(F.trim(cat))))


def method_key(method: Column, detail: Column) -> Column:
    anyv = method.isNotNull() | detail.isNotNull()
    return F.when(anyv, F.md5(F.concat_ws(
        SEP,
        F.upper(F.trim(F.coalesce(method, F.lit("")))),
        F.upper(F.trim(F.coalesce(detail, F.lit("")))))))


def amount_text(c: Column) -> Column:
    """Engine-independent text of an amount for hashing: decimal(28,4)."""
    return c.cast("decimal(28,4)").cast("string")


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def row_hash(key, entity, amount, currency, d1, d2, d3, descr) -> Column:
    """HASH_FILA: md5 over the 8 tracked attributes of a contract."""
    return F.md5(hash_input(key, entity, amount_text(amount), currency,
                            timestamp_text(d1), timestamp_text(d2),
                            timestamp_text(d3), descr))


def full_row_hash(*cols: Column) -> Column:
    """Optional wider change detector over every listed column."""
    return F.sha2(hash_input(*cols), 256)
