"""Text cleaning and name standardisation as native Column expressions.

All functions take and return ``Column`` so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour) ----------------------
# Cell values that mean "no value" after cleaning.
NULL_TOKENS = ["", "nan", "None", "<NA>"]
# Characters kept by the standard-name rule and by the catalog-value rule.
NAME_KEEP_CLASS = "A-Z0-9Ñ& "
CATALOG_KEEP_CLASS = "A-Z0-9Ñ&/ -"
# Whitespace as Python's ``str.isspace`` defines it (the reference cleans with
# Python regular expressions, whose ``\s`` is Unicode-aware).  Java's ``\s``
# is ASCII-only, so the class is spelled out; it is valid in Java and RE2.
WS_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_RUN = WS_CLASS + "+"
# Role patterns over standardised roles (F-22).
BUYER_ROLE_PATTERN = "BUYER|PROCURINGENTITY|COMPRADOR|ENTIDAD CONTRATANTE"
SUPPLIER_ROLE_PATTERN = "SUPPLIER|PROVEEDOR"
# ---------------------------------------------------------------------------


def _accent_map() -> tuple[str, str]:
    """(from, to) strings for ``translate`` built by rule from Unicode data.

    Every code point in U+00A0..U+024F whose compatibility decomposition
    (NFKD, combining marks removed) is a single different character maps to
    it; combining marks U+0300..U+036F map to nothing (deleted).  This is the
    native equivalent of NFKD + drop-combining for Latin text.
    """
    src, dst, drop = [], [], []
    for cp in range(0x00A0, 0x0250):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch)
                       if not unicodedata.combining(c))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    for cp in range(0x0300, 0x0370):
        if unicodedata.combining(chr(cp)):
            drop.append(chr(cp))
    return "".join(src) + "".join(drop), "".join(dst)


ACCENT_FROM, ACCENT_TO = _accent_map()


def collapse_ws(c: Column) -> Column:
    """Unicode whitespace runs -> one space, then strip.  A text of visible ASCII
    alone has none and is not gone through by character class."""
    return F.when(c.rlike(r"[^\x21-\x7e]"), F.trim(F.regexp_replace(c, WS_RUN, " "))).otherwise(c)


def clean_text(c: Column) -> Column:
    """F-1: whitespace collapsed, stripped, null tokens -> NULL."""
    return null_tokens(collapse_ws(c.cast("string")))


def null_tokens(t: Column) -> Column:
    """Null tokens of a collapsed text -> NULL.  Pass a column reference where rows are
    many: a long expression is worked out for the test and again for the value."""
    return F.when(t.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def clean_text_keep_inner(c: Column) -> Column:
    """F-2 (one-year variant): strip ends and null tokens; inner text kept."""
    t = F.regexp_replace(c.cast("string"), rf"\A{WS_RUN}|{WS_RUN}\z", "")
    return F.when(t.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def normalize_id(c: Column) -> Column:
    """F-3: clean, then undo the spreadsheet float suffix ``123.0`` -> ``123``."""
    return no_float_suffix(clean_text(c))


def no_float_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"^([0-9]+)\.0$", "$1")


def strip_marks(c: Column) -> Column:
    """Upper-cased text with accents removed (native NFKD for Latin text).
    Plain ASCII (as many bytes as characters) has none and is not gone through."""
    u = F.upper(c)
    return F.when(F.octet_length(u) == F.length(u), u).otherwise(F.translate(u, ACCENT_FROM, ACCENT_TO))


def _standardise(c: Column, keep: str) -> Column:
    """Upper, accents removed, every run of characters outside ``keep`` (and
    of spaces) -> one space, stripped, empty -> NULL.

    One regex pass: replacing runs of non-kept characters *including spaces*
    by a single space equals "replace by space, then collapse spaces", and
    also covers Unicode whitespace (never a kept character).
    """
    kept = keep.replace(" ", "")
    t = F.trim(F.regexp_replace(strip_marks(c.cast("string")), f"[^{kept}]+", " "))
    return F.nullif(t, F.lit(""))


def standard_name(c: Column) -> Column:
    """F-4: upper, accents removed, only A-Z 0-9 & and space kept."""
    return _standardise(c, NAME_KEEP_CLASS)


def catalog_value(c: Column) -> Column:
    """F-5: like ``standard_name`` but ``/`` and ``-`` are kept as well."""
    return _standardise(c, CATALOG_KEEP_CLASS)


def normalize_header(name) -> str:
    """PRJ-1 for column names (driver-side metadata only, never data)."""
    if name is None:
        return ""
    return re.sub(r"\s+", " ", str(name)).strip()


def compare_name(name) -> str:
    """F-26: case-insensitive comparison form of a column name."""
    return normalize_header(name).casefold()


def cell_for_line(c: Column) -> Column:
    """F-29: cell text for a one-line export: NULL -> '', whitespace collapsed."""
    return F.coalesce(collapse_ws(c.cast("string")), F.lit(""))


def is_buyer_role(roles_std: Column) -> Column:
    """F-22: standardised roles name a buyer / contracting entity; NULL -> false."""
    return F.coalesce(roles_std.rlike(BUYER_ROLE_PATTERN), F.lit(False))


def is_supplier_role(roles_std: Column) -> Column:
    """F-22: standardised roles name a supplier; NULL -> false."""
    return F.coalesce(roles_std.rlike(SUPPLIER_ROLE_PATTERN), F.lit(False))
