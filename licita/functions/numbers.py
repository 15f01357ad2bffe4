"""Localized number parsing (F-9) and tolerant numeric coercion (F-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(c: Column) -> Column:
    """F-9: amounts written with either decimal convention.

    NBSP, spaces, ``S/`` and ``$`` are removed in that order; when both ``,``
    and ``.`` occur the later one is the decimal separator; a lone ``,`` is a
    decimal comma; other characters are dropped; failure -> NULL.
    """
    t = c.cast("string")
    for token in ["\u00a0", " ", "S/", "$"]:
        t = F.replace(t, F.lit(token), F.lit(""))
    rev = F.reverse(t)
    last_comma = F.instr(rev, ",")  # 1-based position from the end, 0 = absent
    last_dot = F.instr(rev, ".")
    both = (last_comma > 0) & (last_dot > 0)
    t = (F.when(both & (last_comma < last_dot),
                F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
         .when(both, F.replace(t, F.lit(","), F.lit("")))
         .when(last_comma > 0, F.replace(t, F.lit(","), F.lit(".")))
         .otherwise(t))
    t = F.regexp_replace(t, r"[^0-9.\-]", "")
    return t.try_cast("double")


def to_number(c: Column, dtype: str = "double") -> Column:
    """F-11 / F-19: coercion that yields NULL instead of failing."""
    return c.try_cast(dtype)
