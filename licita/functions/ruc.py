"""Taxpayer id (RUC) extraction and check-digit validation, native only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Check-digit weights of the 11-digit taxpayer id.
RUC_WEIGHTS = [5, 4, 3, 2, 7, 6, 5, 4, 3, 2]
RUC_LENGTH = 11


def extract_ruc(c: Column) -> Column:
    """F-6: first isolated run of exactly 11 digits; else all digits if 11."""
    t = F.trim(c.cast("string"))
    run = F.regexp_extract(t, r"(?<![0-9])([0-9]{11})(?![0-9])", 1)
    digits = F.regexp_replace(t, "[^0-9]", "")
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(run != "", run)
            .when(F.length(digits) == RUC_LENGTH, digits)
            .otherwise(F.lit(None).cast("string")))


def ruc_from(*cols: Column) -> Column:
    """F-7: RUC from the first column that yields one."""
    return F.coalesce(*[extract_ruc(c) for c in cols])


def validate_ruc(c: Column) -> Column:
    """F-8: NULL -> NULL; wrong shape -> false; else check digit test.

    Digits are taken arithmetically from one 64-bit value; the check digit
    ``(11 - s % 11) % 10`` equals the rule "10 -> 0, 11 -> 1".  Pass a column
    reference (not a long expression): the branches below reference it
    several times.
    """
    s = c.cast("string")
    n = s.try_cast("long")
    total = reduce(lambda a, b: a + b, [
        (n / F.lit(10 ** (RUC_LENGTH - 1 - i))).cast("long") % 10 * w
        for i, w in enumerate(RUC_WEIGHTS)])
    check = (F.lit(11) - total % 11) % 10
    return (F.when(s.isNull(), F.lit(None).cast("boolean"))
            .when(~s.rlike("^[0-9]{11}$"), F.lit(False))
            .otherwise(check == n % 10))
