"""Date parsing, yyyymmdd keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted input layouts, tried in order (first that parses wins),
# each with the text shape it can parse.
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyyMMdd",
]
DATE_SHAPES = [
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    # no day that the month never has: a parse that fails costs more than ten that do not
    r"^(?:[0-2][0-9]/(?:0[1-9]|1[0-2])|30/(?:0[13-9]|1[0-2])|31/(?:0[13578]|1[02]))/[0-9]{4}$",
    r"^[0-9]{8}$",
]
# ISO times with a fraction of a second, and with an offset or Z.
FRACTION_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{1,6}$"
ZONED_SHAPE = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"
               r"(Z|[+-][0-9]{2}:[0-9]{2})$")
# A day and a month in either order, with a year of four digits and perhaps a time.
PAIR_SHAPE = r"^[0-9]{1,2}([/.-])[0-9]{1,2}\1[0-9]{4}( [0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)?$"
# Spanish month names (1..12) and ISO weekday names (1=Monday).
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado",
                 "Domingo"]
# Valid range of the date dimension and its fallback bounds.
DATE_DIM_MIN = "2000-01-01"
DATE_DIM_MAX = "2100-12-31"
DATE_DIM_DEFAULT_FROM = "2022-01-01"
DATE_DIM_DEFAULT_TO = "2030-12-31"


def parse_date(c: Column, formats: list[str] | None = None) -> Column:
    """F-10: first layout that parses, per value; failures -> NULL.

    Each value is parsed on its own, so the order of rows does not matter.
    Dates with slashes are day first.  Times with an offset or ``Z`` become UTC.
    """
    s = F.trim(c.cast("string"))
    if formats is not None:
        return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    # a layout is only attempted on text of its shape: failed parses are the
    # expensive path, and a value has at most one matching shape
    plain = F.coalesce(*[F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(f)))
                         for shape, f in zip(DATE_SHAPES, DATE_FORMATS)]).cast("timestamp_ntz")
    # with an offset the time is moved to UTC, whatever the session's zone
    instant = F.when(s.rlike(ZONED_SHAPE), F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), s.try_cast("timestamp").cast("timestamp_ntz")))
    fraction = F.when(s.rlike(FRACTION_SHAPE), s.try_cast("timestamp_ntz"))
    return F.coalesce(plain, fraction, instant)


def parse_pair(s: Column, month_first: Column) -> Column:
    """A text of PAIR_SHAPE by the given order; NULL where that is no date."""
    # year, month, day, time in one pass; the cast takes a month or day of one digit
    turned = lambda order: F.regexp_replace(
        s, r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})(.*)$", order)
    return F.when(s.rlike(PAIR_SHAPE), F.when(month_first, turned("$3-$1-$2$4")).otherwise(turned("$3-$2-$1$4"))
                  .try_cast("timestamp_ntz"))


def parse_date_by(c: Column, month_first: Column) -> Column:
    """F-10 where the order of day and month is known (a layout per column)."""
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(PAIR_SHAPE), parse_pair(s, month_first)).otherwise(parse_date(s))


def date_key(c: Column) -> Column:
    """F-16: yyyymmdd integer, NULL-safe."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def period_key(year: Column, month: Column) -> Column:
    """yyyymm integer from file year and month."""
    return (year.cast("int") * 100 + month.cast("int")).cast("int")


def _name_lookup(names: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def calendar_columns(d: Column) -> dict[str, Column]:
    """F-21: calendar attributes of a date column."""
    iso_dow = F.weekday(d) + 1  # weekday(): 0 = Monday
    return {
        "FECHA": d,
        "FECHA_KEY": date_key(d),
        "ANIO": F.year(d),
        "SEMESTRE": ((F.month(d) - 1) / 6).cast("int") + 1,
        "TRIMESTRE": F.quarter(d),
        "MES_NUMERO": F.month(d),
        "MES_NOMBRE": _name_lookup(MONTH_NAMES, F.month(d)),
        "ANIO_MES": F.date_format(d, "yyyy-MM"),
        "DIA": F.dayofmonth(d),
        "DIA_SEMANA_NUMERO": iso_dow,
        "DIA_SEMANA_NOMBRE": _name_lookup(WEEKDAY_NAMES, iso_dow),
        "ES_FIN_SEMANA": iso_dow >= 6,
    }


def zero_pad_month(c: Column) -> Column:
    """F-24."""
    return F.lpad(c.cast("string"), 2, "0")
