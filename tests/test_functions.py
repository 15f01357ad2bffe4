"""Scalar functions against a brute-force Python rendering of the rules."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from licita.functions import dates as D
from licita.functions import numbers as N
from licita.functions import ruc as R
from licita.functions import text as T


# -- brute-force versions of the rules (plain Python, row at a time) --------

def py_clean(v):
    if v is None:
        return None
    t = re.sub(r"\s+", " ", str(v)).strip()
    return None if t in ("", "nan", "None", "<NA>") else t


def py_std(v, keep="A-Z0-9Ñ& "):
    if v is None:
        return None
    t = unicodedata.normalize("NFKD", str(v).strip().upper())
    t = "".join(c for c in t if not unicodedata.combining(c))
    t = re.sub(f"[^{keep}]+", " ", t)
    return re.sub(r"\s+", " ", t).strip() or None


def py_ruc(v):
    if v is None:
        return None
    t = str(v).strip()
    m = re.search(r"(?<![0-9])([0-9]{11})(?![0-9])", t)
    if m:
        return m.group(1)
    d = re.sub(r"[^0-9]", "", t)
    return d if len(d) == 11 else None


def py_valid(r):
    if r is None:
        return None
    if not re.fullmatch(r"[0-9]{11}", r):
        return False
    s = sum(int(r[i]) * w for i, w in enumerate([5, 4, 3, 2, 7, 6, 5, 4, 3, 2]))
    d = 11 - s % 11
    d = 0 if d == 10 else 1 if d == 11 else d
    return d == int(r[10])


def py_number(v):
    if v is None:
        return None
    t = str(v).strip()
    if not t:
        return None
    for tok in [" ", " ", "S/", "$"]:
        t = t.replace(tok, "")
    if "," in t and "." in t:
        t = t.replace(".", "").replace(",", ".") if t.rfind(",") > t.rfind(".") else t.replace(",", "")
    elif "," in t:
        t = t.replace(",", ".")
    t = re.sub(r"[^0-9.\-]", "", t)
    try:
        return float(t)
    except ValueError:
        return None


def run(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


TEXTS = [None, "", "nan", "None", "<NA>", "  Ministerio\tde\nSalud  ", "a b", "x y",
         "Compañía & Cía. S.A.C.", "Nº 5 ÁRBOL Çà", "straße", "Ñandú/Perú-Lima", "  ½ ²  ",
         "MUNICIPALIDAD   DISTRITAL\r\nDE  ANCÓN", "é́", "¡Hola! ¿Qué tal?"]


def test_clean_text(spark):
    assert run(spark, TEXTS, T.clean_text) == [py_clean(v) for v in TEXTS]


def test_standard_name_and_catalog(spark):
    got = run(spark, TEXTS, T.standard_name)
    want = [py_std(v) for v in TEXTS]
    # compatibility forms outside Latin-1/Extended (e.g. the fraction 1/2) are
    # the documented limit of the native form
    assert [g for g, w, v in zip(got, want, TEXTS) if v != "  ½ ²  " and g != w] == []
    got = run(spark, TEXTS, T.catalog_value)
    want = [py_std(v, "A-Z0-9Ñ&/ -") for v in TEXTS]
    assert [g for g, w, v in zip(got, want, TEXTS) if v != "  ½ ²  " and g != w] == []


def test_enye_and_ordinal_traps(spark):
    assert run(spark, ["Ñ", "Nº 12", "año"], T.standard_name) == ["N", "N 12", "ANO"]


def test_normalize_id(spark):
    vals = ["20549203931.0", " 00123.0 ", "12.5", "nan", None, "ABC.0"]
    assert run(spark, vals, T.normalize_id) == ["20549203931", "00123", "12.5", None, None, "ABC.0"]


RUCS = ["20549203931", "PE-RUC-20549203931", "20-5492.03931", "205492039310", "x 10123456789 y",
        "1234", None, "20549203931 / 10549203932", "abc"]


def test_extract_and_validate_ruc(spark):
    assert run(spark, RUCS, R.extract_ruc) == [py_ruc(v) for v in RUCS]
    ex = [py_ruc(v) for v in RUCS]
    assert run(spark, ex, R.validate_ruc) == [py_valid(v) for v in ex]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=99999999999), min_size=1, max_size=50))
def test_validate_ruc_property(spark, nums):
    vals = [str(n).zfill(11) for n in nums]
    assert run(spark, vals, R.validate_ruc) == [py_valid(v) for v in vals]


AMOUNTS = ["1.234,56", "1,234.56", "1,234", "1,234,567", "S/ 10", "", "texto", "S/.1,234.56",
           "1e5", "(100)", "-12,5", "$ 1 234,50", None, "1.5E+06", "12 345,6"]


def test_parse_number(spark):
    assert run(spark, AMOUNTS, N.parse_number) == [py_number(v) for v in AMOUNTS]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,-S/$  ab", max_size=12), min_size=1, max_size=40))
def test_parse_number_property(spark, vals):
    assert run(spark, vals, N.parse_number) == [py_number(v) for v in vals]


def test_parse_date_and_keys(spark):
    vals = ["2024-03-05", "05/03/2024", "2024-03-05 10:11:12", "2024-03-05T10:11:12",
            "20240305", "31/02/2024", "nan", None]
    got = run(spark, vals, lambda c: D.date_key(D.parse_date(c)))
    assert got == [20240305, 20240305, 20240305, 20240305, 20240305, None, None, None]


def test_calendar(spark):
    df = spark.createDataFrame([("2024-06-30",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(*[c.alias(k) for k, c in D.calendar_columns(F.col("d")).items()]).first()
    assert (r.FECHA_KEY, r.SEMESTRE, r.TRIMESTRE, r.MES_NOMBRE, r.DIA_SEMANA_NUMERO,
            r.DIA_SEMANA_NOMBRE, r.ES_FIN_SEMANA, r.ANIO_MES) == \
        (20240630, 1, 2, "Junio", 7, "Domingo", True, "2024-06")


@pytest.mark.parametrize("roles,buyer,supplier", [
    ("BUYER PROCURINGENTITY", True, False), ("SUPPLIER", False, True),
    ("ENTIDAD CONTRATANTE / PROVEEDOR", True, True), (None, False, False), ("TENDERER", False, False)])
def test_roles(spark, roles, buyer, supplier):
    assert run(spark, [roles], T.is_buyer_role) == [buyer]
    assert run(spark, [roles], T.is_supplier_role) == [supplier]
