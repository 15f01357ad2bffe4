import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside, as further columns of an input
CLASHING = ["key", "size", "hash", "copies", "row", "shard", "found", "spans", "kind", "start", "length", "cell",
            "block", "score", "n", "part"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def messy_rows():
    """Nulls in every column, empty, blank and long texts, copies, near copies, repeated rows."""
    rng = random.Random(7)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [(0, base, "en", "a", len(base)), (1, base, None, "a", None), (2, " ".join(near), "en", None, 1),
            (3, None, "en", "b", None), (4, "", "de", "b", 0), (5, " \t\n ", None, None, 3),
            (6, "One two", "en", "", 7), (7, "one TWO", "en", "b", 7), (None, "no id here at all", "en", "c", 5),
            (8, words(rng, 30_000), "en", "a", None), (8, words(rng, 50), "fr", "a", 9),
            (9, "Straße Ünïcode ñandú 漢字 \U0001F600 é", "de", "c", 0), (10, "x" * 50_000, "en", "c", 1)]
    rows += [(20 + i, words(rng, rng.randint(1, 400)), "en", rng.choice("abc"), None) for i in range(60)]
    return rows + [rows[0], rows[3], rows[8], rows[20]]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark, messy):
    from pyspark.sql import functions as F
    return messy.select("*", *[F.lit("other").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(0, 80)] + [(None, 1, 0), (3, None, None)],
                                 "doc_id long, quality int, toxic int")
