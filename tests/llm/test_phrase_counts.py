"""Counts of the phrase scans are kept dealt by phrase; word numbers are stored by byte."""

import re

import numpy as np
import pytest

pytest.importorskip("xxhash")
from licita import session as SE  # noqa: E402
from licita.llm import phrases  # noqa: E402


def test_only_the_new_counts_are_exchanged(spark):
    old = [(1, 1, 2, 1, 5, None), (1, 2, 2, 1, 7, 3), (2, 1, 3, 2, 1, None)]
    new = [(1, 1, 2, 2, 4), (3, 3, 5, 4, 9)]
    df = spark.createDataFrame(old, "k1 long, k2 int, size int, start int, n long, known int").repartition("k1", "k2")
    state = SE.materialise_dealt(df, ["k1", "k2"], "counts")
    counted = spark.createDataFrame(new, "k1 long, k2 int, size int, start int, n long").repartition("k1", "k2")
    both = phrases.add_counts(state, counted)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    assert sorted((tuple(r) for r in both.collect()), key=lambda r: r[:2]) == [
        (1, 1, 2, 2, 9, None), (1, 2, 2, 1, 7, 3), (2, 1, 3, 2, 1, None), (3, 3, 5, 4, 9, None)]


@pytest.mark.parametrize("ids", [[], [0], [1, 255, 256, 70_000, 2**31 - 1, 0]])
def test_numbers_stored_by_byte_come_back(ids):
    ids = np.array(ids, np.int32)
    packed = phrases._planes(ids)
    assert len(packed) == 4 * len(ids) and (phrases._from_planes(packed) == ids).all()
    assert packed[len(ids):2 * len(ids)] == bytes((ids >> 8 & 255).astype(np.uint8))
