"""Sums that do not depend on the order of the rows, against whole-number arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest

from clickline.functions.sums import sum_exactly

DRAW = random.Random(8)
NAN, INF = float("nan"), float("inf")
CASES = {
    "cancel": [1e23, 1.0, -1e23, 0.1],
    "large": [1e23] * 3,
    "largest": [1.7e308, -1.7e308, 5.5],
    "cents": [0.01] * 1000,
    "long digits": [123456789.123456789, 0.000000123456789, 1e-12],
    "tiny": [2.0**-1060, 2.0**-1060, 1.0, -1.0],
    "mixed": [DRAW.uniform(-1, 1) * 10.0 ** DRAW.randrange(-30, 30) for _ in range(500)],
    "powers": [s * 2.0**e for e in range(-200, 200, 7) for s in (1, 1, -1)],
    "nulls": [None, 2.5, None],
    "only nulls": [None, None],
    "zeros": [0.0, -0.0, None],
    "nan": [NAN, 1.0],
    "both infinities": [INF, -INF, 1.0],
    "infinity": [INF, 1e308, None],
    "minus infinity": [-INF, 3.0],
}


def expected(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(not math.isfinite(v) for v in known):
        return sum(v for v in known if not math.isfinite(v))
    return float(sum(map(Fraction, known)))


@pytest.mark.parametrize("order", [1, 2])
def test_equals_whole_number_arithmetic(spark, order):
    rows = [(name, v) for name, values in CASES.items() for v in values]
    random.Random(order).shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, v double").repartition(order * 3)
    got = {r["k"]: r["s"] for r in sum_exactly(frame, ["k"], "v", "s").collect()}
    assert set(got) == set(CASES)
    for name, values in CASES.items():
        want = expected(values)
        same = got[name] is None if want is None else (math.isnan(want) and math.isnan(got[name])) or got[name] == want
        assert same, (name, got[name], want)


def test_null_keys_and_no_rows(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 2.0)], "k string, v double")
    assert [tuple(r) for r in sum_exactly(frame, ["k"], "v", "s").collect()] == [(None, 3.0)]
    assert sum_exactly(frame.limit(0), ["k"], "v", "s").count() == 0
