"""Exact percentiles by bracketing (A14) against sorted values."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.operators.percentiles import Ask, exact_percentiles

SHARES = (0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0)


def plain(values, share):
    v = sorted(values)
    if not v:
        return None
    at = share * (len(v) - 1)
    low, high = v[math.floor(at)], v[math.ceil(at)]
    return low if at == math.floor(at) else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def asks(column="x"):
    return [Ask(f"p{s}", F.col(column), s) for s in SHARES]


def tables(n):
    rng = np.random.default_rng(5)
    yield "normal", rng.normal(size=n)
    yield "ties", rng.integers(0, 7, size=n).astype(float)
    yield "one value", np.full(n, 3.25)
    yield "a third equal", np.where(rng.random(n) < 1 / 3, 0.0, rng.exponential(size=n))
    yield "wide", rng.choice([-1e300, -1.0, 0.0, 5e-324, 1e300], size=n) * rng.random(n)


@pytest.mark.parametrize("accuracy, limit, grid", [(10_000, 20_000, 512), (200, 50, 16), (50, 300, 8)])
def test_equal_to_sorted_values(spark, accuracy, limit, grid):
    for name, values in tables(60_000):
        df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
        found, _, trace = exact_percentiles(df, asks(), (), accuracy, limit, grid)
        assert found == {f"p{s}": plain(values, s) for s in SHARES}, name
        assert trace.scans[0] == "sketch" and trace.scans[-1] == "gather"


def test_few_values_are_gathered_whatever_the_rows(spark):
    """Two scans; what is gathered follows the bracket, not the rows."""
    gathered = []
    for n in (50_000, 400_000):
        df = spark.range(n).select(F.xxhash64("id").cast("double").alias("x"))
        found, (rows,), trace = exact_percentiles(df, asks()[1:-1], [F.count(F.lit(1))])
        assert rows == n and trace.scans == ["sketch", "gather"]
        gathered.append(trace.gathered)
        values = [r.x for r in df.collect()]
        assert found == {f"p{s}": plain(values, s) for s in SHARES[1:-1]}
    assert all(g < 6 * 20_000 * 0.2 for g in gathered)
    # a limit below the bracket narrows it by one more scan
    _, _, trace = exact_percentiles(df, asks()[1:-1], (), 10_000, 100)
    assert trace.scans == ["sketch", "narrow", "gather"] and trace.gathered < 6 * 100


def test_a_wrong_bracket_is_opened(spark, monkeypatch):
    """A sketch that errs costs scans, never the result."""
    real, n = F.percentile_approx, 40_000
    values = [float(i % 9973) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    from fleetspark.operators import percentiles

    monkeypatch.setattr(percentiles.F, "percentile_approx", lambda c, s, a: real(c + 5000, s, a))
    found, _, trace = exact_percentiles(df, asks(), (), 10_000, 20_000)
    assert found == {f"p{s}": plain(values, s) for s in SHARES} and len(trace.scans) > 2


def test_empty_null_and_special_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("inf")), (None, float("-inf")), (None, float("nan"))], "x double, y double")
    found, _, _ = exact_percentiles(df, [Ask("none", F.col("x"), 0.5), Ask("low", F.col("y"), 0.0), Ask("mid", F.col("y"), 1 / 3),
                                         Ask("high", F.col("y"), 1.0)])
    assert found["none"] is None and found["low"] == float("-inf") and found["mid"] == 1.0 and math.isnan(found["high"])
    assert exact_percentiles(df.limit(0), [Ask("none", F.col("y"), 0.5)])[0] == {"none": None}
