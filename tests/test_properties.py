"""Property tests: Spark expressions against plain-Python statements of the
same rules, on generated inputs (each example is one Spark job)."""

from __future__ import annotations

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetspark.config import (
    AGGRESSIVE_DRIVER,
    ECO_DRIVER,
    NORMAL_DRIVER,
    REC_BATTERY,
    REC_COOLING,
    REC_DTC,
    REC_LOAD,
    REC_NONE,
    REC_RPM,
)
from fleetspark.functions import scores

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

counts = st.integers(min_value=0, max_value=5000)


def py_rate_text(c: int, t: int) -> str:
    if t <= 0:
        return "0"
    q = Fraction(c * 100, t) * 1000
    n = int(q + Fraction(1, 2))   # half up on the exact ratio
    return f"{n // 1000}.{n % 1000:03d}"


def py_recommendation(n, dtc, bat, hot, load, rpm) -> str:
    if dtc > 0:
        return REC_DTC
    if bat > n * 0.01:
        return REC_BATTERY
    if hot > n * 0.05:
        return REC_COOLING
    if load > n * 0.05:
        return REC_LOAD
    if rpm > n * 0.05:
        return REC_RPM
    return REC_NONE


def py_driver(agg: int, n: int) -> tuple[float, str]:
    score = max(0.0, 100.0 - ((agg / n) * 100) * 5.0)
    cat = ECO_DRIVER if score >= 80 else NORMAL_DRIVER if score >= 50 else AGGRESSIVE_DRIVER
    return score, cat


@SETTINGS
@given(st.lists(st.tuples(counts, counts), min_size=1, max_size=200))
def test_rate_text_matches_exact_rounding(spark, pairs):
    df = spark.createDataFrame(pairs, "c long, t long")
    got = [r[0] for r in df.select(scores.rate_text("c", "t")).collect()]
    assert got == [py_rate_text(c, t) for c, t in pairs]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3000), st.integers(0, 2), counts, counts, counts, counts),
                min_size=1, max_size=200))
def test_recommendation_cascade(spark, rows):
    rows = [(n, d, min(b, n), min(h, n), min(ld, n), min(r, n)) for n, d, b, h, ld, r in rows]
    df = spark.createDataFrame(rows, "total_readings long, dtc_count long, low_battery_count long, "
                                     "overheating_count long, excessive_load_count long, high_rpm_count long")
    got = [r[0] for r in df.select(scores.maintenance_recommendation()).collect()]
    assert got == [py_recommendation(*r) for r in rows]


@SETTINGS
@given(st.lists(st.tuples(counts, st.integers(1, 5000)), min_size=1, max_size=200))
def test_driver_score_and_category(spark, rows):
    rows = [(min(a, n), n) for a, n in rows]
    df = spark.createDataFrame(rows, "aggressive_event_count long, total_readings long")
    out = df.select(scores.per_100("aggressive_event_count", "total_readings").alias("r"))
    out = out.select(scores.driver_safety_score("r").alias("s"))
    got = [(r["s"], r["c"]) for r in out.select("s", scores.driver_category("s").alias("c")).collect()]
    assert got == [py_driver(a, n) for a, n in rows]
