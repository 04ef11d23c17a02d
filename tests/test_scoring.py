"""Scores, categories, ranks and the §7.4 traps on small hand-written frames."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspark.config import DEFAULTS, REC_BATTERY, REC_COOLING, REC_NONE, Thresholds
from fleetspark.functions import scores
from fleetspark.operators import ranking
from fleetspark.plans import analytics

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "tripID int, deviceID int, timeStamp timestamp, speed double, rpm double, kpl double"


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_reading_trips_and_never_moving(spark):
    rows = [
        (1, 10, T0, 30.0, 2500.0, 5.0),          # device 10: only one-reading trips
        (2, 10, T0, 40.0, 2500.0, 5.0),
        (3, 20, T0, 0.0, 800.0, 3.0),            # device 20 never moves
        (3, 20, T0 + dt.timedelta(seconds=1), 0.0, 800.0, 3.0),
    ]
    df = readings(spark, rows)
    fixed = {r["deviceID"]: r for r in analytics.driver_behavior(df).collect()}
    assert fixed[10]["rapid_accel_count"] == 0 and fixed[10]["aggressive_event_count"] == 0
    assert fixed[10]["driver_safety_score"] == 100.0 and fixed[10]["driver_category"] == "Eco Driver"
    assert fixed[20]["avg_kpl_while_moving"] is None and fixed[20]["fuel_efficiency_score"] is None
    ref = {r["deviceID"]: r for r in
           analytics.driver_behavior(df, Thresholds(null_policy="reference")).collect()}
    assert ref[10]["aggressive_event_count"] is None
    assert ref[10]["driver_safety_score"] == 0.0 and ref[10]["driver_category"] == "Aggressive Driver"
    assert ref[20]["fuel_efficiency_score"] == 100.0


def test_category_and_tier_boundaries(spark):
    df = spark.createDataFrame([(80.0,), (79.999,), (60.0,), (50.0,), (49.999,)], "s double")
    got = df.select("s", scores.driver_category("s").alias("c"), scores.risk_tier("s").alias("t"),
                    scores.is_high_risk("s").alias("h")).collect()
    m = {r["s"]: (r["c"], r["t"], r["h"]) for r in got}
    assert m[80.0] == ("Eco Driver", "Normal", False)
    assert m[79.999] == ("Normal Driver", "Moderate Risk", False)
    assert m[60.0] == ("Normal Driver", "Moderate Risk", False)
    assert m[50.0] == ("Normal Driver", "High Risk", True)
    assert m[49.999][0] == "Aggressive Driver"


def test_recommendation_strict_shares(spark):
    base = dict(total_readings=100, dtc_count=0, low_battery_count=0, overheating_count=0,
                excessive_load_count=0, high_rpm_count=0)
    cases = [dict(base, low_battery_count=1), dict(base, low_battery_count=2),
             dict(base, overheating_count=5), dict(base, overheating_count=6)]
    df = spark.createDataFrame(cases)
    got = [r[0] for r in df.select(scores.maintenance_recommendation()).collect()]
    assert got == [REC_NONE, REC_BATTERY, REC_NONE, REC_COOLING]


def test_float_order_of_scores(spark):
    # (29 / 100) * 100 * 5 is 144.99999999999997, not 145: keep the original order.
    df = spark.createDataFrame([(29, 100)], "c long, t long")
    rate = df.select(scores.per_100("c", "t").alias("r")).first()["r"]
    assert rate * 5 == (29 / 100) * 100 * 5


def test_round4_half_up(spark):
    df = spark.createDataFrame([(2.00005,)], "x double")
    assert str(df.select(scores.round4_decimal("x")).first()[0]) == "2.0001"


def test_rate_text(spark):
    df = spark.createDataFrame([(1, 64), (0, 0), (847, 10000), (2, 3), (7, 200000), (9, 200000), (5, 5), (1, 1600),
                                (1 << 53, 195312500000)], "c long, t long")
    got = [r[0] for r in df.select(scores.rate_text("c", "t")).collect()]
    # 1/64 % is a tie in binary; 7/200000*100 is 0.0034999999999999996
    assert got == ["1.563", "0", "8.470", "66.667", "0.003", "0.005", "100.000", "0.063", "4611686.018"]


def test_rate_text_rounds_the_binary_value(spark):
    def fixed(x: float) -> str:
        n = int((Decimal(x) * 1000 + Decimal("0.5")).to_integral_value(rounding="ROUND_FLOOR"))
        return f"{n // 1000}.{n % 1000:03d}"

    random.seed(5)
    pairs = [(random.randint(0, t), t) for t in (random.choice([200000, 16000, 400000, random.randint(1, 10**9)]) for _ in range(3000))]
    df = spark.createDataFrame(pairs, "c long, t long")
    got = df.select("c", "t", scores.rate_text("c", "t").alias("r")).collect()
    assert [r["r"] for r in got] == [fixed(r["c"] / r["t"] * 100) for r in got]


def test_ranks_are_a_permutation_with_ties(spark):
    random.seed(7)
    rows = [(i, float(random.choice([100.0, 95.0, 90.0, 0.0]))) for i in range(1, 301)]
    df = spark.createDataFrame(rows, "deviceID int, driver_safety_score double")
    expected = [d for d, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for rows_per_partition in (7, 40, 10_000):
        out = ranking.driver_rank(df, rows_per_partition).collect()
        by_rank = sorted(out, key=lambda r: r["driver_rank"])
        assert [r["driver_rank"] for r in by_rank] == list(range(1, 301))
        assert [r["deviceID"] for r in by_rank] == expected, rows_per_partition


def test_scores_in_range_on_fixture(spark):
    from fleetspark import fixtures

    t = fixtures.telemetry(spark, "/root/testdata/sf0.001")
    d = analytics.driver_behavior(t)
    v = analytics.vehicle_health(t)
    bad = d.filter(~F.col("driver_safety_score").between(0, 100)
                   | ~F.coalesce(F.col("fuel_efficiency_score"), F.lit(0.0)).between(0, 100)).count()
    assert bad == 0
    assert v.filter(~F.col("vehicle_health_score").between(0, 100)).count() == 0
    assert d.count() == 15 and v.count() == 15


def test_percentile_score_extremes(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "deviceID int, events_per_100_readings double")
    got = {r["deviceID"]: r["percentile_safety_score"]
           for r in ranking.percentile_safety_score(df).collect()}
    assert got == {3: 0.0, 2: 50.0, 1: 100.0}


def test_thresholds_are_parameters(spark):
    rows = [(1, 1, T0, 10.0, 1500.0, 5.0)]
    df = readings(spark, rows)
    strict = Thresholds(high_rpm=1000.0)
    assert analytics.driver_behavior(df, strict).first()["high_rpm_count"] == 1
    assert analytics.driver_behavior(df, DEFAULTS).first()["high_rpm_count"] == 0


def test_percentile_equals_percent_rank(spark):
    random.seed(11)
    rows = [(i, random.choice([0.0, 0.0, 0.0, 1.5, 2.25, 7.0, 12.5, None])) for i in range(1, 501)]
    df = spark.createDataFrame(rows, "deviceID int, events_per_100_readings double")
    window = Window.orderBy(F.col("events_per_100_readings").desc_nulls_last())
    want = {r["deviceID"]: r["p"] for r in df.withColumn("p", F.percent_rank().over(window) * 100).collect()}
    for rows_per_partition in (20, 200, 10_000):  # with 20, one rate fills many partitions
        got = {r["deviceID"]: r["percentile_safety_score"]
               for r in ranking.percentile_safety_score(df, rows_per_partition=rows_per_partition).collect()}
        assert got == want


def test_fleet_scores_equal_separate_jobs(spark):
    from fleetspark import fixtures

    t = fixtures.telemetry(spark, "/root/testdata/sf0.001")
    d, v = analytics.fleet_scores(t)
    assert sorted(map(tuple, d.collect())) == sorted(map(tuple, analytics.driver_behavior(t).collect()))
    assert sorted(map(tuple, v.collect())) == sorted(map(tuple, analytics.vehicle_health(t).collect()))
    assert d.columns == analytics.driver_behavior(t).columns


def test_sentences_word_for_word(spark):
    """The console's sentences, from literal text (the oracle
    SQL builds them from the same templates as the engine)."""
    drivers = spark.createDataFrame([(5, "Aggressive Driver", 123, 45678), (6, "Eco Driver", 1, 1000), (7, "Normal Driver", 20, 400)],
                                    "deviceID int, driver_category string, aggressive_event_count long, total_readings long")
    got = [r[0] for r in drivers.select(scores.driver_explanation()).collect()]
    assert got == [
        "Device 5 is flagged as an Aggressive Driver because their combined rate of risky events (high RPM, rapid "
        "acceleration, hard braking) ranks them near the bottom of the fleet — 123 aggressive events across 45,678 readings "
        "(0.269% event rate). Safety score reflects this driver's relative standing versus the rest of the fleet, not an "
        "absolute safety certification.",
        "Device 6 is flagged as an Eco Driver because their event rate ranks near the top of the fleet — only 1 aggressive "
        "events across 1,000 readings (0.100% event rate).",
        "Device 7 is a Normal Driver — a moderate event rate (20 events across 400 readings, 5.000%) places them in the "
        "middle of the fleet's relative ranking."]
    columns = "high_rpm_count long, overheating_count long, excessive_load_count long, low_battery_count long, dtc_count long"
    vehicles = spark.createDataFrame(
        [(1, 10.0, 30, 1000, 1, 9, 2, 0, 0), (2, 60.0, 5, 1000, 4, 0, 4, 0, 0), (3, 99.0, 0, 2000, 0, 0, 0, 0, 0)],
        f"deviceID int, vehicle_health_score double, total_alert_count long, total_readings long, {columns}")
    high, moderate, normal = (r[0] for r in vehicles.select(scores.vehicle_explanation()).collect())
    assert high.startswith("Device 1 is flagged High Risk because it accumulated 30 health alerts across 1,000 readings (3.000% "
                           "alert rate) — most frequently ")
    assert high.endswith(" (9 occurrences). This is a relative ranking within the current fleet, based on alert frequency per reading.")
    assert moderate.startswith("Device 2 shows Moderate Risk — 5 alerts across 1,000 readings (0.500%), with ")
    assert moderate.endswith(" being the most common signal (4 occurrences). Worth monitoring, not yet urgent.")
    assert normal == ("Device 3 is operating Normally — only 0 alerts across 2,000 readings (0.000%), well within expected range "
                      "for this fleet.")
