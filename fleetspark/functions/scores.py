"""Scores, categories and display values (column expressions, C1-C16, T5).

Floating-point order is kept as in the original formulas: ``(count / total)
* 100`` first, the penalty multiplier afterwards, so boundary values (80, 60,
50) land on the same side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (
    AGGRESSIVE_DRIVER,
    DEFAULTS,
    ECO_DRIVER,
    ISSUE_NAMES,
    NORMAL_DRIVER,
    REC_BATTERY,
    REC_COOLING,
    REC_DTC,
    REC_LOAD,
    REC_NONE,
    REC_RPM,
    TIER_HIGH,
    TIER_MODERATE,
    TIER_NORMAL,
    Thresholds,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def per_100(count, total) -> Column:
    """(count / total) * 100 as double."""
    return (_c(count) / _c(total)) * 100


def penalty_score(rate, per_point: float) -> Column:
    """greatest(0, 100 - rate * per_point)."""
    return F.greatest(F.lit(0.0), F.lit(100.0) - _c(rate) * F.lit(per_point))


def driver_safety_score(rate="events_per_100_readings", th: Thresholds = DEFAULTS) -> Column:
    return penalty_score(rate, th.safety_penalty)


def fuel_efficiency_score(avg_kpl="avg_kpl_while_moving", th: Thresholds = DEFAULTS) -> Column:
    """least(100, avg / reference * 100).

    A driver who never moved has no average; the "fixed" policy leaves the
    score null instead of granting a perfect 100.
    """
    score = F.least(F.lit(100.0), (_c(avg_kpl) / F.lit(th.kpl_reference)) * 100)
    if th.null_policy == "fixed":
        return F.when(_c(avg_kpl).isNotNull(), score)
    return score


def driver_category(score="driver_safety_score", th: Thresholds = DEFAULTS) -> Column:
    s = _c(score)
    return (F.when(s >= F.lit(th.eco_min), F.lit(ECO_DRIVER))
            .when(s >= F.lit(th.normal_min), F.lit(NORMAL_DRIVER))
            .otherwise(F.lit(AGGRESSIVE_DRIVER)))


def vehicle_health_score(rate="alerts_per_100_readings", th: Thresholds = DEFAULTS) -> Column:
    return penalty_score(rate, th.health_penalty)


def is_high_risk(score="vehicle_health_score", th: Thresholds = DEFAULTS) -> Column:
    return _c(score) < F.lit(th.high_risk_below)


def maintenance_recommendation(th: Thresholds = DEFAULTS) -> Column:
    """Priority cascade over per-vehicle counts (strict ``>`` on shares)."""
    n = F.col("total_readings")
    return (F.when(F.col("dtc_count") > 0, F.lit(REC_DTC))
            .when(F.col("low_battery_count") > n * F.lit(th.battery_share), F.lit(REC_BATTERY))
            .when(F.col("overheating_count") > n * F.lit(th.overheat_share), F.lit(REC_COOLING))
            .when(F.col("excessive_load_count") > n * F.lit(th.load_share), F.lit(REC_LOAD))
            .when(F.col("high_rpm_count") > n * F.lit(th.rpm_share), F.lit(REC_RPM))
            .otherwise(F.lit(REC_NONE)))


def risk_tier(score="vehicle_health_score", th: Thresholds = DEFAULTS) -> Column:
    """Console tier (C9): High Risk / Moderate Risk / Normal."""
    s = _c(score)
    return (F.when(s < F.lit(th.high_risk_below), F.lit(TIER_HIGH))
            .when(s < F.lit(th.moderate_risk_below), F.lit(TIER_MODERATE))
            .otherwise(F.lit(TIER_NORMAL)))


def rate_text(count, total) -> Column:
    """count / total * 100 with three decimals, "0" without readings.

    As the browser's ``toFixed(3)``: the double is rounded by its exact binary
    value (0.0034999999999999996 is "0.003"), ties away from zero. 2000 times
    the value is taken exactly, as a product and its rounding error, so its
    whole part tells on which side of a half the value lies.
    """
    c, t = _c(count).cast("double"), _c(total).cast("double")
    x = c / t * 100
    p = x * 2000
    wide = x * 134217729.0  # splits x into two halves whose products are exact
    high = wide - (wide - x)
    error = (high * 2000 - p) + (x - high) * 2000
    whole = F.floor(p) - F.when((F.floor(p) == p) & (error < 0), 1).otherwise(0)
    n = F.floor((whole + 1) / 2).cast("long")
    txt = F.concat(F.floor(n / 1000).cast("string"), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0"))
    return F.when(t > 0, txt).otherwise(F.lit("0"))


def thousands(x) -> Column:
    """Whole number with thousands separators (``toLocaleString``)."""
    return F.format_number(_c(x).cast("long"), 0)


def top_issue_count() -> Column:
    return F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for _, c in ISSUE_NAMES])


def top_issue() -> Column:
    """Most frequent vehicle signal; ties go to the earlier name (T5)."""
    top = top_issue_count()
    expr = None
    for name, col in ISSUE_NAMES:
        cond = F.coalesce(F.col(col), F.lit(0)) == top
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


# --- fixed values: console sentences (must equal the original wording) ------
# {id} device, {n} event count, {t} readings with separators, {r} rate text.
DRIVER_SENTENCES = {
    AGGRESSIVE_DRIVER: ("Device {id} is flagged as an Aggressive Driver because their combined rate "
                        "of risky events (high RPM, rapid acceleration, hard braking) ranks them near "
                        "the bottom of the fleet — {n} aggressive events across {t} readings ({r}% "
                        "event rate). Safety score reflects this driver's relative standing versus "
                        "the rest of the fleet, not an absolute safety certification."),
    ECO_DRIVER: ("Device {id} is flagged as an Eco Driver because their event rate ranks near the "
                 "top of the fleet — only {n} aggressive events across {t} readings ({r}% event rate)."),
    NORMAL_DRIVER: ("Device {id} is a Normal Driver — a moderate event rate ({n} events across {t} "
                    "readings, {r}%) places them in the middle of the fleet's relative ranking."),
}
# {a} alert rows, {i} top issue, {k} its count.
VEHICLE_SENTENCES = {
    TIER_HIGH: ("Device {id} is flagged High Risk because it accumulated {a} health alerts across "
                "{t} readings ({r}% alert rate) — most frequently {i} ({k} occurrences). This is a "
                "relative ranking within the current fleet, based on alert frequency per reading."),
    TIER_MODERATE: ("Device {id} shows Moderate Risk — {a} alerts across {t} readings ({r}%), with "
                    "{i} being the most common signal ({k} occurrences). Worth monitoring, not yet "
                    "urgent."),
    TIER_NORMAL: ("Device {id} is operating Normally — only {a} alerts across {t} readings ({r}%), "
                  "well within expected range for this fleet."),
}


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Turn a ``{name}`` template into a concat of literals and columns."""
    import re

    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def driver_explanation() -> Column:
    """Per-category sentence for a driver row (C11)."""
    vals = {
        "id": F.col("deviceID"),
        "n": F.col("aggressive_event_count"),
        "t": thousands("total_readings"),
        "r": rate_text("aggressive_event_count", "total_readings"),
    }
    cat = F.col("driver_category")
    return (F.when(cat == AGGRESSIVE_DRIVER, fill_template(DRIVER_SENTENCES[AGGRESSIVE_DRIVER], vals))
            .when(cat == ECO_DRIVER, fill_template(DRIVER_SENTENCES[ECO_DRIVER], vals))
            .otherwise(fill_template(DRIVER_SENTENCES[NORMAL_DRIVER], vals)))


def vehicle_explanation(th: Thresholds = DEFAULTS) -> Column:
    """Per-tier sentence for a vehicle row with its top issue."""
    vals = {
        "id": F.col("deviceID"),
        "a": F.col("total_alert_count"),
        "t": thousands(F.coalesce(F.col("total_readings"), F.lit(0))),
        "r": rate_text("total_alert_count", F.coalesce(F.col("total_readings"), F.lit(0))),
        "i": top_issue(),
        "k": top_issue_count(),
    }
    tier = risk_tier(th=th)
    return (F.when(tier == TIER_HIGH, fill_template(VEHICLE_SENTENCES[TIER_HIGH], vals))
            .when(tier == TIER_MODERATE, fill_template(VEHICLE_SENTENCES[TIER_MODERATE], vals))
            .otherwise(fill_template(VEHICLE_SENTENCES[TIER_NORMAL], vals)))


def round4_decimal(x) -> Column:
    """Score as a 4-place decimal, half-up."""
    return F.round(_c(x), 4).cast("decimal(20,4)")


def decimal_to_native(x) -> Column:
    """Stored decimal back to a plain number."""
    return _c(x).cast("double")
