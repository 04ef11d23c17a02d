"""Exact percentiles by bracketing.

A mergeable sketch gives, in one scan, two values that enclose each percentile
but for a known error; a second scan counts what lies below each bracket and
gathers the few values inside it. What is shuffled is bounded by the limit per
bracket, not by the rows: a bracket that still holds more is narrowed by
another scan first, and one that the sketch placed wrongly is opened again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries of a sketch (its rank error is rows / ACCURACY), values gathered per
#: bracket, points that narrow a bracket.
ACCURACY, LIMIT, GRID = 10_000, 20_000, 512


@dataclass
class Ask:
    """A percentile (share 0 to 1) of the non-null values of a column of doubles."""
    name: str
    value: Column
    share: float
    rows: int = 0
    low: float | None = None   # None: open
    high: float | None = None
    expected: float = 0.0      # rows inside the bracket
    result: float | None = None

    def place(self) -> float:
        return self.share * (self.rows - 1)

    def below(self) -> Column:
        return F.lit(False) if self.low is None else self.value < F.lit(self.low)

    def inside(self) -> Column:
        up = F.lit(True) if self.high is None else self.value <= F.lit(self.high)
        return self.value.isNotNull() & up & (F.lit(True) if self.low is None else self.value >= F.lit(self.low))

    def holds(self, below: int, inside: int) -> bool:
        """Whether both neighbours of the place are inside; opens a side that is wrong."""
        first, last = math.floor(self.place()), math.ceil(self.place())
        wrong_low, wrong_high = below > first, below + inside <= last
        if wrong_low:
            self.low = None
        if wrong_high:
            self.high = None
        if wrong_low or wrong_high:
            self.expected = self.rows
        return not (wrong_low or wrong_high)


@dataclass
class Trace:
    """What the scans did: one entry a scan, and the values gathered in all."""
    scans: list[str] = field(default_factory=list)
    gathered: int = 0


def _first_brackets(df: DataFrame, asks: list[Ask], accuracy: int, limit: int, extra: Sequence[Column]):
    margin = 4 / accuracy
    shares = [[max(0.0, a.share - margin), min(1.0, a.share + margin)] for a in asks]
    row = df.agg(*[F.count(a.value).alias(f"n{i}") for i, a in enumerate(asks)],
                 *[F.percentile_approx(a.value, s, accuracy).alias(f"q{i}") for i, (a, s) in enumerate(zip(asks, shares, strict=True))],
                 *extra).first()
    for i, a in enumerate(asks):
        a.rows = row[f"n{i}"]
        if a.rows > limit:
            a.low, a.high = row[f"q{i}"]
            a.low, a.high = (a.low if shares[i][0] > 0 else None), (a.high if shares[i][1] < 1 else None)
            a.expected = a.rows * (2 * margin + 2 / accuracy)
        else:
            a.expected = a.rows
    return row


def _narrow(df: DataFrame, asks: list[Ask], accuracy: int, grid: int) -> None:
    points = [k / grid for k in range(grid + 1)]
    row = df.agg(*[F.count_if(a.below()).alias(f"b{i}") for i, a in enumerate(asks)],
                 *[F.count_if(a.inside()).alias(f"n{i}") for i, a in enumerate(asks)],
                 *[F.percentile_approx(F.when(a.inside(), a.value), points, accuracy).alias(f"q{i}") for i, a in enumerate(asks)]).first()
    for i, a in enumerate(asks):
        below, inside = row[f"b{i}"], row[f"n{i}"]
        if a.holds(below, inside):
            at = [(x - below) / inside * grid for x in (math.floor(a.place()), math.ceil(a.place()) + 1)]
            first, last = math.floor(at[0]) - 1, math.ceil(at[1]) + 1
            a.low, a.high = (a.low if first <= 0 else row[f"q{i}"][first]), (a.high if last >= grid else row[f"q{i}"][last])
            a.expected = inside * (last - first + 1) / grid


def _gather(df: DataFrame, asks: list[Ask], trace: Trace) -> list[Ask]:
    """Values around each place; the asks whose bracket did not hold it come back."""
    mask = F.lit(0).cast("long")
    some = F.lit(False)
    entries = []
    for i, a in enumerate(asks):
        mask = mask + F.when(a.below(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        some = some | F.coalesce(a.inside(), F.lit(False))
        entries.append(F.when(a.inside(), F.struct(F.lit(i).alias("ask"), a.value.alias("value"), F.lit(0).cast("long").alias("mask"))))
    # a row tells below which brackets it lies by one number; few rows have values to hand on
    own = F.struct(F.lit(-1).alias("ask"), F.lit(0.0).alias("value"), mask.alias("mask"))
    rows = df.select(F.explode(F.when(some, F.array_compact(F.array(own, *entries))).otherwise(F.array(own))).alias("e")).select("e.*")
    counts = rows.groupBy("ask", "value", "mask").agg(F.count(F.lit(1)).alias("n"))
    # at most 2 ** asks masks and the values of the brackets; one job does the rest
    lower = counts.filter("ask = -1").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("n"))), F.lit(0)) for i in range(len(asks))]).alias("belows"))
    ask = Window.partitionBy("ask").orderBy("value")
    placed = (counts.filter("ask >= 0").withColumn("upto", F.sum("n").over(ask.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("total", F.sum("n").over(Window.partitionBy("ask"))).withColumn("entries", F.count(F.lit(1)).over(Window.partitionBy("ask")))
              .join(F.broadcast(lower)).withColumn("below", F.expr("belows[ask]")))
    first, last = (F.array(*[F.lit(f(a.place())) for a in asks])[F.col("ask")] - F.col("below") for f in (math.floor, math.ceil))
    near = placed.filter(((F.col("upto") > first) & (F.col("upto") - F.col("n") <= last)) | (F.col("upto") == F.col("total")))
    found: dict[int, list] = {}
    for r in near.select("ask", "value", "n", "upto", "total", "entries", "below").collect():  # at most three a percentile
        found.setdefault(r["ask"], []).append(r)
    again = []
    for i, a in enumerate(asks):
        rows_found = found.get(i, [])
        below, total = (rows_found[0]["below"], rows_found[0]["total"]) if rows_found else (a.rows, 0)
        trace.gathered += rows_found[0]["entries"] if rows_found else 0
        if not a.holds(below, total):
            again.append(a)
            continue
        at, places = a.place(), (math.floor(a.place()), math.ceil(a.place()))
        low, high = (next(r["value"] for r in rows_found if r["upto"] - r["n"] <= x - below < r["upto"]) for x in places)
        a.result = low if places[0] == places[1] else (places[1] - at) * low + (at - places[0]) * high
    return again


def exact_percentiles(df: DataFrame, asks: list[Ask], extra: Sequence[Column] = (), accuracy: int = ACCURACY,
                      limit: int = LIMIT, grid: int = GRID) -> tuple[dict[str, float | None], tuple, Trace]:
    """Each ask's percentile, interpolated between its two neighbours (null
    without values); the values of the ``extra`` aggregates, taken in the first
    scan; and what the scans did. ``df`` is read two times, and once more for
    every factor of about ``grid`` / 5 that its rows exceed limit * accuracy / 10
    by; keep it cheap to read (a written table). Ties, infinities and NaN
    (after all numbers) are values like any other."""
    trace = Trace(["sketch"])
    row = _first_brackets(df, asks, accuracy, limit, extra)
    left = [a for a in asks if a.rows]
    while left:
        if any(a.expected > limit for a in left) and trace.scans.count("narrow") < 8:
            trace.scans.append("narrow")
            _narrow(df, left, accuracy, grid)
        else:
            trace.scans.append("gather")
            left = _gather(df, left, trace)
    return {a.name: a.result for a in asks}, tuple(row)[2 * len(asks):], trace
