"""Column profiles from sketches (A12) against exact figures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.operators import profiles

SF = "/root/testdata/sf0.01"


def _reports(df, parts):
    states = [profiles.profile_state(p) for p in parts]
    union = states[0]
    for s in states[1:]:
        union = union.unionAll(s)
    return {r["column_name"]: r for r in profiles.profile_report(profiles.merge_states(union)).collect()}


def test_errors_are_within_the_bounds(spark):
    t = fixtures.telemetry(spark, SF, with_event_id=True)
    t = t.withColumn("accData", F.when(F.col("event_id") % 3 == 0, F.lit("a third")).otherwise(F.col("accData")))
    t = t.withColumn("rpm", F.when(F.col("event_id") % 10 != 1, F.col("rpm"))).select("event_id", "deviceID", "timeStamp", "rpm", "speed", "accData")
    pdf = t.toPandas()
    parts = [t.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k) for k in range(4)]
    for got in (_reports(t, [t]), _reports(t, parts)):  # one batch, and four merged
        assert list(got) and [got[c]["position"] for c in t.columns] == list(range(1, 7))
        for c in t.columns:
            values = pdf[c].dropna()
            r = got[c]
            assert (r["rows"], r["nulls"]) == (len(pdf), len(pdf) - len(values))
            assert abs(r["distinct_values"] - values.nunique()) <= 0.08 * values.nunique() + 1, c
            if c == "accData":
                assert r["quantiles"] is None
                assert r["frequent"][0]["value"] == "a third"
                assert abs(r["frequent"][0]["count"] - (values == "a third").sum()) <= len(pdf) / profiles.TRACKED * 4
                continue
            numbers = values.astype("datetime64[us]").astype("int64") if c == "timeStamp" else values
            for share, q in zip(profiles.SHARES, r["quantiles"]):
                below, upto = (numbers < q).mean(), (numbers <= q).mean()
                assert below - 0.01 <= share <= upto + 0.01, (c, share)
    assert np.isclose(got["event_id"]["distinct_values"], len(pdf), rtol=0.08)


def test_one_scan_and_odd_tables(spark):
    t = fixtures.telemetry(spark, SF)
    plan = profiles.profile_state(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    odd = spark.createDataFrame([(None, None, float("nan")), (None, "x'y", 1.0)], "`a b` int, `it's` string, d double")
    for df in (odd, odd.limit(0)):
        got = {r["column_name"]: r for r in profiles.profile_report(profiles.profile_state(df)).collect()}
        n = df.count()
        assert [got[c]["rows"] for c in df.columns] == [n] * 3 and got["a b"]["nulls"] == n
        assert got["a b"]["quantiles"] is None and got["a b"]["distinct_values"] == 0
    merged = profiles.merge_states(profiles.profile_state(odd).unionAll(profiles.profile_state(odd.limit(0))))
    assert {r["rows"] for r in profiles.profile_report(merged).collect()} == {2}
