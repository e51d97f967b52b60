import datetime as dt
import math
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import labels, stats
from tidemark.operators import history, series

D = dt.date


def days(start, n):
    return [start + dt.timedelta(days=i) for i in range(n)]


def test_prepare_drops_incomplete_points(spark):
    rows = [("2026-03-01 12:00:00", 1, "A", 10.0), ("2026-03-01 12:00:00", None, "B", 11.0), ("2026-03-01 12:00:00", 3, "C", 12.0), ("2026-03-01 12:00:00", 4, "D", None)]
    out = series.prepare_points(spark.createDataFrame(rows, "time string, region_id int, region_name string, sst double")).collect()
    assert sorted(r.region_id for r in out) == [1, 3] and {r.date for r in out} == {D(2026, 3, 1)}


def test_daily_aggregate_keeps_null_keys(spark):
    df = spark.createDataFrame([(D(2026, 3, 1), 1, 10.0), (D(2026, 3, 1), 1, 12.0), (D(2026, 3, 1), None, 20.0)], "date date, region_id int, sst double")
    got = {r.region_id: (r.mean_sst_c, r.cell_count, r.min_sst_c, r.max_sst_c) for r in series.daily_aggregate(df, ("region_id",)).collect()}
    assert got == {1: (11.0, 2, 10.0, 12.0), None: (20.0, 1, 20.0, 20.0)}


def test_no_leap_calendar(spark):
    df = spark.createDataFrame([(D(2024, 2, 28),), (D(2024, 2, 29),), (D(2024, 3, 1),), (D(2024, 12, 31),), (D(2025, 12, 31),)], "date date")
    assert [r.day_of_year for r in series.no_leap(df).orderBy("date").collect()] == [59, 60, 365, 365]


def test_duplicate_climatology_is_an_error(spark):
    h = spark.createDataFrame([(1, 1, 10.0)], "region_id int, day_of_year int, mean_sst_c double")
    c = spark.createDataFrame([(1, 1, 9.0, 11.0, 3), (1, 1, 9.0, 11.0, 3)], "region_id int, day_of_year int, clim_mean_sst_c double, clim_p90_sst_c double, sample_size int")
    with pytest.raises(Exception, match="duplicate key"):
        series.join_climatology(h, c).collect()
    assert series.join_climatology(h, c.limit(1)).first().clim_p90_sst_c == 11.0


def test_anomalies_over_eight_days(spark):
    means = [20.0, 20.5, 21.0, 21.5, 22.0, 22.5, 23.0, 24.0]
    p90 = [20.0, 20.0, 20.0, 22.0, 22.0, 22.0, 22.0, 22.0]
    rows = [(d, 1, m, 19.0, p) for d, m, p in zip(days(D(2026, 1, 1), 8), means, p90)]
    out = series.with_anomalies(spark.createDataFrame(rows, "date date, region_id int, mean_sst_c double, clim_mean_sst_c double, clim_p90_sst_c double")).orderBy("date").collect()
    assert [r.above_p90 for r in out] == [False, True, True, False, False, True, True, True]
    assert out[0].rolling_7d_anomaly_c == 1.0 and math.isclose(out[7].rolling_7d_anomaly_c, sum(m - 19 for m in means[1:]) / 7)
    assert [r.warming_rate_7d_c for r in out] == [None] * 7 + [4.0]
    assert [r.anomaly_c for r in out] == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0] and out[6].rolling_7d_anomaly_c == 2.5
    assert [r.status_label for r in out] == ["Hot"] + ["Extreme"] * 7


def test_labels(spark):
    a = spark.createDataFrame([(None,), (0.49,), (0.5,), (1.0,), (1.5,)], "x double").select(labels.status(F.col("x")).alias("s")).collect()
    assert [r.s for r in a] == ["Unknown", "Normal", "Watch", "Hot", "Extreme"]
    b = spark.createDataFrame([(None,), (0.0,), (0.1,), (0.5,), (1.0,), (2.0,)], "x double").select(labels.severity(F.col("x")).alias("s")).collect()
    assert [r.s for r in b] == ["Unknown", "Threshold-only", "Weak", "Moderate", "Severe", "Extreme"]


def event_rows(spark, flags, start=D(2026, 1, 1), region=1, skip=()):
    rows = [
        (d, region, "R", "N", 20.0 + e, 19.0 + e, 20.0, 1.0 + e, e > 0)
        for i, (d, e) in enumerate(zip(days(start, len(flags)), flags)) if i not in skip
    ]
    return spark.createDataFrame(rows, "date date, region_id int, region_code string, region_name string, mean_sst_c double, clim_mean_sst_c double, clim_p90_sst_c double, anomaly_c double, above_p90 boolean")


def test_heat_event(spark):
    out = series.heat_events(event_rows(spark, [0.5, 1.0, 0.7, 0.2, 2.2, -1.0, -1.0, -1.0])).collect()
    assert len(out) == 1
    e = out[0]
    assert (e.start_date, e.end_date, e.duration_days, e.peak_date, e.max_exceedance_p90_c, e.severity_class, e.is_active) == (D(2026, 1, 1), D(2026, 1, 5), 5, D(2026, 1, 5), 2.2, "Extreme", False)
    assert e.event_id == str(uuid.uuid5(uuid.NAMESPACE_URL, "warm_event|region_id=1|start_date=2026-01-01"))


def test_active_event_and_gap(spark):
    assert series.heat_events(event_rows(spark, [1.0] * 5)).first().is_active
    assert series.heat_events(event_rows(spark, [1.0] * 8, skip=(4,))).count() == 0
    assert len(series.heat_events(event_rows(spark, [-1.0] * 4)).columns) == 17


def test_leap_day_splits_a_run_unless_bridged(spark):
    rows = series.event_days(event_rows(spark, [1.0] * 4, start=D(2024, 2, 27), skip=(2,)))
    assert series.event_runs(rows).select("run_id").distinct().count() == 2
    assert series.event_runs(rows, bridge_leap_day=True).select("run_id").distinct().count() == 1


def test_precedence_and_append(spark):
    low = spark.createDataFrame([(1, D(2026, 1, d), "final") for d in (1, 2, 3, 4)], "region_id int, date date, source string")
    high = spark.createDataFrame([(1, D(2026, 1, d), "preliminary") for d in (4, 5, 6)], "region_id int, date date, source string")
    got = {r.date.day: r.source for r in history.prefer(low, high).collect()}
    assert got == {1: "final", 2: "final", 3: "final", 4: "preliminary", 5: "preliminary", 6: "preliminary"}
    got = {r.date.day: r.source for r in history.append_missing(low, high).collect()}
    assert got[4] == "final" and len(got) == 6


def test_overlapping_events(spark):
    rows = [("old", D(2026, 1, 1), D(2026, 1, 3)), ("overlap", D(2026, 1, 8), D(2026, 1, 12)), ("inside", D(2026, 1, 11), D(2026, 1, 13)), ("future", D(2026, 2, 1), D(2026, 2, 9))]
    df = spark.createDataFrame(rows, "event_id string, start_date date, end_date date")
    assert {r.event_id for r in history.overlapping(df, "2026-01-10", "2026-01-20").collect()} == {"overlap", "inside"}
    assert history.overlapping(df.limit(0), "2026-01-10", "2026-01-20").columns == df.columns


def test_preliminary_window_needs_history(spark):
    final = spark.createDataFrame([(1, d, 1.0) for d in days(D(2026, 1, 1), 40)], "region_id int, date date, v double")
    new = spark.createDataFrame([(1, d, 2.0) for d in days(D(2026, 2, 10), 3)], "region_id int, date date, v double")
    out = history.preliminary_input(final, new, "2026-02-10").collect()
    assert len(out) == 33 and len({r.date for r in out}) == 33
    with pytest.raises(ValueError):
        history.preliminary_input(final, new, "2026-02-10", days=28)
    with pytest.raises(Exception, match="fewer than 29"):
        history.preliminary_input(final.filter("date > '2026-01-25'"), new, "2026-02-10").collect()


def test_quantile_and_t(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],), ([5.0],)], "v array<double>").select(stats.interpolated(F.col("v"), 0.9).alias("q")).collect()
    assert math.isclose(df[0].q, 3.6) and df[1].q == 5.0
    p = spark.createDataFrame([(0.0, 4.0), (2.776445105, 4.0), (12.7062047, 1.0), (2.048407, 28.0)], "t double, v double").select(stats.t_two_sided(F.col("t"), F.col("v")).alias("p")).collect()
    assert p[0].p == 1.0 and all(abs(r.p - 0.05) < 1e-6 for r in p[1:])
