"""Backfill, streamed appends, staged publication, examples of failing rows, error paths."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import backfill, cells, projection, series, validate
from tidemark.sources import files
from tidemark.streaming import incremental

D = dt.date
DAYS = "date date, region_id int, mean_sst_c double"


@pytest.fixture
def where(tmp_path):
    return f"file://{tmp_path}/table", f"file://{tmp_path}/staging"


def built(spark, asked, value=1.0, bad=()):
    """Rows of two regions for each day; a day of `bad` fails when its rows are read."""

    def build(days):
        asked.append(len(days))
        rows = spark.createDataFrame([(d, r, value) for d in days for r in (1, 2)], DAYS)
        fails = F.raise_error(F.lit("unreadable file")).cast("double")
        return rows.withColumn("mean_sst_c", F.when(F.col("date").isin(list(bad)), fails).otherwise(F.col("mean_sst_c"))) if bad else rows

    return build


def stored(spark, table):
    return {(r.date, r.region_id): r.mean_sst_c for r in spark.read.parquet(table).collect()}


def test_backfill(spark, where):
    days = [D(2020, 1, 30) + dt.timedelta(i) for i in range(6)]
    first = backfill.backfill(spark, built(spark, []), days[:3], *where)
    assert (first.built_rows, first.added_rows, first.written, first.backup) == (6, 6, True, None)
    dry = backfill.backfill(spark, built(spark, [], 9.0), days, *where, dry_run=True)
    assert (dry.added_rows, dry.present_rows, dry.written) == (6, 6, False) and len(stored(spark, where[0])) == 6
    more = backfill.backfill(spark, built(spark, [], 9.0), days, *where)
    got = stored(spark, where[0])
    assert more.written and spark.read.parquet(more.backup).count() == 6
    assert len(got) == 12 and all(got[d, 1] == (1.0 if d in days[:3] else 9.0) for d in days)
    again = backfill.backfill(spark, built(spark, [], 5.0), days, *where)
    assert (again.added_rows, again.written) == (0, False) and stored(spark, where[0]) == got
    with pytest.raises(ValueError):
        backfill.backfill(spark, built(spark, []), [], *where)


def test_a_failing_day_costs_no_other(spark, where):
    days, asked = [D(2020, 3, 1) + dt.timedelta(i) for i in range(8)], []
    out = backfill.backfill(spark, built(spark, asked, bad=[days[5]]), days, *where)
    assert list(out.failed) == [days[5]] and "unreadable" in out.failed[days[5]] and out.added_rows == 14 and asked[0] == 8 and len(asked) <= 7
    assert days[5] not in {d for d, _ in stored(spark, where[0])}
    with pytest.raises(RuntimeError, match="no day was built"):
        backfill.backfill(spark, built(spark, [], bad=days[:2]), days[:2], *where)


def test_stored_duplicates_are_an_error(spark, where):
    rows = spark.createDataFrame([(D(2020, 1, 1), 1, 1.0)] * 2, DAYS)
    backfill.write_months(rows, where[0])
    with pytest.raises(RuntimeError, match="more than once"):
        backfill.backfill(spark, built(spark, []), [D(2020, 1, 2)], *where)


def test_valid_years_stay(spark, where):
    asked = []

    def build(year):
        asked.append(year)
        return spark.createDataFrame([(year, 1.0)], "y int, v double")

    valid = lambda df, year: df.count() == 1 and df.first().y == year
    assert backfill.build_years(spark, build, [2019, 2020], where[0], valid) == {2019: "built", 2020: "built"}
    spark.createDataFrame([(1, 1.0)], "y int, v double").write.mode("overwrite").parquet(f"{where[0]}/year=2020")
    assert backfill.build_years(spark, build, [2019, 2020, 2021], where[0], valid) == {2019: "kept", 2020: "built", 2021: "built"}
    assert asked == [2019, 2020, 2020, 2021]
    with pytest.raises(RuntimeError, match="2022"):
        backfill.build_years(spark, build, [2022], where[0], lambda df, y: False)


def test_streamed_appends(spark, tmp_path):
    """Rows that are late, twice in a batch, stored already or replayed add nothing."""
    target, source = f"file://{tmp_path}/t", f"file://{tmp_path}/s"
    row = lambda d, v, r=1: (D(2020, 1, d), r, v)
    spark.createDataFrame([row(1, 1.0), row(2, 1.0)], DAYS).write.parquet(target)
    run = lambda mark: incremental.append_missing(spark.readStream.schema(DAYS).parquet(source), target, f"file://{tmp_path}/{mark}").awaitTermination()
    spark.createDataFrame([row(2, 5.0), row(3, 5.0), row(3, 5.0)], DAYS).coalesce(1).write.parquet(source)
    run("a")
    assert stored(spark, target) == {(D(2020, 1, d), 1): v for d, v in ((1, 1.0), (2, 1.0), (3, 5.0))}
    spark.createDataFrame([row(1, 7.0), row(4, 7.0)], DAYS).coalesce(1).write.mode("append").parquet(source)
    run("a")
    run("b")  # another checkpoint: all files again
    assert spark.read.parquet(target).count() == 4 and stored(spark, target)[D(2020, 1, 4), 1] == 7.0


def test_nothing_is_published_if_a_check_fails(spark, where):
    target = files.Publication(spark, where[0])
    one, two = (spark.range(n) for n in (1, 2))
    seen = []
    target.publish({"t": one}, check=lambda staged: seen.append(staged["t"].count()))

    def refuse(staged):
        raise validate.ValidationError("no")

    with pytest.raises(validate.ValidationError):
        target.publish({"t": two}, check=refuse)
    assert seen == [1] and target.read("t").count() == 1


def test_examples_of_failing_rows(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = {r.check_name: (r.failing_rows, r.examples) for r in validate.with_examples(df, {"big": F.col("v") > 90, "none": F.col("v") < 0, "many": F.col("k") == 2}, ["k", "v"], 4).collect()}
    assert got == {"big": (9, ["0, 93", "0, 96", "0, 99", "1, 91"]), "none": (0, []), "many": (33, ["2, 2", "2, 5", "2, 8", "2, 11"])}
    twice = validate.duplicate_examples(df, ["k"], "twice", 2).first()
    assert (twice.failing_rows, twice.examples) == (3, ["0", "1"])


def test_empty_results_and_missing_months(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), "a", 1.0)], "date date, cell_id string, sst_c double")
    assert series.period(df, "2019-01-01", None, required=True).count() == 1
    with pytest.raises(ValueError, match="no rows from 2021"):
        series.period(df, "2021-01-01", "2021-12-31", required=True)
    assert cells.monthly_pivot(df, complete=False).first().mean_feb_sst_c is None
    with pytest.raises(Exception, match="no rows of cell a in feb"):
        cells.monthly_pivot(df).collect()


def test_gls_equals_whitened_least_squares(spark):
    """A gap in the months; the likelihood's best correlation against a fine search by brute force."""
    rng = np.random.default_rng(3)
    error, rows = 0.0, []
    for i in range(150):
        error = 0.6 * error + rng.normal() * 0.3
        if i not in (20, 21, 77):
            rows.append((1, D(2000 + i // 12, i % 12 + 1, 1), 15 + 0.02 * i / 12 + 3 * math.sin(i * math.pi / 6) + error, 2000 + i // 12, i % 12 + 1))
    df = spark.createDataFrame([*rows, *[(2, *r[1:]) for r in rows[:14]]], "region_id int, month_date date, mean_sst_c double, year int, month int")
    t = np.array([(r[3] - 2000) * 12 + r[4] - 1 for r in rows])
    x = np.column_stack([np.ones(len(t)), t / 12, *[(t % 12 + 1 == m).astype(float) for m in range(2, 13)]])
    y, n = np.array([r[2] for r in rows]), len(rows)

    def fit(rho):
        r = rho ** np.diff(t)
        white = lambda v: np.concatenate([v[:1], (v[1:] - r.reshape(-1, *[1] * (v.ndim - 1)) * v[:-1]) / np.sqrt(1 - r * r).reshape(-1, *[1] * (v.ndim - 1))])
        wx, wy = white(x), white(y)
        beta = np.linalg.lstsq(wx, wy, rcond=None)[0]
        rss = ((wy - wx @ beta) ** 2).sum()
        return -0.5 * ((n - 13) * np.log(rss) + np.log(1 - r * r).sum() + np.linalg.slogdet(wx.T @ wx)[1]), beta, math.sqrt(rss / (n - 13))

    for rho in (-0.3, 0.0, 0.7):
        got, (value, beta, sigma) = projection.gls_fits(df, rho).collect(), fit(rho)
        assert [g.region_id for g in got] == [1]  # the other has too few months
        assert np.allclose(got[0].beta, beta, atol=1e-9) and math.isclose(got[0].sigma, sigma, rel_tol=1e-9) and math.isclose(got[0].likelihood, value, rel_tol=1e-9)
    best = projection.gls_fits(df).first()
    tried = np.linspace(-0.98, 0.98, 4001)
    assert abs(best.rho - tried[np.argmax([fit(r)[0] for r in tried])]) < 5e-4
    out = projection.gls(df, base=(2000, 2012)).orderBy("month_date").collect()
    _, beta, sigma = fit(best.rho)
    want = beta[0] + beta[1] * (t[-1] + 1) / 12 + beta[(t[-1] + 1) % 12 + 1] if (t[-1] + 1) % 12 else beta[0] + beta[1] * (t[-1] + 1) / 12
    clim = np.mean([r[2] for r in rows if r[4] == out[0].month_date.month])
    assert len(out) == 120 and math.isclose(out[0].predicted_sst_c, want, rel_tol=1e-9) and math.isclose(out[0].predicted_anomaly_c, want - clim, abs_tol=1e-9)
    assert math.isclose(out[0].upper_sst_c - out[0].lower_sst_c, 3.92 * sigma, rel_tol=1e-9)
