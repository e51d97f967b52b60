"""Validation: each check is a row (check_name, failing_rows, ok); a suite is one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import history


#: Columns that anomalies, events and products of either must have.
ANOMALY = [
    "date", "region_id", "region_code", "region_name", "day_of_year", "mean_sst_c", "cell_count", "min_sst_c", "max_sst_c", "clim_mean_sst_c", "clim_p90_sst_c", "sample_size", "anomaly_c",
    "rolling_7d_anomaly_c", "rolling_30d_anomaly_c", "warming_rate_7d_c", "above_p90", "status_label",
]
EVENT = ["event_id", "region_id", "region_code", "region_name", "start_date", "end_date", "peak_date", "duration_days"]
PRODUCT = ["data_product", "is_provisional"]


class ValidationError(ValueError):
    """A suite has failing checks."""


def _rows(counts: DataFrame) -> DataFrame:
    """A one-row table of counts as rows."""
    names = counts.columns
    return rows_of(counts, {n: F.col(f"`{n}`") for n in names})


def rows_of(counts: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Numbers made of a one-row table's columns, as rows; null counts as none."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(c, F.lit(0)).cast("long").alias("failing_rows")) for n, c in checks.items()])
    return counts.select(F.explode(pairs).alias("c")).select("c.*").withColumn("ok", F.col("failing_rows") == 0)


def conditions(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows for which each condition holds, all in one pass; a null condition does not count."""
    return _rows(df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in checks.items()]))


def amount(df: DataFrame, name: str) -> DataFrame:
    """Rows of df as failures."""
    return _rows(df.agg(F.count(F.lit(1)).alias(name)))


def duplicates(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Keys that occur more than once."""
    return amount(df.groupBy(*key).count().filter("count > 1"), name)


def missing_columns(df: DataFrame, columns: Sequence[str], name: str = "missing_columns") -> DataFrame:
    n = len([c for c in columns if c not in df.columns])
    return df.sparkSession.range(1).select(F.lit(name).alias("check_name"), F.lit(n).cast("long").alias("failing_rows"), F.lit(n == 0).alias("ok"))


def empty(df: DataFrame, name: str = "empty") -> DataFrame:
    return _rows(df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias(name)))


def differs(df: DataFrame, value: Column, expected: int, name: str) -> DataFrame:
    """1 if an aggregate of df is not the expected number."""
    return _rows(df.agg(F.when(value == expected, 0).otherwise(1).alias(name)))


def suite(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def require(report: DataFrame) -> None:
    """Raise if a check of the report fails."""
    bad = report.filter(~F.col("ok")).select("check_name", "failing_rows").limit(50).collect()
    if bad:
        raise ValidationError("; ".join(f"{r['check_name']}: {r['failing_rows']}" for r in bad))


def preview(df: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The first duplicate keys, in order."""
    return df.groupBy(*key).count().filter("count > 1").orderBy(*key).limit(n)


def examples(df: DataFrame, checks: Mapping[str, Column], key: Sequence[str], n: int = 10) -> DataFrame:
    """For each check with failing rows, the first n of them by key: check_name, examples (array of the key as text).

    One pass over df; each task keeps n rows of a check before they meet.
    """
    names = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    rows = df.select(*[F.col(k) for k in key], text.alias("_text"), F.explode(names).alias("check_name"))
    first = F.row_number().over(Window.partitionBy("check_name").orderBy(*key))
    rows = rows.withColumn("_nth", first).filter(F.col("_nth") <= n)
    return rows.groupBy("check_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("_nth", "_text"))), lambda r: r["_text"]).alias("examples"))


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """Values to nine places, as labels compare them: the last bits of a sum, whose order Spark does not fix, do not decide at a limit."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def with_examples(df: DataFrame, checks: Mapping[str, Column], key: Sequence[str], n: int = 10) -> DataFrame:
    """`conditions` with up to n keys of failing rows for each check."""
    none = F.array().cast("array<string>")
    return conditions(df, checks).join(examples(df, checks, key, n), "check_name", "left").withColumn("examples", F.coalesce("examples", none))


def duplicate_examples(df: DataFrame, key: Sequence[str], name: str, n: int = 10) -> DataFrame:
    """`duplicates` with up to n keys."""
    twice = df.groupBy(*key).count().filter("count > 1")
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    first = twice.orderBy(*key).limit(n).select(*key, text.alias("_text")).agg(F.transform(F.sort_array(F.collect_list(F.struct(*key, "_text"))), lambda r: r["_text"]).alias("examples"))
    return amount(twice, name).join(F.broadcast(first))  # one row


def _null(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def _unfinite(name: str) -> Column:
    """Null, NaN or infinite."""
    c = F.col(name)
    return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))


def daily_rows() -> dict[str, Column]:
    return {"null_metrics": _null("mean_sst_c", "min_sst_c", "max_sst_c")}


def climatology_rows() -> dict[str, Column]:
    return {
        "day_out_of_range": ~F.col("day_of_year").between(1, 365), "null_values": _null("clim_mean_sst_c", "clim_p90_sst_c"),
        "bad_sample_size": F.col("sample_size").isNull() | (F.col("sample_size") <= 0),
    }


def anomaly_rows() -> dict[str, Column]:
    return {"null_anomaly": _null("anomaly_c"), "null_flag": _null("above_p90")}


def event_rows(latest: Column) -> dict[str, Column]:
    """`latest` is the last day of the anomalies."""
    return {
        "start_after_end": F.col("start_date") > F.col("end_date"), "peak_outside": ~F.col("peak_date").between(F.col("start_date"), F.col("end_date")),
        "bad_duration": F.col("duration_days") <= 0, "active_not_at_latest": F.col("is_active") & (F.col("end_date") != latest),
    }


def product_rows(prefix: str) -> dict[str, Column]:
    return {f"{prefix}_product": F.coalesce(F.col("data_product") != "preliminary", F.lit(True)), f"{prefix}_not_provisional": ~F.coalesce("is_provisional", F.lit(False))}


def preliminary_event_rows() -> dict[str, Column]:
    return {
        "event_start_after_end": F.col("start_date") > F.col("end_date"), "event_bad_duration": F.col("duration_days") <= 0,
        "event_peak_outside": ~F.col("peak_date").between(F.col("start_date"), F.col("end_date")), **product_rows("event"),
    }


def monitoring_rows() -> dict[str, Column]:
    return {
        "unknown_product": ~F.coalesce(F.col("data_product").isin("final", "preliminary"), F.lit(False)),
        "flag_inconsistent": (F.col("data_product") == "preliminary") != F.col("is_provisional"),
    }


def daily_history(df: DataFrame, entities: int = 6) -> DataFrame:
    return suite(
        missing_columns(df, history.DAILY), empty(df), differs(df, F.countDistinct("region_id"), entities, "region_count"),
        duplicates(df, ["date", "region_id"], "duplicate_keys"), amount(history.missing_dates(df), "missing_dates"),
        amount(history.missing_keys(df), "missing_region_dates"), conditions(df, daily_rows()),
    )


def climatology(df: DataFrame, entities: int = 6) -> DataFrame:
    return suite(
        differs(df, F.count(F.lit(1)), entities * 365, "row_count"), duplicates(df, ["region_id", "day_of_year"], "duplicate_keys"),
        conditions(df, climatology_rows()),
    )


def anomalies(df: DataFrame, daily: DataFrame, *, strict: bool = False) -> DataFrame:
    """Against the history without 29 February; `strict` counts that day too."""
    from .series import no_leap

    base = daily if strict else no_leap(daily)
    ends = lambda x, p: x.agg(F.count(F.lit(1)).alias(f"{p}n"), F.min("date").alias(f"{p}a"), F.max("date").alias(f"{p}b"), F.countDistinct("region_id").alias(f"{p}r"))
    last = df.groupBy("date").agg(F.countDistinct("region_id").alias("r")).agg(F.max_by("r", "date").alias("last_r"))
    both = ends(df, "x").join(F.broadcast(ends(base, "y"))).join(F.broadcast(last))  # one row each
    bad = lambda c: F.when(c, 0).otherwise(1)
    return suite(
        duplicates(df, ["date", "region_id"], "duplicate_keys"), conditions(df, anomaly_rows()),
        _rows(both.select(
            F.abs(F.col("xn") - F.col("yn")).alias("row_count_differs"), bad(F.col("xa") == F.col("ya")).alias("first_date_differs"),
            bad(F.col("xb") == F.col("yb")).alias("last_date_differs"), (F.col("yr") - F.col("last_r")).alias("regions_missing_on_last_date"),
        )),
    )


def events(df: DataFrame, rows: DataFrame) -> DataFrame:
    latest = rows.agg(F.max("date").alias("_latest"))
    checked = df.join(F.broadcast(latest))  # one row
    return suite(
        duplicates(df, ["event_id"], "duplicate_event_id"),
        conditions(checked, event_rows(F.col("_latest"))),
    )


def preliminary(daily: DataFrame, anomaly: DataFrame, event: DataFrame, entities: int = 6) -> DataFrame:
    last = anomaly.groupBy("date").agg(F.countDistinct("region_id").alias("r")).agg(F.max_by("r", "date").alias("r"))
    columns = {"sst": [*history.DAILY, *PRODUCT], "anomaly": [*ANOMALY, *PRODUCT], "event": [*EVENT, *PRODUCT]}
    return suite(
        *[missing_columns(df, columns[p], f"{p}_columns") for p, df in (("sst", daily), ("anomaly", anomaly), ("event", event))], empty(daily, "sst_empty"), empty(anomaly, "anomalies_empty"),
        duplicates(daily, ["date", "region_id"], "sst_duplicates"), duplicates(anomaly, ["date", "region_id"], "anomaly_duplicates"),
        differs(daily, F.countDistinct("region_id"), entities, "sst_regions"), conditions(daily, product_rows("sst")), conditions(anomaly, product_rows("anomaly")),
        amount(history.key_difference(daily, anomaly, ["region_id", "date"]), "key_sets_differ"),
        _rows(last.select(F.greatest(F.lit(entities) - F.coalesce("r", F.lit(0)), F.lit(0)).alias("latest_day_incomplete"))),
        duplicates(event, ["event_id"], "duplicate_event_id"),
        conditions(event, preliminary_event_rows()),
    )


def monitoring(actual: DataFrame, expected: DataFrame) -> DataFrame:
    problems = history.compare_products(expected, actual)
    n = lambda k: F.count(F.when(F.col("problem") == k, 1)).alias(f"{k}_rows")
    return suite(
        missing_columns(actual, [*ANOMALY, *PRODUCT]), empty(actual), duplicates(actual, ["region_id", "date"], "duplicate_keys"),
        conditions(actual, monitoring_rows()),
        _rows(problems.agg(n("missing"), n("extra"), n("wrong_product"))),
    )


def cell_year(df: DataFrame, domain: DataFrame, year: int) -> DataFrame:
    other = conditions(df, {"other_year": F.coalesce(F.year("date") != year, F.lit(True))})
    own = df.filter(F.year("date") == year)
    shape = own.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("date").alias("d"), F.countDistinct("cell_id").alias("c"))
    uneven = own.groupBy("date").agg(F.countDistinct("cell_id").alias("c")).agg(F.max("c").alias("most"), F.count(F.lit(1)).alias("_"), F.min("c").alias("least"))
    days = 366 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 365
    agree = own.select("cell_id", "longitude", "latitude").distinct().join(domain.select("cell_id", F.col("longitude").alias("_x"), F.col("latitude").alias("_y")), "cell_id")
    return suite(
        empty(own), other, conditions(own, {"null_or_unfinite": _unfinite("sst_c"), "null_keys": _null("date", "cell_id")}), duplicates(own, ["date", "cell_id"], "duplicate_keys"),
        amount(history.key_difference(domain, own, ["cell_id"]), "cell_set_differs"),
        conditions(agree, {"coordinates_differ": (F.abs(F.col("longitude") - F.col("_x")) > 1e-9) | (F.abs(F.col("latitude") - F.col("_y")) > 1e-9)}),
        _rows(shape.select((F.lit(days) - F.col("d")).alias("days_missing"), (F.col("d") * F.col("c") - F.col("n")).alias("row_product_differs"))),
        _rows(uneven.select((F.col("most") - F.col("least")).alias("cells_per_date_differ"))),
    )


def _one_place(df: DataFrame) -> DataFrame:
    return amount(df.select("cell_id", "longitude", "latitude").distinct().groupBy("cell_id").count().filter("count > 1"), "moved_cells")


def trend_input(df: DataFrame, year: int) -> DataFrame:
    other = conditions(df, {"other_year": F.coalesce(F.year("date") != year, F.lit(True))})
    own = df.filter(F.year("date") == year)
    days = 366 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 365
    short = own.groupBy("cell_id").agg(F.countDistinct("date").alias("d")).filter(F.col("d") < days)
    return suite(
        empty(own), other, duplicates(own, ["date", "cell_id"], "duplicate_keys"), conditions(own, {"null_or_unfinite": _unfinite("sst_c")}),
        _one_place(own), amount(short, "cells_without_all_days"),
    )


def annual_means(df: DataFrame, start: int, end: int) -> DataFrame:
    years = F.array_distinct(F.collect_list("year"))
    every = F.sequence(F.lit(start), F.lit(end))
    wrong = df.groupBy("cell_id").agg((F.size(F.array_except(every, years)) + F.size(F.array_except(years, every))).alias("d")).filter("d > 0")
    return suite(
        duplicates(df, ["cell_id", "year"], "duplicate_keys"), _one_place(df),
        conditions(df, {"null_or_unfinite": _unfinite("annual_mean_sst_c"), "bad_count": F.col("observation_count") <= 0, "outside_years": ~F.col("year").between(start, end)}),
        amount(wrong, "cells_with_other_years"),
    )


def features(cells: DataFrame, out: DataFrame, columns: Sequence[str]) -> DataFrame:
    short = cells.groupBy("cell_id").agg(F.countDistinct(F.month("date")).alias("m")).filter("m < 12")
    return suite(
        duplicates(cells, ["date", "cell_id"], "duplicate_keys"), conditions(cells, {"null_input": _null("date", "cell_id", "sst_c")}), _one_place(cells),
        amount(short, "cells_without_all_months"), conditions(out, {f"unfinite_{c}": _unfinite(c) for c in columns}),
    )


def publication(features_: DataFrame, trends: DataFrame, size: float) -> DataFrame:
    both = features_.select("cell_id", "longitude", "latitude", F.col("observation_count").alias("n")).join(
        trends.select("cell_id", F.col("longitude").alias("_x"), F.col("latitude").alias("_y"), F.col("observation_count").alias("m")), "cell_id"
    )
    return suite(
        duplicates(features_, ["cell_id"], "duplicate_features"), duplicates(trends, ["cell_id"], "duplicate_trends"),
        conditions(features_, {"unfinite_mean": _unfinite("mean_sst_c")}), conditions(trends, {"unfinite_trend": _unfinite("trend_c_per_year")}),
        amount(history.key_difference(features_, trends, ["cell_id"]), "cell_sets_differ"),
        conditions(both, {"coordinates_differ": (F.abs(F.col("longitude") - F.col("_x")) > 1e-10) | (F.abs(F.col("latitude") - F.col("_y")) > 1e-10), "counts_differ": F.col("n") != F.col("m")}),
        conditions(features_.limit(1), {"bad_cell_size": F.lit(size <= 0)}),
    )


def constraints(trends: DataFrame, features_: DataFrame, daily: DataFrame, regions: DataFrame) -> DataFrame:
    from .cells import MONTHS

    return suite(
        conditions(daily, {f"null_daily_{c}": F.col(c).isNull() for c in ("date", "region_id", "mean_sst_c")}), conditions(features_, {f"null_feature_{c}": F.col(c).isNull() for c in ("cell_id", "longitude", "latitude", "mean_sst_c")}),
        conditions(trends, {f"null_trend_{c}": F.col(c).isNull() for c in ("cell_id", "trend_c_per_year", "baseline_start_year", "baseline_end_year")}),
        amount(daily.join(regions, "region_id", "left_anti"), "unknown_region"),
        conditions(features_, {
            "longitude_range": ~F.col("longitude").between(-180, 360), "latitude_range": ~F.col("latitude").between(-90, 90),
            "warmest_month": ~F.col("warmest_month").isin(MONTHS), "coldest_month": ~F.col("coldest_month").isin(MONTHS),
        }),
        conditions(trends, {
            "year_order": F.col("baseline_start_year") > F.col("baseline_end_year"), "p_value_range": ~F.col("trend_p_value").between(0, 1), "r_squared_range": ~F.col("trend_r_squared").between(0, 1),
        }),
        amount(trends.join(features_, "cell_id", "left_anti"), "unknown_cell"),
    )


def cell_regions(cells: DataFrame, assigned: DataFrame, least: int) -> DataFrame:
    """Design rules: each included cell lies in exactly one region, each region has enough cells."""
    n = assigned.filter(F.col("polygon").isNotNull()).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    of_cell = cells.select("cell_id").join(n, "cell_id", "left")
    sizes = assigned.filter(F.col("polygon").isNotNull()).groupBy("polygon").agg(F.countDistinct("cell_id").alias("n"))
    return suite(
        conditions(of_cell, {"cells_without_region": F.col("n").isNull(), "cells_in_several": F.col("n") > 1}), conditions(sizes, {"small_regions": F.col("n") < least})
    )


def region_attributes(df: DataFrame) -> DataFrame:
    names = ("region_id", "region_code", "region_name")
    return suite(conditions(df, {f"null_{c}": F.col(c).isNull() for c in names}), *[duplicates(df, [c], f"duplicate_{c}") for c in names])
