"""Keyed daily series: preparation, aggregation, climatology, anomalies and heat events.

`entity` names the key columns of a series (the first is its id); `value` the
measurement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, labels, stats

REGION = ("region_id", "region_code", "region_name")


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in order; missing ones are an error, others go."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def normalize(df: DataFrame, *, dates: Sequence[str] = (), integers: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """Cast by role; a null or unreadable integer is an error when the row is read."""
    whole = {c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in {c}")).cast("long")).otherwise(F.col(c).cast("long")) for c in integers}
    return df.withColumns({c: F.to_date(c) for c in dates} | whole | {c: F.col(c).cast("boolean") for c in flags})


def flatten_grid(df: DataFrame, value: str = "sst") -> DataFrame:
    """Long grid rows as points: rows without a value go, coordinates get short names, depth goes."""
    names = {"latitude": "lat", "longitude": "lon"}
    out = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    return out.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns}).drop("depth", "zlev")


def prepare_points(df: DataFrame, value: str = "sst", needed: Sequence[str] = ("region_id", "region_name")) -> DataFrame:
    return df.dropna(subset=[*needed, value]).withColumn("date", F.to_date("time"))


def bbox(df: DataFrame, west: float, east: float, south: float, north: float, value: str = "sst") -> DataFrame:
    return df.filter(F.col("lon").between(west, east) & F.col("lat").between(south, north) & F.col(value).isNotNull())


def period(df: DataFrame, start: str | None = None, end: str | None = None, column: str = "date", *, required: bool = False) -> DataFrame:
    """Both bounds included and optional; no row left is an error if `required`."""
    if start:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    df = df.filter(F.col(column) <= F.lit(end).cast("date")) if end else df
    if required and df.isEmpty():
        raise ValueError(f"no rows from {start or 'the first day'} to {end or 'the last day'}")
    return df


def no_leap(df: DataFrame) -> DataFrame:
    """Without 29 February, with day_of_year 1 to 365."""
    return df.filter(~calendar.is_leap_day(F.col("date"))).withColumn("day_of_year", calendar.no_leap_day_of_year(F.col("date")))


def daily_aggregate(points: DataFrame, entity: Sequence[str] = REGION, value: str = "sst") -> DataFrame:
    """Mean, count, least and greatest value of each day; null keys are groups."""
    return points.groupBy("date", *entity).agg(
        F.avg(value).alias("mean_sst_c"), F.count(value).alias("cell_count"), F.min(value).alias("min_sst_c"), F.max(value).alias("max_sst_c")
    )


def climatology(history: DataFrame, entity: Sequence[str] = REGION, value: str = "mean_sst_c", q: float = 0.9) -> DataFrame:
    """Mean, exact quantile and count of each day of the year; `history` has day_of_year."""
    return history.groupBy(*entity, "day_of_year").agg(
        F.avg(value).alias("clim_mean_sst_c"), stats.quantile(value, q).alias("clim_p90_sst_c"), F.count(value).alias("sample_size")
    )


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, with an error in place of the first row whose key another row has too."""
    seen = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    bad = F.raise_error(F.concat(F.lit("duplicate key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    return df.withColumn("_n", seen).filter(F.when(F.col("_n") > 1, bad.cast("boolean")).otherwise(True)).drop("_n")


def join_climatology(history: DataFrame, clim: DataFrame, key: str = "region_id") -> DataFrame:
    """Left join on key and day of year; the climatology's key is checked to be unique."""
    right = unique(clim.select(key, "day_of_year", "clim_mean_sst_c", "clim_p90_sst_c", "sample_size"), [key, "day_of_year"])
    return history.join(right, [key, "day_of_year"], "left")


def with_anomalies(df: DataFrame, key: str = "region_id") -> DataFrame:
    """Anomaly, flag, rolling means over rows, change over seven rows and status; one window serves all."""
    by = Window.partitionBy(key).orderBy("date")
    out = df.withColumn("anomaly_c", F.col("mean_sst_c") - F.col("clim_mean_sst_c")).withColumn(
        "above_p90", F.coalesce(F.col("mean_sst_c") > F.col("clim_p90_sst_c"), F.lit(False))
    )
    return out.withColumns({
        "rolling_7d_anomaly_c": F.avg("anomaly_c").over(by.rowsBetween(-6, 0)),
        "rolling_30d_anomaly_c": F.avg("anomaly_c").over(by.rowsBetween(-29, 0)),
        "warming_rate_7d_c": F.col("mean_sst_c") - F.lag("mean_sst_c", 7).over(by),
    }).withColumn("status_label", labels.status(F.round("anomaly_c", 9)))  # noise of a sum does not decide at a limit


#: Names and order of the table of anomalies.
ANOMALY_COLUMNS = [
    "date", "region_id", "region_code", "region_name", "day_of_year", "mean_sst_c", "cell_count", "min_sst_c", "max_sst_c", "clim_mean_sst_c",
    "clim_p90_sst_c", "sample_size", "anomaly_c", "rolling_7d_anomaly_c", "rolling_30d_anomaly_c", "warming_rate_7d_c", "above_p90", "status_label",
]
#: Names and order of the table of events after the entity, and the type of all of them.
EVENT_COLUMNS = [
    "event_type", "severity_class", "start_date", "end_date", "duration_days", "max_anomaly_c", "mean_anomaly_c", "max_exceedance_p90_c", "mean_exceedance_p90_c",
    "peak_date", "is_active", "threshold_c", "min_duration_days",
]
EVENT_TYPE = "warm_event"


def anomalies(history: DataFrame, clim: DataFrame) -> DataFrame:
    """From daily means and a climatology to the table of anomalies."""
    return with_anomalies(join_climatology(no_leap(history), clim)).select(*ANOMALY_COLUMNS)


def event_days(rows: DataFrame) -> DataFrame:
    return rows.withColumn("exceedance_c", F.col("mean_sst_c") - F.col("clim_p90_sst_c")).withColumn("is_event", F.coalesce("above_p90", F.lit(False)))


def event_runs(days: DataFrame, key: str = "region_id", bridge_leap_day: bool = False) -> DataFrame:
    """run_id, unique within a key: a new run where the flag changes or the step from the row before is not one day.

    With `bridge_leap_day`, 28 February and 1 March of a leap year are one day apart.
    """
    by = Window.partitionBy(key).orderBy("date")
    gap = F.datediff("date", F.lag("date").over(by))
    if bridge_leap_day:
        before = F.lag("date").over(by)
        over = calendar.is_leap_year(F.col("date")) & (F.date_format(before, "MM-dd") == "02-28") & (F.date_format("date", "MM-dd") == "03-01")
        gap = gap - over.cast("int")
    new = F.when(F.lag("is_event").over(by).isNull() | (F.lag("is_event").over(by) != F.col("is_event")) | (gap != 1), 1).otherwise(0)
    return days.withColumn("_new", new).withColumn("run_id", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def heat_events(rows: DataFrame, *, least_days: int = 5, threshold_c: float = 0.0, entity: Sequence[str] = REGION, digits: int = 4) -> DataFrame:
    """Runs of at least `least_days` flagged days; active if they end on the last date of all rows.

    `rows` are anomalies. Null keys are dropped. The peak is the first day of
    the highest exceedance; severity is of the unrounded value. `threshold_c` is
    only recorded. No event gives no rows.
    """
    days = event_days(rows).dropna(subset=list(entity))
    latest = rows.agg(F.max("date").alias("latest"))
    runs = event_runs(days, entity[0]).filter("is_event").groupBy(*entity, "run_id").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"), F.count(F.lit(1)).alias("duration_days"),
        F.max("anomaly_c").alias("max_anomaly_c"), F.avg("anomaly_c").alias("mean_anomaly_c"),
        F.max("exceedance_c").alias("max_exceedance_c"), F.avg("exceedance_c").alias("mean_exceedance_c"),
        F.min_by("date", F.struct((-F.col("exceedance_c")).alias("e"), "date")).alias("peak_date"),
    ).filter(F.col("duration_days") >= least_days)
    to = lambda c, name: F.round(F.round(c, 9), digits).alias(name)
    return runs.join(F.broadcast(latest)).select(  # one row
        labels.event_id(F.col(entity[0]), F.col("start_date")).alias("event_id"), *entity, F.lit(EVENT_TYPE).alias("event_type"),
        labels.severity(F.col("max_exceedance_c")).alias("severity_class"), "start_date", "end_date", "duration_days",
        to("max_anomaly_c", "max_anomaly_c"), to("mean_anomaly_c", "mean_anomaly_c"), to("max_exceedance_c", "max_exceedance_p90_c"), to("mean_exceedance_c", "mean_exceedance_p90_c"),
        "peak_date", (F.col("end_date") == F.col("latest")).alias("is_active"), F.lit(threshold_c).alias("threshold_c"), F.lit(least_days).alias("min_duration_days"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles and floats to `digits` places, moved up by 1e-9 first: exact ties fall one way, whatever the last bits of a sum."""
    nudge = 1e-9 if digits > 4 else 0.0
    return df.select(*[F.round(F.col(c) + nudge, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
