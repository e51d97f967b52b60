"""Figures about tables: dashboard values, metrics, coverage, reconciliation, run logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dashboard(anomalies: DataFrame, events: DataFrame, monitoring: DataFrame) -> DataFrame:
    """One row: latest dates by product, active events, and regions above p90, highest and mean anomaly on the latest day."""
    latest = anomalies.groupBy("date").agg(
        F.count_distinct(F.when(F.col("above_p90"), F.col("region_id"))).alias("regions_above_p90"), F.max("anomaly_c").alias("max_anomaly_c"), F.avg("anomaly_c").alias("mean_anomaly_c")
    ).agg(F.max_by(F.struct("regions_above_p90", "max_anomaly_c", "mean_anomaly_c"), "date").alias("l")).select("l.*")
    dates = monitoring.agg(
        F.max(F.when(~F.col("is_provisional"), F.col("date"))).alias("latest_final_date"), F.max(F.when(F.col("is_provisional"), F.col("date"))).alias("latest_preliminary_date")
    )
    active = events.agg(F.count_distinct(F.when(F.col("is_active"), F.col("event_id"))).alias("active_events"))
    out = dates.join(F.broadcast(active)).join(F.broadcast(latest))  # one row each
    return out.withColumn("regions_above_p90", F.coalesce("regions_above_p90", F.lit(0)))


def latest_status(anomalies: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the latest date of all."""
    last = anomalies.agg(F.max("date").alias("_last"))
    return anomalies.join(F.broadcast(last), F.col("date") == F.col("_last")).select(*columns)  # one row


def metrics(df: DataFrame, name: str, counted: Sequence[str] = (), entity: str = "region_id") -> DataFrame:
    """One row of a table: rows, columns, entities, first and last date, counts of values as JSON (null a value)."""
    base = df.agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
        F.count_distinct(entity).alias("entity_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    for c in counted:
        values = df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("k")).count()
        base = base.join(F.broadcast(values.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count"))))).alias(f"{c}_counts"))))
    return base


def table_metrics(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, first and last date of each (table, date column)."""
    one = lambda n, df, c: df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.min(c).alias("first_date"), F.max(c).alias("last_date"))
    return union([one(n, df, c) for n, (df, c) in tables.items()])


def coverage(daily: DataFrame) -> DataFrame:
    month = F.trunc("date", "MM")
    return daily.groupBy("region_id").agg(
        F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.count_distinct(month).alias("month_count"),
        F.count(F.lit(1)).alias("row_count"), F.avg("mean_sst_c").alias("mean_sst_c"),
    )


def reconcile(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual against expected rows of each table: PASS, FAIL, or MISSING where there is no such table."""
    actual = union([df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("actual_rows")) for n, df in tables.items()])
    out = expected.join(actual, "table_name", "left")
    verdict = F.when(F.col("actual_rows").isNull(), "MISSING").when(F.col("actual_rows") == F.col("expected_rows"), "PASS").otherwise("FAIL")
    return out.withColumn("result", verdict)


def stage_diagnostics(anomalies: DataFrame, events: DataFrame) -> DataFrame:
    """One row: rows without climatology or above p90, labels; events by severity, active, longest."""
    n = lambda c: F.count(F.when(c, 1))
    a = anomalies.agg(
        F.count(F.lit(1)).alias("rows"), n(F.col("clim_mean_sst_c").isNull()).alias("without_climatology"), n(F.col("above_p90")).alias("above_p90"),
        *[n(F.col("status_label") == s).alias(f"status_{s.lower()}") for s in ("Unknown", "Normal", "Watch", "Hot", "Extreme")],
    )
    e = events.agg(
        F.count(F.lit(1)).alias("events"), n(F.col("is_active")).alias("active_events"), F.max("duration_days").alias("longest_days"),
        *[n(F.col("severity_class") == s).alias(f"severity_{s.lower()}") for s in ("Weak", "Moderate", "Severe", "Extreme")],
    )
    return a.join(F.broadcast(e))  # one row


def grid_summary(audit: DataFrame) -> DataFrame:
    n = lambda c: F.count(F.when(c, 1))
    land, inside, ocean = F.col("is_land"), F.col("included_in_coastal_domain"), F.col("oisst_ocean_cell")
    return audit.agg(
        F.count(F.lit(1)).alias("total_cells"), n(land).alias("land_cells"), n(inside).alias("included_cells"), n(ocean).alias("native_ocean_cells"),
        n(~land & ~ocean).alias("masked_out_cells"), n(~land & ~inside).alias("offshore_cells"),
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


#: What the view reads from an event's JSON, and the keys of which one makes an event part of it.
STEP_TEXT = ["step_name", "target_table", "output_file", "load_mode"]
STEP_NUMBERS = ["rows_created", "rows_loaded", "row_count", "column_count", "region_count"]
STEP_DATES = ["date_min", "date_max"]
STEP_OBJECTS = ["status_label_counts", "data_product_counts", "is_provisional_counts"]
STEP_KEYS = ["rows_created", "rows_loaded", "row_count", "target_table", "output_file"]


def step_metrics(runs: DataFrame, log: DataFrame, keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """Run log events with their run: those at level ERROR or whose JSON has one of the keys, even with a null value.

    Text, numbers and dates of the JSON (an empty text is null), sub-objects as JSON, and all of it as raw_extra.
    """
    x = F.col("extra")
    has = F.arrays_overlap(F.coalesce(F.json_object_keys(x), F.array().cast("array<string>")), F.array(*[F.lit(k) for k in keys]))
    kept = log.filter(x.isNotNull() & ((F.col("level") == "ERROR") | has))
    value = lambda k: F.get_json_object(x, f"$.{k}")
    some = lambda k: F.nullif(value(k), F.lit(""))
    fields = {k: value(k) for k in STEP_TEXT + STEP_OBJECTS} | {k: some(k).try_cast("bigint") for k in STEP_NUMBERS} | {k: some(k).try_cast("date") for k in STEP_DATES}
    return kept.join(runs, "run_id").withColumns({k: fields[k] for k in STEP_TEXT + STEP_NUMBERS + STEP_DATES + STEP_OBJECTS} | {"raw_extra": x})


def run_log_latest(log: DataFrame) -> DataFrame:
    """State of each run from its appended events: last event, counts by level, first and last time."""
    return log.groupBy("run_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status"), F.min("ts").alias("started_at"), F.max("ts").alias("last_at"),
        F.count(F.lit(1)).alias("event_count"), F.count(F.when(F.col("level") == "ERROR", 1)).alias("error_count"),
    )


def recent(df: DataFrame, by: str, n: int = 18, *more: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), *more).limit(n)


def enrich(df: DataFrame, names: DataFrame, key: str = "region_id", labels: Sequence[str] = ("region_code", "region_name")) -> DataFrame:
    """Add missing label columns by key; a key without labels is an error when its row is read."""
    wanted = [c for c in labels if c not in df.columns]
    if not wanted:
        return df
    right = names.groupBy(key).agg(F.min(F.struct(*wanted)).alias("_labels")).select(key, "_labels.*")  # of several, the least
    found = df.join(right.withColumn("_known", F.lit(True)), key, "left")
    bad = F.raise_error(F.concat(F.lit("no labels for "), F.col(key).cast("string")))
    return found.filter(F.when(F.col("_known").isNull(), bad.cast("boolean")).otherwise(True)).drop("_known")


def by_recency(df: DataFrame, key: str, by: str, n: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col(by).desc())
    return df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).drop("_r")
