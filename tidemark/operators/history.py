"""Sets of rows over time: precedence, merging, windows of work, calendars."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("region_id", "date")
DAILY = ["date", "region_id", "region_code", "region_name", "mean_sst_c", "cell_count", "min_sst_c", "max_sst_c"]


def standardise(df: DataFrame, source: str, priority: int, columns: Sequence[str] = DAILY) -> DataFrame:
    """Named columns with lenient numbers, tagged by source; rows without date, region or mean go."""
    numeric = {"region_id": "bigint", "mean_sst_c": "double", "cell_count": "bigint", "min_sst_c": "double", "max_sst_c": "double"}
    cols = [F.col(c).try_cast(numeric[c]).alias(c) if c in numeric else (F.to_date(c).alias(c) if c == "date" else F.col(c)) for c in columns]
    out = df.select(*cols, F.lit(source).alias("source_file"), F.lit(priority).alias("source_priority"))
    return out.dropna(subset=["date", "region_id", "mean_sst_c"])


def keep_highest(df: DataFrame, key: Sequence[str] = KEY, priority: str = "source_priority") -> DataFrame:
    """One row for each key, that of the highest priority; of equal ones the greatest by the other columns, in their order."""
    best = Window.partitionBy(*key).orderBy(F.col(priority).desc(), *[F.col(c).desc() for c in df.columns if c not in (*key, priority)])
    return df.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def merge_sources(frames: Sequence[DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """Union of standardised sources; the higher priority wins."""
    return keep_highest(reduce(lambda a, b: a.unionByName(b), frames), key)


def prefer(low: DataFrame, high: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Union where a row of `high` replaces that of `low`."""
    both = low.withColumn("_p", F.lit(0)).unionByName(high.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return keep_highest(both, key, "_p").drop("_p")


def missing_only(new: DataFrame, stored: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return new.join(stored.select(*key), list(key), "left_anti")


def append_missing(stored: DataFrame, new: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Stored rows never change; of `new`, only absent keys are added."""
    return stored.unionByName(missing_only(new, stored, key).select(*stored.columns))


def tag(df: DataFrame, product: str, provisional: bool) -> DataFrame:
    return df.withColumns({"data_product": F.lit(product), "is_provisional": F.lit(provisional)})


def monitoring(final: DataFrame, preliminary: DataFrame) -> DataFrame:
    """Final and preliminary rows with their product; preliminary wins."""
    return prefer(tag(final, "final", False), tag(preliminary, "preliminary", True))


def before_window(final: DataFrame, start: str, days: int | None = None) -> DataFrame:
    """Final rows before `start`, the last `days` days of them."""
    out = final.filter(F.col("date") < F.lit(start).cast("date"))
    return out.filter(F.col("date") >= F.date_sub(F.lit(start).cast("date"), days)) if days else out


def preliminary_input(final: DataFrame, preliminary: DataFrame, start: str, days: int = 30, least: int = 29) -> DataFrame:
    """What anomalies of a preliminary window are computed from: `days` of final rows before it and the window.

    A region of the window without `least` earlier days is an error, raised when the rows are read.
    """
    if days < least:
        raise ValueError(f"history_days must be at least {least}")
    earlier = before_window(final, start, days)
    cover = earlier.groupBy("region_id").agg(F.countDistinct("date").alias("_days"))
    short = F.col("_days").isNull() | (F.col("_days") < least)
    window = (
        preliminary.join(cover, "region_id", "left")
        .filter(F.when(short, F.raise_error(F.lit(f"a region has fewer than {least} days before the window")).cast("boolean")).otherwise(True))
        .drop("_days")
    )
    return prefer(earlier, window.select(*preliminary.columns))


def overlapping(events: DataFrame, start: str, end: str) -> DataFrame:
    return events.filter((F.col("end_date") >= F.lit(start).cast("date")) & (F.col("start_date") <= F.lit(end).cast("date")))


def next_window(df: DataFrame, today: str, lag: int = 18) -> DataFrame:
    """The day after the last stored one to `today` less the lag; has_work if that is a range."""
    end = F.date_sub(F.lit(today).cast("date"), lag)
    start = F.date_add(F.max("date"), 1)
    return df.agg(start.alias("start_date"), end.alias("end_date"), (start <= end).alias("has_work"))


def request_window(today: str, first: int = 21, last: int = 1) -> tuple[datetime.date, datetime.date]:
    """The days that a preliminary update asks for where none are named: `first` to `last` days before today."""
    day = datetime.date.fromisoformat(today)
    if first < last:
        raise ValueError("the window starts after its end")
    return day - datetime.timedelta(first), day - datetime.timedelta(last)


def calendar_of(df: DataFrame, column: str = "date") -> DataFrame:
    """Every day from the first to the last of df."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("date"))


def missing_dates(df: DataFrame) -> DataFrame:
    return calendar_of(df).join(df.select("date").distinct(), "date", "left_anti")


def missing_keys(df: DataFrame, key: str = "region_id") -> DataFrame:
    """Days by known keys that have no row."""
    keys = df.select(key).distinct()
    ends = df.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    every = keys.join(F.broadcast(ends)).select(key, F.explode(F.sequence("a", "b")).alias("date"))  # one row of ends
    return every.join(df.select(key, "date").distinct(), [key, "date"], "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of one side only, with the side."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return a.join(b, list(key), "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, list(key), "left_anti").withColumn("side", F.lit("unexpected")))


def compare_products(expected: DataFrame, actual: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Full outer comparison: rows of one side only, or of both with another product."""
    a = expected.select(*key, F.col("data_product").alias("expected_product"))
    b = actual.select(*key, F.col("data_product").alias("actual_product"))
    both = a.join(b, list(key), "full_outer")
    kind = F.when(F.col("actual_product").isNull(), "missing").when(F.col("expected_product").isNull(), "extra").when(F.col("expected_product") != F.col("actual_product"), "wrong_product")
    return both.withColumn("problem", kind).filter("problem is not null")


def missing_years(df: DataFrame, start: int, end: int, column: str = "year") -> DataFrame:
    """Years of the range for which df has no row."""
    if start > end:
        raise ValueError("start year is after end year")
    years = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(column))
    return years.join(df.select(column).distinct(), column, "left_anti")
