"""Building what a table of days lacks: only absent rows are added, stored ones never change."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from . import history

Day = dt.date


@dataclass
class Backfill:
    """What a run did: days that failed with their reason, rows built, rows that the table had, rows added (or, in a dry run, that would be)."""

    failed: dict[Day, str] = field(default_factory=dict)
    built_rows: int = 0
    present_rows: int = 0
    added_rows: int = 0
    written: bool = False
    backup: str | None = None


def _stage(build: Callable[[Sequence[Day]], DataFrame], days: Sequence[Day], folder: str, failed: dict[Day, str]) -> list[str]:
    """Build days in one job; where that fails, each half apart, so that a failing day costs a few jobs and the others are kept. Returns the folders written."""
    path = f"{folder}/{days[0]}-{len(days)}-{uuid.uuid4().hex[:8]}"
    try:
        build(days).write.parquet(path)
        return [path]
    except Exception as error:  # whatever a day's input holds
        if len(days) == 1:
            failed[days[0]] = str(error).splitlines()[0][:300]
            return []
    half = len(days) // 2
    return _stage(build, days[:half], folder, failed) + _stage(build, days[half:], folder, failed)


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("date", "yyyy-MM"))


def write_months(df: DataFrame, table: str) -> None:
    """Replace the months that df has rows of; the others stay as they are."""
    with_month(df).repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(table)


def _duplicates(df: DataFrame, key: Sequence[str]) -> int:
    return df.groupBy(*key).count().filter("count > 1").count()


def backfill(
    spark: SparkSession, build: Callable[[Sequence[Day]], DataFrame], days: Sequence[Day], table: str, staging: str, *, key: Sequence[str] = history.KEY, dry_run: bool = False, keep_backup: bool = True,
) -> Backfill:
    """Add to `table` (Parquet by `month`, as "2020-01") the rows of the days that it lacks.

    `build` gives the rows of a list of days. Days that fail are left out and
    named; if all fail, that is an error. Rows whose key is stored are skipped,
    of built rows with one key the greatest is taken, and a stored key that is
    twice is an error. Only months that gain rows are written, with the rows
    they had; with nothing new, or in a dry run, nothing is.
    """
    if not days:
        raise ValueError("no day is asked for")
    out = Backfill()
    parts = _stage(build, sorted(set(days)), staging, out.failed)
    if not parts:
        raise RuntimeError(f"no day was built: {next(iter(out.failed.values()), '')}")
    rows = spark.read.parquet(*parts)
    rest = [c for c in rows.columns if c not in key]
    rows = rows.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r")).select(*key, "_r.*").select(*rows.columns)
    out.built_rows = rows.count()
    stored = None
    if files._exists(spark, table):
        span = F.col("month").between(f"{min(days):%Y-%m}", f"{max(days):%Y-%m}")
        stored = spark.read.parquet(table).withColumn("month", F.col("month").cast("string")).filter(span).select(*rows.columns)
        twice = _duplicates(stored, key)
        if twice:
            raise RuntimeError(f"{twice} stored keys are there more than once")
        fresh = history.missing_only(rows, stored, key)
    else:
        fresh = rows
    out.added_rows = fresh.count()
    out.present_rows = out.built_rows - out.added_rows
    if dry_run or not out.added_rows:
        return out
    if stored is not None and keep_backup:
        out.backup = files.backup(spark, table, dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f"))
    whole = fresh if stored is None else fresh.unionByName(with_month(stored).join(with_month(fresh).select("month").distinct(), "month", "left_semi").drop("month"))
    ready = f"{staging}/ready-{uuid.uuid4().hex[:8]}"
    whole.write.parquet(ready)  # a table that is read can't be overwritten
    write_months(spark.read.parquet(ready), table)
    out.written = True
    return out


def build_years(spark: SparkSession, build: Callable[[int], DataFrame], years: Sequence[int], table: str, valid: Callable[[DataFrame, int], bool]) -> dict[int, str]:
    """Build each year that `table` (Parquet by `year`) lacks or whose rows are not valid; years that are there and valid stay untouched.

    Returns what was done with each year: kept, built. Rows that are not valid
    when built are an error, and that year is not written.
    """
    done: dict[int, str] = {}
    for year in years:
        if files._exists(spark, f"{table}/year={year}") and valid(spark.read.parquet(f"{table}/year={year}"), year):
            done[year] = "kept"
            continue
        rows = build(year)
        if not valid(rows, year):
            raise RuntimeError(f"rows of {year} are not valid")
        rows.write.mode("overwrite").parquet(f"{table}/year={year}")
        done[year] = "built"
    return done
