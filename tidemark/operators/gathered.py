"""The checks of a daily run, gathered while its tables are written.

What holds of single rows (numbers, ends, conditions) is observed in the job that
writes a table, so that it costs no scan. Duplicates and sets of keys of the
daily tables come from one table of keys, for which each of them is read once;
climatology and events are read once for their own keys. The report has the
checks of the suites in `validate`, by the same names.

Observed numbers are of tasks that the write has committed: a task that is lost
and run anew counts once. An empty table has no ends and counts zero; a row with
a null in its key equals no row of another table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from . import history, validate

#: Tables by the letter of their columns in the table of keys.
KEYED = {"d": "region_daily_sst", "a": "region_daily_anomalies", "s": "preliminary_daily_sst", "p": "preliminary_anomalies", "m": "monitoring"}
_COLUMNS = {
    "region_daily_sst": history.DAILY, "preliminary_daily_sst": [*history.DAILY, *validate.PRODUCT], "preliminary_anomalies": [*validate.ANOMALY, *validate.PRODUCT],
    "preliminary_events": [*validate.EVENT, *validate.PRODUCT], "monitoring": [*validate.ANOMALY, *validate.PRODUCT],
}


def observed(name: str, seen: Mapping[str, Mapping[str, Any]]) -> dict[str, Column]:
    """What to observe of a table as it is written; `seen` holds what was observed of tables written before it."""
    latest = F.lit(seen.get("region_daily_anomalies", {}).get("last")).cast("date")
    conditions = {
        "region_daily_sst": validate.daily_rows, "region_climatology": validate.climatology_rows, "region_daily_anomalies": validate.anomaly_rows,
        "heat_events": lambda: validate.event_rows(latest), "preliminary_daily_sst": lambda: validate.product_rows("sst"), "preliminary_anomalies": lambda: validate.product_rows("anomaly"),
        "preliminary_events": validate.preliminary_event_rows, "monitoring": validate.monitoring_rows,
    }.get(name)
    out = {"rows": F.count(F.lit(1))} | {n: F.count(F.when(c, 1)) for n, c in (conditions() if conditions else {}).items()}
    if name in KEYED.values():
        out |= {"first": F.min("date"), "last": F.max("date")}
    if name == "region_daily_sst":
        day = F.when(~calendar.is_leap_day(F.col("date")), F.col("date"))
        out |= {"no_leap_rows": F.count(day), "no_leap_first": F.min(day), "no_leap_last": F.max(day)}
    return out


def _total(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


def key_numbers(tables: Mapping[str, DataFrame], seen: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row of numbers about the keys of all daily tables at hand: each is read once, all meet in one grouping by region and day."""
    at_hand = {t: tables[n] for t, n in KEYED.items() if n in tables}
    product = lambda t: (F.col("data_product") if t == "m" else F.lit(None)).cast("string").alias("product")
    rows = reduce(DataFrame.unionByName, [df.select("region_id", "date", F.lit(t).alias("tag"), product(t)) for t, df in at_hand.items()])
    lone = F.when(F.col("region_id").isNull() | F.col("date").isNull(), F.col("tag")).alias("lone")
    of = lambda t, c=F.lit(True): F.count(F.when((F.col("tag") == t) & c, 1))  # noqa: E731, B008
    value = F.col("product")
    by_key = rows.groupBy("region_id", "date", lone).agg(
        *[of(t).alias(t) for t in KEYED], of("m", value.isNotNull()).alias("known"), of("m", value == "final").alias("final"), of("m", value == "preliminary").alias("preliminary")
    )
    has = {t: F.col(t) > 0 for t in KEYED}
    whole = F.col("region_id").isNotNull() & F.col("date").isNotNull()
    on_last = lambda t: _total(has[t] & F.col("region_id").isNotNull() & (F.col("date") == F.lit(seen[KEYED[t]]["last"] if t in at_hand else None).cast("date")))
    regions = lambda c: F.countDistinct(F.when(c, F.col("region_id")))
    expected = has["a"] | has["p"]
    missing = F.when(expected & ~has["m"], 1).otherwise(F.col("m") - F.col("known"))
    wrong = F.when(has["p"], F.col("known") - F.col("preliminary")).when(has["a"], F.col("known") - F.col("final")).otherwise(0)
    return by_key.agg(
        *[_total(F.col(t) > 1).alias(f"{t}_twice") for t in KEYED], regions(has["d"]).alias("d_regions"), regions(has["s"]).alias("s_regions"),
        regions(has["d"] & ~calendar.is_leap_day(F.col("date"))).alias("d_no_leap_regions"), F.countDistinct(F.when(has["d"], F.col("date"))).alias("d_days"),
        _total(has["d"] & whole).alias("d_keys"), F.coalesce(F.max(F.when(has["d"] & F.col("region_id").isNull(), 1)), F.lit(0)).alias("d_null_region"),
        on_last("a").alias("a_on_last"), on_last("p").alias("p_on_last"), _total(has["s"] != has["p"]).alias("sets_differ"),
        F.sum(missing).alias("missing"), F.sum(F.when(~expected, F.col("known"))).alias("extra"), F.sum(wrong).alias("wrong"),
    )


def report(tables: Mapping[str, DataFrame], seen: Mapping[str, Mapping[str, Any]], entities: int = 6) -> DataFrame:
    """check_name, failing_rows, ok: the suites of the tables at hand. `tables` are the tables as written, `seen` what was observed of each by `observed`."""
    number = lambda name, what: F.lit(seen[name].get(what) or 0)
    lost = lambda name: F.lit(len([c for c in _COLUMNS[name] if c not in tables[name].columns]))
    none = lambda name: F.lit(0 if seen[name].get("rows") else 1)
    unlike = lambda a, b: F.lit(0 if a is not None and a == b else 1)
    not_equal = lambda c, n: F.when(c == n, 0).otherwise(1)
    checks: dict[str, Column] = {}
    own: list[DataFrame] = []  # checks of keys other than region and day
    has = lambda *names: all(n in tables for n in names)

    def add(suite: str, parts: Mapping[str, Column]) -> None:
        checks.update({f"{suite}.{n}": c for n, c in parts.items()})

    def rows(suite: str, name: str, conditions: Mapping[str, Column]) -> None:
        add(suite, {c: number(name, c) for c in conditions})

    if has("region_daily_sst"):
        name, own_seen = "region_daily_sst", seen["region_daily_sst"]
        days = (own_seen["last"] - own_seen["first"]).days + 1 if own_seen.get("first") else 0
        add("history", {
            "missing_columns": lost(name), "empty": none(name), "region_count": not_equal(F.col("d_regions"), entities), "duplicate_keys": F.col("d_twice"),
            "missing_dates": F.lit(days) - F.col("d_days"), "missing_region_dates": (F.col("d_regions") + F.col("d_null_region")) * days - F.col("d_keys"),
        })
        rows("history", name, validate.daily_rows())
    if has("region_climatology"):
        add("climatology", {"row_count": not_equal(number("region_climatology", "rows"), entities * 365)})
        rows("climatology", "region_climatology", validate.climatology_rows())
        own.append(validate.duplicates(tables["region_climatology"], ["region_id", "day_of_year"], "climatology.duplicate_keys"))
    if has("region_daily_anomalies", "region_daily_sst"):
        x, y = seen["region_daily_anomalies"], seen["region_daily_sst"]
        add("anomalies", {
            "duplicate_keys": F.col("a_twice"), "row_count_differs": F.lit(abs((x.get("rows") or 0) - (y.get("no_leap_rows") or 0))),
            "first_date_differs": unlike(x.get("first"), y.get("no_leap_first")), "last_date_differs": unlike(x.get("last"), y.get("no_leap_last")),
            "regions_missing_on_last_date": F.when(F.lit(x.get("last") is not None), F.col("d_no_leap_regions") - F.col("a_on_last")),
        })
        rows("anomalies", "region_daily_anomalies", validate.anomaly_rows())
    if has("heat_events"):
        rows("events", "heat_events", validate.event_rows(F.lit(None)))
        own.append(validate.duplicates(tables["heat_events"], ["event_id"], "events.duplicate_event_id"))
    if has("preliminary_daily_sst", "preliminary_anomalies", "preliminary_events"):
        sst, rows_, events = "preliminary_daily_sst", "preliminary_anomalies", "preliminary_events"
        add("preliminary", {
            "sst_columns": lost(sst), "anomaly_columns": lost(rows_), "event_columns": lost(events), "sst_empty": none(sst), "anomalies_empty": none(rows_), "sst_duplicates": F.col("s_twice"),
            "anomaly_duplicates": F.col("p_twice"), "sst_regions": not_equal(F.col("s_regions"), entities), "key_sets_differ": F.col("sets_differ"),
            "latest_day_incomplete": F.greatest(F.lit(entities) - F.col("p_on_last"), F.lit(0)),
        })
        rows("preliminary", sst, validate.product_rows("sst"))
        rows("preliminary", rows_, validate.product_rows("anomaly"))
        rows("preliminary", events, validate.preliminary_event_rows())
        own.append(validate.duplicates(tables[events], ["event_id"], "preliminary.duplicate_event_id"))
    if has("monitoring", "region_daily_anomalies", "preliminary_anomalies"):
        add("monitoring", {
            "missing_columns": lost("monitoring"), "empty": none("monitoring"), "duplicate_keys": F.col("m_twice"),
            "missing_rows": F.col("missing"), "extra_rows": F.col("extra"), "wrong_product_rows": F.col("wrong"),
        })
        rows("monitoring", "monitoring", validate.monitoring_rows())
    return validate.suite(validate.rows_of(key_numbers(tables, seen), checks), *own)
