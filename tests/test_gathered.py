"""Checks gathered while tables are written, against the suites that read the tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gathered, validate
from tidemark.plans import queries
from tidemark.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return files.Publication(spark, str(tmp_path_factory.mktemp("t"))).stage(queries._tables(spark, SF), "plain")


def both(spark, tables, folder):
    target = files.Publication(spark, str(folder))
    staged = target.stage(tables, "v", gathered.observed)
    report = lambda df: {r.check_name: (r.failing_rows, r.ok) for r in df.collect()}
    return report(gathered.report(staged, target.seen)), report(queries.gate(staged)), staged, target.seen


def test_same_report_as_the_suites(spark, tables, tmp_path):
    got, want, _, _ = both(spark, tables, tmp_path)
    assert got == want and len(got) > 40


def test_same_report_over_planted_faults(spark, tables, tmp_path):
    daily, rows, clim = tables["region_daily_sst"], tables["region_daily_anomalies"], tables["region_climatology"]
    last = rows.agg(F.max("date")).first()[0]
    m, p = tables["monitoring"], tables["preliminary_anomalies"]
    bad = dict(tables)
    bad["region_daily_sst"] = daily.filter("day(date) <> 11").unionByName(daily.filter("day(date) = 3")).withColumn("mean_sst_c", F.when(F.col("cell_count") > 1, F.col("mean_sst_c")))
    bad["region_climatology"] = clim.filter("region_id <> 2").unionByName(clim.filter("region_id = 3")).withColumn("sample_size", F.col("sample_size") - 2)
    bad["region_daily_anomalies"] = rows.filter((F.col("date") != F.lit(last)) | (F.col("region_id") == 1)).filter(F.col("date") > "1993-01-01").withColumn("above_p90", F.when(F.col("region_id") > 1, F.col("above_p90")))
    events = tables["heat_events"]
    bad["heat_events"] = events.unionByName(events.filter("region_id = 1")).withColumn("is_active", F.lit(True)).withColumn("peak_date", F.date_add("peak_date", 3))
    bad["preliminary_daily_sst"] = tables["preliminary_daily_sst"].filter("region_id <> 4").withColumn("data_product", F.when(F.col("region_id") > 2, "final"))
    bad["preliminary_anomalies"] = p.unionByName(p.filter("region_id = 5")).drop("cell_count")
    product = F.when(F.col("region_id") == 1, "other").when(F.col("region_id") == 2, F.lit(None)).when(F.col("region_id") == 3, "final").otherwise(F.col("data_product"))
    extra = m.limit(2).withColumn("date", F.lit(datetime.date(2031, 1, 1)))
    bad["monitoring"] = m.filter("region_id <> 6").unionByName(extra).unionByName(m.filter("region_id = 4 and is_provisional")).withColumn("data_product", product)
    got, want, _, seen = both(spark, bad, tmp_path)
    assert got == want
    assert sum(not ok for _, ok in got.values()) >= 25
    assert seen["region_daily_sst"]["rows"] == bad["region_daily_sst"].count()


def test_empty_tables(spark, tables, tmp_path):
    got, want, _, _ = both(spark, {n: df.filter("region_id > 100") for n, df in tables.items()}, tmp_path)
    assert got == want and got["history.empty"] == (1, False)


def test_rows_without_keys(spark, tables, tmp_path):
    daily = tables["region_daily_sst"]
    lost = daily.limit(3).withColumn("region_id", F.lit(None).cast("int"))
    odd = tables | {"region_daily_sst": daily.unionByName(lost).unionByName(daily.limit(2).withColumn("date", F.lit(None).cast("date")))}
    got, want, _, _ = both(spark, odd, tmp_path)
    assert got == want and got["history.missing_region_dates"][0] > 365


def test_each_written_table_is_read_once(spark, tables, tmp_path):
    _, _, staged, seen = both(spark, tables, tmp_path)
    plan = gathered.report(staged, seen)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(tables)
    assert validate.require(gathered.report(staged, seen).filter("ok")) is None
