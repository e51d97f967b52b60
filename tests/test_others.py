import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators import cells, monitoring, projection, series, spatial, validate
from tidemark.plans import proxy, queries
from tidemark.sources import files
from tidemark.streaming import incremental

D = dt.date


def test_cell_features(spark):
    rows = [(D(2000 + y, m, 1), c, 170.0 + i, -40.0, m + 1.0 * y + 10.0 * i) for i, c in enumerate(("a", "b")) for y in (0, 1) for m in range(1, 13)]
    out = {r.cell_id: r for r in cells.features(spark.createDataFrame(rows, "date date, cell_id string, longitude double, latitude double, sst_c double")).collect()}
    a = out["a"]
    assert (a.observation_count, a.mean_sst_c, a.mean_jan_sst_c, a.mean_dec_sst_c, a.summer_mean_sst_c, a.winter_mean_sst_c, a.seasonal_amplitude_c) == (24, 7.0, 1.5, 12.5, 5.5, 7.5, 11.0)
    assert a.warmest_month == "dec" and a.coldest_month == "jan" and math.isclose(a.deseasonalized_daily_sd_sst_c, math.sqrt(6 / 23)) and math.isclose(a.annual_mean_sd_sst_c, math.sqrt(0.5))
    shapes = [a[f"seasonal_shape_{m}_c"] for m in cells.MONTHS]
    assert shapes[0] == -5.5 and shapes[-1] == 5.5 and abs(sum(shapes)) < 1e-9


def test_trends(spark):
    rows = [(c, 170.0, -40.0, y, 15 + s * (y - 1991), 365) for c, s in (("up", 0.02), ("down", -0.01), ("flat", 0.0)) for y in range(1991, 2021)]
    got = {r.cell_id: r for r in cells.trends(spark.createDataFrame(rows, "cell_id string, longitude double, latitude double, year int, annual_mean_sst_c double, observation_count int"), 1991, 2020).collect()}
    assert math.isclose(got["up"].trend_c_per_year, 0.02, rel_tol=1e-9) and math.isclose(got["down"].trend_c_per_decade, -0.1, rel_tol=1e-9)
    assert math.isclose(got["up"].trend_r_squared, 1.0, rel_tol=1e-9) and got["up"].trend_p_value < 1e-9 and math.isclose(got["up"].estimated_change_over_period_c, 0.58, rel_tol=1e-9)
    assert (got["flat"].trend_p_value, got["flat"].trend_r_squared) == (1.0, 0.0) and got["up"].year_count == 30 and got["up"].observation_count == 10950


def test_projection(spark):
    rows = [(1, D(2018 + i // 12, i % 12 + 1, 1), 2018 + i // 12, i % 12 + 1, 15 + 2 * math.sin(2 * math.pi * i / 12) + 0.03 * i) for i in range(48)]
    df = spark.createDataFrame(rows, "region_id int, month_date date, year int, month int, mean_sst_c double")
    out = projection.project(df)
    ahead = out.filter("observed_or_projected = 'projected'").orderBy("month_date").collect()
    assert out.count() == 168 and len(out.columns) == 15 and ahead[0].month_date == D(2022, 1, 1) and ahead[-1].month_date == D(2031, 12, 1)
    assert math.isclose(ahead[0].trend_c_per_decade, 10 * ahead[0].trend_c_per_year) and all(r.p10_sst_c <= r.p90_sst_c for r in ahead)
    fit = projection.gls(df, base=(2018, 2021)).collect()
    assert len(fit) == 120 and all(r.lower_sst_c < r.predicted_sst_c < r.upper_sst_c for r in fit)


def test_grid(spark):
    one = spark.createDataFrame([(164.0, 165.0, -45.0, -44.0)], "west double, east double, south double, north double")
    grid = spatial.build_grid(one)
    assert grid.count() == 16 and sorted({r.longitude for r in grid.collect()}) == [164.125, 164.375, 164.625, 164.875]
    assert "oisst_164.125_-44.875" in {r.cell_id for r in grid.collect()}


def square(k, w, e, s, n):
    ring = [(w, s), (e, s), (e, n), (w, n), (w, s)]
    return [(k, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(ring, ring[1:]))]


EDGES = "polygon int, n int, x double, y double, x2 double, y2 double"


def test_points_in_overlapping_squares(spark):
    edges = spark.createDataFrame(square(1, 0, 2, 0, 2) + square(2, 1, 3, 1, 3), EDGES)
    points = spark.createDataFrame([(1.5, 1.5), (0.5, 0.5), (2.0, 0.5), (9.0, 9.0)], "lon double, lat double")
    got = sorted((r.lon, r.polygon or 0) for r in spatial.assign(points, edges).collect())
    assert got == [(0.5, 1), (1.5, 1), (1.5, 2), (2.0, 0), (9.0, 0)]  # on the edge is outside
    assert spatial.multiple(points, edges).first().polygon_count == 2
    assert spatial.invalid(edges).count() == 0


def test_classify_cells(spark):
    land = spark.createDataFrame(square(1, 173.9, 174.1, -41.1, -40.9), EDGES)
    c = spark.createDataFrame([("land", 174.0, -41.0), ("near", 174.25, -41.0), ("far", 178.0, -41.0)], "cell_id string, longitude double, latitude double")
    got = {r.cell_id: r for r in spatial.classify(c, land).collect()}
    assert got["land"].is_land and got["land"].distance_to_land_km == 0 and got["near"].included_in_coastal_domain and 12 < got["near"].distance_to_land_km < 13
    assert not got["far"].included_in_coastal_domain and got["far"].distance_to_land_km is None
    with pytest.raises(ValueError):
        spatial.classify(c, land, 0)


def test_distance_of_every_cell(spark):
    land = spark.createDataFrame(square(1, 173.9, 174.1, -41.1, -40.9) + square(2, 179.0, 179.1, -41.1, -40.9), EDGES)
    places = [("land", 174.0, -41.0), ("near", 174.25, -41.0), ("mid", 176.0, -42.0), ("far", 165.0, -48.0), ("farther", 150.0, -10.0), ("farthest", 120.0, 40.0)]
    c = spark.createDataFrame(places, "cell_id string, longitude double, latitude double")
    km = F.min(spatial.segment_distance(F.col("px"), F.col("py"))) / 1000
    pairs = spatial.projected(c.select("cell_id", F.col("longitude").alias("px"), F.col("latitude").alias("py")), [("px", "py")])
    want = {r.cell_id: r.km for r in pairs.crossJoin(spatial.projected(land, [("x", "y"), ("x2", "y2")])).groupBy("cell_id").agg(km.alias("km")).collect()} | {"land": 0.0}
    got = {r.cell_id: r for r in spatial.classify(c, land, beyond=True).collect()}
    assert all(math.isclose(got[k].distance_to_land_km, v, rel_tol=1e-12) for k, v in want.items()) and len(got) == 6 and want["farthest"] > 4800
    assert [k for k in want if got[k].included_in_coastal_domain] == ["near"]


def test_mainland_split(spark):
    rows = square(1, 172, 174, -43, -41) + square(2, 174.2, 175, -42, -41) + square(3, 168, 169, -46, -45) + square(4, 174.0, 174.1, -41.0, -40.9) + square(5, 178, 178.2, -44, -43.9)
    got = {r.polygon: r.kept for r in spatial.mainland(spark.createDataFrame(rows, EDGES)).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False}


def test_projection_against_another_series(spark):
    """Redfearn's series to sixth order agrees near the central meridian."""
    a, f = geo.A, geo.FLATTENING
    e2 = f * (2 - f)
    for lon, lat in ((173.0, -41.0), (174.5, -36.5), (171.0, -45.0)):
        got = geo.with_nztm(spark.createDataFrame([(lon, lat)], "lon double, lat double"), "lon", "lat", "e", "n").first()
        p, w = math.radians(lat), math.radians(lon - 173)
        m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - 3 / 8 * (e2 + e2**2 / 4 + 15 * e2**3 / 128) * math.sin(2 * p) + 15 / 256 * (e2**2 + 3 * e2**3 / 4) * math.sin(4 * p) - 35 * e2**3 / 3072 * math.sin(6 * p))
        nu = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
        psi, t2, c = nu / (a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5), math.tan(p) ** 2, math.cos(p)
        k = w * w * c * c
        east = nu * w * c * (1 + k / 6 * (psi - t2) + k * k / 120 * (4 * psi**3 * (1 - 6 * t2) + psi**2 * (1 + 8 * t2) - 2 * psi * t2 + t2**2))
        north = m + nu * math.sin(p) * w * w * c / 2 * (1 + k / 12 * (4 * psi**2 + psi - t2))
        assert abs(got.e - (1.6e6 + 0.9996 * east)) < 0.05 and abs(got.n - (1e7 + 0.9996 * north)) < 0.05


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    dates = {r.d for r in spark.read.parquet(f"{sf}/orders.parquet").select(F.to_date("o_orderdate").alias("d")).collect()}
    every = {min(dates) + dt.timedelta(days=i) for i in range((max(dates) - min(dates)).days + 1)}
    assert {r.date for r in queries.QUERIES["missing_dates"](spark, sf).collect()} == every - dates
    places = {(r.lon, r.lat) for r in proxy.points(spark, sf).collect()}
    got = queries.QUERIES["project_nztm"](spark, sf).collect()
    assert len(got) == len(places) and {(r.lon, r.lat) for r in got} == places and all(math.isfinite(r.easting + r.northing) for r in got)


def test_text_exclusion(spark):
    df = spark.createDataFrame([("Campbell Island", None), (None, "The Snares"), ("Muttonbird Island", "x")], "name string, group_name string")
    got = [r.exclusion_reason for r in spatial.text_exclusion(df, ["name", "group_name"], ["campbell", "snares"], "remote").collect()]
    assert got == ["remote", "remote", None]


def test_wkt(spark):
    text = spark.range(1).select(geo.square_wkt(F.lit(174.125), F.lit(-41.125), 0.25).alias("w")).first().w
    assert text == "POLYGON((174.000000 -41.250000, 174.250000 -41.250000, 174.250000 -41.000000, 174.000000 -41.000000, 174.000000 -41.250000))"


def test_domain_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cell_id,longitude,latitude,included_in_coastal_domain\nb,2.0,1.0, TRUE\nx,3.0,1.0,False\na,1.0,1.0,true\n")
    assert [r.cell_id for r in files.domain_cells(spark, str(tmp_path / "a.csv")).collect()] == ["a", "b"]
    (tmp_path / "b.csv").write_text("cell_id,longitude,latitude,included_in_coastal_domain\na,2.0,1.0,true\na,1.0,1.0,true\n")
    with pytest.raises(validate.ValidationError):
        files.domain_cells(spark, str(tmp_path / "b.csv"))


def test_publication_is_all_or_nothing(spark, tmp_path):
    p = files.Publication(spark, str(tmp_path / "pub"))
    good = spark.range(3)
    p.publish({"a": good, "b": good})
    before = p.current()
    bad = good.select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        p.publish({"a": spark.range(9), "b": bad})
    assert p.current() == before and p.read("a").count() == 3
    p.publish({"a": spark.range(9), "b": good})
    assert p.read("a").count() == 9
    with pytest.raises(ValueError):
        files.publication_plan()


def test_gate_runs_every_suite(spark, monkeypatch, tmp_path):
    sf, seen = "/root/testdata/sf0.001", {}
    monkeypatch.setattr(queries, "publish_checked", lambda _, tables, __: seen.update(tables) or tables["monitoring"])
    queries.QUERIES["daily_pipeline"](spark, sf)
    monkeypatch.undo()
    m = seen["monitoring"]
    drop = m.filter("is_provisional").limit(1).select("region_id", "date")
    seen["monitoring"] = m.join(drop, ["region_id", "date"], "left_anti").select(*m.columns)
    with pytest.raises(validate.ValidationError, match="^monitoring.missing_rows: 1$"):  # the other checks pass over a history without gaps
        queries.publish_checked(spark, seen, str(tmp_path / "pub"))
    assert not (tmp_path / "pub" / "current.json").exists()
    got = {r.check_name: r.failing_rows for r in queries.QUERIES["daily_report"](spark, sf).collect()}
    assert {n.split(".")[0] for n in got} == {"history", "climatology", "anomalies", "events", "preliminary", "monitoring"}
    assert got["monitoring.missing_rows"] == got["monitoring.extra_rows"] == 0 and got["history.missing_region_dates"] > 0
    assert "anomalies.regions_missing_on_last_date" in got


def test_geojson_round_trip(spark, tmp_path):
    (tmp_path / "r.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"region_id":1,"region_name":"N"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    r = files.read_geojson(spark, str(tmp_path / "r.geojson"), "region_id int, region_name string").first()
    assert r.region_id == 1 and len(r.ring) == 4 and r.ring[1].x == 1.0


def test_stream_equals_batch(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    rows = [(start + dt.timedelta(hours=7 * i), i % 2, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "time timestamp, region_id int, sst double")
    df.write.parquet(str(tmp_path / "in"))
    out = incremental.region_daily(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), lateness="1 day")
    q = out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.date, r.region_id): r.mean_sst_c for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    want = {(r.d, r.region_id): r.m for r in df.groupBy(F.to_date("time").alias("d"), "region_id").agg(F.avg("sst").alias("m")).collect()}
    assert got and all(want[k] == v for k, v in got.items()) and len(got) >= len(want) - 8


def test_stream_keeps_open_days(spark, tmp_path):
    def cut(df):
        return {tuple(r) for r in df.select("date", "region_id", "mean_sst_c", "cell_count", "min_sst_c", "max_sst_c").collect()}

    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["stream_region_daily"](spark, sf)
    assert cut(got) == cut(series.rounded(proxy.daily(spark, sf))) and got.count() == proxy.daily(spark, sf).count()
    start = dt.datetime(2026, 1, 1)
    rows = [(start + dt.timedelta(hours=7 * i), i % 2, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "time timestamp, region_id int, sst double").coalesce(1)
    for part in (df.limit(101), df.offset(99)):  # several files, read in batches that share a day
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = incremental.region_daily(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
        incremental.keep_daily(out, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    both = spark.read.parquet(str(tmp_path / "in")).withColumn("date", F.to_date("time"))
    assert cut(incremental.kept_daily(spark, str(tmp_path / "o"), out.schema)) == cut(series.daily_aggregate(both, ("region_id",)))


def test_stream_append_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(D(2026, 1, d), 1, 1.0) for d in (1, 2, 3)], "date date, region_id int, v double")
    df.limit(2).write.parquet(str(tmp_path / "t"))
    df.write.parquet(str(tmp_path / "in"))
    for i in range(2):  # a second stream with a new state replays everything
        incremental.append_missing(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / f"c{i}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_enrich_rejects_unknown(spark):
    df = spark.createDataFrame([(1,), (2,)], "region_id int")
    names = spark.createDataFrame([(1, "A", "a")], "region_id int, region_code string, region_name string")
    with pytest.raises(Exception, match="no labels"):
        monitoring.enrich(df, names).collect()
