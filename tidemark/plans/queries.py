"""The registered queries: each operator over the proxy tables, with its SQL."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, geo, labels
from ..operators import backfill, cells, gathered, history, monitoring, projection, series, spatial, validate
from ..sources import files
from ..streaming import incremental
from . import oracle, proxy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

D6 = series.rounded


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def work_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir; only a local session may do without."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = found.rstrip("/") if found else "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return f"{root}/tidemark/{uuid.uuid4().hex}"


S = oracle.sql
AN = series.ANOMALY_COLUMNS
AN_D = ("mean_sst_c", "min_sst_c", "max_sst_c", "clim_mean_sst_c", "clim_p90_sst_c", "anomaly_c", "rolling_7d_anomaly_c", "rolling_30d_anomaly_c", "warming_rate_7d_c")
EV = [
    "event_id", "region_id", "region_code", "region_name", *series.EVENT_COLUMNS,
]
EV_D = ("max_anomaly_c", "mean_anomaly_c", "max_exceedance_p90_c", "mean_exceedance_p90_c")
DAY_D = ("mean_sst_c", "min_sst_c", "max_sst_c")
PROD = ["data_product", "is_provisional"]


def an(extra: list[str] = []) -> tuple:  # noqa: B006
    return [*AN, *extra]


# --- scans, sources, sinks
@query("scan_daily", oracle.rounded("daily", history.DAILY, doubles=DAY_D))
def scan_daily(spark, sf):
    path = work_dir(spark)
    files.write_parquet(proxy.daily(spark, sf), path)
    return D6(files.read_parquet(spark, path, history.DAILY, allow_empty=False))


@query("scan_pruned", S("SELECT year(l_shipdate)::INT AS year, count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL"))
def scan_pruned(spark, sf):
    df = files.read_parquet(spark, f"{sf}/lineitem.parquet", ["l_shipdate", "l_quantity"])
    return df.groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


@query("missing_years", S("SELECT y::INT AS year FROM range(1990, 2006) r(y) WHERE y NOT IN (SELECT year(date) FROM daily)"))
def missing_years(spark, sf):
    return history.missing_years(proxy.daily(spark, sf).select(F.year("date").alias("year")), 1990, 2005)


@query("regions_from_geojson", S("SELECT polygon, w, e, s, n FROM (SELECT polygon, round(w, 6) AS w, round(e, 6) AS e, round(s, 6) AS s, round(n, 6) AS n FROM boxes)"))
def regions_from_geojson(spark, sf):
    path = work_dir(spark)
    files.write_geojson(proxy.boxes(spark, sf), path)
    back = files.read_geojson(spark, path, "polygon int", collection=False)
    return D6(back.select("polygon", F.explode("ring").alias("p")).groupBy("polygon").agg(F.min("p.x").alias("w"), F.max("p.x").alias("e"), F.min("p.y").alias("s"), F.max("p.y").alias("n")))


@query("domain_cells", S("SELECT cell_id, longitude, latitude FROM classified WHERE included_in_coastal_domain"))
def domain_cells(spark, sf):
    path = work_dir(spark)
    audit = spatial.classify(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS))
    files.write_csv(audit.withColumn("included_in_coastal_domain", F.concat(F.lit(" "), F.upper(F.col("included_in_coastal_domain").cast("string")))), path)
    return files.domain_cells(spark, path)


_HOLE = "lon > w + (e - w) / 3 AND lon < w + (e - w) / 3 * 2 AND lat > s + 0.01 AND lat < n - 0.01"


@query("ringed_regions", S(f"SELECT polygon, count(*) AS places FROM boxes, places WHERE lon > w AND lon < e AND (lat > s AND lat < n AND NOT (polygon % 3 = 0 AND {_HOLE}) OR polygon % 4 = 0 AND lat > s + 0.25 AND lat < n + 0.25) GROUP BY polygon"))
def ringed_regions(spark, sf):
    """Polygons with holes and several parts to GeoJSON and back, and the places inside of them."""
    path = work_dir(spark)
    files.write_geojson(proxy.ringed(spark, sf), path)
    back = files.read_geojson(spark, path, "polygon int", collection=False)
    places = proxy.points(spark, sf).select("lon", "lat").distinct()
    return spatial.assign(places, spatial.edges(back)).filter("polygon is not null").groupBy("polygon").agg(F.count(F.lit(1)).alias("places"))


_STUDY = (161.0, 170.0, -49.0, -44.0)
_CUT = "greatest(least({1}, 170.0) - greatest({0}, 161.0), 0) * greatest(least({3}, -44.0) - greatest({2}, -49.0), 0)"
_CLIPPED = f"""
SELECT polygon, round(area, 6) AS area FROM (
    SELECT polygon, {_CUT.format('w', 'e', 's', 'n')} - CASE WHEN polygon % 3 = 0 THEN {_CUT.format('(w + (e - w) / 3)', '(w + (e - w) / 3 * 2)', '(s + 0.01)', '(n - 0.01)')} ELSE 0 END
        + CASE WHEN polygon % 4 = 0 THEN {_CUT.format('w', 'e', '(s + 0.25)', '(n + 0.25)')} ELSE 0 END AS area
    FROM boxes
) WHERE area > 0"""


@query("clip_to_extent", S(_CLIPPED))
def clip_to_extent(spark, sf):
    """What is left of polygons with holes and several parts inside an extent."""
    cut = spatial.clip(proxy.ringed(spark, sf), *_STUDY)
    return D6(spatial.areas(spatial.edges(cut), metres=False))


_FAULTS = [(0, "edges cross"), (1, "unclosed ring"), (2, "ring touches itself"), (3, "edges overlap"), (3, "ring touches itself"), (4, "hole outside its shell"), (5, "ring of fewer than three places")]


@query("polygon_problems", S(" UNION ALL ".join(f"SELECT polygon, '{text}' AS problem FROM boxes WHERE polygon % 10 = {digit}" for digit, text in _FAULTS)))
def polygon_problems(spark, sf):
    return spatial.problems(proxy.ringed(spark, sf, faults=True)).select("polygon", "problem")


@query("overlap_areas", S("SELECT a.polygon, b.polygon AS other, round((least(a.e, b.e) - greatest(a.w, b.w)) * (least(a.n, b.n) - greatest(a.s, b.s)), 6) AS area FROM boxes a JOIN boxes b ON a.polygon < b.polygon AND least(a.e, b.e) > greatest(a.w, b.w) AND least(a.n, b.n) - greatest(a.s, b.s) > 0.01 WHERE a.polygon % 10 <> 0 AND b.polygon % 10 <> 0"))
def overlap_areas(spark, sf):
    """Area that pairs of polygons share, in square degrees."""
    plain = spatial.edges(proxy.boxes(spark, sf).filter("polygon % 10 <> 0"))
    return D6(spatial.overlap_areas(plain, metres=False, least=1e-6))


@query("flatten_grid", S("SELECT lon, lat, sst FROM grid WHERE sst IS NOT NULL"))
def flatten_grid(spark, sf):
    g = proxy.grid(spark, sf).withColumnsRenamed({"lon": "longitude", "lat": "latitude"}).withColumn("depth", F.lit(0.0))
    return series.flatten_grid(g).select("lon", "lat", "sst")


@query("filename_date_check", S("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 7 = 0"))
def filename_date_check(spark, sf):
    stated = F.date_add(F.to_date("l_shipdate"), F.when(F.col("l_linenumber") % 7 == 0, 1).otherwise(0))
    df = proxy.lineitem(spark, sf).withColumns({"file_name": F.concat(F.lit("oisst_"), F.date_format(stated, "yyyy-MM-dd"), F.lit(".nc")), "time": F.col("l_shipdate")})
    return files.file_date_mismatches(df).select("l_orderkey", "l_linenumber")


@query("sink_parquet_roundtrip", oracle.rounded("anomalies", AN, doubles=AN_D))
def sink_parquet_roundtrip(spark, sf):
    path = work_dir(spark)
    files.write_parquet(proxy.anomalies(spark, sf).withColumn("year", F.year("date")), path, partition_by=["year"], order_by=["region_id", "date"])
    return D6(files.read_parquet(spark, path).select(*AN))


@query("publish_counts", S("SELECT 'daily' AS table_name, count(*) AS rows FROM daily UNION ALL SELECT 'clim', count(*) FROM clim"))
def publish_counts(spark, sf):
    target = files.Publication(spark, work_dir(spark))
    target.publish(files.publication_plan(final={"daily": proxy.daily(spark, sf).limit(1)}))
    target.publish(files.publication_plan(final={"daily": proxy.daily(spark, sf), "clim": proxy.climatology(spark, sf)}))
    return monitoring.union([target.read(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n in target.current()["tables"]])


@query("cell_geojson", S("SELECT cell_id, longitude - 0.125 AS w, latitude - 0.125 AS s, longitude + 0.125 AS e, latitude + 0.125 AS n, 5 AS corners FROM grid_cells"))
def cell_geojson(spark, sf):
    c = proxy.grid_cells(spark, sf)
    at = lambda dx, dy: F.struct((F.col("longitude") + dx).alias("x"), (F.col("latitude") + dy).alias("y"))
    ring = F.array(*[at(x, y) for x, y in ((-0.125, -0.125), (0.125, -0.125), (0.125, 0.125), (-0.125, 0.125), (-0.125, -0.125))])
    text = files.geojson(c.select("cell_id", ring.alias("ring")))
    name = text.columns[-1]
    point = "array<array<array<double>>>"
    shape = F.from_json(name, f"type string, geometry struct<type:string,coordinates:{point}>, properties struct<cell_id:string>")
    rows = text.select(shape.alias("f")).filter("f.type = 'Feature' and f.geometry.type = 'Polygon'")
    ring = F.get(F.col("f.geometry.coordinates"), 0)
    edge = lambda i, pick: pick(F.transform(ring, lambda p: F.get(p, i)))
    return rows.select(
        "f.properties.cell_id", edge(0, F.array_min).alias("w"), edge(1, F.array_min).alias("s"), edge(0, F.array_max).alias("e"), edge(1, F.array_max).alias("n"), F.size(ring).alias("corners")
    )


# --- projections, filters
@query("conform_daily", oracle.rounded("daily", history.DAILY, doubles=DAY_D))
def conform_daily(spark, sf):
    return D6(series.conform(proxy.daily(spark, sf).withColumn("extra", F.lit(1)), history.DAILY))


@query("normalize_types", S("SELECT date, region_id::BIGINT AS region_id, cell_count::BIGINT AS cell_count, (cell_count > 3) AS busy FROM daily"))
def normalize_types(spark, sf):
    df = proxy.daily(spark, sf).select(F.col("date").cast("string"), F.col("region_id").cast("double"), F.col("cell_count").cast("string"), F.when(F.col("cell_count") > 3, "true").otherwise("false").alias("busy"))
    return series.normalize(df.withColumn("region_id", F.col("region_id").cast("long")), dates=["date"], integers=["region_id", "cell_count"], flags=["busy"])


@query("prepare_points", S("SELECT date, region_id, count(*) AS rows FROM points WHERE l_partkey % 5 <> 0 GROUP BY ALL"))
def prepare_points(spark, sf):
    li = proxy.lineitem(spark, sf).select(F.col("l_shipdate").alias("time"), (F.col("l_suppkey") % 6 + 1).cast("int").alias("region_id"), F.lit("x").alias("region_name"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity")).alias("sst"))
    return series.prepare_points(li).groupBy("date", "region_id").agg(F.count(F.lit(1)).alias("rows"))


@query("baseline_period", S(f"SELECT date, region_id, cell_count FROM daily WHERE date BETWEEN DATE '{proxy.BASELINE[0]}' AND DATE '{proxy.BASELINE[1]}'"))
def baseline_period(spark, sf):
    return series.period(proxy.daily(spark, sf), *proxy.BASELINE, required=True).select("date", "region_id", "cell_count")


@query("no_leap_doy", S("SELECT date, region_id, day_of_year::INT AS day_of_year FROM noleap"))
def no_leap_doy(spark, sf):
    return series.no_leap(proxy.daily(spark, sf)).select("date", "region_id", "day_of_year")


@query("standardise_source", S("SELECT date, region_id::BIGINT AS region_id, round(mean_sst_c, 6) AS mean_sst_c, 'gap' AS source_file, 1 AS source_priority FROM daily WHERE region_id <> 3"))
def standardise_source(spark, sf):
    bad = proxy.daily(spark, sf).withColumn("mean_sst_c", F.when(F.col("region_id") == 3, "n/a").otherwise(F.col("mean_sst_c").cast("string")))
    return D6(history.standardise(bad, "gap", 1).select("date", "region_id", "mean_sst_c", "source_file", "source_priority"))


@query("tag_preliminary", S("SELECT date, region_id, 'preliminary' AS data_product, true AS is_provisional FROM prelim"))
def tag_preliminary(spark, sf):
    return history.tag(proxy.preliminary(spark, sf), "preliminary", True).select("date", "region_id", *PROD)


@query("prelim_window", S(f"SELECT date, region_id, round(mean_sst_c, 6) AS mean_sst_c FROM daily WHERE date BETWEEN {oracle.W0} AND {oracle.W1}"))
def prelim_window(spark, sf):
    return D6(series.period(proxy.daily(spark, sf), *proxy.WINDOW, required=True).select("date", "region_id", "mean_sst_c"))


@query("events_overlap", S("SELECT event_id, start_date, end_date FROM heat WHERE end_date >= DATE '1998-01-01' AND start_date <= DATE '1998-12-31'"))
def events_overlap(spark, sf):
    return history.overlapping(proxy.events(spark, sf), "1998-01-01", "1998-12-31").select("event_id", "start_date", "end_date")


@query("text_exclusion", S("SELECT c_custkey, CASE WHEN regexp_matches(lower(coalesce(c_name, '') || ' | ' || coalesce(c_mktsegment, '')), '00001|build|(x)') THEN 'remote' END AS exclusion_reason FROM customer".replace("(x)", "\\(x\\)")))
def text_exclusion(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet")
    return spatial.text_exclusion(df, ["c_name", "c_mktsegment"], ["00001", "Build", "(x)"], "remote").select("c_custkey", "exclusion_reason")


@query("bbox_slice", S("SELECT lon, lat, count(*) AS rows FROM points WHERE lon BETWEEN 165 AND 175 AND lat BETWEEN -45 AND -38 GROUP BY ALL"))
def bbox_slice(spark, sf):
    return series.bbox(proxy.points(spark, sf), 165, 175, -45, -38).groupBy("lon", "lat").agg(F.count(F.lit(1)).alias("rows"))


@query("next_window", S(f"SELECT max(date) + 1 AS start_date, DATE '{proxy.TODAY}' - 18 AS end_date, max(date) + 1 <= DATE '{proxy.TODAY}' - 18 AS has_work FROM daily"))
def next_window(spark, sf):
    return history.next_window(proxy.daily(spark, sf), proxy.TODAY)


# --- joins
@query("point_in_region", S("SELECT p.lon, p.lat, i.polygon, count(*) AS rows FROM points p LEFT JOIN inside i ON p.lon = i.lon AND p.lat = i.lat GROUP BY ALL"))
def point_in_region(spark, sf):
    return spatial.assign(proxy.points(spark, sf), proxy.edges(spark, proxy.REGION_RINGS)).groupBy("lon", "lat", "polygon").agg(F.count(F.lit(1)).alias("rows"))


@query("multi_region_points", S("SELECT lon, lat, count(*) AS polygon_count FROM inside GROUP BY ALL HAVING count(*) > 1"))
def multi_region_points(spark, sf):
    return spatial.multiple(proxy.points(spark, sf), proxy.edges(spark, proxy.REGION_RINGS))


@query("join_climatology", S("SELECT date, region_id, round(clim_mean_sst_c, 6) AS clim_mean_sst_c, round(clim_p90_sst_c, 6) AS clim_p90_sst_c, sample_size FROM anomalies"))
def join_climatology(spark, sf):
    out = series.join_climatology(series.no_leap(proxy.daily(spark, sf)), proxy.climatology(spark, sf))
    return D6(out.select("date", "region_id", "clim_mean_sst_c", "clim_p90_sst_c", "sample_size"))


@query("deseasonalize", S("SELECT date, cell_id, round(month_mean_c, 6) AS month_mean_c, round(residual_c, 6) AS residual_c FROM residuals"))
def deseasonalize(spark, sf):
    return D6(cells.deseasonalize(proxy.cells(spark, sf)).select("date", "cell_id", "month_mean_c", "residual_c"))


@query("missing_rows_only", S("SELECT date, region_id FROM daily ANTI JOIN final USING (date, region_id)"))
def missing_rows_only(spark, sf):
    return history.missing_only(proxy.daily(spark, sf), proxy.final(spark, sf)).select("date", "region_id")


_CAL = "SELECT unnest(generate_series((SELECT min(date) FROM daily), (SELECT max(date) FROM daily), INTERVAL 1 DAY))::DATE AS date"


@query("missing_region_dates", S(f"SELECT region_id, date FROM (SELECT * FROM (SELECT DISTINCT region_id FROM daily), ({_CAL})) ANTI JOIN daily USING (region_id, date)"))
def missing_region_dates(spark, sf):
    return history.missing_keys(proxy.daily(spark, sf))


@query("key_set_diff", S("SELECT region_id, date, 'missing' AS side FROM final ANTI JOIN prelim USING (region_id, date) UNION ALL SELECT region_id, date, 'unexpected' FROM prelim ANTI JOIN final USING (region_id, date)"))
def key_set_diff(spark, sf):
    return history.key_difference(proxy.final(spark, sf), proxy.preliminary(spark, sf), ["region_id", "date"])


@query("monitoring_compare", S("SELECT region_id, date, data_product AS expected_product, CASE WHEN region_id <> 4 THEN CASE WHEN region_id = 5 THEN 'final' ELSE data_product END END AS actual_product, CASE WHEN region_id = 4 THEN 'missing' ELSE 'wrong_product' END AS problem FROM monitoring WHERE region_id = 4 OR region_id = 5 AND data_product <> 'final'"))
def monitoring_compare(spark, sf):
    m = proxy.monitoring(spark, sf)
    other = m.filter("region_id <> 4").withColumn("data_product", F.when(F.col("region_id") == 5, "final").otherwise(F.col("data_product")))
    return history.compare_products(m, other)


@query("enrich_labels", S("SELECT region_id, month_date, 'R' || region_id AS region_code, 'Region ' || region_id AS region_name FROM monthly"))
def enrich_labels(spark, sf):
    names = proxy.daily(spark, sf).select("region_id", "region_code", "region_name")
    return monitoring.enrich(proxy.monthly(spark, sf), names).select("region_id", "month_date", "region_code", "region_name")


@query("ocean_mask", S("SELECT cell_id, oisst_coordinate_exists, oisst_ocean_cell FROM masked"))
def ocean_mask(spark, sf):
    return spatial.ocean_mask(proxy.grid_cells(spark, sf), proxy.grid(spark, sf)).select("cell_id", "oisst_coordinate_exists", "oisst_ocean_cell")


@query("extract_cells", S("SELECT p.date, printf('oisst_%.3f_%.3f', p.lon, p.lat) AS cell_id, p.sst AS sst_c, count(*) AS rows FROM points p JOIN classified c ON p.lon = c.longitude AND p.lat = c.latitude WHERE c.included_in_coastal_domain GROUP BY ALL"))
def extract_cells(spark, sf):
    path = work_dir(spark)
    files.write_parquet(spatial.classify(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS)).filter("included_in_coastal_domain"), path)
    domain = spark.read.parquet(path)
    return cells.extract(proxy.points(spark, sf), domain).groupBy("date", "cell_id", "sst_c").agg(F.count(F.lit(1)).alias("rows"))


@query("absent_cells", S("SELECT c.cell_id, c.longitude, c.latitude FROM grid_cells c JOIN grid g ON c.longitude = g.lon AND c.latitude = g.lat WHERE g.sst IS NULL"))
def absent_cells(spark, sf):
    """Cells whose coordinates a grid of values lacks: those that an extraction would name."""
    return cells.absent_coordinates(proxy.grid(spark, sf).filter("sst is not null"), proxy.grid_cells(spark, sf)).select("cell_id", "longitude", "latitude")


@query("coordinate_agreement", S("SELECT cell_id, cell_id <> 'cell_7' AS agrees FROM (SELECT DISTINCT cell_id FROM cells)"))
def coordinate_agreement(spark, sf):
    places = proxy.cells(spark, sf).select("cell_id", "longitude", "latitude").distinct()
    moved = places.withColumn("longitude", F.col("longitude") + F.when(F.col("cell_id") == "cell_7", 0.001).otherwise(0.0))
    return cells.agreement(places, moved)


_SUMMARY_D = ("longitude", "latitude", *[c for c in cells.SUMMARY if c.endswith(("_c", "_per_year", "_per_decade", "_p_value", "_r_squared"))])
_SQUARE = "printf('POLYGON((%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f))', longitude - 0.125, latitude - 0.125, longitude + 0.125, latitude - 0.125, longitude + 0.125, latitude + 0.125, longitude - 0.125, latitude + 0.125, longitude - 0.125, latitude - 0.125)"
_SUMMARY_SQL = f"(SELECT f.* EXCLUDE (observation_count), f.observation_count AS historical_observation_count, t.* EXCLUDE (cell_id, longitude, latitude, observation_count), t.observation_count AS trend_observation_count, 0.25::DOUBLE AS cell_size_degrees, 'v1' AS grid_version, {_SQUARE.replace('longitude', 'f.longitude').replace('latitude', 'f.latitude')} AS geom_wkt, trend_standard_error_c_per_year * 10 AS trend_standard_error_c_per_decade FROM features f JOIN trends t USING (cell_id))"


@query("cell_summary_view", oracle.rounded(_SUMMARY_SQL, cells.SUMMARY, doubles=_SUMMARY_D))
def cell_summary_view(spark, sf):
    c = proxy.cells(spark, sf)
    places = c.select("cell_id", "longitude", "latitude").distinct()
    out = D6(cells.summary(places, cells.features(c), cells.trends(proxy.annual(spark, sf), *proxy.YEARS)))
    return out


#: The JSON of the events has one key, k; here it also stands under the names that the view reads.
_EXTRA = "CASE WHEN extra IS NOT NULL THEN json_object('k', extra ->> '$.k', 'step_name', status, 'rows_loaded', CASE WHEN event_id % 3 = 0 THEN '' ELSE extra ->> '$.k' END, 'date_min', strftime(ts, '%Y-%m-%d'), 'status_label_counts', json_object('Hot', event_id % 5)) END"
_STEP = ["event_id", "run_id", "pipeline_name", "level", *monitoring.STEP_TEXT, *monitoring.STEP_NUMBERS, *monitoring.STEP_DATES, *monitoring.STEP_OBJECTS]


@query("step_metrics_view", S(
    "SELECT event_id, run_id, pipeline_name, level, " + ", ".join(
        [f"x ->> '$.{k}' AS {k}" for k in monitoring.STEP_TEXT] + [f"try_cast(nullif(x ->> '$.{k}', '') AS BIGINT) AS {k}" for k in monitoring.STEP_NUMBERS]
        + [f"try_cast(nullif(x ->> '$.{k}', '') AS DATE) AS {k}" for k in monitoring.STEP_DATES] + [f"(x -> '$.{k}')::VARCHAR AS {k}" for k in monitoring.STEP_OBJECTS]
    ) + f" FROM (SELECT *, {_EXTRA} AS x FROM log) JOIN runs USING (run_id) WHERE x IS NOT NULL"
))
def step_metrics_view(spark, sf):
    k = F.get_json_object("extra", "$.k")
    fields = F.struct(
        k.alias("k"), F.col("status").alias("step_name"), F.when(F.col("event_id") % 3 == 0, "").otherwise(k).alias("rows_loaded"), F.date_format("ts", "yyyy-MM-dd").alias("date_min"),
        F.struct((F.col("event_id") % 5).alias("Hot")).alias("status_label_counts"),
    )
    log = proxy.log(spark, sf).withColumn("extra", F.when(F.col("extra").isNotNull(), F.to_json(fields, {"ignoreNullFields": "false"})))
    return monitoring.step_metrics(proxy.runs(spark, sf), log).select(*_STEP)


@query("distance_to_land", S("SELECT cell_id, is_land, round(distance_to_land_km, 4) AS distance_to_land_km FROM classified"))
def distance_to_land(spark, sf):
    out = spatial.distances(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS), 75.0)
    return out.select("cell_id", "is_land", F.round("distance_to_land_km", 4).alias("distance_to_land_km"))


# --- aggregations
@query("region_daily_sst", oracle.rounded("daily", history.DAILY, doubles=DAY_D))
def region_daily_sst(spark, sf):
    return D6(proxy.daily(spark, sf))


@query("climatology", S("SELECT region_id, region_code, region_name, day_of_year::INT AS day_of_year, round(clim_mean_sst_c, 6) AS clim_mean_sst_c, round(clim_p90_sst_c, 6) AS clim_p90_sst_c, sample_size FROM clim"))
def climatology(spark, sf):
    return D6(proxy.climatology(spark, sf))


@query("monthly_means", S("SELECT region_id, month_date, round(mean_sst_c, 6) AS mean_sst_c, year, month FROM monthly"))
def monthly_means(spark, sf):
    return D6(proxy.monthly(spark, sf))


@query("monthly_history", S("SELECT region_id, region_name, month_date, round(mean_sst_c, 6) AS mean_sst_c, round(min_sst_c, 6) AS min_sst_c, round(max_sst_c, 6) AS max_sst_c, round(sd_sst_c, 6) AS sd_sst_c, n_days, year(month_date)::INT AS year, month(month_date)::INT AS month, round((month_date - (SELECT date_trunc('month', min(date))::DATE FROM daily)) / 365.25, 6) AS time_index_years, round(sin(2 * pi() * month(month_date) / 12), 6) + 0.0 AS sin_month, round(cos(2 * pi() * month(month_date) / 12), 6) + 0.0 AS cos_month FROM (SELECT region_id, region_name, date_trunc('month', date)::DATE AS month_date, avg(mean_sst_c) AS mean_sst_c, min(mean_sst_c) AS min_sst_c, max(mean_sst_c) AS max_sst_c, stddev_samp(mean_sst_c) AS sd_sst_c, count(DISTINCT date) AS n_days FROM daily GROUP BY ALL)"))
def monthly_history(spark, sf):
    out = D6(projection.monthly_history(proxy.daily(spark, sf)))
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("sin_month", "cos_month")})


_F = [*cells.PLACE, *cells.FEATURES]
_FD = tuple(c for c in _F if c.endswith("_c") or c in ("longitude", "latitude"))


@query("cell_features", oracle.rounded("features", _F, doubles=_FD))
def cell_features(spark, sf):
    return D6(cells.features(proxy.cells(spark, sf)).select(*_F))


@query("cell_monthly_pivot", oracle.rounded("pivoted", ["cell_id", *[f"mean_{m}_sst_c" for m in cells.MONTHS]], doubles=_FD))
def cell_monthly_pivot(spark, sf):
    return D6(cells.monthly_pivot(proxy.cells(spark, sf)))


@query("deseasonalized_sd", oracle.rounded("features", ["cell_id", "deseasonalized_daily_sd_sst_c"], doubles=_FD))
def deseasonalized_sd(spark, sf):
    return D6(cells.deseasonalized_sd(proxy.cells(spark, sf)))


@query("interannual_sd", oracle.rounded("features", ["cell_id", "annual_mean_sd_sst_c"], doubles=_FD))
def interannual_sd(spark, sf):
    return D6(cells.interannual_sd(proxy.cells(spark, sf)))


@query("annual_cell_means", oracle.rounded("annual_all", ["cell_id", "longitude", "latitude", "year", "annual_mean_sst_c", "observation_count"], doubles=("annual_mean_sst_c",)))
def annual_cell_means(spark, sf):
    return D6(cells.annual_means(proxy.cells(spark, sf)))


_T = ["cell_id", "longitude", "latitude", "trend_c_per_year", "trend_c_per_decade", "trend_standard_error_c_per_year", "trend_p_value", "trend_r_squared", "baseline_start_year", "baseline_end_year", "year_count", "observation_count", "estimated_change_over_period_c"]
_TD = ("trend_c_per_year", "trend_c_per_decade", "trend_standard_error_c_per_year", "trend_p_value", "trend_r_squared", "estimated_change_over_period_c")


@query("warming_trends", oracle.rounded("trends", _T, doubles=_TD))
def warming_trends(spark, sf):
    return D6(cells.trends(proxy.annual(spark, sf), *proxy.YEARS))


@query("trend_significance", oracle.rounded("trends", ["cell_id", "trend_standard_error_c_per_year", "trend_p_value"], doubles=_TD))
def trend_significance(spark, sf):
    return D6(cells.trends(proxy.annual(spark, sf), *proxy.YEARS).select("cell_id", "trend_standard_error_c_per_year", "trend_p_value"))


@query("heat_events", oracle.rounded("heat", EV, 4, doubles=EV_D))
def heat_events(spark, sf):
    return D6(proxy.events(spark, sf), 4)


@query("dashboard_measures", S("SELECT (SELECT max(date) FROM monitoring WHERE NOT is_provisional) AS latest_final_date, (SELECT max(date) FROM monitoring WHERE is_provisional) AS latest_preliminary_date, (SELECT count(DISTINCT event_id) FROM heat WHERE is_active) AS active_events, count(DISTINCT region_id) FILTER (WHERE above_p90) AS regions_above_p90, round(max(anomaly_c), 6) AS max_anomaly_c, round(avg(anomaly_c), 6) AS mean_anomaly_c FROM anomalies WHERE date = (SELECT max(date) FROM anomalies)"))
def dashboard_measures(spark, sf):
    return D6(monitoring.dashboard(proxy.anomalies(spark, sf), proxy.events(spark, sf), proxy.monitoring(spark, sf)))


@query("latest_status", S("SELECT date, region_id, round(anomaly_c, 6) AS anomaly_c, round(rolling_30d_anomaly_c, 6) AS rolling_30d_anomaly_c, status_label FROM anomalies WHERE date = (SELECT max(date) FROM anomalies)"))
def latest_status(spark, sf):
    return D6(monitoring.latest_status(proxy.anomalies(spark, sf), ["date", "region_id", "anomaly_c", "rolling_30d_anomaly_c", "status_label"]))


@query("output_metrics", S("SELECT 'anomalies' AS table_name, count(*) AS row_count, 18 AS column_count, count(DISTINCT region_id) AS entity_count, min(date) AS first_date, max(date) AS last_date, (SELECT '{' || string_agg('\"' || status_label || '\":' || n, ',' ORDER BY status_label) || '}' FROM (SELECT status_label, count(*) AS n FROM anomalies GROUP BY ALL)) AS status_label_counts FROM anomalies"))
def output_metrics(spark, sf):
    return monitoring.metrics(proxy.anomalies(spark, sf), "anomalies", ["status_label"])


@query("table_metrics", S("SELECT 'daily' AS table_name, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date FROM daily UNION ALL SELECT 'events', count(*), min(start_date), max(start_date) FROM heat UNION ALL SELECT 'monthly', count(*), min(month_date), max(month_date) FROM monthly"))
def table_metrics(spark, sf):
    return monitoring.table_metrics({"daily": (proxy.daily(spark, sf), "date"), "events": (proxy.events(spark, sf), "start_date"), "monthly": (proxy.monthly(spark, sf), "month_date")})


@query("coverage_by_region", S("SELECT region_id, date_trunc('month', min(date))::DATE AS first_month, date_trunc('month', max(date))::DATE AS last_month, count(DISTINCT date_trunc('month', date)) AS month_count, count(*) AS row_count, round(avg(mean_sst_c), 6) AS mean_sst_c FROM daily GROUP BY region_id"))
def coverage_by_region(spark, sf):
    return D6(monitoring.coverage(proxy.daily(spark, sf)))


@query("count_reconciliation", S("SELECT 'clim' AS table_name, 2190::BIGINT AS expected_rows, (SELECT count(*) FROM clim) AS actual_rows, CASE WHEN (SELECT count(*) FROM clim) = 2190 THEN 'PASS' ELSE 'FAIL' END AS result UNION ALL SELECT 'daily', 1, (SELECT count(*) FROM daily), CASE WHEN (SELECT count(*) FROM daily) = 1 THEN 'PASS' ELSE 'FAIL' END UNION ALL SELECT 'other', 5, NULL, 'MISSING'"))
def count_reconciliation(spark, sf):
    expected = spark.createDataFrame([("clim", 2190), ("daily", 1), ("other", 5)], "table_name string, expected_rows bigint")
    return monitoring.reconcile({"clim": proxy.climatology(spark, sf), "daily": proxy.daily(spark, sf)}, expected)


@query("extraction_manifest", S("SELECT year(date)::INT AS year, count(DISTINCT date) AS files_processed, count(DISTINCT cell_id) AS cell_count, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date, 'complete' AS status, 'cells_' || year(date) || '.parquet' AS output_file FROM cells GROUP BY year(date)"))
def extraction_manifest(spark, sf):
    return cells.manifest(proxy.cells(spark, sf))


def _audit(spark, sf):
    return spatial.ocean_mask(spatial.classify(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS)), proxy.grid(spark, sf))


@query("grid_summary", S("SELECT count(*) AS total_cells, count(*) FILTER (WHERE is_land) AS land_cells, count(*) FILTER (WHERE included_in_coastal_domain AND oisst_ocean_cell) AS included_cells, count(*) FILTER (WHERE oisst_ocean_cell) AS native_ocean_cells, count(*) FILTER (WHERE NOT is_land AND NOT oisst_ocean_cell) AS masked_out_cells, count(*) FILTER (WHERE NOT is_land AND NOT (included_in_coastal_domain AND oisst_ocean_cell)) AS offshore_cells FROM masked"))
def grid_summary(spark, sf):
    return monitoring.grid_summary(_audit(spark, sf))


@query("value_ranges", S("SELECT round(min(mean_sst_c), 6) AS min_mean_sst_c, round(max(mean_sst_c), 6) AS max_mean_sst_c, round(min(seasonal_amplitude_c), 6) AS min_seasonal_amplitude_c, round(max(seasonal_amplitude_c), 6) AS max_seasonal_amplitude_c FROM features"))
def value_ranges(spark, sf):
    return D6(monitoring.value_ranges(cells.features(proxy.cells(spark, sf)), ["mean_sst_c", "seasonal_amplitude_c"]))


@query("stage_diagnostics", S("SELECT * FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE clim_mean_sst_c IS NULL) AS without_climatology, count(*) FILTER (WHERE above_p90) AS above_p90, " + ", ".join(f"count(*) FILTER (WHERE status_label = '{s}') AS status_{s.lower()}" for s in ("Unknown", "Normal", "Watch", "Hot", "Extreme")) + " FROM anomalies), (SELECT count(*) AS events, count(*) FILTER (WHERE is_active) AS active_events, max(duration_days) AS longest_days, " + ", ".join(f"count(*) FILTER (WHERE severity_class = '{s}') AS severity_{s.lower()}" for s in ("Weak", "Moderate", "Severe", "Extreme")) + " FROM heat)"))
def stage_diagnostics(spark, sf):
    return monitoring.stage_diagnostics(proxy.anomalies(spark, sf), proxy.events(spark, sf))


# --- windows, sorts, sets
@query("rolling_anomaly", S("SELECT date, region_id, round(rolling_7d_anomaly_c, 6) AS rolling_7d_anomaly_c, round(rolling_30d_anomaly_c, 6) AS rolling_30d_anomaly_c FROM anomalies"))
def rolling_anomaly(spark, sf):
    return D6(proxy.anomalies(spark, sf).select("date", "region_id", "rolling_7d_anomaly_c", "rolling_30d_anomaly_c"))


@query("warming_rate", S("SELECT date, region_id, round(warming_rate_7d_c, 6) AS warming_rate_7d_c FROM anomalies"))
def warming_rate(spark, sf):
    return D6(proxy.anomalies(spark, sf).select("date", "region_id", "warming_rate_7d_c"))


@query("event_runs", S("SELECT region_id, run_id::BIGINT AS run_id, min(date) AS first_date, max(date) AS last_date, count(*) AS days, bool_or(above_p90) AS is_event FROM heat_r GROUP BY region_id, run_id"))
def event_runs(spark, sf):
    runs = series.event_runs(series.event_days(proxy.anomalies(spark, sf)))
    return runs.groupBy("region_id", "run_id").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("days"), F.max("is_event").alias("is_event"))


_FULL = f"(SELECT *, 'baseline' AS source_file, 0 AS source_priority FROM daily WHERE date <= DATE '1999-12-31' UNION ALL SELECT *, 'gap', 1 FROM daily WHERE date BETWEEN DATE '1999-06-01' AND DATE '2000-12-31' UNION ALL SELECT *, 'current', 2 FROM daily WHERE date >= DATE '2000-06-01')"
_BEST = "QUALIFY row_number() OVER (PARTITION BY region_id, date ORDER BY source_priority DESC) = 1"


def _sources(spark, sf):
    d = proxy.daily(spark, sf)
    return [
        history.standardise(series.period(d, None, "1999-12-31"), "baseline", 0), history.standardise(series.period(d, "1999-06-01", "2000-12-31"), "gap", 1),
        history.standardise(series.period(d, "2000-06-01"), "current", 2),
    ]


@query("dedup_priority", S(f"SELECT date, region_id::BIGINT AS region_id, source_file FROM {_FULL} {_BEST}"))
def dedup_priority(spark, sf):
    return history.keep_highest(monitoring.union(_sources(spark, sf))).select("date", "region_id", "source_file")


@query("full_history", S(f"SELECT date, region_id::BIGINT AS region_id, region_code, region_name, round(mean_sst_c, 6) AS mean_sst_c, cell_count, min_sst_c, max_sst_c, source_file, source_priority FROM {_FULL} {_BEST}"))
def full_history(spark, sf):
    return D6(history.merge_sources(_sources(spark, sf)))


@query("append_missing", S("SELECT date, region_id, round(mean_sst_c, 6) AS mean_sst_c FROM final UNION ALL SELECT date, region_id, round(mean_sst_c, 6) FROM prelim ANTI JOIN final USING (date, region_id)"))
def append_missing(spark, sf):
    return D6(history.append_missing(proxy.final(spark, sf), proxy.preliminary(spark, sf)).select("date", "region_id", "mean_sst_c"))


@query("backfill_days", S("SELECT date, region_id, round(mean_sst_c, 6) AS mean_sst_c FROM final UNION ALL SELECT date, region_id, round(mean_sst_c, 6) FROM prelim ANTI JOIN final USING (date, region_id)"))
def backfill_days(spark, sf):
    """The table of days after a backfill of the last weeks by the preliminary rows: stored rows stay."""
    table = f"{work_dir(spark)}/days"
    backfill.write_months(proxy.final(spark, sf), table)
    rows = proxy.preliminary(spark, sf)
    days = [r[0] for r in rows.select("date").distinct().collect()]  # three weeks
    backfill.backfill(spark, lambda d: rows.filter(F.col("date").isin(list(d))), days, table, work_dir(spark))
    return D6(spark.read.parquet(table).select("date", "region_id", "mean_sst_c"))


@query("sorted_output", S("SELECT region_id, date, cell_count FROM daily ORDER BY region_id, date"))
def sorted_output(spark, sf):
    return proxy.daily(spark, sf).select("region_id", "date", "cell_count").orderBy("region_id", "date")


@query("recent_months", S("SELECT region_id, month_date, round(mean_sst_c, 6) AS mean_sst_c FROM monthly ORDER BY month_date DESC, region_id LIMIT 18"))
def recent_months(spark, sf):
    return D6(monitoring.recent(proxy.monthly(spark, sf).select("region_id", "month_date", "mean_sst_c"), "month_date", 18, "region_id"))


@query("monitoring_anomalies", oracle.rounded("monitoring", [*AN, *PROD], doubles=AN_D))
def monitoring_anomalies(spark, sf):
    return D6(proxy.monitoring(spark, sf).select(*AN, *PROD))


@query("prelim_anomaly_input", oracle.rounded("prelim_in", history.DAILY, doubles=DAY_D))
def prelim_anomaly_input(spark, sf):
    return D6(history.preliminary_input(proxy.final(spark, sf), proxy.preliminary(spark, sf), proxy.WINDOW[0], proxy.HISTORY_DAYS))


@query("prelim_event_input", oracle.rounded("prelim_event_in", AN, doubles=AN_D))
def prelim_event_input(spark, sf):
    earlier = history.before_window(series.anomalies(proxy.final(spark, sf), proxy.climatology(spark, sf)), proxy.WINDOW[0])
    return D6(earlier.unionByName(proxy.preliminary_anomalies(spark, sf).drop(*PROD)).select(*AN))


_HOLES = "(SELECT DISTINCT o_orderdate::DATE AS date FROM orders)"


@query("missing_dates", S(f"SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM {_HOLES} EXCEPT SELECT date FROM {_HOLES}"))
def missing_dates(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").select(F.to_date("o_orderdate").alias("date"))
    return history.missing_dates(df)


# --- generators and functions
@query("date_spine", S(_CAL))
def date_spine(spark, sf):
    ends = proxy.daily(spark, sf).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return ends.select(F.explode(calendar.days(F.col("a"), F.col("b"))).alias("date"))


@query("future_months", S("SELECT region_id, unnest(generate_series(last + INTERVAL 1 MONTH, last + INTERVAL 120 MONTH, INTERVAL 1 MONTH))::DATE AS month_date FROM (SELECT region_id, max(month_date) AS last FROM monthly GROUP BY ALL)"))
def future_months(spark, sf):
    return projection.future_months(proxy.monthly(spark, sf))


_EXTENT = "(SELECT min(lon) - 0.1 AS w, max(lon) + 0.1 AS e, min(lat) - 0.1 AS s, max(lat) + 0.1 AS n FROM points)"


def _centre_sql(low: str, high: str) -> str:
    return f"unnest(list_transform(range(ceil(({low} - 0.125) / 0.25)::BIGINT, floor(({high} - 0.125) / 0.25)::BIGINT + 1), lambda i: 0.125::DOUBLE + 0.25::DOUBLE * i))"


def _extent(spark, sf):
    return proxy.points(spark, sf).agg((F.min("lon") - 0.1).alias("west"), (F.max("lon") + 0.1).alias("east"), (F.min("lat") - 0.1).alias("south"), (F.max("lat") + 0.1).alias("north"))


@query("grid_centres", S(f"SELECT {_centre_sql('w', 'e')} AS longitude FROM {_EXTENT}"))
def grid_centres(spark, sf):
    return _extent(spark, sf).select(F.explode(spatial.centres(F.col("west"), F.col("east"))).alias("longitude"))


@query("coastal_grid", S(f"SELECT printf('oisst_%.3f_%.3f', longitude, latitude) AS cell_id, longitude, latitude FROM (SELECT {_centre_sql('w', 'e')} AS longitude, s, n FROM {_EXTENT}), LATERAL (SELECT {_centre_sql('s', 'n')} AS latitude)"))
def coastal_grid(spark, sf):
    return spatial.build_grid(_extent(spark, sf))


@query("event_id_uuid5", S("SELECT event_id, region_id, start_date FROM heat"))
def event_id_uuid5(spark, sf):
    return proxy.events(spark, sf).select(labels.event_id(F.col("region_id"), F.col("start_date")).alias("event_id"), "region_id", "start_date")


@query("status_labels", S(f"SELECT l_orderkey, l_linenumber, {oracle.STATUS.format('(l_quantity / 20 - 0.5)')} AS status FROM lineitem"))
def status_labels(spark, sf):
    return proxy.lineitem(spark, sf).select("l_orderkey", "l_linenumber", labels.status(F.col("l_quantity") / 20 - 0.5).alias("status"))


@query("severity_labels", S(f"SELECT l_orderkey, l_linenumber, {oracle.SEVERITY.format('(l_quantity / 16 - 0.5)')} AS severity FROM lineitem"))
def severity_labels(spark, sf):
    return proxy.lineitem(spark, sf).select("l_orderkey", "l_linenumber", labels.severity(F.col("l_quantity") / 16 - 0.5).alias("severity"))



@query("cell_wkt", S("SELECT cell_id, printf('POLYGON((%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f))', longitude - 0.125, latitude - 0.125, longitude + 0.125, latitude - 0.125, longitude + 0.125, latitude + 0.125, longitude - 0.125, latitude + 0.125, longitude - 0.125, latitude - 0.125) AS geom_wkt FROM grid_cells"))
def cell_wkt(spark, sf):
    return proxy.grid_cells(spark, sf).select("cell_id", geo.square_wkt(F.col("longitude"), F.col("latitude"), 0.25).alias("geom_wkt"))


@query("decimal_year", S("SELECT DISTINCT date, round(year(date) + (dayofyear(date) - 1) / 365.25, 6) AS decimal_year FROM daily"))
def decimal_year(spark, sf):
    return proxy.daily(spark, sf).select("date").distinct().select("date", F.round(calendar.decimal_year(F.col("date")), 6).alias("decimal_year"))


@query("json_step_metrics", S("SELECT (extra ->> '$.k')::BIGINT AS k, count(*) AS events FROM log GROUP BY ALL"))
def json_step_metrics(spark, sf):
    return proxy.log(spark, sf).groupBy(F.nullif(F.get_json_object("extra", "$.k"), F.lit("")).try_cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("events"))


@query("download_manifest", S("SELECT date, 'https://example.invalid/avhrr/' || strftime(date, '%Y%m') || '/oisst-avhrr-v02r01.' || strftime(date, '%Y%m%d') || '.nc' AS url, 'oisst_' || date || '.nc' AS file_name FROM (SELECT DISTINCT date FROM daily)"))
def download_manifest(spark, sf):
    return files.download_manifest(proxy.daily(spark, sf).select("date").distinct())


# --- spatial
@query("project_nztm", S(f"SELECT lon, lat, round({oracle.nztm('lon', 'lat')[0]}, 1) AS easting, round({oracle.nztm('lon', 'lat')[1]}, 1) AS northing FROM places"))
def project_nztm(spark, sf):
    out = geo.with_nztm(proxy.points(spark, sf).select("lon", "lat").distinct(), "lon", "lat", "easting", "northing")
    return out.select("lon", "lat", F.round("easting", 1).alias("easting"), F.round("northing", 1).alias("northing"))


@query("classify_cells", S("SELECT cell_id, is_land, round(distance_to_land_km, 4) AS distance_to_land_km, included_in_coastal_domain FROM classified"))
def classify_cells(spark, sf):
    out = spatial.classify(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS), beyond=True)
    return out.select("cell_id", "is_land", F.round("distance_to_land_km", 4).alias("distance_to_land_km"), "included_in_coastal_domain")


def _turned(p: str, q: str, r: str, t: str, u: str, v: str) -> str:
    return f"(({r} - {p}) * ({v} - {q}) - ({t} - {q}) * ({u} - {p}))"


_E, _A = ("e.ex", "e.ey", "e.ex2", "e.ey2"), ("a.ex", "a.ey", "a.ex2", "a.ey2")
_GAP = f"""CASE WHEN {_turned(*_E, *_A[:2])} * {_turned(*_E, *_A[2:])} < 0 AND {_turned(*_A, *_E[:2])} * {_turned(*_A, *_E[2:])} < 0 THEN 0.0
    ELSE least({oracle._segment(*_E[:2], *_A)}, {oracle._segment(*_E[2:], *_A)}, {oracle._segment(*_A[:2], *_E)}, {oracle._segment(*_A[2:], *_E)}) END"""
_MAINLAND = f"""
, mr AS (
    SELECT polygon, 0 AS r, w AS x0, e AS x1, s AS y0, n AS y1 FROM boxes UNION ALL SELECT polygon, 1, w + (e - w) / 3, w + (e - w) / 3 * 2, s + 0.01, n - 0.01 FROM boxes WHERE polygon % 3 = 0
    UNION ALL SELECT polygon, 2, w, e, s + 0.25, n + 0.25 FROM boxes WHERE polygon % 4 = 0
), ml AS (
    SELECT polygon, r AS n, x0 AS x, y0 AS y, x1 AS x2, y0 AS y2 FROM mr UNION ALL SELECT polygon, r, x1, y0, x1, y1 FROM mr UNION ALL SELECT polygon, r, x1, y1, x0, y1 FROM mr UNION ALL SELECT polygon, r, x0, y1, x0, y0 FROM mr
), me AS MATERIALIZED ({oracle._projected_edges('ml')}
), ms AS (
    SELECT polygon, sum(CASE WHEN n = 1 THEN -a ELSE a END) AS area FROM (SELECT polygon, n, abs(sum(ex * ey2 - ex2 * ey)) / 2 AS a FROM me GROUP BY ALL) GROUP BY polygon
), mt AS (
    SELECT polygon FROM ms ORDER BY area DESC, polygon LIMIT 3
), md AS (
    SELECT e.polygon, min({_GAP}) / 1000 AS km FROM me e, (SELECT * FROM me WHERE polygon IN (SELECT polygon FROM mt)) a GROUP BY e.polygon
)
SELECT polygon, round(area / 1e6, 3) AS area_km2, CASE WHEN km <= 80 THEN round(km, 3) END AS distance_km, km <= 80 AS kept FROM ms JOIN md USING (polygon)"""


@query("mainland_split", S(_MAINLAND.replace("\n, mr", ", mr", 1)))
def mainland_split(spark, sf):
    """Polygons with holes and several parts: area, distance to the three largest, and whether they are kept."""
    out = spatial.mainland(spatial.edges(proxy.ringed(spark, sf)))
    return out.select("polygon", F.round(F.col("area_m2") / 1e6, 3).alias("area_km2"), F.round("distance_km", 3).alias("distance_km"), "kept")


@query("extent_filter", S("SELECT polygon FROM boxes WHERE w <= 170 AND e >= 161 AND s <= -44 AND n >= -49"))
def extent_filter(spark, sf):
    return spatial.in_extent(spatial.edges(proxy.boxes(spark, sf)), 161, 170, -49, -44)


@query("invalid_polygons", S("SELECT polygon, 1::BIGINT AS crossings FROM boxes WHERE polygon % 10 = 0"))
def invalid_polygons(spark, sf):
    return spatial.invalid(spatial.edges(proxy.boxes(spark, sf))).select("polygon", "crossings")


@query("region_overlap", S("SELECT a.polygon, b.polygon AS other, count(*) AS shared_cells FROM inside a JOIN inside b ON a.lon = b.lon AND a.lat = b.lat AND a.polygon < b.polygon GROUP BY ALL"))
def region_overlap(spark, sf):
    return spatial.overlap(proxy.points(spark, sf), proxy.edges(spark, proxy.REGION_RINGS))


_REG = "(SELECT n_nationkey AS region_id, n_name AS region_code, CASE WHEN n_nationkey <> 3 THEN 'Region ' || (n_nationkey % 20) END AS region_name FROM nation JOIN (SELECT DISTINCT s_nationkey FROM supplier) ON n_nationkey = s_nationkey)"


@query("region_attribute_check", oracle.checks([
    *[(f"null_{c}", f"SELECT count(*) FROM {_REG} WHERE {c} IS NULL") for c in ("region_id", "region_code", "region_name")],
    *[(f"duplicate_{c}", f"SELECT count(*) FROM (SELECT {c} FROM {_REG} GROUP BY {c} HAVING count(*) > 1)") for c in ("region_id", "region_code", "region_name")],
]))
def region_attribute_check(spark, sf):
    used = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    n = spark.read.parquet(f"{sf}/nation.parquet").join(used, "n_nationkey")
    name = F.when(F.col("n_nationkey") != 3, F.concat(F.lit("Region "), (F.col("n_nationkey") % 20).cast("string")))
    return validate.region_attributes(n.select(F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("region_code"), name.alias("region_name")))


# --- models
_PB = (1995, 1999)
_P = f"""
, ps AS (
    SELECT region_id, month_date, year, month, mean_sst_c, year + (dayofyear(month_date) - 1) / 365.25 AS x, year >= {_PB[0]} AS recent FROM monthly
), pc AS (
    -- five baseline years are fewer than ten, so all years count
    SELECT region_id, month, avg(mean_sst_c) AS clim FROM ps GROUP BY ALL
), pl AS (
    SELECT region_id, regr_slope(mean_sst_c - clim, x) AS slope, regr_intercept(mean_sst_c - clim, x) AS intercept FROM ps JOIN pc USING (region_id, month) WHERE recent GROUP BY ALL
), pr AS (
    SELECT ps.*, clim, slope, clim + intercept + slope * x AS trend, mean_sst_c - (clim + intercept + slope * x) AS residual FROM ps JOIN pc USING (region_id, month) JOIN pl USING (region_id)
), pm AS (
    SELECT region_id, month, count(*) AS n, quantile_cont(residual, 0.1) AS m10, quantile_cont(residual, 0.9) AS m90 FROM pr GROUP BY ALL
), pa AS (
    SELECT region_id, quantile_cont(residual, 0.1) AS a10, quantile_cont(residual, 0.9) AS a90 FROM pr GROUP BY ALL
), p12 AS (
    SELECT region_id, avg(mean_sst_c) AS last12 FROM (SELECT * FROM ps QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY month_date DESC) <= 12) GROUP BY ALL
), pf AS (
    SELECT region_id, unnest(generate_series(last + INTERVAL 1 MONTH, last + INTERVAL 120 MONTH, INTERVAL 1 MONTH))::DATE AS month_date FROM (SELECT region_id, max(month_date) AS last FROM ps GROUP BY ALL)
), pp AS (
    SELECT pf.region_id, month_date, year(month_date)::INT AS year, month(month_date)::INT AS month, clim, slope, last12,
        clim + intercept + slope * (year(month_date) + (dayofyear(month_date) - 1) / 365.25) AS trend, CASE WHEN n >= 5 THEN m10 ELSE a10 END AS q10, CASE WHEN n >= 5 THEN m90 ELSE a90 END AS q90
    FROM pf JOIN pc ON pf.region_id = pc.region_id AND month(pf.month_date) = pc.month JOIN pl ON pl.region_id = pf.region_id JOIN pm ON pm.region_id = pf.region_id AND pm.month = pc.month
        JOIN pa ON pa.region_id = pf.region_id JOIN p12 ON p12.region_id = pf.region_id
)
SELECT region_id, month_date, year, month, 'observed' AS observed_or_projected, 'observed' AS scenario, 'NOAA_OISST' AS model_id, round(mean_sst_c, 5) AS mean_sst_c, round(mean_sst_c, 5) AS median_sst_c,
    NULL::DOUBLE AS p10_sst_c, NULL::DOUBLE AS p90_sst_c, round(clim, 5) AS monthly_climatology_sst_c, round(slope, 5) AS trend_c_per_year, round(slope * 10, 5) AS trend_c_per_decade, 0.0::DOUBLE AS warming_from_last_observed_c
FROM pr UNION ALL
SELECT region_id, month_date, year, month, 'projected', 'local_trend', 'OISST_seasonal_trend_residual', NULL, round(trend, 5), round(trend + q10, 5), round(trend + q90, 5), round(clim, 5), round(slope, 5), round(slope * 10, 5),
    round(trend - last12, 5) FROM pp
"""


@query("projection", S(_P.replace("\n, ps AS", ", ps AS", 1)))
def projection_query(spark, sf):
    return D6(projection.project(proxy.monthly(spark, sf), base=_PB), 5)


_LB = (1985, 1999)
_WEEKS = "(SELECT *, year(month_date)::INT AS year, month(month_date)::INT AS month FROM (SELECT region_id, (DATE '1980-01-01' + to_months((date - DATE '1995-01-01') // 7))::DATE AS month_date, avg(mean_sst_c) AS mean_sst_c FROM daily GROUP BY ALL))"
_PW = (
    _P.replace("FROM monthly", f"FROM {_WEEKS}").replace(f"year >= {_PB[0]} AS recent", f"year >= {_LB[0]} AS recent").replace("-- five baseline years are fewer than ten, so all years count\n", "")
    .replace("avg(mean_sst_c) AS clim FROM ps GROUP BY ALL", f"avg(mean_sst_c) AS clim FROM ps WHERE year BETWEEN {_LB[0]} AND {_LB[1]} GROUP BY ALL").replace("FROM pr GROUP BY ALL", "FROM pr WHERE recent GROUP BY ALL")
)


@query("projection_of_decades", S(_PW.replace("\n, ps AS", ", ps AS", 1)))
def projection_of_decades(spark, sf):
    """The projection with fifteen baseline years: weeks of the daily table stand for months."""
    week = F.floor(F.datediff("date", F.lit("1995-01-01").cast("date")) / 7).cast("int")
    rows = proxy.daily(spark, sf).groupBy("region_id", F.add_months(F.lit("1980-01-01").cast("date"), week).alias("month_date")).agg(F.avg("mean_sst_c").alias("mean_sst_c"))
    return D6(projection.project(rows.withColumns({"year": F.year("month_date"), "month": F.month("month_date")}), base=_LB), 5)


_RHO = 0.4
_GLS = f"""
, gx AS (
    SELECT region_id, month_date, k, (year * 12 + month) - min(year * 12 + month) OVER (PARTITION BY region_id) AS t, CASE k WHEN 0 THEN 1.0 WHEN 13 THEN mean_sst_c ELSE (month = k)::INT::DOUBLE END AS v0, month, mean_sst_c
    FROM monthly, range(14) r(k)
), gv AS (
    SELECT region_id, k, t, v, lag(v) OVER w AS lv, t - lag(t) OVER w AS gap FROM (SELECT region_id, k, t, CASE WHEN k = 1 THEN t / 12.0::DOUBLE ELSE v0 END AS v FROM gx) WINDOW w AS (PARTITION BY region_id, k ORDER BY t)
), gw AS (
    SELECT region_id, k, t, CASE WHEN gap IS NULL THEN v ELSE (v - pow({_RHO}::DOUBLE, gap) * lv) / sqrt(1 - pow({_RHO}::DOUBLE, 2 * gap)) END AS v FROM gv
), g0 AS MATERIALIZED (
    SELECT a.region_id, a.k AS i, b.k AS j, sum(a.v * b.v) AS v FROM gw a JOIN gw b USING (region_id, t) GROUP BY ALL
), {", ".join(f"""g{k + 1} AS MATERIALIZED (
    SELECT a.region_id, a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - b.v * c.v / p.v END AS v
    FROM g{k} a JOIN g{k} p ON p.region_id = a.region_id AND p.i = {k} AND p.j = {k} JOIN g{k} b ON b.region_id = a.region_id AND b.i = a.i AND b.j = {k} JOIN g{k} c ON c.region_id = a.region_id AND c.i = {k} AND c.j = a.j
)""" for k in range(13))}, gb AS (
    SELECT region_id, i, v FROM g13 WHERE j = 13
), gn AS (
    SELECT region_id, count(*) AS n, min(month_date) AS first, max(month_date) AS last, sqrt(any_value(r.v) / (count(*) - 13)) AS sigma FROM monthly JOIN (SELECT region_id, v FROM gb WHERE i = 13) r USING (region_id)
    GROUP BY region_id HAVING count(*) > 14 AND count(DISTINCT month) = 12
), gf AS (
    SELECT region_id, sigma, (last + to_months(k::INT))::DATE AS month_date, first FROM gn, range(1, 121) r(k)
), gp AS (
    SELECT f.region_id, f.month_date, f.sigma, b0.v + b1.v * ((year(f.month_date) - year(f.first)) * 12 + month(f.month_date) - month(f.first)) / 12.0 + coalesce(bm.v, 0) AS p, clim
    FROM gf f JOIN gb b0 ON b0.region_id = f.region_id AND b0.i = 0 JOIN gb b1 ON b1.region_id = f.region_id AND b1.i = 1 LEFT JOIN gb bm ON bm.region_id = f.region_id AND bm.i = month(f.month_date) AND month(f.month_date) > 1
    LEFT JOIN (SELECT region_id, month, avg(mean_sst_c) AS clim FROM monthly WHERE year BETWEEN {_PB[0]} AND {_PB[1]} GROUP BY ALL) c ON c.region_id = f.region_id AND c.month = month(f.month_date)
)
SELECT region_id::BIGINT AS region_id, month_date, round(p, 6) AS predicted_sst_c, round(p - 1.96 * sigma, 6) AS lower_sst_c, round(p + 1.96 * sigma, 6) AS upper_sst_c, round(sigma, 6) AS sigma,
    round(p - clim, 6) AS predicted_anomaly_c, round(p - 1.96 * sigma - clim, 6) AS lower_anomaly_c, round(p + 1.96 * sigma - clim, 6) AS upper_anomaly_c
FROM gp"""


@query("gls_given_correlation", S(_GLS))
def gls_given_correlation(spark, sf):
    """The model with a stated correlation of neighbouring months."""
    return D6(projection.gls(proxy.monthly(spark, sf), base=_PB, rho=_RHO).select("region_id", "month_date", *[f"{p}_{q}_c" for p in ("predicted", "lower", "upper") for q in ("sst", "anomaly")], "sigma"))


@query("gls_projection")
def gls_projection(spark, sf):
    return projection.gls(proxy.monthly(spark, sf), base=_PB)


# --- compositions
@query("points_to_region_daily", S("SELECT p.date, i.polygon AS region_id, round(avg(sst), 6) AS mean_sst_c, count(*) AS cell_count FROM points p JOIN inside i ON p.lon = i.lon AND p.lat = i.lat GROUP BY ALL"))
def points_to_region_daily(spark, sf):
    p = series.flatten_grid(proxy.points(spark, sf).drop("region_id", "region_code", "region_name"))
    p = spatial.assign(p, proxy.edges(spark, proxy.REGION_RINGS)).withColumnRenamed("polygon", "region_id")
    days = series.daily_aggregate(series.prepare_points(p, needed=["region_id"]), ("region_id",))
    return D6(days.select("date", "region_id", "mean_sst_c", "cell_count"))


@query("anomalies", oracle.rounded("anomalies", AN, doubles=AN_D))
def anomalies(spark, sf):
    return D6(proxy.anomalies(spark, sf))


@query("prelim_anomalies", oracle.rounded("prelim_anomalies", [*AN, *PROD], doubles=AN_D))
def prelim_anomalies(spark, sf):
    return D6(proxy.preliminary_anomalies(spark, sf))


@query("prelim_events", oracle.rounded("prelim_events", [*EV, *PROD], 4, doubles=EV_D))
def prelim_events(spark, sf):
    return D6(proxy.preliminary_events(spark, sf), 4)


def gate(tables: dict[str, DataFrame]) -> DataFrame:
    """The checks that a set of tables passes before it is published: all six suites, no check left out."""
    daily, clim, rows, events, m = (tables[n] for n in ("region_daily_sst", "region_climatology", "region_daily_anomalies", "heat_events", "monitoring"))
    prelim = [tables[f"preliminary_{n}"] for n in ("daily_sst", "anomalies", "events")]
    keys = lambda df, product: df.select("region_id", "date", F.lit(product).alias("data_product"))
    # by key, with no use of the table that is checked; "preliminary" is the greater and wins
    expected = keys(rows, "final").unionByName(keys(prelim[1], "preliminary")).groupBy("region_id", "date").agg(F.max("data_product").alias("data_product"))
    parts = {
        "history": validate.daily_history(daily), "climatology": validate.climatology(clim), "anomalies": validate.anomalies(rows, daily),
        "events": validate.events(events, rows), "preliminary": validate.preliminary(*prelim), "monitoring": validate.monitoring(m, expected),
    }
    return validate.suite(*[r.withColumn("check_name", F.concat(F.lit(f"{n}."), F.col("check_name"))) for n, r in parts.items()])


_FINAL_TABLES = ("region_daily_sst", "region_climatology", "region_daily_anomalies", "heat_events")


def _tables(spark: SparkSession, sf: str, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a daily run."""
    daily, clim = proxy.final(spark, sf, base), proxy.climatology(spark, sf, base)
    rows = series.anomalies(daily, clim)
    return {
        "region_daily_sst": daily, "region_climatology": clim, "region_daily_anomalies": rows, "heat_events": series.heat_events(rows),
        "preliminary_daily_sst": history.tag(proxy.preliminary(spark, sf, base), "preliminary", True), "preliminary_anomalies": proxy.preliminary_anomalies(spark, sf, base),
        "preliminary_events": proxy.preliminary_events(spark, sf, base), "monitoring": proxy.monitoring(spark, sf, base),
    }


def publish_checked(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Write the tables, check them as written, then switch; return the published monitoring table. A failing check is an error, and nothing is published."""
    groups = {"final": {n: tables[n] for n in _FINAL_TABLES}, "preliminary": {n: df for n, df in tables.items() if n.startswith("preliminary_")}, "monitoring": {"monitoring": tables["monitoring"]}}
    target = files.Publication(spark, root)
    target.publish(files.publication_plan(**groups), observe=gathered.observed, check=lambda staged: validate.require(gathered.report(staged, target.seen)))
    return target.read("monitoring")


@query("daily_pipeline", oracle.over_repaired(oracle.rounded("monitoring", [*AN, *PROD], doubles=AN_D)))
def daily_pipeline(spark, sf):
    """Build over a history without gaps, write, validate what was written, publish; the monitoring table that readers then see."""
    path = work_dir(spark)
    files.write_parquet(proxy.repaired(spark, sf), path)
    return D6(publish_checked(spark, _tables(spark, sf, spark.read.parquet(path)), work_dir(spark)).select(*AN, *PROD))


@query("final_refresh", oracle.rounded("heat", EV, 4, doubles=EV_D))
def final_refresh(spark, sf):
    """Final rows to anomalies, events and a publication; the events that readers then see."""
    daily, clim = proxy.daily(spark, sf), proxy.climatology(spark, sf)
    rows = series.anomalies(daily, clim)
    target = files.Publication(spark, work_dir(spark))
    target.publish(files.publication_plan(final={"region_daily_anomalies": rows, "heat_events": series.heat_events(rows)}))
    return D6(target.read("heat_events"), 4)


_BRANCH = f"""
SELECT cell_id, longitude, latitude, {_SQUARE} AS geom_wkt, count(*) AS historical_observation_count, round(avg(sst_c), 6) AS mean_sst_c, round(min(sst_c), 6) AS minimum_sst_c, round(max(sst_c), 6) AS maximum_sst_c
FROM (SELECT p.date, m.cell_id, m.longitude, m.latitude, avg(p.sst) AS sst_c FROM points p JOIN masked m ON p.lon = m.longitude AND p.lat = m.latitude WHERE m.included_in_coastal_domain AND m.oisst_ocean_cell GROUP BY ALL)
GROUP BY ALL"""


@query("cell_branch", S(_BRANCH))
def cell_branch(spark, sf):
    """Grid, land, ocean mask, extraction, features: the published table of cells that readers then see."""
    path = work_dir(spark)
    files.write_parquet(_audit(spark, sf).filter("included_in_coastal_domain").select("cell_id", "longitude", "latitude"), path)
    domain = spark.read.parquet(path)
    days = proxy.points(spark, sf).groupBy("lon", "lat", F.to_date("time").alias("time")).agg(F.avg("sst").alias("sst"))
    target = files.Publication(spark, work_dir(spark))
    target.publish(files.publication_plan(final={"cells": domain, "cell_sst": cells.extract(days, domain)}))
    seen = target.read("cell_sst").groupBy("cell_id").agg(
        F.count("sst_c").alias("historical_observation_count"), F.avg("sst_c").alias("mean_sst_c"), F.min("sst_c").alias("minimum_sst_c"), F.max("sst_c").alias("maximum_sst_c")
    )
    out = target.read("cells").join(seen, "cell_id").withColumn("geom_wkt", geo.square_wkt(F.col("longitude"), F.col("latitude"), 0.25))
    return D6(out.select("cell_id", "longitude", "latitude", "geom_wkt", "historical_observation_count", "mean_sst_c", "minimum_sst_c", "maximum_sst_c"))


def _valid_year(rows: DataFrame, year: int) -> bool:
    own = rows.filter(F.year("date") == year)
    report = validate.suite(
        validate.empty(own), validate.conditions(rows, {"other_year": F.year("date") != year, "null": F.col("sst_c").isNull() | F.isnan("sst_c")}), validate.duplicates(own, ["date", "cell_id"], "duplicate_keys")
    )
    return report.filter(~F.col("ok")).isEmpty()


@query("cell_publication", oracle.over_years(oracle.rounded(_SUMMARY_SQL, cells.SUMMARY, doubles=_SUMMARY_D)))
def cell_publication(spark, sf):
    """Years of cells built where they are not there and valid, features and trends of them, checked as written, published: the serving view."""
    table, target, years = f"{work_dir(spark)}/years", files.Publication(spark, work_dir(spark)), range(proxy.YEARS[0], proxy.YEARS[1] + 1)
    days = proxy.cells(spark, sf)
    build = lambda year: days.filter(F.year("date") == year)
    backfill.build_years(spark, build, [*years][::2], table, _valid_year)
    backfill.build_years(spark, build, years, table, _valid_year)  # half of them are there
    rows = spark.read.schema(days.schema).parquet(table)
    out = {"cell_features": cells.features(rows), "cell_trends": cells.trends(cells.annual_means(rows), *proxy.YEARS)}
    target.publish(files.publication_plan(final=out), check=lambda s: validate.require(validate.publication(s["cell_features"], s["cell_trends"], 0.25)))
    places = rows.select("cell_id", "longitude", "latitude").distinct()
    return D6(cells.summary(places, target.read("cell_features"), target.read("cell_trends")))


@query("load_modes", S("SELECT 'append' AS mode, 2 * count(*) AS rows FROM daily UNION ALL SELECT 'backup', count(*) FROM daily UNION ALL SELECT 'replace', count(*) FROM clim"))
def load_modes(spark, sf):
    """A table replaced, appended to, backed up and replaced again."""
    path = f"{work_dir(spark)}/table"
    daily = proxy.daily(spark, sf).select("region_id")
    files.load_table(daily, path, "replace")
    count = lambda at, name: spark.read.parquet(at).agg(F.lit(name).alias("mode"), F.count(F.lit(1)).alias("rows"))
    kept = files.backup(spark, path, "19990101T000000")
    other = f"{path}-appended"
    files.load_table(daily, other, "fail")
    files.load_table(daily, other, "append")
    files.load_table(proxy.climatology(spark, sf).select("region_id"), path, "replace")
    return monitoring.union([count(other, "append"), count(kept, "backup"), count(path, "replace")])


@query("sink_csv", S("SELECT region_id, date, round(mean_sst_c, 6) AS mean_sst_c FROM daily"))
def sink_csv(spark, sf):
    path = work_dir(spark)
    files.write_csv(D6(proxy.daily(spark, sf).select("region_id", "date", "mean_sst_c")), path, order_by=["region_id", "date"])
    return spark.read.schema("region_id int, date date, mean_sst_c double").option("header", True).csv(path)


@query("default_window", S(f"SELECT date, region_id FROM daily WHERE date BETWEEN DATE '2001-11-01' - 21 AND DATE '2001-11-01' - 1"))
def default_window(spark, sf):
    first, last = history.request_window("2001-11-01")
    return series.period(proxy.daily(spark, sf), str(first), str(last)).select("date", "region_id")


@query("prepare_for_load", S("SELECT date, region_id::BIGINT AS region_id, round(anomaly_c, 6) AS anomaly_c, above_p90, status_label FROM anomalies"))
def prepare_for_load(spark, sf):
    chosen = series.conform(proxy.anomalies(spark, sf), ["date", "region_id", "anomaly_c", "above_p90", "status_label"])
    return D6(series.unique(series.normalize(chosen, dates=["date"], integers=["region_id"], flags=["above_p90"]), ["region_id", "date"]))


@query("run_log_latest", S("SELECT run_id, first(status ORDER BY ts DESC, event_id DESC) AS status, min(ts) AS started_at, max(ts) AS last_at, count(*) AS event_count, count(*) FILTER (WHERE level = 'ERROR') AS error_count FROM log GROUP BY run_id"))
def run_log_latest(spark, sf):
    return monitoring.run_log_latest(proxy.log(spark, sf))


# --- validation
def dup(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"


_NULLS = "SELECT count(*) FROM {} WHERE {}"
_HISTORY = [
    ("missing_columns", "0"), ("empty", "0"), ("region_count", "SELECT CASE WHEN count(DISTINCT region_id) = 6 THEN 0 ELSE 1 END FROM daily"), ("duplicate_keys", dup("daily", "date, region_id")),
    ("missing_dates", f"SELECT count(*) FROM ({_CAL}) ANTI JOIN daily USING (date)"),
    ("missing_region_dates", f"SELECT count(*) FROM (SELECT * FROM (SELECT DISTINCT region_id FROM daily), ({_CAL})) ANTI JOIN daily USING (region_id, date)"),
    ("null_metrics", "SELECT count(*) FROM daily WHERE mean_sst_c IS NULL"),
]


@query("validate_history", oracle.checks(_HISTORY))
def validate_history(spark, sf):
    return validate.daily_history(proxy.daily(spark, sf))


_CLIM = [
    ("row_count", "SELECT CASE WHEN count(*) = 2190 THEN 0 ELSE 1 END FROM clim"), ("duplicate_keys", dup("clim", "region_id, day_of_year")),
    ("day_out_of_range", "SELECT count(*) FROM clim WHERE day_of_year NOT BETWEEN 1 AND 365"), ("null_values", "SELECT count(*) FROM clim WHERE clim_mean_sst_c IS NULL OR clim_p90_sst_c IS NULL"),
    ("bad_sample_size", "SELECT count(*) FROM clim WHERE sample_size <= 0"),
]


@query("validate_climatology", oracle.checks(_CLIM))
def validate_climatology(spark, sf):
    return validate.climatology(proxy.climatology(spark, sf))


_ANOM = [
    ("duplicate_keys", dup("anomalies", "date, region_id")), ("null_anomaly", "SELECT count(*) FROM anomalies WHERE anomaly_c IS NULL"), ("null_flag", "SELECT count(*) FROM anomalies WHERE above_p90 IS NULL"),
    ("row_count_differs", "SELECT abs((SELECT count(*) FROM anomalies) - (SELECT count(*) FROM noleap))"),
    ("first_date_differs", "SELECT CASE WHEN (SELECT min(date) FROM anomalies) = (SELECT min(date) FROM noleap) THEN 0 ELSE 1 END"),
    ("last_date_differs", "SELECT CASE WHEN (SELECT max(date) FROM anomalies) = (SELECT max(date) FROM noleap) THEN 0 ELSE 1 END"),
    ("regions_missing_on_last_date", "SELECT (SELECT count(DISTINCT region_id) FROM noleap) - count(DISTINCT region_id) FROM anomalies WHERE date = (SELECT max(date) FROM anomalies)"),
]


@query("validate_anomalies", oracle.checks(_ANOM))
def validate_anomalies(spark, sf):
    return validate.anomalies(proxy.anomalies(spark, sf), proxy.daily(spark, sf))


_EVENTS = [
    ("duplicate_event_id", dup("heat", "event_id")), ("start_after_end", _NULLS.format("heat", "start_date > end_date")), ("peak_outside", _NULLS.format("heat", "peak_date NOT BETWEEN start_date AND end_date")),
    ("bad_duration", _NULLS.format("heat", "duration_days <= 0")), ("active_not_at_latest", _NULLS.format("heat", "is_active AND end_date <> (SELECT max(date) FROM anomalies)")),
]


@query("validate_events", oracle.checks(_EVENTS))
def validate_events(spark, sf):
    return validate.events(proxy.events(spark, sf), proxy.anomalies(spark, sf))


#: Faults planted: rows of region 1 twice, product or flag of others wrong, region 6 lost, events twice with a peak before their start.
_PRELIM_CLEAN = [
    ("sst_columns", "0"), ("anomaly_columns", "0"), ("event_columns", "0"), ("sst_empty", "SELECT (count(*) = 0)::INT FROM prelim"), ("anomalies_empty", "SELECT (count(*) = 0)::INT FROM prelim_anomalies"),
    ("sst_duplicates", dup("prelim", "date, region_id")), ("anomaly_duplicates", dup("prelim_anomalies", "date, region_id")),
    ("sst_regions", "SELECT CASE WHEN count(DISTINCT region_id) = 6 THEN 0 ELSE 1 END FROM prelim"), ("sst_product", "0"), ("sst_not_provisional", "0"),
    ("anomaly_product", _NULLS.format("prelim_anomalies", "data_product <> 'preliminary'")), ("anomaly_not_provisional", _NULLS.format("prelim_anomalies", "NOT is_provisional")),
    ("key_sets_differ", "SELECT (SELECT count(*) FROM prelim ANTI JOIN prelim_anomalies USING (date, region_id)) + (SELECT count(*) FROM prelim_anomalies ANTI JOIN prelim USING (date, region_id))"),
    ("latest_day_incomplete", "SELECT greatest(6 - count(DISTINCT region_id), 0) FROM prelim_anomalies WHERE date = (SELECT max(date) FROM prelim_anomalies)"),
    ("duplicate_event_id", dup("prelim_events", "event_id")), ("event_start_after_end", _NULLS.format("prelim_events", "start_date > end_date")), ("event_bad_duration", _NULLS.format("prelim_events", "duration_days <= 0")),
    ("event_peak_outside", _NULLS.format("prelim_events", "peak_date NOT BETWEEN start_date AND end_date")), ("event_product", _NULLS.format("prelim_events", "data_product <> 'preliminary'")), ("event_not_provisional", _NULLS.format("prelim_events", "NOT is_provisional")),
]
_LEFT = "(SELECT * FROM prelim_anomalies WHERE region_id <> 6)"
_PRELIM = dict(_PRELIM_CLEAN) | {
    "sst_duplicates": _NULLS.format("prelim", "region_id = 1"), "sst_product": _NULLS.format("prelim", "region_id = 2"), "sst_not_provisional": _NULLS.format("prelim", "region_id = 3"),
    "anomaly_product": _NULLS.format("prelim_anomalies", "region_id = 4"), "anomaly_not_provisional": _NULLS.format("prelim_anomalies", "region_id = 5"),
    "key_sets_differ": f"SELECT (SELECT count(*) FROM prelim ANTI JOIN {_LEFT} USING (date, region_id)) + (SELECT count(*) FROM {_LEFT} ANTI JOIN prelim USING (date, region_id))",
    "latest_day_incomplete": f"SELECT greatest(6 - count(DISTINCT region_id), 0) FROM {_LEFT} WHERE date = (SELECT max(date) FROM {_LEFT})",
    "duplicate_event_id": "SELECT count(*) FROM prelim_events", "event_peak_outside": "SELECT count(*) FROM prelim_events", "event_product": "SELECT count(*) FROM prelim_events",
}


@query("validate_preliminary", oracle.checks(list(_PRELIM.items())))
def validate_preliminary(spark, sf):
    """Preliminary tables with planted faults."""
    wrong = lambda n: F.when(F.col("region_id") == n, "final").otherwise("preliminary")
    daily = history.tag(proxy.preliminary(spark, sf), "preliminary", True).withColumns({"data_product": wrong(2), "is_provisional": F.col("region_id") != 3})
    daily = daily.unionByName(daily.filter("region_id = 1"))
    rows = proxy.preliminary_anomalies(spark, sf).filter("region_id <> 6").withColumns({"data_product": wrong(4), "is_provisional": F.col("region_id") != 5})
    events = proxy.preliminary_events(spark, sf)
    again = events.withColumns({"peak_date": F.date_sub("start_date", 1), "data_product": F.lit("final")})
    return validate.preliminary(daily, rows, events.unionByName(again))


_EXPECTED = "(SELECT region_id, date, max(p) AS p FROM (SELECT region_id, date, 'final' AS p FROM final_anomalies UNION ALL SELECT region_id, date, 'preliminary' FROM prelim_anomalies) GROUP BY ALL)"
_MONITORING_CLEAN = [
    ("missing_columns", "0"), ("empty", "SELECT (count(*) = 0)::INT FROM monitoring"), ("duplicate_keys", dup("monitoring", "region_id, date")), ("unknown_product", _NULLS.format("monitoring", "data_product NOT IN ('final', 'preliminary')")),
    ("flag_inconsistent", _NULLS.format("monitoring", "(data_product = 'preliminary') <> is_provisional")), ("missing_rows", f"SELECT count(*) FROM {_EXPECTED} ANTI JOIN monitoring USING (region_id, date)"),
    ("extra_rows", f"SELECT count(*) FROM monitoring ANTI JOIN {_EXPECTED} USING (region_id, date)"), ("wrong_product_rows", f"SELECT count(*) FROM monitoring JOIN {_EXPECTED} USING (region_id, date) WHERE data_product <> p"),
]


@query("validate_monitoring", oracle.checks([
    ("missing_columns", "0"), ("empty", "SELECT (count(*) = 0)::INT FROM monitoring"), ("duplicate_keys", dup("monitoring", "region_id, date")), ("unknown_product", _NULLS.format("monitoring", "region_id = 3")),
    ("flag_inconsistent", _NULLS.format("monitoring", "region_id = 4 OR region_id = 3 AND is_provisional")), ("missing_rows", _NULLS.format("monitoring", "region_id = 5")), ("extra_rows", _NULLS.format("monitoring", "region_id = 2")),
    ("wrong_product_rows", _NULLS.format("monitoring", "region_id = 3")),
]))
def validate_monitoring(spark, sf):
    """Region 2 is not expected, of region 3 the product is unknown, of region 4 the flag is turned, region 5 is lost."""
    m = proxy.monitoring(spark, sf)
    wrong = {"data_product": F.when(F.col("region_id") == 3, "other").otherwise(F.col("data_product")), "is_provisional": (F.col("region_id") == 4) != F.col("is_provisional")}
    return validate.monitoring(m.filter("region_id <> 5").withColumns(wrong), m.filter("region_id <> 2"))


_FIN = "(SELECT * FROM noleap WHERE date <= " + oracle.FE + ")"
_named = lambda rows, **names: [(n, re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m[0]], q)) for n, q in rows]
_GATE = {
    "history": _named(_HISTORY, daily="final"), "climatology": _CLIM, "anomalies": _named(_ANOM, anomalies="final_anomalies", noleap=_FIN), "events": _named(_EVENTS, heat="final_heat", anomalies="final_anomalies"),
    "preliminary": _PRELIM_CLEAN, "monitoring": _MONITORING_CLEAN,
}


@query("daily_report", oracle.checks([(f"{p}.{n}", q) for p, rows in _GATE.items() for n, q in rows]))
def daily_report(spark, sf):
    """The report on the tables of a daily run as they are: gathered while they are written, and from one table of their keys."""
    path, target = work_dir(spark), files.Publication(spark, work_dir(spark))
    files.write_parquet(proxy.daily(spark, sf), path)
    return gathered.report(target.stage(_tables(spark, sf, spark.read.parquet(path)), "checked", gathered.observed), target.seen)


_PARTS = {"no_mean": "mean_sst_c < 12", "warm": "anomaly_c > 2", "no_flag": "above_p90 IS NULL", "early": "date < DATE '1995-01-10'"}


@query("failing_examples", S(" UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) AS failing_rows, count(*) = 0 AS ok, coalesce(list(region_id || ', ' || date ORDER BY region_id, date)[1:10]::VARCHAR, '[]') AS examples FROM anomalies WHERE {c}" for n, c in _PARTS.items()
)))
def failing_examples(spark, sf):
    """Checks with the first ten keys of the rows that fail them, as text."""
    checks = {n: F.expr(c.replace("DATE '1995-01-10'", "date'1995-01-10'")) for n, c in _PARTS.items()}
    out = validate.with_examples(validate.settled(proxy.anomalies(spark, sf), "mean_sst_c", "anomaly_c"), checks, ["region_id", "date"])
    return out.withColumn("examples", F.concat(F.lit("["), F.array_join(F.transform("examples", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]")))


_Y = 1996
#: Rows of the year and, planted, of the next: these count as of another year; of cell_5 one day has no value, of cell_7 one place moved, cell_9 is twice on one day.
_PLANTED = f"""(
    SELECT date, cell_id, CASE WHEN cell_id = 'cell_7' AND month(date) = 5 THEN longitude + 0.01 ELSE longitude END AS longitude, latitude, CASE WHEN cell_id <> 'cell_5' OR month(date) <> 6 THEN sst_c END AS sst_c
    FROM cells WHERE year(date) IN ({_Y}, {_Y} + 1)
    UNION ALL SELECT date, cell_id, longitude, latitude, sst_c FROM cells WHERE year(date) = {_Y} AND cell_id = 'cell_9' AND month(date) = 7
)"""
_OWN = f"(SELECT * FROM {_PLANTED} WHERE year(date) = {_Y})"
_CY = f"(SELECT * FROM cells WHERE year(date) = {_Y})"


@query("validate_cell_year", oracle.checks([
    ("empty", f"SELECT (count(*) = 0)::INT FROM {_CY}"), ("other_year", f"SELECT count(*) FROM cells WHERE year(date) <> {_Y}"), ("null_or_unfinite", f"SELECT count(*) FROM {_CY} WHERE sst_c IS NULL"), ("null_keys", f"SELECT count(*) FROM {_CY} WHERE cell_id IS NULL"), ("duplicate_keys", dup(_CY, "date, cell_id")), ("cell_set_differs", f"SELECT (SELECT count(DISTINCT cell_id) FROM cells) - count(DISTINCT cell_id) FROM {_CY}"), ("coordinates_differ", "0"),
    ("days_missing", f"SELECT 366 - count(DISTINCT date) FROM {_CY}"), ("row_product_differs", f"SELECT count(DISTINCT date) * count(DISTINCT cell_id) - count(*) FROM {_CY}"),
    ("cells_per_date_differ", f"SELECT max(c) - min(c) FROM (SELECT count(*) AS c FROM {_CY} GROUP BY date)"),
]))
def validate_cell_year(spark, sf):
    c = proxy.cells(spark, sf)
    return validate.cell_year(c, c.select("cell_id", "longitude", "latitude").distinct(), _Y)


def _planted(spark, sf):
    c = proxy.cells(spark, sf).filter(F.year("date").isin(_Y, _Y + 1))
    moved = (F.col("cell_id") == "cell_7") & (F.month("date") == 5)
    lost = (F.col("cell_id") == "cell_5") & (F.month("date") == 6)
    again = c.filter((F.year("date") == _Y) & (F.col("cell_id") == "cell_9") & (F.month("date") == 7))
    c = c.withColumns({"longitude": F.when(moved, F.col("longitude") + 0.01).otherwise(F.col("longitude")), "sst_c": F.when(~lost, F.col("sst_c"))})
    return c.unionByName(again)


@query("validate_trend_input", oracle.checks([
    ("empty", f"SELECT (count(*) = 0)::INT FROM {_OWN}"), ("other_year", f"SELECT count(*) FROM {_PLANTED} WHERE year(date) <> {_Y}"), ("duplicate_keys", dup(_OWN, "date, cell_id")), ("null_or_unfinite", f"SELECT count(*) FROM {_OWN} WHERE sst_c IS NULL"),
    ("moved_cells", f"SELECT count(*) FROM (SELECT cell_id FROM {_OWN} GROUP BY cell_id HAVING count(DISTINCT longitude) > 1)"),
    ("cells_without_all_days", f"SELECT count(*) FROM (SELECT cell_id FROM {_OWN} GROUP BY cell_id HAVING count(DISTINCT date) < 366)"),
]))
def validate_trend_input(spark, sf):
    """Two years of cells with planted faults."""
    return validate.trend_input(_planted(spark, sf), _Y)


@query("validate_annual_means", oracle.checks([
    ("duplicate_keys", "SELECT count(*) FROM annual_all WHERE cell_id = 'cell_4' AND year = 1999"), ("moved_cells", "SELECT count(DISTINCT cell_id) FROM annual_all WHERE cell_id = 'cell_1' AND year = 1996"),
    ("null_or_unfinite", "SELECT count(*) FROM annual_all WHERE cell_id = 'cell_2' AND year = 1997"), ("bad_count", "SELECT count(*) FROM annual_all WHERE cell_id = 'cell_3'"), ("outside_years", _NULLS.format("annual_all", "year NOT BETWEEN 1995 AND 2000")),
    ("cells_with_other_years", "SELECT count(*) FROM (SELECT cell_id FROM annual_all GROUP BY cell_id HAVING max(year) > 2000 OR count(*) FILTER (WHERE year BETWEEN 1995 AND 2000) <> 6)"),
]))
def validate_annual_means(spark, sf):
    """Annual means with planted faults: a place that moves, a value lost, counts of 0, a row twice."""
    rows, at = cells.annual_means(proxy.cells(spark, sf)), lambda c, y: (F.col("cell_id") == c) & (F.col("year") == y)
    again = rows.filter(at("cell_4", 1999))
    rows = rows.withColumns({
        "longitude": F.col("longitude") + F.when(at("cell_1", 1996), 1.0).otherwise(0.0), "annual_mean_sst_c": F.when(~at("cell_2", 1997), F.col("annual_mean_sst_c")),
        "observation_count": F.when(F.col("cell_id") == "cell_3", F.lit(0).cast("long")).otherwise(F.col("observation_count")),
    })
    return validate.annual_means(rows.unionByName(again), *proxy.YEARS)


@query("validate_features", oracle.checks([
    ("duplicate_keys", "SELECT count(*) FROM cells WHERE cell_id = 'cell_9' AND year(date) = 1996 AND month(date) = 7"), ("null_input", "SELECT count(*) FROM cells WHERE cell_id = 'cell_5' AND month(date) = 6"),
    ("moved_cells", "SELECT count(DISTINCT cell_id) FROM cells WHERE cell_id = 'cell_7' AND month(date) = 5"), ("cells_without_all_months", "SELECT count(*) FROM (SELECT cell_id FROM cells WHERE cell_id <> 'cell_11' OR month(date) < 12 GROUP BY cell_id HAVING count(DISTINCT month(date)) < 12)"),
    *[(f"unfinite_{c}", _NULLS.format("features", f"{c} IS NULL OR cell_id = '{p}'")) for c, p in (("mean_sst_c", "cell_2"), ("deseasonalized_daily_sd_sst_c", "cell_3"), ("annual_mean_sd_sst_c", "cell_4"))],
]))
def validate_features(spark, sf):
    """Cells and features with planted faults."""
    c = proxy.cells(spark, sf)
    cell, month = F.col("cell_id"), F.month("date")
    out = cells.features(c).withColumns({n: F.when(cell != p, F.col(n)) for n, p in (("mean_sst_c", "cell_2"), ("deseasonalized_daily_sd_sst_c", "cell_3"), ("annual_mean_sd_sst_c", "cell_4"))})
    bad = c.filter((cell != "cell_11") | (month < 12)).unionByName(c.filter((cell == "cell_9") & (F.year("date") == 1996) & (month == 7)))
    bad = bad.withColumns({"sst_c": F.when((cell != "cell_5") | (month != 6), F.col("sst_c")), "longitude": F.col("longitude") + F.when((cell == "cell_7") & (month == 5), 1.0).otherwise(0.0)})
    return validate.features(bad, out, ["mean_sst_c", "deseasonalized_daily_sd_sst_c", "annual_mean_sd_sst_c"])


_ONE = "SELECT count(*) FROM features WHERE cell_id = '{}'"
_PF = "(SELECT * FROM features WHERE cell_id <> 'cell_5' UNION ALL SELECT * FROM features WHERE cell_id = 'cell_3')"
_PT = "(SELECT * FROM trends WHERE cell_id <> 'cell_9' UNION ALL SELECT * FROM trends WHERE cell_id = 'cell_7')"


@query("validate_publication", oracle.checks([
    ("duplicate_features", _ONE.format("cell_3")), ("duplicate_trends", dup(_PT, "cell_id")), ("unfinite_mean", _ONE.format("cell_4")), ("unfinite_trend", f"SELECT count(*) FROM {_PT} WHERE trend_c_per_year IS NULL OR cell_id = 'cell_8'"),
    ("cell_sets_differ", f"SELECT (SELECT count(DISTINCT cell_id) FROM {_PF} f ANTI JOIN {_PT} t USING (cell_id)) + (SELECT count(DISTINCT cell_id) FROM {_PT} t ANTI JOIN {_PF} f USING (cell_id))"),
    ("coordinates_differ", f"SELECT count(*) FROM {_PF} f JOIN {_PT} t USING (cell_id) WHERE cell_id = 'cell_6'"), ("counts_differ", f"SELECT count(*) FROM {_PF} f JOIN {_PT} t USING (cell_id) WHERE f.observation_count <> t.observation_count"), ("bad_cell_size", "SELECT 1"),
]))
def validate_publication(spark, sf):
    """Features and trends with planted faults, and a cell size of 0."""
    cell = F.col("cell_id")
    f, t = cells.features(proxy.cells(spark, sf)), cells.trends(proxy.annual(spark, sf), *proxy.YEARS)
    f = f.filter(cell != "cell_5").unionByName(f.filter(cell == "cell_3")).withColumns({"mean_sst_c": F.when(cell != "cell_4", F.col("mean_sst_c")), "longitude": F.col("longitude") + F.when(cell == "cell_6", 0.001).otherwise(0.0)})
    t = t.filter(cell != "cell_9").unionByName(t.filter(cell == "cell_7")).withColumn("trend_c_per_year", F.when(cell != "cell_8", F.col("trend_c_per_year")))
    return validate.publication(f, t, 0.0)


@query("validate_keys", S("SELECT l_suppkey, l_partkey, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 10"))
def validate_keys(spark, sf):
    return validate.preview(proxy.lineitem(spark, sf), ["l_suppkey", "l_partkey"])


_T1 = "SELECT count(*) FROM trends WHERE cell_id = '{}'"
_BAD_FEATURES = {"longitude": ("cell_1", 400.0), "latitude": ("cell_2", 95.0), "warmest_month": ("cell_3", "none"), "coldest_month": ("cell_4", "none"), "mean_sst_c": ("cell_5", None)}
_BAD_TRENDS = {"baseline_start_year": ("cell_7", 3000), "trend_p_value": ("cell_8", 1.5), "trend_r_squared": ("cell_9", -1.0), "trend_c_per_year": ("cell_10", None)}


@query("validate_constraints", oracle.checks([
    ("null_daily_date", "SELECT count(*) FROM daily WHERE date IS NULL"), ("null_daily_region_id", "SELECT count(*) FROM daily WHERE region_id IS NULL"), ("null_daily_mean_sst_c", "SELECT count(*) FROM daily WHERE region_id = 5"),
    *[(f"null_feature_{c}", _ONE.format("cell_5") if c == "mean_sst_c" else f"SELECT count(*) FROM features WHERE {c} IS NULL") for c in ("cell_id", "longitude", "latitude", "mean_sst_c")],
    *[(f"null_trend_{c}", _T1.format("cell_10") if c == "trend_c_per_year" else f"SELECT count(*) FROM trends WHERE {c} IS NULL") for c in ("cell_id", "trend_c_per_year", "baseline_start_year", "baseline_end_year")],
    ("unknown_region", "SELECT count(*) FROM daily WHERE region_id = 6"), *[(n, _ONE.format(c)) for n, c in (("longitude_range", "cell_1"), ("latitude_range", "cell_2"), ("warmest_month", "cell_3"), ("coldest_month", "cell_4"))],
    *[(n, _T1.format(c)) for n, c in (("year_order", "cell_7"), ("p_value_range", "cell_8"), ("r_squared_range", "cell_9"), ("unknown_cell", "cell_6"))],
]))
def validate_constraints(spark, sf):
    """Tables with a fault planted for each constraint."""
    d = proxy.daily(spark, sf)
    f, t = cells.features(proxy.cells(spark, sf)), cells.trends(proxy.annual(spark, sf), *proxy.YEARS)
    wrong = lambda df, faults: df.withColumns({c: F.when(F.col("cell_id") == k, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, (k, v) in faults.items()})
    lost = d.withColumn("mean_sst_c", F.when(F.col("region_id") != 5, F.col("mean_sst_c")))
    return validate.constraints(wrong(t, _BAD_TRENDS), wrong(f, _BAD_FEATURES).filter("cell_id <> 'cell_6'"), lost, d.select("region_id").distinct().filter("region_id <> 6"))


_CR = "(SELECT c.cell_id, i.polygon FROM classified c LEFT JOIN inside i ON c.longitude = i.lon AND c.latitude = i.lat WHERE included_in_coastal_domain)"


@query("validate_cell_regions", oracle.checks([
    ("cells_without_region", f"SELECT count(*) FROM {_CR} WHERE polygon IS NULL"), ("cells_in_several", f"SELECT count(*) FROM (SELECT cell_id FROM {_CR} WHERE polygon IS NOT NULL GROUP BY cell_id HAVING count(*) > 1)"),
    ("small_regions", f"SELECT count(*) FROM (SELECT polygon FROM {_CR} WHERE polygon IS NOT NULL GROUP BY polygon HAVING count(*) < 20)"),
]))
def validate_cell_regions(spark, sf):
    inside = spatial.classify(proxy.grid_cells(spark, sf), proxy.edges(spark, proxy.LAND_RINGS)).filter("included_in_coastal_domain").select("cell_id", "longitude", "latitude")
    assigned = spatial.assign(inside, proxy.edges(spark, proxy.REGION_RINGS), lon="longitude", lat="latitude")
    return validate.cell_regions(inside, assigned, 20)


@query("validation_report", oracle.checks([(f"{p}.{n}", q) for p, rows in (("history", _HISTORY), ("climatology", _CLIM), ("anomalies", _ANOM), ("events", _EVENTS)) for n, q in rows]))
def validation_report(spark, sf):
    """All checks of four tables, gathered while these are written; each is read once more for its keys."""
    target, staged = files.Publication(spark, work_dir(spark)), {}
    add = lambda name, df: staged.update(target.stage({name: df}, "checked", gathered.observed))
    add("region_daily_sst", proxy.daily(spark, sf))
    add("region_climatology", proxy.climatology(spark, sf, staged["region_daily_sst"]))
    add("region_daily_anomalies", series.anomalies(staged["region_daily_sst"], staged["region_climatology"]))
    add("heat_events", series.heat_events(staged["region_daily_anomalies"]))
    return gathered.report(staged, target.seen)


# --- streaming
def _stream(spark, df) -> DataFrame:
    """A stream of files that hold df's rows."""
    path = work_dir(spark)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@query("stream_region_daily", S("SELECT date, region_id, round(avg(sst), 6) AS mean_sst_c, count(sst) AS cell_count, min(sst) AS min_sst_c, max(sst) AS max_sst_c FROM points GROUP BY ALL"))
def stream_region_daily(spark, sf):
    """All days of the bounded input, those of the last 18 days too, which the watermark leaves open."""
    target = work_dir(spark)
    out = incremental.region_daily(_stream(spark, proxy.points(spark, sf)))
    incremental.keep_daily(out, target, f"{target}-state").awaitTermination()
    return D6(incremental.kept_daily(spark, target, out.schema))


@query("stream_append_missing", oracle.rounded("daily", history.DAILY, doubles=DAY_D))
def stream_append_missing(spark, sf):
    target = work_dir(spark)
    proxy.final(spark, sf).write.parquet(target)
    incremental.append_missing(_stream(spark, proxy.daily(spark, sf)), target, f"{target}-state").awaitTermination()
    return D6(spark.read.parquet(target).select(*history.DAILY))
