"""The star-schema tables as keyed daily series.

Nothing here is about SST itself: dates, keys and values of `lineitem`,
`orders` and `events` stand in for it. Values are multiples of 1/4, so that
sums do not depend on their order; a warm spell is added on some days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cells as cell_ops
from ..operators import history, projection, series, spatial

BASELINE = ("1995-01-01", "1999-12-31")
#: The preliminary product covers the last three weeks; final rows end inside of them.
WINDOW = ("2001-10-15", "2001-11-04")
FINAL_END = "2001-10-25"
#: Days before the window that anomalies are computed from; days without a row are common at small scale.
HISTORY_DAYS = 365
YEARS = (1995, 2000)
TODAY = "2001-12-01"


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/lineitem.parquet")


def points(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("l_shipdate")
    region = (F.col("l_suppkey") % 6 + 1).cast("int")
    warm = F.pmod(F.floor((F.datediff(day, F.lit("1995-01-01").cast("date")) + 3 * region) / 8), F.lit(5)) == 0
    return lineitem(spark, sf).select(
        F.col("l_shipdate").alias("time"), region.alias("region_id"), F.concat(F.lit("R"), region.cast("string")).alias("region_code"),
        F.concat(F.lit("Region "), region.cast("string")).alias("region_name"),
        (160.125 + 0.25 * (F.col("l_partkey") % 88)).alias("lon"), (-52.875 + 0.25 * (F.col("l_suppkey") % 80)).alias("lat"),
        (8 + 0.25 * F.col("l_quantity") + F.when(warm, 4.0).otherwise(0.0)).alias("sst"),
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return series.daily_aggregate(series.prepare_points(points(spark, sf))).select(*history.DAILY)


def repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rows with every region on every day: a day without a row takes the last one before it, or the first after it."""
    rows = daily(spark, sf)
    first, last = rows.agg(F.min("date"), F.max("date")).first()
    regions = rows.select("region_id", "region_code", "region_name").distinct()
    every = regions.withColumn("date", F.explode(F.sequence(F.lit(first), F.lit(last))))
    kept = ["mean_sst_c", "cell_count", "min_sst_c", "max_sst_c"]
    out = every.join(rows.select("region_id", "date", F.struct(*kept).alias("_r")), ["region_id", "date"], "left")
    by = Window.partitionBy("region_id").orderBy("date")
    before, after = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(0, Window.unboundedFollowing)
    value = F.coalesce(F.last("_r", ignorenulls=True).over(before), F.first("_r", ignorenulls=True).over(after))
    return out.withColumn("_r", value).select("date", "region_id", "region_code", "region_name", "_r.*").select(*history.DAILY)


def climatology(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    return series.climatology(series.period(series.no_leap(base or daily(spark, sf)), *BASELINE))


def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return series.anomalies(daily(spark, sf), climatology(spark, sf))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return series.heat_events(anomalies(spark, sf))


def final(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    return series.period(base or daily(spark, sf), None, FINAL_END)


def preliminary(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    """The last three weeks as another product measures them: a quarter higher."""
    up = {c: F.col(c) + 0.25 for c in ("mean_sst_c", "min_sst_c", "max_sst_c")}
    return series.period(base or daily(spark, sf), *WINDOW).withColumns(up)


def preliminary_anomalies(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    rows = history.preliminary_input(final(spark, sf, base), preliminary(spark, sf, base), WINDOW[0], HISTORY_DAYS)
    out = series.anomalies(rows, climatology(spark, sf, base))
    return history.tag(series.period(out, *WINDOW), "preliminary", True)


def preliminary_events(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    earlier = history.before_window(series.anomalies(final(spark, sf, base), climatology(spark, sf, base)), WINDOW[0])
    rows = earlier.unionByName(preliminary_anomalies(spark, sf, base).drop("data_product", "is_provisional"))
    return history.tag(history.overlapping(series.heat_events(rows), *WINDOW), "preliminary", True)


def monitoring(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    done = series.anomalies(final(spark, sf, base), climatology(spark, sf, base))
    return history.monitoring(done, preliminary_anomalies(spark, sf, base).drop("data_product", "is_provisional"))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Daily values of twenty cells (by supplier)."""
    n = F.col("l_suppkey") % 20
    return lineitem(spark, sf).groupBy(
        F.to_date("l_shipdate").alias("date"), F.concat(F.lit("cell_"), n.cast("string")).alias("cell_id"), (160.125 + 0.25 * n).alias("longitude"), (-40.125 + 0.25 * n).alias("latitude")
    ).agg(F.avg(8 + 0.25 * F.col("l_quantity")).alias("sst_c"))


def annual(spark: SparkSession, sf: str) -> DataFrame:
    return cell_ops.annual_means(cells(spark, sf)).filter(F.col("year").between(*YEARS))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return projection.monthly(daily(spark, sf))


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """The places of all points, as cells with their mean value; every seventh has none."""
    value = F.avg("sst").alias("sst")
    out = points(spark, sf).groupBy("lon", "lat").agg(value)
    masked = (F.col("lon") * 4 + F.col("lat") * 4) % 7 == 0
    return out.withColumn("sst", F.when(~masked, F.col("sst")))


def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.once(points(spark, sf), "lon", "lat").select(
        F.format_string("oisst_%.3f_%.3f", "lon", "lat").alias("cell_id"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude")
    )


#: Polygons of regions and land, off the lattice. Regions 2 and 3 overlap; region 6 crosses itself.
REGION_RINGS = {
    1: [(160.03, -52.97), (166.03, -52.97), (168.07, -46.03), (160.03, -45.01)],
    2: [(166.53, -52.53), (174.03, -52.03), (173.01, -46.51), (168.51, -46.02)],
    3: [(171.03, -50.03), (181.03, -51.01), (181.53, -44.03), (172.03, -45.03)],
    4: [(160.53, -44.03), (169.03, -45.53), (170.01, -38.03), (161.03, -37.03)],
    5: [(170.53, -43.53), (181.03, -43.03), (180.03, -38.53), (171.53, -39.03)],
    6: [(162.03, -36.53), (176.03, -33.53), (176.53, -36.03), (162.53, -33.03)],
}
LAND_RINGS = {
    1: [(166.31, -46.61), (170.71, -46.33), (174.17, -41.71), (172.61, -40.57), (168.11, -43.97)],
    2: [(173.81, -41.27), (176.27, -41.47), (178.51, -37.69), (174.77, -36.13), (173.87, -39.31)],
    3: [(167.51, -47.23), (168.23, -47.19), (168.17, -46.79), (167.63, -46.71)],
    4: [(174.97, -40.99), (175.02, -40.97), (175.01, -40.92)],
    5: [(165.93, -50.93), (166.27, -50.91), (166.23, -50.53)],
    6: [(176.41, -43.77), (176.73, -43.71), (176.61, -43.51)],
}
LAND_NAMES = {1: "South Island", 2: "North Island", 3: "Stewart Island", 4: "Kapiti Island", 5: "Auckland Islands", 6: "Chatham Island"}


def edge_values(rings: dict) -> list[tuple]:
    return [(k, n, *a, *b) for k, ring in rings.items() for n, (a, b) in enumerate(zip(ring, [*ring[1:], ring[0]]))]


def edges(spark: SparkSession, rings: dict) -> DataFrame:
    rows = [(k, n, float(x), float(y), float(x2), float(y2)) for k, n, x, y, x2, y2 in edge_values(rings)]
    return spark.createDataFrame(rows, "polygon int, n int, x double, y double, x2 double, y2 double")


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    return lineitem(spark, sf).withColumns({"lon": 160.125 + 0.25 * (F.col("l_partkey") % 88), "lat": -52.875 + 0.25 * (F.col("l_suppkey") % 80)}).groupBy("l_suppkey").agg(
        (F.min("lon") - 0.05).alias("w"), (F.max("lon") + 0.05).alias("e"), (F.min("lat") - 0.05).alias("s"), (F.max("lat") + 0.05).alias("n")
    )


def _ring(*points) -> Column:
    """A ring of points (x, y) whose coordinates are columns."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A ring round the points of each supplier: polygons that come from the tables; every tenth crosses itself."""
    w, e, s, n = (F.col(c) for c in "wesn")
    plain, crossed = _ring((w, s), (e, s), (e, n), (w, n), (w, s)), _ring((w, s), (e, n), (e, s), (w, n), (w, s))
    return _boxes(spark, sf).select(F.col("l_suppkey").cast("int").alias("polygon"), F.when(F.col("l_suppkey") % 10 == 0, crossed).otherwise(plain).alias("ring"))


def ringed(spark: SparkSession, sf: str, *, faults: bool = False) -> DataFrame:
    """Polygons with `rings` round the points of each supplier: of every third the middle is a hole, every fourth has a second part to the north.

    With `faults`, suppliers by their last digit: 0 crosses itself, 1 is not
    closed, 2 touches itself, 3 has edges that overlap, 4 has a hole outside, 5
    has two places only.
    """
    w, e, s, n = (F.col(c) for c in "wesn")
    a, b, mid = w + (e - w) / 3, w + (e - w) / 3 * 2, (s + n) / 2
    box = lambda x0, x1, y0, y1: _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    row = lambda part, ring, points: F.struct(F.lit(part).alias("part"), F.lit(ring).alias("ring"), points.alias("points"))
    k, none = F.col("l_suppkey"), F.array().cast("array<struct<part:int,ring:int,points:array<struct<x:double,y:double>>>>")
    hole = F.when(k % 3 == 0, F.array(row(0, 1, box(a, b, s + 0.01, n - 0.01)))).otherwise(none)
    second = F.when(k % 4 == 0, F.array(row(1, 0, box(w, e, s + 0.25, n + 0.25)))).otherwise(none)
    rings = F.concat(F.array(row(0, 0, box(w, e, s, n))), hole, second)
    if faults:
        shell = lambda *points: F.array(row(0, 0, _ring(*points)))
        digit = k % 10
        rings = (
            F.when(digit == 0, shell((w, s), (e, n), (e, s), (w, n), (w, s))).when(digit == 1, shell((w, s), (e, s), (e, n), (w, n)))
            .when(digit == 2, shell((w, s), (a, s), (a, mid), (b, s), (e, s), (e, n), (a, mid), (w, n), (w, s)))
            .when(digit == 3, shell((w, s), (e, s), (e, n), (e + 1, n), (a, n), (w, n), (w, s)))
            .when(digit == 4, F.array(row(0, 0, box(w, e, s, n)), row(0, 1, box(w, e, s + 1, n + 1)))).when(digit == 5, shell((w, s), (e, n), (w, s))).otherwise(rings)
        )
    return _boxes(spark, sf).select(F.col("l_suppkey").cast("int").alias("polygon"), rings.alias("rings"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Run-log events from the stream of events: the user is the run, the type the state."""
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "ts", F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), F.when(F.col("value") > 90, "ERROR").otherwise("INFO").alias("level"), F.col("props").alias("extra")
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("run_id"), F.col("c_name").alias("pipeline_name"))
