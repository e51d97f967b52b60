"""Features and trends of grid cells; rows are date, cell_id, longitude, latitude, sst_c."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, stats

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
PLACE = ("cell_id", "longitude", "latitude")
#: The features' names and their order.
FEATURES = [
    "observation_count", "mean_sst_c", "raw_sst_sd_c", "minimum_sst_c", "maximum_sst_c", *[f"mean_{m}_sst_c" for m in MONTHS],
    "summer_mean_sst_c", "winter_mean_sst_c", "seasonal_amplitude_c", "warmest_month", "coldest_month", *[f"seasonal_shape_{m}_c" for m in MONTHS],
    "deseasonalized_daily_sd_sst_c", "annual_mean_sd_sst_c",
]
#: The serving view's names and their order.
SUMMARY = [
    "cell_id", "longitude", "latitude", "cell_size_degrees", "grid_version", "geom_wkt", "baseline_start_year", "baseline_end_year", "year_count", "trend_observation_count",
    "historical_observation_count", "mean_sst_c", "minimum_sst_c", "maximum_sst_c", "summer_mean_sst_c", "winter_mean_sst_c", "seasonal_amplitude_c", "warmest_month", "coldest_month",
    "raw_sst_sd_c", "deseasonalized_daily_sd_sst_c", "annual_mean_sd_sst_c", "trend_c_per_year", "trend_c_per_decade", "trend_standard_error_c_per_year",
    "trend_standard_error_c_per_decade", "trend_p_value", "trend_r_squared", "estimated_change_over_period_c",
]


def extract(grid: DataFrame, domain: DataFrame) -> DataFrame:
    """Values of the domain's cells, matched by coordinates to three places.

    A domain cell whose coordinates the grid lacks is an error at once, with how
    many there are and up to ten of them; so is a missing value when it is read.
    """
    absent = absent_coordinates(grid, domain).select(*PLACE)
    examples = absent.orderBy("cell_id").limit(10).collect()
    if examples:
        raise ValueError(f"{absent.count()} domain coordinates are absent from the grid, such as {[tuple(r) for r in examples]}")
    at = domain.select("cell_id", F.round("longitude", 3).alias("_lon"), F.round("latitude", 3).alias("_lat"), "longitude", "latitude")
    found = grid.withColumns({"_lon": F.round("lon", 3), "_lat": F.round("lat", 3)}).join(at, ["_lon", "_lat"])
    where = F.concat(F.lit("missing SST in domain cell "), F.col("cell_id"), F.lit(" on "), F.to_date("time").cast("string"))
    value = F.when(F.col("sst").isNull() | F.isnan("sst"), F.raise_error(where).cast("double")).otherwise(F.col("sst"))
    return found.select(F.to_date("time").alias("date"), "cell_id", "longitude", "latitude", value.alias("sst_c"))


def absent_coordinates(grid: DataFrame, domain: DataFrame) -> DataFrame:
    """Domain cells whose coordinates the grid lacks."""
    have = grid.select(F.round("lon", 3).alias("_lon"), F.round("lat", 3).alias("_lat")).distinct()
    return domain.withColumns({"_lon": F.round("longitude", 3), "_lat": F.round("latitude", 3)}).join(have, ["_lon", "_lat"], "left_anti").drop("_lon", "_lat")


def monthly_pivot(cells: DataFrame, *, complete: bool = True) -> DataFrame:
    """Mean of each month as a column. A cell without rows in a month is an error when read, or null there if not `complete`."""
    month = F.month("date")
    names = [f"mean_{m}_sst_c" for m in MONTHS]
    out = cells.groupBy("cell_id").agg(*[F.avg(F.when(month == i + 1, F.col("sst_c"))).alias(n) for i, n in enumerate(names)])
    if not complete:
        return out
    lacks = lambda n, m: F.raise_error(F.concat(F.lit("no rows of cell "), F.col("cell_id"), F.lit(f" in {m}"))).cast("double")
    return out.withColumns({n: F.when(F.col(n).isNull(), lacks(n, m)).otherwise(F.col(n)) for n, m in zip(names, MONTHS)})


def _mean_of(names: list[str]) -> Column:
    total = F.col(f"mean_{names[0]}_sst_c")
    for n in names[1:]:
        total = total + F.col(f"mean_{n}_sst_c")
    return total / len(names)


def features(cells: DataFrame) -> DataFrame:
    """Overall, monthly and seasonal features of each cell.

    The warmest and coldest months are the first to attain the extreme; shapes
    are monthly means less the mean of the twelve.
    """
    base = monthly_pivot(cells).join(
        cells.groupBy(*PLACE).agg(
            F.avg("sst_c").alias("mean_sst_c"), F.stddev_samp("sst_c").alias("raw_sst_sd_c"), F.min("sst_c").alias("minimum_sst_c"),
            F.max("sst_c").alias("maximum_sst_c"), F.count("sst_c").alias("observation_count"),
        ),
        "cell_id",
    )
    months = F.array(*[F.col(f"mean_{m}_sst_c") for m in MONTHS])
    names = F.array(*[F.lit(m) for m in MONTHS])
    first = lambda x: F.element_at(names, F.array_position(months, x).cast("int"))
    out = base.withColumns({
        "summer_mean_sst_c": _mean_of(["dec", "jan", "feb"]), "winter_mean_sst_c": _mean_of(["jun", "jul", "aug"]),
        "seasonal_amplitude_c": F.array_max(months) - F.array_min(months), "warmest_month": first(F.array_max(months)), "coldest_month": first(F.array_min(months)),
    })
    out = out.withColumns({f"seasonal_shape_{m}_c": F.col(f"mean_{m}_sst_c") - _mean_of(MONTHS) for m in MONTHS})
    return out.join(deseasonalized_sd(cells), "cell_id").join(interannual_sd(cells), "cell_id").select(*PLACE, *FEATURES)


def deseasonalized_sd(cells: DataFrame) -> DataFrame:
    """Sample deviation of daily values less their cell's mean of the month.

    From counts, sums and squares by month in one aggregation: the squares
    about each month's mean add up over the months.
    """
    by_month = cells.groupBy("cell_id", F.month("date").alias("month")).agg(F.count("sst_c").alias("n"), F.var_pop("sst_c").alias("v"))
    return by_month.groupBy("cell_id").agg(F.sqrt(F.try_divide(F.sum(F.col("n") * F.col("v")), F.sum("n") - 1)).alias("deseasonalized_daily_sd_sst_c"))


def interannual_sd(cells: DataFrame) -> DataFrame:
    yearly = cells.groupBy("cell_id", F.year("date").alias("year")).agg(F.avg("sst_c").alias("m"))
    return yearly.groupBy("cell_id").agg(F.stddev_samp("m").alias("annual_mean_sd_sst_c"))


def deseasonalize(cells: DataFrame) -> DataFrame:
    """Rows with their cell's mean of the month and the difference."""
    mean = F.avg("sst_c").over(Window.partitionBy("cell_id", F.month("date")))
    return cells.withColumn("month_mean_c", mean).withColumn("residual_c", F.col("sst_c") - F.col("month_mean_c"))


def annual_means(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*PLACE, F.year("date").alias("year")).agg(F.avg("sst_c").alias("annual_mean_sst_c"), F.count("sst_c").alias("observation_count"))


def trends(annual: DataFrame, start: int, end: int) -> DataFrame:
    """Least squares of annual means on years for each cell, with standard error and two-sided p-value.

    A constant series explains nothing: r2 0, p 1. An exact line has error 0 and p 0.
    """
    x, y = "year", "annual_mean_sst_c"
    own = annual.filter(F.col("year").between(start, end))
    sums = own.groupBy(*PLACE).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
        F.count(y).alias("year_count"), F.sum("observation_count").alias("observation_count"),
    )
    df = (F.col("year_count") - 2).cast("double")
    flat = F.col("syy") <= 0
    r2 = F.when(flat, 0.0).otherwise(F.least(F.col("r2"), F.lit(1.0)))
    se = F.sqrt(F.try_divide((1 - r2) * F.col("syy"), F.col("sxx") * df))
    sums = sums.withColumns({"trend_r_squared": r2, "trend_standard_error_c_per_year": se})
    t = F.try_divide(F.col("slope"), F.col("trend_standard_error_c_per_year"))
    p = F.when(flat, 1.0).when(F.col("trend_standard_error_c_per_year") == 0, 0.0).otherwise(stats.t_two_sided(t, df))
    return sums.select(
        *PLACE, F.lit(start).alias("baseline_start_year"), F.lit(end).alias("baseline_end_year"), "year_count", "observation_count",
        F.col("slope").alias("trend_c_per_year"), (F.col("slope") * 10).alias("trend_c_per_decade"), "trend_standard_error_c_per_year",
        p.alias("trend_p_value"), "trend_r_squared", (F.col("slope") * (end - start)).alias("estimated_change_over_period_c"),
    )


def manifest(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.year("date").alias("year")).agg(
        F.countDistinct("date").alias("files_processed"), F.countDistinct("cell_id").alias("cell_count"), F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).withColumns({"status": F.lit("complete"), "output_file": F.concat(F.lit("cells_"), F.col("year").cast("string"), F.lit(".parquet"))})


def summary(places: DataFrame, feature_rows: DataFrame, trend_rows: DataFrame, *, size: float = 0.25, version: str = "v1") -> DataFrame:
    """Serving view: cells of a grid with their square, features and trends, standard error by decade."""
    f = feature_rows.drop("longitude", "latitude").withColumnRenamed("observation_count", "historical_observation_count")
    t = trend_rows.drop("longitude", "latitude").withColumnRenamed("observation_count", "trend_observation_count")
    out = places.select(*PLACE).join(f, "cell_id").join(t, "cell_id").withColumns({
        "cell_size_degrees": F.lit(size), "grid_version": F.lit(version), "geom_wkt": geo.square_wkt(F.col("longitude"), F.col("latitude"), size),
        "trend_standard_error_c_per_decade": F.col("trend_standard_error_c_per_year") * 10,
    })
    return out.select(*SUMMARY)


def agreement(left: DataFrame, right: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Cells of both sides with whether their coordinates agree."""
    b = right.select("cell_id", F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat"))
    return left.join(b, "cell_id").select(
        "cell_id", ((F.abs(F.col("longitude") - F.col("_lon")) <= tolerance) & (F.abs(F.col("latitude") - F.col("_lat")) <= tolerance)).alias("agrees")
    )
