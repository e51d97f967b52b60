"""Monthly series and their projection over the next ten years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, stats

#: Fixed values of the projection: baseline years, least years and months for them, months ahead, residuals for a month of its own.
BASE_START, BASE_END, LEAST_YEARS, LEAST_MONTHS, AHEAD, LEAST_RESIDUALS = 1991, 2020, 10, 36, 120, 5


def monthly(daily: DataFrame, value: str = "mean_sst_c") -> DataFrame:
    month = calendar.month_start(F.col("date"))
    out = daily.groupBy("region_id", month.alias("month_date")).agg(F.avg(value).alias("mean_sst_c"))
    return out.withColumns({"year": F.year("month_date"), "month": F.month("month_date")})


def monthly_history(daily: DataFrame) -> DataFrame:
    """Monthly statistics with regressors: years since the first month of all, and the season's sine and cosine."""
    out = daily.groupBy("region_id", "region_name", calendar.month_start(F.col("date")).alias("month_date")).agg(
        F.avg("mean_sst_c").alias("mean_sst_c"), F.min("mean_sst_c").alias("min_sst_c"), F.max("mean_sst_c").alias("max_sst_c"),
        F.stddev_samp("mean_sst_c").alias("sd_sst_c"), F.countDistinct("date").alias("n_days"),
    )
    first = daily.agg(calendar.month_start(F.min("date")).alias("first"))
    season = 2 * 3.141592653589793 * F.month("month_date") / 12
    return out.join(F.broadcast(first)).withColumns({  # one row
        "year": F.year("month_date"), "month": F.month("month_date"), "time_index_years": F.datediff("month_date", "first") / 365.25,
        "sin_month": F.sin(season), "cos_month": F.cos(season),
    }).drop("first")


def future_months(series: DataFrame, ahead: int = AHEAD) -> DataFrame:
    """The months after each region's last one."""
    last = series.groupBy("region_id").agg(F.max("month_date").alias("last"))
    step = F.expr("interval 1 month")
    return last.select("region_id", F.explode(F.sequence(F.add_months("last", 1), F.add_months("last", ahead), step)).alias("month_date"))


def project(
    series: DataFrame, *, base: tuple[int, int] = (BASE_START, BASE_END), ahead: int = AHEAD,
    model: str = "NOAA_OISST", scenario: str = "local_trend",
) -> DataFrame:
    """Observed months and `ahead` projected ones of each region.

    Anomalies from the months' means of the baseline (all years if the region
    has fewer than ten of it) follow a line in the decimal year, fitted from the
    baseline's first year on (on all months if these are fewer than 36). The
    band is the line and season with the tenth and ninetieth percentile of the
    month's residuals, or of all where a month has fewer than five. Warming is
    against the mean of the last twelve months; of an observed month, the median
    is the observation. All regions are done at once.
    """
    region = Window.partitionBy("region_id")
    in_base = F.col("year").between(*base)
    years = F.size(F.array_distinct(F.collect_list(F.when(in_base, F.col("year"))).over(region)))
    df = series.select("region_id", "month_date", "year", "month", "mean_sst_c").withColumn("x", calendar.decimal_year(F.col("month_date")))
    df = df.withColumn("used", F.when(years >= LEAST_YEARS, in_base).otherwise(F.lit(True)))
    clim = df.filter("used").groupBy("region_id", "month").agg(F.avg("mean_sst_c").alias("clim"))
    df = df.join(clim, ["region_id", "month"], "left").withColumn("anomaly", F.col("mean_sst_c") - F.col("clim"))
    recent = F.col("year") >= base[0]
    df = df.withColumn("fitted", F.when(F.sum(recent.cast("int")).over(region) >= LEAST_MONTHS, recent).otherwise(F.lit(True)))
    line = df.filter("fitted").groupBy("region_id").agg(F.regr_slope("anomaly", "x").alias("slope"), F.regr_intercept("anomaly", "x").alias("intercept"))
    df = df.join(line, "region_id").withColumn("trend", F.col("clim") + F.col("intercept") + F.col("slope") * F.col("x"))
    residuals = df.withColumn("residual", F.col("mean_sst_c") - F.col("trend")).filter("fitted and residual is not null")
    band = lambda p: [stats.quantile("residual", 0.1).alias(f"{p}10"), stats.quantile("residual", 0.9).alias(f"{p}90")]
    of_month = residuals.groupBy("region_id", "month").agg(F.count(F.lit(1)).alias("n"), *band("m"))
    of_all = residuals.groupBy("region_id").agg(*band("a"))
    recency = Window.partitionBy("region_id").orderBy(F.col("month_date").desc())
    last = df.withColumn("r", F.row_number().over(recency)).filter("r <= 12").groupBy("region_id").agg(F.avg("mean_sst_c").alias("last12"))

    null, slopes = F.lit(None).cast("double"), [F.col("slope").alias("trend_c_per_year"), (F.col("slope") * 10).alias("trend_c_per_decade")]
    own = F.coalesce(F.col("n") >= LEAST_RESIDUALS, F.lit(False))
    observed = df.select(
        "region_id", "month_date", "year", "month", F.lit("observed").alias("observed_or_projected"), F.lit("observed").alias("scenario"), F.lit(model).alias("model_id"),
        "mean_sst_c", F.col("mean_sst_c").alias("median_sst_c"), null.alias("p10_sst_c"), null.alias("p90_sst_c"), F.col("clim").alias("monthly_climatology_sst_c"), *slopes,
        F.lit(0.0).alias("warming_from_last_observed_c"),
    )
    ahead_rows = (
        future_months(series, ahead).withColumns({"year": F.year("month_date"), "month": F.month("month_date"), "x": calendar.decimal_year(F.col("month_date"))})
        .join(clim, ["region_id", "month"], "left").join(line, "region_id").join(of_month, ["region_id", "month"], "left").join(of_all, "region_id").join(last, "region_id")
        .withColumn("trend", F.col("clim") + F.col("intercept") + F.col("slope") * F.col("x"))
    )
    projected = ahead_rows.select(
        "region_id", "month_date", "year", "month", F.lit("projected").alias("observed_or_projected"), F.lit(scenario).alias("scenario"),
        F.lit("OISST_seasonal_trend_residual").alias("model_id"), null.alias("mean_sst_c"), F.col("trend").alias("median_sst_c"),
        (F.col("trend") + F.when(own, F.col("m10")).otherwise(F.col("a10"))).alias("p10_sst_c"),
        (F.col("trend") + F.when(own, F.col("m90")).otherwise(F.col("a90"))).alias("p90_sst_c"),
        F.col("clim").alias("monthly_climatology_sst_c"), *slopes, (F.col("trend") - F.col("last12")).alias("warming_from_last_observed_c"),
    )
    return observed.unionByName(projected)


#: Bound of the correlation of neighbouring months, and how many values are tried, each time closer round the best.
RHO, TRIED = 0.98, (99, 41, 41, 41)
#: Constant, time, eleven months; then the value itself.
_TERMS = 13


def _moments(series: DataFrame) -> DataFrame:
    """region_id, y0, gap, i, j, s0, s1, s2, n: sums of products of regressors and value, of a month, of it and the one before, of that one.

    Months stand apart by `gap`; a region's first month has gap 0 and s0 alone.
    With a correlation r = rho ** gap, a month less r times the one before is
    uncorrelated with it, so that (s0 - r s1 + r r s2) / (1 - r r), over all
    gaps, are the cross-moments of generalised least squares. Values are less
    their mean y0, so that little is lost where products cancel.
    """
    by = Window.partitionBy("region_id").orderBy("month_date")
    rows = series.filter(F.col("mean_sst_c").isNotNull() & ~F.isnan("mean_sst_c")).select(F.col("region_id").cast("long").alias("region_id"), "month_date", "mean_sst_c")
    number = F.year("month_date") * 12 + F.month("month_date")
    rows = rows.withColumns({"t": number - F.first(number).over(by), "y0": F.avg("mean_sst_c").over(Window.partitionBy("region_id"))})
    dummies = [(F.month("month_date") == m).cast("double") for m in range(2, 13)]
    rows = rows.withColumn("z", F.array(F.lit(1.0), F.col("t") / 12, *dummies, F.col("mean_sst_c").cast("double") - F.col("y0")))
    rows = rows.withColumns({"w": F.lag("z").over(by), "gap": F.coalesce(F.col("t") - F.lag("t").over(by), F.lit(0)).cast("int")})
    at = F.sequence(F.lit(0), F.lit(_TERMS))
    rows = rows.withColumn("i", F.explode(at)).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("i"))))
    z, w = (lambda k: F.get("z", F.col(k))), (lambda k: F.coalesce(F.get("w", F.col(k)), F.lit(0.0)))
    return rows.groupBy("region_id", "y0", "gap", "i", "j").agg(F.sum(z("i") * z("j")).alias("s0"), F.sum(z("i") * w("j") + z("j") * w("i")).alias("s1"), F.sum(w("i") * w("j")).alias("s2"), F.count(F.lit(1)).alias("n"))


def _fits(moments: DataFrame, rhos: DataFrame) -> DataFrame:
    """region_id, rho, likelihood (restricted, but for a constant), beta, sigma of each region and value of rho.

    Elimination of the regressors from the matrix of cross-moments leaves their
    coefficients in its last column and the residual sum of squares in its last
    corner; the pivots multiply to the determinant. A sum of squares that is
    lost in the rounding of what it is left of counts as that rounding.
    """
    r = F.when(F.col("gap") == 0, 0.0).otherwise(F.pow("rho", "gap"))
    rows = moments.join(rhos, "region_id").withColumn("r", r)
    cell = rows.groupBy("region_id", "y0", "rho", "i", "j").agg(
        F.sum((F.col("s0") - F.col("r") * F.col("s1") + F.col("r") * F.col("r") * F.col("s2")) / (1 - F.col("r") * F.col("r"))).alias("v"), F.sum("n").alias("n"), F.sum(F.col("n") * F.log(1 - F.col("r") * F.col("r"))).alias("scale")
    )
    both = cell.withColumn("e", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))))
    line = both.groupBy("region_id", "y0", "rho", F.col("e.i").alias("i")).agg(F.sort_array(F.collect_list(F.struct("e.j", "v"))).alias("row"), F.max("n").alias("n"), F.max("scale").alias("scale"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("i", "row"))), lambda x: F.transform(x["row"], lambda c: c["v"]))
    whole = line.groupBy("region_id", "y0", "rho").agg(lines.alias("m"), F.max("n").alias("n"), F.max("scale").alias("scale"))

    def eliminate(state, k):
        pivot = F.get(F.get(state["m"], k), k)
        base = F.transform(F.get(state["m"], k), lambda v: v / pivot)
        each = lambda row, i: F.when(i == k, base).otherwise(F.zip_with(row, base, lambda v, b: v - F.get(row, k) * b))
        return F.struct(F.transform(state["m"], each).alias("m"), (state["det"] + F.log(pivot)).alias("det"))

    start = F.struct(F.col("m").alias("m"), F.lit(0.0).alias("det"))
    done = whole.withColumn("d", F.aggregate(F.sequence(F.lit(0), F.lit(_TERMS - 1)), start, eliminate))
    corner = lambda m: F.get(F.get(m, F.lit(_TERMS)), F.lit(_TERMS))
    rss = F.greatest(corner("d.m"), corner("m") * F.col("n") * 2.0**-52, F.lit(1e-300))
    free = F.col("n") - _TERMS
    beta = F.transform(F.slice("d.m", 1, _TERMS), lambda row, i: F.get(row, _TERMS) + F.when(i == 0, F.col("y0")).otherwise(0.0))
    return done.select("region_id", "rho", (-0.5 * (free * F.log(rss) + F.col("scale") + F.col("d.det"))).alias("likelihood"), beta.alias("beta"), F.sqrt(rss / free).alias("sigma"))


def gls_fits(series: DataFrame, rho: float | None = None) -> DataFrame:
    """region_id, rho, likelihood, beta, sigma of each region with every month of the year and more than 14 months.

    The mean depends on time and the month; errors of months t apart correlate
    by rho ** t, with rho of the greatest restricted likelihood, or as given.
    """
    fit = series.filter(F.col("mean_sst_c").isNotNull() & ~F.isnan("mean_sst_c")).groupBy(F.col("region_id").cast("long").alias("region_id")).agg(F.count(F.lit(1)).alias("_n"), F.countDistinct(F.month("month_date")).alias("_m"))
    regions = fit.filter("_n > 14 and _m = 12").select("region_id")
    moments = _moments(series)
    if rho is not None:
        return _fits(moments, regions.withColumn("rho", F.lit(float(rho))))
    around, width = F.lit(0.0), RHO
    best = None
    for tried in TRIED:
        low, high = F.greatest(around - width, F.lit(-RHO)), F.least(around + width, F.lit(RHO))
        grid = F.transform(F.sequence(F.lit(0), F.lit(tried - 1)), lambda i: low + (high - low) * i / (tried - 1))  # noqa: B023
        of = regions if best is None else best.select("region_id", F.col("rho").alias("_at"))
        fits = _fits(moments, of.select("region_id", F.explode(grid).alias("rho")))
        best = fits.groupBy("region_id").agg(F.max_by(F.struct("rho", "likelihood", "beta", "sigma"), F.struct("likelihood", -F.abs("rho"))).alias("b")).select("region_id", "b.*")
        around, width = F.col("_at"), width * 2 / (tried - 1)
    return best


def gls(series: DataFrame, *, base: tuple[int, int] = (BASE_START, BASE_END), ahead: int = AHEAD, rho: float | None = None) -> DataFrame:
    """Exploratory model for each region; the band and value also as anomalies from the baseline's months. Regions that lack a month have no rows."""
    fits = gls_fits(series, rho)
    seen = series.filter(F.col("mean_sst_c").isNotNull() & ~F.isnan("mean_sst_c")).groupBy(F.col("region_id").cast("long").alias("region_id")).agg(F.min("month_date").alias("_first"), F.max("month_date").alias("_last"))
    rows = fits.join(seen, "region_id").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(ahead))))
    rows = rows.withColumn("month_date", F.add_months("_last", F.col("_k").cast("int"))).withColumn("month", F.month("month_date"))
    t = (F.year("month_date") - F.year("_first")) * 12 + F.month("month_date") - F.month("_first")
    of_month = F.when(F.col("month") == 1, 0.0).otherwise(F.get("beta", F.greatest(F.col("month"), F.lit(2))))
    mean = F.get("beta", F.lit(0)) + F.get("beta", F.lit(1)) * t / 12 + of_month
    out = rows.withColumn("predicted_sst_c", mean).select(
        "region_id", "month_date", "predicted_sst_c", (F.col("predicted_sst_c") - 1.96 * F.col("sigma")).alias("lower_sst_c"), (F.col("predicted_sst_c") + 1.96 * F.col("sigma")).alias("upper_sst_c"), "rho", "sigma", "month"
    )
    clim = series.filter(F.col("year").between(*base)).groupBy(F.col("region_id").cast("long").alias("region_id"), "month").agg(F.avg("mean_sst_c").alias("clim_mean_sst_c"))
    out = out.join(clim, ["region_id", "month"], "left")
    return out.withColumns({k.replace("sst_c", "anomaly_c"): F.col(k) - F.col("clim_mean_sst_c") for k in ("predicted_sst_c", "lower_sst_c", "upper_sst_c")})
