"""The registered queries in DuckDB SQL, for checking."""

from __future__ import annotations

from . import proxy


def _edges(rings: dict) -> str:
    return ", ".join(f"({k}, {n}, {x}::DOUBLE, {y}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for k, n, x, y, x2, y2 in proxy.edge_values(rings))


STATUS = "CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} >= 1.5 THEN 'Extreme' WHEN {0} >= 1.0 THEN 'Hot' WHEN {0} >= 0.5 THEN 'Watch' ELSE 'Normal' END"
SEVERITY = (
    "CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} >= 2 THEN 'Extreme' WHEN {0} >= 1 THEN 'Severe' WHEN {0} >= 0.5 THEN 'Moderate' WHEN {0} > 0 THEN 'Weak' "
    "ELSE 'Threshold-only' END"
)
LERP = "list_sort(list({0}))"
W0, W1, FE = (f"DATE '{d}'" for d in (*proxy.WINDOW, proxy.FINAL_END))
LEAP = "(month(date) = 2 AND day(date) = 29)"
DOY = "(dayofyear(date) - CASE WHEN day(last_day(make_date(year(date), 2, 1))) = 29 AND dayofyear(date) > 60 THEN 1 ELSE 0 END)"


def _q(values: str, q: float) -> str:
    """The interpolated quantile of a sorted list."""
    at = f"({q} * (len({values}) - 1))"
    a, b = f"{values}[floor({at})::INT + 1]", f"{values}[ceil({at})::INT + 1]"
    return f"({a} + ({b} - {a}) * ({at} - floor({at})))"


def _anomalies(name: str, source: str) -> str:
    """Tables of anomalies of `source`, as name."""
    return f"""
{name}_a AS (
    SELECT h.*, clim_mean_sst_c, clim_p90_sst_c, sample_size, mean_sst_c - clim_mean_sst_c AS anomaly_c, coalesce(mean_sst_c > clim_p90_sst_c, false) AS above_p90
    FROM (SELECT *, {DOY} AS day_of_year FROM {source} WHERE NOT {LEAP}) h
    LEFT JOIN (SELECT region_id, day_of_year, clim_mean_sst_c, clim_p90_sst_c, sample_size FROM clim) c USING (region_id, day_of_year)
), {name} AS (
    SELECT date, region_id, region_code, region_name, mean_sst_c, min_sst_c, max_sst_c, cell_count, day_of_year, clim_mean_sst_c, clim_p90_sst_c, sample_size,
        anomaly_c, above_p90,
        avg(anomaly_c) OVER (w ROWS 6 PRECEDING) AS rolling_7d_anomaly_c, avg(anomaly_c) OVER (w ROWS 29 PRECEDING) AS rolling_30d_anomaly_c,
        mean_sst_c - lag(mean_sst_c, 7) OVER w AS warming_rate_7d_c, {STATUS.format('round(anomaly_c, 9)')} AS status_label
    FROM {name}_a WINDOW w AS (PARTITION BY region_id ORDER BY date)
)"""


def _events(name: str, source: str) -> str:
    return f"""
{name}_d AS (
    SELECT *, mean_sst_c - clim_p90_sst_c AS exceedance_c, lag(above_p90) OVER w AS before, date - lag(date) OVER w AS gap
    FROM {source} WINDOW w AS (PARTITION BY region_id ORDER BY date)
), {name}_r AS (
    SELECT *, sum(CASE WHEN before IS NULL OR before <> above_p90 OR gap <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY region_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS run_id
    FROM {name}_d
), {name}_g AS (
    SELECT region_id, region_code, region_name, run_id, min(date) AS start_date, max(date) AS end_date, count(*) AS duration_days, max(anomaly_c) AS max_anomaly_c,
        avg(anomaly_c) AS mean_anomaly_c, max(exceedance_c) AS max_exceedance_c, avg(exceedance_c) AS mean_exceedance_c,
        first(date ORDER BY exceedance_c DESC, date) AS peak_date
    FROM {name}_r WHERE above_p90 GROUP BY ALL HAVING count(*) >= 5
), {name}_h AS (
    SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('warm_event|region_id=' || region_id || '|start_date=' || start_date)) AS h FROM {name}_g
), {name} AS (
    SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', strpos('0123456789abcdef', substr(h, 17, 1)) % 4 + CASE WHEN strpos('0123456789abcdef', substr(h, 17, 1)) % 4 = 0 THEN 4 ELSE 0 END, 1)
            || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS event_id,
        region_id, region_code, region_name, 'warm_event' AS event_type, {SEVERITY.format('max_exceedance_c')} AS severity_class, start_date, end_date, duration_days, peak_date, round(round(max_anomaly_c, 9), 4) AS max_anomaly_c,
        round(round(mean_anomaly_c, 9), 4) AS mean_anomaly_c, round(round(max_exceedance_c, 9), 4) AS max_exceedance_p90_c, round(round(mean_exceedance_c, 9), 4) AS mean_exceedance_p90_c,
        end_date = (SELECT max(date) FROM {source}) AS is_active, 0.0 AS threshold_c, 5 AS min_duration_days
    FROM {name}_h
)"""


def _inside(places: str, edges: str) -> str:
    """Pairs of a place (lon, lat) and a polygon that holds it."""
    return f"""
    SELECT lon, lat, polygon FROM {places}, {edges}
    GROUP BY lon, lat, polygon
    HAVING count(*) FILTER (WHERE (y > lat) <> (y2 > lat) AND lon < x + (lat - y) / nullif(y2 - y, 0) * (x2 - x)) % 2 = 1
        AND NOT bool_or(abs((x2 - x) * (lat - y) - (y2 - y) * (lon - x)) < 1e-12 AND lon BETWEEN least(x, x2) AND greatest(x, x2) AND lat BETWEEN least(y, y2) AND greatest(y, y2))"""


def nztm(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing by a series in the third flattening, another than the one under test."""
    f = 1 / 298.257222101
    n = f / (2 - f)
    a1 = n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180
    a2 = 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440
    a3 = 61 * n**3 / 240 - 103 * n**4 / 140
    a4 = 49561 * n**4 / 161280
    big = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    c = 2 * n**0.5 / (1 + n)
    real = lambda v: f"({v!r}::DOUBLE)"
    phi, lam = f"radians({lat})", f"radians({lon} - 173.0)"
    t = f"sinh(atanh(sin({phi})) - {real(c)} * atanh({real(c)} * sin({phi})))"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    east = " + ".join([eta, *[f"{real(v)} * cos({2 * (i + 1)} * {xi}) * sinh({2 * (i + 1)} * {eta})" for i, v in enumerate((a1, a2, a3, a4))]])
    north = " + ".join([xi, *[f"{real(v)} * sin({2 * (i + 1)} * {xi}) * cosh({2 * (i + 1)} * {eta})" for i, v in enumerate((a1, a2, a3, a4))]])
    return f"({real(1600000.0)} + {real(0.9996 * big)} * ({east}))", f"({real(10000000.0)} + {real(0.9996 * big)} * ({north}))"


def _segment(px: str, py: str, x: str = "ex", y: str = "ey", x2: str = "ex2", y2: str = "ey2") -> str:
    dx, dy = f"({x2} - {x})", f"({y2} - {y})"
    t = f"greatest(0.0, least(1.0, (({px} - {x}) * {dx} + ({py} - {y}) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    return f"sqrt(pow({px} - {x} - {t} * {dx}, 2) + pow({py} - {y} - {t} * {dy}, 2))"


def _projected_edges(source: str) -> str:
    e, n = nztm("x", "y")
    e2, n2 = nztm("x2", "y2")
    return f"SELECT polygon, n, {e} AS ex, {n} AS ey, {e2} AS ex2, {n2} AS ey2 FROM {source}"


_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_ALL = [f"mean_{m}_sst_c" for m in _MONTHS]
_SUM = " + ".join(_ALL)

TABLES = f"""
WITH points AS (
    SELECT l_shipdate AS time, l_shipdate::DATE AS date, (l_suppkey % 6 + 1)::INT AS region_id, 'R' || (l_suppkey % 6 + 1) AS region_code,
        'Region ' || (l_suppkey % 6 + 1) AS region_name, 160.125::DOUBLE + 0.25::DOUBLE * (l_partkey % 88) AS lon, -52.875::DOUBLE + 0.25::DOUBLE * (l_suppkey % 80) AS lat,
        8 + 0.25::DOUBLE * l_quantity
            + CASE WHEN floor(((l_shipdate::DATE - DATE '1995-01-01') + 3 * (l_suppkey % 6 + 1)) / 8.0)::INT % 5 = 0 THEN 4.0 ELSE 0.0 END AS sst,
        l_suppkey, l_partkey
    FROM lineitem
), daily AS (
    SELECT date, region_id, region_code, region_name, avg(sst) AS mean_sst_c, count(sst) AS cell_count, min(sst) AS min_sst_c, max(sst) AS max_sst_c
    FROM points GROUP BY ALL
), noleap AS (
    SELECT *, {DOY} AS day_of_year FROM daily WHERE NOT {LEAP}
), clim_l AS (
    SELECT region_id, region_code, region_name, day_of_year, avg(mean_sst_c) AS clim_mean_sst_c, {LERP.format('mean_sst_c')} AS v, count(*) AS sample_size
    FROM noleap WHERE date BETWEEN DATE '{proxy.BASELINE[0]}' AND DATE '{proxy.BASELINE[1]}' GROUP BY ALL
), clim AS (
    SELECT region_id, region_code, region_name, day_of_year, clim_mean_sst_c, {_q('v', 0.9)} AS clim_p90_sst_c, sample_size FROM clim_l
), {_anomalies('anomalies', 'daily')}, {_events('heat', 'anomalies')}, final AS (
    SELECT * FROM daily WHERE date <= {FE}
), prelim AS (
    SELECT * REPLACE (mean_sst_c + 0.25 AS mean_sst_c, min_sst_c + 0.25 AS min_sst_c, max_sst_c + 0.25 AS max_sst_c) FROM daily WHERE date BETWEEN {W0} AND {W1}
), prelim_in AS (
    SELECT * FROM final WHERE date < {W0} AND date >= {W0} - {proxy.HISTORY_DAYS} UNION ALL SELECT * FROM prelim
), {_anomalies('prelim_out', 'prelim_in')}, prelim_anomalies AS (
    SELECT *, 'preliminary' AS data_product, true AS is_provisional FROM prelim_out WHERE date BETWEEN {W0} AND {W1}
), {_anomalies('final_anomalies', 'final')}, {_events('final_heat', 'final_anomalies')}, prelim_event_in AS (
    SELECT * FROM final_anomalies WHERE date < {W0} UNION ALL SELECT * EXCLUDE (data_product, is_provisional) FROM prelim_anomalies
), {_events('prelim_heat', 'prelim_event_in')}, prelim_events AS (
    SELECT *, 'preliminary' AS data_product, true AS is_provisional FROM prelim_heat WHERE end_date >= {W0} AND start_date <= {W1}
), monitoring AS (
    SELECT *, 'final' AS data_product, false AS is_provisional FROM final_anomalies f ANTI JOIN prelim_anomalies p USING (region_id, date)
    UNION ALL BY NAME SELECT * FROM prelim_anomalies
), cells AS (
    SELECT l_shipdate::DATE AS date, 'cell_' || (l_suppkey % 20) AS cell_id, 160.125::DOUBLE + 0.25::DOUBLE * (l_suppkey % 20) AS longitude,
        -40.125::DOUBLE + 0.25::DOUBLE * (l_suppkey % 20) AS latitude, avg(8 + 0.25::DOUBLE * l_quantity) AS sst_c
    FROM lineitem GROUP BY ALL
), annual_all AS (
    SELECT cell_id, longitude, latitude, year(date)::INT AS year, avg(sst_c) AS annual_mean_sst_c, count(sst_c) AS observation_count FROM cells GROUP BY ALL
), annual AS (
    SELECT * FROM annual_all WHERE year BETWEEN {proxy.YEARS[0]} AND {proxy.YEARS[1]}
), pivoted AS (
    SELECT cell_id, {', '.join(f'avg(sst_c) FILTER (WHERE month(date) = {i + 1}) AS mean_{m}_sst_c' for i, m in enumerate(_MONTHS))} FROM cells GROUP BY cell_id
), residuals AS (
    SELECT *, avg(sst_c) OVER (PARTITION BY cell_id, month(date)) AS month_mean_c, sst_c - avg(sst_c) OVER (PARTITION BY cell_id, month(date)) AS residual_c FROM cells
), features AS (
    SELECT p.*, b.* EXCLUDE (cell_id), (mean_dec_sst_c + mean_jan_sst_c + mean_feb_sst_c) / 3 AS summer_mean_sst_c, (mean_jun_sst_c + mean_jul_sst_c + mean_aug_sst_c) / 3 AS winter_mean_sst_c,
        greatest({', '.join(_ALL)}) - least({', '.join(_ALL)}) AS seasonal_amplitude_c,
        {str(_MONTHS)}[list_position([{', '.join(_ALL)}], greatest({', '.join(_ALL)}))] AS warmest_month,
        {str(_MONTHS)}[list_position([{', '.join(_ALL)}], least({', '.join(_ALL)}))] AS coldest_month,
        {', '.join(f'mean_{m}_sst_c - ({_SUM}) / 12 AS seasonal_shape_{m}_c' for m in _MONTHS)}, d.deseasonalized_daily_sd_sst_c, i.annual_mean_sd_sst_c
    FROM pivoted p JOIN (
        SELECT cell_id, longitude, latitude, avg(sst_c) AS mean_sst_c, stddev_samp(sst_c) AS raw_sst_sd_c, min(sst_c) AS minimum_sst_c, max(sst_c) AS maximum_sst_c, count(sst_c) AS observation_count
        FROM cells GROUP BY ALL
    ) b USING (cell_id) JOIN (SELECT cell_id, stddev_samp(residual_c) AS deseasonalized_daily_sd_sst_c FROM residuals GROUP BY ALL) d USING (cell_id)
    JOIN (SELECT cell_id, stddev_samp(annual_mean_sst_c) AS annual_mean_sd_sst_c FROM annual_all GROUP BY ALL) i USING (cell_id)
), fits AS (
    SELECT cell_id, longitude, latitude, regr_slope(annual_mean_sst_c, year) AS slope, regr_r2(annual_mean_sst_c, year) AS r2, regr_sxx(annual_mean_sst_c, year) AS sxx,
        regr_syy(annual_mean_sst_c, year) AS syy, count(*) AS n, sum(observation_count)::BIGINT AS observation_count
    FROM annual GROUP BY ALL
), tests AS (
    SELECT *, sqrt((1 - r2) * syy / sxx / (n - 2)) AS se, n - 2 AS v FROM fits
), tail AS (
    -- Simpson's rule on the density of Student's distribution, from 0 to |t|
    SELECT cell_id, sum((CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + pow(abs(slope / se) * i / 2000.0, 2) / v, -(v + 1) / 2.0)) * abs(slope / se) / 6000
        * exp(lgamma((v + 1) / 2.0) - lgamma(v / 2.0)) / sqrt(v * pi()) AS half
    FROM tests, range(2001) r(i) GROUP BY cell_id, slope, se, v
), trends AS (
    SELECT cell_id, longitude, latitude, slope AS trend_c_per_year, slope * 10 AS trend_c_per_decade, se AS trend_standard_error_c_per_year,
        1 - 2 * half AS trend_p_value, r2 AS trend_r_squared, {proxy.YEARS[0]} AS baseline_start_year, {proxy.YEARS[1]} AS baseline_end_year, n AS year_count, observation_count,
        slope * {proxy.YEARS[1] - proxy.YEARS[0]} AS estimated_change_over_period_c
    FROM tests JOIN tail USING (cell_id)
), monthly AS (
    SELECT region_id, date_trunc('month', date)::DATE AS month_date, avg(mean_sst_c) AS mean_sst_c, year(any_value(date))::INT AS year, month(any_value(date))::INT AS month
    FROM daily GROUP BY region_id, date_trunc('month', date)
), edges AS (
    SELECT * FROM (VALUES {_edges(proxy.REGION_RINGS)}) e(polygon, n, x, y, x2, y2)
), land AS (
    SELECT * FROM (VALUES {_edges(proxy.LAND_RINGS)}) e(polygon, n, x, y, x2, y2)
), places AS (
    SELECT DISTINCT lon, lat FROM points
), inside AS ({_inside('places', 'edges')}
), grid AS (
    SELECT lon, lat, CASE WHEN (lon * 4 + lat * 4) % 7 <> 0 THEN avg(sst) END AS sst FROM points GROUP BY lon, lat
), grid_cells AS (
    SELECT printf('oisst_%.3f_%.3f', lon, lat) AS cell_id, lon AS longitude, lat AS latitude FROM places
), land_edges AS ({_projected_edges('land')}
), land_inside AS ({_inside('places', 'land')}
), classified AS (
    SELECT cell_id, longitude, latitude, is_land, CASE WHEN is_land THEN 0.0 ELSE km END AS distance_to_land_km, NOT is_land AND km <= 75 AS included_in_coastal_domain
    FROM (
        SELECT printf('oisst_%.3f_%.3f', lon, lat) AS cell_id, lon AS longitude, lat AS latitude, (lon, lat) IN (SELECT (lon, lat) FROM land_inside) AS is_land,
            min({_segment('pe', 'pn')}) / 1000 AS km
        FROM (SELECT lon, lat, {nztm('lon', 'lat')[0]} AS pe, {nztm('lon', 'lat')[1]} AS pn FROM places), land_edges l
        GROUP BY lon, lat
    )
), masked AS (
    SELECT c.*, true AS oisst_coordinate_exists, g.sst IS NOT NULL AS oisst_ocean_cell FROM classified c JOIN grid g ON c.longitude = g.lon AND c.latitude = g.lat
), boxes AS (
    SELECT l_suppkey::INT AS polygon, min(lon) - 0.05 AS w, max(lon) + 0.05 AS e, min(lat) - 0.05 AS s, max(lat) + 0.05 AS n FROM points GROUP BY l_suppkey
), runs AS (
    SELECT c_custkey AS run_id, c_name AS pipeline_name FROM customer
), log AS (
    SELECT event_id, ts, user_id AS run_id, event_type AS status, CASE WHEN value > 90 THEN 'ERROR' ELSE 'INFO' END AS level, props AS extra FROM events
)
"""


def _nudged(text: str) -> str:
    """round(x, 5 or 6) as round(x + 1e-9, ...), as series.rounded does: exact ties fall one way, whatever the last bits of a sum."""
    out, at = [], 0
    while (i := text.find("round(", at)) >= 0:
        depth, j = 1, i + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(text[j], 0)
            j += 1
        inner, _, digits = text[i + 6 : j - 1].rpartition(",")
        out.append(text[at:i])
        out.append(f"round(({inner}) + 1e-9, {digits.strip()})" if digits.strip() in ("5", "6") else text[i:j])
        at = j
    return "".join(out) + text[at:]


def sql(select: str) -> str:
    return TABLES + _nudged(select)


_FILLED = """), daily AS (
    SELECT date, region_id, region_code, region_name, r.mean_sst_c AS mean_sst_c, r.cell_count AS cell_count, r.min_sst_c AS min_sst_c, r.max_sst_c AS max_sst_c
    FROM (
        SELECT date, region_id, region_code, region_name, coalesce(last_value(r IGNORE NULLS) OVER (PARTITION BY region_id ORDER BY date ROWS UNBOUNDED PRECEDING),
            first_value(r IGNORE NULLS) OVER (PARTITION BY region_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS r
        FROM (
            SELECT * FROM (SELECT unnest(generate_series((SELECT min(date) FROM daily_kept), (SELECT max(date) FROM daily_kept), INTERVAL 1 DAY))::DATE AS date), (SELECT DISTINCT region_id, region_code, region_name FROM daily_kept)
        ) LEFT JOIN (SELECT date, region_id, {'mean_sst_c': mean_sst_c, 'cell_count': cell_count, 'min_sst_c': min_sst_c, 'max_sst_c': max_sst_c} AS r FROM daily_kept) USING (date, region_id)
    )
), noleap AS ("""


def over_repaired(text: str) -> str:
    """A query with every day of every region in its daily table."""
    return text.replace("), daily AS (", "), daily_kept AS (", 1).replace("), noleap AS (", _FILLED, 1)


def over_years(text: str) -> str:
    """A query with the cells of the baseline's years only."""
    return text.replace("), cells AS (", "), every_cell AS (", 1).replace("), annual_all AS (", f"), cells AS (SELECT * FROM every_cell WHERE year(date) BETWEEN {proxy.YEARS[0]} AND {proxy.YEARS[1]}), annual_all AS (", 1)


def rounded(table: str, columns: list[str], digits: int = 6, *, doubles: tuple[str, ...] = ()) -> str:
    """Select columns, the named ones rounded."""
    return sql("SELECT " + ", ".join(f"round({c}, {digits}) AS {c}" if c in doubles else c for c in columns) + f" FROM {table}")


def checks(rows: list[tuple[str, str]]) -> str:
    """A suite: names and scalar SQL for the number of failing rows."""
    return sql("SELECT check_name, failing_rows::BIGINT AS failing_rows, failing_rows = 0 AS ok FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({q}) AS failing_rows" for n, q in rows) + ")")
