"""Queries of profile interpolation, monthly series, seasonal models, bands and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.operators import series as S

from .registry import CUSTOMER_MONTHS_SQL, MONTHLY_SQL, PROFILES_SQL, SEQ, customer_months, monthly_orders, profiles, r6, settled, settled_sql
from .registry import query as _query

K = ["series_id"]


def query(name: str, sql: str):
    return _query(name, settled_sql(sql))


CASTS_SQL = PROFILES_SQL + """, z AS (SELECT estacion, cast_key, profundidad_m AS z, avg(temperatura_c) AS v FROM profiles GROUP BY ALL),
 b AS (SELECT estacion, cast_key, max(z) FILTER (z <= 20) AS z0, arg_max(v, z) FILTER (z <= 20) AS v0, min(z) FILTER (z >= 20) AS z1, arg_min(v, z) FILTER (z >= 20) AS v1, max(z) AS z_max FROM z GROUP BY ALL),
 interp AS (SELECT estacion, cast_key, CASE WHEN z0 = z1 THEN v0 ELSE v0 + (v1 - v0) * (20 - z0) / (z1 - z0) END AS value_at, z_max FROM b),
 fst AS (SELECT DISTINCT ON (estacion, cast_key) estacion, cast_key, CAST(date_trunc('month', fecha) AS DATE) AS month FROM profiles ORDER BY estacion, cast_key, l_linenumber, l_partkey, l_suppkey),
 casts AS (SELECT estacion, cast_key, value_at, z_max, month FROM interp JOIN fst USING (estacion, cast_key))"""


def casts(read):
    return S.casts_at_depth(profiles(read), "estacion", "cast_key", SEQ, "fecha", "profundidad_m", "temperatura_c", 20.0)


@query("h1_interp_at_depth", "WITH " + CASTS_SQL + "SELECT estacion, cast_key, round(value_at, 6) AS value_at, z_max FROM interp")
def _(read):
    return settled(S.interp_at_depth(profiles(read), ["estacion", "cast_key"], "profundidad_m", "temperatura_c", 20.0))


@query("h2_monthly_at_depth", "WITH " + CASTS_SQL + """SELECT DISTINCT ON (estacion, month) estacion, month, round(value_at, 6) AS value_at, z_max, cast_key FROM casts WHERE value_at IS NOT NULL
  ORDER BY estacion, month, z_max DESC, cast_key""")
def _(read):
    return settled(S.monthly_at_depth(casts(read), "estacion", "cast_key"))


@query("h3_coverage_diag", "WITH " + CASTS_SQL + "SELECT count(*) AS n_casts, count(value_at) AS n_with_value, count(*) - count(value_at) AS n_without_coverage, CAST(20 AS DOUBLE) AS target_depth FROM casts")
def _(read):
    return S.coverage_diag(casts(read), 20.0)


@query("h4_monthly_mean", "WITH " + CUSTOMER_MONTHS_SQL + f"SELECT series_id, month, {r6('value')} AS value FROM monthly")
def _(read):
    return settled(customer_months(read))


GRID_SQL = CUSTOMER_MONTHS_SQL + """, span AS (SELECT series_id, min(month) AS a, max(month) AS b FROM monthly GROUP BY ALL),
 g AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
 grid AS (SELECT g.series_id, g.month, value FROM g LEFT JOIN monthly USING (series_id, month))"""


def grid(read):
    return S.month_grid(customer_months(read), K)


@query("h5_month_grid", "WITH " + GRID_SQL + f"SELECT series_id, month, {r6('value')} AS value FROM grid")
def _(read):
    return settled(grid(read))


CLIM_SQL = GRID_SQL + ", clim AS (SELECT *, CAST(sum(CAST(value AS DECIMAL(28, 12))) OVER (PARTITION BY series_id, month(month)) AS DOUBLE) / nullif(count(value) OVER (PARTITION BY series_id, month(month)), 0) AS climatology FROM grid)"


@query("h6_climatology_anomaly", "WITH " + CLIM_SQL + f"SELECT series_id, month, {r6('value')} AS value, {r6('climatology')} AS climatology, {r6('value - climatology')} AS anomaly FROM clim")
def _(read):
    return settled(S.climatology_anomaly(grid(read), K))


T_SQL = GRID_SQL + ", tt AS (SELECT *, (year(month) * 12 + month(month)) - min(year(month) * 12 + month(month)) OVER (PARTITION BY series_id) AS t FROM grid)"


@query("h7_month_index", "WITH " + T_SQL + f"SELECT series_id, month, {r6('value')} AS value, t FROM tt")
def _(read):
    return settled(S.month_index(grid(read), K))


def _gram_sql(p: int, table: str) -> str:
    total = lambda x: r6(f"sum(CAST({x} AS DECIMAL(28, 12)))")
    sums = ", ".join(f"{total(f'x{i} * x{j}')} AS g_{i}_{j}" for i in range(p) for j in range(i, p))
    return f"SELECT series_id, count(*) AS n, {sums}, " + ", ".join(f"{total(f'x{i} * value')} AS r_{i}" for i in range(p)) + f" FROM {table} WHERE value IS NOT NULL GROUP BY series_id"


XS_SQL = "1.0 AS x0, " + ", ".join(f"{f}(2 * pi() * {k} / 12 * t) AS x{2 * k - (1 if f == 'sin' else 0)}" for k in (1, 2, 3) for f in ("sin", "cos"))


@query("h8_gram_sums", "WITH " + T_SQL + f", x AS (SELECT *, {XS_SQL} FROM tt) " + _gram_sql(7, "x"))
def _(read):
    xs = S.design(F.col("t"))
    g = S.gram_sums(S.month_index(grid(read), K), K, xs, F.col("value"))
    p = len(xs)
    return settled(g.select("series_id", "n", *[F.col("g")[i * p + j].alias(f"g_{i}_{j}") for i in range(p) for j in range(i, p)], *[F.col("r")[i].alias(f"r_{i}") for i in range(p)]))


def _solve_sql(p: int, rows: str, name: str) -> str:
    """CTEs that end in ``name`` (series_id, n, c: list of coefficients): normal equations of ``rows`` (series_id, x0.., value) by elimination."""
    total = lambda x: f"CAST(sum(CAST({x} AS DECIMAL(28, 12))) AS DOUBLE)"
    lines = ", ".join("[" + ", ".join([total(f"x{i} * x{j}") for j in range(p)] + [total(f"x{i} * value")]) + "]" for i in range(p))
    out = f"{name}_0 AS (SELECT series_id, count(*) AS n, [{lines}] AS m FROM {rows} GROUP BY series_id)"
    for k in range(1, p + 1):
        line = f"list_transform(m[{k}], lambda x: x / m[{k}][{k}])"
        other = f"list_transform(list_zip(r, m[{k}]), lambda q: q[1] - r[{k}] / m[{k}][{k}] * q[2])"
        out += f",\n {name}_{k} AS (SELECT series_id, n, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN {line} ELSE {other} END) AS m FROM {name}_{k - 1})"
    return out + f",\n {name} AS (SELECT series_id, n, list_transform(m, lambda r: r[{p + 1}]) AS c FROM {name}_{p})"


NATION_GRID_SQL = T_SQL.replace(CUSTOMER_MONTHS_SQL, MONTHLY_SQL)
SEASONAL = " + ".join(f"c[{i + 1}] * x{i}" for i in range(1, 7))
FIT_SQL = NATION_GRID_SQL + f""", x AS (SELECT *, {XS_SQL} FROM tt), seen AS (SELECT * FROM x WHERE value IS NOT NULL), {_solve_sql(7, "seen", "sol")},
 fit AS (SELECT x.*, sol.c, CASE WHEN n >= 7 THEN {SEASONAL} ELSE 0 END AS seasonal FROM x LEFT JOIN sol USING (series_id))"""
DES_SQL = FIT_SQL + """, des AS (SELECT *, value - seasonal AS deseasonalized, value - seasonal - avg(value - seasonal) OVER (PARTITION BY series_id) AS deseasonalized_anomaly FROM fit)"""


@query("h8_fourier_fit", "WITH " + FIT_SQL + "SELECT series_id, month, round(value, 6) AS value, t, round(seasonal, 6) AS seasonal FROM fit")
def _(read):
    return settled(S.fourier_fit(S.month_grid(monthly_orders(read), K), K).drop("coef"))


@query("h9_deseasonalize", "WITH " + DES_SQL + "SELECT series_id, month, round(value, 6) AS value, t, round(seasonal, 6) AS seasonal, round(deseasonalized, 6) AS deseasonalized, round(deseasonalized_anomaly, 6) AS deseasonalized_anomaly FROM des")
def _(read):
    return settled(S.deseasonalize(S.fourier_fit(S.month_grid(monthly_orders(read), K), K), K).drop("coef"))


def _ahead_sql(h: int) -> str:
    return f""", last AS (SELECT series_id, max(month) AS last, max(t) AS t_last FROM tt GROUP BY ALL), ahead AS (SELECT series_id, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, CAST(t_last + h AS BIGINT) AS t FROM last, generate_series(1, {h}) g(h)),
 ax AS (SELECT *, {XS_SQL} FROM ahead), ext AS (SELECT ax.series_id, ax.month, ax.t, CASE WHEN n >= 7 THEN {SEASONAL} END AS seasonal FROM ax LEFT JOIN sol USING (series_id))"""


@query("h10_fourier_extrapolate", "WITH " + FIT_SQL + _ahead_sql(12) + "SELECT series_id, month, CAST(t AS INTEGER) AS t, round(seasonal, 6) AS seasonal FROM ext")
def _(read):
    return settled(S.fourier_extrapolate(S.fourier_fit(S.month_grid(monthly_orders(read), K), K), K, 12).drop("coef"))


@query("h11_fill_linear", "WITH " + GRID_SQL + """, n AS (SELECT *, year(month) * 12 + month(month) AS n, CASE WHEN value IS NOT NULL THEN year(month) * 12 + month(month) END AS k FROM grid),
 f AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS v0, first_value(value IGNORE NULLS) OVER a AS v1, last_value(k IGNORE NULLS) OVER b AS n0, first_value(k IGNORE NULLS) OVER a AS n1 FROM n
   WINDOW b AS (PARTITION BY series_id ORDER BY month ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
 SELECT series_id, month, """ + r6("value") + " AS value, " + r6("CASE WHEN value IS NOT NULL THEN value WHEN v1 IS NULL THEN v0 WHEN v0 IS NOT NULL THEN v0 + (v1 - v0) * (n - n0) / (n1 - n0) END") + " AS filled FROM f")
def _(read):
    return settled(S.fill_linear(grid(read), K))


@query("h12_forecast_flat", "WITH " + MONTHLY_SQL + """, s AS (SELECT series_id, max(month) AS last, max(year(month) * 12 + month(month)) - min(year(month) * 12 + month(month)) AS t, avg(value) AS forecast, coalesce(stddev_samp(value), 0.5) AS sd FROM monthly GROUP BY ALL)
 SELECT series_id, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, t + h AS t, round(forecast, 6) AS forecast, round(forecast - 1.96 * sd, 6) AS lower, round(forecast + 1.96 * sd, 6) AS upper FROM s, generate_series(1, 60) x(h)""")
def _(read):
    return settled(S.forecast_flat(monthly_orders(read), K).withColumn("t", F.col("t").cast("long")))


@query("h13_station_forecast", "WITH " + DES_SQL + _ahead_sql(12) + """, clim AS (SELECT des.*, avg(value) OVER (PARTITION BY series_id, month(month)) AS climatology FROM des),
 flat AS (SELECT series_id, avg(value) AS forecast, coalesce(stddev_samp(value), 0.5) AS sd FROM monthly GROUP BY ALL), by_month AS (SELECT DISTINCT series_id, month(month) AS cm, climatology FROM clim WHERE climatology IS NOT NULL)
 SELECT series_id, month, round(value, 6) AS value, round(climatology, 6) AS climatology, round(value - climatology, 6) AS anomaly, CAST(t AS INTEGER) AS t, round(seasonal, 6) AS seasonal, round(deseasonalized, 6) AS deseasonalized,
  round(deseasonalized_anomaly, 6) AS deseasonalized_anomaly, 'historico' AS kind, CAST(NULL AS DOUBLE) AS forecast, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper FROM clim
 UNION ALL SELECT ext.series_id, ext.month, NULL, round(climatology, 6), NULL, CAST(ext.t AS INTEGER), round(ext.seasonal, 6), NULL, NULL, 'pronostico', round(forecast, 6), round(forecast - 1.96 * sd, 6), round(forecast + 1.96 * sd, 6)
  FROM ext JOIN flat USING (series_id) LEFT JOIN by_month b ON b.series_id = ext.series_id AND b.cm = month(ext.month)""")
def _(read):
    o = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("series_id"), "o_orderdate", (F.col("o_totalprice") / 10000).alias("v"))
    return settled(S.station_forecast(o, K, "o_orderdate", "v", 12))


TREND_XS_SQL = "1.0 AS x0, CAST(t AS DOUBLE) AS x1, " + ", ".join(f"{f}(2 * pi() * {k} / 12 * t) AS x{2 * k + (0 if f == 'sin' else 1)}" for k in (1, 2, 3) for f in ("sin", "cos"))
HOLDOUT_SQL = MONTHLY_SQL + f""", n AS (SELECT *, (year(month) * 12 + month(month)) - min(year(month) * 12 + month(month)) OVER (PARTITION BY series_id) AS t, count(*) OVER (PARTITION BY series_id) AS n_all, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS rk FROM monthly WHERE value IS NOT NULL),
 ok AS (SELECT *, n_all >= 4 AND least(12, n_all - 9) >= 1 AS ok, least(12, n_all - 9) AS held FROM n), hx AS (SELECT *, ok AND rk <= held AS is_holdout, {TREND_XS_SQL} FROM ok),
 train AS (SELECT * FROM hx WHERE ok AND NOT is_holdout), {_solve_sql(8, "train", "sol")},
 hfit AS (SELECT hx.*, {" + ".join(f"c[{i + 1}] * x{i}" for i in range(8))} AS fitted FROM hx LEFT JOIN sol USING (series_id))"""


@query("h14_trend_fourier_holdout", "WITH " + HOLDOUT_SQL + "SELECT series_id, month, t, round(value, 6) AS observation, round(fitted, 6) AS fitted, round(value - fitted, 6) AS residual, is_holdout, CASE WHEN ok THEN 'ok' ELSE 'too_short' END AS status FROM hfit")
def _(read):
    return settled(S.trend_fourier_holdout(monthly_orders(read), K))


#: A model that SQL can follow: the series' mean as the fit, the last 12 months held out.
GIVEN_SQL = MONTHLY_SQL + """, model AS (SELECT series_id, month, value AS observation, avg(value) OVER (PARTITION BY series_id) AS fitted, value - avg(value) OVER (PARTITION BY series_id) AS residual,
   row_number() OVER (PARTITION BY series_id ORDER BY month DESC) <= 12 AS is_holdout FROM monthly),
 bands AS (SELECT series_id, CASE WHEN coalesce(stddev_samp(residual) FILTER (NOT is_holdout), 0) > 0 THEN stddev_samp(residual) FILTER (NOT is_holdout) ELSE 1 END AS sigma FROM model GROUP BY ALL),
 banded AS (SELECT model.*, fitted - 1.959963984540054 * sigma AS lower_95, fitted + 1.959963984540054 * sigma AS upper_95, fitted - 1.1503493803760079 * sigma AS lower_75, fitted + 1.1503493803760079 * sigma AS upper_75,
   fitted - 0.6744897501960817 * sigma AS lower_50, fitted + 0.6744897501960817 * sigma AS upper_50 FROM model JOIN bands USING (series_id))"""


def given(read):
    from pyspark.sql import Window

    m = monthly_orders(read)
    w = Window.partitionBy("series_id")
    fit = F.avg("value").over(w)
    return m.select("series_id", "month", F.col("value").alias("observation"), fit.alias("fitted"), (F.col("value") - fit).alias("residual"), (F.row_number().over(w.orderBy(F.desc("month"))) <= 12).alias("is_holdout"))


@query("h15_residual_bands", "WITH " + GIVEN_SQL + "SELECT series_id, round(sigma, 6) AS sigma, round(1.959963984540054 * sigma, 6) AS half_95, round(1.1503493803760079 * sigma, 6) AS half_75, round(0.6744897501960817 * sigma, 6) AS half_50 FROM bands")
def _(read):
    return settled(S.residual_bands(given(read), K))


SIDES = [(sign, z, f"{name}_{p}") for p, z in S.Z.items() for sign, name in (("-", "low"), ("", "high"))]
INSIDE_SQL = "month >= cutoff AND (year(month) * 12 + month(month)) - (year(cutoff) * 12 + month(cutoff)) < 6"


@query("h15_band_rows", "WITH " + GIVEN_SQL + ", cut AS (SELECT series_id, min(month) FILTER (is_holdout) AS cutoff FROM model GROUP BY ALL) SELECT series_id, month, " + ", ".join(f"round({s}{z} * sigma, 6) AS {n}" for s, z, n in SIDES)
       + f", CASE WHEN {INSIDE_SQL} THEN CAST(0 AS DOUBLE) END AS forecast, " + ", ".join(f"CASE WHEN {INSIDE_SQL} THEN round({s}{z} * sigma, 6) END AS forecast_{n}" for s, z, n in SIDES) + " FROM model JOIN bands USING (series_id) JOIN cut USING (series_id)")
def _(read):
    """Forecast bands of the first six of twelve held-out months."""
    return settled(S.residual_band_rows(given(read), K, 6))


R = ", ".join(f"round({c}, 6) AS {c}" for c in ["observation", "fitted", "residual", *[f"{s}_{p}" for p in (95, 75, 50) for s in ("lower", "upper")]])


@query("h16_apply_bands", "WITH " + GIVEN_SQL + f"SELECT series_id, month, is_holdout, {R} FROM banded")
def _(read):
    g = given(read)
    return settled(S.apply_bands(g, S.residual_bands(g, K), K))


@query("h17_band_guard", "WITH " + GIVEN_SQL + f"""SELECT series_id, month, is_holdout, {R}, round(upper_95 - lower_95, 6) AS width FROM banded b WHERE NOT is_holdout
  AND upper_95 - lower_95 <= 3 * (SELECT quantile_cont(x.upper_95 - x.lower_95, 0.95) FROM banded x WHERE x.series_id = b.series_id AND NOT x.is_holdout)""")
def _(read):
    g = given(read)
    return settled(S.band_guard(S.apply_bands(g, S.residual_bands(g, K), K), K))


GAPS_SQL = CUSTOMER_MONTHS_SQL + """, nx AS (SELECT series_id, month, lead(month) OVER (PARTITION BY series_id ORDER BY month) AS nxt FROM monthly),
 gaps AS (SELECT series_id, CAST(month + INTERVAL 1 MONTH AS DATE) AS gap_from, CAST(nxt - INTERVAL 1 MONTH AS DATE) AS gap_to, date_diff('month', month, nxt) - 1 AS missing FROM nx WHERE date_diff('month', month, nxt) - 1 >= 3)"""


@query("h18_long_gaps", "WITH " + GAPS_SQL + "SELECT * FROM gaps")
def _(read):
    return S.long_gaps(customer_months(read), K)


@query("h19_segments_at_gaps", "WITH " + CUSTOMER_MONTHS_SQL + """, j AS (SELECT *, CASE WHEN date_diff('month', lag(month) OVER (PARTITION BY series_id ORDER BY month), month) > 3 THEN 1 ELSE 0 END AS j FROM monthly)
 SELECT series_id, month, CAST(round(CAST(value AS DECIMAL(28, 10)), 6) AS DOUBLE) AS value, CAST(sum(j) OVER (PARTITION BY series_id ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM j""")
def _(read):
    return settled(S.segments_at_gaps(customer_months(read), K))


@query("h20_coverage_pct", "WITH " + GAPS_SQL + """SELECT m.series_id, count(*) AS observed, date_diff('month', min(month), max(month)) + 1 AS calendar, max(month) AS last_month,
  (SELECT count(*) FROM gaps g WHERE g.series_id = m.series_id) AS n_gaps, round(100.0 * count(*) / (date_diff('month', min(month), max(month)) + 1), 6) AS coverage_pct FROM monthly m GROUP BY m.series_id""")
def _(read):
    return settled(S.coverage_pct(customer_months(read), K))


@query("h21_series_highlights", "WITH " + MONTHLY_SQL + """, i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month) AS i FROM monthly)
 SELECT series_id, count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, CASE WHEN count(*) > 12 THEN round(max(value) - min(value), 6) END AS amplitude, CASE WHEN count(*) >= 24 THEN round(regr_slope(value, i) * 12, 6) END AS slope_per_year FROM i GROUP BY series_id""")
def _(read):
    m = monthly_orders(read)
    return settled(S.series_highlights(m.select("series_id", "month", F.col("value").alias("observation"), F.col("value").alias("fitted")), K))


@query("h22_viewer_union", "SELECT event_id, user_id, value, value > 100 AS is_anomaly FROM events")
def _(read):
    e = read("events").select("event_id", "user_id", "value")
    return S.viewer_union(e.where("value <= 100"), e.where("value > 100"))
