"""Queries of the data contract rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.operators import contract as C

from .registry import MONTHLY_SQL, PROFILES_SQL, SEQ, monthly_orders, profiles, query, rounded

V = ["severity", "code", "group_key", "n_rows", "worst"]


def shown(df):
    return rounded(df.select(*V))


F1_SQL = """SELECT 'error' AS severity, 'sampling_date_out_of_calendar_range' AS code, CAST(NULL AS VARCHAR) AS group_key,
  count(*) FILTER (year({t}) NOT BETWEEN 1996 AND 2000) AS n_rows, CAST(CASE WHEN max(year({t})) > 2000 THEN max(year({t})) ELSE min(year({t})) END AS DOUBLE) AS worst
  FROM {f} HAVING count(*) FILTER (year({t}) NOT BETWEEN 1996 AND 2000) > 0"""


@query("f1_check_dates", F1_SQL.format(t="l_shipdate", f="lineitem"))
def _(read):
    return shown(C.check_dates(read("lineitem"), "l_shipdate", (1996, 2000)))


@query("f2_check_columns", """SELECT 'error' AS severity, 'missing_column' AS code, 'salinidad_psu' AS group_key, 0 AS n_rows, CAST(NULL AS DOUBLE) AS worst
  UNION ALL SELECT 'warning', 'empty_after_coerce', 'event_type', count(*), NULL FROM events WHERE (SELECT count(TRY_CAST(event_type AS DOUBLE)) FROM events) = 0""")
def _(read):
    return shown(C.check_columns(read("events"), ["ts", "value", "salinidad_psu"], ["value", "event_type"]))


F3_SQL = """SELECT 'error' AS severity, '{code}' AS code, CAST(NULL AS VARCHAR) AS group_key, count(*) AS n_rows, round({worst}, 6) AS worst
  FROM {f} WHERE {bad} HAVING count(*) > 0"""


@query("f3_check_range", "WITH " + PROFILES_SQL + F3_SQL.format(code="temp_out_of_absolute_range", worst="CASE WHEN max(temperatura_c) > 32 THEN max(temperatura_c) ELSE min(temperatura_c) END", f="profiles", bad="temperatura_c < -2 OR temperatura_c > 32"))
def _(read):
    return shown(C.check_range(profiles(read), "temperatura_c", -2.0, 32.0, "temp_out_of_absolute_range"))


SEGMENTS_SQL = PROFILES_SQL + """, diffs AS (SELECT *, CASE WHEN profundidad_m - lag(profundidad_m) OVER w < -1.5 THEN 1 ELSE 0 END AS fell FROM profiles
  WINDOW w AS (PARTITION BY cast_key ORDER BY l_linenumber, l_partkey, l_suppkey)),
 seg AS (SELECT *, CAST(sum(fell) OVER (PARTITION BY cast_key ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM diffs)"""


@query("f4_depth_segments", "WITH " + SEGMENTS_SQL + " SELECT cast_key, segment, count(*) AS n, min(profundidad_m) AS z_min, max(profundidad_m) AS z_max FROM seg GROUP BY ALL")
def _(read):
    s = C.depth_segments(profiles(read), ["cast_key"], SEQ, "profundidad_m")
    return s.groupBy("cast_key", "segment").agg(F.count(F.lit(1)).alias("n"), F.min("profundidad_m").alias("z_min"), F.max("profundidad_m").alias("z_max"))


@query("f4_segments_of_long_casts", """WITH x AS (SELECT *, CASE WHEN l_quantity - lag(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) < -1.5 THEN 1 ELSE 0 END AS fell FROM lineitem)
 SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(sum(fell) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM x""")
def _(read):
    """Three casts hold all rows: each is cut into pieces, which a small window over their sums connects."""
    order = ["l_orderkey", *SEQ]
    df = read("lineitem").select("l_returnflag", *order, "l_quantity")
    return C.depth_segments(df, ["l_returnflag"], order, "l_quantity", piece_rows=10_000).drop("l_quantity")


GRADIENT_SQL = SEGMENTS_SQL + """, d AS (SELECT cast_key, segment, profundidad_m - lag(profundidad_m) OVER w AS dz, abs(temperatura_c - lag(temperatura_c) OVER w) AS dv FROM seg
  WINDOW w AS (PARTITION BY cast_key, segment ORDER BY l_linenumber, l_partkey, l_suppkey)),
 f AS (SELECT *, coalesce((dz BETWEEN 2.5 AND 5 AND dv >= 23) OR (dz > 5 AND dz <= 15 AND dv >= 24), false) AS e, coalesce((dz BETWEEN 2.5 AND 5 AND dv >= 8) OR (dz > 5 AND dz <= 15 AND dv >= 10), false) AS w FROM d),
 s AS (SELECT cast_key, segment, bool_or(e) AS e, bool_or(w) AND NOT bool_or(e) AS w, coalesce(max(dv) FILTER (e), max(dv) FILTER (w)) AS worst FROM f GROUP BY ALL),
 g AS (SELECT count(*) FILTER (e) AS ne, count(*) FILTER (w) AS nw, max(worst) FILTER (e) AS we, max(worst) FILTER (w) AS ww FROM s)"""
F5_SQL = """SELECT CASE WHEN ne > 0 THEN 'error' ELSE 'warning' END AS severity, CASE WHEN ne > 0 THEN 'temp_large_vertical_jump' ELSE 'temp_moderate_vertical_jump' END AS code,
  CAST(NULL AS VARCHAR) AS group_key, CASE WHEN ne > 0 THEN ne ELSE nw END AS n_rows, round(CASE WHEN ne > 0 THEN we ELSE ww END, 6) AS worst FROM g WHERE ne > 0 OR nw > 0"""


@query("f5_check_vertical_gradient", "WITH " + GRADIENT_SQL + F5_SQL)
def _(read):
    return shown(C.check_vertical_gradient(profiles(read), ["cast_key"], SEQ, "profundidad_m", "temperatura_c"))


@query("f6_check_monthly_jump", "WITH " + MONTHLY_SQL + """, d AS (SELECT series_id, CASE WHEN date_diff('day', lag(month) OVER w, month) / 30.4 <= 3 THEN abs(value - lag(value) OVER w) END AS d
  FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY month)), g AS (SELECT series_id, max(d) AS d, count(*) AS n FROM d GROUP BY ALL)
  SELECT CASE WHEN d >= 12 THEN 'error' ELSE 'warning' END AS severity, CASE WHEN d >= 12 THEN 'temp_month_to_month_spike' ELSE 'temp_month_to_month_jump' END AS code,
  CAST(series_id AS VARCHAR) AS group_key, n AS n_rows, round(d, 6) AS worst FROM g WHERE d >= 6""")
def _(read):
    return shown(C.check_monthly_jump(monthly_orders(read), "series_id", "month", "value"))


YEARLY_SQL = MONTHLY_SQL + """, y AS (SELECT series_id, year(month) AS year, median(value) AS m FROM monthly GROUP BY ALL),
 t AS (SELECT series_id, count(*) AS n, regr_slope(m, year) AS slope FROM y GROUP BY ALL)"""


@query("f7_check_annual_trend", "WITH " + YEARLY_SQL + """SELECT CASE WHEN n >= 5 AND abs(slope) >= 0.6 THEN 'error' ELSE 'warning' END AS severity,
  CASE WHEN n < 5 THEN 'series_too_short_for_trend' WHEN abs(slope) >= 0.6 THEN 'temp_annual_median_trend_extreme' ELSE 'temp_annual_median_trend' END AS code,
  CAST(series_id AS VARCHAR) AS group_key, n AS n_rows, CASE WHEN n >= 5 THEN round(slope, 6) END AS worst FROM t WHERE n < 5 OR abs(slope) >= 0.25""")
def _(read):
    return shown(C.check_annual_trend(monthly_orders(read), ["series_id"], "month", "value"))


@query("f8_check_window_shift", "WITH " + YEARLY_SQL + """, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY year DESC) AS rn FROM y),
 s AS (SELECT series_id, count(*) AS n, median(m) FILTER (rn <= 3) - median(m) FILTER (rn BETWEEN 4 AND 6) AS d FROM r GROUP BY ALL)
 SELECT 'warning' AS severity, 'temp_window_median_shift' AS code, CAST(series_id AS VARCHAR) AS group_key, n AS n_rows, round(d, 6) AS worst FROM s WHERE n >= 6 AND abs(d) >= 0.8""")
def _(read):
    return shown(C.check_window_shift(monthly_orders(read), "series_id", "month", "value"))


DATES_SQL = F1_SQL.replace("1996", "1970").replace("2000", "1999").format(t="fecha", f="profiles")


@query("f9_profile_contract", "WITH " + GRADIENT_SQL + F3_SQL.format(code="temp_out_of_absolute_range", worst="CASE WHEN max(temperatura_c) > 32 THEN max(temperatura_c) ELSE min(temperatura_c) END", f="profiles", bad="temperatura_c < -2 OR temperatura_c > 32") + " UNION ALL " + F5_SQL + " UNION ALL " + DATES_SQL)
def _(read):
    return shown(C.profile_contract(profiles(read), ["cast_key"], SEQ, C.ProfileLimits(years=(1970, 1999))))


F10_SQL = F3_SQL.format(code="out_of_absolute_range", worst="CASE WHEN max(value) > 200 THEN max(value) ELSE min(value) END", f="events", bad="value < 5 OR value > 200")
F11_SQL = """SELECT 'warning' AS severity, 'duplicate_timestamps' AS code, CAST(NULL AS VARCHAR) AS group_key, CAST(sum(n) AS BIGINT) AS n_rows, CAST(max(n) AS DOUBLE) AS worst
  FROM (SELECT count(*) AS n FROM {f} GROUP BY {k} HAVING count(*) > 1) HAVING sum(n) > 0"""
F12_SQL = """SELECT 'warning' AS severity, 'time_gap_detected' AS code, CAST(NULL AS VARCHAR) AS group_key, count(*) FILTER (g > 1) AS n_rows, round(max(g), 6) AS worst
  FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 86400e6 AS g FROM events) HAVING count(*) FILTER (g > 1) > 0"""


@query("f10_check_absolute_range", F10_SQL)
def _(read):
    return shown(C.check_range(read("events"), "value", 5.0, 200.0, "out_of_absolute_range"))


@query("f11_check_duplicates", F11_SQL.format(f="orders", k="o_custkey, o_orderdate"))
def _(read):
    return shown(C.check_duplicates(read("orders"), "o_orderdate", ["o_custkey"]))


@query("f12_check_time_gaps", F12_SQL)
def _(read):
    return shown(C.check_time_gaps(read("events"), "ts", ["user_id"], 1.0))


@query("f13_check_trend", "WITH " + YEARLY_SQL + """SELECT CASE WHEN abs(slope) >= 0.6 THEN 'error' ELSE 'warning' END AS severity,
  CASE WHEN abs(slope) >= 0.6 THEN 'extreme_annual_trend' ELSE 'notable_annual_trend' END AS code, CAST(series_id AS VARCHAR) AS group_key, n AS n_rows, round(slope, 6) AS worst FROM t WHERE n >= 5 AND abs(slope) >= 0.25""")
def _(read):
    return shown(C.check_annual_trend(monthly_orders(read), ["series_id"], "month", "value", codes=("notable_annual_trend", "extreme_annual_trend", None)))


@query("f14_run_contract", " UNION ALL ".join([F10_SQL, F11_SQL.format(f="events", k="ts, user_id"), F12_SQL]))
def _(read):
    return shown(C.run_contract(read("events"), "ts", "value", ["user_id"], C.SeriesLimits(low=5.0, high=200.0, max_gap_days=1.0)))


JUMPS_SQL = MONTHLY_SQL + """, d AS (SELECT series_id, abs(value - lag(value) OVER (PARTITION BY series_id ORDER BY month)) AS d FROM monthly),
 v AS (SELECT series_id, CASE WHEN max(d) >= 12 THEN 'error' ELSE 'warning' END AS severity FROM d GROUP BY ALL HAVING max(d) >= 6)"""


@query("f15_contract_counts", "WITH " + JUMPS_SQL + "SELECT CAST(series_id AS VARCHAR) AS source_file, count(*) AS n_violations, count(*) FILTER (severity = 'error') AS n_errors, count(*) FILTER (severity = 'error') > 0 AS has_error FROM v GROUP BY ALL")
def _(read):
    return C.contract_counts(C.check_monthly_jump(monthly_orders(read), "series_id", "month", "value").withColumnRenamed("group_key", "source_file"))


@query("f16_series_gate", "WITH " + JUMPS_SQL + "SELECT series_id, month, round(value, 6) AS value FROM monthly WHERE series_id NOT IN (SELECT series_id FROM v WHERE severity = 'error')")
def _(read):
    m = monthly_orders(read)
    return rounded(C.series_gate(m, C.check_monthly_jump(m, "series_id", "month", "value"), "series_id"))
