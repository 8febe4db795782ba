"""Data contracts: rules that turn a table into a table of violations.

A violation is ``severity, code, group_key, n_rows, worst, message``. Every rule is one aggregation per grouping; the
conditions over the aggregates become rows with ``inline``. NaN counts as null throughout.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles
from .scan import layout

ERROR, WARNING = "error", "warning"
SCHEMA = "severity string, code string, group_key string, n_rows bigint, worst double, message string"


@dataclass(frozen=True)
class Band:
    """Adjacent samples whose distance lies in [low, high] (or (low, high] if ``open_low``) may differ by so much."""

    low: float
    high: float
    warn: float
    error: float
    open_low: bool = False


@dataclass(frozen=True)
class ProfileLimits:
    """Default limits of profile and monthly series rules."""

    temperature: tuple[float, float] = (-2.0, 32.0)
    salinity: tuple[float, float] = (0.0, 42.0)
    temperature_bands: tuple[Band, ...] = (Band(2.5, 5.0, 8.0, 23.0), Band(5.0, 15.0, 10.0, 24.0, True))
    salinity_bands: tuple[Band, ...] = (Band(2.5, 5.0, 3.0, 8.0), Band(5.0, 15.0, 4.0, 10.0, True))
    temperature_month: tuple[float, float] = (6.0, 12.0)
    salinity_month: tuple[float, float] = (2.5, 5.0)
    month_gap: float = 3.0
    years: tuple[int, int] = (1970, 2035)
    min_years: int = 5
    slope: tuple[float, float] = (0.25, 0.6)
    window_years: int = 3
    window_shift: float = 0.8
    segment_drop: float = 1.5


@dataclass(frozen=True)
class SeriesLimits:
    """Limits of the generic series contract; a rule whose limits are None is not run."""

    low: float | None = None
    high: float | None = None
    max_gap_days: float | None = None
    slope_warn: float | None = None
    slope_error: float | None = None
    min_years: int = 5


def finite(column: str) -> Column:
    """A numeric column with NaN as null; strings are tried as numbers."""
    x = F.col(column).try_cast("double")
    return F.when(~F.isnan(x), x)


def violation(when: Column, severity: str | Column, code: str | Column, n: Column, worst: Column | None = None, message: Column | None = None, group: Column | None = None) -> Column:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(
        when,
        F.struct(
            text(severity).alias("severity"), text(code).alias("code"), (group if group is not None else F.lit(None)).cast("string").alias("group_key"),
            n.cast("long").alias("n_rows"), (worst if worst is not None else F.lit(None)).cast("double").alias("worst"), (message if message is not None else text(code)).alias("message"),
        ),
    )


def emitted(df: DataFrame, *rules: Column, by: list[str] = ()) -> DataFrame:
    """The violations among ``rules``, each a struct or null, of every row, after its ``by`` columns."""
    return df.select(*by, F.explode(F.filter(F.array(*rules), lambda v: v.isNotNull())).alias("v")).select(*by, "v.*")


def check_dates(df: DataFrame, date: str, years: tuple[int, int] = ProfileLimits.years, by: list[str] = ()) -> DataFrame:
    """All dates unparseable: ERROR; some: WARNING; any year outside the window: ERROR. With ``by`` for each group of rows."""
    day = F.try_to_timestamp(F.col(date).cast("string"))
    out = F.count_if((F.year(day) < years[0]) | (F.year(day) > years[1]))
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count(day).alias("ok"), out.alias("out"), F.min(F.year(day)).alias("lo"), F.max(F.year(day)).alias("hi"))
    n, ok = F.col("n"), F.col("ok")
    return emitted(
        agg,
        violation((n > 0) & (ok == 0), ERROR, "sampling_date_unparseable", n),
        violation((ok > 0) & (ok < n), WARNING, "sampling_date_partially_missing", n - ok),
        violation(F.col("out") > 0, ERROR, "sampling_date_out_of_calendar_range", F.col("out"), F.when(F.col("hi") > years[1], F.col("hi")).otherwise(F.col("lo")), F.format_string("years %d to %d", "lo", "hi")),
        by=by,
    )


def check_columns(df: DataFrame, required: list[str], numeric: list[str] = ()) -> DataFrame:
    """A missing column: ERROR; a numeric one without any number: WARNING."""
    spark = df.sparkSession
    missing = [(ERROR, "missing_column", c, 0, None, f"column {c} is missing") for c in required if c not in df.columns]
    out = spark.createDataFrame(missing, SCHEMA)
    present = [c for c in numeric if c in df.columns]
    if present:
        agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(finite(c)).alias(c) for c in present])
        out = out.unionByName(emitted(agg, *[violation((F.col("_n") > 0) & (F.col(c) == 0), WARNING, "empty_after_coerce", F.col("_n"), group=F.lit(c)) for c in present]))
    return out


def check_range(df: DataFrame, value: str, low: float | None, high: float | None, code: str, by: list[str] = ()) -> DataFrame:
    """Values outside the bounds (None: unbounded): one ERROR with their number and the furthest of them. With ``by`` for each group of rows."""
    x = finite(value)
    bad = F.lit(False)
    bad = bad | (x < low) if low is not None else bad
    bad = bad | (x > high) if high is not None else bad
    agg = df.groupBy(*by).agg(F.count_if(bad).alias("n"), F.min(F.when(bad, x)).alias("lo"), F.max(F.when(bad, x)).alias("hi"))
    beyond = F.col("hi") > high if high is not None else F.lit(False)
    return emitted(agg, violation(F.col("n") > 0, ERROR, code, F.col("n"), F.when(beyond, F.col("hi")).otherwise(F.col("lo"))), by=by)


def _fell(depth: str, drop: float) -> Column:
    """1 where depth has dropped by more than ``drop`` since the row before, which is ``_z`` deep."""
    return F.coalesce((F.col(depth) - F.col("_z") < -drop).cast("int"), F.lit(0))


def _segments(df: DataFrame, cast: list[str], order: list[str], depth: str, drop: float, lag: dict[str, str], piece_rows: int | None = None) -> DataFrame:
    """Rows by cast with ``segment``, and the row before's depth ``_z`` and values of ``lag`` (name: column)."""
    before = {"_z": F.col(depth)} | {n: F.col(c) for n, c in lag.items()}
    return layout(df, cast, order, piece_rows).windowed(lag=before, total={"segment": _fell(depth, drop)}).table()


def depth_segments(df: DataFrame, cast: list[str], order: list[str], depth: str, drop: float = ProfileLimits.segment_drop, piece_rows: int | None = None) -> DataFrame:
    """``segment``: the number of times, in acquisition order, that depth has dropped by more than ``drop`` so far. A cast of any
    size is cut into pieces (see ``scan``)."""
    return _segments(df, cast, order, depth, drop, {}, piece_rows).drop("_z")


def gradient_segments(df: DataFrame, cast: list[str], order: list[str], depth: str, value: str, bands: tuple[Band, ...], drop: float = ProfileLimits.segment_drop) -> DataFrame:
    """For every segment of every cast: ``is_error``, ``is_warning`` and the largest flagged difference ``worst``.

    Rows without depth or value are left out first; acquisition order is never replaced by depth order. Within a band an
    error masks a warning; a segment with an error in any band is an error. A row that opens a segment has no neighbour in
    it, so segments need no window of their own; a cast of any size is cut into pieces (see ``scan``).
    """
    df = df.select(*cast, *[c for c in order if c not in cast], finite(depth).alias("_depth"), finite(value).alias("_value")).where("_depth is not null and _value is not null")
    near = lambda x: F.when(_fell("_depth", drop) == 0, x)
    df = _segments(df, cast, order, "_depth", drop, {"_v": "_value"}).select(*cast, "segment", near(F.col("_depth") - F.col("_z")).alias("dz"), near(F.abs(F.col("_value") - F.col("_v"))).alias("dv"))
    inside = [((F.col("dz") > b.low) if b.open_low else (F.col("dz") >= b.low)) & (F.col("dz") <= b.high) for b in bands]
    err = reduce(lambda a, b: a | b, [i & (F.col("dv") >= b.error) for i, b in zip(inside, bands, strict=True)])
    warn = reduce(lambda a, b: a | b, [i & (F.col("dv") >= b.warn) for i, b in zip(inside, bands, strict=True)])
    out = df.groupBy(*cast, "segment").agg(
        F.coalesce(F.bool_or(err), F.lit(False)).alias("is_error"), F.coalesce(F.bool_or(warn), F.lit(False)).alias("is_warning"), F.max(F.when(err, F.col("dv"))).alias("worst_error"), F.max(F.when(warn, F.col("dv"))).alias("worst_warning")
    )
    return out.select(*cast, "segment", "is_error", (F.col("is_warning") & ~F.col("is_error")).alias("is_warning"), F.coalesce("worst_error", "worst_warning").alias("worst"))


def check_vertical_gradient(df: DataFrame, cast: list[str], order: list[str], depth: str, value: str, prefix: str = "temp", bands: tuple[Band, ...] = ProfileLimits.temperature_bands, by: list[str] = ()) -> DataFrame:
    """``<prefix>_large_vertical_jump`` ERROR with the number of segments in error, else ``_moderate_`` WARNING. With ``by`` for
    each group of casts."""
    s = gradient_segments(df, [*by, *cast], order, depth, value, bands)
    agg = s.groupBy(*by).agg(F.count_if("is_error").alias("e"), F.count_if("is_warning").alias("w"), F.max(F.when(F.col("is_error"), F.col("worst"))).alias("we"), F.max(F.when(F.col("is_warning"), F.col("worst"))).alias("ww"))
    return emitted(
        agg,
        violation(F.col("e") > 0, ERROR, f"{prefix}_large_vertical_jump", F.col("e"), F.col("we")),
        violation((F.col("e") == 0) & (F.col("w") > 0), WARNING, f"{prefix}_moderate_vertical_jump", F.col("w"), F.col("ww")),
        by=by,
    )


def check_monthly_jump(df: DataFrame, station: str, month: str, value: str, prefix: str = "temp", limits: tuple[float, float] = ProfileLimits.temperature_month, max_gap: float = ProfileLimits.month_gap) -> DataFrame:
    """For each series, the largest difference of neighbours at most ``max_gap`` months of 30.4 days apart: ERROR
    ``_month_to_month_spike`` or WARNING ``_month_to_month_jump``. Series of fewer than two rows have none."""
    w = Window.partitionBy(station).orderBy(month)
    x = finite(value)
    near = F.datediff(F.col(month), F.lag(month).over(w)) / 30.4 <= max_gap
    df = df.where(x.isNotNull() & F.col(month).isNotNull()).withColumn("_d", F.when(near, F.abs(x - F.lag(x).over(w))))
    agg = df.groupBy(station).agg(F.max("_d").alias("d"), F.count(F.lit(1)).alias("n"))
    d = F.col("d")
    return emitted(
        agg,
        violation(d >= limits[1], ERROR, f"{prefix}_month_to_month_spike", F.col("n"), d, group=F.col(station)),
        violation((d >= limits[0]) & (d < limits[1]), WARNING, f"{prefix}_month_to_month_jump", F.col("n"), d, group=F.col(station)),
    )


def yearly_medians(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """``keys, year, median``: exact medians, counted out, so no task holds a year's values."""
    rows = df.where(finite(value).isNotNull() & F.col(time).isNotNull()).withColumn("_year", F.year(time))
    out = quantiles(rows, [*keys, "_year"], {"median": finite(value)}, 0.5)
    return out.select(*[F.col(f"_k.k{i}").alias(k) for i, k in enumerate([*keys, "year"])], "median")


def check_annual_trend(df: DataFrame, keys: list[str], time: str, value: str, limits: tuple[float | None, float | None] = ProfileLimits.slope, min_years: int = 5, codes: tuple[str, str, str | None] = ("temp_annual_median_trend", "temp_annual_median_trend_extreme", "series_too_short_for_trend")) -> DataFrame:
    """Slope of a line through the yearly medians of each series: WARNING or ERROR by its size; too few years: WARNING."""
    agg = yearly_medians(df, keys, time, value).groupBy(*keys).agg(F.count(F.lit(1)).alias("years"), F.regr_slope("median", "year").alias("slope"))
    slope, enough = F.abs("slope"), F.col("years") >= min_years
    group = F.concat_ws("/", *keys) if keys else None
    warn, err = limits
    rules = []
    if err is not None:
        rules.append(violation(enough & (slope >= err), ERROR, codes[1], F.col("years"), F.col("slope"), group=group))
    if warn is not None:
        rules.append(violation(enough & (slope >= warn) & ((slope < err) if err is not None else F.lit(True)), WARNING, codes[0], F.col("years"), F.col("slope"), group=group))
    if codes[2]:
        rules.append(violation(~enough, WARNING, codes[2], F.col("years"), group=group))
    return emitted(agg, *rules)


def check_window_shift(df: DataFrame, station: str, time: str, value: str, years: int = 3, shift: float = 0.8) -> DataFrame:
    """Median of the last ``years`` yearly medians against that of as many before: WARNING from ``shift`` on."""
    m = yearly_medians(df, [station], time, value)
    m = m.withColumn("rn", F.row_number().over(Window.partitionBy(station).orderBy(F.desc("year"))))
    late, early = F.col("rn") <= years, F.col("rn").between(years + 1, 2 * years)
    agg = m.groupBy(station).agg(F.count(F.lit(1)).alias("n"), (F.median(F.when(late, F.col("median"))) - F.median(F.when(early, F.col("median")))).alias("d"), F.sort_array(F.collect_list(F.when(F.col("rn") <= 2 * years, F.col("year")))).alias("ys"))
    return emitted(agg, violation((F.col("n") >= 2 * years) & (F.abs("d") >= shift), WARNING, "temp_window_median_shift", F.col("n"), F.col("d"), F.concat(F.lit("years "), F.array_join(F.col("ys").cast("array<string>"), ",")), F.col(station)))


def sorted_violations(df: DataFrame) -> DataFrame:
    """Errors first, then by code and group."""
    return df.orderBy(F.when(F.col("severity") == ERROR, 0).otherwise(1), "code", "group_key")


def profile_contract(df: DataFrame, cast: list[str], order: list[str], limits: ProfileLimits = ProfileLimits(), depth: str = "profundidad_m", temperature: str = "temperatura_c", date: str = "fecha") -> DataFrame:
    """The canonical profile table's rules together; missing core columns are WARNINGs and their rules are left out."""
    missing = [c for c in (depth, temperature, date) if c not in df.columns]
    rows = df.sparkSession.createDataFrame([(WARNING, "missing_column", c, 0, None, f"column {c} is missing") for c in missing], SCHEMA)
    parts = [rows]
    if temperature not in missing:
        parts.append(check_range(df, temperature, *limits.temperature, "temp_out_of_absolute_range"))
        if depth not in missing:
            parts.append(check_vertical_gradient(df, cast, order, depth, temperature, "temp", limits.temperature_bands))
    if date not in missing:
        parts.append(check_dates(df, date, limits.years))
    return sorted_violations(reduce(DataFrame.unionByName, parts))


def profile_contract_by(df: DataFrame, by: list[str], cast: list[str], order: list[str], limits: ProfileLimits = ProfileLimits(), depth: str = "profundidad_m", temperature: str = "temperatura_c", date: str = "fecha") -> DataFrame:
    """``profile_contract`` of every source at once: ``by`` columns before each violation. The table has the core columns."""
    parts = [
        check_range(df, temperature, *limits.temperature, "temp_out_of_absolute_range", by),
        check_vertical_gradient(df, cast, order, depth, temperature, "temp", limits.temperature_bands, by),
        check_dates(df, date, limits.years, by),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_duplicates(df: DataFrame, time: str, keys: list[str] = ()) -> DataFrame:
    """All rows that share time and keys with another: WARNING; a missing time column: ERROR. Null keys are a group."""
    if time not in df.columns:
        return df.sparkSession.createDataFrame([(ERROR, "missing_time_column", time, 0, None, f"column {time} is missing")], SCHEMA)
    agg = df.groupBy(time, *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("n").alias("m"))
    return emitted(agg, violation(F.col("n") > 0, WARNING, "duplicate_timestamps", F.col("n"), F.col("m")))


def check_time_gaps(df: DataFrame, time: str, keys: list[str], max_gap_days: float) -> DataFrame:
    """Steps of a series longer than ``max_gap_days``: one WARNING with their number and the longest. Null keys are a group; a
    series of any length is cut into pieces (see ``scan``)."""
    rows = layout(df.where(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_t")), keys, ["_t"]).windowed(lag={"_before": F.col("_t")}).table()
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    gap = (micros(F.col("_t")) - micros(F.col("_before"))) / 86_400e6
    agg = rows.select(gap.alias("g")).agg(F.count_if(F.col("g") > max_gap_days).alias("n"), F.max("g").alias("m"))
    return emitted(agg, violation(F.col("n") > 0, WARNING, "time_gap_detected", F.col("n"), F.col("m")))


def run_contract(df: DataFrame, time: str, value: str, keys: list[str], limits: SeriesLimits) -> DataFrame:
    """The generic series contract: range, duplicates, gaps and trend, as far as ``limits`` asks for them."""
    parts = [check_duplicates(df, time, keys)]
    if limits.low is not None or limits.high is not None:
        parts.append(check_range(df, value, limits.low, limits.high, "out_of_absolute_range"))
    if time in df.columns:
        if limits.max_gap_days is not None:
            parts.append(check_time_gaps(df, time, keys, limits.max_gap_days))
        if limits.slope_warn is not None or limits.slope_error is not None:
            parts.append(check_annual_trend(df, keys, time, value, (limits.slope_warn, limits.slope_error), limits.min_years, ("notable_annual_trend", "extreme_annual_trend", None)))
    return sorted_violations(reduce(DataFrame.unionByName, parts))


def contract_counts(violations: DataFrame, source: str = "source_file") -> DataFrame:
    """Violations and errors of every source, and whether it has any."""
    out = violations.groupBy(source).agg(F.count(F.lit(1)).alias("n_violations"), F.count_if(F.col("severity") == ERROR).alias("n_errors"))
    return out.withColumn("has_error", F.col("n_errors") > 0)


def series_gate(series: DataFrame, violations: DataFrame, key: str, unlocked: bool = False) -> DataFrame:
    """Series without an ERROR against them; all of them when unlocked."""
    if unlocked:
        return series
    bad = violations.where(F.col("severity") == ERROR).select(F.col("group_key").alias("_bad")).distinct()
    return series.join(bad, series[key].cast("string") == F.col("_bad"), "left_anti")
