"""Profiles to monthly series, climatology, seasonal models, bands and gaps; all series at once, grouped by their key."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contract import finite
from .scan import layout

#: What sums are taken in: exact, so that no order of rows or partitions changes a result.
EXACT = "decimal(28,12)"
#: About the rows that a task groups where groups are nearly as many as rows.
TASK_ROWS = 250_000
#: Steps of a series' order that one block of its factorisation spans.
BLOCK_ROWS = 16_384
#: Quantiles of the normal distribution for two-sided bands of 95, 75 and 50 %.
Z = {"95": 1.959963984540054, "75": 1.1503493803760079, "50": 0.6744897501960817}


def exact_sum(x: Column) -> Column:
    """The sum of ``x``, its values rounded to 12 places, as an aggregate or window column to be cast or divided."""
    return F.sum(x.try_cast(EXACT))


def interp_at_depth(df: DataFrame, cast: list[str], depth: str, value: str, target: float, least: Column | None = None) -> DataFrame:
    """``cast, value_at, z_max`` by linear interpolation; repeated depths are averaged; null outside the cast's depths. With ``least``
    also its least value over all rows of the cast, those without depth or value too.

    Casts may be nearly as many as rows, so rows go by cast and depth to tasks of about ``TASK_ROWS`` before any group is made: what
    a task holds depends neither on the table's size nor on a cast's (rows of one depth pass it as a running mean). The rows are
    counted first (footers only, of a Parquet table).
    """
    z, v, low = finite(depth), finite(value), [] if least is None else [F.min("least").alias("least")]
    rows = df.select(*cast, F.when(v.isNotNull(), z).alias("z"), F.when(z.isNotNull(), v).alias("v"), *([] if least is None else [least.alias("least")]))
    rows = (rows.where("z is not null") if least is None else rows).repartition(max(1, -(-df.count() // TASK_ROWS)), *cast, "z")
    depths = rows.groupBy(*cast, "z").agg(F.avg("v").alias("v"), *low)
    below, above = F.col("z") <= target, F.col("z") >= target
    agg = depths.groupBy(*cast).agg(
        F.max(F.when(below, F.col("z"))).alias("z0"), F.max_by("v", F.when(below, F.col("z"))).alias("v0"), F.min(F.when(above, F.col("z"))).alias("z1"), F.min_by("v", F.when(above, F.col("z"))).alias("v1"), F.max("z").alias("z_max"), *low
    )
    line = F.col("v0") + (F.col("v1") - F.col("v0")) * (target - F.col("z0")) / (F.col("z1") - F.col("z0"))
    return agg.where("z_max is not null").select(*cast, F.when(F.col("z0") == F.col("z1"), F.col("v0")).otherwise(line).alias("value_at"), "z_max", *([] if least is None else ["least"]))


def casts_at_depth(df: DataFrame, station: str, cast: str, order: list[str], date: str, depth: str, value: str, target: float) -> DataFrame:
    """One row a cast that has a station and a key: station, month of its first row in acquisition order, ``value_at`` and ``z_max``."""
    first = F.struct(F.struct(*order).alias("at"), F.col(date).alias("date"))
    casts = interp_at_depth(df, [station, cast], depth, value, target, first).where(F.col(station).isNotNull() & F.col(cast).isNotNull())
    return casts.select(station, cast, "value_at", "z_max", F.trunc("least.date", "MONTH").alias("month"))


def monthly_at_depth(casts: DataFrame, station: str, cast: str) -> DataFrame:
    """Of each station and month the value of the deepest cast; of equally deep ones the smallest cast key."""
    rows = casts.where("value_at is not null").groupBy(station, "month")
    best = F.min_by(F.struct("value_at", "z_max", cast), F.struct((-F.col("z_max")).alias("a"), F.col(cast)))
    return rows.agg(best.alias("b")).select(station, "month", F.col("b.value_at").alias("value_at"), F.col("b.z_max").alias("z_max"), F.col(f"b.{cast}").alias(cast))


def coverage_diag(casts: DataFrame, target: float) -> DataFrame:
    """Casts, those with a value and those without coverage at the target; one row of zeros for no casts."""
    return casts.agg(F.count(F.lit(1)).alias("n_casts"), F.count("value_at").alias("n_with_value"), F.count_if(F.col("value_at").isNull()).alias("n_without_coverage"), F.lit(target).alias("target_depth"))


def monthly_mean(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """``keys, month, value``: the mean of each month, from an exact sum divided once."""
    x = finite(value)
    return df.groupBy(*keys, F.trunc(time, "MONTH").alias("month")).agg(F.try_divide(exact_sum(x).cast("double"), F.count(x.try_cast(EXACT))).alias("value"))


def month_grid(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Every month between a series' first and last, values null where it has none."""
    span = monthly.groupBy(*keys).agg(F.min("month").alias("a"), F.max("month").alias("b"))
    grid = span.select(*keys, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return grid.join(monthly, [*keys, "month"], "left")


def climatology_anomaly(grid: DataFrame, keys: list[str]) -> DataFrame:
    """``climatology`` (mean of the calendar month's values of the series, from an exact sum) and ``anomaly`` (value less it)."""
    own = Window.partitionBy(*keys, F.month("month"))
    clim = F.try_divide(exact_sum(F.col("value")).over(own).cast("double"), F.count("value").over(own))
    return grid.withColumn("climatology", clim).withColumn("anomaly", F.col("value") - F.col("climatology"))


def month_number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month)


def month_index(grid: DataFrame, keys: list[str]) -> DataFrame:
    """``t``: whole months since the series' first."""
    n = month_number(F.col("month"))
    return grid.withColumn("t", n - F.min(n).over(Window.partitionBy(*keys)))


def design(t: Column, harmonics: int = 3, trend: bool = False) -> list[Column]:
    """1, (t,) and sine and cosine of each yearly harmonic."""
    turn = [F.lit(2 * math.pi * k / 12) * t for k in range(1, harmonics + 1)]
    return [F.lit(1.0), *([t.cast("double")] if trend else []), *[f(a) for a in turn for f in (F.sin, F.cos)]]


def gram_sums(df: DataFrame, keys: list[str], xs: list[Column], y: Column) -> DataFrame:
    """``n``, the Gram matrix ``g`` (row by row) and ``r`` = X'y of each series, by exact sums with map-side combine."""
    p = len(xs)
    total = lambda x: exact_sum(x).cast("double")
    upper = {(i, j): total(xs[i] * xs[j]) for i in range(p) for j in range(i, p)}
    rows = df.where(y.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"g_{i}_{j}") for (i, j), s in upper.items()], *[total(xs[i] * y).alias(f"r_{i}") for i in range(p)])
    g = F.array(*[F.col(f"g_{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)])
    return rows.select(*keys, "n", g.alias("g"), F.array(*[F.col(f"r_{i}") for i in range(p)]).alias("r"))


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists as rows of doubles, where each list begins and the last ends)."""
    ends = column.offsets.to_numpy()
    flat = column.values.slice(ends[0], ends[-1] - ends[0])
    parts = [np.asarray(flat.field(i).to_numpy(zero_copy_only=False), float) for i in range(flat.type.num_fields)] if pa.types.is_struct(flat.type) else [np.asarray(flat.to_numpy(zero_copy_only=False), float)]
    return np.stack(parts, axis=-1) if len(parts) > 1 else parts[0], ends - ends[0]


def _triangles(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The R of a QR factorisation of each consecutive run of rows; runs of like length are factored together, zeros below."""
    size, width = np.diff(ends), rows.shape[1]
    room = np.maximum(width, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(int))
    out = np.zeros((len(size), width, width))
    for n in np.unique(room):
        own = np.flatnonzero(room == n)
        for some in np.array_split(own, max(1, len(own) * n * width // 4_000_000)):
            stack = np.zeros((len(some), n, width))
            for k, i in enumerate(some):
                stack[k, : size[i]] = rows[ends[i] : ends[i + 1]]
            out[some] = np.linalg.qr(stack, mode="r")
    return out


def least_squares(df: DataFrame, keys: list[str], xs: list[Column], y: Column, order: Column) -> DataFrame:
    """``n, coef``: rows with a ``y`` and the least-squares coefficients of each series, of least norm where its columns depend.

    A tall-and-skinny QR: rows of a series are factored in blocks of ``BLOCK_ROWS`` steps of the whole number ``order``, and the
    small triangles are stacked and factored again, so the columns' condition isn't squared as in normal equations, and a series
    of any length is many tasks. Blocks depend on ``order`` alone, so partitions don't change a result.
    """
    width, kinds = len(xs) + 1, dict(df.dtypes)
    place = order.cast("long")
    block = F.floor(place / BLOCK_ROWS).alias("_block")
    line = F.struct(place.cast("double").alias("at"), *[x.cast("double").alias(f"x{i}") for i, x in enumerate(xs)], y.cast("double").alias("y"))
    blocks = df.where(y.isNotNull()).groupBy(*keys, block).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(line)).alias("rows"))

    def factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows, ends = _lists(rb.column("rows"))
            r = _triangles(rows[:, 1:], ends).reshape(rb.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*[rb.column(k) for k in (*keys, "_block", "n")], pa.array(r.tolist(), pa.list_(pa.float64()))], names=[*keys, "_block", "n", "r"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            flat, ends = _lists(rb.column("r"))
            r = _triangles(flat.reshape(-1, width), ends // width)
            a, b = r[:, :-1, :-1], r[:, :-1, -1:]
            size = np.sqrt(np.einsum("nij,nij->nj", a, a))
            scale = np.where(size > 1e-10 * size.max(axis=1, keepdims=True), 1 / np.maximum(size, 1e-300), 0)  # like size, so small columns aren't cut; empty ones are
            coef = (np.linalg.pinv(a * scale[:, None, :], rcond=1e-10) @ b)[:, :, 0] * scale
            yield pa.RecordBatch.from_arrays([*[rb.column(k) for k in keys], rb.column("n"), pa.array(coef.tolist(), pa.list_(pa.float64()))], names=[*keys, "n", "coef"])

    own = ", ".join(f"{k} {kinds[k]}" for k in keys)
    triangles = blocks.mapInArrow(factored, f"{own}, _block long, n long, r array<double>")
    ordered = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_block", "r"))), lambda s: s["r"]))
    return triangles.groupBy(*keys).agg(F.sum("n").alias("n"), ordered.alias("r")).mapInArrow(merged, f"{own}, n long, coef array<double>")


def _fitted(xs: list[Column], skip: int = 0) -> Column:
    return sum((F.col("coef")[i] * x for i, x in enumerate(xs) if i >= skip), F.lit(0.0))


def fourier_fit(grid: DataFrame, keys: list[str], harmonics: int = 3) -> DataFrame:
    """``coef`` and ``seasonal`` (fitted less its constant) for all months, from the observed ones; series with fewer
    than 2K + 1 have seasonal 0 and null coefficients."""
    grid = grid if "t" in grid.columns else month_index(grid, keys)
    xs = design(F.col("t"), harmonics)
    coef = least_squares(grid, keys, xs, F.col("value"), F.col("t")).where(F.col("n") >= 2 * harmonics + 1).drop("n")
    out = grid.join(coef, keys, "left")
    return out.withColumn("seasonal", F.when(F.col("coef").isNull(), F.lit(0.0)).otherwise(_fitted(xs, skip=1)))


def deseasonalize(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """``deseasonalized`` (value less seasonal) and ``deseasonalized_anomaly`` (less its mean)."""
    out = fitted.withColumn("deseasonalized", F.col("value") - F.col("seasonal"))
    return out.withColumn("deseasonalized_anomaly", F.col("deseasonalized") - F.avg("deseasonalized").over(Window.partitionBy(*keys)))


def future_months(grid: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """The ``horizon`` months after each series' last, with their index from the same origin."""
    n = month_number(F.col("month"))
    span = grid.groupBy(*keys).agg(F.max("month").alias("last"), (F.max(n) - F.min(n)).alias("t_last"))
    step = span.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return step.select(*keys, F.add_months("last", F.col("h")).alias("month"), (F.col("t_last") + F.col("h")).alias("t"))


def fourier_extrapolate(fitted: DataFrame, keys: list[str], horizon: int = 60, harmonics: int = 3) -> DataFrame:
    """Seasonal values of the coming months from the fitted coefficients; null without."""
    coef = fitted.groupBy(*keys).agg(F.first("coef", ignorenulls=True).alias("coef"))
    ahead = future_months(fitted, keys, horizon).join(coef, keys)
    return ahead.withColumn("seasonal", F.when(F.col("coef").isNotNull(), _fitted(design(F.col("t"), harmonics), skip=1)))


def fill_linear(grid: DataFrame, keys: list[str]) -> DataFrame:
    """``filled``: gaps between observed months by a line; trailing gaps carry the last value, leading ones stay null. A series of
    any length is cut into pieces (see ``scan``)."""
    n = month_number(F.col("month"))
    seen = F.when(F.col("value").isNotNull(), F.struct(n.alias("n"), F.col("value").alias("v")))
    out = layout(grid, keys, ["month"]).windowed(last={"_a": seen}, ahead={"_b": seen}).table()
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (n - F.col("_a.n")) / (F.col("_b.n") - F.col("_a.n"))
    filled = F.when(F.col("value").isNotNull(), F.col("value")).when(F.col("_b").isNull(), F.col("_a.v")).when(F.col("_a").isNotNull(), line)
    return out.withColumn("filled", filled).drop("_a", "_b")


def forecast_flat(monthly: DataFrame, keys: list[str], horizon: int = 60) -> DataFrame:
    """The mean for ``horizon`` months with bounds at 1.96 sample standard deviations (0.5 for a single point)."""
    stats = monthly.where("value is not null").groupBy(*keys).agg(F.avg("value").alias("forecast"), F.coalesce(F.stddev_samp("value"), F.lit(0.5)).alias("sd"))
    out = future_months(monthly, keys, horizon).join(stats, keys)
    return out.select(*keys, "month", "t", "forecast", (F.col("forecast") - 1.96 * F.col("sd")).alias("lower"), (F.col("forecast") + 1.96 * F.col("sd")).alias("upper"))


def trend_fourier_holdout(monthly: DataFrame, keys: list[str], holdout: int = 12, harmonics: int = 3) -> DataFrame:
    """``observation, fitted, residual, is_holdout, status`` of a trend and Fourier model, the last observed months held out.

    With n observed months, min(holdout, n - (2K + 3)) are held out; series with fewer than 4 months, or none to hold out
    or to train on, keep their rows with status ``too_short``.
    """
    rows = month_index(monthly.where("value is not null"), keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("month")))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    held = F.least(F.lit(holdout), n - (2 * harmonics + 3))
    rows = rows.withColumn("_n", n).withColumn("_h", held).withColumn("_rank", rank)
    ok = (F.col("_n") >= 4) & (F.col("_h") >= 1)
    rows = rows.withColumn("status", F.when(ok, "ok").otherwise("too_short")).withColumn("is_holdout", ok & (F.col("_rank") <= F.col("_h")))
    xs = design(F.col("t"), harmonics, trend=True)
    train = rows.where("status = 'ok' and not is_holdout")
    coef = least_squares(train, keys, xs, F.col("value"), F.col("t")).drop("n")
    out = rows.join(coef, keys, "left").withColumn("fitted", F.when(F.col("coef").isNotNull(), _fitted(xs)))
    return out.select(*keys, "month", "t", F.col("value").alias("observation"), "fitted", (F.col("value") - F.col("fitted")).alias("residual"), "is_holdout", "status")


def residual_bands(model: DataFrame, keys: list[str]) -> DataFrame:
    """Half widths of the 95, 75 and 50 % bands, the same for every month of a series: z times the sample standard deviation
    of the training residuals (one residual: 0, which counts as 1; none: 1)."""
    sd = model.groupBy(*keys).agg(F.stddev_samp(F.when(~F.col("is_holdout"), F.col("residual"))).alias("sd"))
    sd = sd.withColumn("sigma", F.when(F.coalesce("sd", F.lit(0.0)) > 0, F.col("sd")).otherwise(F.lit(1.0))).drop("sd")
    return sd.select(*keys, "sigma", *[(F.lit(z) * F.col("sigma")).alias(f"half_{p}") for p, z in Z.items()])


def residual_band_rows(model: DataFrame, keys: list[str], months: int = 12) -> DataFrame:
    """For every month of a series the residual bands ``low_p, high_p``, and the forecast's (``forecast`` 0, ``forecast_low_p,
    forecast_high_p``), which are null outside the ``months`` months from the first held-out one on; null throughout for a series
    without held-out months. Of rows of one month the residual bands count the last."""
    last = model.groupBy(*keys, "month").agg(F.max_by(F.struct("residual", "is_holdout"), F.coalesce("t", F.lit(0)) if "t" in model.columns else F.lit(0)).alias("r"))
    rows = last.select(*keys, "month", "r.residual", "r.is_holdout")
    start = rows.groupBy(*keys).agg(F.min(F.when(F.col("is_holdout"), F.col("month"))).alias("cutoff"))
    out = rows.select(*keys, "month").join(residual_bands(rows, keys), keys).join(start, keys)
    ahead = month_number(F.col("month")) - month_number(F.col("cutoff"))
    inside = (F.col("month") >= F.col("cutoff")) & (ahead < months)
    sides = [(F.lit(sign) * F.col(f"half_{p}"), f"{name}_{p}") for p in Z for sign, name in ((-1.0, "low"), (1.0, "high"))]
    return out.select(*keys, "month", *[c.alias(n) for c, n in sides], F.when(inside, F.lit(0.0)).alias("forecast"), *[F.when(inside, c).alias(f"forecast_{n}") for c, n in sides])


def apply_bands(model: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """The model with ``lower_p, upper_p`` for each band; a missing band is the fitted value itself."""
    out = model.join(bands, keys, "left")
    for p in Z:
        half = F.coalesce(f"half_{p}", F.lit(0.0))
        out = out.withColumn(f"lower_{p}", F.col("fitted") - half).withColumn(f"upper_{p}", F.col("fitted") + half)
    return out.drop("sigma", *[f"half_{p}" for p in Z])


def band_guard(banded: DataFrame, keys: list[str], factor: float = 3.0) -> DataFrame:
    """Training rows whose 95 % band is at most ``factor`` times the series' 95 % quantile of widths."""
    rows = banded.where("not is_holdout").withColumn("width", F.col("upper_95") - F.col("lower_95"))
    limit = rows.groupBy(*keys).agg(F.percentile("width", 0.95).alias("q"))
    return rows.join(limit, keys).where(F.col("width") <= factor * F.col("q")).drop("q")


def long_gaps(monthly: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """Runs of ``least`` or more missing months between observed ones: ``gap_from, gap_to, missing``."""
    months = monthly.where("value is not null").select(*keys, "month").distinct()
    nxt = F.lead("month").over(Window.partitionBy(*keys).orderBy("month"))
    rows = months.withColumn("next", nxt).withColumn("missing", month_number(F.col("next")) - month_number(F.col("month")) - 1)
    return rows.where(F.col("missing") >= least).select(*keys, F.add_months("month", 1).alias("gap_from"), F.add_months("next", -1).alias("gap_to"), "missing")


def segments_at_gaps(monthly: DataFrame, keys: list[str], max_gap: int = 3) -> DataFrame:
    """``segment``: how many steps of more than ``max_gap`` months lie before a month."""
    w = Window.partitionBy(*keys).orderBy("month")
    n = month_number(F.col("month"))
    rows = monthly.withColumn("_jump", F.coalesce((n - F.lag(n).over(w) > max_gap).cast("int"), F.lit(0)))
    return rows.withColumn("segment", F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def coverage_pct(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Observed months against calendar months, the last month and the number of gaps of each series."""
    rows = monthly.where("value is not null").select(*keys, "month").distinct()
    n = month_number(F.col("month"))
    agg = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("observed"), (F.max(n) - F.min(n) + 1).alias("calendar"), F.max("month").alias("last_month"))
    gaps = long_gaps(monthly, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_gaps"))
    out = agg.join(gaps, keys, "left").withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0)))
    return out.withColumn("coverage_pct", 100.0 * F.col("observed") / F.col("calendar"))


def series_highlights(model: DataFrame, keys: list[str]) -> DataFrame:
    """Least and greatest observation, amplitude of the fit (over 12 rows) and its yearly slope by position (24 rows)."""
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy("month"))
    agg = model.withColumn("_i", pos).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("observation").alias("low"), F.max("observation").alias("high"), (F.max("fitted") - F.min("fitted")).alias("amp"), (F.regr_slope("fitted", "_i") * 12).alias("slope")
    )
    return agg.select(*keys, "n", "low", "high", F.when(F.col("n") > 12, F.col("amp")).alias("amplitude"), F.when(F.col("n") >= 24, F.col("slope")).alias("slope_per_year"))


def station_forecast(df: DataFrame, keys: list[str], time: str, value: str, horizon: int = 60) -> DataFrame:
    """History (mean, climatology, anomaly, seasonal, deseasonalised) and forecast rows of every series, tagged ``kind``."""
    monthly = monthly_mean(df, keys, time, value)
    past = deseasonalize(fourier_fit(climatology_anomaly(month_grid(monthly, keys), keys), keys), keys)
    clim = past.where("climatology is not null").groupBy(*keys, F.month("month").alias("cm")).agg(F.first("climatology").alias("climatology"))
    ahead = forecast_flat(monthly, keys, horizon).join(fourier_extrapolate(past, keys, horizon).drop("t", "coef"), [*keys, "month"])
    ahead = ahead.withColumn("cm", F.month("month")).join(clim, [*keys, "cm"], "left").drop("cm")
    return past.drop("coef").withColumn("kind", F.lit("historico")).unionByName(ahead.withColumn("kind", F.lit("pronostico")), allowMissingColumns=True)


def viewer_union(clean: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Both tables by name, tagged ``is_anomaly``."""
    return clean.withColumn("is_anomaly", F.lit(False)).unionByName(anomalies.withColumn("is_anomaly", F.lit(True)), allowMissingColumns=True)
