"""Audit aggregates over file, run and row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.scratch import written

from .quantiles import joined, quantiles


def inventory(files: DataFrame, rid: str = "radial_id", unknown: str = "desconocida") -> DataFrame:
    """Files by class with the total, most first."""
    by = written(files.groupBy(F.coalesce(F.col(rid).cast("string"), F.lit(unknown)).alias(rid)).agg(F.count(F.lit(1)).alias("n")), "inventory")  # classes, so files run once
    return by.unionByName(by.agg(F.lit("total").alias(rid), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))).orderBy(F.desc("n"), rid)


def top_reasons(df: DataFrame, reasons: str, n: int = 8) -> DataFrame:
    """The ``n`` most frequent elements of an array column, ties by name."""
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def funnel(files: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """``stage_no, stage, remaining, removed``: files that pass each stage and all before it, in one aggregation."""
    passed, sums = F.lit(True), []
    for name, cond in stages:
        passed = passed & F.coalesce(cond, F.lit(False))
        sums.append(F.count_if(passed).alias(name))
    agg = files.agg(*sums)
    rows = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), F.col(name).alias("remaining"), ((F.col(stages[i - 1][0]) - F.col(name)) if i else F.lit(0).cast("long")).alias("removed")) for i, (name, _) in enumerate(stages)])
    return agg.select(F.inline(rows))


def station_clean_vs_anomaly(df: DataFrame, station: str, flag: str, n: int = 8) -> DataFrame:
    """Clean and anomalous rows of the ``n`` stations with most rows."""
    out = df.groupBy(station).agg(F.count_if(~F.col(flag)).alias("clean"), F.count_if(flag).alias("anomalous"))
    return out.orderBy(F.desc(F.col("clean") + F.col("anomalous")), station).limit(n)


def anomaly_ratio(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count_if(~F.col(flag)).alias("clean"), F.count_if(flag).alias("anomalous"), F.try_divide(F.count_if(flag), F.count(flag)).alias("ratio"))


def run_duration(runs: DataFrame, run: str, start: str, end: str) -> DataFrame:
    """Seconds from the first start to the last end of every run; null if negative."""
    out = runs.groupBy(run).agg(F.min(start).alias("_a"), F.max(end).alias("_b"))
    seconds = (F.unix_micros(F.col("_b").cast("timestamp")) - F.unix_micros(F.col("_a").cast("timestamp"))) / 1e6
    return out.select(run, F.when(seconds >= 0, seconds).alias("seconds"))


def geo_index(files: DataFrame, rid: str, station: str, lat: str, lon: str, classes: list[str] | None = None) -> DataFrame:
    """Median position and number of files for each class, and for each class and station."""
    # read by counts and medians alike; filtered after it is written, as a filter on a class would repeat all that makes it
    rows = written(files.select(rid, station, lat, lon), "positions")
    rows = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(rid).isNotNull())
    rows = rows.where(F.col(rid).isin(*classes)) if classes else rows
    counts = rows.groupingSets([[F.col(rid)], [F.col(rid), F.col(station)]], F.col(rid), F.col(station)).agg(F.grouping(station).cast("int").alias("of_class"), F.count(F.lit(1)).alias("n"))
    each = {"lat": F.col(lat), "lon": F.col(lon)}
    of_class = joined(counts.where("of_class = 1"), [rid], quantiles(rows, [rid], each, 0.5))
    of_station = joined(counts.where("of_class = 0"), [rid, station], quantiles(rows, [rid, station], each, 0.5))
    return of_class.unionByName(of_station)


def profile_columns(df: DataFrame) -> DataFrame:
    """``column, type, nulls, pct_null`` for every column, in one pass; NaN counts as null."""
    empty = lambda c, t: (F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`")) if t in ("double", "float") else F.col(f"`{c}`").isNull()
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(empty(c, t)).alias(f"_{i}") for i, (c, t) in enumerate(df.dtypes)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"_{i}").alias("nulls")) for i, (c, t) in enumerate(df.dtypes)])
    return agg.select("_n", F.explode(rows).alias("r")).select("r.*", F.coalesce(F.try_divide(100.0 * F.col("r.nulls"), F.col("_n")), F.lit(0.0)).alias("pct_null"))


def table_completeness(profile: DataFrame, n_rows: int) -> DataFrame:
    """Cells, nulls, completeness and columns with nulls of a table's column profile."""
    agg = profile.agg((F.count(F.lit(1)) * n_rows).alias("cells"), F.sum("nulls").alias("nulls"), F.count_if(F.col("nulls") > 0).alias("columns_with_nulls"))
    return agg.withColumn("pct_complete", F.try_divide(100.0 * (F.col("cells") - F.col("nulls")), F.col("cells")))


def columns_without_description(columns: DataFrame, glossary: DataFrame) -> DataFrame:
    """Columns (``column``) that no glossary row (``column, description``) names, whatever case and blanks."""
    known = glossary.select(F.lower(F.trim("column")).alias("_k")).distinct()
    return columns.join(known, F.lower(F.trim(columns["column"])) == F.col("_k"), "left_anti")


def dataset_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"), F.array_join(F.array(*map(F.lit, df.columns)), ",").alias("columns"))


def step_totals(steps: DataFrame, status: str, ok: str, quarantined: str | None = None) -> DataFrame:
    """Steps, those that went well and not, and rows in quarantine."""
    q = F.coalesce(F.sum(quarantined), F.lit(0)) if quarantined else F.lit(0)
    return steps.agg(F.count(F.lit(1)).alias("n_steps"), F.count_if(F.col(status) == ok).alias("n_ok"), F.count_if(F.col(status) != ok).alias("n_errors"), q.cast("long").alias("n_quarantined"))


def ingest_failures(failures: DataFrame, order: list[str], n: int = 25) -> DataFrame:
    """The first ``n`` failures by path: a report."""
    return failures.orderBy(*order).limit(n)


def null_fractions(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns with the largest share of nulls."""
    return profile_columns(df).select("column", (F.col("pct_null") / 100).alias("fraction")).orderBy(F.desc("fraction"), "column").limit(n)
