"""Acceptance of files by their header facts, preflight aggregates and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names that count as temperature, depth, time, auxiliary sensors, and salinity or conductivity.
TEMPERATURE = ("temperatura_c", "temperatura", "temp", "temperature", "t090c", "t068", "t068c", "tv290c", "ts068", "potemp068", "potemp068c")
DEPTH = ("profundidad_m", "profundidad", "depth", "dep", "depsm", "deps", "dep_sm", "prdm", "prdm [m]", "prsm", "prsm [db]", "prse", "press", "pr", "sigma0", "sigma-theta", "sigma_theta")
TIME = ("fecha", "date", "datetime", "time", "timestamp", "timej", "timejv2", "time_s")
AUXILIARY = ("par", "spar", "fls", "oxygen", "oxymg", "sbeoxymg", "sbeoxymol")
SALINE = ("c0s/m", "c1s/m", "sal00", "salinity", "sal")


def _any(names: Column, wanted: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, wanted))), F.lit(False))


def gate(files: DataFrame, path: str = "path", length: str = "length", names: str = "names", start_time: str = "has_start_time") -> DataFrame:
    """``reasons`` (all that apply) and ``accepted``. Missing, extension and emptiness end the inspection, as does a header
    without columns; then temperature, depth and time are asked for. A file without temperature is an auxiliary profile if it has
    an auxiliary sensor and neither salinity nor conductivity."""
    n, cols = F.col(length), F.col(names)
    say = lambda cond, text: F.when(F.coalesce(cond, F.lit(False)), F.lit(text))
    first = [say(n.isNull(), "missing_file"), say(~F.lower(path).endswith(".cnv"), "bad_extension"), say(n == 0, "empty_file")]
    no_temp, auxiliary = ~_any(cols, TEMPERATURE), _any(cols, AUXILIARY) & ~_any(cols, SALINE)
    rest = [
        say(no_temp & ~auxiliary, "no_temperature"), say(no_temp & auxiliary, "no_temperature_auxiliary_profile"), say(~_any(cols, DEPTH), "no_depth"),
        say(~_any(cols, TIME) & ~F.col(start_time), "no_time"),
    ]
    early = F.filter(F.array(*first), lambda r: r.isNotNull())
    none = F.coalesce(F.size(cols) <= 0, F.lit(True))
    late = F.when(none, F.array(F.lit("no_columns"))).otherwise(F.filter(F.array(*rest), lambda r: r.isNotNull()))
    reasons = F.when(F.size(early) > 0, early).otherwise(late)
    return files.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def preflight_by_folder(files: DataFrame, folder: str = "folder", top: int = 12) -> DataFrame:
    """Of each folder: files, accepted, rejected, ids, unknown ids, conflicts, without start time, and its ``top`` reasons."""
    agg = files.groupBy(folder).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if("accepted").alias("n_ok"), F.count_if(~F.col("accepted")).alias("n_rejected"), F.count_distinct("radial_id").alias("n_ids"),
        F.count_if(F.col("radial_id").isNull()).alias("n_unknown"), F.count_if("conflict").alias("n_conflicts"), F.count_if(~F.col("has_start_time")).alias("n_no_start_time"),
    )
    reasons = files.select(folder, F.explode("reasons").alias("reason")).groupBy(folder, "reason").agg(F.count(F.lit(1)).alias("n"))
    # a handful of reasons for each folder, so the list is short whatever the folder holds
    ordered = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("a"), F.col("reason").alias("reason")))), 1, top)
    return agg.join(reasons.groupBy(folder).agg(F.transform(ordered, lambda s: F.concat_ws(":", s["reason"], (-s["a"]).cast("string"))).alias("top_reasons")), folder, "left")


def preflight_findings(folders: DataFrame, folder: str = "folder") -> DataFrame:
    """``folder, finding`` rows: mixed ids, unknown ids, conflicts, all rejected, many rejected (over max(3, a fifth))."""
    say = lambda cond, text: F.when(cond, F.lit(text))
    found = F.array(
        say(F.col("n_ids") > 1, "mixed_ids"), say(F.col("n_unknown") > 0, "unknown_ids"), say(F.col("n_conflicts") > 0, "conflicts"), say((F.col("n_rejected") > 0) & (F.col("n_ok") == 0), "all_rejected"),
        say((F.col("n_ok") > 0) & (F.col("n_rejected") > F.greatest(F.lit(3), F.floor(F.col("n_files") / 5))), "many_rejected"),
    )
    return folders.select(folder, F.explode(F.filter(found, lambda f: f.isNotNull())).alias("finding"))


def dubious_rows(files: DataFrame, most: int = 400, path: str = "path") -> DataFrame:
    """Files with an issue (gate, unknown id, conflict), the first ``most`` by path: a report."""
    issues = F.concat("reasons", F.filter(F.array(F.when(F.col("radial_id").isNull(), "unknown_id"), F.when(F.col("conflict"), "conflict")), lambda x: x.isNotNull()))
    return files.withColumn("issues", issues).where(F.size("issues") > 0).orderBy(path).limit(most)


def shard_counts(files: DataFrame, segment: str = "segment") -> DataFrame:
    """Files by first segment, of those that are no year, most first."""
    return files.where(~F.col(segment).rlike(r"^\d{4}$")).groupBy(segment).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), segment)
