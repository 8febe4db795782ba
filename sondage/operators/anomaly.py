"""Anomaly plumbing: features, strata, thresholds, explanation, outputs and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.scratch import written

from . import contract
from .contract import finite
from .forest import Forest, narrow_features, narrow_scores, with_scores
from .quantiles import joined, key_of, narrow, quantiles, quantiles_of

# Columns that identify rows, and the edges of the depth bands.
IDS = ("estacion", "acronimo", "cast", "source_file", "radial_id", "run_id", "row_id")
DEPTHS = ("profundidad_m", "pressure", "depth")
BANDS = (0.0, 20.0, 100.0)
NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def select_features(df: DataFrame, ids: tuple[str, ...] = IDS, most_null: float = 0.40) -> list[str]:
    """Numeric columns that are no ids and of which at most ``most_null`` is null or NaN; one aggregation."""
    cols = [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c.lower() not in ids]
    if not cols:
        return []
    share = df.agg(*[F.avg(finite(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if (share[c] or 0.0) <= most_null]


def stratify(radial: Column, depth: Column | None) -> Column:
    """``id/band`` by depth: [0, 20), [20, 100), from 100 on; null ``unk``, anything else ``deep``."""
    if depth is None:
        return F.concat_ws("/", F.coalesce(radial, F.lit("unk")), F.lit("unk"))
    band = F.when(depth.isNull(), "unk").when((depth >= BANDS[0]) & (depth < BANDS[1]), "0-20").when((depth >= BANDS[1]) & (depth < BANDS[2]), "20-100").otherwise("deep")
    return F.concat_ws("/", F.coalesce(radial, F.lit("unk")), band)


def score_threshold(df: DataFrame, score: str, q: float, strata: list[str] = (), high: bool = True, approximate: bool = False, settled: bool = False) -> DataFrame:
    """``threshold`` (linear-interpolated quantile of the stratum's scores) and ``is_anomaly`` (score at or beyond it).

    The quantile is exact, counted out (see ``quantiles``), and joined back; ``approximate`` takes one pass
    instead of two. ``settled``: the table is no more than read.
    """
    if approximate:
        x = df.select(key_of(list(strata)).alias("_k"), F.col(score).alias("_x"))
        cut = x.groupBy("_k").agg(F.percentile_approx("_x", q, 100_000).cast("double").alias("threshold"))
    else:
        cut = quantiles(df, list(strata), {"threshold": F.col(score)}, q, settled)
    beyond = (lambda s, t: s >= t) if high else (lambda s, t: s <= t)
    out = joined(df.drop("threshold"), list(strata), cut)
    return out.withColumn("is_anomaly", F.coalesce(beyond(F.col(score), F.col("threshold")), F.lit(False)))


def split_outputs(df: DataFrame, flag: str = "is_anomaly", audit: tuple[str, ...] = ("run_id", "source_file", "row_id", "is_anomaly", "anomaly_score", "threshold", "reason", "top_features")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean rows, anomalous rows, audit with one row for each input row)."""
    return df.where(~F.col(flag)), df.where(flag), df.select(*[c for c in audit if c in df.columns])


def explain_topk(df: DataFrame, features: list[str], flag: str = "is_anomaly", strata: list[str] = (), k: int = 5, baseline: str = "stratum") -> DataFrame:
    """``top_features`` of flagged rows: the k features with the largest robust z, |x - median| / MAD (a MAD below 1e-12 counts as 1).

    The baseline is all rows of the stratum, or with ``baseline="anomalies"`` the flagged rows alone. ``df`` runs twice: for the
    baseline's values, which both medians read, and for its rows.
    """
    strata = list(strata)
    base = narrow(df.where(flag) if baseline == "anomalies" else df, strata, {f"_x_{f}": F.col(f) for f in features})
    mid = quantiles_of(base, {f"_m_{f}": F.col(f"_x_{f}") for f in features}, 0.5)
    dev = quantiles_of(base.join(mid, "_k"), {f"_d_{f}": F.abs(F.col(f"_x_{f}") - F.col(f"_m_{f}")) for f in features}, 0.5)
    rows = joined(df.where(flag), strata, mid.join(dev, "_k"))
    mad = lambda f: F.when(F.col(f"_d_{f}") < 1e-12, F.lit(1.0)).otherwise(F.col(f"_d_{f}"))
    each = F.array(*[F.struct((-F.coalesce(F.abs((F.col(f) - F.col(f"_m_{f}")) / mad(f)), F.lit(0.0))).alias("z"), F.lit(f).alias("name")) for f in features])
    out = rows.withColumn("top_features", F.transform(F.slice(F.sort_array(each), 1, k), lambda s: s["name"]))
    return out.drop(*[f"_{x}_{f}" for x in "md" for f in features])


def tree_budget(df: DataFrame, strata: list[str], cap: int = 200, least: int = 48) -> DataFrame:
    """Trees for each stratum: its rows between ``least`` and ``cap``; 32 for none."""
    out = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("n_trees", F.when(F.col("n") == 0, 32).otherwise(F.greatest(F.lit(least), F.least(F.lit(cap), "n"))))


def evaluate(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """True and false positives and negatives, precision, recall and F1; null on zero denominators."""
    agg = df.agg(F.count_if(predicted & truth).alias("tp"), F.count_if(predicted & ~truth).alias("fp"), F.count_if(~predicted & truth).alias("fn"), F.count_if(~predicted & ~truth).alias("tn"))
    agg = agg.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))
    return agg.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def detect(df: DataFrame, features: list[str], strata: list[str], key: list[str], forest: Forest = Forest(), contamination: float = 0.05, budget: bool = False) -> DataFrame:
    """Every row with ``anomaly_score`` (lower is more anomalous), ``threshold``, ``is_anomaly`` and ``reason``.

    The lowest ``contamination`` of each stratum's scores is flagged. Strata below ``forest.least_rows`` rows, and tables with
    fewer than two features, are all clean with score 0. Key, stratum and features are written once, and all steps up to the
    threshold read and write such narrow tables; scores join the rows by their key (see ``forest``).
    """
    if len(features) < 2:
        return df.withColumns({"anomaly_score": F.lit(0.0), "threshold": F.lit(None).cast("double"), "is_anomaly": F.lit(False), "reason": F.lit("insufficient_features")})
    stratum = F.concat_ws("|", *[F.coalesce(F.col(s).cast("string"), F.lit("unk")) for s in strata])
    scores = narrow_scores(narrow_features(df, features, stratum, key), len(features), forest, budget)
    scores = score_threshold(scores.withColumn("anomaly_score", F.lit(0.5) - F.col("iso_score")), "anomaly_score", contamination, ["stratum"], high=False, settled=True)
    out = with_scores(df, scores, key)
    reason = F.when(F.col("iso_score").isNull(), "small_stratum").when(F.col("is_anomaly"), "isolation_forest").otherwise("clean")
    return out.withColumn("reason", reason).withColumn("anomaly_score", F.coalesce("anomaly_score", F.lit(0.0))).drop("iso_score")


def qc_batch(
    df: DataFrame, source: str, features: list[str], strata: list[str], key: list[str], cast: list[str], order: list[str], forest: Forest = Forest(), limits: contract.ProfileLimits = contract.ProfileLimits(), row_id: str | None = None,
    fresh: DataFrame | None = None, earlier: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contract and forest of every source in one job: (scored rows, one row for each source, one row of totals).

    Of a source: ``n_rows, n_violations, n_contract_errors, has_contract_error, n_anomalies, skipped, error``. A source that can't be
    judged (a row without ``row_id``, no feature with a number) is a row with its ``error`` and no scores, and the
    others go on. Trees are budgeted by a stratum's rows. Strata lie within sources.

    Sources that ``fresh`` (``source, is_fresh``, see ``incremental.outputs_fresh``) tells fresh, and of which ``earlier``, the scored
    rows of an earlier run, has rows, are ``skipped``: their rows and anomalies are the earlier ones, and only the contract reads
    their input. A fresh source without earlier rows is done again.
    """
    lacks = F.count_if(F.col(row_id).isNull()) if row_id else F.lit(0)
    numbers = F.count_if(reduce(lambda a, b: a | b, [contract.finite(f).isNotNull() for f in features]))
    per = df.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"), lacks.alias("_lacks"), numbers.alias("_numbers"))
    error = F.when(F.col("_lacks") > 0, F.lit(f"ValueError: rows without {row_id}")).when(F.col("_numbers") == 0, "ValueError: no feature with a number")
    per, again = per.withColumn("error", error).withColumn("_before", F.lit(None).cast("long")), fresh is not None and earlier is not None
    if again:
        done = fresh.where("is_fresh").select(F.col(source).alias("_done")).distinct()
        before = earlier.groupBy(F.col(source).alias("_earlier")).agg(F.count_if("is_anomaly").alias("_before"))
        before = before.join(done, F.col("_earlier").eqNullSafe(F.col("_done")), "left_semi")
        per = per.drop("_before").join(before, per[source].eqNullSafe(F.col("_earlier")), "left")
    skipped = F.col("_before").isNotNull()
    per = written(per.select(source, "n_rows", skipped.alias("skipped"), "_before", F.when(~skipped, F.col("error")).alias("error")), "qc-sources")
    of = lambda rows, which: rows.join(per.where(which).select(F.col(source).alias("_source")), rows[source].eqNullSafe(F.col("_source")), "left_semi")
    counts = contract.contract_counts(contract.profile_contract_by(of(df, "error is null"), [source], cast, order, limits), source)
    rows = detect(of(df, "error is null and not skipped"), features, [source, *strata], key, forest, budget=True)
    rows = written(rows, "qc-rows")
    flagged = rows.groupBy(source).agg(F.count_if("is_anomaly").alias("n_anomalies"))
    at = lambda t, name: t.withColumnRenamed(source, name)
    out = per.join(at(counts, "_c"), per[source].eqNullSafe(F.col("_c")), "left").join(at(flagged, "_f"), per[source].eqNullSafe(F.col("_f")), "left")
    out = out.withColumn("n_anomalies", F.coalesce("_before", "n_anomalies"))
    zero = lambda c: F.when(F.col("error").isNull(), F.coalesce(c, F.lit(0))).alias(c)
    out = out.select(source, "n_rows", zero("n_violations"), zero("n_errors").alias("n_contract_errors"), F.coalesce("has_error", F.lit(False)).alias("has_contract_error"), zero("n_anomalies"), "skipped", "error")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    totals = out.agg(F.count(F.lit(1)).alias("n_sources"), F.count("error").alias("n_failed"), F.count_if("skipped").alias("n_skipped"), total("n_rows"), total("n_contract_errors"), total("n_anomalies"), F.count_if("has_contract_error").alias("n_sources_with_errors"))
    return rows.unionByName(of(earlier, "skipped"), allowMissingColumns=True) if again else rows, out, totals


def detection_metrics(df: DataFrame, n_features: int, strata: list[str], flag: str = "is_anomaly") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n_features).alias("n_features"), F.count_if(flag).alias("n_anomalies"), F.median("threshold").alias("median_threshold"), F.count_distinct(*strata).alias("n_strata"))


def score_stats(df: DataFrame, score: str, flag: str) -> DataFrame:
    """Least, median and greatest score, flagged rows and their share: one row."""
    mid = quantiles(df, [], {"mid": F.col(score)}, 0.5).select("mid")
    stats = df.agg(F.min(score).alias("low"), F.max(score).alias("high"), F.count_if(flag).alias("n_flagged"), F.avg(F.col(flag).cast("int")).alias("rate"))
    return stats.join(mid, how="left").select("low", "mid", "high", "n_flagged", "rate")


def anomalies_by_station(df: DataFrame, by: list[str], flag: str = "is_anomaly") -> DataFrame:
    return df.where(flag).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
