"""Queries of anomaly detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.operators import anomaly as A
from sondage.operators import canonical as N
from sondage.operators import contract
from sondage.operators import forest as T
from sondage.operators import incremental as J
from sondage.operators.quantiles import joined, quantiles

from .registry import PROFILES_SQL, SEQ, profiles, query, rounded

#: Profiles by shipping year: segments and neighbours stay within a source.
SOURCES_SQL = PROFILES_SQL + """, src AS (SELECT *, CAST(year(fecha) AS VARCHAR) AS source_file FROM profiles),
 fell AS (SELECT *, CASE WHEN profundidad_m - lag(profundidad_m) OVER (PARTITION BY source_file, cast_key ORDER BY l_linenumber, l_partkey, l_suppkey) < -1.5 THEN 1 ELSE 0 END AS fell FROM src),
 seg AS (SELECT *, sum(fell) OVER (PARTITION BY source_file, cast_key ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS segment FROM fell),
 d AS (SELECT source_file, cast_key, segment, profundidad_m - lag(profundidad_m) OVER w AS dz, abs(temperatura_c - lag(temperatura_c) OVER w) AS dv FROM seg WINDOW w AS (PARTITION BY source_file, cast_key, segment ORDER BY l_linenumber, l_partkey, l_suppkey)),
 f AS (SELECT *, coalesce((dz BETWEEN 2.5 AND 5 AND dv >= 23) OR (dz > 5 AND dz <= 15 AND dv >= 24), false) AS e, coalesce((dz BETWEEN 2.5 AND 5 AND dv >= 8) OR (dz > 5 AND dz <= 15 AND dv >= 10), false) AS w FROM d),
 s AS (SELECT source_file, cast_key, segment, bool_or(e) AS e, bool_or(w) AND NOT bool_or(e) AS w, coalesce(max(dv) FILTER (e), max(dv) FILTER (w)) AS worst FROM f GROUP BY ALL),
 g AS (SELECT source_file, count(*) FILTER (e) AS ne, count(*) FILTER (w) AS nw, max(worst) FILTER (e) AS we, max(worst) FILTER (w) AS ww FROM s GROUP BY ALL)"""
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BAND_SQL = "CASE WHEN l_quantity IS NULL THEN 'unk' WHEN l_quantity >= 0 AND l_quantity < 20 THEN '0-20' WHEN l_quantity >= 20 AND l_quantity < 100 THEN '20-100' ELSE 'deep' END"
SCORED_SQL = f"""m AS (SELECT l_returnflag, median(l_extendedprice) AS mid FROM lineitem GROUP BY ALL),
 s AS (SELECT l.*, abs(l.l_extendedprice - mid) AS score, l.l_returnflag || '/' || {BAND_SQL} AS stratum FROM lineitem l JOIN m USING (l_returnflag)),
 q AS (SELECT stratum, quantile_cont(score, 0.95) AS threshold FROM s GROUP BY ALL),
 f AS (SELECT s.*, threshold, score >= threshold AS is_anomaly FROM s JOIN q USING (stratum))"""


def stratified(read):
    return read("lineitem").withColumn("stratum", A.stratify(F.col("l_returnflag"), F.col("l_quantity")))


def flagged(read):
    """A score that SQL can follow: distance from the flag's median price."""
    df = stratified(read)
    mid = quantiles(df, ["l_returnflag"], {"mid": F.col("l_extendedprice")}, 0.5, settled=True)
    return A.score_threshold(joined(df, ["l_returnflag"], mid).withColumn("score", F.abs(F.col("l_extendedprice") - F.col("mid"))).drop("mid"), "score", 0.95, ["stratum"])


#: Numeric columns that are no ids; two of them have gaps, of more and of less than the share that is too much.
OFFERED = {"l_linenumber": "l_linenumber", "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax", "often_null": "CASE WHEN l_discount >= 0.05 THEN l_discount END", "seldom_null": "CASE WHEN l_tax >= 0.03 THEN l_tax END"}
SHARES_SQL = " UNION ALL ".join(f"SELECT '{name}' AS feature, avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END) AS share FROM lineitem" for name, e in OFFERED.items())


@query("g1_select_features", f"SELECT feature FROM ({SHARES_SQL}) WHERE share <= 0.4")
def _(read):
    df = read("lineitem").withColumns({name: F.expr(e) for name, e in OFFERED.items()})
    ids = (*A.IDS, "l_orderkey", "l_partkey", "l_suppkey")
    return df.sparkSession.createDataFrame([(f,) for f in A.select_features(df, ids)], "feature string")


@query("g2_stratify", f"SELECT l_returnflag || '/' || {BAND_SQL} AS stratum, count(*) AS n FROM lineitem GROUP BY ALL")
def _(read):
    return stratified(read).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


@query("g3_isolation_forest")
def _(read):
    df = A.detect(stratified(read), FEATURES, ["stratum"], KEY, T.Forest(trees=100))
    return rounded(df.select(*KEY, "stratum", "anomaly_score", "threshold", "is_anomaly", "reason"))


@query("g4_extended_isolation_forest")
def _(read):
    df = read("lineitem").select(*KEY, *FEATURES).withColumn("stratum", F.lit("all"))
    out = T.isolation_scores(df, FEATURES, "stratum", KEY, T.Forest(trees=100, ndim=2, max_depth=8))
    return rounded(A.score_threshold(out, "iso_score", 0.95).drop("stratum", *FEATURES))


@query("g5_score_threshold", f"WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(score, 6) AS score, round(threshold, 6) AS threshold, is_anomaly FROM f")
def _(read):
    return rounded(flagged(read).select(*KEY, "score", "threshold", "is_anomaly"))


@query("g6_split_outputs", f"WITH {SCORED_SQL} SELECT 'clean' AS part, count(*) AS n FROM f WHERE NOT is_anomaly UNION ALL SELECT 'anomalies', count(*) FROM f WHERE is_anomaly UNION ALL SELECT 'audit', count(*) FROM f")
def _(read):
    clean, bad, audit = A.split_outputs(flagged(read))
    n = lambda df, tag: df.agg(F.lit(tag).alias("part"), F.count(F.lit(1)).alias("n"))
    return n(clean, "clean").unionByName(n(bad, "anomalies")).unionByName(n(audit, "audit"))


MEDIANS = ", ".join(f"median({c}) AS m_{c}" for c in FEATURES)
MADS = ", ".join(f"median(abs(f.{c} - m_{c})) AS d_{c}" for c in FEATURES)
ZS = " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{c}' AS name, abs((f.{c} - m_{c}) / CASE WHEN d_{c} < 1e-12 THEN 1 ELSE d_{c} END) AS z FROM f JOIN mid USING (stratum) JOIN dev USING (stratum) WHERE is_anomaly" for c in FEATURES)


@query("g7_explain_topk", f"""WITH {SCORED_SQL}, mid AS (SELECT stratum, {MEDIANS} FROM f GROUP BY ALL), dev AS (SELECT stratum, {MADS} FROM f JOIN mid USING (stratum) GROUP BY ALL), z AS ({ZS}),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey ORDER BY z DESC, name) AS rn FROM z)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, string_agg(name, ',' ORDER BY rn) AS top_features FROM r WHERE rn <= 3 GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey""")
def _(read):
    out = A.explain_topk(flagged(read), FEATURES, strata=["stratum"], k=3)
    return out.select(*KEY, F.array_join("top_features", ",").alias("top_features"))


@query("g8_insufficient_features", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(0 AS DOUBLE) AS anomaly_score, false AS is_anomaly, 'insufficient_features' AS reason FROM lineitem")
def _(read):
    return A.detect(read("lineitem"), ["l_quantity"], ["l_returnflag"], KEY).select(*KEY, "anomaly_score", "is_anomaly", "reason")


@query("g9_evaluate", """WITH j AS (SELECT toxic = 1 AS t, n_chars FROM labels JOIN documents USING (doc_id)), q AS (SELECT quantile_cont(n_chars, 0.95) AS q FROM j),
 c AS (SELECT count(*) FILTER (p AND t) AS tp, count(*) FILTER (p AND NOT t) AS fp, count(*) FILTER (NOT p AND t) AS fn, count(*) FILTER (NOT p AND NOT t) AS tn FROM (SELECT t, n_chars >= q AS p FROM j, q))
 SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6) AS f1 FROM c""")
def _(read):
    df = A.score_threshold(read("labels").join(read("documents"), "doc_id"), "n_chars", 0.95)
    return rounded(A.evaluate(df, F.col("toxic") == 1, F.col("is_anomaly")))


@query("g10_tree_budget", "SELECT l_returnflag, l_linenumber, count(*) AS n, greatest(48, least(200, count(*))) AS n_trees FROM lineitem GROUP BY ALL")
def _(read):
    return A.tree_budget(read("lineitem"), ["l_returnflag", "l_linenumber"])


def yearly_sources(read):
    """Order lines as profile rows; a source is a shipping year."""
    p = profiles(read).withColumn("source_file", F.year("fecha").cast("string"))
    return p.withColumn("stratum", A.stratify(F.lit("all"), F.col("profundidad_m")))


@query("g11_qc_batch")
def _(read):
    """Contract and forest of every source in one job."""
    df = yearly_sources(read)
    return A.qc_batch(df, "source_file", ["profundidad_m", "temperatura_c"], ["stratum"], ["cast_key", *SEQ], ["cast_key"], SEQ, T.Forest(trees=64))[1]


@query("g11_contract_by_source", """WITH """ + SOURCES_SQL + """ SELECT source_file, 'error' AS severity, 'temp_out_of_absolute_range' AS code, count(*) AS n_rows, round(CASE WHEN max(temperatura_c) > 32 THEN max(temperatura_c) ELSE min(temperatura_c) END, 6) AS worst FROM src WHERE temperatura_c < -2 OR temperatura_c > 32 GROUP BY ALL
 UNION ALL SELECT source_file, CASE WHEN ne > 0 THEN 'error' ELSE 'warning' END, CASE WHEN ne > 0 THEN 'temp_large_vertical_jump' ELSE 'temp_moderate_vertical_jump' END, CASE WHEN ne > 0 THEN ne ELSE nw END, round(CASE WHEN ne > 0 THEN we ELSE ww END, 6) FROM g WHERE ne > 0 OR nw > 0
 UNION ALL SELECT source_file, 'error', 'sampling_date_out_of_calendar_range', count(*), CAST(max(year(fecha)) AS DOUBLE) FROM src WHERE year(fecha) > 1996 GROUP BY ALL""")
def _(read):
    out = contract.profile_contract_by(yearly_sources(read), ["source_file"], ["cast_key"], SEQ, contract.ProfileLimits(years=(1970, 1996)))
    return rounded(out.select("source_file", "severity", "code", "n_rows", "worst"))


@query("g11_reuse_fresh", """WITH """ + SOURCES_SQL + """, dated AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS source_file, l_returnflag, max(struct_pack(p := l_extendedprice, d := l_shipdate)).d AS d, max(l_extendedprice) AS p FROM lineitem GROUP BY ALL),
 fresh AS (SELECT source_file FROM dated GROUP BY ALL HAVING count(*) >= 3 AND min(d) >= max(struct_pack(p := p, d := d)).d),
 errors AS (SELECT source_file, CAST(bool_or(temperatura_c < -2 OR temperatura_c > 32) AS INTEGER) + CAST(bool_or(year(fecha) > 1996) AS INTEGER) AS n FROM src GROUP BY ALL),
 jumps AS (SELECT source_file, sum(CAST(ne > 0 AS INTEGER)) AS n FROM g GROUP BY ALL)
 SELECT source_file, count(*) AS n_rows, any_value(source_file IN (SELECT source_file FROM fresh)) AS skipped, CAST(any_value(coalesce(errors.n, 0) + coalesce(jumps.n, 0)) AS BIGINT) AS n_contract_errors,
  CASE WHEN any_value(source_file IN (SELECT source_file FROM fresh)) THEN count(*) FILTER (temperatura_c >= 30) END AS earlier_anomalies
 FROM src LEFT JOIN errors USING (source_file) LEFT JOIN jumps USING (source_file) GROUP BY source_file""")
def _(read):
    """A second batch: a source is fresh where the day of each flag's dearest line isn't before that of the dearest of all."""
    df = yearly_sources(read)
    day = read("lineitem").select(F.year("l_shipdate").cast("string").alias("source_file"), "l_returnflag", F.struct(F.col("l_extendedprice").alias("p"), F.col("l_shipdate").alias("mtime")).alias("top"))
    outputs = day.groupBy("source_file", "l_returnflag").agg(F.max("top").alias("top")).select("source_file", "top", "top.mtime")
    fresh = J.outputs_fresh(outputs.groupBy("source_file").agg(F.max("top")["mtime"].alias("mtime")), outputs, "source_file", 3)
    earlier = df.withColumn("is_anomaly", F.col("temperatura_c") >= 30)
    limits = contract.ProfileLimits(years=(1970, 1996))
    per = A.qc_batch(df, "source_file", ["profundidad_m", "temperatura_c"], ["stratum"], ["cast_key", *SEQ], ["cast_key"], SEQ, T.Forest(trees=64), limits, fresh=fresh, earlier=earlier)[1]
    return per.select("source_file", "n_rows", "skipped", "n_contract_errors", F.when(F.col("skipped"), F.col("n_anomalies")).alias("earlier_anomalies"))


@query("g12_detection_metrics", f"WITH {SCORED_SQL} SELECT count(*) AS n_rows, 4 AS n_features, count(*) FILTER (is_anomaly) AS n_anomalies, round(median(threshold), 6) AS median_threshold, count(DISTINCT stratum) AS n_strata FROM f")
def _(read):
    return rounded(A.detection_metrics(flagged(read), len(FEATURES), ["stratum"]))


@query("g13_score_stats", f"WITH {SCORED_SQL} SELECT round(min(score), 6) AS low, round(median(score), 6) AS mid, round(max(score), 6) AS high, count(*) FILTER (is_anomaly) AS n_flagged, round(avg(CAST(is_anomaly AS INTEGER)), 6) AS rate FROM f")
def _(read):
    return rounded(A.score_stats(flagged(read), "score", "is_anomaly"))


@query("g14_anomalies_by_station", f"WITH {SCORED_SQL} SELECT l_returnflag, l_suppkey % 8 + 1 AS estacion, count(*) AS n FROM f WHERE is_anomaly GROUP BY ALL")
def _(read):
    return A.anomalies_by_station(flagged(read).withColumn("estacion", F.col("l_suppkey") % 8 + 1), ["l_returnflag", "estacion"])


@query("d10_impute_median", """WITH n AS (SELECT *, CASE WHEN l_discount >= 0.05 THEN l_discount END AS d FROM lineitem), m AS (SELECT l_returnflag, median(d) AS m FROM n GROUP BY ALL)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(d, m, 0), 6) AS d FROM n JOIN m USING (l_returnflag)""")
def _(read):
    df = read("lineitem").withColumn("d", F.when(F.col("l_discount") >= 0.05, F.col("l_discount")))
    return rounded(N.impute_median(df, ["d"], ["l_returnflag"]).select(*KEY, "d"))
