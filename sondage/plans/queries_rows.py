"""Queries of canonicalisation, gate, preflight and audit operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.operators import audit as U
from sondage.operators import canonical as N
from sondage.operators import gate as G

from .queries_scores import SCORED_SQL, flagged
from .queries_text import DETAILED_SQL, detailed
from .registry import query, rounded

K3 = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("d1_resolve_alias", "SELECT 'depSM' AS depth, 'T068' AS temperature, 'SAL' AS salinity, CAST(NULL AS VARCHAR) AS date, count(*) AS n, round(sum(l_quantity), 4) AS depths, round(sum(l_tax), 4) AS temperatures, round(sum(l_discount), 4) AS salinities FROM lineitem")
def _(read):
    """Two candidates of each kind, and a time in seconds, which is no date."""
    q = lambda c: F.col(c)
    df = read("lineitem").select(q("l_linenumber").alias("prDM"), q("l_quantity").alias("depSM"), q("l_linenumber").alias("T068C"), q("l_tax").alias("T068"), q("l_linenumber").alias("SAL00"), q("l_discount").alias("SAL"), q("l_linenumber").alias("time"))
    found = {k: N.resolve_alias(df.columns, a) for k, a in (("depth", N.DEPTH), ("temperature", N.TEMPERATURE), ("salinity", N.SALINITY), ("date", N.DATE))}
    sums = [F.round(F.sum(found[k]), 4).alias(n) for k, n in (("depth", "depths"), ("temperature", "temperatures"), ("salinity", "salinities"))]
    return df.agg(*[F.lit(v).cast("string").alias(k) for k, v in found.items()], F.count(F.lit(1)).alias("n"), *sums)


def raw(read):
    """Order lines under a file's own names; a tenth of the temperatures is no number."""
    return read("lineitem").select(
        F.col("l_orderkey").cast("string").alias("CAST"), F.when(F.col("l_linenumber") == 7, "bad").otherwise((F.col("l_extendedprice") / 3000).cast("string")).alias("T090C"), F.col("l_quantity").alias("DepSM"), F.col("l_shipdate").alias("Date"), "l_linenumber", "l_partkey", "l_suppkey"
    )


RAW_SQL = "raw AS (SELECT l_quantity AS profundidad_m, CASE WHEN l_linenumber <> 7 THEN l_extendedprice / 3000 END AS temperatura_c, CAST(NULL AS DOUBLE) AS salinidad_psu, l_shipdate AS fecha, CAST(NULL AS VARCHAR) AS estacion, CAST(l_orderkey AS VARCHAR) AS \"cast\", l_linenumber, l_partkey, l_suppkey FROM lineitem)"


@query("d2_canonicalize", f"WITH {RAW_SQL} SELECT profundidad_m, round(temperatura_c, 6) AS temperatura_c, salinidad_psu, fecha, estacion, \"cast\", l_linenumber, l_partkey, l_suppkey FROM raw WHERE temperatura_c IS NOT NULL AND profundidad_m IS NOT NULL AND year(fecha) BETWEEN 1996 AND 1999")
def _(read):
    return rounded(N.canonicalize(raw(read), (1996, 1999)))


@query("d2_candidates", "SELECT l_quantity AS profundidad_m, l_tax AS temperatura_c, l_discount AS salinidad_psu, CAST(NULL AS TIMESTAMP) AS fecha, CAST(NULL AS VARCHAR) AS estacion, CAST(l_orderkey AS VARCHAR) AS \"cast\", l_linenumber AS t068c, l_linenumber AS sal00, l_linenumber AS time, 'x' AS acronimo FROM lineitem")
def _(read):
    """A file with two candidates of a kind, a time in seconds and an acronym: the first candidates count, the others are kept."""
    n, q = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    df = read("lineitem").select(n.alias("t068c"), F.col("l_tax").alias("t068"), F.col("l_quantity").alias("prsm"), n.alias("sal00"), F.col("l_discount").alias("sal"), n.alias("time"), F.lit("x").alias("acronimo"), q.alias("cast"))
    return N.canonicalize(df)


@query("d3_filter_year_window", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def _(read):
    return N.filter_year_window(read("orders"), "o_orderdate", 1996, 1998, strict=True).select("o_orderkey", "o_orderdate")


@query("d4_coerce", f"WITH {RAW_SQL} SELECT l_linenumber, count(*) AS n, round(sum(temperatura_c), 4) AS total FROM raw WHERE temperatura_c IS NOT NULL GROUP BY ALL")
def _(read):
    df = N.coerce(raw(read), ["T090C"], ["Date"], ["T090C"])
    return df.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("T090C"), 4).alias("total"))


@query("d5_tag_lineage", "SELECT 'run-1' AS run_id, 'order-' || CAST(o_orderkey AS VARCHAR) AS source_file, o_custkey FROM orders")
def _(read):
    return N.tag_lineage(read("orders"), "run-1", F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))).select("run_id", "source_file", "o_custkey")


@query("d6_row_id", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS row_id FROM lineitem")
def _(read):
    return N.row_id(read("lineitem"), ["l_orderkey"], K3[1:]).select(*K3, "row_id")


@query("d7_synthesize_date", "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate WHEN o_orderkey % 3 = 1 THEN make_date(year(o_orderdate), month(o_orderdate), 15) ELSE make_date(year(o_orderdate), 6, 15) END AS TIMESTAMP) AS fecha FROM orders")
def _(read):
    k = F.col("o_orderkey") % 3
    df = read("orders").select("o_orderkey", F.when(k == 0, F.col("o_orderdate")).alias("d"), F.year("o_orderdate").alias("y"), F.when(k == 1, F.month("o_orderdate")).alias("m"))
    return N.synthesize_date(df, "d", "y", "m").select("o_orderkey", "fecha")


@query("d8_cast_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN 'c' || CAST(l_orderkey AS VARCHAR) ELSE l_returnflag || '_' || CAST(l_linenumber AS VARCHAR) END AS cast_key FROM lineitem")
def _(read):
    df = read("lineitem").withColumn("cast", F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("c"), F.col("l_orderkey").cast("string"))))
    return N.cast_key(df, source="l_returnflag", row="l_linenumber").select(*K3, "cast_key")


@query("d9_require_columns", "SELECT o_orderkey, o_custkey FROM orders")
def _(read):
    return N.require_columns(read("orders"), ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@query("d11_limit_sources", "SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 20")
def _(read):
    return N.limit_sources(read("pages").select("page_id", "url"), 20, "url")


@query("d12_filter_station", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey % 8 + 1 = 3")
def _(read):
    return N.filter_station(read("lineitem").withColumn("station", F.col("l_suppkey") % 8 + 1), 3).select(*K3)


#: A file for every order: its names, start time and length come from the order.
FILES_SQL = f"""{DETAILED_SQL}, files AS (SELECT o_orderkey AS path_no, 'raw/' || CASE WHEN o_custkey % 3 = 0 THEN '1994' ELSE 'f' || CAST(o_custkey % 5 AS VARCHAR) END || '/' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 11 = 0 THEN '.txt' ELSE '.cnv' END AS path,
  CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 100 END AS length, o_orderkey % 4 AS kind, o_orderkey % 2 = 0 AS has_start_time, o_custkey FROM orders),
 gated AS (SELECT *, CASE WHEN o.path_no % 11 = 0 AND length = 0 THEN 'bad_extension,empty_file' WHEN o.path_no % 11 = 0 THEN 'bad_extension' WHEN length = 0 THEN 'empty_file' WHEN kind = 0 THEN 'no_columns'
   WHEN kind = 1 THEN CASE WHEN has_start_time THEN '' ELSE 'no_time' END WHEN kind = 2 THEN 'no_temperature' || CASE WHEN has_start_time THEN '' ELSE ',no_time' END
   ELSE CASE WHEN o.path_no % 3 = 2 THEN 'no_temperature_auxiliary_profile,no_depth' ELSE 'no_temperature,no_depth' END || CASE WHEN has_start_time THEN '' ELSE ',no_time' END END AS reasons FROM files o)"""


def files(read):
    k = F.col("o_orderkey")
    folder = F.when(F.col("o_custkey") % 3 == 0, "1994").otherwise(F.concat(F.lit("f"), (F.col("o_custkey") % 5).cast("string")))
    path = F.concat(F.lit("raw/"), folder, F.lit("/"), k.cast("string"), F.when(k % 11 == 0, ".txt").otherwise(".cnv"))
    none = F.lit(None).cast("array<string>")
    names = F.when(k % 4 == 0, none).when(k % 4 == 1, F.array(F.lit("t090c"), F.lit("pr"))).when(k % 4 == 2, F.array(F.lit("sal00"), F.lit("depsm"))).when(k % 3 == 0, F.array(F.lit("par"), F.lit("c0s/m"))).when(k % 3 == 1, F.array(F.lit("v0"))).otherwise(F.array(F.lit("par")))
    df = read("orders").select(k.alias("path_no"), path.alias("path"), folder.alias("folder"), F.when(k % 13 == 0, 0).otherwise(100).alias("length"), names.alias("names"), (k % 2 == 0).alias("has_start_time"), "o_custkey")
    return G.gate(df)


@query("e1_gate", f"WITH {FILES_SQL} SELECT path, reasons, reasons = '' AS accepted FROM gated")
def _(read):
    return files(read).select("path", F.array_join("reasons", ",").alias("reasons"), "accepted")


def classified(read):
    c = detailed(read).select(F.col("k").alias("o_custkey"), "radial_id", "conflict")
    return files(read).join(c, "o_custkey")


PREFLIGHT_SQL = f"""WITH {FILES_SQL}, j AS (SELECT g.*, split_part(g.path, '/', 2) AS folder, e.radial_id, e.conflict FROM gated g JOIN e ON g.o_custkey = e.k),
 f AS (SELECT folder, count(*) AS n_files, count(*) FILTER (reasons = '') AS n_ok, count(*) FILTER (reasons <> '') AS n_rejected, count(DISTINCT radial_id) AS n_ids, count(*) FILTER (radial_id IS NULL) AS n_unknown, count(*) FILTER (conflict) AS n_conflicts, count(*) FILTER (NOT has_start_time) AS n_no_start_time FROM j GROUP BY ALL)"""


@query("e2_preflight_by_folder", PREFLIGHT_SQL + """, x AS (SELECT folder, unnest(string_split(reasons, ',')) AS r FROM j WHERE reasons <> ''), y AS (SELECT folder, r, count(*) AS n FROM x GROUP BY ALL), z AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY n DESC, r) AS rn FROM y)
 SELECT f.*, (SELECT string_agg(r || ':' || CAST(n AS VARCHAR), ';' ORDER BY rn) FROM z WHERE z.folder = f.folder AND rn <= 12) AS top_reasons FROM f""")
def _(read):
    out = G.preflight_by_folder(classified(read))
    return out.withColumn("top_reasons", F.array_join("top_reasons", ";"))


@query("e3_preflight_findings", PREFLIGHT_SQL + """ SELECT folder, unnest(list_filter([CASE WHEN n_ids > 1 THEN 'mixed_ids' END, CASE WHEN n_unknown > 0 THEN 'unknown_ids' END, CASE WHEN n_conflicts > 0 THEN 'conflicts' END,
  CASE WHEN n_rejected > 0 AND n_ok = 0 THEN 'all_rejected' END, CASE WHEN n_ok > 0 AND n_rejected > greatest(3, n_files // 5) THEN 'many_rejected' END], lambda x: x IS NOT NULL)) AS finding FROM f""")
def _(read):
    return G.preflight_findings(G.preflight_by_folder(classified(read)))


@query("e4_dubious_rows", PREFLIGHT_SQL + " SELECT path, reasons || CASE WHEN conflict THEN CASE WHEN reasons = '' THEN 'conflict' ELSE ',conflict' END ELSE '' END AS issues FROM j WHERE reasons <> '' OR conflict ORDER BY path LIMIT 400")
def _(read):
    return G.dubious_rows(classified(read)).select("path", F.array_join("issues", ",").alias("issues"))


@query("e5_shard_counts", f"WITH {FILES_SQL} SELECT split_part(path, '/', 2) AS segment, count(*) AS n FROM files WHERE split_part(path, '/', 2) <> '1994' GROUP BY ALL")
def _(read):
    return G.shard_counts(files(read).withColumnRenamed("folder", "segment"))


@query("i1_inventory", f"WITH {DETAILED_SQL} SELECT coalesce(radial_id, 'desconocida') AS radial_id, count(*) AS n FROM e GROUP BY ALL UNION ALL SELECT 'total', count(*) FROM e")
def _(read):
    return U.inventory(detailed(read))


@query("i2_top_reasons", f"WITH {FILES_SQL}, x AS (SELECT unnest(string_split(reasons, ',')) AS reason FROM gated WHERE reasons <> '') SELECT reason, count(*) AS n FROM x GROUP BY ALL ORDER BY n DESC, reason LIMIT 8")
def _(read):
    return U.top_reasons(files(read), "reasons", 8)


@query("i3_funnel", f"WITH {FILES_SQL}, a AS (SELECT count(*) AS n0, count(*) FILTER (path LIKE '%.cnv') AS n1, count(*) FILTER (path LIKE '%.cnv' AND reasons = '') AS n2, count(*) FILTER (path LIKE '%.cnv' AND reasons = '' AND path LIKE 'raw/1994/%') AS n3 FROM gated) SELECT unnest([0, 1, 2, 3]) AS stage_no, unnest(['inventory', 'profiles', 'gate', 'scope']) AS stage, unnest([n0, n1, n2, n3]) AS remaining, unnest([0, n0 - n1, n1 - n2, n2 - n3]) AS removed FROM a")
def _(read):
    return U.funnel(files(read), [("inventory", F.lit(True)), ("profiles", F.endswith(F.col("path"), F.lit(".cnv"))), ("gate", F.col("accepted")), ("scope", F.col("folder") == "1994")])


@query("i4_station_clean_vs_anomaly", f"WITH {SCORED_SQL} SELECT l_suppkey % 8 + 1 AS estacion, count(*) FILTER (NOT is_anomaly) AS clean, count(*) FILTER (is_anomaly) AS anomalous FROM f GROUP BY ALL ORDER BY count(*) DESC, estacion LIMIT 8")
def _(read):
    return U.station_clean_vs_anomaly(flagged(read).withColumn("estacion", F.col("l_suppkey") % 8 + 1), "estacion", "is_anomaly")


@query("i5_anomaly_ratio", f"WITH {SCORED_SQL} SELECT count(*) FILTER (NOT is_anomaly) AS clean, count(*) FILTER (is_anomaly) AS anomalous, round(count(*) FILTER (is_anomaly) / count(*), 6) AS ratio FROM f")
def _(read):
    return rounded(U.anomaly_ratio(flagged(read), "is_anomaly"))


@query("i6_run_duration", "SELECT o_custkey, round(epoch_us(max(o_orderdate)) / 1e6 - epoch_us(min(o_orderdate)) / 1e6, 3) AS seconds FROM orders GROUP BY ALL")
def _(read):
    return U.run_duration(read("orders"), "o_custkey", "o_orderdate", "o_orderdate").withColumn("seconds", F.round("seconds", 3))


@query("i7_geo_index", f"""WITH {DETAILED_SQL}, x AS (SELECT radial_id, k % 5 AS station, lat, lon FROM e JOIN p USING (k) WHERE radial_id IS NOT NULL)
 SELECT radial_id, station, CAST(grouping(station) AS INTEGER) AS of_class, round(median(lat), 6) AS lat, round(median(lon), 6) AS lon, count(*) AS n FROM x GROUP BY GROUPING SETS ((radial_id), (radial_id, station))""")
def _(read):
    from .queries_text import positions

    df = detailed(read).join(positions(read), "k").withColumn("station", F.col("k") % 5)
    return rounded(U.geo_index(df, "radial_id", "station", "lat", "lon"))


NULLS_SQL = "n AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS value, CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type FROM events)"


def with_nulls(read):
    k = F.col("event_id")
    return read("events").select("event_id", F.when(k % 4 != 0, F.col("value")).alias("value"), F.when(k % 10 != 0, F.col("event_type")).alias("event_type"))


PROFILE_SQL = f"{NULLS_SQL}, p AS (SELECT 'event_id' AS \"column\", 'bigint' AS type, count(*) - count(event_id) AS nulls, count(*) AS n FROM n UNION ALL SELECT 'value', 'double', count(*) - count(value), count(*) FROM n UNION ALL SELECT 'event_type', 'string', count(*) - count(event_type), count(*) FROM n)"


@query("i8_profile_columns", f"WITH {PROFILE_SQL} SELECT \"column\", type, nulls, round(100.0 * nulls / n, 6) AS pct_null FROM p")
def _(read):
    return rounded(U.profile_columns(with_nulls(read)))


@query("i8_table_completeness", f"WITH {PROFILE_SQL} SELECT sum(n)::BIGINT AS cells, sum(nulls)::BIGINT AS nulls, count(*) FILTER (nulls > 0) AS columns_with_nulls, round(100.0 * (sum(n) - sum(nulls)) / sum(n), 6) AS pct_complete FROM p")
def _(read):
    df = with_nulls(read)
    return rounded(U.table_completeness(U.profile_columns(df), df.count()))


@query("i9_columns_without_description", f"WITH {PROFILE_SQL} SELECT \"column\" FROM p WHERE lower(\"column\") NOT IN (SELECT DISTINCT CASE WHEN event_type IS NULL THEN 'value' ELSE 'event_id' END FROM n)")
def _(read):
    df = with_nulls(read)
    glossary = df.select(F.upper(F.when(F.col("event_type").isNull(), " value ").otherwise("event_id")).alias("column"), F.lit("text").alias("description")).distinct()
    return U.columns_without_description(U.profile_columns(df).select("column"), glossary)


@query("i10_dataset_metrics", "SELECT count(*) AS n_rows, 5 AS n_cols, 'doc_id,text,lang,source,n_chars' AS columns FROM documents")
def _(read):
    return U.dataset_metrics(read("documents"))


@query("i11_step_totals", "SELECT count(*) AS n_steps, count(*) FILTER (o_orderstatus = 'F') AS n_ok, count(*) FILTER (o_orderstatus <> 'F') AS n_errors, CAST(sum(o_custkey % 3) AS BIGINT) AS n_quarantined FROM orders")
def _(read):
    return U.step_totals(read("orders").withColumn("q", F.col("o_custkey") % 3), "o_orderstatus", "F", "q")


@query("i14_ingest_failures", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderdate, o_orderkey LIMIT 25")
def _(read):
    return U.ingest_failures(read("orders").where("o_orderstatus <> 'F'"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderpriority")


@query("g12_health_summary", f"WITH {PROFILE_SQL} SELECT \"column\", round(nulls / n, 6) AS fraction FROM p ORDER BY fraction DESC, \"column\" LIMIT 10")
def _(read):
    return rounded(U.null_fractions(with_nulls(read)))
