"""Queries of sources, run logs and incremental processing. Text profiles, CSV and parts are rendered from the driver's
tables by Spark, in the shared folder where the session names one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.operators import incremental as J
from sondage.operators.profiles import load_class_profiles
from sondage.scratch import new_folder
from sondage.sources import files as A

from .registry import query, rounded


def folder(df: DataFrame) -> str:
    """A new folder under the cluster's shared one."""
    return new_folder(df.sparkSession, "files")


#: Every order is a profile in text: its lines are samples, and lines with number 7 are damaged.
TEXT_COLUMNS = ["prsm", "t090c", "sal00"]


def rendered(read) -> DataFrame:
    line = F.concat_ws("  ", F.col("l_quantity").cast("string"), F.when(F.col("l_linenumber") == 7, "oops").otherwise(F.col("l_tax").cast("string")), F.col("l_discount").cast("string"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("t")))), lambda s: s["t"]), "\n")
    text = F.concat(F.lit("* header\n# name 0 = prSM: Pressure\n# name 1 = t090C: T\n# name 2 = sal00: S\n*END*\n"), body)
    return read("lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(text.alias("content"))


@query("a1_read_profiles_text", "SELECT l_orderkey AS path, count(*) AS n, round(sum(l_quantity), 4) AS prsm, round(sum(l_tax), 4) AS t090c, round(sum(l_discount), 4) AS sal00 FROM lineitem WHERE l_linenumber <> 7 GROUP BY ALL")
def _(read):
    rows, _ = A.parse_profiles(rendered(read), F.col("content"))
    wide = A.widened(rows, TEXT_COLUMNS)
    return wide.groupBy("path").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 4).alias(c) for c in TEXT_COLUMNS])


@query("a1_ingest_errors", "SELECT l_orderkey AS path, 'no_valid_rows' AS error FROM lineitem GROUP BY ALL HAVING bool_and(l_linenumber = 7)")
def _(read):
    return A.parse_profiles(rendered(read), F.col("content"))[1]


@query("a2_list_sources", "SELECT o_orderstatus AS status, 1 AS n_files, true AS have_bytes, 0 AS others FROM orders GROUP BY ALL")
def _(read):
    """One file for each status, beside others of another suffix."""
    df = read("orders").select(F.col("o_orderkey"), "o_orderstatus")
    at = folder(df)
    df.select("o_orderstatus").distinct().coalesce(1).write.text(f"{at}/notes")
    df.repartition("o_orderstatus").write.mode("append").partitionBy("o_orderstatus").parquet(at)
    return A.list_sources(df.sparkSession, at, "*.parquet").groupBy(F.regexp_extract("path", r"o_orderstatus=(\w+)", 1).alias("status")).agg(F.count(F.lit(1)).alias("n_files"), (F.min("length") > 0).alias("have_bytes"), F.count_if(~F.col("path").endswith(".parquet")).alias("others"))


@query("a3_read_csv_resilient", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey, 'semicolon' AS strategy FROM customer")
def _(read):
    df = read("customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") == 3, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"))
    at = folder(df)
    df.write.option("header", True).option("sep", ";").csv(at)
    out, strategy = A.read_csv_resilient(df.sparkSession, at)
    return out.withColumn("strategy", F.lit(strategy))


def odd_lines(read) -> str:
    """Customers as comma-separated lines, many of them odd: names with separators and line ends in quotes, stray quotes, short lines
    and lines with a field too many."""
    k, n, nation = F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey").cast("string")
    name = F.when(k % 5 == 0, F.concat(F.lit('"'), n, F.lit(', "" inc"'))).when(k % 7 == 0, F.concat(F.lit('"'), n, F.lit('\nsecond"'))).when(k % 3 == 0, F.concat(n, F.lit('" wide'))).otherwise(n)
    line = F.when(k % 11 == 0, F.concat_ws(",", k, name)).when(k % 13 == 0, F.concat_ws(",", k, name, nation, F.lit("more"))).otherwise(F.concat_ws(",", k, name, nation))
    df = read("customer")
    at = folder(df)
    rows = df.select(F.lit(1).alias("o"), k.alias("k"), line.alias("value"))
    head = df.sparkSession.range(1).select(F.lit(0).alias("o"), F.lit(0).cast("long").alias("k"), F.lit("c_custkey,c_name,c_nationkey").alias("value"))
    head.unionByName(rows).repartition(1).sortWithinPartitions("o", "k").select("value").write.text(at)
    return at


ODD_SQL = """odd AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN c_name || ', " inc' WHEN c_custkey % 7 = 0 THEN c_name || chr(10) || 'second' WHEN c_custkey % 3 = 0 THEN c_name || '" wide' ELSE c_name END AS name, CAST(c_nationkey AS VARCHAR) AS nation,
   CASE WHEN c_custkey % 5 = 0 THEN '"' || c_name || ', "" inc"' WHEN c_custkey % 7 = 0 THEN '"' || c_name || chr(10) || 'second"' WHEN c_custkey % 3 = 0 THEN c_name || '" wide' ELSE c_name END AS shown FROM customer)"""


@query("a3_odd_records", f"WITH {ODD_SQL} SELECT CAST(k AS VARCHAR) AS c_custkey, name AS c_name, CASE WHEN k % 11 <> 0 THEN nation END AS c_nationkey, 'comma_ignore_errors' AS strategy FROM odd")
def _(read):
    """Every record is a row, whatever its line looks like."""
    out, strategy, _ = A.read_csv_with_issues(read("customer").sparkSession, odd_lines(read))
    return out.withColumn("strategy", F.lit(strategy))


@query("a3_issues", f"WITH {ODD_SQL} SELECT CAST(k AS VARCHAR) || ',' || shown || CASE WHEN k % 11 = 0 THEN '' ELSE ',' || nation || ',more' END AS record, CASE WHEN k % 11 = 0 THEN 'missing_fields' ELSE 'surplus_fields' END AS reason FROM odd WHERE k % 11 = 0 OR k % 13 = 0")
def _(read):
    return A.read_csv_with_issues(read("customer").sparkSession, odd_lines(read))[2].select("record", "reason")


@query("a4_read_delimited_any", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part")
def _(read):
    df = read("part").select("p_partkey", "p_name")
    at = folder(df)
    df.write.option("header", True).option("sep", "\t").csv(at)
    return A.read_delimited_any(df.sparkSession, at)[0]


@query("a5_read_radial_csv", "SELECT CAST(s_suppkey AS VARCHAR) AS n, 'rcan2025E2GIcast' || CAST(s_suppkey AS VARCHAR) AS cast_key, CAST('1999-06-15' AS TIMESTAMP) AS fecha, 'gijon' AS radial_id FROM supplier")
def _(read):
    df = read("supplier").select(F.col("s_suppkey").alias("N"), F.concat(F.lit("rcan2025E2GIcast"), F.col("s_suppkey").cast("string")).alias("Acronimo"), F.lit(1999).alias("Year"))
    at = folder(df)
    df.write.option("header", True).csv(at)
    return A.read_radial_csv(df.sparkSession, at, "part.csv").select("n", "cast_key", "fecha", "radial_id")


@query("a6_read_parquet_checked", "SELECT o_orderkey, o_totalprice FROM orders")
def _(read):
    from sondage.operators.canonical import require_columns

    return require_columns(read("orders"), ["o_orderkey", "o_totalprice"]).select("o_orderkey", "o_totalprice")


@query("a7_read_run_parts", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def _(read):
    o = read("orders")
    at = folder(o)
    o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus").write.parquet(f"{at}/a")
    o.where("o_orderkey % 2 = 1").select("o_orderkey").write.parquet(f"{at}/b")
    return A.read_run_parts(o.sparkSession, [f"{at}/a", f"{at}/b"])


@query("a7_prefers_the_consolidated_file", "SELECT 'whole' AS found, count(*) AS n FROM orders UNION ALL SELECT 'parts', count(*) FROM orders WHERE o_orderkey % 2 = 0")
def _(read):
    o = read("orders").select("o_orderkey")
    at = folder(o)
    o.write.parquet(f"{at}/all")
    o.where("o_orderkey % 2 = 0").write.parquet(f"{at}/part")
    n = lambda whole, tag: A.read_run_parts(o.sparkSession, [f"{at}/part"], f"{at}/{whole}").agg(F.lit(tag).alias("found"), F.count(F.lit(1)).alias("n"))
    return n("all", "whole").unionByName(n("none", "parts"))


@query("a8_write_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(read):
    o = read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    at = folder(o)
    A.write_table(o, at, ["o_orderstatus"])
    return o.sparkSession.read.parquet(at)


@query("a9_write_qc_triplet", "SELECT event_id, value, value > 100 AS is_anomaly FROM events")
def _(read):
    e = read("events").select("event_id", "value", (F.col("value") > 100).alias("is_anomaly"))
    at = folder(e)
    A.write_qc_triplet(e, at)
    return e.sparkSession.read.parquet(f"{at}/rows").withColumn("is_anomaly", F.col("is_anomaly").cast("boolean"))


@query("a10_consolidate", "SELECT n_nationkey AS k, n_name AS name, NULL::VARCHAR AS extra FROM nation UNION ALL SELECT r_regionkey, r_name, 'region' FROM region")
def _(read):
    return A.consolidate(read("nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name")), read("region").select(F.col("r_regionkey").cast("long").alias("k"), F.col("r_name").alias("name"), F.lit("region").alias("extra")))


@query("a11_quarantine_sink", "SELECT page_id, 'http' AS reasons, CAST('2020-01-01' AS DATE) AS day FROM pages WHERE starts_with(url, 'http:')")
def _(read):
    p = read("pages").where(F.col("url").startswith("http:")).select("page_id", F.array(F.lit("http")).alias("reasons"))
    at = folder(p)
    A.quarantine_sink(p, at, F.lit("2020-01-01 10:00:00").cast("timestamp_ntz"))
    return p.sparkSession.read.parquet(at).select("page_id", F.array_join("reasons", ",").alias("reasons"), F.col("day").cast("date").alias("day"))


@query("a12_read_write_csv", "SELECT c_custkey, c_acctbal FROM customer")
def _(read):
    c = read("customer").select("c_custkey", "c_acctbal")
    at = folder(c)
    A.write_csv(c, at)
    return A.read_csv(c.sparkSession, at, "c_custkey long, c_acctbal double")


@query("a13_run_log", "SELECT o_orderkey AS run_id, o_orderpriority AS step, o_orderstatus AS status FROM orders")
def _(read):
    runs = read("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("step"), F.col("o_orderstatus").alias("status"))
    at = folder(runs)
    A.run_log_sink(runs, at)
    return A.read_run_log(runs.sparkSession, at, "run_id long, step string, status string")


@query("a14_latest_run", "SELECT o_orderkey AS run_id, o_orderdate AS generated_at FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def _(read):
    return A.latest_run(read("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("generated_at")))


@query("a15_row_counts", "SELECT source, count(*) AS n FROM documents GROUP BY ALL")
def _(read):
    return A.row_counts(read("documents"), F.col("source"))


@query("a15_footer_counts", "SELECT o_orderstatus AS source, count(*) AS n FROM orders GROUP BY ALL")
def _(read):
    """Counts of a table by folder, from the footers of its files."""
    o = read("orders").select("o_orderkey", "o_orderstatus")
    at = folder(o)
    A.write_table(o, at, ["o_orderstatus"])
    return A.footer_counts(o.sparkSession, at, "o_orderstatus")


@query("a1_read_profile_files", "SELECT split_part(o_orderpriority, '-', 1) AS path, count(*) AS n, CAST(sum(o_custkey) AS DOUBLE) AS prsm, round(sum(o_custkey % 7 + 0.5), 4) AS t090c FROM orders GROUP BY ALL")
def _(read):
    """Five large files, one for each priority, read by lines in blocks."""
    o = read("orders").select(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("p"), F.concat_ws(" ", F.col("o_custkey").cast("string"), (F.col("o_custkey") % 7 + 0.5).cast("string")).alias("value"), F.lit(1).alias("o"))
    at = folder(o)
    heads = o.select("p").distinct().select("p", F.lit("# name 0 = prSM: P\n# name 1 = t090C: T\n*END*").alias("value"), F.lit(0).alias("o"))
    heads.unionByName(o.select("p", "value", "o")).repartition("p").sortWithinPartitions("p", "o").select("p", "value").write.partitionBy("p").text(at)
    rows, _ = A.read_profiles_text(o.sparkSession, at, "*.txt")
    wide = A.widened(rows, ["prsm", "t090c"]).groupBy(F.regexp_extract("path", r"/p=([^/]+)/", 1).alias("p"))
    return wide.agg(F.count(F.lit(1)).alias("n"), F.sum("prsm").alias("prsm"), F.round(F.sum("t090c"), 4).alias("t090c")).withColumnRenamed("p", "path")


@query("a16_read_run_log", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def _(read):
    runs = read("orders").select(F.to_json(F.struct(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status"))).alias("value"))
    at = folder(runs)
    runs.unionByName(read("region").select(F.lit("{broken").alias("value"))).write.text(at)
    return A.read_run_log(runs.sparkSession, at, "run_id long, status string").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("a16_failures_of_messages", "SELECT CAST(c_custkey AS VARCHAR) || '.cnv' AS file, CASE WHEN c_custkey % 2 = 0 THEN 'ValueError' ELSE 'broken' END AS error_type, CASE WHEN c_custkey % 2 = 0 THEN 'no: rows' ELSE 'broken' END AS reason FROM customer")
def _(read):
    k = F.col("c_custkey").cast("string")
    message = F.when(F.col("c_custkey") % 2 == 0, F.concat(k, F.lit(".cnv: ValueError: no: rows"))).otherwise(F.concat(k, F.lit(".cnv: broken")))
    return A.failures_of_messages(read("customer").select(F.array(message, F.lit("no colon")).alias("errors")))


#: Files are orders, the manifest knows two thirds of them, some with another length.
MANIFEST_SQL = "f AS (SELECT o_orderkey AS path, o_custkey AS length, o_orderdate AS mtime FROM orders), changed AS (SELECT * FROM f WHERE path % 3 = 0 OR path % 7 = 0)"


def manifest(read):
    f = read("orders").select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("length"), F.col("o_orderdate").alias("mtime"))
    known = f.where("path % 3 <> 0").withColumn("length", F.col("length") + F.when(F.col("path") % 7 == 0, 1).otherwise(0)).withColumn("version", F.lit(2))
    return f, known


@query("j1_changed_files", f"WITH {MANIFEST_SQL} SELECT path, length FROM changed")
def _(read):
    return J.changed_files(*manifest(read), 2).select("path", "length")


@query("j1_changed_files_by_digest", f"WITH {MANIFEST_SQL} SELECT path FROM f WHERE path % 3 = 0 OR path % 7 = 0 OR (path % 5 = 0 AND path % 11 = 0)")
def _(read):
    """The manifest's times are an hour late for every fifth file; digests tell which of these have changed."""
    f, known = manifest(read)
    at = lambda late: F.sha2(F.concat_ws("-", F.col("path"), F.when(F.lit(late) & (F.col("path") % 11 == 0), 1).otherwise(0)), 256)
    known = known.withColumn("sha256", at(True)).withColumn("mtime", F.when(F.col("path") % 5 == 0, F.col("mtime") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("mtime")))
    return J.changed_files(f.withColumn("sha256", at(False)), known, 2).select("path")


@query("j2_reuse_unchanged", f"WITH {MANIFEST_SQL} SELECT path, 'old' AS made FROM f WHERE path NOT IN (SELECT path FROM changed) UNION ALL SELECT path, 'new' FROM changed")
def _(read):
    f, known = manifest(read)
    changed = J.changed_files(f, known, 2)
    return J.reuse_unchanged(f.select("path", F.lit("old").alias("made")), changed.select("path", F.lit("new").alias("made")), changed)


@query("j3_publish_manifest", "SELECT DISTINCT ON (o_custkey) o_custkey AS path, o_orderdate AS published_at, o_orderkey AS entry FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def _(read):
    o = read("orders").select(F.col("o_custkey").alias("path"), F.col("o_orderdate").alias("published_at"), F.col("o_orderkey").alias("entry"))
    return J.publish_manifest(o.where("entry % 2 = 0"), o.where("entry % 2 <> 0"))


@query("j3_commit_manifest", "SELECT DISTINCT ON (o_custkey) o_custkey AS path, o_orderdate AS published_at, o_orderkey AS entry FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def _(read):
    """Three commits of a manifest, each a snapshot that readers see once it is whole."""
    o = read("orders").select(F.col("o_custkey").alias("path"), F.col("o_orderdate").alias("published_at"), F.col("o_orderkey").alias("entry"))
    at = folder(o)
    for k in range(3):
        J.commit_manifest(o.where(F.col("entry") % 3 == k), at)
    return J.read_snapshot(o.sparkSession, at)


@query("a13_repeated_runs", "SELECT o_orderstatus AS run_id, o_orderkey AS k, o_orderpriority AS step FROM orders")
def _(read):
    """Each status is a run that writes its records twice; they are there once."""
    o = read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("step"), "o_orderstatus")
    at = folder(o)
    for run in ("F", "O", "P", "O", "F"):
        A.run_log_sink(o.where(F.col("o_orderstatus") == run).drop("o_orderstatus"), at, run)
    return A.read_run_log(o.sparkSession, at, "run_id string, k long, step string")


@query("j4_outputs_fresh", "SELECT o_orderkey AS path, (SELECT count(*) >= 3 AND min(l_shipdate) >= o_orderdate FROM lineitem WHERE l_orderkey = o_orderkey) AS is_fresh FROM orders")
def _(read):
    inputs = read("orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("mtime"))
    outputs = read("lineitem").select(F.col("l_orderkey").alias("path"), F.col("l_shipdate").alias("mtime"))
    return J.outputs_fresh(inputs, outputs, "path", 3).select("path", "is_fresh")


@query("j5_tree_fingerprint", "SELECT CAST(count(*) AS VARCHAR) || ':' || CAST(max(epoch_us(o_orderdate)) AS VARCHAR) || ':' || CAST(CAST(sum(o_custkey) AS BIGINT) AS VARCHAR) AS fingerprint FROM orders")
def _(read):
    return J.tree_fingerprint(manifest(read)[0])


@query("j6_provenance", "SELECT page_id AS path, sha256(html) AS sha256, length(html) AS length, 'run-1' AS run_id FROM pages")
def _(read):
    p = read("pages").select(F.col("page_id").alias("path"), F.encode("html", "UTF-8").alias("content"), F.length("html").alias("length"), F.lit(0).alias("mtime"))
    return J.provenance(p, "run-1", F.current_timestamp(), {"years": "1970-2035"}).select("path", "sha256", "length", "run_id")


@query("j7_key_collisions", "SELECT split_part(url, '/', 3) AS stem, count(*) AS n, max(url) AS wins FROM pages GROUP BY ALL HAVING count(*) > 1")
def _(read):
    return J.key_collisions(read("pages").select(F.col("url").alias("path")), F.split_part(F.col("path"), F.lit("/"), F.lit(3)))


def class_files(read) -> DataFrame:
    """Every order as a text profile with its class, station and time in the header; some have no temperature."""
    line = F.concat_ws("  ", F.col("l_quantity").cast("string"), F.when(F.col("l_linenumber") == 7, "oops").otherwise(F.col("l_tax").cast("string")), F.col("l_discount").cast("string"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("t")))), lambda s: s["t"]), "\n")
    bodies = read("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(body.alias("body"))
    o = read("orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus", "o_orderdate")
    cruise = F.when(F.col("o_orderstatus") == "F", "Radial Gijón").when(F.col("o_orderstatus") == "O", "Santander").otherwise("RADCAN 2010")
    second = F.when(F.col("o_custkey") % 5 == 0, "par: PAR").otherwise("t090C: T")
    head = F.concat(
        F.lit("* header\n** Cruise: "), cruise, F.lit("\n** Station: "), (F.col("o_custkey") % 6).cast("string"), F.lit("\n# name 0 = prSM: Pressure\n# name 1 = "), second, F.lit("\n# name 2 = sal00: S\n# start_time = "),
        F.date_format("o_orderdate", "MMM dd yyyy HH:mm:ss"), F.lit("\n*END*\n"),
    )
    return bodies.join(o, "k").select(F.concat(F.lit("raw/p"), F.col("k").cast("string"), F.lit("x.cnv")).alias("path"), F.concat(head, "body").alias("content"))


#: Profiles of the class whose temperature can be read: rows without the damaged lines.
CLASS_FILES_SQL = """f AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
 r AS (SELECT f.*, l_quantity, l_tax, l_discount FROM f JOIN lineitem ON k = l_orderkey WHERE o_orderstatus = 'F' AND o_custkey % 5 <> 0 AND l_linenumber <> 7)"""


@query("d13_load_class_profiles", f"WITH {CLASS_FILES_SQL} SELECT 'p' || CAST(k AS VARCHAR) || 'x.cnv' AS source_file, CAST(o_custkey % 6 AS INTEGER) AS estacion, CAST(CASE WHEN o_custkey % 6 BETWEEN 1 AND 4 THEN o_custkey % 6 END AS INTEGER) AS estacion_canonica, CAST(o_orderdate AS DATE) AS day, count(*) AS n, count(*) - 1 AS last_row, round(avg(l_quantity), 6) AS depth, round(avg(l_tax), 6) AS temperature, round(avg(l_discount), 6) AS salinity FROM r GROUP BY ALL")
def _(read):
    rows, _ = load_class_profiles(class_files(read), "gijon")
    out = rows.groupBy("source_file", "estacion", "estacion_canonica", F.col("fecha").cast("date").alias("day"))
    return rounded(out.agg(F.count(F.lit(1)).alias("n"), F.max("row_id").alias("last_row"), F.avg("profundidad_m").alias("depth"), F.avg("temperatura_c").alias("temperature"), F.avg("salinidad_psu").alias("salinity")))


@query("d13_statistics", f"""WITH {CLASS_FILES_SQL} SELECT 'gijon' AS radial_id, (SELECT count(*) FROM f) AS n_files, (SELECT count(*) FROM f WHERE o_orderstatus = 'F') AS n_of_class, (SELECT count(*) FROM f WHERE o_orderstatus <> 'F') AS n_of_others, (SELECT count(*) FROM f WHERE o_orderstatus = 'F' AND o_custkey % 6 = 2) AS n_chosen,
  (SELECT count(*) FROM f WHERE o_orderstatus = 'F' AND o_custkey % 6 = 2 AND o_custkey % 5 = 0) AS n_without_temperature, (SELECT count(*) FROM f WHERE o_orderstatus = 'F' AND o_custkey % 6 = 2 AND o_custkey % 5 <> 0) - count(DISTINCT k) AS n_errors, count(DISTINCT k) AS n_profiles,
  count(*) FILTER (year(o_orderdate) <= 1994) AS n_rows, count(*) FILTER (year(o_orderdate) > 1994) AS n_out_of_years, CAST(min(o_orderdate) FILTER (year(o_orderdate) <= 1994) AS DATE) AS first_date, CAST(max(o_orderdate) FILTER (year(o_orderdate) <= 1994) AS DATE) AS last_date FROM r WHERE o_custkey % 6 = 2""")
def _(read):
    return load_class_profiles(class_files(read), "gijon", station=2, years=(1970, 1994))[1]
