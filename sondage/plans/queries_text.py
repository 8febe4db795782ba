"""Queries of header, path, name and classification expressions, over texts that the driver's tables hold or make."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.functions import text as T
from sondage.operators import classify as C

from .registry import query, rounded

#: A profile header for every customer: names, start time, station and position depend on the key.
HEADERS_SQL = """h AS (SELECT c_custkey AS k, '* Sea-Bird' || chr(10) || '** Cruise: ' || CASE c_custkey % 4 WHEN 0 THEN 'Radial Gijón' WHEN 1 THEN 'RADCAN 2010' WHEN 2 THEN 'Santander' ELSE '' END || chr(10)
  || '** Station: C' || CAST(c_custkey % 9 AS VARCHAR) || chr(10) || '** Latitude: 43 ' || CAST(c_custkey % 60 AS VARCHAR) || '.5 N' || chr(10) || '* NMEA Longitude = 005 ' || CAST(c_custkey % 59 AS VARCHAR) || '.25 W' || chr(10)
  || '# name 0 = prDM: Pressure' || chr(10) || '# name 1 = ' || CASE WHEN c_custkey % 3 = 0 THEN 't090C' ELSE 'sal00' END || ': x' || chr(10)
  || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '# start_time = ' || ['Jan', 'Abr', 'Ago', 'Xyz', 'Dic'][c_custkey % 5 + 1] || ' ' || CAST(c_custkey % 28 + 1 AS VARCHAR) || ' 2093 11:54:25' || chr(10) END AS head,
  CASE WHEN c_custkey % 2 = 0 THEN 'raw/1994/St.' || CAST(c_custkey % 7 AS VARCHAR) || ' CNVs/apr94.cnv' ELSE 'raw/other/gnov' || lpad(CAST(c_custkey % 100 AS VARCHAR), 3, '1') || '.cnv' END AS path FROM customer)"""


def headers(read):
    k = F.col("c_custkey")
    s = lambda x: x.cast("string")
    nl = F.lit("\n")
    cruise = F.when(k % 4 == 0, "Radial Gijón").when(k % 4 == 1, "RADCAN 2010").when(k % 4 == 2, "Santander").otherwise("")
    month = F.element_at(F.array(*map(F.lit, ["Jan", "Abr", "Ago", "Xyz", "Dic"])), (k % 5 + 1).cast("int"))
    start = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("# start_time = "), month, F.lit(" "), s(k % 28 + 1), F.lit(" 2093 11:54:25"), nl))
    head = F.concat(
        F.lit("* Sea-Bird\n** Cruise: "), cruise, F.lit("\n** Station: C"), s(k % 9), F.lit("\n** Latitude: 43 "), s(k % 60), F.lit(".5 N\n* NMEA Longitude = 005 "), s(k % 59), F.lit(".25 W\n# name 0 = prDM: Pressure\n# name 1 = "),
        F.when(k % 3 == 0, "t090C").otherwise("sal00"), F.lit(": x\n"), start,
    )
    path = F.when(k % 2 == 0, F.concat(F.lit("raw/1994/St."), s(k % 7), F.lit(" CNVs/apr94.cnv"))).otherwise(F.concat(F.lit("raw/other/gnov"), F.lpad(s(k % 100), 3, "1"), F.lit(".cnv")))
    return read("customer").select(k.alias("k"), head.alias("head"), path.alias("path"))


@query("b1_header_columns", f"WITH {HEADERS_SQL} SELECT k, array_to_string(list_transform(regexp_extract_all(head, '(?m)^# name \\d+ = (.+?) *:', 1), lambda x: lower(x)), ',') AS names FROM h")
def _(read):
    return headers(read).select("k", F.array_join(T.header_columns(F.col("head")), ",").alias("names"))


@query("b2_has_start_time", f"WITH {HEADERS_SQL} SELECT k, contains(head, '# start_time') AS has FROM h")
def _(read):
    return headers(read).select("k", T.has_start_time(F.col("head")).alias("has"))


ISO_SQL = """iso AS (SELECT *, CASE WHEN k % 5 IN (1, 2, 4) THEN '2093-' || ['01', '04', '08', '', '12'][k % 5 + 1] || '-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || 'T11:54:25' END AS iso,
  CASE WHEN k % 2 = 0 THEN 1994 END AS py, CASE WHEN k % 2 = 0 THEN 1994 WHEN CAST(right(lpad(CAST(k % 100 AS VARCHAR), 3, '1'), 2) AS INTEGER) >= 80 THEN 1900 + CAST(right(lpad(CAST(k % 100 AS VARCHAR), 3, '1'), 2) AS INTEGER) ELSE 2000 + CAST(right(lpad(CAST(k % 100 AS VARCHAR), 3, '1'), 2) AS INTEGER) END AS fy FROM h)"""


@query("b3_parse_start_time", f"WITH {HEADERS_SQL}, {ISO_SQL} SELECT k, iso FROM iso")
def _(read):
    return headers(read).select("k", T.parse_start_time(F.col("head")).alias("iso"))


@query("b4_two_digit_year", "SELECT c_custkey AS k, CASE WHEN c_custkey % 100 >= 80 THEN 1900 + c_custkey % 100 ELSE 2000 + c_custkey % 100 END AS year FROM customer")
def _(read):
    return read("customer").select(F.col("c_custkey").alias("k"), T.two_digit_year(F.col("c_custkey") % 100).alias("year"))


@query("b5_year_from_path", f"WITH {HEADERS_SQL}, {ISO_SQL} SELECT k, py AS year FROM iso")
def _(read):
    return headers(read).select("k", T.year_from_path(F.col("path")).alias("year"))


@query("b6_year_from_filename", f"WITH {HEADERS_SQL}, {ISO_SQL} SELECT k, fy AS year FROM iso")
def _(read):
    return headers(read).select("k", T.year_from_filename(T.file_stem(F.col("path"))).alias("year"))


@query("b7_reconcile_year", f"WITH {HEADERS_SQL}, {ISO_SQL} SELECT k, CAST(TRY_CAST(lpad(CAST(coalesce(py, fy) AS VARCHAR), 4, '0') || substr(iso, 5) AS TIMESTAMP) AS VARCHAR) AS at FROM iso")
def _(read):
    return headers(read).select("k", F.date_format(T.reconcile_year(T.parse_start_time(F.col("head")), F.col("path")), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("b8_explain_year", f"WITH {HEADERS_SQL}, {ISO_SQL} SELECT k, CASE WHEN iso IS NOT NULL THEN 2093 END AS header_year, py AS path_year, fy AS file_year, CASE WHEN iso IS NOT NULL THEN coalesce(py, fy) END AS applied_year, CASE WHEN iso IS NULL THEN 'none' WHEN py IS NOT NULL THEN 'path' ELSE 'filename' END AS rule FROM iso")
def _(read):
    return headers(read).select("k", T.explain_year(T.parse_start_time(F.col("head")), F.col("path")).alias("y")).select("k", "y.*")


@query("b9_station_number", f"WITH {HEADERS_SQL} SELECT k, CAST(k % 9 AS INTEGER) AS station FROM h")
def _(read):
    return headers(read).select("k", T.station_number(F.col("head"), F.col("path")).alias("station"))


HINTS_SQL = """hints AS (SELECT k, path, CASE k % 4 WHEN 0 THEN 'Radial Gijón' WHEN 1 THEN 'RADCAN 2010' WHEN 2 THEN 'Santander' ELSE '' END AS cruise, 'C' || CAST(k % 9 AS VARCHAR) AS station_field,
  43 + (k % 60 + 0.5) / 60 AS lat_deg, -(5 + (k % 59 + 0.25) / 60) AS lon_deg FROM h)"""


@query("b10_header_hints", f"WITH {HEADERS_SQL}, {HINTS_SQL} SELECT k, cruise, station_field, round(CAST(lat_deg AS DOUBLE), 6) AS lat_deg, round(CAST(lon_deg AS DOUBLE), 6) AS lon_deg FROM hints")
def _(read):
    return rounded(headers(read).select("k", T.header_hints(F.col("head")).alias("x")).select("k", "x.cruise", "x.station_field", "x.lat_deg", "x.lon_deg"))


@query("b11_dms_to_degrees", """SELECT c_custkey AS k, round(CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END * CASE WHEN c_custkey % 7 = 1 THEN (c_custkey % 90 + 1) + (c_custkey % 60) / 60.0
  WHEN c_custkey % 7 = 2 THEN -(c_custkey % 90 + 1) + (c_custkey % 60) / 60.0 WHEN c_custkey % 7 > 3 OR c_custkey % 7 = 0 THEN (c_custkey % 90 + 1) + (c_custkey % 60) / 60.0 + 7.5 / 3600 END, 6) AS deg FROM customer""")
def _(read):
    """Degrees, minutes and seconds; with a comma, which parts numbers; with a sign; and with a word, which spoils them."""
    k = F.col("c_custkey")
    side, d, m = F.when(k % 2 == 0, "S").otherwise("N"), k % 90 + 1, k % 60
    kinds = F.when(k % 7 == 1, F.format_string("%d,%d %s", d, m, side)).when(k % 7 == 2, F.format_string("-%d %d%s", d, m, side)).when(k % 7 == 3, F.format_string("%d deg %d %s", d, m, side))
    text = kinds.otherwise(F.format_string("%d° %d' 7.5\" %s", d, m, side))
    return rounded(read("customer").select(k.alias("k"), T.dms_to_degrees(text, "NS").alias("deg")))


@query("b12_normalize_text", "SELECT doc_id, md5(trim(regexp_replace(lower(translate(text, 'áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ', 'aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY')), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) AS h FROM documents")
def _(read):
    return read("documents").select("doc_id", F.md5(T.normalize_text(F.col("text"))).alias("h"))


@query("b13_path_shard", f"WITH {HEADERS_SQL} SELECT k, CASE WHEN k % 2 = 0 THEN '1994' ELSE 'other' END AS shard, k % 2 = 0 AS is_year FROM h")
def _(read):
    shard = T.path_shard(F.col("path"), "raw")
    return headers(read).select("k", shard.alias("shard"), T.is_year_shard(shard).alias("is_year"))


@query("b14_file_label", f"WITH {HEADERS_SQL} SELECT k, CASE WHEN k % 2 = 0 THEN '1994/apr94.cnv' ELSE substr(path, 5) END AS label FROM h")
def _(read):
    return headers(read).select("k", T.file_label(F.col("path"), "raw").alias("label"))


@query("b15_content_hash", "SELECT doc_id, sha256(text) AS sha, substr(sha256(CAST(doc_id AS VARCHAR)), 1, 12) || '_' || substr(replace(text, ' ', '_'), 1, 80) AS slug FROM documents")
def _(read):
    d = read("documents")
    return d.select("doc_id", T.content_hash(F.encode("text", "UTF-8")).alias("sha"), T.artifact_slug(F.col("doc_id").cast("string"), F.col("text")).alias("slug"))


@query("b16_header_has_any", f"WITH {HEADERS_SQL} SELECT k, k % 3 = 0 AS has FROM h")
def _(read):
    return headers(read).select("k", T.header_has_any(T.header_columns(F.col("head")), ["t090c", "t068"]).alias("has"))


@query("b17_normalize_column_name", "SELECT p_partkey, lower(p_name) AS name FROM part")
def _(read):
    return read("part").select("p_partkey", T.normalize_column_name(F.concat(F.lit(" \""), F.upper("p_name"), F.lit("\" "))).alias("name"))


LABELS_SQL = "[" + ", ".join(f"{{'k': '{k}', 'label': '{v[0]}', 'unit': '{v[1]}'}}" for k, v in T.VARIABLES.items()) + "]"


@query("b18_var_meta", f"WITH v AS (SELECT unnest({LABELS_SQL}) AS v), n AS (SELECT v.k AS k, v.label AS label, v.unit AS unit, row_number() OVER (ORDER BY v.k) - 1 AS i FROM v) SELECT event_id, label, unit FROM events JOIN n ON event_id % 12 = i")
def _(read):
    names = sorted(T.VARIABLES)
    name = F.upper(F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % 12 + 1).cast("int")))
    return read("events").select("event_id", T.var_meta(name).alias("m")).select("event_id", "m.*")


@query("b18_infer_kind", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'temperature' WHEN 1 THEN 'salinity' ELSE 'other' END AS kind, CASE event_id % 3 WHEN 0 THEN 'Temp 5m' WHEN 1 THEN 'Salinidad' ELSE 'Oxygen Mgl' END AS label, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'PSU' ELSE '' END AS unit FROM events")
def _(read):
    name = F.element_at(F.array(*map(F.lit, ["temp_5m", "salinidad_psu", "oxygen_mgl"])), (F.col("event_id") % 3 + 1).cast("int"))
    e = read("events").select("event_id", name.alias("name"))
    return e.select("event_id", T.infer_kind(F.col("name")).alias("kind"), T.var_meta(F.col("name")).alias("m")).select("event_id", "kind", "m.*")


@query("b19_reason_label", "SELECT doc_id, CASE WHEN contains(lower(text), 'token =') THEN 'secret' WHEN contains(lower(text), 'stupid') THEN 'abuse' ELSE substr(text, 1, 60) END AS label FROM documents")
def _(read):
    return read("documents").select("doc_id", T.reason_label(F.col("text"), {"token =": "secret", "stupid": "abuse"}).alias("label"))


@query("b20_coords_from_docs", """WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS form FROM customer)
 SELECT k, i AS station, round(40 + i + (k % 60) / 60.0, 6) AS lat_deg, round(-(5 + (k % 59) / 60.0), 6) AS lon_deg, ['E1 · Costa', 'E2 · Plataforma', 'E3 · Talud', 'E4 · Talud profundo'][i] AS name FROM c, generate_series(1, 4) g(i) WHERE form = 0
 UNION ALL SELECT k, i, round(40 + i + (k % 60) / 60.0, 6), round(-(5 + (k % 59) / 60.0), 6), 'E' || CAST(i AS VARCHAR) || 'CU' FROM c, generate_series(1, 3) g(i) WHERE form = 1
 UNION ALL SELECT k, i, round(40 + i + (k % 60) / 60.0, 6), round(-(5 + (k % 59) / 60.0), 6), 'E' || CAST(i AS VARCHAR) || ' · Punta ' || CAST(i AS VARCHAR) FROM c, generate_series(1, 2) g(i) WHERE form = 2""")
def _(read):
    """A methodology text for every customer, in one of the three forms or still to be written."""
    k = F.col("c_custkey")
    lat, lon = (k % 60) / 60, -(5 + (k % 59) / 60)
    comment = lambda n: F.concat(F.lit("Estaciones <!-- "), *[x for i in range(1, n + 1) for x in (F.format_string(f"%sE{i} %.8f %.8f", F.lit(" | " if i > 1 else ""), lat + 40 + i, lon),)], F.lit(" -->"))
    points = F.concat(*[F.format_string(f"- **Estación {i} · Punta {i}** ({40 + i}° %d.0' N, 5° %d.0′ W)\n", k % 60, k % 59) for i in (2, 1)])
    text = F.when(k % 4 == 0, comment(4)).when(k % 4 == 1, comment(3)).when(k % 4 == 2, points).otherwise(F.concat(F.lit("<p>Texto de metodología pendiente</p>"), comment(4)))
    return rounded(read("customer").select(k.alias("k"), F.inline(T.coords_from_docs(text))).withColumn("station", F.col("station").cast("long")))


CASE_CODES = "CASE " + " ".join(f"WHEN contains(upper(text), '{c}') THEN '{k}'" for c, k in [("THE", "a"), ("UND", "b"), ("QUE", "c"), ("LA", "d")]) + " END"


@query("c1_identify_by_code", f"SELECT doc_id, {CASE_CODES} AS id FROM documents")
def _(read):
    catalog = {"a": ("THE",), "b": ("UND",), "c": ("QUE",), "d": ("LA",)}
    return read("documents").select("doc_id", C.identify_by_code(F.col("text"), catalog).alias("id"))


@query("c1_identify_by_catalog", """WITH codes AS (SELECT p_partkey AS id, upper(p_name) AS code FROM part), names AS (SELECT s_suppkey, upper(s_name) || ' ' || (SELECT upper(p_name) FROM part WHERE p_partkey = s_suppkey) AS t FROM supplier)
 SELECT s_suppkey, min_by(id, row(-length(code), id)) AS id FROM names JOIN codes ON contains(t, code) GROUP BY ALL""")
def _(read):
    part, s = read("part").select(F.col("p_partkey"), F.col("p_partkey").alias("id"), F.col("p_name").alias("code")), read("supplier")
    texts = s.join(part, s["s_suppkey"] == part["p_partkey"]).select("s_suppkey", F.concat_ws(" ", "s_name", "code").alias("t"))
    return C.identify_by_catalog(texts, "t", "s_suppkey", part.select("id", "code"))


@query("c1_identify_in_documents", """WITH codes AS (SELECT item_id AS id, upper(substr(text, 1, 40)) AS code FROM benchmark WHERE NOT contains(substr(text, 1, 40), 'ß') AND length(text) >= 40)
 SELECT doc_id, min(id) AS id FROM documents JOIN codes ON contains(upper(text), code) GROUP BY ALL""")
def _(read):
    """Whole documents against the beginnings of all benchmark texts."""
    begin = F.substring("text", 1, 40)
    codes = read("benchmark").where((F.length("text") >= 40) & ~F.contains(begin, F.lit("ß"))).select(F.col("item_id").alias("id"), begin.alias("code"))
    return C.identify_by_catalog(read("documents"), "text", "doc_id", codes)


POSITIONS_SQL = "p AS (SELECT c_custkey AS k, 42.5 + (c_custkey % 250) / 100.0 AS lat, -10 + (c_custkey * 7 % 800) / 100.0 AS lon FROM customer)"
GEO_SQL = "CASE WHEN lat BETWEEN 43.15 AND 44.7 AND lon BETWEEN -9.5 AND -2.5 THEN CASE WHEN lon <= -7.5 AND lat BETWEEN 43.05 AND 44.35 THEN 'coruna' WHEN lon <= -6.0 THEN 'cudillero' WHEN lon <= -4.85 THEN 'gijon' ELSE 'santander' END END"


def positions(read):
    k = F.col("c_custkey")
    return read("customer").select(k.alias("k"), (F.lit(42.5) + (k % 250) / 100).alias("lat"), (F.lit(-10.0) + (k * 7 % 800) / 100).alias("lon"))


@query("c2_classify_by_position", f"WITH {POSITIONS_SQL} SELECT k, {GEO_SQL} AS id FROM p")
def _(read):
    return positions(read).select("k", C.classify_by_position(F.round("lat", 6), F.round("lon", 6)).alias("id"))


@query("c3_classify_by_keywords", f"WITH {HEADERS_SQL}, {HINTS_SQL} SELECT k, CASE k % 4 WHEN 0 THEN 'gijon' WHEN 2 THEN 'santander' END AS id FROM hints")
def _(read):
    return headers(read).select("k", C.classify_by_keywords(T.header_hints(F.col("head"))["cruise"]).alias("id"))


@query("c4_classify_by_filename", f"WITH {HEADERS_SQL} SELECT k, CASE WHEN k % 2 = 0 THEN 'cudillero' ELSE 'gijon' END AS id FROM h")
def _(read):
    return headers(read).select("k", C.classify_by_filename(T.file_stem(F.col("path"))).alias("id"))


@query("c5_campaign_flag", f"WITH {HEADERS_SQL} SELECT k, k % 4 = 1 AS campaign FROM h")
def _(read):
    return headers(read).select("k", C.campaign_flag(T.header_hints(F.col("head"))["cruise"]).alias("campaign"))


@query("c6_classify_by_station_prefix", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CASE s_suppkey % 5 WHEN 0 THEN 'coruna' WHEN 1 THEN 'cudillero' WHEN 2 THEN 'gijon' WHEN 3 THEN 'santander' ELSE 'vigo' END END AS id FROM supplier")
def _(read):
    k = F.col("s_suppkey")
    station = F.concat(F.element_at(F.array(*map(F.lit, ["co", "c", "g", "S", "V"])), (k % 5 + 1).cast("int")), F.lit("3"))
    return read("supplier").select("s_suppkey", C.classify_by_station_prefix(station, k % 2 == 0).alias("id"))


@query("c7_folder_and_bbox_rules", f"WITH {HEADERS_SQL}, {POSITIONS_SQL} SELECT k, CASE WHEN k % 2 = 0 THEN 'cudillero' END AS folder, lat BETWEEN 43.2 AND 43.95 AND lon BETWEEN -6.5 AND -3 AS in_box FROM h JOIN p USING (k)")
def _(read):
    return headers(read).join(positions(read), "k").select("k", C.folder_rule(F.col("path")).alias("folder"), C.in_bbox(F.round("lat", 6), F.round("lon", 6)).alias("in_box"))


DETAILED_SQL = f"""{HEADERS_SQL}, {HINTS_SQL.replace("lat_deg", "_a").replace("lon_deg", "_o")}, {POSITIONS_SQL},
 c AS (SELECT k, path, CASE k % 4 WHEN 0 THEN 'gijon' WHEN 2 THEN 'santander' END AS by_cruise, {GEO_SQL} AS geo, k % 2 = 0 AS folder, k % 4 = 1 AS campana, k % 4 = 3 AS blank FROM hints JOIN p USING (k)),
 d AS (SELECT *, coalesce(by_cruise <> geo, false) AS conflict FROM c),
 e AS (SELECT k, path, campana, conflict, CASE WHEN folder THEN 'cudillero' WHEN blank THEN 'gijon' WHEN by_cruise IS NOT NULL AND NOT conflict THEN by_cruise WHEN geo IS NOT NULL THEN geo ELSE 'gijon' END AS radial_id,
   CASE WHEN folder THEN 'folder' WHEN blank THEN 'filename' WHEN by_cruise IS NOT NULL AND NOT conflict THEN 'cruise' WHEN geo IS NOT NULL THEN 'geo' ELSE 'filename' END AS rule FROM d)"""


def detailed(read):
    hints = T.header_hints(F.col("head"))  # its fields as columns of their own: the others aren't evaluated
    h = headers(read).join(positions(read), "k").select("k", "path", hints["cruise"].alias("cruise"), hints["station_field"].alias("station"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))
    return C.classify_detailed(h, "path", "cruise", "lat", "lon", "station").select("k", "path", "cruise", "cls.radial_id", "cls.rule", "cls.campana", "cls.conflict")


@query("c8_classify_detailed", f"WITH {DETAILED_SQL} SELECT k, radial_id, rule, campana, conflict FROM e")
def _(read):
    return detailed(read).drop("path", "cruise")


@query("c9_scope_files", f"WITH {DETAILED_SQL} SELECT coalesce(radial_id, 'desconocida') AS radial_id, count(*) AS n FROM e GROUP BY ALL")
def _(read):
    return C.scope_files(detailed(read), "gijon")[2]


@query("c10_classify_by_reference", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'site' || CAST(s_nationkey AS VARCHAR) ELSE 'gijon' END AS radial_id FROM supplier")
def _(read):
    k = F.col("s_suppkey")
    s = read("supplier")
    files = s.where(k % 3 == 0).select(F.concat(F.lit("a/Gnov"), k.cast("string"), F.lit(".cnv")).alias("path"), F.concat(F.lit("site"), F.col("s_nationkey").cast("string")).alias("radial_id"))
    rows = s.select("s_suppkey", F.concat(F.lit("z/gnov"), k.cast("string"), F.lit(".CNV")).alias("source_file"))
    return C.classify_by_reference(rows, "source_file", files).select("s_suppkey", "radial_id")


def acronyms(read):
    k = F.col("s_suppkey")
    return read("supplier").select("s_suppkey", F.lit(None).cast("string").alias("acronimo"), F.concat(F.lit("rcan2025"), F.element_at(F.array(*map(F.lit, ["E2GI", "E3SA", "xx", "E1CU"])), (k % 4 + 1).cast("int")), F.lit("cast"), k.cast("string")).alias("cast"), (k % 12).alias("n"))


CLASS_SQL = "a AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'gijon' WHEN 1 THEN 'santander' WHEN 3 THEN 'cudillero' END AS radial_id FROM supplier)"


@query("c11_attach_class", f"WITH {CLASS_SQL} SELECT * FROM a")
def _(read):
    return C.attach_class(acronyms(read)).select("s_suppkey", "radial_id")


@query("c11_attach_class_by_source", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'site' || CAST(s_nationkey AS VARCHAR) ELSE 'gijon' END AS radial_id FROM supplier")
def _(read):
    """The row's source tells the class before any code in its columns."""
    k = F.col("s_suppkey")
    s = read("supplier")
    files = s.where(k % 3 == 0).select(F.concat(F.lit("a/Gnov"), k.cast("string"), F.lit(".cnv")).alias("path"), F.concat(F.lit("site"), F.col("s_nationkey").cast("string")).alias("radial_id"))
    rows = acronyms(read).withColumn("source_file", F.concat(F.lit("z/gnov"), k.cast("string"), F.lit(".CNV"))).withColumn("radial_id", F.lit(None).cast("string"))
    return C.attach_class(rows, files=files).select("s_suppkey", "radial_id")


@query("c12_filter_to_class", f"WITH {CLASS_SQL} SELECT s_suppkey, (SELECT count(*) FROM a WHERE radial_id IS DISTINCT FROM 'gijon') AS dropped FROM a WHERE radial_id = 'gijon'")
def _(read):
    kept, dropped = C.filter_to_class(acronyms(read), "gijon")
    return kept.select("s_suppkey").withColumn("dropped", F.lit(dropped.first()["dropped"]))


@query("c13_scope_rows", "SELECT CAST(n_nationkey AS VARCHAR) AS source_file, count(*) FILTER (s_suppkey % 4 = 2 OR s_suppkey % 4 = n_nationkey % 4) AS kept, count(*) FILTER (NOT (s_suppkey % 4 = 2 OR s_suppkey % 4 = n_nationkey % 4)) AS dropped, count(*) FILTER (s_suppkey % 4 = 2 OR s_suppkey % 4 = n_nationkey % 4) = 0 AS is_error FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def _(read):
    k = F.col("s_suppkey") % 4
    rows = read("supplier").select(F.col("s_nationkey").cast("string").alias("source_file"), F.when(k != 2, k.cast("string")).alias("radial_id"))
    files = read("nation").select(F.col("n_nationkey").cast("string").alias("path"), (F.col("n_nationkey") % 4).cast("string").alias("radial_id"))
    return C.scope_rows(rows, files)[1]


GIJON = C.CODES["gijon"]


@query("c14_resolve_station", "SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 4 = 0 THEN 2 WHEN s_suppkey % 12 BETWEEN 1 AND 4 THEN s_suppkey % 12 END AS INTEGER) AS idx FROM supplier")
def _(read):
    return acronyms(read).select("s_suppkey", C.resolve_station(GIJON, [F.col("cast"), F.col("acronimo")], F.lit(None).cast("int"), F.col("n").cast("int")).alias("idx"))


STATION_SQL = "st AS (SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 4 = 0 THEN 2 WHEN s_suppkey % 12 BETWEEN 1 AND 4 THEN s_suppkey % 12 END AS INTEGER) AS estacion_canonica FROM supplier)"


@query("c15_apply_station", f"WITH {STATION_SQL} SELECT * FROM st")
def _(read):
    return C.apply_station(acronyms(read), GIJON, ["acronimo", "cast"], "n").select("s_suppkey", "estacion_canonica")


@query("c16_station_options", f"WITH {STATION_SQL} SELECT DISTINCT estacion_canonica FROM st WHERE estacion_canonica BETWEEN 1 AND 4")
def _(read):
    return C.station_options(C.apply_station(acronyms(read), GIJON, ["acronimo", "cast"], "n"), 4)


@query("c17_station_names", "SELECT s_suppkey, CASE WHEN s_suppkey % 6 BETWEEN 1 AND 4 THEN 'E' || CAST(s_suppkey % 6 AS VARCHAR) || 'GI' ELSE 'Estacion ' || CAST(s_suppkey % 6 AS VARCHAR) END AS station_name FROM supplier")
def _(read):
    s = read("supplier").select("s_suppkey", (F.col("s_suppkey") % 6).alias("estacion_canonica"))
    return C.station_names(s, GIJON).select("s_suppkey", "station_name")


@query("c17_station_code", "SELECT s_suppkey, CASE WHEN s_suppkey % 10 BETWEEN 2 AND 8 THEN 'E' || CAST(s_suppkey % 10 AS VARCHAR) || 'SA' WHEN s_suppkey % 10 = 1 THEN 'E2SA' END AS code, CASE WHEN s_suppkey % 2 = 0 THEN 'A Coruña' ELSE 'elsewhere' END AS label FROM supplier")
def _(read):
    n = F.col("s_suppkey") % 10
    return read("supplier").select("s_suppkey", C.station_code(n, C.CODES["santander"]).alias("code"), C.site_label(F.when(F.col("s_suppkey") % 2 == 0, "coruna").otherwise("elsewhere")).alias("label"))


@query("c18_file_audit", f"""WITH {DETAILED_SQL} SELECT e.k, split_part(e.path, '/', -1) AS file, split_part(e.path, '/', -2) AS parent_folder, h2.cruise AS cruise_raw, CASE e.k % 4 WHEN 0 THEN 'radial gijon' WHEN 1 THEN 'radcan 2010' WHEN 2 THEN 'santander' ELSE '' END AS cruise_normalized,
  CASE e.k % 4 WHEN 0 THEN 'gijon' WHEN 2 THEN 'santander' END AS cruise_radial, e.radial_id, e.rule, e.campana, e.conflict, CASE WHEN e.k % 2 = 0 THEN CAST(e.k % 7 AS INTEGER) END AS station_folder, CASE WHEN e.k % 2 = 0 THEN 1994 END AS path_year
  FROM e JOIN (SELECT k, cruise FROM hints) h2 USING (k)""")
def _(read):
    h = headers(read).join(positions(read), "k").withColumn("hints", T.header_hints(F.col("head")))
    h = h.select("path", "k", F.col("hints.cruise").alias("cruise"), F.col("hints.station_field").alias("station_field"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), T.parse_start_time(F.col("head")).alias("start_iso"), T.station_number(F.col("head"), F.col("path")).alias("station"))
    files = C.classify_detailed(h, "path", "cruise", "lat", "lon", "station_field")
    files = files.withColumn("path", F.concat_ws("/", F.col("k").cast("string"), "path"))  # paths repeat among customers
    shown = ["file", "parent_folder", "cruise_raw", "cruise_normalized", "cruise_radial", "radial_id", "rule", "campana", "conflict", "station_folder", "path_year"]
    return C.file_audit(files).select(F.split_part("path", F.lit("/"), F.lit(1)).cast("long").alias("k"), *shown)


@query("c18_conflict_audit", f"WITH {DETAILED_SQL} SELECT radial_id, cruise, count(*) AS n FROM e JOIN (SELECT k, cruise FROM hints) USING (k) GROUP BY ALL")
def _(read):
    return C.conflict_audit(detailed(read))[0]
