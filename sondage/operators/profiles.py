"""Profiles of one class from text files: scan, classify, filter, parse, canonicalise, station, years, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.functions import text as T
from sondage.scratch import written

from . import canonical as N
from . import classify as C
from .canonical import filter_year_window, limit_sources


def header_facts(files: DataFrame, content: Column) -> DataFrame:
    """``path, names, start_time, station, cruise, lat, lon, station_field`` of every file, from its header alone."""
    head = T.header_part(content)
    rows = files.select("path", head.alias("_head"))
    hints = T.header_hints(F.col("_head"))
    return rows.select(
        "path", T.header_columns(F.col("_head")).alias("names"), T.reconcile_year(T.parse_start_time(F.col("_head")), F.col("path")).alias("start_time"), T.station_number(F.col("_head"), F.col("path")).alias("station"),
        hints["cruise"].alias("cruise"), hints["lat_deg"].alias("lat"), hints["lon_deg"].alias("lon"), hints["station_field"].alias("station_field"),
    )


def _by_alias(aliases: tuple[str, ...]) -> Column:
    """The value of the first alias that a row's map ``values`` has."""
    found = F.get(F.filter(F.array(*map(F.lit, aliases)), lambda a: F.map_contains_key("values", a)), F.lit(0))
    return T.once(found, lambda a: F.when(a.isNotNull(), F.try_element_at(F.col("values"), a)))


def load_class_profiles(files: DataFrame, target: str, content: Column | None = None, codes: dict[str, tuple[str, ...]] = C.CODES, station: int | None = None, most_files: int | None = None, years: tuple[int, int] = (1970, 2035)) -> tuple[DataFrame, DataFrame]:
    """(canonical rows, one row of statistics) of the files (``path, content``) that are of the class ``target``.

    Files are classified from their headers; those of another station (if one is asked for), those beyond the first
    ``most_files`` by path, and those without a temperature are left out, and only the others' bodies are parsed. Columns
    are those of the first alias in a file; rows without temperature, or without depth in a file that has one, go, as do those
    outside the years. ``estacion`` is the header's number, ``estacion_canonica`` its index in the class's codes. Statistics
    count files in all, of the class, without temperature, without a valid row (errors) and loaded, and rows and dates.
    """
    from sondage.sources.files import parse_profiles

    content = F.col("content") if content is None else content
    facts = C.classify_detailed(header_facts(files, content), "path", "cruise", "lat", "lon", "station_field")
    facts = written(facts.select("path", "names", "start_time", "station", F.col("cls.radial_id").alias("radial_id")), "headers")
    own = facts.where(F.col("radial_id") == target)
    chosen = own.where(F.col("station") == station) if station is not None else own
    chosen = limit_sources(chosen, most_files) if most_files else chosen
    chosen = chosen.withColumn("with_temperature", T.header_has_any(F.col("names"), list(N.TEMPERATURE)))
    chosen = written(chosen.withColumn("with_depth", T.header_has_any(F.col("names"), list(N.DEPTH))), "chosen")
    ready = chosen.where("with_temperature")
    rows, _ = parse_profiles(files.join(ready.select("path"), "path", "left_semi"), content)
    rows = rows.select("path", "line_no", _by_alias(N.DEPTH).alias("profundidad_m"), _by_alias(N.TEMPERATURE).alias("temperatura_c"), _by_alias(N.SALINITY).alias("salinidad_psu"))
    rows = rows.join(ready.select("path", "start_time", "station", "with_depth"), "path")
    rows = rows.where(F.col("temperatura_c").isNotNull() & (F.col("profundidad_m").isNotNull() | ~F.col("with_depth")))
    row_id = (F.row_number().over(Window.partitionBy("path").orderBy("line_no")) - 1).cast("long")
    leaf = F.element_at(F.split("path", "/"), -1)
    rows = rows.select("path", leaf.alias("source_file"), row_id.alias("row_id"), F.col("start_time").cast("timestamp_ntz").alias("fecha"), F.col("station").alias("estacion"), F.lit(target).alias("radial_id"), "profundidad_m", "temperatura_c", "salinidad_psu")
    index = C.resolve_station(codes[target], [F.col("source_file")], F.lit(None).cast("int"), F.col("estacion"))
    rows = written(rows.withColumn("estacion_canonica", index), "profiles")
    kept = filter_year_window(rows, "fecha", *years)
    total = facts.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("radial_id") == target).alias("n_of_class"))
    tried = chosen.agg(F.count(F.lit(1)).alias("n_chosen"), F.count_if(~F.col("with_temperature")).alias("n_without_temperature"))
    loaded = rows.agg(F.count_distinct("path").alias("n_profiles"), F.count(F.lit(1)).alias("n_parsed"))
    last = kept.agg(F.count(F.lit(1)).alias("n_rows"), F.min("fecha").cast("date").alias("first_date"), F.max("fecha").cast("date").alias("last_date"))
    stats = total.crossJoin(tried).crossJoin(loaded).crossJoin(last)  # four tables of one row
    stats = stats.select(
        F.lit(target).alias("radial_id"), "n_files", "n_of_class", (F.col("n_files") - F.col("n_of_class")).alias("n_of_others"), "n_chosen", "n_without_temperature", (F.col("n_chosen") - F.col("n_without_temperature") - F.col("n_profiles")).alias("n_errors"),
        "n_profiles", "n_rows", (F.col("n_parsed") - F.col("n_rows")).alias("n_out_of_years"), "first_date", "last_date",
    )
    return kept, stats
