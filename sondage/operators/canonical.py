"""Mapping of heterogeneous columns to one profile schema: aliases, casts, dates, keys, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contract import finite
from .quantiles import joined, quantiles

# Column aliases in the order in which they are tried.
DEPTH = ("profundidad_m", "profundidad", "depth", "deps", "depsm", "dep_sm", "dep_sm [m]", "dep", "prdm", "prdm [m]", "prsm", "prsm [db]", "press", "pr", "prse")
TEMPERATURE = ("temperatura_c", "temperatura", "temp", "temperature", "t090c", "t068", "t068c", "tv290c", "ts068", "potemp068", "potemp068c")
SALINITY = ("salinidad_psu", "salinidad", "salinity", "sal", "sal00")
DATE = ("fecha", "date", "datetime", "timestamp")
STATION = ("estacion", "station", "est")
CAST = ("cast",)
ALIASES = {"profundidad_m": DEPTH, "temperatura_c": TEMPERATURE, "salinidad_psu": SALINITY, "fecha": DATE, "estacion": STATION, "cast": CAST}
YEAR = r"(?:19|20)\d{2}"
KINDS = {"profundidad_m": "double", "temperatura_c": "double", "salinidad_psu": "double", "fecha": "timestamp_ntz", "estacion": "string", "cast": "string"}


def resolve_alias(columns: list[str], candidates: tuple[str, ...]) -> str | None:
    """The first candidate among the columns, whatever its case; of columns that differ by case alone the last."""
    low = {c.lower(): c for c in columns}
    return next((low[c] for c in candidates if c in low), None)


def coerce(df: DataFrame, numeric: list[str] = (), dates: list[str] = (), required: list[str] = ()) -> DataFrame:
    """Numbers and timestamps where values are ones, else null; rows that lack a required one go."""
    out = df.withColumns({c: finite(c) for c in numeric} | {c: F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz") for c in dates})
    return out.dropna(subset=list(required)) if required else out


def filter_year_window(df: DataFrame, date: str, low: int = 1970, high: int = 2035, strict: bool = False) -> DataFrame:
    """Rows whose year lies in the window, and, unless ``strict``, those without a date; all rows if the bounds are crossed."""
    if low > high:
        return df
    inside = F.year(date).between(low, high)
    return df.where(inside if strict else F.col(date).isNull() | inside)


def canonicalize(df: DataFrame, years: tuple[int, int] = (1970, 2035)) -> DataFrame:
    """The canonical columns from their first alias present, missing ones as typed nulls, other columns kept.

    Where both depth and temperature have a source, rows that lack either go; then the year window applies.
    """
    found = {k: resolve_alias(df.columns, a) for k, a in ALIASES.items()}
    used = {c for c in found.values() if c}

    def typed(k: str) -> Column:
        if not found[k]:
            return F.lit(None).cast(KINDS[k]).alias(k)
        if KINDS[k] == "double":
            return finite(found[k]).alias(k)
        x = F.col(found[k])
        return (F.try_to_timestamp(x.cast("string")).cast("timestamp_ntz") if k == "fecha" else x.cast("string")).alias(k)

    extras = [c for c in df.columns if c not in used and c.lower() not in ALIASES]
    out = df.select(*[typed(k) for k in ALIASES], *extras)
    if found["profundidad_m"] and found["temperatura_c"]:
        out = out.dropna(subset=["profundidad_m", "temperatura_c"])
    return filter_year_window(out, "fecha", *years)


def ensure_depth(df: DataFrame) -> DataFrame:
    """``profundidad_m`` from the first depth alias if it isn't there."""
    found = resolve_alias(df.columns, DEPTH)
    return df if "profundidad_m" in df.columns or not found else df.withColumn("profundidad_m", finite(found))


def tag_lineage(df: DataFrame, run_id: str, source: Column) -> DataFrame:
    return df.withColumn("run_id", F.lit(run_id)).withColumn("source_file", source)


def row_id(df: DataFrame, source: list[str], order: list[str]) -> DataFrame:
    """A 0-based index inside each source, in its own order."""
    return df.withColumn("row_id", (F.row_number().over(Window.partitionBy(*source).orderBy(*order)) - 1).cast("long"))


def synthesize_date(df: DataFrame, date: str | None = None, year: str | None = None, month: str | None = None) -> DataFrame:
    """``fecha``: the date itself; else year and month on the 15th; else the year on 15 June; without any of these columns
    15 June of the year that the first column with one holds (see ``probe_year``); null without such a column."""
    if not (date or year):
        found = probe_year(df)
        if found is None:
            return df.withColumn("fecha", F.lit(None).cast("timestamp_ntz"))
        held = F.regexp_extract(F.col(f"`{found}`").cast("string"), YEAR, 0).try_cast("int")
        return df.withColumn("fecha", F.make_date(held, F.lit(6), F.lit(15)).cast("timestamp_ntz"))
    parts = []
    if date:
        parts.append(F.try_to_timestamp(F.col(date).cast("string")).cast("timestamp_ntz"))
    y = F.col(year).try_cast("int") if year else None
    if year and month:
        parts.append(F.when(F.col(month).try_cast("int").between(1, 12), F.make_date(y, F.col(month).try_cast("int"), F.lit(15))).cast("timestamp_ntz"))
    if year:
        parts.append(F.make_date(y, F.lit(6), F.lit(15)).cast("timestamp_ntz"))
    return df.withColumn("fecha", F.coalesce(*parts))


def probe_year(df: DataFrame) -> str | None:
    """The first column with a value that holds a year from 1900 to 2099; one aggregation over all columns."""
    columns = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "binary"))]
    if not columns:
        return None
    hits = df.agg(*[F.count_if(F.col(f"`{c}`").cast("string").rlike(YEAR)).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return next((c for i, c in enumerate(columns) if hits[i]), None)


def cast_key(df: DataFrame, hints: tuple[str, ...] = ("acronimo", "cast", "est", "estacion"), source: str = "source_file", row: str = "row_id", day: str | None = None) -> DataFrame:
    """``cast_key``: the first hint with a value, else the day of a date column (``day``), else the source and row."""
    found = [F.col(h).cast("string") for h in hints if h in df.columns]
    if day:
        found.append(F.date_format(day, "yyyy-MM-dd"))
        if source not in df.columns or row not in df.columns:
            return df.withColumn("cast_key", F.coalesce(*found))
    return df.withColumn("cast_key", F.coalesce(*found, F.concat_ws("_", F.col(source).cast("string"), F.col(row).cast("string"))))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The table itself; ValueError lists what it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; present: {', '.join(df.columns)}")
    return df


def impute_median(df: DataFrame, features: list[str], strata: list[str] = ()) -> DataFrame:
    """Nulls and NaN replaced by the stratum's median of the feature, by 0 where it has none.

    Medians are counted out (see ``quantiles``) before they meet the rows, so a stratum with most of the rows is no single task.
    """
    mid = quantiles(df, list(strata), {f"_m_{c}": finite(c) for c in features}, 0.5)
    out = joined(df, list(strata), mid)
    return out.withColumns({c: F.coalesce(finite(c), F.col(f"_m_{c}"), F.lit(0.0)) for c in features}).drop(*[f"_m_{c}" for c in features])


def limit_sources(files: DataFrame, n: int, path: str = "path") -> DataFrame:
    """The first n files by path."""
    return files.orderBy(path).limit(n)


def filter_station(df: DataFrame, station: int, column: str = "station") -> DataFrame:
    return df.where(F.col(column) == station)
