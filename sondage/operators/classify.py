"""Classification of files and rows by codes, positions, keywords and names; scoping; station mapping."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.functions.text import STATION_FOLDER, explain_year, extract, normalize_text, once
from sondage.scratch import written

UNKNOWN = "desconocida"
# Station codes, keywords and prefixes of the sites.
CODES = {
    "vigo": ("E15VI", "E1VI", "E3VI"),
    "coruna": ("EPCO", "E4CO", "E3BCO", "E3CCO", "E3ACO", "E2TCO", "E2CO", "I1CO"),
    "cudillero": ("E1CU", "E2CU", "E3CU"),
    "gijon": ("E1GI", "E2GI", "E3GI", "E4GI"),
    "santander": ("E2SA", "E3SA", "E4SA", "E5SA", "E6SA", "E7SA", "E8SA", "AGL"),
}
LABELS = {"cudillero": "Cudillero", "gijon": "Gijón", "santander": "Santander", "coruna": "A Coruña", "vigo": "Vigo", "desconocida": "Sin clasificar"}
ALIASES = {"cuideiru": "cudillero", "xixon": "gijon"}
KEYWORDS = (
    ("cudillero", ("cudillero", "cuideiru", "radial cud", "rad. cud")),
    ("gijon", ("gijon", "gij\x95n", "xixon", "radial gij", "radial de gij", "jureva")),
    ("santander", ("santander", "santand", "sanatnder", "sanatander", "rad san", "radsan")),
    ("vigo", ("vigo", "radial vi", "rad vi")),
    ("coruna", ("coru", "coruna", "la coru", "a coru")),
)
CAMPAIGN = r"(?i)rcan|radcan|radial_can|radprof|radiales?\s+cant[aá]bric"
MONTH_NAME = r"(?i)^([a-z]{0,2})(?:jan|feb|mar|apr|may|jun|jul|ago|sep|oct|nov|dic|ene)\d"
MONTH_PREFIX = {"g": "gijon", "s": "santander"}
STATION_PREFIX = (("CO", "coruna"), ("C", "cudillero"), ("G", "gijon"), ("S", "santander"), ("V", "vigo"))
#: Bytes of the codes of one automaton (some fifty times as much in memory).
CATALOG_BYTES = 4 << 20
BBOX = ((43.2, 43.95), (-6.5, -3.0))


def pairs(catalog: dict[str, tuple[str, ...]] = CODES) -> list[tuple[str, str]]:
    """(code, id), the longest code first, equal lengths in catalog order."""
    return sorted(((c.upper(), k) for k, codes in catalog.items() for c in codes), key=lambda p: -len(p[0]))


def identify_by_code(text: Column, catalog: dict[str, tuple[str, ...]] = CODES) -> Column:
    """The id of the longest code that the text contains, whatever its case."""
    return once(F.upper(F.trim(text)), lambda up: F.coalesce(*[F.when(F.contains(up, F.lit(code)), F.lit(k)) for code, k in pairs(catalog)]))


def longest_codes(df: DataFrame, text: str, key: str, codes: DataFrame) -> DataFrame:
    """``key, code``: of every text the longest of the ``codes`` (upper case) that it contains, all of them if several are as long.

    An Aho-Corasick automaton finds all codes in one pass over a text, whatever their number, and texts aren't shuffled. Codes
    are dealt by a hash into automata of about ``CATALOG_BYTES``, one job each, so driver and tasks hold one of them.
    """
    size = codes.agg(F.sum(F.octet_length("code"))).first()[0] or 0
    shards, kind, out = -(-size // CATALOG_BYTES), df.schema[key].dataType.simpleString(), []
    rows = df.select(key, F.upper(F.trim(F.col(text))).alias("_text")).where("_text is not null")
    for i in range(shards):
        words = [r[0] for r in codes.where(F.pmod(F.xxhash64("code"), F.lit(shards)) == i).select("code").collect()]
        shared = df.sparkSession.sparkContext.broadcast(words)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = ahocorasick.Automaton()
            for word in shared.value:
                automaton.add_word(word, word)
            automaton.make_automaton()
            for rb in batches:
                at, best = [], []
                for row, t in enumerate(rb.column("_text").to_pylist()):
                    found, most = set(), 1
                    for _, word in automaton.iter(t) if shared.value else ():
                        if len(word) > most:
                            found, most = {word}, len(word)
                        elif len(word) == most:
                            found.add(word)
                    at += [row] * len(found)
                    best += found
                yield pa.RecordBatch.from_arrays([rb.column(key).take(pa.array(at, pa.int64())), pa.array(best, pa.string())], names=[key, "code"])

        out.append(written(rows.mapInArrow(run, f"`{key}` {kind}, code string"), "codes"))
        shared.unpersist()
    if not out:
        return rows.select(key, F.lit("").alias("code")).limit(0)
    return reduce(DataFrame.unionByName, out)


def one_id_a_code(catalog: DataFrame) -> DataFrame:
    """``code, id``: a row for each upper-case code that isn't empty, with its smallest id; many ids of one code would multiply its texts."""
    known = catalog.select(F.upper("code").alias("code"), "id").where("code <> ''")
    return known.groupBy("code").agg(F.min(F.struct("id"))["id"].alias("id"))


def identify_by_catalog(df: DataFrame, text: str, key: str, catalog: DataFrame) -> DataFrame:
    """``key, id`` by a catalog table (``code, id``) of any size over texts of any length: the longest code that a text contains, whatever
    its case, wins (of equally long ones the smallest id); texts without one, and empty codes, give nothing."""
    known = one_id_a_code(catalog)
    rows = longest_codes(df, text, key, known.select("code")).join(known, "code")
    return rows.groupBy(key).agg(F.min_by("id", F.struct((-F.length("code")).alias("a"), F.col("id"))).alias("id"))


def classify_by_position(lat: Column, lon: Column) -> Column:
    """Ordered bands of longitude inside the region; null outside."""
    inside = lat.between(43.15, 44.7) & lon.between(-9.5, -2.5)
    band = F.when((lon <= -7.5) & lat.between(43.05, 44.35), "coruna").when(lon <= -6.0, "cudillero").when(lon <= -4.85, "gijon").otherwise("santander")
    return F.when(inside, band)


def classify_by_keywords(text: Column, aliases: dict[str, str] = ALIASES, keywords: tuple = KEYWORDS, normal: bool = False) -> Column:
    """The alias the normalised text contains, else the first list with a word in it; ``normal``: the text is normalised already."""

    def found(t: Column) -> Column:
        alias = [F.when(F.contains(t, F.lit(a)), F.lit(k)) for a, k in aliases.items()]
        return F.coalesce(*alias, *[F.when(reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words]), F.lit(k)) for k, words in keywords])

    return once(text if normal else normalize_text(text), found)


def campaign_flag(text: Column) -> Column:
    """A campaign name without any site's keyword."""
    return F.coalesce(text.rlike(CAMPAIGN), F.lit(False)) & classify_by_keywords(text).isNull()


def classify_by_filename(stem: Column, bare_month: str = "cudillero") -> Column:
    """By code; else campaigns are null; else by the letter before a month, a bare month being the default site."""

    def named(stem: Column) -> Column:
        by_month = once(F.lower(F.regexp_extract(stem, MONTH_NAME, 1)), lambda prefix: F.coalesce(*[F.when(prefix == p, F.lit(k)) for p, k in MONTH_PREFIX.items()], F.when(prefix == "", F.lit(bare_month))))
        return F.coalesce(identify_by_code(stem), F.when(~F.lower(stem).startswith("rcan") & stem.rlike(MONTH_NAME), by_month))

    return once(stem, named)


def classify_by_station_prefix(station: Column, is_campaign: Column) -> Column:
    """Only for campaigns: the site of the station's leading letters, two before one."""
    up = F.upper(F.trim(station))
    return F.when(is_campaign, F.coalesce(*[F.when(F.startswith(up, F.lit(p)), F.lit(k)) for p, k in STATION_PREFIX]))


def folder_rule(path: Column) -> Column:
    """A parent folder ``St.N CNVs`` is the default site's."""
    return F.when(path.rlike(r"(?i)(^|/)st\.\s*\d+\s+cnvs/[^/]*$"), F.lit("cudillero"))


def in_bbox(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(*BBOX[0]) & lon.between(*BBOX[1]), F.lit(False))


def classify_detailed(df: DataFrame, path: str, cruise: str, lat: str, lon: str, station: str, out: str = "cls") -> DataFrame:
    """Adds a struct ``radial_id, rule, campana, cruise_radial, geo_radial, conflict``: folder; without a cruise, file name, then
    position; the cruise unless it conflicts with the position, which then wins; file name; box; station prefix of
    campaigns; unknown. Each part is a column of its own first, so the cascade stays small."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    df = df.withColumn("_norm", normalize_text(F.col(cruise)))
    df = df.withColumns(
        {"_cruise": classify_by_keywords(F.col("_norm"), normal=True), "_geo": classify_by_position(F.col(lat), F.col(lon)), "_name": classify_by_filename(stem), "_folder": folder_rule(F.col(path)), "_blank": F.coalesce(F.trim(cruise) == "", F.lit(True)), "_like": F.coalesce(F.col(cruise).rlike(CAMPAIGN), F.lit(False))}
    )
    df = df.withColumns({"_campaign": F.col("_like") & F.col("_cruise").isNull(), "_conflict": F.coalesce(F.col("_cruise") != F.col("_geo"), F.lit(False))})
    df = df.withColumn("_prefix", classify_by_station_prefix(F.col(station), F.col("_campaign")))
    steps = [
        (F.col("_folder").isNotNull(), F.col("_folder"), "folder"), (F.col("_blank") & F.col("_name").isNotNull(), F.col("_name"), "filename"), (F.col("_cruise").isNotNull() & ~F.col("_conflict"), F.col("_cruise"), "cruise"),
        (F.col("_geo").isNotNull(), F.col("_geo"), "geo"), (F.col("_name").isNotNull(), F.col("_name"), "filename"), (in_bbox(F.col(lat), F.col(lon)), F.lit("cudillero"), "bbox"), (F.col("_prefix").isNotNull(), F.col("_prefix"), "station_prefix"),
    ]
    first = F.coalesce(*[F.when(cond, F.struct(value.alias("radial_id"), F.lit(tag).alias("rule"))) for cond, value, tag in steps], F.struct(F.lit(None).cast("string").alias("radial_id"), F.lit("unknown").alias("rule")))
    df = df.withColumn("_first", first)
    cls = F.struct("_first.radial_id", "_first.rule", F.col("_campaign").alias("campana"), F.col("_cruise").alias("cruise_radial"), F.col("_geo").alias("geo_radial"), F.col("_conflict").alias("conflict"))
    return df.withColumn(out, cls).drop("_norm", "_cruise", "_geo", "_name", "_folder", "_blank", "_like", "_campaign", "_conflict", "_prefix", "_first")


def scope_files(files: DataFrame, target: str, rid: str = "radial_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, skipped with reason, counts by id with unknown ones named)."""
    same = F.coalesce(F.col(rid) == target, F.lit(False))
    reason = F.when(F.col(rid).isNull(), "unclassified").otherwise(F.concat(F.lit("belongs to "), F.col(rid)))
    return files.where(same), files.where(~same).withColumn("reason", reason), files.groupBy(F.coalesce(rid, F.lit(UNKNOWN)).alias(rid)).agg(F.count(F.lit(1)).alias("n"))


def classify_by_reference(rows: DataFrame, source: str, files: DataFrame) -> DataFrame:
    """``radial_id`` of the first file by path whose name is the row's source, else of the bare name. ``files``: path, radial_id."""
    leaf = lambda c: F.lower(F.element_at(F.split(c, "/"), -1))
    known = files.groupBy(leaf(F.col("path")).alias("_leaf")).agg(F.min_by(F.struct("radial_id"), "path").alias("_c"))
    out = rows.withColumn("_leaf", leaf(F.col(source))).join(known, "_leaf", "left")
    bare = classify_by_filename(F.regexp_replace(F.element_at(F.split(F.col(source), "/"), -1), r"\.[^.]*$", ""))
    return out.withColumn("radial_id", F.when(F.col("_c").isNotNull(), F.col("_c.radial_id")).otherwise(bare)).drop("_leaf", "_c")


def first_matching(df: DataFrame, hints: list[str], found: dict[str, Column]) -> str | None:
    """The first hint column in which any row matches; one aggregation over all of them."""
    present = [h for h in hints if h in df.columns]
    if not present:
        return None
    counts = df.agg(*[F.count(found[h]).alias(h) for h in present]).first()
    return next((h for h in present if counts[h]), None)


def attach_class(df: DataFrame, hints: tuple[str, ...] = ("acronimo", "cast"), rid: str = "radial_id", files: DataFrame | None = None, source: str = "source_file") -> DataFrame:
    """Fills a missing or all-null id column: by the row's source (see ``classify_by_reference``; ``files`` may be missing), and
    only if that tells no row's class by codes in the first hint column with any match."""
    if rid in df.columns and df.where(F.col(rid).isNotNull()).limit(1).count():
        return df
    if source in df.columns:
        known = files if files is not None else df.sparkSession.createDataFrame([], "path string, radial_id string")
        told = classify_by_reference(df.drop(rid), source, known).withColumnRenamed("radial_id", rid)
        if told.where(F.col(rid).isNotNull()).limit(1).count():
            return told
    found = {h: identify_by_code(F.col(h)) for h in hints if h in df.columns}
    best = first_matching(df, list(hints), found)
    return df.withColumn(rid, found[best] if best else F.lit(None).cast("string"))


def filter_to_class(df: DataFrame, target: str, default: str = "cudillero", rid: str = "radial_id") -> tuple[DataFrame, DataFrame]:
    """(rows of the class, one row with the dropped count); a table without ids passes whole for the default site."""
    if rid not in df.columns:
        df = attach_class(df, rid=rid)
    if target == default and not df.where(F.col(rid).isNotNull()).limit(1).count():
        return df, df.limit(0).agg(F.count(F.lit(1)).alias("dropped"))
    same = F.coalesce(F.col(rid) == target, F.lit(False))
    return df.where(same), df.agg(F.count_if(~same).alias("dropped"))


def scope_rows(rows: DataFrame, files: DataFrame, source: str = "source_file", rid: str = "radial_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose id is their file's, or is null, or whose file has none; per file kept, dropped and ``is_error`` if none is left)."""
    joined = rows.join(files.select(F.col("path").alias(source), F.col("radial_id").alias("_file")), source, "left")
    keep = F.coalesce(F.col(rid) == F.col("_file"), F.lit(True))
    counts = joined.groupBy(source).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))
    return joined.where(keep).drop("_file"), counts.withColumn("is_error", F.col("kept") == 0)


def _station_in(text: Column, codes: tuple[str, ...]) -> Column:
    return once(F.upper(text), lambda up: F.coalesce(*[F.when(F.contains(up, F.lit(c)), F.lit(i)) for i, c in enumerate(codes, 1)]))


def resolve_station(codes: tuple[str, ...], hints: list[Column], folder_number: Column, header_number: Column) -> Column:
    """1-based index of the first catalog code in the hints, in their order; else the folder's number; else the header's in range."""
    inside = lambda n: F.when(n.between(1, len(codes)), n)
    return F.coalesce(*[_station_in(h, codes) for h in hints], inside(folder_number), inside(header_number))


def apply_station(df: DataFrame, codes: tuple[str, ...], hints: list[str], number: str, out: str = "estacion_canonica") -> DataFrame:
    """Station index by the first hint *column* with any match; where it has none, the station number if in range."""
    found = {h: _station_in(F.col(h), codes) for h in hints if h in df.columns}
    best = first_matching(df, hints, found)
    n = F.col(number).try_cast("int")
    return df.withColumn(out, F.coalesce(*([found[best]] if best else []), F.when(n.between(1, len(codes)), n)))


def station_options(df: DataFrame, n: int, column: str = "estacion_canonica") -> DataFrame:
    return df.select(column).distinct().where(F.col(column).between(1, n)).orderBy(column)


def station_names(df: DataFrame, codes: tuple[str, ...], column: str = "estacion_canonica") -> DataFrame:
    """``station_name``: the code at the index, else ``Estacion n``."""
    name = F.coalesce(F.get(F.array(*map(F.lit, codes)), F.col(column).cast("int") - 1), F.concat(F.lit("Estacion "), F.col(column).cast("string")))
    return df.withColumn("station_name", name)


def station_code(number: Column, codes: tuple[str, ...]) -> Column:
    """The code of a header's station number: the first code ``E<number>`` and a letter, else the one at that position."""
    named = [(int(m[1]), c.upper()) for c in codes if (m := re.match(r"(?i)E(\d+)[A-Z]", c.strip()))]
    first = [F.when(number == n, F.lit(c)) for n, c in named]
    return F.coalesce(*first, F.get(F.array(*[F.lit(c.upper()) for c in codes]), number.cast("int") - 1))


def site_label(rid: Column) -> Column:
    """The name of a site's id; ids without one as they are."""
    return F.coalesce(*[F.when(rid == k, F.lit(v)) for k, v in LABELS.items()], rid)


def file_audit(files: DataFrame, path: str = "path", cruise: str = "cruise", station: str = "station", iso: str = "start_iso", cls: str = "cls") -> DataFrame:
    """One row a file: path, name and folder, cruise raw and normalised, the class by cruise, alias, position and in all with its
    rule and conflict, the station of the header and of the folder, and where its year comes from. ``files`` carries ``cls``
    (see ``classify_detailed``)."""
    p, c = F.col(path), F.col(cruise)
    parts = F.split(p, "/")
    folder = F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - 2))
    normal = normalize_text(c)
    alias = F.coalesce(*[F.when(F.contains(normal, F.lit(a)), F.lit(k)) for a, k in ALIASES.items()])
    year = explain_year(F.col(iso), p)
    return files.select(
        path, F.element_at(parts, -1).alias("file"), folder.alias("parent_folder"), F.substring(c, 1, 200).alias("cruise_raw"), F.substring(normal, 1, 200).alias("cruise_normalized"), F.col(f"{cls}.cruise_radial").alias("cruise_radial"), alias.alias("alias_radial"),
        F.col(f"{cls}.geo_radial").alias("geo_radial"), F.col(f"{cls}.radial_id").alias("radial_id"), F.col(f"{cls}.rule").alias("rule"), F.col(f"{cls}.campana").alias("campana"), F.col(f"{cls}.conflict").alias("conflict"), F.col(station).alias("station"),
        extract(folder, STATION_FOLDER).try_cast("int").alias("station_folder"), year["header_year"].alias("header_year"), year["path_year"].alias("path_year"), year["file_year"].alias("file_year"), year["applied_year"].alias("applied_year"), year["rule"].alias("year_rule"),
    )


def conflict_audit(files: DataFrame, most: int = 15) -> tuple[DataFrame, DataFrame]:
    """(files by id and cruise; the ``most`` most frequent unmatched cruises). ``files``: radial_id, cruise."""
    by = files.groupBy("radial_id", "cruise").agg(F.count(F.lit(1)).alias("n"))
    return by, by.where("radial_id is null").orderBy(F.desc("n"), "cruise").limit(most)
