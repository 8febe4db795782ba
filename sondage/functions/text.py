"""Header, path and name expressions: Column to Column, built-ins only."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months as headers name them, English and Spanish, and the patterns of header lines and names.
MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12, "ene": 1, "abr": 4, "ago": 8, "dic": 12}
START_TIME = r"(?im)^#\s*start_time\s*=\s*(\w+)\s+(\d+)\s+(\d{4})\s+(\d{1,2}):(\d{2}):(\d{2})"
STATION = r"(?imu)^\*+\s*(?:Station|Estaci[oó]n|N[uú]mero\s+de\s+estaci[oó]n):[ \t]*(.+)$"
STATION_FOLDER = r"(?i)st[.\s_]?(\d+)"
STATION_FILE = r"(?i)st[c\s_]?(\d+)"
HINTS = {
    "cruise": r"(?im)^\*+\s*Cruise:[ \t]*(.*)$",
    "latitude": r"(?im)^\*{2,}\s*Latitude:[ \t]*(.*)$",
    "longitude": r"(?im)^\*{2,}\s*Longitude:[ \t]*(.*)$",
    "nmea_latitude": r"(?im)^\*\s*NMEA Latitude\s*=[ \t]*(.*)$",
    "nmea_longitude": r"(?im)^\*\s*NMEA Longitude\s*=[ \t]*(.*)$",
    "station_field": r"(?im)^\*{2,}\s*Station:[ \t]*(.*)$",
}
# Labels and units of variables.
VARIABLES = {
    "temperatura": ("Temperatura", "°C"),
    "temperatura_c": ("Temperatura", "°C"),
    "salinidad": ("Salinidad", "PSU"),
    "salinidad_psu": ("Salinidad", "PSU"),
    "fluorescencia": ("Fluorescencia", "μg/L"),
    "fluorescencia_cdom": ("Fluorescencia CDOM", "ppb"),
    "fluorescencia_afl": ("Fluorescencia AFL", "μg/L"),
    "par": ("PAR", "μE/m²/s"),
    "oxigeno": ("Oxígeno", "mL/L"),
    "o_100": ("Oxígeno (100 m)", "mL/L"),
    "turbidez_ntu": ("Turbidez", "NTU"),
    "densidad00": ("Densidad", "kg/m³"),
}
# Names of the stations of a coordinate comment, by the number of stations in it.
STATION_NAMES = {4: ["E1 · Costa", "E2 · Plataforma", "E3 · Talud", "E4 · Talud profundo"], 3: ["E1CU", "E2CU", "E3CU"]}
PENDING = "<p>Texto de metodología pendiente"


def _decomposed() -> tuple[str, str, dict[str, str]]:
    """Characters that compatibility decomposition makes one other, those others, and letters that it makes several."""
    one, other, several = [], [], {}
    for cp in range(0x80, 0xFFFF):
        c = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c:
            one.append(c)
            other.append(base)
        elif len(base) > 1 and unicodedata.name(c, "").startswith("LATIN"):
            several[c] = base
    return "".join(one), "".join(other), several


COMPOSED, BASES, LIGATURES = _decomposed()


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)``, with ``x`` evaluated once however often ``f`` names it (a column expression is otherwise evaluated wherever it stands)."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def extract(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null where nothing or nothing but blanks matches."""
    return blank_to_null(F.regexp_extract(x, pattern, group))


def header_part(text: Column) -> Column:
    """What stands before the ``*END*`` line; the whole text without one."""
    return F.element_at(F.split(text, r"(?im)^\*END\*\s*$", 2), 1)


def header_columns(head: Column) -> Column:
    """Names of the ``# name N = var: ...`` lines in lower case, in order; null without any."""
    names = F.regexp_extract_all(head, F.lit(r"(?im)^#\s+name\s+\d+\s*=\s*(.+?)\s*:"), F.lit(1))
    return F.when(F.size(names) > 0, F.transform(names, F.lower))


def has_start_time(head: Column) -> Column:
    return F.coalesce(F.regexp_like(head, F.lit(START_TIME)), F.lit(False))


def parse_start_time(head: Column) -> Column:
    """The first start_time as an ISO string; null for unknown months."""
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    padded = lambda x, n=2: F.lpad(x, n, "0")

    def iso(line: Column) -> Column:  # the one line, so that its parts aren't searched in the whole header
        part = lambda i: F.regexp_extract(line, START_TIME, i)
        month = F.try_element_at(months, F.lower(F.substring(part(1), 1, 3)))
        return F.when(month.isNotNull(), F.concat(padded(part(3), 4), F.lit("-"), padded(month.cast("string")), F.lit("-"), padded(part(2)), F.lit("T"), padded(part(4)), F.lit(":"), part(5), F.lit(":"), part(6)))

    return once(F.regexp_extract(head, START_TIME, 0), iso)


def two_digit_year(y: Column) -> Column:
    """From 80 on in the 20th century, below in the 21st."""
    return F.when(y >= 80, y + 1900).otherwise(y + 2000)


def year_from_path(path: Column, low: int = 1950, high: int = 2035) -> Column:
    """The first path segment that is a year between the bounds."""
    segments = F.filter(F.split(path, "/"), lambda s: s.rlike(r"^\d{4}$"))
    years = F.filter(F.transform(segments, lambda s: s.try_cast("int")), lambda y: y.between(low, high))
    return F.get(years, F.lit(0))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def year_from_filename(stem: Column) -> Column:
    """Two digits at the end, after a month if there is one."""
    months = "|".join(MONTHS)
    return two_digit_year(F.coalesce(extract(stem, rf"(?i)(?:{months})(\d{{2}})$"), extract(stem, r"(\d{2})$")).try_cast("int"))


def reconcile_year(iso: Column, path: Column) -> Column:
    """The timestamp with its year replaced by the path's, else the file name's; impossible dates become null."""
    year = F.coalesce(year_from_path(path), year_from_filename(file_stem(path)))
    spliced = once(year, lambda y: F.when(y.isNull(), iso).otherwise(F.concat(F.lpad(y.cast("string"), 4, "0"), F.substring(iso, 5, 40))))
    return F.try_to_timestamp(spliced)


def explain_year(iso: Column, path: Column) -> Column:
    """Header, path, file and applied year, and the rule that chose: path, filename, header_only or none."""
    head, p, f = F.substring(iso, 1, 4).try_cast("int"), year_from_path(path), year_from_filename(file_stem(path))
    rule = F.when(head.isNull(), "none").when(p.isNotNull(), "path").when(f.isNotNull(), "filename").otherwise("header_only")
    return F.struct(head.alias("header_year"), p.alias("path_year"), f.alias("file_year"), F.when(head.isNotNull(), F.coalesce(p, f, head)).alias("applied_year"), rule.alias("rule"))


def station_number(head: Column, path: Column) -> Column:
    """The first integer of the station line, else of the parent folder, else of the file name."""
    folder = F.element_at(F.split(path, "/"), -2)
    parts = F.split(path, "/")
    folder = F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - 2))
    number = lambda x, p: extract(x, p).try_cast("int")
    return F.coalesce(number(extract(head, STATION), r"(\d+)"), number(folder, STATION_FOLDER), number(file_stem(path), STATION_FILE))


def header_hints(head: Column) -> Column:
    """Cruise, position (own lines before NMEA ones) in text and degrees, and station field; the last line of a kind wins."""
    last = lambda k: blank_to_null(F.try_element_at(F.regexp_extract_all(head, F.lit(HINTS[k]), F.lit(1)), F.lit(-1)))
    lat, lon = F.coalesce(last("latitude"), last("nmea_latitude")), F.coalesce(last("longitude"), last("nmea_longitude"))
    return F.struct(
        F.coalesce(last("cruise"), F.lit("")).alias("cruise"), lat.alias("latitude"), lon.alias("longitude"), dms_to_degrees(lat, "NS").alias("lat_deg"), dms_to_degrees(lon, "EW").alias("lon_deg"), last("station_field").alias("station_field")
    )


def dms_to_degrees(x: Column, axis: str = "NSEW") -> Column:
    """Up to three numbers as degrees, minutes and seconds, summed with their signs; S or W negates the sum. Anything but letters,
    digits, points, signs and blanks counts as a blank, a comma too, and the ``axis``' letters go; null if one of the first three
    words is then no number, or there is none."""
    number = lambda w: F.when(w.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)(E[+-]?\d+)?$"), w.try_cast("double"))

    def signed(up: Column) -> Column:
        words = F.slice(F.filter(F.split(F.translate(up, axis, ""), r"\s+"), lambda w: w != ""), 1, 3)
        sign = F.when(up.rlike("[" + "".join(c for c in axis if c in "SW") + "]"), -1.0).otherwise(1.0)
        return once(F.transform(words, number), lambda n: degrees(n, sign))

    def degrees(n: Column, sign: Column) -> Column:
        at = lambda i: F.coalesce(F.get(n, F.lit(i)), F.lit(0.0))
        return F.when((F.size(n) > 0) & ~F.exists(n, lambda v: v.isNull()), sign * (at(0) + at(1) / 60 + at(2) / 3600))

    return once(F.regexp_replace(F.upper(F.trim(x)), r"[^0-9A-Z\s.+-]", " "), signed)


def strip_accents(x: Column) -> Column:
    """Characters as their bases by compatibility decomposition, combining marks left out; Latin ligatures as their letters."""
    letters = F.create_map(*[F.lit(y) for pair in LIGATURES.items() for y in pair])

    def whole(plain: Column) -> Column:
        return F.array_join(F.transform(F.split(plain, ""), lambda c: F.coalesce(F.try_element_at(letters, c), c)), "")

    bare = once(F.translate(F.regexp_replace(x, r"\p{Mn}+", ""), COMPOSED, BASES), lambda p: F.when(p.rlike("[" + "".join(LIGATURES) + "]"), whole(p)).otherwise(p))
    return F.when(x.rlike(r"[^\x00-\x7F]"), bare).otherwise(x)  # plain ASCII stays


def normalize_text(x: Column) -> Column:
    """Without accents, in lower case, blanks collapsed."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(x)), r"\s+", " "))


def path_shard(path: Column, root: str = "") -> Column:
    """The first segment under the root."""
    return F.split_part(F.regexp_replace(path, "^" + root + "/?", ""), F.lit("/"), F.lit(1))


def is_year_shard(segment: Column) -> Column:
    return segment.rlike(r"^\d{4}$")


def file_label(path: Column, root: str = "") -> Column:
    """``YYYY/name`` under a year folder, else the path under the root."""
    rel = F.regexp_replace(path, "^" + root + "/?", "")
    shard = F.split_part(rel, F.lit("/"), F.lit(1))
    return F.when(is_year_shard(shard), F.concat_ws("/", shard, F.element_at(F.split(rel, "/"), -1))).otherwise(rel)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def artifact_slug(key: Column, stem: Column) -> Column:
    """12 hexadecimal digits of the key's hash and at most 80 characters of the stem, blanks as underscores."""
    return F.concat(F.substring(F.sha2(key, 256), 1, 12), F.lit("_"), F.substring(F.replace(stem, F.lit(" "), F.lit("_")), 1, 80))


def header_has_any(names: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, wanted))), F.lit(False))


def normalize_column_name(name: Column) -> Column:
    """Without blanks, byte order mark and quotes round it, in lower case."""
    return F.lower(F.regexp_replace(name, "^[\\s﻿\"']+|[\\s\"']+$", ""))


def infer_kind(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.rlike("temp"), "temperature").when(low.rlike("sal"), "salinity").otherwise("other")


def var_meta(name: Column) -> Column:
    """(label, unit) of a variable name by ``VARIABLES``; unknown names in title case, without a unit."""
    key = F.lower(F.trim(name))
    pick = lambda i, other: F.coalesce(*[F.when(key == k, F.lit(v[i])) for k, v in VARIABLES.items()], other)
    return F.struct(pick(0, F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))).alias("label"), pick(1, F.lit("")).alias("unit"))


def reason_label(text: Column, labels: dict[str, str], most: int = 60) -> Column:
    """The label of the first key that the text contains, whatever its case; other texts cut to ``most`` characters."""
    low, out = F.lower(text), F.substring(text, 1, most)
    for part, label in reversed(list(labels.items())):
        out = F.when(F.contains(low, F.lit(part.lower())), F.lit(label)).otherwise(out)
    return out


def coords_from_docs(text: Column) -> Column:
    """Station coordinates in a methodology text, ``station, lat_deg, lon_deg, name`` structs: a comment
    ``<!-- E1 lat lon | E2 lat lon | ... -->`` of four stations, else of three, else points
    ``**Estación N · name** (43°34.5' N, 5°37.0' W`` by number. A text that is still to be written, and a null one, has none."""
    number = r"\s+([\d.]+)\s+([-\d.]+)\s*"

    def comment(n: int) -> Column:
        pattern = r"<!--\s*" + r"\|\s*".join(f"E{i}{number}" for i in range(1, n + 1)) + "-->"
        part = lambda i: F.regexp_extract(text, pattern, i).try_cast("double")
        rows = [F.struct(F.lit(i + 1).alias("station"), part(2 * i + 1).alias("lat_deg"), part(2 * i + 2).alias("lon_deg"), F.lit(STATION_NAMES[n][i]).alias("name")) for i in range(n)]
        return F.when(text.rlike(pattern), F.array(*rows))

    # Fixed value: the form of a station's heading
    point = r"(?iu)\*\*Estación\s+(\d+)\s*·\s*([^*]+)\*\*\s*\(\s*(\d+)°\s*([\d.]+)\s*['′´]\s*N\s*,\s*(\d+)°\s*([\d.]+)\s*['′´]\s*W"
    each = lambda i: F.regexp_extract_all(text, F.lit(point), F.lit(i))
    points = F.transform(
        F.arrays_zip(*[each(i).alias(f"p{i}") for i in range(1, 7)]),
        lambda s: F.struct(
            s["p1"].cast("int").alias("station"), (s["p3"].cast("double") + s["p4"].cast("double") / 60).alias("lat_deg"), (-(s["p5"].cast("double") + s["p6"].cast("double") / 60)).alias("lon_deg"),
            F.concat(F.lit("E"), s["p1"].cast("int").cast("string"), F.lit(" · "), F.trim(s["p2"])).alias("name"),
        ),
    )
    found = F.coalesce(comment(4), comment(3), F.array_sort(points, lambda a, b: a["station"] - b["station"]))
    return F.when(~F.contains(text, F.lit(PENDING)), found)
