"""Readers and writers: header-and-body text profiles, resilient CSV, parts, quarantine and run logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from sondage.functions import text as T
from sondage.operators.canonical import cast_key, probe_year, require_columns, synthesize_date
from sondage.operators.classify import identify_by_code
from sondage.operators.scan import layout
from sondage.scratch import written

PROFILE_GLOB = "*.[cC][nN][vV]"
NULLS = ("", "NA", "NaN", "null")


def list_sources(spark: SparkSession, root: str, glob: str = PROFILE_GLOB) -> DataFrame:
    """Files under a root by suffix, whatever its case: ``path, length, mtime``; content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("mtime"))


def file_table(spark: SparkSession, root: str, glob: str = PROFILE_GLOB) -> DataFrame:
    """The file-grain table all classification reads: ``path, length, mtime, names, has_start_time, start_time, station, hints``.

    One pass over the content takes out every header fact; persist or write it, and no file is opened again.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    head = T.header_part(F.decode("content", "ISO-8859-1"))
    files = files.select("path", "length", F.col("modificationTime").alias("mtime"), head.alias("head"))
    iso = T.parse_start_time(F.col("head"))
    return files.select(
        "path", "length", "mtime", T.header_columns(F.col("head")).alias("names"), T.has_start_time(F.col("head")).alias("has_start_time"), iso.alias("start_iso"),
        T.reconcile_year(iso, F.col("path")).alias("start_time"), T.station_number(F.col("head"), F.col("path")).alias("station"), T.header_hints(F.col("head")).alias("hints"),
    )


def _line_values(names: Column, line: Column) -> Column:
    """The map of a body line's numbers by name; null for a line with anything that is no number (a blank or comment line too) and without names."""
    numbers = F.transform(F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " "), lambda x: x.try_cast("double"))
    number = lambda v: F.nanvl(v, F.lit(None).cast("double"))

    def by_name(x: Column) -> Column:
        n = F.least(F.size(names), F.size(x))
        plain = F.map_from_arrays(F.slice(names, 1, n), F.transform(F.slice(x, 1, n), number))
        # equal names: the last one stays, as earlier places of a name that comes again are left out
        places = F.filter(F.sequence(F.lit(1), n), lambda i: ~F.array_contains(F.slice(names, i + 1, F.greatest(n - i, F.lit(0))), F.element_at(names, i)))
        entries = F.transform(places, lambda i: F.struct(F.element_at(names, i).alias("key"), number(F.element_at(x, i)).alias("value")))
        several = F.size(F.array_distinct(names)) < F.size(names)
        return F.when(names.isNotNull() & ~F.exists(x, lambda v: v.isNull()), F.when(several, F.map_from_entries(entries)).otherwise(plain))

    return T.once(numbers, by_name)


def _values(lines: DataFrame) -> DataFrame:
    """``path, line_no, values`` of body lines (``path, names, line_no, line``) that hold nothing but numbers."""
    one = F.array(F.struct("line_no", _line_values(F.col("names"), F.col("line")).alias("values")))
    return lines.select("path", F.inline_outer(one)).where("values is not null")


def parse_profiles(files: DataFrame, content: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of header-and-body texts, one a row. Rows: ``path, line_no, values map<string,double>``.

    Names come from the header in order, lower-case; a line with anything that is no number is dropped, as are blank lines and
    those that start with ``*`` or ``#``; short rows miss their last names, long ones are cut; of equal names the last counts. Errors: files
    without columns or without a valid row.
    """
    whole = files.select("path", content.alias("_text"))
    parts = F.split("_text", r"(?im)^\*END\*[ \t]*\r?$", 2)
    whole = whole.select("path", T.header_columns(T.header_part(F.col("_text"))).alias("names"), F.element_at(parts, -1).alias("body"))
    # an outer generator's rows are made once: a filter on them, here or later, isn't pushed into what makes them
    lines = F.transform(F.split("body", r"\r?\n"), lambda line, i: F.struct(i.alias("line_no"), _line_values(F.col("names"), line).alias("values")))
    rows = whole.select("path", F.inline_outer(lines)).where("values is not null")
    good = rows.select("path").distinct()
    bad = whole.join(good, "path", "left_anti").select("path", F.when(F.col("names").isNull(), "no_columns").when(F.col("body").rlike(r"^\s*$"), "no_data").otherwise("no_valid_rows").alias("error"))
    return rows, bad


def read_profiles_text(spark: SparkSession, root: str, glob: str = PROFILE_GLOB) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of all profile files under a root, as ``parse_profiles`` has them; failures are rows, not exceptions.

    Files are read by lines, so a large one is many tasks. A first pass finds in every block its first line's number, its lines
    and its part of the header; what a file's blocks add up to (one row a file: names, and where the body begins) meets the lines of
    the second pass. Lines are never shuffled by file.
    """
    reader = spark.read.option("encoding", "ISO-8859-1").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    # rows of a block are read one after the other, so their ids count its lines
    lines = reader.text(root).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    end = F.when(F.col("value").rlike(r"(?i)^\*END\*[ \t]*$"), F.col("_id"))
    head = F.when(F.col("value").rlike(r"(?i)^#\s+name\s+\d+\s*="), F.struct("_id", "value"))
    blocks = lines.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.min(end).alias("_end"), F.collect_list(head).alias("_head"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    blocks = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    shifted = F.transform("_head", lambda h: F.struct((h["_id"] + F.col("_start")).alias("at"), h["value"].alias("line")))
    blocks = blocks.select("_file", "_block", "_start", (F.col("_end") + F.col("_start")).alias("_end"), shifted.alias("_head"))
    facts = blocks.groupBy("_file").agg(F.min("_end").alias("_end"), F.sort_array(F.flatten(F.collect_list("_head"))).alias("_head"))
    named = F.filter("_head", lambda h: F.col("_end").isNull() | (h["at"] < F.col("_end")))
    facts = facts.select("_file", F.coalesce("_end", F.lit(-1)).alias("_stop"), T.header_columns(F.array_join(F.transform(named, lambda h: h["line"]), "\n")).alias("names"))
    known = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path", F.col("_metadata.file_path").alias("_file"))
    of_file = known.join(facts, "_file", "left")  # a file without a line has no facts
    numbered = lines.join(blocks.select("_file", "_block", "_start"), ["_file", "_block"]).join(of_file, "_file").withColumn("_no", F.col("_id") + F.col("_start") - F.col("_stop"))
    # without an end line the whole text is the body, whose first line is number 0; after one the first line is number 1
    body = numbered.where("_no > 0").select("path", "names", F.when(F.col("_stop") < 0, F.col("_no") - 1).otherwise(F.col("_no")).cast("int").alias("line_no"), F.col("value").alias("line"))
    rows = _values(body)
    good, filled = rows.select("path").distinct(), body.where(F.trim("line") != "").select("path", F.lit(True).alias("_filled")).distinct()
    bad = of_file.join(good, "path", "left_anti").join(filled, "path", "left")
    return rows, bad.select("path", F.when(F.col("names").isNull(), "no_columns").when(F.col("_filled").isNull(), "no_data").otherwise("no_valid_rows").alias("error"))


def widened(rows: DataFrame, names: list[str]) -> DataFrame:
    """A column for each wanted name of the rows' maps; names that a file lacks are null."""
    return rows.select("path", "line_no", *[F.try_element_at("values", F.lit(n)).alias(n) for n in names])


@dataclass(frozen=True)
class CsvPlan:
    """How a delimited file is read."""

    strategy: str
    sep: str
    quote: str
    encoding: str = "UTF-8"
    mode: str = "PERMISSIVE"


STRATEGIES = (CsvPlan("comma_strict", ",", '"'), CsvPlan("comma_ignore_errors", ",", '"'), CsvPlan("semicolon", ";", '"'), CsvPlan("comma_no_quote", ",", ""))


def _csv(spark: SparkSession, path: str, plan: CsvPlan, places: bool = False) -> DataFrame:
    """The table of a delimited file, all strings; with ``places`` also ``_file`` and ``_block``, where a row was read."""
    reader = spark.read.option("header", True).option("sep", plan.sep).option("quote", plan.quote).option("encoding", plan.encoding).option("mode", plan.mode)
    df = (reader.option("escape", plan.quote) if plan.quote else reader).option("enforceSchema", False).csv(path)
    return _nulled(df, df.columns, [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")] if places else [])


def _nulled(df: DataFrame, columns: list[str], others: list[Column] = ()) -> DataFrame:
    return df.select(*[F.when(~F.trim(F.col(f"`{c}`")).isin(*NULLS), F.col(f"`{c}`")).alias(c) for c in columns], *others)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows of a file source (with ``_file`` and ``_block``) with their 0-based number in the files' own order, whatever
    their splits: the place in a block, which one task reads (or by ``_at``), after the rows of the blocks before it."""
    place = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_at"))
    rows = (df if "_at" in df.columns else df.withColumn("_at", F.monotonically_increasing_id())).withColumn("_place", place)
    sizes = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))  # a row for each block of the files
    before = F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_file", "_block", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, ["_file", "_block"]).withColumn(name, F.col("_start") + F.col("_place") - 1).drop("_file", "_block", "_at", "_place", "_start")


def unquoted(value: Column, sep: str) -> Column:
    """A line without its complete quoted fields. Quotes count at the start of a field alone, doubled ones inside are text; up to
    2000 doubled quotes a field."""
    return F.regexp_replace(value, f'(^|{sep})"[^"]*+(?:""[^"]*+){{0,2000}}+"', "$1")


def left_open(value: Column, sep: str) -> Column:
    """Does a line that starts outside quotes end inside a quoted field?"""
    return unquoted(value, sep).rlike(f'(^|{sep})"')


def n_fields(value: Column, plan: CsvPlan) -> Column:
    rest = unquoted(value, plan.sep) if plan.quote else value
    return F.length(rest) - F.length(F.replace(rest, F.lit(plan.sep))) + 1


def _lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``value, _file`` of the lines of delimited files, without blank ones and each file's header: the CSV reader with a
    separator that no text holds, so that files stay splittable."""
    reader = spark.read.schema("value string, _bad string").option("header", True).option("sep", "\x01").option("quote", "").option("encoding", encoding)
    df = reader.option("columnNameOfCorruptRecord", "_bad").csv(path)
    return df.select(F.coalesce("_bad", "value").alias("value"), F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``value, unclosed, _file, _record`` of the records of quoted files, where quoted fields may span lines; each file's first
    record is its header and left out.

    A line turns the state before it (inside or outside quotes) into the state after it, so lines are functions of two states
    whose composition is a scan: it is taken by pieces (see ``scan``), and a file of any size is read by many tasks. Records of
    one line are never gathered.
    """
    v = F.col("value")
    rows = spark.read.text(path).select(v, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    rows = written(rows.withColumn("_f0", left_open(v, sep)).withColumn("_f1", left_open(F.concat(F.lit('"'), v), sep)), "lines")
    at, swap, fixed = layout(rows, ["_file"], ["_block", "_at"]), F.col("_f0") & ~F.col("_f1"), F.col("_f0") == F.col("_f1")
    at = at.windowed(total={"_swaps": swap.cast("long")})
    at = at.windowed(last={"_fixed": F.when(fixed, F.struct(F.col("_f0").alias("v"), F.col("_swaps").alias("s")))})
    odd = lambda n: n % 2 == 1
    after = F.when(F.col("_fixed").isNull(), odd(F.col("_swaps"))).otherwise(F.col("_fixed.v") != odd(F.col("_swaps") - F.col("_fixed.s")))
    at = at.map(lambda t: t.withColumn("_after", after)).windowed(lag={"_before": F.col("_after")})
    at = at.map(lambda t: t.withColumn("_starts", ~F.coalesce("_before", F.lit(False)))).windowed(total={"_record": F.col("_starts").cast("long")})
    t = written(at.table().select("_file", "_record", "_block", "_at", "value", "_starts", "_after"), "records")
    whole = F.col("_starts") & ~F.col("_after")
    one = t.where(whole & (F.trim("value") != "")).select("value", F.lit(False).alias("unclosed"), "_file", "_record")
    place = F.struct("_block", "_at")
    many = t.where(~whole).groupBy("_file", "_record").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))), lambda x: x["value"]), "\n").alias("value"), F.max_by("_after", place).alias("unclosed"))
    out = one.unionByName(many)
    heads = out.groupBy("_file").agg(F.min("_record").alias("_head"))
    return out.join(heads, "_file").where("_record > _head").drop("_head")


@dataclass(frozen=True)
class CsvSurvey:
    """What a strategy makes of a file: fields of the header, records that are short, that have surplus fields, lines lost to a
    quote that never closes, and whether records span lines."""

    plan: CsvPlan
    width: int
    short: int = 0
    surplus: int = 0
    runaway: int = 0
    spans: bool = False

    @property
    def lost(self) -> int:
        return self.surplus + self.runaway


def survey(spark: SparkSession, path: str, plans: tuple[CsvPlan, ...] = STRATEGIES, encoding: str = "UTF-8") -> list[CsvSurvey]:
    """Every strategy's view of all lines, from one aggregation; where quotes stay open at a line's end, from its records."""
    head = spark.read.option("encoding", encoding).text(path).first()
    if head is None:
        raise ValueError("empty file")
    known, checks, v = {}, {}, F.col("value")
    top = spark.range(1).select(*[n_fields(F.lit(head.value.removeprefix("\ufeff")), p).alias(str(i)) for i, p in enumerate(plans)]).first()
    for i, p in enumerate(plans):
        n = n_fields(v, p)
        key = (p.sep, p.quote)
        known.setdefault(key, top[i])
        checks.setdefault(key, (F.count_if(n < top[i]), F.count_if(n > top[i]), F.count_if(left_open(v, p.sep)) if p.quote else F.lit(0)))
    found = _lines(spark, path, encoding).agg(*[c.alias(f"{i}_{j}") for i, cs in enumerate(checks.values()) for j, c in enumerate(cs)]).first()
    seen = {key: [found[f"{i}_{j}"] for j in range(3)] for i, key in enumerate(checks)}
    out, spanning = [], {}
    for p in plans:
        key = (p.sep, p.quote)
        short, surplus, opens = seen[key]
        if not opens or known[key] <= 1:
            out.append(CsvSurvey(p, known[key], short, surplus))
            continue
        if key not in spanning:
            n, lines = n_fields(v, p), F.length(v) - F.length(F.replace(v, F.lit("\n"))) + 1
            ok = ~F.col("unclosed")
            spanning[key] = records(spark, path, p.sep).agg(F.count_if(ok & (n < known[key])), F.count_if(ok & (n > known[key])), F.coalesce(F.sum(F.when(~ok, lines)), F.lit(0))).first()
        out.append(CsvSurvey(p, known[key], *spanning[key], spans=True))
    return out


def plan_csv(spark: SparkSession, path: str) -> CsvSurvey:
    """The first strategy that loses nothing, among those that see more than one column; the strict one has no short record
    either. If all lose something, the one that loses least."""
    usable = [s for s in survey(spark, path) if s.width > 1 and not (s.plan.strategy == "comma_strict" and (s.lost or s.short))]
    if not usable:
        raise ValueError("at most one column")
    return min(usable, key=lambda s: s.lost)


def read_csv_with_issues(spark: SparkSession, path: str, places: bool = False) -> tuple[DataFrame, str, DataFrame]:
    """(table, strategy, issues) of delimited files with one header each: the columns as strings, nulls of ``NULLS``.

    Every record is a row of the table: a short one has nulls, one with surplus fields its first ones. ``issues`` has these
    records as they stand: ``file, record, reason`` (``missing_fields, surplus_fields, unclosed_quote``). A table of one column is an
    error (ValueError).
    """
    found = plan_csv(spark, path)
    plan, n = found.plan, n_fields(F.col("value"), found.plan)
    columns = _csv(spark, path, plan).columns
    if found.spans:
        rows = records(spark, path, plan.sep)
        fields = F.from_csv("value", ", ".join([f"c{i} string" for i in range(len(columns))]), {"sep": plan.sep, "quote": plan.quote, "escape": plan.quote, "multiLine": "true"})
        flat = rows.select(fields.alias("r"), "_file", "_record").select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)], "_file", (F.col("_record") / 65_536).cast("long").alias("_block"), F.col("_record").alias("_at"))
        df = _nulled(flat, columns, [F.col(c) for c in ("_file", "_block", "_at")] if places else [])
    else:
        rows = _lines(spark, path, plan.encoding).withColumn("unclosed", F.lit(False))
        df = _csv(spark, path, plan, places)
    reason = F.when(F.col("unclosed"), "unclosed_quote").when(n < found.width, "missing_fields").when(n > found.width, "surplus_fields")
    issues = rows.select(F.col("_file").alias("file"), F.col("value").alias("record"), reason.alias("reason")).where("reason is not null")
    return df, plan.strategy, issues


def read_csv_resilient(spark: SparkSession, path: str, places: bool = False) -> tuple[DataFrame, str]:
    """(table, strategy) of ``read_csv_with_issues``."""
    df, strategy, _ = read_csv_with_issues(spark, path, places)
    return df, strategy


def read_delimited_any(spark: SparkSession, path: str) -> tuple[DataFrame | None, str]:
    """(table or None, what was chosen or why not): UTF-8 unless the text holds broken sequences, then ISO-8859-1; the separator
    of comma, semicolon and tab that cuts the header into most columns. What keeps a file from being read (no such path, no
    columns) is returned, not raised; ISO-8859-1 reads any bytes, so no further encoding is tried. Odd lines are counted in what is
    said: those that are short (nulls fill them) and those with surplus fields."""
    try:
        broken = spark.read.text(path).where(F.contains("value", F.lit("\ufffd"))).limit(1).count() > 0
        encoding = "ISO-8859-1" if broken else "UTF-8"
        found = max(survey(spark, path, tuple(CsvPlan("any", sep, '"', encoding) for sep in ",;\t"), encoding), key=lambda s: s.width)
        if found.width <= 1:
            return None, "at most one column"
        odd = [f"{n} {what}" for n, what in ((found.short, "short"), (found.surplus, "with surplus fields"), (found.runaway, "after an open quote")) if n]
        return _csv(spark, path, found.plan), "; ".join([f"{encoding} {found.plan.sep!r}", *odd])
    except (PySparkException, ValueError) as e:
        return None, f"{type(e).__name__}: {e}"[:300] if isinstance(e, PySparkException) else str(e)


def read_radial_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A CSV with plain lower-case names, a date, a cast key and the class of its text codes; ``row_id`` counts the rows in
    the file's order. ValueError if no column tells a date or year."""
    df, _ = read_csv_resilient(spark, path, places=True)
    df = numbered(df.toDF(*[c.strip().strip("﻿\"'").lower() for c in df.columns]), "row_id").withColumn("source_file", F.lit(source))
    pick = lambda *names: next((n for n in names if n in df.columns), None)
    date, year = pick("fecha"), pick("year", "anio", "año")
    if not (date or year) and probe_year(df.drop("row_id", "source_file")) is None:
        raise ValueError(f"no column tells a date or year: {', '.join(df.columns)}")
    own = ["row_id", "source_file"]
    df = synthesize_date(df.select(*[c for c in df.columns if c not in own], *own), date, year, pick("month", "mes"))
    df = cast_key(df)
    return df.withColumn("radial_id", identify_by_code(F.coalesce(F.col("cast_key"), F.col("source_file"))))


def read_parquet_checked(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    return require_columns(spark.read.parquet(path), required)


def read_run_parts(spark: SparkSession, paths: list[str], whole: str | None = None) -> DataFrame:
    """A run's consolidated table (``whole``) where there is one, else all its parts as one table, columns by name."""
    if whole:
        try:
            return spark.read.parquet(whole)
        except PySparkException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return spark.read.option("mergeSchema", True).parquet(*paths)


def write_table(df: DataFrame, path: str, by: list[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*by).parquet(path)


def write_qc_triplet(scored: DataFrame, path: str, flag: str = "is_anomaly", audit: list[str] = ("run_id", "source_file", "row_id", "is_anomaly", "anomaly_score", "threshold", "reason", "top_features")) -> None:
    """Clean and anomalous rows as partitions of one table, and the audit beside them; the scores are computed once."""
    scored.write.mode("overwrite").partitionBy(flag).parquet(f"{path}/rows")
    rows = scored.sparkSession.read.parquet(f"{path}/rows")
    rows.select(*[c for c in audit if c in rows.columns]).write.mode("overwrite").parquet(f"{path}/audit")


def consolidate(*parts: DataFrame) -> DataFrame:
    """Union by name, missing columns null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def quarantine_sink(rejected: DataFrame, path: str, evaluated_at: Column, run_id: str | None = None) -> None:
    """Rejected rows (with ``reasons``) under their day; with ``run_id`` in the run's own folders, which a repeated run replaces."""
    rows = rejected.withColumn("evaluated_at", evaluated_at).withColumn("day", F.to_date("evaluated_at"))
    _committed(rows, run_id, ["day"]).parquet(path)


def _committed(rows: DataFrame, run_id: str | None, by: list[str]) -> DataFrameWriter:
    """A writer that appends, or, for a run, replaces the partitions of this run alone, so that a stage that runs again, after a
    failure too, leaves each record once."""
    if run_id is None:
        return rows.write.mode("append").partitionBy(*by)
    return rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", *by)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def run_log_sink(entries: DataFrame, path: str, run_id: str | None = None) -> None:
    """Run, step or failure records, appended; with ``run_id`` as those of this run, which a repeated run replaces."""
    _committed(entries, run_id, []).json(path)


def read_run_log(spark: SparkSession, path: str, schema: str, *others: str) -> DataFrame:
    """Run records of the first of the paths that exists and has a readable one, no rows without; unreadable records are skipped."""
    for at in (path, *others):
        try:
            found = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(at)
        except PySparkException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if not others or found.limit(1).count():
            return found
    return spark.createDataFrame([], schema)


def failures_of_messages(metrics: DataFrame, errors: str = "errors") -> DataFrame:
    """``file, error_type, reason`` of the messages ``file: Type: reason`` that a step's metrics list (an array column), the form
    that runs without a failure list have; messages without a colon are left out."""
    rows = metrics.select(F.explode(errors).alias("m")).where(F.contains("m", F.lit(": ")))
    rest = F.substring(F.col("m"), F.locate(": ", "m") + 2, F.length("m"))
    kind = F.substring_index(rest, ": ", 1)
    reason = F.when(F.contains(rest, F.lit(": ")), F.substring(rest, F.length(kind) + 3, F.length(rest))).otherwise(rest)
    return rows.select(F.substring_index("m", ": ", 1).alias("file"), F.when(kind == "", "Error").otherwise(kind).alias("error_type"), reason.alias("reason"))


def latest_run(runs: DataFrame, run: str = "run_id", at: str = "generated_at", wanted: str = "__latest__") -> DataFrame:
    """The newest run (ties: the greatest id), or the one asked for."""
    rows = runs if wanted == "__latest__" else runs.where(F.col(run).cast("string") == wanted)
    return rows.groupBy().agg(F.max_by(F.struct(run, at), F.struct(at, run)).alias("r")).where("r is not null").select("r.*")


def row_counts(df: DataFrame, by: Column) -> DataFrame:
    return df.groupBy(by.alias("source")).agg(F.count(F.lit(1)).alias("n"))


def footer_counts(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """``source, n``: rows of Parquet files by the value of their partition ``folder`` (``root/folder=value/...``), from the files'
    footers alone: the count is pushed into the scan, which reads no row group. The table is read in a session of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(root).groupBy(folder).agg(F.count("*").alias("n")).withColumnRenamed(folder, "source")
