"""Small literal cases: contract rules, headers, classification, gate, forest, series models, sources, streams."""

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sondage.functions import text as T
from sondage.operators import anomaly, canonical, classify, contract, forest, gate, incremental, series
from sondage.sources import files
from sondage.streaming import rows as streaming

HEAD = "* Sea-Bird\n** Cruise: Radial Gijon\n** Station: 3\n** Latitude: 43 34.5 N\n* NMEA Longitude = 005 37.0 W\n# name 0 = prSM: Pressure\n# name 1 = t090C: T\n# start_time = Ago 17 2093 11:54:25\n"


def codes(df):
    return {(r.severity, r.code) for r in df.collect()}


def profile(spark, temps, depths=None):
    return spark.createDataFrame([("c", i, float(d), float(t)) for i, (d, t) in enumerate(zip(depths or range(1, len(temps) + 1), temps, strict=True))], "cast string, n int, z double, t double")


@pytest.mark.parametrize("temps, found", [([15.0, 14.9, 14.8], set()), ([-5.0, 14.0], {("error", "r")}), ([50.0, 14.0], {("error", "r")}), ([float("nan"), 14.0], set())])
def test_range(spark, temps, found):
    assert codes(contract.check_range(profile(spark, temps), "t", -2, 32, "r")) == found


def test_vertical_jump(spark):
    bands = ["cast"], ["n"], "z", "t"
    assert codes(contract.check_vertical_gradient(profile(spark, [15, 40, 15], [1, 4, 7]), *bands)) == {("error", "temp_large_vertical_jump")}
    assert codes(contract.check_vertical_gradient(profile(spark, [14, 34.5, 14], [45, 50, 55]), *bands)) == {("warning", "temp_moderate_vertical_jump")}
    assert codes(contract.check_vertical_gradient(profile(spark, [14, 40], [10, 5]), *bands)) == set()  # a new segment


def test_dates_and_columns(spark):
    df = spark.createDataFrame([("2080-01-01",), ("2001-05-01",), ("x",)], "fecha string")
    assert codes(contract.check_dates(df, "fecha")) == {("error", "sampling_date_out_of_calendar_range"), ("warning", "sampling_date_partially_missing")}
    assert codes(contract.check_columns(df, ["salinidad_psu"], ["fecha"])) == {("error", "missing_column"), ("warning", "empty_after_coerce")}
    assert codes(contract.check_dates(df.limit(0), "fecha")) == set()


def monthly(spark, values, start=2000):
    return spark.createDataFrame([("s", dt.date(start + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(values)], "series string, month date, value double")


def test_monthly_rules(spark):
    wave = [14 + 2 * math.sin(2 * math.pi * i / 12) for i in range(24)]
    assert codes(contract.check_monthly_jump(monthly(spark, wave), "series", "month", "value")) == set()
    spike = [v + (15 if i == 5 else 0) for i, v in enumerate(wave)]
    assert codes(contract.check_monthly_jump(monthly(spark, spike), "series", "month", "value")) == {("error", "temp_month_to_month_spike")}
    assert codes(contract.check_annual_trend(monthly(spark, wave), ["series"], "month", "value")) == {("warning", "series_too_short_for_trend")}
    ramp = [i * 120 / 72 for i in range(72)]
    assert codes(contract.run_contract(monthly(spark, ramp), "month", "value", ["series"], contract.SeriesLimits(slope_warn=1, slope_error=5))) == {("error", "extreme_annual_trend")}


def test_headers(spark):
    df = spark.createDataFrame([(HEAD, "raw/2005/St.1 CNVs/apr94.cnv")], "h string, p string")
    r = df.select(T.header_columns(F.col("h")).alias("names"), T.parse_start_time(F.col("h")).alias("iso"), T.reconcile_year(T.parse_start_time(F.col("h")), F.col("p")).alias("at"), T.station_number(F.col("h"), F.col("p")).alias("st"), T.header_hints(F.col("h")).alias("x")).first()
    assert r.names == ["prsm", "t090c"] and r.iso == "2093-08-17T11:54:25" and r["at"].year == 2005 and r.st == 3
    assert r.x.lat_deg == pytest.approx(43.575) and r.x.lon_deg == pytest.approx(-5 - 37 / 60)


@pytest.mark.parametrize("lat, lon, want", [(43.55, -5.6, "gijon"), (43.6, -6.2, "cudillero"), (43.4, -8.4, "coruna"), (43.5, -3.8, "santander"), (40.0, -5.0, None), (None, None, None)])
def test_positions(spark, lat, lon, want):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(classify.classify_by_position(F.col("lat"), F.col("lon"))).first()[0] == want


@pytest.mark.parametrize("text, want", [("x_E1CU_1", "cudillero"), ("rcan202510E2GIcast018", "gijon"), ("e3bco", "coruna"), ("", None), (None, None)])
def test_codes(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(classify.identify_by_code(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("bytes_", [4 << 20, 40])
def test_longest_codes_of_a_catalog(spark, monkeypatch, bytes_):
    monkeypatch.setattr(classify, "CATALOG_BYTES", bytes_)  # one automaton, and several
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abñ"), n))
    codes = [(word(rng.integers(1, 6)), i) for i in range(40)] + [("", 99), ("ABN", 7), ("aa", 3), ("aa", 1)]
    texts = [(i, word(rng.integers(0, 12))) for i in range(60)] + [(100, None), (101, ""), (102, "x"), (5, "abn")]
    got = {r.k: r.id for r in classify.identify_by_catalog(spark.createDataFrame(texts, "k long, t string"), "t", "k", spark.createDataFrame(codes, "code string, id long")).collect()}
    want = {}
    for k, t in texts:
        for c, i in codes:
            if t and c and c.upper() in t.strip().upper():
                want[k] = min(want.get(k, (0, 0)), (-len(c), i))
    assert got == {k: v[1] for k, v in want.items()}
    assert classify.identify_by_catalog(spark.createDataFrame(texts, "k long, t string"), "t", "k", spark.createDataFrame([], "code string, id long")).count() == 0


def test_a_catalog_has_one_row_a_code(spark):
    """Of many ids of one code only the smallest meets the texts."""
    codes = spark.createDataFrame([("ab", i) for i in range(500, 0, -1)] + [("AB", 0), ("c", 9), ("", 1), (None, 2)], "code string, id long")
    assert {tuple(r) for r in classify.one_id_a_code(codes).collect()} == {("AB", 0), ("C", 9)}
    texts = spark.createDataFrame([(1, "xab"), (2, "c")], "k long, t string")
    assert {tuple(r) for r in classify.identify_by_catalog(texts, "t", "k", codes).collect()} == {(1, 0), (2, 9)}


def test_shared_expressions_stand_once(spark):
    """Text work is evaluated once for a classification, not once for each code, keyword or condition."""
    x = F.regexp_replace("p", "MARK", "")
    for made in (classify.identify_by_code(x), classify.classify_by_keywords(x), classify.classify_by_filename(x), T.dms_to_degrees(x), T.strip_accents(x)):
        assert str(made).count("MARK") <= 3
    head = "* x\n** Cruise: c\n** Latitude: 43 30 N\n* NMEA Longitude = 005 30 W"
    row = spark.createDataFrame([(head, "Ǆ Gijóń ﬁ"), ("", None)], "h string, t string").select(T.header_hints(F.col("h")).alias("h"), T.strip_accents(F.col("t")).alias("t")).collect()
    assert (row[0].h.cruise, row[0].h.lat_deg, row[0].h.lon_deg, row[0].h.station_field) == ("c", 43.5, -5.5, None) and row[0].t == "DZ Gijon fi"
    assert (row[1].h.cruise, row[1].h.lat_deg, row[1].t) == ("", None, None)


def test_cascade(spark):
    rows = [("a/St.1 CNVs/x.cnv", "Santander", 43.5, -3.8, None, "cudillero", "folder"), ("a/x.cnv", "Radial Gijón", 43.5, -3.8, None, "santander", "geo"), ("a/gnov05.cnv", "", None, None, None, "gijon", "filename"), ("a/x.cnv", "RADCAN", None, None, "CO2", "coruna", "station_prefix"), ("a/x.cnv", "zz", None, None, None, None, "unknown")]
    df = spark.createDataFrame(rows, "p string, cruise string, lat double, lon double, st string, want string, rule string")
    for r in classify.classify_detailed(df, "p", "cruise", "lat", "lon", "st").collect():
        assert (r.cls.radial_id, r.cls.rule) == (r.want, r.rule)


def test_gate(spark):
    df = spark.createDataFrame([("a.cnv", 10, ["t068", "pr"], True), ("b.txt", 0, None, False), ("c.cnv", 5, None, True), ("d.cnv", 5, ["sal00"], False)], "path string, length long, names array<string>, has_start_time boolean")
    got = {r.path: (r.accepted, r.reasons) for r in gate.gate(df).collect()}
    assert got["a.cnv"] == (True, []) and got["b.txt"] == (False, ["bad_extension", "empty_file"]) and got["c.cnv"] == (False, ["no_columns"])
    assert got["d.cnv"] == (False, ["no_temperature", "no_depth", "no_time"])


def test_canonical(spark):
    df = spark.createDataFrame([("1", "12.5", "3"), ("x", "12.5", "4"), (None, "1", None)], "T068 string, depS string, extra string")
    out = canonical.canonicalize(df)
    assert out.columns == [*canonical.ALIASES, "extra"] and [(r.temperatura_c, r.profundidad_m) for r in out.collect()] == [(1.0, 12.5)]
    assert canonical.ensure_depth(df).first().profundidad_m == 12.5
    with pytest.raises(ValueError, match="cast"):
        canonical.require_columns(df, ["cast"])


def test_candidates_are_tried_in_order(spark):
    df = spark.createDataFrame([(9.0, 1.0, 2.0, 8.0, 3.0, 77.5, "a")], "t068C double, T068 double, depS double, SAL00 double, Sal double, time double, acronimo string")
    out = canonical.canonicalize(df).first()
    assert (out.temperatura_c, out.profundidad_m, out.salinidad_psu, out.fecha, out.cast, out.time, out.acronimo) == (1.0, 2.0, 3.0, None, None, 77.5, "a")
    assert canonical.resolve_alias(["prSE", "pr", "DEPTH"], canonical.DEPTH) == "DEPTH" and canonical.resolve_alias(["x"], canonical.DEPTH) is None


@pytest.mark.parametrize("names, reason", [(["par", "pr"], "no_temperature_auxiliary_profile"), (["par", "c0s/m", "pr"], "no_temperature"), (["spar", "sal", "pr"], "no_temperature"), (["v0", "pr"], "no_temperature"), (["sbeoxymol", "pr"], "no_temperature_auxiliary_profile"), (["par", "t068", "pr"], None)])
def test_auxiliary_profiles(spark, names, reason):
    df = spark.createDataFrame([("a.cnv", 10, names, True)], "path string, length long, names array<string>, has_start_time boolean")
    assert gate.gate(df).first().reasons == ([reason] if reason else [])


@pytest.mark.parametrize("text, axis, want", [("43 34.5 N", "NS", 43.575), ("43,5 N", "NS", 43 + 5 / 60), ("5° 37' 30\" w", "EW", -5.625), ("-5 30", "EW", -4.5), ("43 deg", "NS", None), ("", "NS", None), (None, "NS", None), ("5 37 30 9 W", "EW", -5.625), ("43N", "EW", None)])
def test_positions_in_text(spark, text, axis, want):
    got = spark.createDataFrame([(text,)], "t string").select(T.dms_to_degrees(F.col("t"), axis)).first()[0]
    assert got == (None if want is None else pytest.approx(want))


def test_profile_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.CNV").write_text(HEAD + "*END*\n 1.0 14.5\n 2.0\nbad row\n3 13 99\n\n", encoding="latin-1")
    (tmp_path / "b.cnv").write_text("no header\n*END*\n1 2\n")
    (tmp_path / "c.cnv").write_text(HEAD + "*END*\n")
    rows, errors = files.read_profiles_text(spark, str(tmp_path))
    got = sorted((r.prsm, r.t090c) for r in files.widened(rows, ["prsm", "t090c"]).collect() if r.t090c is not None)
    assert got == [(1.0, 14.5), (3.0, 13.0)] and rows.count() == 3
    assert sorted(r.error for r in errors.collect()) == ["no_columns", "no_data"]
    assert files.file_table(spark, str(tmp_path)).count() == 3


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.cnv").write_text(HEAD + "*END*\n1 2\n")
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.cnv").write_text(HEAD + "*END*\n1 2\n")
        streaming.run_available(streaming.profile_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 2 and all(r.accepted for r in got)


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;NA\n2;3\n")
    df, strategy = files.read_csv_resilient(spark, str(tmp_path / "a.csv"))
    assert strategy == "semicolon" and [tuple(r) for r in df.collect()] == [("1", None), ("2", "3")]
    (tmp_path / "one.csv").write_text("x\n1\n")
    with pytest.raises(ValueError):
        files.read_csv_resilient(spark, str(tmp_path / "one.csv"))
    assert files.read_delimited_any(spark, str(tmp_path / "none.csv"))[0] is None


def test_deepest_cast(spark):
    rows = [("s", c, i, dt.date(2020, 5, 3), z, t) for c, top, t in (("a", 30, 10.0), ("b", 80, 14.0), ("c", 50, 12.0)) for i, z in enumerate((0.0, 10.0, float(top)))]
    df = spark.createDataFrame(rows, "st string, cast string, n int, fecha date, z double, t double")
    casts = series.casts_at_depth(df, "st", "cast", ["n"], "fecha", "z", "t", 5.0)
    assert [r.value_at for r in series.monthly_at_depth(casts, "st", "cast").collect()] == [14.0]
    assert series.coverage_diag(casts, 5.0).first().n_casts == 3


def test_fourier_against_lstsq(spark):
    rng = np.random.default_rng(1)
    y = 15 + 3 * np.sin(2 * np.pi * np.arange(60) / 12) + rng.normal(size=60)
    got = series.fourier_fit(monthly(spark, y), ["series"]).orderBy("month").collect()
    t = np.arange(60)
    x = np.column_stack([np.ones(60), *[f(2 * np.pi * k * t / 12) for k in (1, 2, 3) for f in (np.sin, np.cos)]])
    want = x[:, 1:] @ np.linalg.lstsq(x, y, rcond=None)[0][1:]
    assert np.allclose([r.seasonal for r in got], want, atol=1e-6)
    short = series.fourier_fit(monthly(spark, y[:5]), ["series"]).collect()
    assert all(r.seasonal == 0 and r.coef is None for r in short)


@pytest.mark.parametrize("block", [16_384, 50])
def test_coefficients_of_long_trends(spark, monkeypatch, block):
    """Against lstsq: a trend of 600 months on a large offset, series of several lengths, one with dependent columns, in one or many blocks."""
    monkeypatch.setattr(series, "BLOCK_ROWS", block)
    rng = np.random.default_rng(6)
    data = {"long": (np.arange(600), 1e6 + 0.37 * np.arange(600) + np.sin(np.arange(600)) + rng.normal(size=600)), "late": (np.arange(4000, 4600), rng.normal(size=600)), "mid": (np.arange(0, 90, 3), rng.normal(size=30)), "short": (np.arange(5), rng.normal(size=5))}
    rows = [(k, int(a), float(b)) for k, (t, y) in data.items() for a, b in zip(t, y, strict=True)] + [("long", 7, None)]
    df = spark.createDataFrame(rows, "k string, t long, y double")
    xs = series.design(F.col("t"), 3, trend=True)
    runs = [{r.k: (r.n, r.coef) for r in series.least_squares(df.orderBy(F.rand(i)).repartition(i), ["k"], xs, F.col("y"), F.col("t")).collect()} for i in (1, 5)]
    assert runs[0] == runs[1]
    for k, (t, y) in data.items():
        x = np.column_stack([np.ones(len(t)), t, *[f(2 * np.pi * h * t / 12) for h in (1, 2, 3) for f in (np.sin, np.cos)]])
        n, coef = runs[0][k]
        assert n == len(t)
        if k in ("long", "late"):
            want = np.linalg.lstsq(x, y, rcond=None)[0]
            assert np.allclose(coef, want, rtol=1e-9, atol=1e-9)
        assert np.allclose(x @ coef, x @ np.linalg.lstsq(x, y, rcond=1e-10)[0], atol=1e-6)  # the fit is one, whichever of dependent columns carry it


def test_holdout_and_bands(spark):
    model = series.trend_fourier_holdout(monthly(spark, [15 + i % 3 for i in range(18)]), ["series"], 1)
    assert model.where("is_holdout").count() == 1 and model.where("status = 'ok'").count() == 18
    banded = series.apply_bands(model, series.residual_bands(model, ["series"]), ["series"]).collect()
    assert len({round(r.upper_95 - r.lower_95, 9) for r in banded}) == 1
    assert series.trend_fourier_holdout(monthly(spark, [1, 2, 3]), ["series"]).where("status = 'ok'").count() == 0


def test_forest_is_the_same_under_any_partitioning(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "big" if i < 400 else "small", *map(float, rng.normal(size=3))) for i in range(405)]
    rows[7] = (7, "big", 10.0, -10.0, 10.0)
    df = spark.createDataFrame(rows, "id long, g string, a double, b double, c double")
    runs = [sorted((r.id, r.anomaly_score, r.is_anomaly) for r in anomaly.detect(df.repartition(n), ["a", "b", "c"], ["g"], ["id"], forest.Forest(trees=50)).collect()) for n in (1, 7)]
    assert runs[0] == runs[1]
    flagged = [i for i, _, f in runs[0] if f]
    assert 7 in flagged and len(flagged) in (20, 21) and not any(i >= 400 for i in flagged)
    assert anomaly.detect(df, ["a"], ["g"], ["id"]).where("is_anomaly").count() == 0


@pytest.mark.parametrize("ndim", [1, 2])
def test_forest_scores_tell_outliers(spark, ndim):
    rng = np.random.default_rng(5)
    rows = [(i, "all", *map(float, rng.normal(size=2) + (12 if i < 5 else 0))) for i in range(300)]
    out = forest.isolation_scores(spark.createDataFrame(rows, "id long, g string, a double, b double"), ["a", "b"], "g", ["id"], forest.Forest(trees=60, ndim=ndim, max_depth=8)).orderBy(F.desc("iso_score")).limit(5)
    assert {r.id for r in out.collect()} == set(range(5))


def test_manifest(spark):
    t = dt.datetime(2020, 1, 1)
    now = spark.createDataFrame([("a", 1, t), ("b", 2, t), ("c", 3, t)], "path string, length long, mtime timestamp_ntz")
    known = spark.createDataFrame([("a", 1, t, 1), ("b", 9, t, 1), ("c", 3, t, 0)], "path string, length long, mtime timestamp_ntz, version int")
    assert sorted(r.path for r in incremental.changed_files(now, known, 1).collect()) == ["b", "c"]
    assert incremental.changed_files(now, known, 1, rebuild=True).count() == 3
    assert incremental.tree_fingerprint(now.limit(0)).first()[0] == "empty"


def test_csv_plan_reads_all_lines(spark, tmp_path):
    from sondage.sources import files

    good = ["a,b"] + [f"{i},x" for i in range(100)]
    for name, last, strategy in (("even", "7,y", "comma_strict"), ("ragged", "7,y,z", "comma_ignore_errors"), ("quote", '7,"y', "comma_no_quote")):
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([*good, last]) + "\n")
        df, got = files.read_csv_resilient(spark, str(path))
        assert got == strategy and len(df.collect()) == 101


def test_quantiles_are_exact(spark, monkeypatch):
    from sondage.operators import quantiles as Q

    rng = np.random.default_rng(11)
    rows = [("hot" if i % 3 else None, float(x), None if i % 7 == 0 else float(y)) for i, (x, y) in enumerate(zip(rng.lognormal(3, 2, 9000), rng.integers(0, 5, 9000), strict=True))]
    rows += [("one", 3.0, float("nan")), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    for small in (50_000, 10):  # whole groups, and brackets
        monkeypatch.setattr(Q, "SMALL", small)
        for q in (0.0, 0.05, 0.5, 0.95, 1.0):
            got = {r._k.k0: (r.a, r.b) for r in Q.quantiles(df, ["g"], {"a": F.col("x"), "b": F.col("y")}, q).collect()}
            assert set(got) == {"hot", None, "one", "none"} and got["none"] == (None, None)
            for g in ("hot", None, "one"):
                for i, column in enumerate((1, 2)):
                    v = [r[column] for r in rows if r[0] == g and r[column] is not None and not np.isnan(r[column])]
                    assert got[g][i] == (pytest.approx(np.quantile(v, q), rel=1e-12) if v else None)
    assert Q.quantiles(df, [], {"a": F.col("x")}, 0.5).first().a == pytest.approx(np.median([r[1] for r in rows if r[1] is not None]))
    assert Q.quantiles(df.limit(0), ["g"], {"a": F.col("x")}, 0.5).count() == 0


def plain_forest_scores(rows, nodes):
    """Mean depths by walking every tree for every row."""
    trees = {}
    for n in nodes:
        trees.setdefault((n.stratum, n.tree), {})[n.node] = n
    out = {}
    for key, g, x in rows:
        own = [t for (s, _), t in trees.items() if s == g]
        if not own:
            continue
        total, psi = 0.0, max(t[0].size for t in own)
        for t in own:
            at = t[0]
            while at.left is not None:
                at = t[at.left if sum(c * v for c, v in zip(at.coef, x, strict=True)) <= at.threshold else at.right]
            total += at.depth + forest.path_length(at.size)
        out[key] = 2 ** (-total / len(own) / forest.path_length(psi))
    return out


@pytest.mark.parametrize("ndim", [1, 2])
def test_forest_against_walking_every_tree(spark, monkeypatch, ndim):
    rng = np.random.default_rng(4)
    rows = [(i, "ab"[i % 5 == 0] if i < 300 else "few" if i < 305 else None, *map(float, rng.normal(size=3))) for i in range(325)]
    df = spark.createDataFrame(rows, "id long, g string, a double, b double, c double")
    shape = forest.Forest(trees=12, psi=32, ndim=ndim)
    narrow = forest.narrow_features(df, ["a", "b", "c"], F.col("g"), ["id"])
    full = narrow.select("_key", "stratum", F.array("f0", "f1", "f2").alias("x"))
    nodes = forest.grown(forest.subsamples(full, shape), shape).persist()
    own = nodes.groupBy("stratum", "tree").agg(F.max("size").alias("n")).collect()
    assert {r.stratum for r in own} == {"a", "b"} and all(r.n <= 32 for r in own) and len(own) == 24
    for (s, k), tree in {(r.stratum, r.tree): [n for n in nodes.collect() if (n.stratum, n.tree) == (r.stratum, r.tree)] for r in own}.items():
        at = {n.node: n for n in tree}
        assert all(at[n.left].size + at[n.right].size == n.size and at[n.left].depth == n.depth + 1 for n in tree if n.left is not None), (s, k)
        assert len({n.node for n in tree}) == len(tree) and all(n.size == 1 or n.depth == 5 for n in tree if n.left is None)
    want = plain_forest_scores([(r[0], r[1], r[2:]) for r in rows], nodes.collect())
    for most in (forest.BROADCAST_BYTES, 0):  # a broadcast forest, and one that stays distributed
        monkeypatch.setattr(forest, "BROADCAST_BYTES", most)
        monkeypatch.setattr(forest, "GROUP_ROWS", 50)
        got = {r._key.k0: r.iso_score for r in forest.scored(full, nodes, 3, shape).collect()}
        assert len(got) == 325 and all(got[k] == pytest.approx(v, rel=1e-9) for k, v in want.items()) and all(got[k] is None for k in range(300, 325))
    out = forest.isolation_scores(df, ["a", "b", "c"], "g", ["id"], shape)
    assert out.columns == [*df.columns, "iso_score"] and {r.id: r.iso_score for r in out.collect()} == got
    nodes.unpersist()


def test_batch_goes_on_after_failures(spark):
    from sondage.operators import contract

    day = dt.datetime(2001, 5, 1)
    rows = [("good", i, i, "c", float(i), 15.0 + i % 3, day) for i in range(60)] + [("hot", i, i, "c", float(i), 40.0 if i == 5 else 15.0, day) for i in range(60)]
    rows += [("no_id", None if i == 3 else i, i, "c", 1.0, 2.0, day) for i in range(20)] + [("empty", i, i, "c", None, None, day) for i in range(20)] + [(None, i, i, "c", float(i), 15.0, day) for i in range(30)]
    df = spark.createDataFrame(rows, "source_file string, row_id long, n int, cast_key string, profundidad_m double, temperatura_c double, fecha timestamp_ntz")
    df = df.withColumn("stratum", F.lit("s"))
    scored, per, totals = anomaly.qc_batch(df, "source_file", ["profundidad_m", "temperatura_c"], ["stratum"], ["source_file", "n"], ["cast_key"], ["n"], forest.Forest(trees=20), contract.ProfileLimits(), "row_id")
    got = {r.source_file: r for r in per.collect()}
    assert got["no_id"].error == "ValueError: rows without row_id" and got["empty"].error == "ValueError: no feature with a number"
    assert got["no_id"].n_anomalies is None and {r.source_file for r in scored.select("source_file").distinct().collect()} == {"good", "hot", None}
    assert got["good"].n_contract_errors == 0 and got["hot"].has_contract_error and got["hot"].n_contract_errors == 1 and got["good"].n_anomalies >= 3 and got[None].n_rows == 30
    t = totals.first()
    assert (t.n_sources, t.n_failed, t.n_rows, t.n_sources_with_errors) == (5, 2, 190, 1) and t.n_anomalies == sum(r.n_anomalies or 0 for r in got.values())


def test_batch_takes_fresh_sources_from_an_earlier_run(spark):
    day = dt.datetime(2001, 5, 1)
    rows = [(s, i, i, "c", float(i), 40.0 if s == "hot" and i == 5 else 15.0 + i % 3, day) for s in ("hot", "old", "unseen", None) for i in range(60)]
    rows += [("broken", None, i, "c", 1.0, 2.0, day) for i in range(20)]
    df = spark.createDataFrame(rows, "source_file string, row_id long, n int, cast_key string, profundidad_m double, temperatura_c double, fecha timestamp_ntz")
    df = df.withColumn("stratum", F.lit("s"))
    run = lambda **more: anomaly.qc_batch(df, "source_file", ["profundidad_m", "temperatura_c"], ["stratum"], ["source_file", "n"], ["cast_key"], ["n"], forest.Forest(trees=20), row_id="row_id", **more)
    first, per, _ = run()
    assert not any(r.skipped for r in per.collect())
    marked = first.withColumn("reason", F.lit("earlier")).where("source_file is null or source_file <> 'unseen'")
    one = marked.where("source_file = 'old'").limit(1).withColumn("source_file", F.lit("broken")).withColumn("is_anomaly", F.lit(True))
    earlier = marked.unionByName(one)
    fresh = spark.createDataFrame([("hot", True), ("hot", True), ("old", False), ("unseen", True), (None, True), ("broken", True), ("gone", True)], "source_file string, is_fresh boolean")
    scored, again, totals = run(fresh=fresh, earlier=earlier)
    before, got = {r.source_file: r for r in per.collect()}, {r.source_file: r for r in again.collect()}
    assert {s for s, r in got.items() if r.skipped} == {"hot", None, "broken"} and got["broken"].error is None and got["broken"].n_anomalies == 1
    assert all(got[s][:6] == before[s][:6] for s in ("hot", "old", "unseen", None)) and got["hot"].n_contract_errors == 1
    kinds = {(r.source_file, r.is_earlier): r.n for r in scored.groupBy("source_file", (F.col("reason") == "earlier").alias("is_earlier")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {("hot", True): 60, (None, True): 60, ("broken", True): 1, ("old", False): 60, ("unseen", False): 60}
    assert totals.first().n_skipped == 3 and totals.first().n_sources == 5


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(8)
    rows = [("s", dt.date(2000, 1 + i % 2, 1 + i % 20), float(x)) for i, x in enumerate(rng.normal(size=500) * 10.0 ** rng.integers(-3, 5, 500))]
    df = spark.createDataFrame(rows, "series string, day date, v double")
    runs = [sorted(map(tuple, series.monthly_mean(df.orderBy(F.rand(k)).repartition(1 + k), ["series"], "day", "v").collect())) for k in range(4)]
    assert all(r == runs[0] for r in runs)
    assert runs[0][0][2] == pytest.approx(np.mean([v for _, d, v in rows if d.month == 1]))


def test_rows_of_files_are_numbered_in_order(spark, tmp_path):
    body = "\n".join(f"{i},{'x' * 40}" for i in range(3000))
    (tmp_path / "t.csv").write_text(f"n,2019 text\n{body}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        plain = files._csv(spark, str(tmp_path / "t.csv"), files.CsvPlan("any", ",", '"'), places=True)
        got = files.numbered(plain, "k").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3000 and all(int(r.n) == r.k for r in got)
    (tmp_path / "y.csv").write_text("n,when\n1,in 2019\n2,none\n")
    table = files.read_radial_csv(spark, str(tmp_path / "y.csv"), "y.csv").orderBy("row_id").collect()
    assert [(r.fecha and r.fecha.year, r.cast_key) for r in table] == [(2019, "y.csv_0"), (None, "y.csv_1")]
    (tmp_path / "z.csv").write_text("n,when\n1,now\n")
    with pytest.raises(ValueError):
        files.read_radial_csv(spark, str(tmp_path / "z.csv"), "z.csv")


def test_run_logs_fall_back(spark, tmp_path):
    (tmp_path / "b.json").write_text('{broken\n')
    (tmp_path / "c.json").write_text('{"run_id": "r", "errors": ["f: E: r"]}\n')
    at = [str(tmp_path / f"{x}.json") for x in "abc"]
    assert [r.run_id for r in files.read_run_log(spark, at[0], "run_id string", *at[1:]).collect()] == ["r"]
    assert files.read_run_log(spark, at[0], "run_id string").count() == 0


def test_decompositions_and_labels(spark):
    row = spark.createDataFrame([("Ａ Coruña ﬁn ĳ Ǆ é ½ Ωmega", "gij\u0095n", None)], "a string, b string, c string")
    got = row.select(T.normalize_text(F.col("a")), classify.classify_by_keywords(F.col("b")), T.normalize_text(F.col("c")), T.var_meta(F.lit("PAR"))["label"], T.var_meta(F.lit("o_100"))["unit"], T.infer_kind(F.lit("psu"))).first()
    assert list(got) == ["a coruna fin ij dz e ½ ωmega", "gijon", None, "PAR", "mL/L", "other"]


def test_digests_are_taken_for_new_files_alone(spark):
    t = dt.datetime(2020, 1, 1)
    now = spark.createDataFrame([("a", 1, t), ("b", 2, t)], "path string, length long, mtime timestamp_ntz")
    known = spark.createDataFrame([("a", 1, t, "told")], "path string, length long, mtime timestamp_ntz, sha256 string")
    contents = spark.createDataFrame([("a", b"x"), ("b", b"y")], "path string, content binary")
    got = {r.path: r.sha256 for r in incremental.with_digests(now, known, contents).collect()}
    assert got["a"] == "told" and len(got["b"]) == 64


def test_days_stand_in_for_casts(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 5, 1, 8), None), (dt.datetime(2001, 5, 2), "c")], "fecha timestamp_ntz, cast string")
    assert sorted(r.cast_key for r in canonical.cast_key(df, day="fecha").collect()) == ["2001-05-01", "c"]


def test_strata_meet_their_rows_by_broadcast(spark):
    """The sizes of strata are a small table, so no task reads all rows of a large stratum."""
    rows = spark.range(5000).selectExpr("struct(id) AS _key", "concat('s', id div 100000) AS stratum", "array(rand(1), rand(2)) AS x")
    got = forest.subsamples(rows, forest.Forest(trees=4, psi=64))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    counts = {r["tree"]: r["count"] for r in got.groupBy("tree").count().collect()}
    assert set(counts) == {1, 2, 3, 4} and all(30 < n <= 64 for n in counts.values())


def test_forest_rows_are_gathered_and_medians_are_for_gaps(spark, monkeypatch):
    """Small batches of many strata are scored together (each was walked by itself), and medians are counted only where a feature is missing."""
    from sondage.operators import forest as T

    asked = []
    monkeypatch.setattr(T, "quantiles", lambda df, by, values, *a, own=T.quantiles, **k: asked.append(sorted(values)) or own(df, by, values, *a, **k))
    rows = spark.range(600).select("id", (F.col("id") % 3).cast("string").alias("s"), (F.col("id") * 7 % 31).cast("double").alias("a"), (F.col("id") % 13).cast("double").alias("b"))
    whole = T.isolation_scores(rows, ["a", "b"], "s", ["id"], T.Forest(trees=20))
    assert whole.where("iso_score > 0 and iso_score < 1").count() == 600 and asked == []
    gaps = rows.withColumn("b", F.when(F.col("id") >= 30, F.col("b")))
    filled = rows.withColumn("b", F.when(F.col("id") >= 30, F.col("b")).otherwise(F.lit(6.0)))
    got, want = (T.isolation_scores(t, ["a", "b"], "s", ["id"], T.Forest(trees=20)).select("id", "iso_score") for t in (gaps, filled))
    assert asked == [["m1"]] and got.exceptAll(want).count() == 0
    batches = [pa.RecordBatch.from_pydict({"x": list(range(i, i + 10))}) for i in range(0, 90, 10)]
    monkeypatch.setattr(T, "GATHER_ROWS", 40)
    assert [b.num_rows for b in T._gathered(iter(batches))] == [40, 40, 10] and [v for b in T._gathered(iter(batches)) for v in b.column("x").to_pylist()] == list(range(90))


def test_depths_are_dealt_before_they_are_grouped(spark, monkeypatch):
    df = spark.createDataFrame([(f"c{i // 3}" if i % 4 else "hot", float(i % 13), float(i % 17)) for i in range(2000)], "cast string, z double, t double")
    run = lambda: series.interp_at_depth(df, ["cast"], "z", "t", 5.0)
    plain = sorted(map(tuple, run().collect()))
    monkeypatch.setattr(series, "TASK_ROWS", 100)
    plan = run()._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
    assert len(plan) == 2 and "Aggregate" not in plan[1] and ", 20)" in plan[0].splitlines()[-1]  # no task groups more than its share
    assert [r[::2] for r in sorted(map(tuple, run().collect()))] == [r[::2] for r in plain]


def test_casts_are_dealt_before_they_are_grouped(spark, monkeypatch):
    """Nearly as many casts as rows: no group is made before rows are dealt to tasks of some rows, however large a cast is; against brute force."""
    rng = np.random.default_rng(5)
    rows = [("s" if i % 3 else None, "hot" if i % 4 == 0 else f"c{i // 6}", -i, dt.date(2000 + i % 9, 1 + i % 12, 9), [None, math.nan, 0.0, 5.0, -0.0][i % 5] if i % 7 == 0 else float(rng.integers(0, 12)), None if i % 11 == 0 else float(i % 17)) for i in range(2000)]
    rows += [("s", "empty", i, dt.date(2001, 1, 1), None, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "st string, cast string, n int, fecha date, z double, t double")

    def casts():
        return series.casts_at_depth(df, "st", "cast", ["n"], "fecha", "z", "t", 5.0)

    def shown(out):
        return sorted(((*r[:-1], str(r[-1])) for r in out.collect()), key=str)

    plain = shown(casts())
    monkeypatch.setattr(series, "TASK_ROWS", 100)
    dealt = casts()
    assert [r[:2] + r[3:] for r in shown(dealt)] == [r[:2] + r[3:] for r in plain] and [r[2] for r in shown(dealt)] == pytest.approx([r[2] for r in plain])
    for out in (casts(), casts().select("st", "value_at")):
        below = out._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
        assert len(below) == 2 and "Aggregate" not in below[1] and ", 21)" in below[0].splitlines()[-1]
    want = {}
    for key in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == key]
        at = {}
        for r in own:
            if r[4] is not None and not math.isnan(r[4]) and r[5] is not None:
                at.setdefault(r[4] + 0.0, []).append(r[5])
        low, high = max((z for z in at if z <= 5), default=None), min((z for z in at if z >= 5), default=None)
        if at and key[0]:  # as in SQL, a cast without a station meets no first row
            v = {z: sum(x) / len(x) for z, x in at.items()}
            value = None if low is None or high is None else v[low] if low == high else v[low] + (v[high] - v[low]) * (5 - low) / (high - low)
            want[key] = (value, max(at), min(own, key=lambda r: r[2])[3].replace(day=1))
    got = {(r.st, r.cast): (r.value_at, r.z_max, r.month) for r in casts().collect()}
    assert got.keys() == want.keys() and ("s", "empty") not in got
    assert all(got[k][1:] == want[k][1:] and (got[k][0] is None) == (want[k][0] is None) and (want[k][0] is None or got[k][0] == pytest.approx(want[k][0])) for k in want)
