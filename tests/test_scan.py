"""Windows by pieces: the same rows as plain windows, with one key that holds most of them."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondage.operators import contract, scan, series


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = [("hot" if i % 4 else [None, "a", "b"][i % 3], i, float(rng.integers(0, 30)), None if i % 5 == 0 else float(rng.integers(0, 40))) for i in range(4000)]
    return spark.createDataFrame(out, "cast string, n int, z double, t double").repartition(6)


def both(monkeypatch, run):
    """The rows with plain windows, and with pieces of some 150 rows."""
    plain = run()
    monkeypatch.setattr(scan, "PIECE_ROWS", 150)
    return plain, run()


def test_windows_by_pieces(spark, rows, monkeypatch):
    def run():
        out = scan.layout(rows, ["cast"], ["n"])
        out = out.windowed(lag={"l": F.col("t")}, total={"s": F.col("t")}, last={"b": F.col("t")}, ahead={"a": F.col("t")})
        return sorted(map(tuple, out.table().collect()), key=lambda r: r[1])

    plain, pieces = both(monkeypatch, run)
    assert plain == pieces and len(plain) == 4000
    hot = scan.layout(rows, ["cast"], ["n"])
    sizes = [r[0] for r in hot.hot.groupBy("_piece").count().select("count").collect()]
    assert len(sizes) > 15 and max(sizes) < 600  # the largest piece, where the key has 3000 rows
    assert hot.cold.count() + sum(sizes) == 4000
    assert hot.hot.where("cast is null").count() == 334 and scan.layout(rows.limit(0), ["cast"], ["n"]).table().count() == 0


def test_casts_and_gaps_by_pieces(rows, monkeypatch):
    def segments():
        return sorted(map(tuple, contract.depth_segments(rows, ["cast"], ["n"], "z").collect()), key=str)

    def gradients():
        return sorted(map(tuple, contract.gradient_segments(rows, ["cast"], ["n"], "z", "t", contract.ProfileLimits.temperature_bands).collect()), key=str)

    def gaps():
        times = rows.where("n % 7 <> 3").withColumn("at", F.timestamp_seconds(F.col("n") * 3600))
        return [tuple(r) for r in contract.check_time_gaps(times, "at", ["cast"], 0.1).collect()]

    for run in (segments, gradients, gaps):
        with monkeypatch.context() as m:
            plain, pieces = both(m, run)
            assert plain == pieces and plain
    # brute force: segments of the key with most rows
    own = sorted((r for r in rows.collect() if r.cast == "hot"), key=lambda r: r.n)
    segment, want = 0, []
    for i, r in enumerate(own):
        segment += i > 0 and r.z - own[i - 1].z < -1.5
        want.append((r.n, segment))
    assert sorted((r[1], r[4]) for r in segments() if r[0] == "hot") == want


def test_long_series_are_filled_by_pieces(spark, monkeypatch):
    grid = [("s", dt.date(1900 + i // 12, i % 12 + 1, 1), float(i * i % 17) if i % 11 == 3 and 400 < i < 2000 else None) for i in range(2400)]
    df = spark.createDataFrame(grid, "k string, month date, value double").repartition(3)
    plain, pieces = both(monkeypatch, lambda: sorted(map(tuple, series.fill_linear(df, ["k"]).collect())))
    assert plain == pieces
    seen = [i for i, g in enumerate(grid) if g[2] is not None]
    want = np.interp(np.arange(2400), seen, [grid[i][2] for i in seen])
    got = {r[1]: r[3] for r in pieces}
    assert all(got[g[1]] is None if i < seen[0] else got[g[1]] == pytest.approx(want[i]) for i, g in enumerate(grid))


def test_a_small_bound_does_not_make_ever_more_pieces(rows, monkeypatch):
    monkeypatch.setattr(scan, "PIECES", 20)
    out = scan.layout(rows, ["cast"], ["n"], piece_rows=10)
    sizes = [r[0] for r in out.hot.groupBy("_piece").count().select("count").collect()]
    assert 15 < len(sizes) <= 21 and sum(sizes) == 4000
    got = contract.depth_segments(rows, ["cast"], ["n"], "z", piece_rows=10)
    want = contract.depth_segments(rows, ["cast"], ["n"], "z")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_sums_of_what_the_row_before_tells(spark, monkeypatch):
    """Pieces down to one row, sums that begin with nulls, in one pass; no task reads rows again to make the carried ones."""
    df = spark.createDataFrame([("a" if i % 3 else None, i, None if i < 9 or i % 5 == 0 else float(i * i % 23)) for i in range(60)], "k string, n int, v double").withColumn("d", F.col("v").cast("decimal(8,2)"))

    def run():
        change = F.col("v") - F.col("_b")
        out = scan.layout(df, ["k"], ["n"]).windowed(lag={"_b": F.col("v")}, total={"up": (change > 0).cast("int"), "all": F.col("d")}, last={"l": F.col("v")}, ahead={"a": F.col("v")}).table()
        return out.dtypes, sorted(map(tuple, out.collect()), key=lambda r: r[1])

    plain = run()
    for most in (1, 7, 30):
        monkeypatch.setattr(scan, "PIECE_ROWS", most)
        kinds, got = run()
        assert kinds == run()[0] and dict(kinds) == dict(plain[0])
        at = [kinds.index(x) for x in plain[0]]
        assert [tuple(r[i] for i in at) for r in got] == plain[1]
    plan = scan.layout(df, ["k"], ["n"]).windowed(lag={"_b": F.col("v")}, total={"s": F.col("_b")}).hot._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan and "RangePartitioning" not in plan
