"""Profile files by blocks, sinks that a repeated run leaves as they are, counts from footers, snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sondage.operators import incremental
from sondage.sources import files


def test_large_profile_files_are_many_tasks(spark, tmp_path):
    head = "* Sea-Bird\n# name 0 = prSM: Pressure\n# name 1 = t090C: T\n"
    body = "".join(f"{i} {i % 40}.5\n" if i % 9 else "bad row\n" if i % 2 else "# name 7 = late: no\n" for i in range(4000))
    texts = {"big.cnv": head + "*END*  \n" + body, "crlf.cnv": (head + "*end*\n1 2\n\n3 4\n").replace("\n", "\r\n"), "open.cnv": head + "5 6\n7 8\n", "none.cnv": "no header\n*END*\n1 2\n", "empty.cnv": "", "bare.cnv": head + "*END*\n \n", "words.cnv": head + "*END*\nx y\n", "a b.cnv": head + "*END*\n9 9 9\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="latin-1", newline="")
    whole = files.parse_profiles(spark.read.format("binaryFile").load(str(tmp_path)), F.decode("content", "ISO-8859-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows, errors = files.read_profiles_text(spark, str(tmp_path))
        show = lambda t: sorted(((r.path, r.line_no, sorted(r["values"].items())) for r in t.collect()), key=str)
        assert show(rows) == show(whole[0]) and rows.where("path like '%big%'").count() > 3000
        assert sorted(map(tuple, errors.collect())) == sorted(map(tuple, whole[1].collect()))
        assert rows.where("path like '%big%'").select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_repeated_run_leaves_each_record_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "path string, reasons array<string>")
    at = F.lit("2020-01-01 10:00:00").cast("timestamp_ntz")
    for run in ("r1", "r2", "r1"):
        files.quarantine_sink(rows, str(tmp_path / "q"), at, run)
        files.run_log_sink(rows.select("path"), str(tmp_path / "l"), run)
    assert sorted((r.run_id, r.path) for r in spark.read.parquet(str(tmp_path / "q")).collect()) == [(r, p) for r in ("r1", "r2") for p in "ab"]
    assert files.read_run_log(spark, str(tmp_path / "l"), "run_id string, path string").count() == 4
    for _ in range(2):
        files.run_log_sink(rows.select("path"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 4


def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(1000).withColumn("source", F.concat(F.lit("s"), F.col("id") % 3))
    df.repartition(4).write.partitionBy("source").parquet(str(tmp_path / "t"))
    out = files.footer_counts(spark, str(tmp_path / "t"), "source")
    assert {r.source: r.n for r in out.collect()} == {"s0": 334, "s1": 333, "s2": 333}
    plan = out._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_readers_never_see_half_a_manifest(spark, tmp_path):
    t = dt.datetime(2020, 1, 1)
    entry = lambda *rows: spark.createDataFrame([(p, t + dt.timedelta(days=d), d) for p, d in rows], "path string, published_at timestamp_ntz, entry int")
    root = f"file://{tmp_path}/m"
    assert incremental.read_snapshot(spark, root) is None
    incremental.commit_snapshot(entry(("a", 1), ("b", 1)), root)
    assert incremental.commit_manifest(entry(("b", 2), ("c", 2)), root) == 2
    seen = lambda: {r.path: r.entry for r in incremental.read_snapshot(spark, root).collect()}
    assert seen() == {"a": 1, "b": 2, "c": 2}
    # a writer that dies between write and commit leaves files without the mark of success
    broken = entry(("a", 9), ("z", 9)).withColumn("entry", F.when(F.col("path") == "z", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("entry")))
    with pytest.raises(Exception, match="lost"):
        incremental.commit_snapshot(broken, root)
    entry(("a", 8)).write.parquet(f"{root}/v=00000000000000000007")
    (tmp_path / "m" / "v=00000000000000000007" / "_SUCCESS").unlink()
    assert seen() == {"a": 1, "b": 2, "c": 2}
    assert incremental.commit_manifest(entry(("d", 3)), root) == 8
    assert seen() == {"a": 1, "b": 2, "c": 2, "d": 3}
    reader = incremental.read_snapshot(spark, root)
    incremental.commit_manifest(entry(("a", 5)), root)
    assert {r.path: r.entry for r in reader.collect()}["a"] == 1 and seen()["a"] == 5  # an older snapshot stays as it is


def test_a_body_line_is_parsed_once(spark):
    """Filters on parsed rows aren't pushed into the parsing, and odd lines keep their meaning."""
    text = "# name 0 = a: x\n# name 1 = b: y\n# name 2 = a: z\n*END*\n1 2 3\n\n \t \n* 4 5 6\n#7\n\t4  5\n6 oops 7\n8\n1 2 3 4"
    df = spark.createDataFrame([("p", text), ("q", "*END*\n1 2"), ("r", None), ("s", "# name 0 = a: x\n*END*\nnan")], "path string, content string")
    rows, bad = files.parse_profiles(df, F.col("content"))
    assert sorted((r.path, r.line_no, sorted(r["values"].items(), key=str)) for r in rows.collect()) == [
        ("p", 1, [("a", 3.0), ("b", 2.0)]), ("p", 6, [("a", 4.0), ("b", 5.0)]), ("p", 8, [("a", 8.0)]), ("p", 9, [("a", 3.0), ("b", 2.0)]), ("s", 1, [("a", None)]),
    ]
    assert {r.path: r.error for r in bad.collect()} == {"q": "no_columns", "r": "no_columns"}
    plan = rows.where("values['a'] > 1 and values['b'] < 9")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
