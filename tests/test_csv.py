"""Delimited files: no record and no field is lost, whatever the quotes and the lengths of lines."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from sondage.operators import scan
from sondage.sources import files


def read(spark, path):
    df, strategy, issues = files.read_csv_with_issues(spark, str(path))
    return sorted((tuple(r) for r in df.collect()), key=str), strategy, sorted((r.record, r.reason) for r in issues.collect())


@pytest.mark.parametrize("text, strategy, rows, issues", [
    ('a,b,c\n"x,y",1,2\n5" pipe,2,3\n"p,q",4,5\n', "comma_strict", [("x,y", "1", "2"), ('5" pipe', "2", "3"), ("p,q", "4", "5")], []),
    ("a,b,c\n1,2,3\n4,5\n6,7,8,9\n", "comma_ignore_errors", [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")], [("4,5", "missing_fields"), ("6,7,8,9", "surplus_fields")]),
    ('a,b\n1,"two\n\nlines, ""here"""\n3,4\n"5\n5",6\n', "comma_strict", [("1", 'two\n\nlines, "here"'), ("3", "4"), ("5\n5", "6")], []),
    ('a,b\n1,"two\nlines"\n3\n', "comma_ignore_errors", [("1", "two\nlines"), ("3", None)], [("3", "missing_fields")]),
    ('a,b\n1,2\n"3,4\n5,6\n', "comma_no_quote", [("1", "2"), ('"3', "4"), ("5", "6")], []),
    ("a;b\n1;NA\n2;3,5\n", "semicolon", [("1", None), ("2", "3,5")], []),
    ('a;b\n1;"x;y"\n2;""\n', "semicolon", [("1", "x;y"), ("2", None)], []),
    ("a,b\r\n1,2\r\n\r\n3,4", "comma_strict", [("1", "2"), ("3", "4")], []),
    ("a,b\n", "comma_strict", [], []),
])
def test_nothing_is_lost(spark, tmp_path, text, strategy, rows, issues):
    (tmp_path / "t.csv").write_text(text, newline="")
    assert read(spark, tmp_path / "t.csv") == (sorted(rows, key=str), strategy, sorted(issues))


def test_files_without_columns(spark, tmp_path):
    for name, text in (("one", "x\n1\n"), ("none", "")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError):
            files.read_csv_resilient(spark, str(tmp_path / name))
        assert files.read_delimited_any(spark, str(tmp_path / name))[0] is None
    (tmp_path / "odd.csv").write_text("a\tb\n1\t2\n3\n4\t5\t6\n")
    assert files.read_delimited_any(spark, str(tmp_path / "odd.csv"))[1] == "UTF-8 '\\t'; 1 short; 1 with surplus fields"


@pytest.mark.parametrize("pieces", [1_000_000, 70])
def test_records_that_span_lines_in_many_blocks(spark, tmp_path, monkeypatch, pieces):
    """Against the standard library's reader: files of many blocks, quoted line ends, quotes, separators; rows keep their order."""
    monkeypatch.setattr(scan, "PIECE_ROWS", pieces)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(['a', 'b', ',', '"', "\n", " x", "z"]) for _ in range(rng.randint(0, 9)))
    want = []
    (tmp_path / "d").mkdir()
    for k in range(2):
        rows = [(f"{k}-{i}", word() or "-", word() or "-") for i in range(900)]
        with open(tmp_path / "d" / f"{k}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([("id", "b", "c"), *rows])
        want += rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df, strategy, issues = files.read_csv_with_issues(spark, str(tmp_path / "d"), places=True)
        got = files.numbered(df, "n").orderBy("n").collect()
        assert issues.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    clean = lambda r: tuple(None if x.strip(" ") in files.NULLS else x for x in r)
    assert strategy == "comma_strict" and [r.n for r in got] == list(range(1800))
    assert [tuple(r)[:3] for r in got] == [clean(r) for r in want]


def test_quotes_open_and_close_as_a_parser_would(spark):
    """Lines of quotes, separators and letters against a machine that reads them letter by letter."""

    def ends_inside(line, inside):
        at_start, i = not inside, 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside = False
            elif c == '"' and at_start:
                inside = True
            at_start = not inside and c == ","
            i += 1
        return inside

    rng = random.Random(9)
    lines = ["".join(rng.choice('",,a""') for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = df.select("value", files.left_open(F.col("value"), ",").alias("a"), files.left_open(F.concat(F.lit('"'), F.col("value")), ",").alias("b")).collect()
    assert [(r.value, r.a, r.b) for r in got if (r.a, r.b) != (ends_inside(r.value, False), ends_inside(r.value, True))] == []
    assert list(csv.reader(io.StringIO('a,"b\nc"'))) == [["a", "b\nc"]]
