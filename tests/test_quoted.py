"""Quoted line breaks across blocks: as Spark's own reader with multiLine, with many tasks a file."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources import quoted, read_delimited, read_quoted
from sparkmart.sources.quoted import read_lines

SCHEMA = T.StructType().add("id", T.LongType()).add("text", T.StringType()).add("n", T.IntegerType())
SMALL = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def small_blocks(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def cell(text):
    return '"' + text.replace('"', '""') + '"'


def write(path, rows, end="\n", last=True):
    lines = ["id,text,n", *(f"{i},{cell(t)},{n}" for i, t, n in rows)]
    path.write_bytes((end.join(lines) + (end if last else "")).encode())


def texts(dealer):
    pieces = ["word", "\n", '"', ",", "\r\n", '""', "é\n\n", " ", "line, with\n\"quote\"", "\n" * 7, "x" * 60]
    return "".join(dealer.choice(pieces) for _ in range(dealer.randrange(1, 14)))


@pytest.mark.parametrize("last", [True, False])
def test_records_against_what_was_written(spark, tmp_path, small_blocks, last):
    dealer, expected = random.Random(2), []
    for number in range(3):
        rows = [(1000 * number + k, "a" + texts(dealer), k) for k in range(60)]
        write(tmp_path / f"part{number}.csv", rows, last=last)
        expected += rows
    assert read_lines(spark, str(tmp_path)).select("block").distinct().count() > 20
    found = read_quoted(spark, str(tmp_path), SCHEMA)
    assert found.schema == SCHEMA
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_a_cell_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [(1, "short", 1), (2, "line\n" * 200 + '"end"', 2), (3, "a\nb", 3), (4, "\n" * 300, 4)]
    write(tmp_path / "a.csv", rows)
    assert sorted(tuple(r) for r in read_quoted(spark, str(tmp_path), SCHEMA).collect()) == rows


def test_windows_line_ends_and_empty_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,text,n\r\n1,"a\r\nb",1\r\n\r\n2,plain,\r\n3,"",3')
    found = sorted(tuple(r) for r in read_quoted(spark, str(tmp_path), SCHEMA).collect())
    strict = read_delimited(spark, str(tmp_path), SCHEMA, multiLine="true", lineSep="\r\n")
    assert [f[:2] for f in found[:2]] == [(1, "a\r\nb"), (2, "plain")] and found[1][2] is None
    assert len(found) == strict.count() == 3


@pytest.mark.parametrize("body", ["x,a,1", "1,a", "1,a,1,1", '1,"a"b,1'])
def test_broken_records_end_the_read(spark, tmp_path, body):
    (tmp_path / "a.csv").write_text(f"id,text,n\n1,a,1\n{body}\n")
    with pytest.raises(Exception, match="(?i)malformed|unescaped quote"):
        read_quoted(spark, str(tmp_path), SCHEMA).collect()


def test_headers_must_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,words,n\n1,a,1\n")
    with pytest.raises(Exception, match="header"):
        read_quoted(spark, str(tmp_path), SCHEMA).collect()
    with pytest.raises(ValueError):
        read_quoted(spark, str(tmp_path), SCHEMA, escape="\\")
    with pytest.raises(ValueError):
        read_quoted(spark, str(tmp_path), SCHEMA, encoding="latin1")


def test_a_file_of_a_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,n\n")
    (tmp_path / "b.csv").write_text("")
    assert read_quoted(spark, str(tmp_path), SCHEMA).collect() == []


def test_only_the_edges_of_blocks_are_shuffled(spark, tmp_path, plan_of):
    """All lines were shuffled twice, each with its file's path, so shuffle and spill were many times the text."""
    write(tmp_path / "a.csv", [(k, "a\nb", k) for k in range(50)])
    plan = plan_of(read_quoted(spark, str(tmp_path), SCHEMA))
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert shuffled and not any(re.search(r"\b(line|value)#", columns) for columns in shuffled)
    lines = read_lines(spark, str(tmp_path))
    placed = lines.select(
        F.lit(1).cast("long").alias("_no"),
        F.lit(1).cast("long").alias("_top"),
        F.lit(0).cast("long").alias("_inside"),
        F.col("line").cast("binary").alias("line"),
    )
    edges = quoted.map_arrow(placed, quoted._cut(b'"', False), quoted._CUT).collect()
    assert [(r["part"], bytes(r["record"])) for r in edges] == [(quoted._BEGUN, b'49,"a\nb",49')]


def test_records_over_arrow_batches(spark, tmp_path):
    dealer = random.Random(5)
    rows = [(k, "a" + texts(dealer), k) for k in range(400)]
    write(tmp_path / "a.csv", rows)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for size in (1, 7):
            spark.conf.set(name, str(size))
            found = read_quoted(spark, str(tmp_path), SCHEMA).collect()
            assert sorted(tuple(r) for r in found) == sorted(rows)
    finally:
        spark.conf.set(name, before)
