"""One document over many blocks: braces and quotes in names and texts, any layout."""

import json
import random
import re

import pytest
from pyspark.sql import types as T

from sparkmart.sources import read_documents, read_large_document
from sparkmart.sources.large_documents import read_pieces

RECORD = (
    T.StructType()
    .add("name", T.StringType())
    .add("size", T.LongType())
    .add("tags", T.MapType(T.StringType(), T.StringType()))
    .add("parts", T.ArrayType(T.StructType().add("a", T.StringType())))
)
SMALL = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def small_blocks(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def records(seed, count):
    dealer = random.Random(seed)
    pieces = ["word", "{", "}", '"', "\\", "}}", '{"a":', "\\\\", "é", "\n", "[", "x" * 40, '\\"}']

    def text():
        return "".join(dealer.choice(pieces) for _ in range(dealer.randrange(9)))

    return [
        (f"{n}{text()}", n, {text(): text()} if n % 3 else None, [{"a": text()}] * (n % 4))
        for n in range(count)
    ]


def document(rows, **layout):
    named = {name: {"name": name, "size": size, "tags": tags, "parts": parts} for name, size, tags, parts in rows}
    return json.dumps({"data_products": named}, **layout)


def plain(df):
    return sorted((r["name"], r["size"], r["tags"], [p.asDict() for p in r["parts"]]) for r in df.collect())


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_entries_against_what_was_written(spark, tmp_path, small_blocks, layout):
    expected = []
    for number in range(2):
        rows = records(number, 40)
        end = "\n" if number else ""
        (tmp_path / f"d{number}.json").write_text(document(rows, **layout) + end)
        expected += rows
    assert read_pieces(spark, str(tmp_path)).select("block").distinct().count() > 20
    assert plain(read_large_document(spark, str(tmp_path), RECORD)) == sorted(expected)


def test_as_the_whole_file_reader(spark, tmp_path):
    rows = records(9, 15)
    (tmp_path / "d.json").write_text(document(rows, indent=1))
    whole = read_documents(spark, str(tmp_path), RECORD, whole_file=True)
    assert plain(read_large_document(spark, str(tmp_path), RECORD)) == plain(whole) == sorted(rows)


@pytest.mark.parametrize("text, names", [
    ('{"data_products": {}}', []),
    (' {"data_products" : { } } \n', []),
    ('{"data_products":{"a":{"name":"}"}}}', ["}"]),
    ('{"data_products":{"a":{"name":"x"},"b":null}}', [None, "x"]),
    ('{"data_products":{"a":null,"b":{"name":"x"}}}', [None, "x"]),
])
def test_small_documents(spark, tmp_path, small_blocks, text, names):
    (tmp_path / "d.json").write_text(text)
    found = [row["name"] for row in read_large_document(spark, str(tmp_path), RECORD).collect()]
    assert sorted(found, key=str) == sorted(names, key=str)


@pytest.mark.parametrize("text", [
    '{"data_products": {"a": {"name": "x"}, "b": {"na',
    '{"data_products": {"a": {"name": "x"}',
    '{"data_products": {"a": {"name": "x"}}',
    '{"products": {"a": {"name": "x"}}}',
    '{"data_products": {"a": {"size": "x"}}}',
    '{"data_products": {"a": {"name": "x"} "b": {"name": "y"}}}',
])
def test_broken_documents_end_the_read(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|cannot|unexpected"):
        read_large_document(spark, str(tmp_path), RECORD).collect()


def test_no_frame_reaches_ahead(spark, tmp_path, plan_of):
    """Spark computes a frame that begins at a row and reaches to the end of its partition anew for
    each row, so the time grew with the square of the pieces of a block."""
    (tmp_path / "d.json").write_text(document(records(3, 9)))
    plan = plan_of(read_large_document(spark, str(tmp_path), RECORD), "extended").lower()
    assert "specifiedwindowframe(rowframe, unboundedpreceding$()" in plan
    assert not re.search(r"specifiedwindowframe\(rowframe, (?!unboundedpreceding)[^,]*, unboundedfollowing", plan)
