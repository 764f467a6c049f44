"""The declared test-table schemas, against what the files say."""

import pytest
from pyspark.sql import types as T

from sparkmart.sources import struct_from_json_schema
from sparkmart.workload.tables import SCHEMAS


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_declared_schema_fits_the_file(spark, sf_dir, name):
    stored = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    declared = T.StructType.fromDDL(SCHEMAS[name])
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in declared]


def test_json_schema_types():
    schema = struct_from_json_schema(
        {
            "type": "object",
            "properties": {
                "id": {"type": ["number", "null"]},
                "name": {"type": ["string", "null"], "description": "who"},
                "age": {"type": "integer"},
                "active": {"type": ["null", "boolean"]},
            },
        }
    )
    assert [f.dataType.simpleString() for f in schema] == ["double", "string", "bigint", "boolean"]
    assert all(f.nullable for f in schema)
    assert schema["name"].metadata == {"comment": "who"}


@pytest.mark.parametrize("declared", [["object", "null"], ["null"], None, ["string", "number"]])
def test_json_schema_refuses_other_types(declared):
    with pytest.raises(ValueError, match="unsupported type"):
        struct_from_json_schema({"properties": {"x": {"type": declared}}})


def test_json_schema_refuses_other_roots():
    with pytest.raises(ValueError, match="object"):
        struct_from_json_schema({"type": "array"})
