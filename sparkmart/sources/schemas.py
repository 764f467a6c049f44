"""Column types declared as JSON Schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

# JSON Schema type name -> column type.
JSON_TYPES: dict[str, T.DataType] = {
    "number": T.DoubleType(),
    "string": T.StringType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
}


def struct_from_json_schema(schema: Mapping) -> T.StructType:
    """Spark schema for a flat JSON Schema object; every column is nullable.

    A property's ``type`` is a name or a list of one name and ``"null"``.
    """
    if schema.get("type", "object") != "object":
        raise ValueError("the top level of a stream schema must be an object")
    fields = []
    for name, spec in schema.get("properties", {}).items():
        declared = spec.get("type")
        kinds = [declared] if isinstance(declared, str) else list(declared or [])
        kinds = [kind for kind in kinds if kind != "null"]
        if len(kinds) != 1 or kinds[0] not in JSON_TYPES:
            raise ValueError(f"column {name!r}: unsupported type {declared!r}")
        metadata = {"comment": spec["description"]} if "description" in spec else {}
        fields.append(T.StructField(name, JSON_TYPES[kinds[0]], True, metadata))
    return T.StructType(fields)
