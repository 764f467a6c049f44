"""Raw landing: records kept as JSON text, typed again when read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_ID = "raw_id"
LOADED_AT = "loaded_at"
PAYLOAD = "payload"
RECORD = "record"


def land_raw(df: DataFrame) -> DataFrame:
    """Each row as (raw_id, loaded_at, payload); NULL columns stay in the payload.

    The ids are random, so write the result once and read it from there: a
    recomputed partition would carry other ids.
    """
    return df.select(
        F.expr("uuid()").alias(RAW_ID),
        F.current_timestamp().alias(LOADED_AT),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(PAYLOAD),
    )


def with_record(raw: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """The raw columns and ``record``, the payload as one parsed value; NULL where the text is not
    exactly one JSON value.

    Land this where records are read often: they are parsed once and not on each read. The
    parser stops at the end of the first value, so the text is parsed within an object whose last
    member is a word drawn anew for each call, which must still be found there.
    """
    seal = uuid.uuid4().hex
    sealed = F.concat(F.lit('{"r":'), F.col(payload), F.lit(f',"{seal}":true}}'))
    whole = F.try_variant_get("_parsed", f"$.{seal}", "boolean")
    return _once(raw, "_parsed", F.try_parse_json(sealed)).select(
        *raw.columns, F.when(whole, F.try_variant_get("_parsed", "$.r", "variant")).alias(RECORD)
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column computed once: exploding a one-element array keeps it below later
    filters, which would else repeat it for every condition that reads it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _is(found: Column, *names: str) -> Column:
    """Whether a value's type, as text, is one of ``names``; those with a bracket take any numbers."""
    tests = [found.startswith(name) if name.endswith("(") else found == name for name in names]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def _typed(value: Column, found: Column, kind: T.DataType) -> Column:
    """The value as ``kind``, or NULL. Text in place of a number is not tried: each failure costs
    as much as many records."""
    typed = F.try_variant_get(value, "$", kind.simpleString())
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.when(found != "STRING", typed)
    return typed


def _members(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _sound(value: Column, found: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether a parsed value, whose type is ``found``, or no value, is one of ``kind``."""
    missing = value.isNull() | _is(found, "VOID")
    if isinstance(kind, T.VariantType):
        return F.lit(True)
    if isinstance(kind, T.StructType):
        members = _members(value)
        fits = _well_named(members, kind)
        for field in kind.fields:
            fits = fits & _item_sound(F.try_element_at(members, F.lit(field.name)), field.dataType)
        fits = found.startswith("OBJECT") & fits
    elif isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        fits = F.forall(items, lambda item: _item_sound(item, kind.elementType))
    elif isinstance(kind, T.MapType):
        items = F.map_values(_members(value))
        fits = F.forall(items, lambda item: _item_sound(item, kind.valueType))
    elif isinstance(kind, T.IntegralType):
        fits = typed.isNotNull() & (
            _is(found, "BIGINT") | (found.startswith("DECIMAL(") & found.endswith(",0)"))
        )
    elif isinstance(kind, T.DecimalType):
        fits = typed.isNotNull() & _is(found, "BIGINT", "DECIMAL(", "DOUBLE", "FLOAT")
    elif isinstance(kind, T.NumericType):
        finite = F.abs(typed) < float("inf")
        fits = finite & _is(found, "DOUBLE", "DECIMAL(", "BIGINT", "FLOAT")
    elif isinstance(kind, T.BooleanType):
        fits = _is(found, "BOOLEAN")
    elif isinstance(kind, T.StringType):
        fits = _is(found, "STRING")
    else:
        fits = typed.isNotNull() & _is(found, "STRING")
    return missing | F.coalesce(fits, F.lit(False))


def _item_sound(value: Column, kind: T.DataType) -> Column:
    found = F.schema_of_variant(value)
    return _sound(value, found, _typed(value, found, kind), kind)


def _well_named(members: Column, schema: T.StructType) -> Column:
    """Whether no declared member is there only under a name in other case."""
    names = F.concat(F.lit("\0"), F.array_join(F.map_keys(members), "\0"), F.lit("\0"))
    fits = F.lit(True)
    for name in schema.names:
        exact = F.contains(names, F.lit(f"\0{name}\0"))
        fits = fits & (exact | ~F.contains(F.lower(names), F.lit(f"\0{name.lower()}\0")))
    return F.coalesce(fits, F.lit(False))


def parse_raw(raw: DataFrame, schema: T.StructType, payload: str = PAYLOAD) -> DataFrame:
    """The raw columns, the typed columns, and ``fits``: whether the record is sound.

    A record does not fit when its text is missing, empty, not exactly one JSON object, or holds a
    value of another type; the typed columns of such a row mean nothing. Text is no number, be it
    "1" or "NaN", a fraction is no whole number, and numbers beyond their type, infinity
    included, do not fit. Members are named exactly: a record that has a declared member under a name
    in other case only does not fit, as it would be read as missing. Other members are ignored.

    The text is parsed once, or not at all where ``raw`` has a ``record`` by ``with_record``.
    """
    landed = RECORD in raw.columns and isinstance(raw.schema[RECORD].dataType, T.VariantType)
    records = raw if landed else with_record(raw, payload)
    is_object = F.schema_of_variant(RECORD).startswith("OBJECT")
    opened = _once(records, "_members", F.when(is_object, _members(F.col(RECORD))))
    places = [(f"_{place}", field) for place, field in enumerate(schema.fields)]

    def each(of) -> Column:
        return F.struct(*[of(name, field).alias(name) for name, field in places])

    opened = _once(
        opened, "_value", each(lambda _, field: F.try_element_at("_members", F.lit(field.name)))
    )
    opened = _once(opened, "_found", each(lambda name, _: F.schema_of_variant(f"_value.{name}")))
    opened = _once(
        opened,
        "_typed",
        each(
            lambda name, field: _typed(
                F.col(f"_value.{name}"), F.col(f"_found.{name}"), field.dataType
            )
        ),
    )
    fits = F.col("_members").isNotNull() & _well_named(F.col("_members"), schema)
    for name, field in places:
        value, found, typed = [F.col(f"{of}.{name}") for of in ("_value", "_found", "_typed")]
        fits = fits & _sound(value, found, typed, field.dataType)
    return _once(opened, "_fits", F.coalesce(fits, F.lit(False))).select(
        *[f"`{name}`" for name in raw.columns],
        *[F.col(f"_typed.{name}").alias(field.name) for name, field in places],
        F.col("_fits").alias("fits"),
    )


def read_raw(
    raw: DataFrame, schema: T.StructType, payload: str = PAYLOAD
) -> tuple[DataFrame, DataFrame]:
    """Split raw records into typed rows and a quarantine of those that do not fit.

    The quarantine keeps the raw columns whole. Each of the two parses the records once, unless
    they are landed ``with_record``; whoever needs both from one pass takes ``parse_raw``.
    """
    parsed = parse_raw(raw, schema, payload)
    return parsed.where("fits").select(*schema.names), parsed.where("not fits").select(
        *raw.columns
    )
