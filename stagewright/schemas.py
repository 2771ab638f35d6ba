"""Schemas that change from day to day: the type that holds both, and values cast to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers from narrow to wide, with the digits that hold them.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_BROKEN = (T.FloatType, T.DoubleType)
_PLAIN = (*_WHOLE, *_BROKEN, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


class SchemaClash(ValueError):
    """Two types of one field that no type holds both of."""


def nullable(kind: T.DataType) -> T.DataType:
    """The type as files give it back: everything in it may be null, nothing has metadata."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind


def _decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_WHOLE[type(kind)], 0)


def wider(a: T.DataType, b: T.DataType, field: str = "") -> T.DataType:
    """The type that holds values of both.

    Whole numbers become the wider one, with a fraction on either side a decimal or a double, a date
    and a timestamp a timestamp, and any other plain values text. Structs are widened by field,
    arrays and maps by what they hold. A nested value and a plain one, or bytes and another
    type, are a ``SchemaClash``.
    """
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_rows(a, b, field)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, f"{field}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        keys = wider(a.keyType, b.keyType, f"{field} keys")
        return T.MapType(keys, wider(a.valueType, b.valueType, f"{field} values"))
    if a == b:
        return a
    if not (isinstance(a, _PLAIN) and isinstance(b, _PLAIN)):
        raise SchemaClash(f"field {field} is {a.simpleString()} on some days and {b.simpleString()} on others")
    whole = tuple(_WHOLE)
    if isinstance(a, whole) and isinstance(b, whole):
        return max(a, b, key=lambda kind: _WHOLE[type(kind)])
    exact = (*whole, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        left, right = _decimal(a), _decimal(b)
        scale = max(left.scale, right.scale)
        digits = max(left.precision - left.scale, right.precision - right.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, (*exact, *_BROKEN)) and isinstance(b, (*exact, *_BROKEN)):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def wider_rows(a: T.StructType, b: T.StructType, field: str = "") -> T.StructType:
    """All fields of both, those of ``a`` first; names are matched without regard to case."""
    other = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        twin = other.pop(f.name.lower(), None)
        name = f"{field}.{f.name}" if field else f.name
        out.append(T.StructField(f.name, f.dataType if twin is None else wider(f.dataType, twin.dataType, name)))
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in other.values()])


def _cast(value: Column, now: T.DataType, to: T.DataType) -> Column:
    if now == to:
        return value
    if isinstance(to, T.StructType):
        own = {f.name.lower(): f for f in now.fields}
        parts = []
        for f in to.fields:
            twin = own.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if twin is None else _cast(value[twin.name], twin.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, now.elementType, to.elementType))
    if isinstance(to, T.MapType):
        keyed = F.transform_keys(value, lambda k, v: _cast(k, now.keyType, to.keyType))
        return F.transform_values(keyed, lambda k, v: _cast(v, now.valueType, to.valueType))
    return value.cast(to)


def as_rows(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """The frame in the columns of a wider schema, null where it has none, followed by ``more``.

    A column that is as it should be stays the stored one: under a name given anew, Spark would not
    see that two joins of it shuffle the same rows.
    """
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        twin = own.get(f.name.lower())
        if twin is not None and (twin.name, twin.dataType) == (f.name, f.dataType):
            columns.append(F.col(f"`{f.name}`"))
            continue
        value = F.lit(None).cast(f.dataType) if twin is None else _cast(F.col(f"`{twin.name}`"), twin.dataType, f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns, *more)
