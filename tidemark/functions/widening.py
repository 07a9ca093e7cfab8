"""Schemas that change: the least type that holds the values of two, without losing any.

Types form a lattice. Whole numbers widen to longer ones, then to decimals; floats to doubles; whole numbers of 32 bits to
doubles; dates to times; every plain type to text. Structs widen field by field and gain fields, arrays and maps by what
they hold. Binary values and text, or plain and nested types, have no common type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds both; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        try:
            return widened_schema(a, b)
        except ValueError:
            return None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        own = wider(a.elementType, b.elementType)
        return own and T.ArrayType(own)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(a, _NESTED) or isinstance(b, _NESTED) or isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType):
        return None
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    exact = [T.DecimalType(_DIGITS[type(t)], 0) if isinstance(t, _WHOLE) else t for t in (a, b)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale, digits = max(t.scale for t in exact), max(t.precision - t.scale for t in exact)
        return T.DecimalType(scale + digits, scale) if scale + digits <= 38 else T.StringType()
    floats = [isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)]
    if any(floats) and all(f or isinstance(t, _WHOLE[:3]) for f, t in zip(floats, (a, b), strict=True)):
        return T.DoubleType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def widened_schema(stored: T.StructType, arriving: T.StructType) -> T.StructType:
    """The stored columns, widened where arriving ones ask for it, and then the new ones. ``ValueError`` names what doesn't fit."""
    new = {f.name: f.dataType for f in arriving}
    fields, bad = [], []
    for f in stored:
        kind = wider(f.dataType, new[f.name]) if f.name in new else f.dataType
        if kind is None:
            bad.append(f"{f.name} ({f.dataType.simpleString()}, {new[f.name].simpleString()})")
        else:
            fields.append(T.StructField(f.name, kind))
    if bad:
        raise ValueError(f"schema: no type holds {', '.join(bad)}")
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in arriving if f.name not in stored.names])


def widened(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A value of a type as one of a wider type; fields that it lacks are null."""
    if kind == to:
        return value
    if isinstance(kind, T.StructType) and isinstance(to, T.StructType):
        fields = [(widened(value.getField(f.name), kind[f.name].dataType, f.dataType) if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in to]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: widened(x, kind.elementType, to.elementType))
    if isinstance(kind, T.MapType) and isinstance(to, T.MapType):
        return F.transform_values(F.transform_keys(value, lambda k, _: widened(k, kind.keyType, to.keyType)), lambda _, v: widened(v, kind.valueType, to.valueType))
    return value.cast(to)


def widened_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the columns of a schema that holds theirs."""
    own = rows.schema
    return rows.select(*((widened(F.col(f"`{f.name}`"), own[f.name].dataType, f.dataType) if f.name in own.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def united(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, in the wider of their schemas."""
    schema = widened_schema(left.schema, right.schema)
    return widened_rows(left, schema).unionAll(widened_rows(right, schema))
