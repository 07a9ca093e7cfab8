"""Guarded conversions to target types: each gives a value and, where it can't be had, an error text.

Spark's own casts are wider than the rules here (they trim blanks, read ``1d`` or the date ``2024``), so texts pass a
pattern first. Empty texts count as 0, and as no time at all. Unsigned 64-bit numbers become decimal(20, 0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Converted = tuple[Column, Column]

TRUE_WORDS = ("true", "1", "yes", "on")
TRUE_WORDS_DOCUMENT = (*TRUE_WORDS, "y")

#: Text forms of times in the order in which they are tried: a pattern, and the format for what it fits.
TIME_FORMS = (
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6}$", "yyyy-MM-dd HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd'T'HH:mm:ssXXX"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}(Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]XXX"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
)


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _failed(value: Column, result: Column, what: str) -> Column:
    """An error text where a value was there and the result isn't."""
    return F.when(value.isNotNull() & result.isNull(), F.concat(F.lit(f"cannot convert to {what}: "), value.cast("string")))


def to_int(value: Column, kind: T.DataType) -> Converted:
    if isinstance(kind, T.BooleanType):
        out = value.cast("int").cast("bigint")
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        out = value.try_cast("bigint")
    elif isinstance(kind, T.StringType):
        out = F.when(value == "", F.lit(0).cast("bigint")).when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("bigint"))
    else:
        out = value.try_cast("bigint")
    return out, _failed(value, out, "int")


def to_uint(value: Column, kind: T.DataType, wide: bool = False) -> Converted:
    to = "decimal(20,0)" if wide else "bigint"
    most = F.lit("18446744073709551615" if wide else "9223372036854775807").cast("decimal(20,0)")
    if isinstance(kind, T.BooleanType):
        out = value.cast("int").cast(to)
    elif isinstance(kind, T.StringType):
        number = F.when(value == "", F.lit("0")).when(value.rlike(r"^[0-9]{1,20}$"), value).try_cast("decimal(20,0)")
        out = F.when(number <= most, number.try_cast(to))
    else:
        out = F.when(value >= 0, (F.floor(value) if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)) else value).try_cast(to))
    return out, _failed(value, out, "uint")


def to_float(value: Column, kind: T.DataType) -> Converted:
    if isinstance(kind, T.BooleanType):
        out = value.cast("int").cast("double")
    elif isinstance(kind, T.StringType):
        out = F.when(value == "", F.lit(0.0)).when(value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), value.try_cast("double"))
    else:
        out = value.try_cast("double")
    return out, _failed(value, out, "float")


def to_text(value: Column, kind: T.DataType) -> Converted:
    if isinstance(kind, T.BinaryType):
        return F.decode(value, "UTF-8"), _none()
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value), _none()
    return value.cast("string"), _none()


def parse_time(text: Column) -> Column:
    """A timestamp in the session's time zone from one of TIME_FORMS, else null; fractions beyond microseconds are cut."""
    fine = F.regexp_replace(text, r"(:\d{2}\.\d{6})\d{1,3}(?=$|Z|[+-])", "$1")
    return F.coalesce(*(F.when(fine.rlike(pattern), F.try_to_timestamp(fine, F.lit(form))) for pattern, form in TIME_FORMS))


def to_time(value: Column, kind: T.DataType) -> Converted:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp"), _none()
    if isinstance(kind, T.StringType):
        out = parse_time(value)
        return out, F.when(value != "", _failed(value, out, "datetime"))
    out = F.timestamp_seconds(value.try_cast("bigint"))
    return out, _failed(value, out, "datetime")


def to_date(value: Column, kind: T.DataType) -> Converted:
    out, error = to_time(value, kind)
    return out.cast("date"), error


def to_bool(value: Column, kind: T.DataType, words: tuple[str, ...] = TRUE_WORDS) -> Converted:
    if isinstance(kind, T.BooleanType):
        return value, _none()
    if isinstance(kind, T.StringType):
        return F.lower(value).isin(*words), _none()
    if isinstance(kind, T.NumericType):
        return value != 0, _none()
    out = F.lower(value.cast("string")).isin(*words)
    return out, _none()


def to_index(value: Column, kind: T.DataType) -> Converted:
    """A whole number for enum and set columns; an empty text is 0."""
    return to_int(value, kind)


#: By lower-case name; names that documents use for the same come last. Other names leave the value as it is.
CONVERSIONS: dict[str, Callable[[Column, T.DataType], Converted]] = {
    **{f"uint{n}": to_uint for n in (8, 16, 32)},
    "uint64": lambda v, k: to_uint(v, k, wide=True),
    **{f"int{n}": to_int for n in (8, 16, 32, 64)},
    "float32": to_float, "float64": to_float, "string": to_text, "datetime": to_time, "date": to_date, "bool": to_bool, "boolean": to_bool,
    "int": to_int, "float": to_float, "double": to_float,
}

#: Spark types of the results, for what comes after a conversion.
RESULT_TYPES: dict[str, T.DataType] = {
    **{n: T.LongType() for n in ("uint8", "uint16", "uint32", "int8", "int16", "int32", "int64", "int")},
    "uint64": T.DecimalType(20, 0), "float32": T.DoubleType(), "float64": T.DoubleType(), "float": T.DoubleType(), "double": T.DoubleType(),
    "string": T.StringType(), "datetime": T.TimestampType(), "date": T.DateType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
}


def convert(value: Column, kind: T.DataType, name: str, sink: str = "table") -> Converted:
    """``value`` (of Spark type ``kind``) as the named type, and an error text or null."""
    plain = name.strip().lower()
    if plain in ("bool", "boolean"):
        return to_bool(value, kind, TRUE_WORDS if sink == "table" else TRUE_WORDS_DOCUMENT)
    if plain not in CONVERSIONS:
        return value, _none()
    return CONVERSIONS[plain](value, kind)
