"""Keys, ids, topics and envelopes of rows on their way to documents and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: How times are written in JSON, and read from it: with all six digits of the second's fraction.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def primary_key(columns: Sequence[str], every: Sequence[str] = (), renamed: dict[str, str] | None = None) -> Column:
    """Key names and values as a map of texts; names as in the target if given. Without a key all columns of ``every`` count."""
    names, chosen = renamed or {}, columns or every
    return F.create_map(*(x for c in chosen for x in (F.lit(names.get(c, c)), F.col(c).cast("string")))) if chosen else F.create_map().cast("map<string,string>")


def document_id(columns: Sequence[str]) -> Column:
    """One key as text; several joined by ``_`` in order of their names; none: empty."""
    return F.concat_ws("_", *(F.col(c).cast("string") for c in sorted(columns)))


def topic(target: Column, database: Column, table: Column) -> Column:
    """The configured topic, else database and table with ``_`` for every dot."""
    return F.coalesce(F.nullif(target, F.lit("")), F.replace(F.concat_ws("_", database, table), F.lit("."), F.lit("_")))


def envelope(task: str, database: Column, table: Column, action: Column, data: Column, timestamp: Column, sync_time: Column) -> Column:
    """A message's value as JSON; null fields of ``data`` are kept, and times with their microseconds."""
    return F.to_json(
        F.struct(F.lit(task).alias("task_name"), database.alias("database"), table.alias("table"), action.alias("action"), data.alias("data"), timestamp.alias("timestamp"), sync_time.alias("sync_time")),
        {"ignoreNullFields": "false"} | JSON_TIMES,
    )


def row_fingerprint(database: Column, table: Column, action: Column, columns: Sequence[str]) -> Column:
    """A digest of where a row belongs, its action and its key, independent of the order of the key's columns."""
    own = F.struct(database.alias("database"), table.alias("table"), action.alias("action"), *(F.col(c).cast("string").alias(c) for c in sorted(columns)))
    return F.sha2(F.to_json(own, {"ignoreNullFields": "false"}), 256)


def sql_literal(value: Column, kind: T.DataType) -> Column:
    """A value as text for logs: never for statements, which take parameters."""
    if isinstance(kind, T.BooleanType):
        text = value.cast("int").cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit("'"), F.date_format(value, "yyyy-MM-dd HH:mm:ss"), F.lit("'"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.format_string("%f", value.cast("double"))
    elif isinstance(kind, T.NumericType):
        text = value.cast("string")
    else:
        text = F.concat(F.lit("'"), F.replace(value.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(text, F.lit("NULL"))


def logged_statement(template: str, values: Sequence[tuple[Column, T.DataType]]) -> Column:
    """A statement for logs: each ``?`` replaced by a value in order; places without a value stay. Statements that run take parameters."""
    parts = template.split("?")
    shown = [sql_literal(v, k) for v, k in values[: len(parts) - 1]]
    shown += [F.lit("?")] * (len(parts) - 1 - len(shown))
    return F.concat(F.lit(parts[0]), *(x for s, p in zip(shown, parts[1:], strict=True) for x in (s, F.lit(p))))


def too_large(value: Column, kind: T.DataType, text_bytes: int = 1_000_000, binary_bytes: int = 5_000_000) -> Column:
    """Is the value beyond what sinks take?"""
    return F.coalesce(F.octet_length(value) > (binary_bytes if isinstance(kind, T.BinaryType) else text_bytes), F.lit(False))
