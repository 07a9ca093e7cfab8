"""The field mapper: a table's configuration becomes one projection.

For each column in turn: ignored, read (a missing column counts as null), required, condition, then default, transform,
enum, set or copy (the first that applies), type conversion, name. The last mapping of a target wins; one whose
condition isn't met leaves the target to an earlier one. Null and empty text count as missing. An error rejects the
whole row; errors are collected in ``ERRORS`` and nothing is raised, so that one bad row never ends a job.

Everything is a native expression: Spark reads only the mapped columns and pushes the table's row filter to the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ColumnMapping, TableConfig
from ..functions.conditions import condition
from ..functions.convert import RESULT_TYPES, convert, to_index
from ..functions.labels import enum_label, set_label
from ..functions.transform import transform

ERRORS = "_errors"


@dataclass(frozen=True)
class MappedColumn:
    target: str
    value: Column
    #: Is the target written for this row? None: always.
    met: Column | None
    errors: tuple[Column, ...]


def _missing(value: Column, kind: T.DataType) -> Column:
    return value.isNull() | (value == "") if isinstance(kind, T.StringType) else value.isNull()


def _default_text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def map_column(mapping: ColumnMapping, schema: T.StructType, sink: str = "table", semantics: str = "documented") -> MappedColumn:
    """The projection of one column of rows with this schema."""
    target = mapping.target or mapping.source
    there = mapping.source in schema.names
    kind = schema[mapping.source].dataType if there else T.StringType()
    value = F.col(f"`{mapping.source}`") if there else F.lit(None).cast("string")
    missing = _missing(value, kind)
    errors: list[Column] = []
    if mapping.required:
        errors.append(F.when(missing, F.lit(f"required column is missing: {mapping.source}")))
    met = None
    if mapping.condition:
        met, error = condition(mapping.condition, value, semantics)
        errors.append(error)
    name = mapping.type.strip().lower()
    to_label = (name == "enum2string" and mapping.enum) or (name == "set2string" and mapping.set)
    problem = F.lit(None).cast("string")
    if mapping.transform:
        out, out_kind = transform(mapping.transform, value, kind, semantics)
        out = F.when(value.isNotNull(), out) if "{{value}}" in mapping.transform or "(" not in mapping.transform else out
    elif name == "enum2string" and to_label:
        index, problem = to_index(value, kind)
        out, bad = enum_label(index, mapping.enum)
        problem, out_kind = F.coalesce(problem, bad), T.StringType()
    elif name == "set2string" and to_label:
        mask, problem = to_index(value, kind)
        out, out_kind = set_label(mask, mapping.set), T.StringType()
    else:
        out, out_kind = value, kind
    converted, error = (out, F.lit(None).cast("string")) if to_label else convert(out, out_kind, name, sink)
    error = F.coalesce(problem, error)
    result_kind = out_kind if to_label or name not in RESULT_TYPES else RESULT_TYPES[name]
    if mapping.default is not None:
        # A default passes by the transform, not by the conversion.
        text = F.lit(_default_text(mapping.default))
        fill, fill_error = convert(text, T.StringType(), name, sink)
        converted = F.when(missing, fill.try_cast(result_kind.simpleString())).otherwise(converted)
        error = F.when(missing, fill_error).otherwise(error)
        if met is not None and mapping.on_unmet == "default":
            converted, met = F.when(met, converted).otherwise(fill.try_cast(result_kind.simpleString())), None
    errors.append(error if met is None else F.when(met, error))
    return MappedColumn(target, converted, met, tuple(errors))


def map_columns(table: TableConfig, schema: T.StructType, sink: str = "table", semantics: str = "documented") -> tuple[list[Column], Column]:
    """The select list in order of the targets' first mention, and the array of a row's errors."""
    values: dict[str, Column] = {}
    errors: list[Column] = []
    for mapping in table.columns:
        if mapping.ignore:
            continue
        one = map_column(mapping, schema, sink, semantics)
        earlier = values.get(one.target)
        if one.met is None:
            values[one.target] = one.value
        else:
            values[one.target] = F.when(one.met, one.value) if earlier is None else F.when(one.met, one.value).otherwise(earlier)
        errors += one.errors
    found = F.filter(F.array(*errors, F.lit(None).cast("string")), lambda e: e.isNotNull())
    return [v.alias(name) for name, v in values.items()], found


def map_rows(rows: DataFrame, table: TableConfig, sink: str = "table", semantics: str = "documented", keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` projected to the table's targets, with their errors and the columns named in ``keep`` after them."""
    chosen = rows.where(F.expr(table.where)) if table.where else rows
    values, errors = map_columns(table, rows.schema, sink, semantics)
    return chosen.select(*values, *(F.col(k) for k in keep), errors.alias(ERRORS))


def mapped_by_target(parts: Sequence[tuple[DataFrame, TableConfig]], sink: str = "table", semantics: str = "documented") -> dict[str, DataFrame]:
    """Valid rows of several source tables by the target that they go to; columns that one source lacks are null."""
    out: dict[str, DataFrame] = {}
    for rows, config in parts:
        mapped = valid_rows(map_rows(rows, config, sink, semantics))
        earlier = out.get(config.target_name)
        out[config.target_name] = mapped if earlier is None else earlier.unionByName(mapped, allowMissingColumns=True)
    return out


def valid_rows(mapped: DataFrame) -> DataFrame:
    return mapped.where(F.size(ERRORS) == 0).drop(ERRORS)


def rejected_rows(rows: DataFrame, table: TableConfig, sink: str = "table", semantics: str = "documented") -> DataFrame:
    """The source rows that can't be mapped, with their errors: they are kept as they came and mapped once it works."""
    chosen = rows.where(F.expr(table.where)) if table.where else rows
    _, errors = map_columns(table, rows.schema, sink, semantics)
    return chosen.withColumn(ERRORS, errors).where(F.size(ERRORS) > 0)
