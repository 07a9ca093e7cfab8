"""Enum numbers and set bit masks as labels, and back. Index or bit -1 marks the default label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Label

NO_DEFAULT = "\0"


def _parts(labels: Sequence[Label]) -> tuple[dict[int, str], str | None]:
    """Labels by number (the last of equal ones) and the default."""
    return {x.index: x.const for x in labels if x.index != -1}, next((x.const for x in reversed(labels) if x.index == -1), None)


def enum_label(index: Column, labels: Sequence[Label]) -> tuple[Column, Column]:
    """The label, else the default; without one an error text."""
    known, default = _parts(labels)
    found = F.lit(None).cast("string")
    if known:
        table = F.create_map(*(F.lit(x).cast(t) for pair in known.items() for x, t in zip(pair, ("bigint", "string"), strict=True)))
        found = F.try_element_at(table, index)
    out = F.coalesce(found, F.lit(default).cast("string"))
    out = F.when(index.isNotNull(), out)
    return out, F.when(index.isNotNull() & out.isNull(), F.concat(F.lit("no label for enum value "), index.cast("string")))


def enum_index(label: Column, labels: Sequence[Label]) -> tuple[Column, Column]:
    """The number of a label; an error text if there is none."""
    known, _ = _parts(labels)
    table = F.create_map(*(F.lit(x).cast(t) for i, c in known.items() for x, t in ((c, "string"), (i, "bigint")))) if known else None
    out = F.try_element_at(table, label) if table is not None else F.lit(None).cast("bigint")
    return out, F.when(label.isNotNull() & out.isNull(), F.concat(F.lit("no enum value for label "), label))


def set_label(mask: Column, labels: Sequence[Label]) -> Column:
    """Labels of the set bits, by ascending bit, with commas; 0 gives an empty text, unknown bits alone the default."""
    known, default = _parts(labels)
    names = F.array(*(F.when(mask.bitwiseAND(F.lit(bit).cast("bigint")) != 0, F.lit(known[bit])) for bit in sorted(known)), F.lit(None).cast("string"))
    joined = F.array_join(F.filter(names, lambda x: x.isNotNull()), ",")
    return F.when(mask == 0, F.lit("")).when(joined != "", joined).when(mask.isNotNull(), F.lit(default or ""))


def label_table(spark: SparkSession, labels: Sequence[Label]) -> DataFrame:
    """The labels of a configuration: const, index, is_default."""
    return spark.createDataFrame([(x.const, x.index, x.index == -1) for x in labels], "const string, index bigint, is_default boolean")
