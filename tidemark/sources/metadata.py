"""Columns and keys of tables: from a database's catalogue, from a DataFrame's schema, or found in the rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "table_name string, column_name string, position int, type_name string, nullable boolean, key_position int"


def schema_columns(table: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """A row for each column of a DataFrame, in order: with its place in the key, or null."""
    rows = [(name, f.name, i + 1, f.dataType.simpleString(), f.nullable, list(keys).index(f.name) + 1 if f.name in keys else None) for i, f in enumerate(table.schema)]
    return table.sparkSession.createDataFrame(rows, COLUMNS).orderBy("position")


def database_columns(spark: SparkSession, url: str, schema: str | None = None, table: str = "%", **options: Any) -> DataFrame:
    """The same from a database's catalogue, by table and position; key places are those of declared primary keys.

    It reads names alone, a row for each column that fits the pattern ``table``, on the driver.
    """
    properties = spark._jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, str(v))
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        told = connection.getMetaData()
        rows, found = [], told.getColumns(None, schema, table, "%")
        while found.next():
            rows.append((found.getString("TABLE_NAME"), found.getString("COLUMN_NAME"), found.getInt("ORDINAL_POSITION"), found.getString("TYPE_NAME"), found.getString("IS_NULLABLE") == "YES"))
        places = {}
        for name in {r[0] for r in rows}:
            keys = told.getPrimaryKeys(None, schema, name)
            while keys.next():
                places[name, keys.getString("COLUMN_NAME")] = keys.getInt("KEY_SEQ")
    finally:
        connection.close()
    return spark.createDataFrame([(*r, places.get(r[:2])) for r in rows], COLUMNS).orderBy("table_name", "position")


def declared_key(columns: DataFrame, table: str) -> list[str]:
    """The key's columns in order, of rows as the functions above give them."""
    own = columns.where((F.col("table_name") == table) & F.col("key_position").isNotNull()).orderBy("key_position")
    return [r["column_name"] for r in own.collect()]


def unique_keys(rows: DataFrame, columns: Sequence[str] = (), width: int = 4, deviations: float = 4.0, rsd: float = 0.02) -> list[tuple[str, ...]]:
    """The minimal sets of up to ``width`` columns that tell all rows apart, null being a value of its own.

    It walks the lattice of column sets upwards. A set that holds a unique one isn't minimal, and a set whose columns'
    numbers of values multiply to fewer than there are rows can't be unique. One pass estimates the distinct values of
    all sets that are left of a size; those within ``deviations`` of the number of rows are proved by an exact count, in
    which a repeated set of values ends as a row for each task that has it.
    """
    columns = list(columns) or [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    names = [c for c in columns if c in rows.columns]
    value = lambda own: F.struct(*(F.col(f"`{c}`") for c in own))
    total = rows.count()
    least = total * (1 - deviations * rsd)
    known: dict[frozenset, float] = {}
    keys: list[tuple[str, ...]] = []
    for size in range(1, width + 1):
        sets = [s for s in combinations(names, size) if not any(set(k) <= set(s) for k in keys)]
        # Upper bounds: the product of what is known of a set's two parts.
        bound = lambda s: min((known.get(frozenset(s) - {c}, 0) * known[frozenset([c])] for c in s), default=0) if len(s) > 1 else total
        sets = [s for s in sets if bound(s) >= least]
        if not sets:
            continue
        told = rows.agg(*(F.approx_count_distinct(F.xxhash64(value(s), *(F.col(f"`{c}`").isNull() for c in s)), rsd).alias(f"n{i}") for i, s in enumerate(sets))).first()
        for i, s in enumerate(sets):
            known[frozenset(s)] = told[f"n{i}"] * (1 + deviations * rsd)
            if told[f"n{i}"] >= least and not rows.groupBy(*(F.col(f"`{c}`") for c in s)).count().where("count > 1").limit(1).count():
                keys.append(s)
    return keys
