"""Batches, quotas by priority, statistics and positions of change streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .changes import free_name


def batch_statistics(events: DataFrame, order: str, size: int, failed: Column, time: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows cut into batches of ``size`` consecutive numbers of ``order``: rows, errors, seconds from first to last."""
    cut = F.floor(F.col(order) / size).cast("bigint").alias("batch")
    seconds = F.unix_seconds(F.max(time).cast("timestamp")) - F.unix_seconds(F.min(time).cast("timestamp"))
    return events.groupBy(*group, cut).agg(F.count("*").alias("n_rows"), F.sum(failed.cast("bigint")).alias("n_errors"), seconds.alias("seconds"))


def row_batches(events: DataFrame, order: str, size: int, width: int = 1_000_000) -> DataFrame:
    """``events`` with ``batch``: every ``size`` rows in the order of a whole number, from 0; null comes last, equal numbers in no set order.

    Ranges of ``width`` numbers are counted and numbered apart; only their counts, a row per range, are put in one order.
    """
    part = F.floor(F.col(order) / width)
    counts = events.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy(F.asc_nulls_last("_part"))) - F.col("_n")).alias("_before"))
    before = before.withColumnRenamed("_part", "_range")
    placed = events.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    return placed.join(before, F.col("_part").eqNullSafe(F.col("_range"))).withColumn("batch", F.floor((F.col("_before") + F.col("_place") - 1) / size).cast("bigint")).drop("_part", "_range", "_place", "_before")


def shed_low_priority(events: DataFrame, time: str, tie: str, priority: str = "priority", per_second: int = 1000) -> DataFrame:
    """All other rows stay; low-priority rows get what these leave of each second's ``per_second`` places, in order.

    Other rows, those without a priority too, are only counted by second. Of low-priority rows no task sends more than
    ``per_second`` of a second on (up to Spark's ``windowGroupLimitThreshold``), as later ones can't get a place.
    """
    second, place, of, taken = (free_name(events.columns, n) for n in ("_second", "_place", "_of", "_taken"))
    low = F.col(priority).eqNullSafe("low")
    rest, by_second = events.where(~low), F.unix_seconds(F.col(time).cast("timestamp"))
    counts = rest.groupBy(by_second.alias(of)).agg(F.count("*").alias(taken))
    order = F.row_number().over(Window.partitionBy(second).orderBy(time, tie))
    asked = events.where(low).withColumn(second, by_second).withColumn(place, order).where(F.col(place) <= per_second)
    given = asked.join(counts, F.col(second).eqNullSafe(F.col(of)), "left").where(F.col(place) <= per_second - F.coalesce(F.col(taken), F.lit(0)))
    return rest.union(given.select(*events.columns))


def positions(events: DataFrame, key: Sequence[str], order: str, time: str) -> DataFrame:
    """The last position of every stream and its time in seconds."""
    return events.groupBy(*key).agg(F.max(order).alias("position"), F.unix_seconds(F.max(time).cast("timestamp")).alias("timestamp"))


def routed(events: DataFrame, table_name: Column, patterns: Sequence[str]) -> DataFrame:
    """Events of the tables whose full name fits one of the patterns."""
    return events.where(table_name.rlike("|".join(f"^(?:{p})$" for p in patterns)) if patterns else F.lit(False))
