"""Rows that couldn't be mapped or written: classes, retries, retention.

A quarantine is a table of source rows with reason, attempts and next_retry_at. An attempt counts when the sink answers,
never when a row is queued; what has used up its attempts is permanent. Nothing is dropped without a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ATTEMPTS = 3
BASE_SECONDS, MOST_SECONDS = 1, 30

# Words in an error text that tell its class.
TEMPORARY = ("timeout", "connection", "network", "unavailable", "too many")
FORMAT = ("cannot convert", "parse", "format", "required column", "no label", "needs numbers")
SCHEMA = ("unknown column", "no such column", "schema")
CONFIGURATION = ("unknown table", "no such table", "configuration")


def failure_class(error: Column) -> Column:
    """temporary, format, schema, config or unknown; null errors are unknown."""
    text = F.lower(error)
    has = lambda words: F.coalesce(text.rlike("|".join(words)), F.lit(False))
    return F.when(has(TEMPORARY), "temporary").when(has(FORMAT), "format").when(has(SCHEMA), "schema").when(has(CONFIGURATION), "config").otherwise("unknown")


def backoff_seconds(attempts: Column) -> Column:
    """1, 2, 4 ... seconds, 30 at most."""
    return F.least(F.lit(MOST_SECONDS), F.pow(F.lit(2), F.least(attempts, F.lit(30))) * BASE_SECONDS).cast("bigint")


def after_attempt(rows: DataFrame, now: Column) -> DataFrame:
    """Quarantined rows after another failed attempt: attempts, next_retry_at, status (waiting or permanent)."""
    counted = rows.withColumn("attempts", F.col("attempts") + 1)
    status = F.when((F.col("attempts") >= MAX_ATTEMPTS) | F.col("reason").isin("schema", "config"), "permanent").otherwise("waiting")
    wait = F.make_dt_interval(secs=backoff_seconds(F.col("attempts")).cast("decimal(18,6)"))
    return counted.withColumn("status", status).withColumn("next_retry_at", F.when(F.col("status") == "waiting", now + wait))


def due(rows: DataFrame, now: Column) -> DataFrame:
    """Rows whose next attempt is due."""
    return rows.where((F.col("status") == "waiting") & (F.col("next_retry_at") <= now))


def most_recent(rows: DataFrame, time: str, tie: str, count: int = 1000) -> DataFrame:
    """The rolling list of the latest failures."""
    return rows.orderBy(F.desc(time), F.desc(tie)).limit(count)


def within(rows: DataFrame, time: str, now: Column, hours: int = 24) -> DataFrame:
    """Rows that retention keeps."""
    return rows.where(F.col(time) >= now - F.expr(f"interval {int(hours)} hours"))


def write_dead_letters(rows: DataFrame, path: str, now: Column) -> None:
    """Appends rows (with database and table) as JSON, in folders by day, database and table."""
    rows.withColumn("saved_at", now).withColumn("day", F.date_format("saved_at", "yyyy-MM-dd")).write.mode("append").partitionBy("day", "database", "table").json(path)
