"""Message rows (topic, key, value, headers) and where they go."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.documents import document_id, envelope, topic

#: As message producers are configured in the field: messages per request, milliseconds to wait, acknowledgements.
PRODUCER = {"kafka.batch.size": "102400", "kafka.linger.ms": "100", "kafka.acks": "1"}


def message_rows(rows: DataFrame, task: str, database: str, table: str, keys: tuple[str, ...], timestamp: Column, sync_time: Column, action: str | Column = "action", target: str = "", headers: dict[str, Column] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Every row as a message, keyed by its document id, so that changes of a key keep their order.

    ``columns`` are the row's; without them all but the action's. With ``headers`` (name to text) there is a column of them as the connector takes it.
    """
    does = F.col(action) if isinstance(action, str) else action
    data = F.struct(*(F.col(f"`{c}`") for c in (columns if columns is not None else [c for c in rows.columns if c != action])))
    value = envelope(task, F.lit(database), F.lit(table), does, data, timestamp, sync_time)
    return rows.select(topic(F.lit(target), F.lit(database), F.lit(table)).alias("topic"), document_id(keys).alias("key"), value.alias("value"), *([header_column(headers).alias("headers")] if headers else []))


def header_column(headers: dict[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value")) for k, v in headers.items()))


def write_messages(messages: DataFrame, options: dict[str, Any]) -> None:
    """Sends message rows; needs Spark's connector package on the cluster."""
    messages.write.format("kafka").options(**PRODUCER | options).save()


def write_message_files(messages: DataFrame, path: str, batch_id: int | str, writer: str = "main") -> None:
    """Message rows as JSON files, a folder per writer (query), batch and topic; a repeated batch overwrites itself."""
    messages.write.mode("overwrite").partitionBy("topic").json(f"{path}/writer={writer}/batch={batch_id}")
