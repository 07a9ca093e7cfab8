"""Batch and streaming inputs: tables in a folder, change files, messages, databases."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: What change files hold besides the payload.
ENVELOPE = T.StructType(
    [T.StructField("database", T.StringType()), T.StructField("table", T.StringType()), T.StructField("action", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("ts", T.TimestampType())]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def change_schema(payload: T.StructType) -> T.StructType:
    """Of changes of one table: the envelope with the row's image before and after."""
    return T.StructType([*ENVELOPE.fields, T.StructField("data", payload), T.StructField("before", payload)])


def change_files(spark: SparkSession, folder: str, payload: T.StructType, kind: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    """A stream of change files as they arrive. Its progress is the query's checkpoint: what is read is read once."""
    return spark.readStream.schema(change_schema(payload)).option("maxFilesPerTrigger", files_per_batch).format(kind).load(folder)


def messages(spark: SparkSession, options: dict[str, Any], stream: bool = True) -> DataFrame:
    """Messages of topics; needs Spark's connector package on the cluster. ``options`` as that connector names them."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("startingOffsets", "earliest")
    return reader.options(**options).load()


def database_query(spark: SparkSession, url: str, query: str, partition: tuple[str, int, int, int] | None = None, **options: Any) -> DataFrame:
    """Rows of a query; with ``partition`` (column, lowest, highest, number) read by that many tasks. Needs a JDBC driver."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition is None:
        return reader.option("query", query).load()
    column, low, high, number = partition
    reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", number)
    return reader.option("dbtable", f"({query}) t").load()


_own_folder: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or of this process where both are one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="tidemark-streams-"))
            atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
        root = f"file://{_own_folder[0]}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
