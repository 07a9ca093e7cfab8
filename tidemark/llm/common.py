"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as the operators count it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: list[str] = []
_shipped: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` where it is set.

    Where it is unset, a temporary folder of this process takes its place if driver and executors are one process
    (tests, a laptop); on a cluster that is an error, as other machines would not see the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cleared(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that are still lazily read from them are lost."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    It cuts the lineage and survives lost executors, as the rows no longer depend on them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Deletes tables that ``stored`` gave, of which nothing lazy is read any more, and shuffle files of queries that ended.

    Spark deletes the latter once the driver has collected what stands for them, which a large heap seldom does by itself.
    """
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
    if frames:
        frames[0].sparkSession._jvm.System.gc()


#: Rows and bytes of a batch of texts on its way to Python; both sides hold a few batches for each task.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "1048576b")}


def shipped(spark: SparkSession) -> None:
    """Prepares a session for the operators; each calls it first.

    It sends this package's modules to the executors, once per application, for clusters where it isn't installed, and
    bounds the batches that Python gets, unless the session has bounds of its own.
    """
    for name, (default, own) in BATCH.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, own)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    if package.parent.is_dir():  # else the package is itself read from an archive that Spark was given
        folder = tempfile.mkdtemp(prefix="tidemark-")  # on the driver, which serves it to executors until it ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}-modules", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


def rested(spark: SparkSession) -> None:
    """Asks the executors for a full collection, after which their heaps shrink to what is in use.

    Between stages of a long session: a heap keeps the size that the stage before needed, beside the Python workers of
    the next one. A task costs a fraction of a second; an executor that gets none of them just stays as it is.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def released() -> None:
    """Gives memory that this Python worker no longer uses back to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, with its memory given back at the end."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            released()

    return task


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Words (see WORD) of a text, 0 for null, without an array of them: each becomes one letter, and letters are counted."""
    letters = F.translate(F.regexp_replace(text, WORD, "w"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.char_length(letters), F.lit(0)).cast("long")


def id_text_crc(column: Column) -> Column:
    """crc32 of an id's decimal text; a null id counts as the empty text (crc 0)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns of a row; equal for equal rows. Maps, which have no hash, count by their JSON."""
    parts = [F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name] for f in docs.schema]
    nulls = F.concat(F.lit(""), *(docs[c].isNull().cast("string") for c in docs.columns))  # a hash passes over nulls
    return F.xxhash64(*parts, nulls)


def labelled(rows: DataFrame, labels: DataFrame, key: str, hot_rows: int = 100_000, most: int = 100_000) -> DataFrame:
    """``rows`` joined with ``labels`` (one row for each key, with ``n_rows``, the number of its rows) by ``key``.

    Labels of keys with many rows are sent to every executor, so that these rows stay where they are; the bound for "many"
    rises with the table, so that there are at most ``most`` of them. All others are shuffled.
    """
    total = labels.agg(F.sum("n_rows")).first()[0] or 0
    many = F.col("n_rows") > max(hot_rows, total // most)
    value = [c for c in labels.columns if c not in (key, "n_rows")]
    hot = F.broadcast(labels.where(many).select(F.col(key).alias("_hot"), F.struct(*value).alias("_label")))
    marked = rows.join(hot, rows[key] == F.col("_hot"), "left")
    known = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, "_label.*")
    rest = marked.where(F.col("_hot").isNull()).select(*rows.columns).join(labels.where(~many).drop("n_rows"), key).select(*rows.columns, *value)
    return known.unionByName(rest)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's texts as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``, so that working memory stays bounded."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)
