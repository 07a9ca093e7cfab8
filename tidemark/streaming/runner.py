"""Tasks as streaming queries: change files in, mapped rows out, rejects into quarantine.

Every table of a task is a query with its own checkpoint, and its batches have folders of their own, so that tables
which share a target don't touch each other's rows. Spark commits a batch's position after its sink succeeded; all
sinks overwrite what an earlier try of the same batch left, so that each change takes effect once.

A table's row filter makes of its log the log of a view: rows that come to fit it are inserted, rows that no longer do are
deleted (see ``routed_changes``). Rows may have columns of any name: sequence, action and origin travel in one struct.

What can't be mapped, and batches that a sink refused ``attempts`` times, wait in the quarantine as the changes they
came as, each with an id. ``retry_due`` maps and sends them again when they are due; what fails three times is permanent.
A retry writes down what it is about to send before it sends it, and takes up one that was broken off under its old
name, so that sinks can tell that they have it. A sink refuses by raising ``SinkRefused`` or an ``OSError``; all other
errors, such as a lost cluster or a fault in a program, stop the query and move no change.

A table of low priority may have a ``rate_limit``: changes that find no token in its bucket by their time wait in the
quarantine too and go on with a retry; the bucket's level is carried from batch to batch.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Config, SyncTask, TableConfig
from ..operators import quarantine
from ..operators.buckets import Bucket, Level, arrivals_of, bucket_levels, last_level, marked
from ..operators.changes import ACTION, DELETE, free_name, latest_changes, routed_changes
from ..operators.documents import JSON_TIMES, too_large
from ..plans.mapping import ERRORS, map_rows
from ..sinks.change_table import ChangeTable
from ..sinks.database import DatabaseTable, SinkRefused
from ..sinks.messages import message_rows, write_message_files
from ..sources.tables import change_files, change_schema

#: Batch sinks: (mapped valid changes with their envelope, batch id) -> None.
Sink = Callable[[DataFrame, int | str], None]


REFUSALS = (SinkRefused, OSError)

#: A quarantined change: as it came, how often the batch held it, what was wrong, and its attempts so far.
QUARANTINE = "id string, change string, copies bigint, errors array<string>, reason string, attempts int, status string, next_retry_at timestamp, failed_at timestamp"
REJECTED = "id string, change string, copies bigint, errors array<string>"
RAW = "_change_as_it_came"

#: What a batch or a retry came to: rows after the filter, rows rejected, and how long mapping and sink took.
STATISTICS = "batch string, retried boolean, n_rows bigint, n_rejected bigint, seconds double, rows_a_second double, at timestamp"

#: The level of a bucket after a batch.
LEVELS = "stream string, batch bigint, second bigint, tokens bigint"

#: The task of each query that was started here.
_tasks: dict[str, str] = {}


def with_retries(sink: Sink, attempts: int = 3, pause: float = 1.0) -> Sink:
    """Tries a sink that refuses again after 1, 2, ... pauses; the last refusal is raised."""

    def run(rows: DataFrame, batch_id: int | str) -> None:
        for n in range(1, attempts + 1):
            try:
                return sink(rows, batch_id)
            except REFUSALS:
                if n == attempts:
                    raise
                time.sleep(pause * n)

    return run


def mapped_changes(changes: DataFrame, table: TableConfig, sink: str, carried: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """Changes in envelopes as target rows with their errors, and a struct of action, seq, part, origin and ``carried``.

    The struct's name, which no column of source or target has, is the second result. Key columns have the names of the
    target. A delete needs nothing but its key: errors in other columns don't hold it up, but without a key it is an
    error itself. Values beyond the table's sizes are errors.
    """
    plain, own = routed_changes(changes, table.primary_key, table.where, ("seq", *carried))
    taken = [*plain.columns, *(c.target or c.source for c in table.columns)]
    envelope, bad_key = free_name(taken, "_envelope"), free_name(taken, "_bad_key")
    does = F.col(f"{own}.{ACTION}")
    named = F.coalesce(*(F.col(f"`{k}`").cast("string") for k in table.primary_key)).isNotNull() if table.primary_key else F.lit(False)
    fields = F.struct(does.alias(ACTION), *(F.col(f"{own}.{c}").alias(c) for c in ("seq", "part", *carried)), F.lit(table.source_name).alias("origin"))
    rows = plain.withColumns({envelope: fields, bad_key: F.when((does == DELETE) & ~named, F.lit("delete needs a key"))})
    mapped = map_rows(rows, replace(table, where=""), sink, keep=(envelope, bad_key))
    sizes = [
        F.when(too_large(F.col(f"`{f.name}`"), f.dataType, table.max_text_bytes, table.max_binary_bytes), F.lit(f"value too large: {f.name}"))
        for f in mapped.schema if isinstance(f.dataType, (T.StringType, T.BinaryType)) and f.name != bad_key and (table.max_binary_bytes if isinstance(f.dataType, T.BinaryType) else table.max_text_bytes)
    ]
    found = F.concat(F.col(ERRORS), F.filter(F.array(*sizes), lambda e: e.isNotNull())) if sizes else F.col(ERRORS)
    deleted = F.filter(F.array(F.col(bad_key)), lambda e: e.isNotNull())
    return mapped.withColumn(ERRORS, F.when(F.col(f"{envelope}.{ACTION}") == DELETE, deleted).otherwise(found)).drop(bad_key), envelope


@dataclass(frozen=True)
class TableRun:
    """One table of a task: where its changes come from, what they become."""

    task: SyncTask
    table: TableConfig
    payload: T.StructType
    changes: str
    output: str
    checkpoints: str
    file_kind: str = "parquet"
    files_per_batch: int = 64
    attempts: int = 3
    pause: float = 1.0
    #: Where rows go to a database: url, dialect and the connection's own options.
    database: dict[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.task.name}-{self.table.source_name}"

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(self.table.target_of(k) for k in self.table.primary_key)

    @property
    def quarantine(self) -> str:
        return f"{self.output}/quarantine/{self.name}"

    def change_table(self, spark: SparkSession) -> ChangeTable:
        empty = map_rows(spark.createDataFrame([], self.payload), replace(self.table, where=""), self.task.kind).drop(ERRORS)
        order = (("seq", "bigint"), ("part", "int"), ("origin", "string"))
        return ChangeTable(f"{self.output}/{self.table.target_name}", empty.schema, self.keys, order, self.table.policy)

    def database_table(self) -> DatabaseTable:
        """The target in a database; tasks send it ``batch_size`` rows at a time."""
        options = {k: v for k, v in self.database.items() if k not in ("url", "dialect")}
        return DatabaseTable(self.database["url"], self.table.target_table or self.table.source_table, self.keys, self.table.policy, self.database.get("dialect", "standard"), options, self.table.batch_size)

    def sink(self, spark: SparkSession, stream: Callable[[], str] = lambda: "") -> Sink:
        """The sink of the task's kind; ``stream`` tells batches of one number of different streams apart."""
        writer = lambda: f"{self.name}-{stream()}".rstrip("-")
        if self.task.kind == "message":
            def write(rows: DataFrame, batch_id: int | str) -> None:
                now, envelope = F.current_timestamp(), rows.columns[-1]
                out = message_rows(rows, self.task.name, self.table.source_database, self.table.source_table, self.keys, now, now, F.col(f"{envelope}.{ACTION}"), self.table.target_table, columns=rows.columns[:-1])
                write_message_files(out, f"{self.output}/messages", batch_id, writer())

            return write
        if self.database:
            database = self.database_table()

            def move(rows: DataFrame, batch_id: int | str) -> None:
                database.write(rows, batch_id, writer(), ("seq", "part"), rows.columns[-1])

            return move
        target = self.change_table(spark)

        def append(rows: DataFrame, batch_id: int | str) -> None:
            try:
                target.append(batch_id, rows, writer(), rows.columns[-1])
            except ValueError as e:  # no schema holds both
                raise SinkRefused(str(e)) from e

        return append

    def _identified(self, names: list[str], batch_id: int | str, stream: str, ident: str = "", within: str = "") -> Column:
        """id and text of a change, whose columns may be fields of a struct; the id is that of its batch and text unless a column has it."""
        column = lambda c: F.col(f"{within}.`{c}`" if within else c)
        text = F.to_json(F.struct(*(column(c).alias(c) for c in names)), JSON_TIMES)
        own = column(ident) if ident else F.sha2(F.concat_ws("\n", F.lit(f"{self.name} {stream} {batch_id}"), text), 256)
        return F.struct(own.alias("id"), text.alias("change"))

    def _admitted(self, changes: DataFrame, batch_id: int, stream: str) -> tuple[DataFrame, DataFrame | None]:
        """The changes that find a token or need none, and the others as (id, change, copies, errors).

        The level that a batch leaves is written under its number; a batch that is repeated begins as it did before.
        """
        if not self.table.rate_limit or self.table.priority.lower() != "low":
            return changes, None
        spark, names = changes.sparkSession, changes.columns
        bucket = Bucket(self.table.rate_limit, self.table.burst or 2 * self.table.rate_limit)
        path, start = f"{self.output}/levels/{self.name}", None
        if self._exists(spark, path):
            earlier = spark.read.schema(LEVELS).parquet(path).where((F.col("stream") == stream) & (F.col("batch") < batch_id))
            row = earlier.orderBy(F.desc("batch")).select("second", "tokens").first()
            start = Level(row["second"], row["tokens"]) if row else None
        left = last_level(bucket_levels(arrivals_of(changes, "ts"), bucket, start), start)
        if left:
            spark.createDataFrame([(stream, batch_id, left.second, left.tokens)], LEVELS).coalesce(1).write.mode("overwrite").parquet(f"{path}/of={stream}-{batch_id}")
        mark = free_name(names, "_passes")
        told = marked(changes, "ts", "seq", mark, F.lit(True), bucket, start)
        held = told.where(~F.col(mark)).select(self._identified(names, batch_id, stream).alias("c")).select("c.*").groupBy("id", "change").agg(F.count("*").alias("copies"))
        return told.where(mark).drop(mark), held.withColumn("errors", F.array(F.lit("rate limit")))

    def _deliver(self, changes: DataFrame, batch_id: int | str, write: Sink, stream: str = "", ident: str = "") -> DataFrame:
        """Sends what can be mapped; what can't, or wasn't taken, comes back as (id, change, copies, errors).

        ``ident`` names a column of ids; without it each change gets one of its batch and text. The last column of the
        rows that a sink gets is their envelope.
        """
        spark = changes.sparkSession
        names = [c for c in changes.columns if c != ident]
        # Texts and ids are made of what is rejected alone: kept for all changes they would be most of a batch.
        raw = changes.withColumn(RAW, F.struct(*changes.columns))
        mapped, envelope = mapped_changes(raw.select(*names, RAW), self.table, self.task.kind, (RAW,))
        mapped, began, refused = mapped.persist(), time.monotonic(), False
        try:
            told = self._identified(names, batch_id, stream, ident, f"{envelope}.{RAW}")
            rejected = lambda rows, errors: rows.select(told.alias("c"), f"{envelope}.part", errors.alias("errors")).select("c.*", "part", "errors")
            own = F.struct(*(F.col(f"{envelope}.{c}").alias(c) for c in (ACTION, "seq", "part", "origin"))).alias(envelope)
            good = mapped.where(F.size(ERRORS) == 0)
            try:
                write(good.select(*(F.col(f"`{c}`") for c in mapped.columns if c not in (ERRORS, envelope)), own), batch_id)
                bad = rejected(mapped.where(F.size(ERRORS) > 0), F.col(ERRORS))
            except REFUSALS as e:  # after the last attempt: the whole batch waits
                bad, refused = rejected(mapped, F.array(F.lit(f"{type(e).__name__}: {e}"[:1000]))), True
            # A change may be rejected in both of its parts; it waits once for each time that it came.
            parts = bad.groupBy("id", "change", "part").agg(F.first("errors").alias("errors"), F.count("*").alias("n"))
            path = f"{self.quarantine}-tries/{uuid.uuid4().hex}"
            parts.groupBy("id", "change").agg(F.first("errors").alias("errors"), F.max("n").alias("copies")).select("id", "change", "copies", "errors").write.parquet(path)
            count = mapped.agg(F.count("*").alias("n"), F.count_if(F.size(ERRORS) > 0).alias("bad")).first()
            seconds = max(1e-6, time.monotonic() - began)
            row = (f"{stream}{'-' if stream else ''}{batch_id}", bool(ident), count["n"], count["n"] if refused else count["bad"], seconds, count["n"] / seconds)
            one = spark.createDataFrame([row], "batch string, retried boolean, n_rows bigint, n_rejected bigint, seconds double, rows_a_second double")
            one.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{self.output}/statistics/{self.name}/of={row[0]}")
            return spark.read.schema(REJECTED).parquet(path)
        finally:
            mapped.unpersist()

    def start(self, spark: SparkSession, available_now: bool = False, sink: Sink | None = None) -> StreamingQuery:
        """Starts the query; ``available_now``: it ends when everything that is there is done."""
        stream = change_files(spark, self.changes, self.payload, self.file_kind, self.files_per_batch)
        own = stream.where((F.col("database") == self.table.source_database) & (F.col("table") == self.table.source_table))
        started, ids = threading.Event(), []  # the checkpoint's id: another checkpoint numbers its batches anew

        def stream() -> str:
            started.wait(60)
            return ids[0]

        write = with_retries(sink or self.sink(spark, stream), self.attempts, self.pause)

        def batch(changes: DataFrame, batch_id: int) -> None:
            admitted, held = self._admitted(changes, batch_id, stream())
            bad = self._deliver(admitted, batch_id, write, stream())
            waiting(bad.unionByName(held) if held is not None else bad, F.lit(0), F.current_timestamp()).write.mode("overwrite").parquet(f"{self.quarantine}/batch={stream()}-{batch_id}")
            self._removed(spark, bad)

        _tasks[self.name] = self.task.name
        writer = own.writeStream.queryName(self.name).option("checkpointLocation", f"{self.checkpoints}/{self.name}").foreachBatch(batch)
        query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{self.table.batch_timeout} seconds")).start()
        ids.append(query.id)
        started.set()
        return query

    def _folder(self, spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, spark: SparkSession, path: str) -> bool:
        at, files = self._folder(spark, path)
        return files.exists(at)

    def _removed(self, spark: SparkSession, rejected: DataFrame) -> None:
        """Removes the folder that ``_deliver`` left its rejects in, once they are written elsewhere."""
        for file in rejected.inputFiles()[:1]:
            at, files = self._folder(spark, file.rsplit("/", 1)[0])
            files.delete(at, True)

    def quarantined(self, spark: SparkSession) -> DataFrame:
        """The changes that wait, that are done, or that failed for good, each as it stands after its last attempt."""
        if not self._exists(spark, self.quarantine):
            return spark.createDataFrame([], QUARANTINE)
        names = T._parse_datatype_string(QUARANTINE).names
        return latest_changes(spark.read.schema(QUARANTINE).parquet(self.quarantine).select(names), ["id"], ["attempts"])

    def retry_due(self, spark: SparkSession, now: Column | None = None, sink: Sink | None = None) -> int:
        """Maps the due changes again and sends them by their action; how many there were. Each counts one attempt.

        What is due is written down under the number of the retry first; a retry that was broken off before its outcome
        was written is done again with the same changes under the same name.
        """
        now = F.current_timestamp() if now is None else now
        number = 0
        while self._exists(spark, f"{self.quarantine}/batch=retry-{number}/_SUCCESS"):
            number += 1
        token, path = f"retry-{number}", f"{self.quarantine}-tries/due-{number}"
        if not self._exists(spark, f"{path}/_SUCCESS"):
            quarantine.due(self.quarantined(spark), now).write.mode("overwrite").parquet(path)
        ready = spark.read.schema(QUARANTINE).parquet(path)
        n = ready.count()
        if not n:
            at, files = self._folder(spark, path)
            files.delete(at, True)
            return 0
        ident = free_name(change_schema(self.payload).names, "_id")
        times = ready.select("id", "change", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        parsed = times.select(F.col("id").alias(ident), F.from_json("change", change_schema(self.payload), JSON_TIMES).alias("_c")).select(ident, "_c.*")
        bad = self._deliver(parsed, token, with_retries(sink or self.sink(spark), self.attempts, self.pause), ident=ident)
        joined = ready.join(bad.select("id", F.col("errors").alias("now_wrong")).groupBy("id").agg(F.first("now_wrong").alias("now_wrong")), "id", "left")
        failed = joined.where("now_wrong is not null").withColumn("errors", F.col("now_wrong")).drop("now_wrong")
        failed = quarantine.after_attempt(failed.withColumn("reason", quarantine.failure_class(F.array_join("errors", "; "))), now).withColumn("failed_at", now)
        done = joined.where("now_wrong is null").drop("now_wrong").withColumns({"attempts": F.col("attempts") + 1, "status": F.lit("done"), "next_retry_at": F.lit(None).cast("timestamp")})
        done.unionByName(failed).write.mode("overwrite").parquet(f"{self.quarantine}/batch={token}")
        self._removed(spark, bad)
        return n

    def statistics(self, spark: SparkSession) -> DataFrame:
        """A row for each batch and retry; one that was repeated counts as it ended the last time."""
        path = f"{self.output}/statistics/{self.name}"
        if not self._exists(spark, path):
            return spark.createDataFrame([], STATISTICS)
        return spark.read.schema(STATISTICS).parquet(path).select(T._parse_datatype_string(STATISTICS).names)

    def failures(self, spark: SparkSession, now: Column | None = None, hours: int = 24) -> DataFrame:
        """What failed for good within the last hours."""
        return quarantine.within(self.quarantined(spark).where("status = 'permanent'"), "failed_at", F.current_timestamp() if now is None else now, hours)


def waiting(bad: DataFrame, attempts: Column, now: Column) -> DataFrame:
    """Rejected changes (id, change, copies, errors) as quarantine rows, due after a first pause."""
    reason = quarantine.failure_class(F.array_join("errors", "; "))
    wait = F.make_dt_interval(secs=quarantine.backoff_seconds(attempts).cast("decimal(18,6)"))
    return bad.select("id", "change", "copies", "errors", reason.alias("reason"), attempts.cast("int").alias("attempts"), F.lit("waiting").alias("status"), (now + wait).alias("next_retry_at"), now.alias("failed_at"))


def runs_of(config: Config, payloads: dict[str, T.StructType], checkpoints: str, **options) -> list[TableRun]:
    """A run for every table of every active task; ``payloads`` by the table's source name.

    The source's option ``path`` is the folder of its change files, the target's the folder that is written to, which
    holds the quarantine alone where the target has a ``url`` (and ``dialect``, user and so on) of a database.
    """
    def options_of(target: str) -> dict:
        given = {k: str(v) for k, v in config.source(target).options.items() if k != "path"}
        return {"database": given} if "url" in given else {}

    return [
        TableRun(task, table, payloads[table.source_name], str(config.source(task.source).options["path"]), str(config.source(task.target).options["path"]), checkpoints, **options_of(task.target), **options)
        for task in config.active_tasks() for table in sorted(task.tables, key=lambda t: {"high": 0, "low": 2}.get(t.priority.lower(), 1))
    ]


def start_all(spark: SparkSession, config: Config, payloads: dict[str, T.StructType], checkpoints: str, available_now: bool = False, **options) -> list[StreamingQuery]:
    """Starts every table of every active task, those of high priority first."""
    return [run.start(spark, available_now) for run in runs_of(config, payloads, checkpoints, **options)]


def retried(spark: SparkSession, runs: list[TableRun], queries: list[StreamingQuery], pause: float = 5.0) -> int:
    """Sends due changes again every ``pause`` seconds while queries are active, and once after; how many were sent.

    An error of a query is raised when all have ended.
    """
    sent = 0
    while True:
        active = any(q.isActive for q in queries)
        sent += sum(run.retry_due(spark) for run in runs)
        if not active:
            break
        until = time.monotonic() + pause
        while time.monotonic() < until and any(q.isActive for q in queries):
            time.sleep(0.1)
    for q in queries:
        if (e := q.exception()) is not None:
            raise e
    return sent


def stop_all(spark: SparkSession, task: str = "", seconds: float = 10.0) -> list[str]:
    """Stops a task's queries (or all), waiting for each batch under way; the names of those that didn't end in time."""
    own = [q for q in spark.streams.active if q.name and (not task or _tasks.get(q.name) == task)]
    late = []
    for q in own:
        q.stop()
    until = time.monotonic() + seconds
    for q in own:
        if not q.awaitTermination(max(0.1, until - time.monotonic())):
            late.append(q.name)
    return late
