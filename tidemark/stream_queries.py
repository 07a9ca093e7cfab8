"""Registered queries that run whole streams over the events of a folder, and the same in SQL.

Each writes the events as change files, runs a table of a task over them in several micro-batches until all is done, and
reads the target.
"""

from __future__ import annotations

from dataclasses import replace
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import ColumnMapping as C
from .config import SyncTask, TableConfig
from .functions.widening import united
from .operators import changes as ch
from .operators import documents as doc
from .operators import flow
from .operators.buckets import Bucket, bucket_levels, limited
from .operators.search_index import build_index, ranked
from .sources.metadata import schema_columns, unique_keys
from .sources.tables import change_schema, shared_folder, table
from .streaming.runner import TableRun

_ACTION = "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END"


def _kind() -> Column:
    return F.col("event_type")


def _actions() -> Column:
    return F.when(_kind() == "signup", ch.INSERT).when(_kind() == "error", ch.DELETE).otherwise(ch.UPDATE)


def changes_of(events: DataFrame, action: Column, data: Column, before: Column | None = None) -> DataFrame:
    """Events as changes of the table shop.events, in the order of their ids."""
    image = events.select(data.alias("d")).schema["d"].dataType
    return events.select(
        F.lit("shop").alias("database"), F.lit("events").alias("table"), action.alias("action"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
        data.alias("data"), (F.lit(None).cast(image) if before is None else before).alias("before"),
    )


#: Rows of a change file at most, and files that make a batch: a few of a small log, so that it takes several batches, and
#: never more than so many, so that a batch and its tasks stay bounded however long the log is.
FILE_ROWS, LEAST_FILES, MOST_FILES = 100_000, 3, 48


def streamed(spark: SparkSession, changes: DataFrame, config: TableConfig, kind: str = "mysql2clickhouse") -> TableRun:
    """A table's run over changes, in files of which a few make a batch."""
    payload = changes.schema["data"].dataType
    assert isinstance(payload, T.StructType)
    folder = shared_folder(spark, "stream")
    changes.select(change_schema(payload).names).write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/in")
    files = min(MOST_FILES, max(LEAST_FILES, LEAST_FILES * len(spark.read.parquet(f"{folder}/in").inputFiles()) // 8))
    task = SyncTask("task", kind, "in", "out", (config,))
    run = TableRun(task, config, payload, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoints", files_per_batch=files, pause=0.1)
    run.start(spark, available_now=True).awaitTermination()
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In as many parts as its rows ask for, 8 at least."""
    events = table(spark, sf_dir, "events")
    return events.repartition(max(8, -(-events.count() // FILE_ROWS)), "event_id")


VIEW = TableConfig("shop", "events", target_table="view", columns=(C("user_id", "user"), C("event_type", "kind"), C("value", "value")), primary_key=("user_id",), where="value > 50")


def where_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users whose last value is above 50: rows enter, stay, leave; a third of the updates lacks the image before.

    Deletes hold nothing but the key.
    """
    image = lambda p: F.struct(F.col("user_id").alias("user_id"), F.col(f"{p}event_type").alias("event_type"), F.col(f"{p}value").alias("value"))
    events = ch.with_before(_events(spark, sf_dir), ["user_id"], ["event_id"], ["event_type", "value"])
    alone = F.struct(F.col("user_id").alias("user_id"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"))
    known = (F.col("event_id") % 3 > 0) & (F.col("before_event_type") != "error")
    data = F.when(_actions() == ch.DELETE, alone).otherwise(image(""))
    changes = changes_of(events, F.when((_actions() == ch.INSERT) & F.col("before_event_type").isNotNull(), ch.UPDATE).otherwise(_actions()), data, F.when(known & (_actions() != ch.DELETE), image("before_")))
    run = streamed(spark, changes, VIEW)
    return run.change_table(spark).current(spark)


def append_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a key: every change but the deletes, which need one, is a row."""
    config = TableConfig("shop", "events", target_table="log", columns=(C("event_id", "id"), C("event_type", "kind")))
    run = streamed(spark, changes_of(_events(spark, sf_dir), _actions(), F.struct("event_id", "event_type")), config)
    bad = run.quarantined(spark).where(F.array_contains("errors", "delete needs a key")).agg(F.sum("copies").alias("n_refused"))
    return run.change_table(spark).current(spark).groupBy("kind").agg(F.count("*").alias("n"), F.sum("id").alias("ids")).crossJoin(F.broadcast(bad))


def envelope_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are named as the fields of an envelope are, through a stream with an upsert by key."""
    names = ("user_id", "ts", "action", "seq", "part", "table", "database", "row", "change", "origin")
    values = ("user_id", "ts", "event_type", "event_id", "value", "event_type", "props", "value", "event_id", "event_type")
    config = TableConfig("shop", "events", target_table="odd", columns=tuple(map(C, names)), primary_key=("user_id",))
    data = F.struct(*(F.col(v).alias(n) for n, v in zip(names, values, strict=True)))
    run = streamed(spark, changes_of(_events(spark, sf_dir), _actions(), data), config)
    return run.change_table(spark).current(spark).withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


STRICT = TableConfig("shop", "events", target_table="kinds", columns=(C("event_id", "id"), C("event_type", "kind", type="int32"), C("ts", "at")), primary_key=("event_id",))


def retry_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that couldn't be mapped, sent again under a mended mapping and another order of columns; times to the microsecond."""
    events = _events(spark, sf_dir)
    run = streamed(spark, changes_of(events, F.lit(ch.INSERT), F.struct("event_id", "event_type", "ts")), STRICT)
    payload = events.select("ts", "event_id", "event_type").schema
    mended = replace(run, table=replace(STRICT, columns=(C("event_id", "id"), C("event_type", "kind", transform="toUpperCase"), C("ts", "at"))), payload=payload)
    mended.retry_due(spark, F.lit("2999-01-01 00:00:00").cast("timestamp"))
    rows = mended.change_table(spark).current(spark).select("id", "kind", F.unix_micros(F.col("at").cast("timestamp")).alias("micros"))
    state = mended.quarantined(spark).groupBy("status").agg(F.sum("copies").alias("n_sent"))
    return rows.crossJoin(F.broadcast(state))


def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects of a stream's batches and of the retry of its rejects, under a mapping that is mended between."""
    data = F.struct("event_id", F.when(_kind() == "error", F.lit("x")).otherwise(F.col("event_id").cast("string")).alias("event_type"), "ts")
    run = streamed(spark, changes_of(_events(spark, sf_dir), F.lit(ch.INSERT), data), STRICT)
    mended = replace(run, table=replace(STRICT, columns=(C("event_id", "id"), C("event_type", "kind"), C("ts", "at"))))
    mended.retry_due(spark, F.lit("2999-01-01 00:00:00").cast("timestamp"))
    return run.statistics(spark).groupBy("retried").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"), F.min(F.col("rows_a_second") > 0).alias("timed"))


def partial_log(events: DataFrame) -> DataFrame:
    """A log of partial writes: clicks set the value, views the properties, other events the kind and value; errors delete."""
    return events.select("user_id", F.col("event_id").alias("seq"), F.when(_kind() == "error", ch.DELETE).otherwise(ch.UPDATE).alias("action"),
        F.when(~_kind().isin("click", "view"), _kind()).alias("kind"), F.when(_kind() != "view", F.col("value")).alias("value"), F.when(_kind() == "view", F.col("props")).alias("props"))


def cdc_partial_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.merged_columns(partial_log(table(spark, sf_dir, "events")), ["user_id"], ["seq"])


def cdc_partial_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stream into a table with the policy PARTIAL, compacted in the end."""
    config = TableConfig("shop", "events", target_table="partial", columns=tuple(map(C, ("user_id", "kind", "value", "props"))), primary_key=("user_id",), on_conflict="PARTIAL")
    log = partial_log(_events(spark, sf_dir)).withColumns({"event_id": F.col("seq"), "ts": F.lit(None).cast("timestamp")})
    run = streamed(spark, changes_of(log, F.col("action"), F.struct("user_id", "kind", "value", "props")), config)
    return run.change_table(spark).compact(spark).current(spark)


def envelope_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in messages, read back to the microsecond."""
    at = F.col("ts").cast("timestamp")
    sent = table(spark, sf_dir, "events").select("event_id", doc.envelope("t", F.lit("shop"), F.lit("events"), F.lit("insert"), F.struct(F.col("ts").alias("local")), at, at).alias("value"))
    read = F.from_json("value", "data struct<local: timestamp_ntz>, timestamp timestamp", doc.JSON_TIMES)
    return sent.select("event_id", F.unix_micros(read["timestamp"]).alias("micros"), F.unix_micros(read["data"]["local"].cast("timestamp")).alias("local_micros"))


def batch_rows_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 1,000 rows where one in seven has no number: those come last."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("event_id")).alias("place"))
    return flow.row_batches(rows, "place", 1000, width=3000).groupBy("batch").agg(F.count("*").alias("n_rows"), F.count("place").alias("n_numbered"))


def _bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events so that some seconds have thousands and some few: time goes by in steps of the user's number."""
    at = F.timestamp_seconds(F.col("event_id").cast("double") / 2500 + F.floor(F.col("event_id") / 6000) * 2)
    return table(spark, sf_dir, "events").select("event_id", at.alias("at"), F.when(F.col("event_type").isin("view", "click"), "low").otherwise("high").alias("priority"))


def token_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1,000 tokens a second, 2,000 at most; only events of low priority are shed."""
    return limited(_bursts(spark, sf_dir), "at", "event_id").select("event_id", "priority")


def token_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of a bucket of 5 tokens, 2 a quarter of an hour, over all such quarters with events."""
    quarters = table(spark, sf_dir, "events").groupBy(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900).alias("second")).agg(F.count("*").alias("n"))
    return bucket_levels(quarters, Bucket(rate=2, burst=5, width=16))


def schema_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with whole sizes, suppliers with a nation: one table, with numbers that hold both and a column more."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("id"), F.col("p_size").cast("smallint").alias("amount"), F.struct(F.col("p_size").cast("tinyint").alias("n")).alias("more"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"), F.struct(F.col("s_nationkey").cast("bigint").alias("n"), F.col("s_name").alias("name")).alias("more"), F.lit("s").alias("kind"))
    return united(parts, suppliers).select("id", "amount", "more.n", "more.name", "kind")


KEY_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimal sets among four columns that tell line items apart, and among all columns of three tables."""
    found = [("lineitem", k) for k in unique_keys(table(spark, sf_dir, "lineitem"), KEY_COLUMNS)]
    for name in ("nation", "customer", "conversations"):
        found += [(name, k) for k in unique_keys(table(spark, sf_dir, name), width=2)]
    return spark.createDataFrame([(t, ",".join(k)) for t, k in found], "table_name string, key string")


def _unique_sql(name: str, columns: tuple[str, ...], width: int) -> str:
    """All sets by brute force."""
    sets = [s for n in range(1, width + 1) for s in combinations(columns, n)]
    counts = " UNION ALL ".join(f"SELECT '{','.join(s)}' AS key, {[*s]!r}::VARCHAR[] AS own, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {name})) AS n" for s in sets)
    return f"SELECT '{name}' AS table_name, key FROM ({counts}) x WHERE n = (SELECT count(*) FROM {name}) AND NOT EXISTS (SELECT 1 FROM ({counts}) y WHERE y.n = x.n AND y.key <> x.key AND list_has_all(x.own, y.own))"


def schema_columns_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and places of the columns of two tables, with the place in the key and the number of values."""
    out = None
    for name, key in (("nation", "n_nationkey"), ("orders", "o_orderkey")):
        rows = table(spark, sf_dir, name)
        values = rows.agg(*(F.count(c).alias(c) for c in rows.columns)).unpivot([], rows.columns, "column_name", "n_values")
        own = schema_columns(rows, name, (key,)).join(values, "column_name")
        out = own if out is None else out.unionByName(own)
    return out.select("table_name", "column_name", "position", F.coalesce("key_position", F.lit(0)).alias("key_position"), "n_values").orderBy("table_name", "position")


def search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of all documents, and the ten best that hold one word, maybe two others, and not a fourth."""
    index = build_index(table(spark, sf_dir, "documents"), "doc_id", "text", shared_folder(spark, "search-index"))
    return ranked(spark, index, must=("on",), should=("the", "License"), must_not=("los",)).select(F.col("key").alias("doc_id"), "score")


_ENDED = f"SELECT * FROM (SELECT *, {_ACTION} AS action, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) WHERE place = 1 AND action <> 'delete'"
_MICROS = "epoch_us(ts)::BIGINT"
_PARTIAL = """SELECT user_id, max_by(CASE WHEN event_type NOT IN ('click', 'view') THEN event_type END, CASE WHEN event_type NOT IN ('click', 'view') THEN event_id END) AS kind,
    max_by(value, event_id) FILTER (event_type <> 'view' AND value IS NOT NULL) AS value, max_by(props, event_id) FILTER (event_type = 'view' AND props IS NOT NULL) AS props
    FROM (SELECT *, max(CASE WHEN event_type = 'error' THEN event_id END) OVER (PARTITION BY user_id) AS gone FROM events) WHERE event_type <> 'error' AND (gone IS NULL OR event_id > gone) GROUP BY user_id"""
_TIMES = "WITH RECURSIVE e AS (SELECT event_id, event_id / 2500.0 + (event_id // 6000) * 2 AS tm, CASE WHEN event_type IN ('view', 'click') THEN 'low' ELSE 'high' END AS priority FROM events)"
_WALK = """, w AS (SELECT k, second, n, {burst} AS level, greatest(0, {burst} - n) AS after FROM c WHERE k = 1
    UNION ALL SELECT c.k, c.second, c.n, least({burst}, w.after + (c.second - w.second) * {rate}), greatest(0, least({burst}, w.after + (c.second - w.second) * {rate}) - c.n) FROM w JOIN c ON c.k = w.k + 1)"""

SQL = {
    "where_stream": f"SELECT user_id AS \"user\", event_type AS kind, value FROM ({_ENDED}) WHERE value > 50",
    "append_log": "SELECT event_type AS kind, count(*) AS n, sum(event_id)::BIGINT AS ids, (SELECT count(*) FROM events WHERE event_type = 'error') AS n_refused FROM events WHERE event_type <> 'error' GROUP BY 1",
    "envelope_names": f'SELECT user_id, {_MICROS} AS ts, event_type AS action, event_id AS seq, value AS part, event_type AS "table", props AS database, value AS row, event_id AS change, event_type AS origin FROM ({_ENDED})',
    "retry_by_id": f"SELECT event_id AS id, upper(event_type) AS kind, {_MICROS} AS micros, 'done' AS status, (SELECT count(*) FROM events) AS n_sent FROM events",
    "stream_statistics": """SELECT false AS retried, count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_rejected, true AS timed FROM events
        UNION ALL SELECT true, count(*) FILTER (event_type = 'error'), 0, true FROM events""",
    "cdc_partial_log": _PARTIAL,
    "cdc_partial_stream": _PARTIAL,
    "envelope_micros": f"SELECT event_id, {_MICROS} AS micros, {_MICROS} AS local_micros FROM events",
    "batch_rows_nulls": """SELECT batch, count(*) AS n_rows, count(place) AS n_numbered FROM (SELECT place, (row_number() OVER (ORDER BY place NULLS LAST) - 1) // 1000 AS batch
        FROM (SELECT CASE WHEN event_id % 7 > 0 THEN event_id END AS place FROM events)) GROUP BY 1""",
    "token_bucket": _TIMES + """, c AS (SELECT floor(tm)::BIGINT AS second, count(*) AS n, row_number() OVER (ORDER BY floor(tm)::BIGINT) AS k FROM e GROUP BY 1)""" + _WALK.format(rate=1000, burst=2000)
        + """ SELECT event_id, priority FROM (SELECT event_id, priority, level, row_number() OVER (PARTITION BY second ORDER BY tm, event_id) AS place FROM e JOIN w ON second = floor(tm)::BIGINT) WHERE priority <> 'low' OR place <= level""",
    "key_discovery": " UNION ALL ".join(_unique_sql(*x) for x in (("lineitem", KEY_COLUMNS, 4), ("nation", ("n_nationkey", "n_name", "n_regionkey"), 2), ("customer", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), 2), ("conversations", ("conv_id", "turn", "role", "text"), 2))),
    "schema_columns": "SELECT table_name, column_name, ordinal_position::INT AS position, CASE WHEN column_name IN ('n_nationkey', 'o_orderkey') THEN 1 ELSE 0 END::INT AS key_position, (SELECT count(*) FROM nation) * (table_name = 'nation')::INT + (SELECT count(*) FROM orders) * (table_name = 'orders')::INT AS n_values FROM information_schema.columns WHERE table_name IN ('nation', 'orders')",
    "search_bm25": r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda v: v <> '') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS a FROM d),
        c AS (SELECT doc_id, len(w) AS length, t.term, len(list_filter(w, lambda v: v = t.term)) AS tf FROM d, (VALUES ('on'), ('the'), ('license'), ('los')) t(term)),
        f AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM c GROUP BY 1),
        s AS (SELECT doc_id, sum(CASE WHEN term <> 'los' AND tf > 0 THEN round(ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * length / a))) * 1000000000)::BIGINT ELSE 0 END)::BIGINT AS score,
            bool_or(term = 'on' AND tf > 0) AS held, bool_or(term = 'los' AND tf > 0) AS barred FROM c JOIN f USING (term), n GROUP BY doc_id)
        SELECT doc_id, score FROM s WHERE held AND NOT barred ORDER BY score DESC, doc_id LIMIT 10""",
    "schema_widening": """SELECT p_partkey AS id, p_size::DOUBLE AS amount, p_size::BIGINT AS n, NULL::VARCHAR AS name, NULL::VARCHAR AS kind FROM part
        UNION ALL SELECT s_suppkey, s_acctbal, s_nationkey, s_name, 's' FROM supplier""",
    "token_levels": "WITH RECURSIVE c AS (SELECT epoch_ms(date_trunc('second', ts)) // 900000 AS second, count(*) AS n, row_number() OVER (ORDER BY second) AS k FROM events GROUP BY 1)" + _WALK.format(rate=2, burst=5)
        + " SELECT second::BIGINT AS second, n, level::BIGINT AS level, after::BIGINT AS after FROM w",
}
QUERIES = {f.__name__: f for f in (where_stream, append_log, envelope_names, retry_by_id, cdc_partial_log, cdc_partial_stream, envelope_micros, batch_rows_nulls, token_bucket, token_levels, schema_widening, key_discovery, search_bm25, stream_statistics)} | {"schema_columns": schema_columns_of}
ORACLE_SQL = {k: " ".join(v.split()) for k, v in SQL.items()}
