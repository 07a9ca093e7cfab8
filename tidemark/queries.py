"""Registered queries over the tables in a folder, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import ColumnMapping as C
from .config import Label, TableConfig
from .functions.convert import parse_time
from .functions.labels import enum_index
from .operators import changes as ch
from .operators import documents as doc
from .operators import flow, quarantine, search
from .plans.mapping import ERRORS, map_rows, mapped_by_target, rejected_rows, valid_rows
from .sinks.messages import message_rows
from .sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = " ".join(sql.split())


def _mapping(name: str, source: str, columns: list[C], sql: str, rejects: bool = False, where: str = "", sink: str = "table", prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    config = TableConfig("shop", source, target_table=f"{source}_facts", columns=tuple(columns), where=where)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, source)
        rows = prepare(rows) if prepare else rows
        if rejects:
            return rejected_rows(rows, config, sink)
        return valid_rows(map_rows(rows, config, sink))

    _register(name, query, sql)


# --- Projection -------------------------------------------------------------------------------------------------

_mapping("map_rename_prune", "orders", [C("o_orderkey", "id"), C("o_custkey", "customer_id"), C("o_orderstatus", ignore=True), C("o_totalprice", "amount")],
    "SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")

_no_building = lambda rows: rows.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
_mapping("map_default_fill", "customer", [C("c_custkey", "id"), C("c_mktsegment", "segment", default="unknown", transform="toLowerCase")],
    "SELECT c_custkey AS id, coalesce(lower(nullif(c_mktsegment, 'BUILDING')), 'unknown') AS segment FROM customer", prepare=_no_building)
_mapping("map_required_valid", "customer", [C("c_custkey", "id"), C("c_mktsegment", "segment", required=True)],
    "SELECT c_custkey AS id, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'", prepare=_no_building)


def map_required_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = TableConfig("shop", "customer", columns=(C("c_custkey", "id"), C("c_mktsegment", "segment", required=True)))
    bad = rejected_rows(_no_building(table(spark, sf_dir, "customer")), config)
    return bad.select(F.col("c_custkey").alias("id"), F.array_join(ERRORS, "; ").alias("errors"), quarantine.failure_class(F.array_join(ERRORS, "; ")).alias("reason"))


_register("map_required_rejects", map_required_rejects, "SELECT c_custkey AS id, 'required column is missing: c_mktsegment' AS errors, 'format' AS reason FROM customer WHERE c_mktsegment = 'BUILDING'")
_mapping("map_duplicate_target", "orders", [C("o_orderkey", "id"), C("o_orderstatus", "state"), C("o_orderpriority", "state", condition="{{value}} != 5-LOW")],
    "SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE o_orderstatus END AS state FROM orders")
_mapping("map_missing_column", "customer", [C("c_custkey", "id"), C("no_such_column", "extra", default="none")], "SELECT c_custkey AS id, 'none' AS extra FROM customer")
_mapping("table_where", "orders", [C("o_orderkey", "id"), C("o_totalprice", "amount")], "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000", where="o_orderstatus = 'F' AND o_totalprice > 50000")

# --- Conditions -------------------------------------------------------------------------------------------------

for _name, _operator in (("gt", ">"), ("lt", "<"), ("ge", ">="), ("le", "<=")):
    _mapping(f"cond_{_name}", "orders", [C("o_orderkey", "id"), C("o_totalprice", "amount", condition=f"{{{{value}}}} {_operator} 100000")],
        f"SELECT o_orderkey AS id, CASE WHEN o_totalprice {_operator} 100000 THEN o_totalprice END AS amount FROM orders")
for _name, _operator, _sql in (("eq", "==", "="), ("ne", "!=", "<>")):
    _mapping(f"cond_{_name}", "orders", [C("o_orderkey", "id"), C("o_orderstatus", "state", condition=f"{{{{value}}}} {_operator} F")],
        f"SELECT o_orderkey AS id, CASE WHEN o_orderstatus {_sql} 'F' THEN o_orderstatus END AS state FROM orders")
_mapping("cond_nonempty", "customer", [C("c_custkey", "id"), C("c_mktsegment", "segment", condition="{{value}}")], "SELECT c_custkey AS id, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer", prepare=_no_building)
_mapping("cond_default", "orders", [C("o_orderkey", "id"), C("o_totalprice", "amount", condition="{{value}} > 100000", default="0", on_unmet="default")],
    "SELECT o_orderkey AS id, CASE WHEN o_totalprice > 100000 THEN o_totalprice ELSE 0.0::DOUBLE END AS amount FROM orders")

# --- Transforms -------------------------------------------------------------------------------------------------

_mapping("tf_case_trim", "part", [C("p_partkey", "id"), C("p_name", "upper_name", transform="toUpperCase"), C("p_brand", "lower_brand", transform="toLowerCase({{value}})"), C("p_type", "padded", transform="trim(concat('  ', {{value}}, '  '))")],
    "SELECT p_partkey AS id, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand, trim(p_type) AS padded FROM part")
_mapping("tf_concat", "part", [C("p_partkey", "id"), C("p_brand", "tag", transform="concat({{value}}, '-', checked)")], "SELECT p_partkey AS id, trim(p_brand) || '-checked' AS tag FROM part")
_mapping("tf_substring", "part", [C("p_partkey", "id"), C("p_name", "head", transform="substring({{value}}, 0, 4)"), C("p_type", "tail", transform="substring({{value}}, -3)"), C("p_brand", "rest", transform="substring({{value}}, 2)")],
    "SELECT p_partkey AS id, substr(p_name, 1, 4) AS head, right(p_type, 3) AS tail, substr(p_brand, 3) AS rest FROM part")
_mapping("tf_replace", "part", [C("p_partkey", "id"), C("p_brand", "label", transform="replace({{value}}, Brand, B)")], "SELECT p_partkey AS id, replace(p_brand, 'Brand', 'B') AS label FROM part")
_mapping("tf_if", "part", [C("p_partkey", "id"), C("p_size", "kind", transform="if({{value}} >= 25, large, small)")], "SELECT p_partkey AS id, CASE WHEN p_size >= 25 THEN 'large' ELSE 'small' END AS kind FROM part")
_mapping("tf_default", "part", [C("p_partkey", "id"), C("p_brand", "brand", transform="default({{value}}, none)")], "SELECT p_partkey AS id, coalesce(nullif(p_brand, ''), 'none') AS brand FROM part")
_mapping("tf_round", "part", [C("p_partkey", "id"), C("p_retailprice", "price", transform="round({{value}}, 0)")], "SELECT p_partkey AS id, round(p_retailprice, 0) AS price FROM part")

_as_text = lambda rows: rows.withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
_mapping("tf_datetime", "events", [C("event_id", "id"), C("ts_text", "at", transform="parseDateTimeBestEffort"), C("ts_text", "seconds", transform="toUnixTimestamp")],
    "SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, (epoch_ms(date_trunc('second', ts)) // 1000)::BIGINT AS seconds FROM events", prepare=_as_text)
QUERIES["tf_datetime"] = lambda spark, sf_dir, f=QUERIES["tf_datetime"]: f(spark, sf_dir).withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
_mapping("tf_json_stringify", "events", [C("event_id", "id"), C("event_type", "quoted", transform="jsonStringify")], "SELECT event_id AS id, to_json(event_type)::VARCHAR AS quoted FROM events")
_mapping("tf_boolean", "orders", [C("o_orderkey", "id"), C("o_orderstatus", "done", transform="toBoolean(if({{value}} == F, yes, no))")], "SELECT o_orderkey AS id, o_orderstatus = 'F' AS done FROM orders", sink="document")

# --- Conversions ------------------------------------------------------------------------------------------------

_mapping("cv_int", "lineitem", [C("l_orderkey", "id", type="int64"), C("l_linenumber", "line", type="Int8"), C("l_quantity", "quantity", type="int32")], "SELECT l_orderkey AS id, l_linenumber::BIGINT AS line, trunc(l_quantity)::BIGINT AS quantity FROM lineitem")
_mapping("cv_uint", "customer", [C("c_custkey", "id", type="uint32"), C("c_acctbal", "balance", type="uint64", required=True)], "SELECT c_custkey AS id, floor(c_acctbal)::DECIMAL(20,0) AS balance FROM customer WHERE c_acctbal >= 0")
_mapping("cv_float", "part", [C("p_partkey", "id"), C("p_size", "size", type="float64")], "SELECT p_partkey AS id, p_size::DOUBLE AS size FROM part")
_mapping("cv_string", "part", [C("p_partkey", "id", type="string"), C("p_size", "size", type="String")], "SELECT p_partkey::VARCHAR AS id, p_size::VARCHAR AS size FROM part")
_mapping("cv_date", "events", [C("event_id", "id"), C("ts_text", "day", type="date")], "SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS day FROM events", prepare=_as_text)
QUERIES["cv_date"] = lambda spark, sf_dir, f=QUERIES["cv_date"]: f(spark, sf_dir).withColumn("day", F.col("day").cast("string"))
_mapping("cv_bool", "part", [C("p_partkey", "id"), C("p_size", "large", type="bool", transform="if({{value}} > 25, yes, no)")], "SELECT p_partkey AS id, p_size > 25 AS large FROM part")
_mixed_text = lambda rows: rows.withColumn("code", F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".5"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string")))
_mapping("cv_int_guarded", "part", [C("p_partkey", "id"), C("code", "code", type="int32")], "SELECT p_partkey AS id, p_size::BIGINT AS code FROM part WHERE p_size % 3 = 2", prepare=_mixed_text)

# --- Enum and set -----------------------------------------------------------------------------------------------

NATIONS = (Label("NORTH", 0), Label("SOUTH", 1), Label("EAST", 2), Label("WEST", 3), Label("ELSEWHERE", -1))
FLAGS = (Label("new", 1), Label("sale", 2), Label("heavy", 4), Label("rare", 8), Label("other", -1))
_names = "CASE c_nationkey WHEN 0 THEN 'NORTH' WHEN 1 THEN 'SOUTH' WHEN 2 THEN 'EAST' WHEN 3 THEN 'WEST'"
_mapping("enum_label", "customer", [C("c_custkey", "id"), C("c_nationkey", "nation", type="enum2string", enum=NATIONS)], f"SELECT c_custkey AS id, {_names} ELSE 'ELSEWHERE' END AS nation FROM customer")
_mapping("enum_no_default", "customer", [C("c_custkey", "id"), C("c_nationkey", "nation", type="enum2string", enum=NATIONS[:4])], f"SELECT c_custkey AS id, {_names} END AS nation FROM customer WHERE c_nationkey BETWEEN 0 AND 3")
_mapping("set_label", "part", [C("p_partkey", "id"), C("p_size", "flags", type="set2string", set=FLAGS)],
    """SELECT p_partkey AS id, CASE WHEN p_size = 0 THEN '' WHEN p_size & 15 = 0 THEN 'other' ELSE
       concat_ws(',', CASE WHEN p_size & 1 <> 0 THEN 'new' END, CASE WHEN p_size & 2 <> 0 THEN 'sale' END, CASE WHEN p_size & 4 <> 0 THEN 'heavy' END, CASE WHEN p_size & 8 <> 0 THEN 'rare' END) END AS flags FROM part""")  # fmt: skip


def enum_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = (Label("AUTOMOBILE", 1), Label("BUILDING", 2), Label("FURNITURE", 3))
    index, error = enum_index(F.col("c_mktsegment"), labels)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), index.alias("segment_no"), error.isNotNull().alias("failed"))


_register("enum_reverse", enum_reverse, "SELECT c_custkey AS id, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 END::BIGINT AS segment_no, c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') AS failed FROM customer")

# --- Keys, routing, envelopes -----------------------------------------------------------------------------------

_register("doc_id_single", lambda s, d: table(s, d, "orders").select("o_orderkey", doc.document_id(["o_orderkey"]).alias("doc_id")), "SELECT o_orderkey, o_orderkey::VARCHAR AS doc_id FROM orders")
_register("doc_id_composite", lambda s, d: table(s, d, "lineitem").select(doc.document_id(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).alias("doc_id")),
    "SELECT concat_ws('_', l_linenumber, l_orderkey, l_partkey, l_suppkey) AS doc_id FROM lineitem")
_register("topic_route", lambda s, d: table(s, d, "events").select("event_id", doc.topic(F.when(F.col("event_type") == "click", "clicks"), F.lit("shop.v1"), F.col("event_type")).alias("topic")),
    "SELECT event_id, CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'shop_v1_' || event_type END AS topic FROM events")
_register("distinct_topics", lambda s, d: QUERIES["topic_route"](s, d).select("topic").distinct(), "SELECT DISTINCT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'shop_v1_' || event_type END AS topic FROM events")
_register("table_filter", lambda s, d: flow.routed(table(s, d, "events").select("event_id", "event_type"), F.concat(F.lit("shop."), F.col("event_type")), [r"shop\.click", r"shop\.p.*"]), "SELECT event_id, event_type FROM events WHERE event_type = 'click' OR event_type LIKE 'p%'")


def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back field by field."""
    rows = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    data = F.struct(F.col("o_orderkey").alias("id"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("state"))
    sent = rows.select(doc.envelope("orders-out", F.lit("shop"), F.lit("orders"), F.lit("insert"), data, at, at).alias("value"))
    read = F.from_json("value", "task_name string, database string, table string, action string, data struct<id: bigint, state: string>, timestamp timestamp")
    got = sent.select(read.alias("m"), F.col("value").contains('"state":null').alias("null_kept"))
    return got.select("m.task_name", "m.database", "m.table", "m.action", "m.data.id", "m.data.state", F.date_format("m.timestamp", "yyyy-MM-dd").alias("day"), "null_kept")


_register("envelope_json", envelope_json, "SELECT 'orders-out' AS task_name, 'shop' AS database, 'orders' AS \"table\", 'insert' AS action, o_orderkey AS id, nullif(o_orderstatus, 'P') AS state, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus = 'P' AS null_kept FROM orders")
_register("sql_literals", lambda s, d: (lambda t: t.select("c_custkey", *(doc.sql_literal(F.col(c), t.schema[c].dataType).alias(f"{c}_sql") for c in ("c_name", "c_nationkey", "c_acctbal"))))(table(s, d, "customer")),
    "SELECT c_custkey, '''' || replace(c_name, '''', '''''') || '''' AS c_name_sql, c_nationkey::VARCHAR AS c_nationkey_sql, printf('%.6f', c_acctbal) AS c_acctbal_sql FROM customer")

# --- Change logs ------------------------------------------------------------------------------------------------


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a user's state: signup inserts, error deletes, the rest updates."""
    kind = F.col("event_type")
    action = F.when(kind == "signup", ch.INSERT).when(kind == "error", ch.DELETE).otherwise(ch.UPDATE).alias("action")
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), action, "event_type", "value", "props")


_log = "SELECT user_id, event_id AS seq, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action, event_type, value, props FROM events"
_last = f"SELECT * FROM ({_log}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) = 1"
_register("cdc_latest", lambda s, d: ch.latest_changes(user_log(s, d), ["user_id"], ["seq"]), _last)
_register("cdc_apply", lambda s, d: ch.state_of(user_log(s, d), ["user_id"], ["seq"]), f"SELECT * EXCLUDE (action) FROM ({_last}) WHERE action <> 'delete'")


def cdc_apply_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user log applied to a table of one row per customer key."""
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("none").alias("event_type"), F.col("c_acctbal").alias("value"))
    return ch.apply_changes(users, user_log(spark, sf_dir).drop("props"), ["user_id"], ["seq"])


_register("cdc_apply_table", cdc_apply_table, f"""SELECT c_custkey AS user_id, 'none' AS event_type, c_acctbal AS value FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
    UNION ALL SELECT user_id, event_type, value FROM ({_last}) WHERE action <> 'delete'""")  # fmt: skip
_register("cdc_delete_keys", lambda s, d: ch.delete_keys(table(s, d, "customer"), table(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]),
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")


def cdc_delete_allcols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a key all columns must agree, null with null."""
    rows = _no_building(table(spark, sf_dir, "customer"))
    return ch.delete_keys(rows, rows.where("c_nationkey < 5"))


_register("cdc_delete_allcols", cdc_delete_allcols, "SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer WHERE c_nationkey >= 5")


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)


_register("cdc_conflict_replace", lambda s, d: ch.upsert(*_two_loads(s, d), ["o_orderkey"], "REPLACE"), "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders")
_register("cdc_conflict_ignore", lambda s, d: ch.upsert(*_two_loads(s, d), ["o_orderkey"], "IGNORE"), "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders")
_register("cdc_append", lambda s, d: ch.upsert(*_two_loads(s, d), ["o_orderkey"], ""), "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1 FROM orders WHERE o_orderstatus <> 'F'")


def cdc_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    new = rows.where("c_nationkey < 10").select("c_custkey", F.when(F.col("c_nationkey") < 5, F.lit(0.0)).alias("c_acctbal"))
    return ch.partial_update(rows, new, ["c_custkey"])


_register("cdc_partial_update", cdc_partial_update, "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 5 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer")
_register("cdc_before_after", lambda s, d: ch.with_before(user_log(s, d).select("user_id", "seq", "action", "value"), ["user_id"], ["seq"], ["value"]), f"SELECT user_id, seq, action, value, lag(value) OVER (PARTITION BY user_id ORDER BY seq) AS before_value FROM ({_log})")


def cdc_key_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of orders whose customer changes: delete of the old key, upsert of the new one."""
    rows = table(spark, sf_dir, "orders")
    image = lambda key: F.struct(key.alias("o_custkey"), F.col("o_orderkey").alias("o_orderkey"))
    moved = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    events = rows.select(F.col("o_orderkey").alias("seq"), F.lit(ch.UPDATE).alias("action"), image(F.col("o_custkey")).alias("before"), image(moved).alias("data"))
    return ch.normalised(events, ["o_custkey"])


_register("cdc_key_change", cdc_key_change, """SELECT o_orderkey AS seq, 'delete' AS action, 0 AS part, o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'update', 1, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END, o_orderkey FROM orders""")  # fmt: skip

# --- Delivery ---------------------------------------------------------------------------------------------------

_register("batch_stats", lambda s, d: flow.batch_statistics(table(s, d, "events"), "event_id", 1000, F.col("event_type") == "error", "ts"),
    "SELECT event_id // 1000 AS batch, count(*) AS n_rows, sum((event_type = 'error')::INT)::BIGINT AS n_errors, (epoch_ms(date_trunc('second', max(ts))) // 1000 - epoch_ms(date_trunc('second', min(ts))) // 1000)::BIGINT AS seconds FROM events GROUP BY 1")
_register("priority_shed", lambda s, d: flow.shed_low_priority(table(s, d, "events").select("event_id", F.date_trunc("day", "ts").alias("day"), "ts", F.when(F.col("event_type") == "view", "low").otherwise("high").alias("priority")), "day", "event_id", per_second=150).select("event_id", "priority"),
    "SELECT event_id, priority FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 'low' ELSE 'high' END AS priority, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY CASE WHEN event_type = 'view' THEN 1 ELSE 0 END, event_id) AS place FROM events) WHERE priority <> 'low' OR place <= 150")
_register("checkpoint_max", lambda s, d: flow.positions(table(s, d, "events"), ["event_type"], "event_id", "ts"), "SELECT event_type, max(event_id) AS position, (epoch_ms(date_trunc('second', max(ts))) // 1000)::BIGINT AS \"timestamp\" FROM events GROUP BY 1")


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.pmod(F.col("event_id"), F.lit(5))
    error = F.when(number == 0, "i/o timeout").when(number == 1, "cannot convert to int: x").when(number == 2, "unknown column c").when(number == 3, "unknown table t").otherwise("boom")
    return table(spark, sf_dir, "events").select("event_id", "ts", error.alias("error"), F.pmod(F.col("event_id"), F.lit(7)).cast("int").alias("attempts"))


_register("dlq_classify", lambda s, d: _failures(s, d).select("event_id", quarantine.failure_class(F.col("error")).alias("reason")),
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'temporary' WHEN 1 THEN 'format' WHEN 2 THEN 'schema' WHEN 3 THEN 'config' ELSE 'unknown' END AS reason FROM events")
_register("dlq_backoff", lambda s, d: _failures(s, d).select("event_id", quarantine.backoff_seconds(F.col("attempts")).alias("seconds")), "SELECT event_id, least(30, pow(2, event_id % 7))::BIGINT AS seconds FROM events")


def dlq_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and next attempt after one more failure, from a fixed time."""
    rows = _failures(spark, sf_dir).select("event_id", "attempts", quarantine.failure_class(F.col("error")).alias("reason"))
    after = quarantine.after_attempt(rows, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return after.select("event_id", "attempts", "status", F.unix_seconds("next_retry_at").alias("retry_at"))


_register("dlq_attempt", dlq_attempt, """SELECT event_id, (event_id % 7 + 1)::INT AS attempts, CASE WHEN gone THEN 'permanent' ELSE 'waiting' END AS status, CASE WHEN NOT gone THEN 1704067200 + least(30, pow(2, event_id % 7 + 1))::BIGINT END AS retry_at
    FROM (SELECT *, event_id % 7 + 1 >= 3 OR event_id % 5 IN (2, 3) AS gone FROM events)""")  # fmt: skip
_register("dlq_recent_1000", lambda s, d: quarantine.most_recent(_failures(s, d), "ts", "event_id").select("event_id"), "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
_register("dlq_ttl", lambda s, d: quarantine.within(_failures(s, d), "ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select("event_id"), "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 24 HOUR")

# --- Reading back -----------------------------------------------------------------------------------------------

_register("search_contains", lambda s, d: search.search(table(s, d, "documents"), "the", "doc_id"),
    "SELECT doc_id, ((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3)::INT AS score FROM documents WHERE contains(lower(text), 'the') ORDER BY score DESC, doc_id LIMIT 20")
_register("search_page_total", lambda s, d: search.search_total(table(s, d, "documents"), "license"), "SELECT count(*) AS total FROM documents WHERE contains(lower(text), 'license')")
_register("search_second_page", lambda s, d: search.search(table(s, d, "pages"), "href", "page_id", "html", 10, 10),
    "SELECT page_id, ((length(lower(html)) - length(replace(lower(html), 'href', ''))) // 4)::INT AS score FROM pages WHERE contains(lower(html), 'href') ORDER BY score DESC, page_id LIMIT 10 OFFSET 10")
_register("get_by_id", lambda s, d: search.get_document(table(s, d, "documents"), "doc_id", 7).select("doc_id", "lang", "source"), "SELECT doc_id, lang, source FROM documents WHERE doc_id = 7")
_register("row_count", lambda s, d: search.row_count(table(s, d, "lineitem")), "SELECT count(*) AS row_count FROM lineitem")
_register("table_size_by_group", lambda s, d: search.text_sizes(table(s, d, "documents"), "lang", ["text", "source"]), "SELECT lang, sum(octet_length(encode(text)) + octet_length(encode(source)))::BIGINT AS size_bytes, count(*) AS row_count FROM documents GROUP BY 1")
_register("value_size_check", lambda s, d: table(s, d, "documents").select("doc_id", doc.too_large(F.col("text"), table(s, d, "documents").schema["text"].dataType, text_bytes=10_000).alias("too_large")), "SELECT doc_id, octet_length(encode(text)) > 10000 AS too_large FROM documents")


# --- Several tables, retries, keys and times ----------------------------------------------------------------------

_PARTY = (
    ("customer", TableConfig("shop", "customer", "crm", "party", (C("c_custkey", "id"), C("c_name", "name", transform="toUpperCase"), C("c_mktsegment", "segment")))),
    ("supplier", TableConfig("shop", "supplier", "crm", "party", (C("s_suppkey", "id"), C("s_name", "name")))),
    ("nation", TableConfig("shop", "nation", "crm", "place", (C("n_nationkey", "id"),))),
)
_register("group_by_target", lambda s, d: mapped_by_target([(table(s, d, name), config) for name, config in _PARTY])["crm.party"],
    "SELECT c_custkey AS id, upper(c_name) AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")


def messages_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, key, a header and the name in the value of the messages of two tables."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = []
    for name, key, shown in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name")):
        rows = table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(shown).alias("name"), F.lit("insert").alias("action"))
        out.append(message_rows(rows, "task", "shop.eu", name, ("id",), at, at, headers={"table": F.lit(name)}))
    both = out[0].unionByName(out[1])
    return both.select("topic", "key", F.decode(F.col("headers")[0]["value"], "UTF-8").alias("header"), F.get_json_object("value", "$.data.name").alias("name"))


_register("messages_two_tables", messages_two_tables, """SELECT 'shop_eu_nation' AS topic, n_nationkey::VARCHAR AS key, 'nation' AS header, n_name AS name FROM nation
    UNION ALL SELECT 'shop_eu_region', r_regionkey::VARCHAR, 'region', r_name FROM region""")  # fmt: skip


def dlq_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows that are due two seconds after a failed attempt."""
    rows = _failures(spark, sf_dir).select("event_id", "attempts", quarantine.failure_class(F.col("error")).alias("reason"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return quarantine.due(quarantine.after_attempt(rows, at), at + F.expr("interval 2 seconds")).select("event_id", "attempts")


_register("dlq_due", dlq_due, "SELECT event_id, (event_id % 7 + 1)::INT AS attempts FROM events WHERE event_id % 7 + 1 < 3 AND event_id % 5 NOT IN (2, 3) AND pow(2, event_id % 7 + 1) <= 2")


def dlq_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is no number, mapped again once the column is a text."""
    strict = TableConfig("shop", "orders", columns=(C("o_orderkey", "id"), C("o_orderstatus", "status", type="int32")))
    mended = TableConfig("shop", "orders", columns=(C("o_orderkey", "id"), C("o_orderstatus", "status", transform="toLowerCase")))
    return valid_rows(map_rows(rejected_rows(table(spark, sf_dir, "orders"), strict).drop(ERRORS), mended))


_register("dlq_remap", dlq_remap, "SELECT o_orderkey AS id, lower(o_orderstatus) AS status FROM orders")


def cdc_map_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each user, with a map among its columns."""
    rows = user_log(spark, sf_dir).select("user_id", "seq", F.create_map("event_type", "value").alias("fields"))
    return ch.latest_changes(rows, ["user_id"], ["seq"]).select("user_id", "seq", F.map_keys("fields")[0].alias("event_type"), F.map_values("fields")[0].alias("value"))


_register("cdc_map_payload", cdc_map_payload, f"SELECT user_id, seq, event_type, value FROM ({_last})")
_register("cdc_delete_all", lambda s, d: ch.delete_all(table(s, d, "nation")), "SELECT * FROM nation WHERE false")
_register("delete_without_key", lambda s, d: user_log(s, d).withColumn("user_id", F.expr("nullif(user_id % 10, 0)")).select("seq", ch.key_errors(["user_id"]).alias("error")),
    f"SELECT seq, CASE WHEN action = 'delete' AND user_id % 10 = 0 THEN 'delete needs a key' END AS error FROM ({_log})")
_register("pk_all_columns", lambda s, d: table(s, d, "region").select(F.to_json(doc.primary_key((), ("r_regionkey", "r_name"), {"r_name": "name"})).alias("key")),
    """SELECT '{"r_regionkey":"' || r_regionkey || '","name":"' || r_name || '"}' AS key FROM region""")  # fmt: skip
_register("logged_statement", lambda s, d: table(s, d, "nation").select("n_nationkey", doc.logged_statement("DELETE FROM t WHERE k = ? AND n = ? AND ?", [(F.col("n_nationkey"), T.IntegerType()), (F.col("n_name"), T.StringType())]).alias("statement")),
    "SELECT n_nationkey, 'DELETE FROM t WHERE k = ' || n_nationkey || ' AND n = ' || chr(39) || replace(n_name, chr(39), chr(39) || chr(39)) || chr(39) || ' AND ?' AS statement FROM nation")
_register("cv_datetime_fraction", lambda s, d: table(s, d, "events").select("event_id", F.unix_micros(parse_time(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad(F.pmod("event_id", F.lit(1000)).cast("string"), 3, "0"), F.lit("4567Z")))).alias("micros")),
    "SELECT event_id, (epoch_ms(date_trunc('second', ts)) * 1000 + (event_id % 1000) * 1000 + 456)::BIGINT AS micros FROM events")
_register("batch_rows", lambda s, d: flow.row_batches(table(s, d, "lineitem").select(F.expr("l_orderkey * 16 + l_linenumber").cast("bigint").alias("place")).distinct(), "place", 1000, width=5000).groupBy("batch").agg(F.count("*").alias("n_rows"), F.min("place").alias("first")),
    "SELECT batch, count(*) AS n_rows, min(place) AS first FROM (SELECT place, (row_number() OVER (ORDER BY place) - 1) // 1000 AS batch FROM (SELECT DISTINCT (l_orderkey * 16 + l_linenumber)::BIGINT AS place FROM lineitem)) GROUP BY 1")
_register("priority_shed_seconds", lambda s, d: flow.shed_low_priority(table(s, d, "events").select("event_id", "ts", F.when(F.col("event_type") == "view", "low").otherwise("high").alias("priority")), "ts", "event_id", per_second=1).select("event_id", "priority"),
    "SELECT event_id, priority FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 'low' ELSE 'high' END AS priority, row_number() OVER (PARTITION BY date_trunc('second', ts) ORDER BY CASE WHEN event_type = 'view' THEN 1 ELSE 0 END, ts, event_id) AS place FROM events) WHERE priority <> 'low' OR place <= 1")
_register("share_of_total", lambda s, d: search.share_of_total(table(s, d, "documents"), "lang"), "SELECT lang, count(*) AS row_count, round(count(*) / (SELECT count(*) FROM documents), 9) AS share FROM documents GROUP BY 1")


# --- Flagship ---------------------------------------------------------------------------------------------------

ORDER_FACTS = TableConfig(
    "shop", "orders", target_table="order_facts",
    columns=(
        C("o_orderkey", "id", type="int64", required=True), C("o_custkey", "customer_id", type="uint32"), C("o_orderstatus", "order_status", transform="toLowerCase"),
        C("o_totalprice", "large_amount", condition="{{value}} > 100000"), C("o_totalprice", "amount", type="float64", required=True), C("o_orderpriority", ignore=True),
    ),
)


def revenue_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped orders: how many by status, and their revenue in cents."""
    facts = valid_rows(map_rows(table(spark, sf_dir, "orders"), ORDER_FACTS))
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("bigint"))
    return facts.groupBy("order_status").agg(F.count("*").alias("n_orders"), F.count("large_amount").alias("n_large"), cents("amount").alias("cents"), cents("large_amount").alias("large_cents"))


_register("revenue_by_status", revenue_by_status, "SELECT lower(o_orderstatus) AS order_status, count(*) AS n_orders, count(*) FILTER (o_totalprice > 100000) AS n_large, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, (sum(round(o_totalprice * 100)::BIGINT) FILTER (o_totalprice > 100000))::BIGINT AS large_cents FROM orders GROUP BY 1")
