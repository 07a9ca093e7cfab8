"""Whole configurations: two tables of a task, refused batches, retries, keyless deletes, checks and the command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.__main__ import main
from tidemark.config import ColumnMapping, SyncTask, TableConfig, config
from tidemark.operators import changes as ch
from tidemark.sources.tables import change_schema
from tidemark.streaming.runner import TableRun, runs_of, start_all

PAYLOAD = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def at(year):
    return F.lit(f"{year}-01-01 00:00:00").cast("timestamp")


def written(spark, path, events):
    spark.createDataFrame(events, change_schema(PAYLOAD)).coalesce(1).write.mode("append").parquet(path)


def inserts(table, keys, seq=0):
    return [("db", table, "insert", seq + i, None, (k, f"{table}{k}"), None) for i, k in enumerate(keys)]


def settings(tmp_path, kind, targets):
    names = {"mysql2clickhouse": "clickhouse", "mysql2kafka": "kafka"}
    tables = [{"sourceDatabase": "db", "sourceTable": t, "targetTable": to, "primaryKey": ["k"], "priority": p, "columns": [{"source": "k", "target": "key"}, {"source": "v", "target": "value"}]} for t, to, p in zip(("a", "b"), targets, ("low", "high"), strict=True)]
    return {
        "dataSources": [{"name": "in", "type": "mysql", "path": f"{tmp_path}/in"}, {"name": "out", "type": names[kind], "path": f"{tmp_path}/out"}],
        "syncTasks": [{"name": "task", "type": kind, "source": "in", "target": "out", "tables": tables}],
    }


def finished(queries):
    for q in queries:
        q.awaitTermination(120)
        assert q.exception() is None


def test_two_tables_with_one_target(spark, tmp_path):
    written(spark, f"{tmp_path}/in", inserts("a", range(5)) + inserts("b", range(100, 105)))
    conf = config(settings(tmp_path, "mysql2clickhouse", ("all", "all")))
    payloads = {"db.a": PAYLOAD, "db.b": PAYLOAD}
    for _ in range(2):  # what is done isn't done again
        finished(start_all(spark, conf, payloads, f"{tmp_path}/ck", available_now=True))
    written(spark, f"{tmp_path}/in", [("db", "a", "delete", 50, None, (1, None), None), ("db", "b", "update", 51, None, (2, "from b"), None)])
    finished(start_all(spark, conf, payloads, f"{tmp_path}/ck", available_now=True))
    runs = runs_of(conf, payloads, f"{tmp_path}/ck")
    assert [r.table.source_table for r in runs] == ["b", "a"]  # by priority
    got = {r.key: r.value for r in runs[0].change_table(spark).current(spark).collect()}
    assert got == {0: "a0", 2: "from b", 3: "a3", 4: "a4"} | {k: f"b{k}" for k in range(100, 105)}


def test_messages_of_two_tables(spark, tmp_path):
    written(spark, f"{tmp_path}/in", inserts("a", range(5)) + inserts("b", range(5)))
    conf = config(settings(tmp_path, "mysql2kafka", ("", "own")))
    finished(start_all(spark, conf, {"db.a": PAYLOAD, "db.b": PAYLOAD}, f"{tmp_path}/ck", available_now=True))
    rows = spark.read.json(f"{tmp_path}/out/messages").collect()
    assert sorted((r.topic, r.key) for r in rows) == sorted([("db_a", str(k)) for k in range(5)] + [("own", str(k)) for k in range(5)])


@pytest.fixture
def run(tmp_path):
    table = TableConfig("db", "a", target_table="t", columns=(ColumnMapping("k", "key"), ColumnMapping("v", "value")), primary_key=("k",))
    return TableRun(SyncTask("task", "mysql2clickhouse", "in", "out", (table,)), table, PAYLOAD, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", pause=0.0)


def test_refused_batches_wait_and_are_sent_again(spark, run):
    written(spark, run.changes, inserts("a", range(4)))
    calls = []

    def refusing(rows, batch_id):
        calls.append(batch_id)
        raise OSError("connection refused")

    finished([run.start(spark, available_now=True, sink=refusing)])
    assert calls == [0, 0, 0]
    rows = run.quarantined(spark).collect()
    assert len(rows) == 4 and {(r.status, r.reason, r.attempts) for r in rows} == {("waiting", "temporary", 0)}
    assert run.retry_due(spark, at(2000)) == 0  # none is due yet
    assert run.retry_due(spark, at(2100), sink=refusing) == 4
    assert {(r.status, r.attempts) for r in run.quarantined(spark).collect()} == {("waiting", 1)}
    assert run.retry_due(spark, at(2101)) == 4
    assert {(r.status, r.attempts) for r in run.quarantined(spark).collect()} == {("done", 2)}
    assert {r.key: r.value for r in run.change_table(spark).current(spark).collect()} == {k: f"a{k}" for k in range(4)}
    assert run.retry_due(spark, at(2102)) == 0


def test_permanent_after_three_attempts(spark, run):
    written(spark, run.changes, inserts("a", [7]))

    def refusing(rows, batch_id):
        raise OSError("timeout")

    finished([run.start(spark, available_now=True, sink=refusing)])
    for year in (2100, 2101, 2102, 2103):
        run.retry_due(spark, at(year), sink=refusing)
    assert [(r.status, r.attempts) for r in run.quarantined(spark).collect()] == [("permanent", 3)]


def test_rejects_are_mapped_again_once_the_mapping_is_mended(spark, run, tmp_path):
    from dataclasses import replace

    written(spark, run.changes, inserts("a", [1, 2]))
    strict = replace(run, table=replace(run.table, columns=(ColumnMapping("k", "key"), ColumnMapping("v", "value", type="int32"))))
    finished([strict.start(spark, available_now=True)])
    assert {r.reason for r in strict.quarantined(spark).collect()} == {"format"} and strict.change_table(spark).current(spark).count() == 0
    assert run.retry_due(spark, at(2100)) == 2
    assert {r.key: r.value for r in run.change_table(spark).current(spark).collect()} == {1: "a1", 2: "a2"}


def test_deletes_need_a_key(spark, run):
    from dataclasses import replace

    keyless = replace(run, table=replace(run.table, primary_key=(), on_conflict=""))
    written(spark, run.changes, [("db", "a", "delete", 1, None, (1, "x"), None)])
    finished([keyless.start(spark, available_now=True)])
    assert [r.errors for r in keyless.quarantined(spark).collect()] == [["delete needs a key"]]
    written(spark, run.changes, [("db", "a", "delete", 2, None, (None, "x"), None)])
    finished([replace(run, checkpoints=run.checkpoints + "2", output=run.output + "2").start(spark, available_now=True)])
    assert [r.errors for r in replace(run, output=run.output + "2").quarantined(spark).collect()] == [["delete needs a key"]]


def test_changes_with_maps(spark):
    rows = spark.createDataFrame([(1, 5, "insert", {"a": 1}), (1, 6, "update", {"b": 2}), (2, 1, "insert", {}), (2, 1, "insert", {"c": 3})], "k long, seq long, action string, m map<string,long>")
    # Of equal sequences the greater JSON text wins: {...,"m":{}} is above {...,"m":{"c":3}}.
    assert {r.k: r.m for r in ch.latest_changes(rows, ["k"], ["seq"]).collect()} == {1: {"b": 2}, 2: {}}
    assert {r.k: r.m for r in ch.first_changes(rows, ["k"], ["seq"]).collect()} == {1: {"a": 1}, 2: {"c": 3}}


def test_types_and_command_line(tmp_path, capsys):
    data = settings(tmp_path, "mysql2kafka", ("x", "y"))
    data["syncTasks"] += [data["syncTasks"][0] | {"name": "wrong", "source": "out"}, data["syncTasks"][0] | {"name": "odd", "type": "mysql2moon"}, data["syncTasks"][0] | {"name": "off", "enabled": False}]
    conf = config(data)
    assert [t.name for t in conf.active_tasks()] == ["task"] and conf.task_types() == ["mysql2kafka", "mysql2moon"] and conf.task("wrong").source == "out"
    assert conf.problem(conf.task("wrong")) == "out is of type kafka, not mysql" and [t.name for t in conf.tasks_of("MySQL2Kafka")] == ["task", "wrong", "off"]
    assert [t.source_table for t in conf.task("task").tables_into("y")] == ["b"]
    with pytest.raises(KeyError):
        conf.task("none")
    path = tmp_path / "tasks.json"
    path.write_text(json.dumps(data))
    assert main(["-f", str(path), "--list"]) == 0 and main(["-v"]) == 0
    shown = capsys.readouterr().out
    assert "task: ready" in shown and "wrong: out is of type kafka, not mysql" in shown and "off: disabled" in shown
