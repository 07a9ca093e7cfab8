"""Change logs against a plain replay, the change table, and a stream that stops and starts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ColumnMapping, SyncTask, TableConfig
from tidemark.operators import changes as ch
from tidemark.operators import flow
from tidemark.sinks.change_table import ChangeTable
from tidemark.sources.tables import change_schema
from tidemark.streaming.runner import TableRun, with_retries

PAYLOAD = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def log(seed, n=200):
    r = random.Random(seed)
    return [(r.choice([*range(12), None]), i, r.choice([ch.INSERT, ch.UPDATE, ch.DELETE]), f"v{i}") for i in range(n)]


def replay(rows):
    state = {}
    for k, _, action, v in sorted(rows, key=lambda x: x[1]):
        state.pop(k, None) if action == ch.DELETE else state.__setitem__(k, v)
    return state


def test_replay_in_any_split(spark, tmp_path):
    rows = log(1)
    frame = spark.createDataFrame(rows, "k long, seq long, action string, v string")
    assert {r.k: r.v for r in ch.state_of(frame, ["k"], ["seq"]).collect()} == replay(rows)
    table = ChangeTable(str(tmp_path / "t"), PAYLOAD, ("k",))
    order = rows[:]
    random.Random(2).shuffle(order)
    for batch in range(4):
        part = spark.createDataFrame(order[batch::4], "k long, seq long, action string, v string")
        table.append(batch, part)
        table.append(batch, part)  # a repeated batch changes nothing
    assert {r.k: r.v for r in table.current(spark).collect()} == replay(rows)
    smaller = table.compact(spark, str(tmp_path / "u"))
    assert {r.k: r.v for r in smaller.current(spark).collect()} == replay(rows)
    assert ChangeTable(str(tmp_path / "none"), PAYLOAD, ("k",)).current(spark).count() == 0


def test_hot_key_is_merged_before_the_shuffle(spark):
    frame = spark.createDataFrame(log(3), "k long, seq long, action string, v string")
    plan = ch.latest_changes(frame, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_stream_that_stops_and_starts(spark, tmp_path):
    rows = log(4, 60)
    source = str(tmp_path / "in")
    events = [("db", "t", a, i, None, (k, v), (k if i % 9 else (k or 0) + 100, "old") if a == ch.UPDATE else None) for k, i, a, v in rows if k is not None]
    write = lambda part: spark.createDataFrame([(d, t, a, s, ts, data, before) for d, t, a, s, ts, data, before in part], change_schema(PAYLOAD)).coalesce(1).write.mode("append").parquet(source)
    table = TableConfig("db", "t", target_table="out", columns=(ColumnMapping("k", "key"), ColumnMapping("v", "value", transform="toUpperCase")), primary_key=("k",))
    run = TableRun(SyncTask("task", "mysql2clickhouse", "a", "b", (table,)), table, PAYLOAD, source, str(tmp_path / "out"), str(tmp_path / "ck"), files_per_batch=1)
    for part in (events[:20], events[20:]):
        write(part)
        query = run.start(spark, available_now=True)
        query.awaitTermination(60)
        assert query.exception() is None
    want = replay([(k, i, a, v) for k, i, a, v in rows if k is not None])
    assert {r.key: r.value for r in run.change_table(spark).current(spark).collect()} == {k: v.upper() for k, v in want.items()}


def test_key_change(spark):
    rows = spark.createDataFrame([(1, "update", (1, "a"), (2, "b")), (2, "insert", None, (3, "c")), (3, "delete", (3, "c"), None)], "seq long, action string, before struct<k: long, v: string>, data struct<k: long, v: string>")
    got = sorted((r.seq, r.part, r.action, r.k) for r in ch.normalised(rows, ["k"]).collect())
    assert got == [(1, 0, "delete", 1), (1, 1, "update", 2), (2, 1, "insert", 3), (3, 1, "delete", 3)]


def test_retries_end():
    calls = []

    def sink(rows, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("connection lost")

    with_retries(sink, pause=0.0)(None, 5)
    assert calls == [5, 5, 5]


def test_before_images_of_a_hot_key_in_any_range(spark):
    """Ranges of any width give what one pass over each key gives; null keys are a key, nulls are images."""
    rows = [(k, i * 3 % 400, a, v if i % 5 else None) for k, i, a, v in log(5)]
    want, last = {}, {}
    for k, seq, _, v in sorted(rows, key=lambda x: x[1]):
        want[seq], last[k] = last.get(k), v
    frame = spark.createDataFrame(rows, "k long, seq long, action string, image string")
    for width in (1, 7, 100_000):
        got = ch.with_before(frame, ["k"], ["seq"], ["image"], width)
        assert got.columns == ["k", "seq", "action", "image", "before_image"]
        assert {r.seq: r.before_image for r in got.collect()} == want
    assert ch.with_before(frame.limit(0), ["k"], ["seq"], ["image"]).count() == 0


def test_shedding_sends_no_more_than_a_second_holds(spark):
    rows = [(i, i // 40, "low" if i % 4 else (None if i % 8 else "high")) for i in range(400)] + [(900, None, "low"), (901, None, None)]
    frame = spark.createDataFrame(rows, "id long, _second long, priority string").withColumn("ts", F.timestamp_seconds("_second"))
    kept = sorted(r.id for r in flow.shed_low_priority(frame, "ts", "id", per_second=15).collect())
    want = []
    for second in {s for _, s, _ in rows}:
        own = [(i, p) for i, s, p in rows if s == second]
        rest = [i for i, p in own if p != "low"]
        want += rest + sorted(i for i, p in own if p == "low")[: max(0, 15 - len(rest))]
    assert kept == sorted(want)
    plan = flow.shed_low_priority(frame, "ts", "id", per_second=15)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
