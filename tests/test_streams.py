"""What streams must not lose: keyless tables, failed retries, rows that leave a filter, clashing names, broken-off retries."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ColumnMapping, SyncTask, TableConfig, table_config
from tidemark.functions.widening import wider
from tidemark.operators import changes as ch
from tidemark.operators.buckets import Bucket, Level, bucket_levels, last_level, limited
from tidemark.operators.flow import row_batches
from tidemark.sinks.change_table import ChangeTable
from tidemark.sinks.manifest import Manifest
from tidemark.sources.tables import change_schema
from tidemark.streaming.runner import TableRun, start_all, stop_all  # noqa: F401

PAYLOAD = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def run_of(tmp_path, table, payload=PAYLOAD, kind="mysql2clickhouse"):
    return TableRun(SyncTask("task", kind, "in", "out", (table,)), table, payload, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", pause=0.0)


def sent(spark, run, events, sink=None):
    """events: (action, seq, data, before)."""
    rows = [("db", "a", a, s, None, d, b) for a, s, d, b in events]
    spark.createDataFrame(rows, change_schema(run.payload)).coalesce(1).write.mode("append").parquet(run.changes)
    query = run.start(spark, available_now=True, sink=sink)
    query.awaitTermination(120)
    assert query.exception() is None


def columns(*names):
    return tuple(map(ColumnMapping, names))


def at(year):
    return F.lit(f"{year}-01-01 00:00:00").cast("timestamp")


def test_keyless_and_append_tables(spark, tmp_path):
    rows = [("insert", i, (i % 2, f"v{i}"), None) for i in range(5)] + [("insert", 4, (0, "v4"), None)]
    keyless = run_of(tmp_path / "a", TableConfig("db", "a", columns=columns("k", "v")))
    sent(spark, keyless, rows)
    assert sorted(r.v for r in keyless.change_table(spark).current(spark).collect()) == ["v0", "v1", "v2", "v3", "v4", "v4"]
    appended = run_of(tmp_path / "b", table_config({"sourceDatabase": "db", "sourceTable": "a", "primaryKey": ["k"], "onConflict": "", "columns": [{"source": "k"}, {"source": "v"}]}))
    sent(spark, appended, [*rows, ("delete", 3, (1, None), None)])
    assert sorted(r.v for r in appended.change_table(spark).current(spark).collect()) == ["v0", "v2", "v4", "v4"]
    assert TableConfig("db", "a", on_conflict="REPLACE").problem() and TableConfig("db", "a", on_conflict="ignore").problem() and not TableConfig("db", "a").problem()
    assert "no such conflict policy" in TableConfig("db", "a", primary_key=("k",), on_conflict="merge").problem()


def test_first_row_stays(spark, tmp_path):
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "v"), primary_key=("k",), on_conflict="IGNORE"))
    sent(spark, run, [("insert", 1, (1, "a"), None), ("insert", 2, (1, "b"), None), ("insert", 3, (2, "a"), None), ("delete", 4, (2, None), None), ("insert", 5, (2, "c"), None)])
    target = run.change_table(spark)
    assert {r.k: r.v for r in target.current(spark).collect()} == {1: "a", 2: "c"}
    assert {r.k: r.v for r in target.compact(spark).current(spark).collect()} == {1: "a", 2: "c"}


def test_rows_that_leave_a_filter(spark, tmp_path):
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "v"), primary_key=("k",), where="v >= 'm'"))
    sent(spark, run, [("insert", i, (i, "x"), None) for i in range(1, 7)] + [("insert", 9, (7, "b"), None)])
    sent(spark, run, [
        ("update", 10, (1, "b"), (1, "x")), ("update", 11, (2, "a"), None), ("delete", 12, (3, None), None), ("delete", 13, None, (4, None)), ("update", 14, (7, "z"), (7, "b")),
        ("update", 15, (50, "y"), (5, "x")), ("update", 16, (60, "b"), (6, "x")), ("update", 17, (8, "c"), (8, "b")),
    ])
    assert {r.k: r.v for r in run.change_table(spark).current(spark).collect()} == {7: "z", 50: "y"}


def test_names_of_envelopes(spark, tmp_path):
    names = ["ts", "action", "seq", "part", "table", "database", "_order", "_envelope", "_change", "_event", "row", "change", "data", "before", "id", "origin", "_id", "_change_text"]
    payload = T.StructType([T.StructField(n, T.StringType()) for n in names])
    run = run_of(tmp_path, TableConfig("db", "a", columns=(*columns(*names[:-1]), ColumnMapping(names[-1], names[-1], required=True)), primary_key=("seq",)), payload)
    row = lambda k, v: tuple(k if n == "seq" else v for n in names)
    sent(spark, run, [("insert", 1, row("a", "x"), None), ("update", 2, row("a", "y"), row("a", "x")), ("insert", 3, row("b", "x"), None), ("delete", 4, row("b", "x"), None), ("insert", 5, row("c", ""), None)])
    assert [r.asDict() for r in run.change_table(spark).current(spark).collect()] == [dict(zip(names, row("a", "y"), strict=True))]
    lax = replace(run, table=replace(run.table, columns=columns(*names)))
    assert lax.retry_due(spark, at(2999)) == 1
    assert {r.seq for r in lax.change_table(spark).current(spark).collect()} == {"a", "c"}
    out = run_of(tmp_path / "m", TableConfig("db", "a", target_table="t", columns=columns(*names), primary_key=("seq",)), payload, "mysql2kafka")
    sent(spark, out, [("insert", 1, row("a", "x"), None)])
    assert spark.read.json(f"{out.output}/messages").select(F.get_json_object("value", "$.data.action"), F.get_json_object("value", "$.action")).first()[:] == ("x", "insert")


def test_failed_retries_wait_whatever_the_order_of_columns(spark, tmp_path):
    payload = T._parse_datatype_string("k bigint, v string, t timestamp")
    strict = run_of(tmp_path, TableConfig("db", "a", columns=(ColumnMapping("k"), ColumnMapping("v", type="int32"), ColumnMapping("t")), primary_key=("k",)), payload)
    import datetime

    when = datetime.datetime(2024, 1, 1, 0, 0, 0, 123456)
    sent(spark, strict, [("insert", 1, (1, "x", when), None), ("insert", 2, (2, "7", when), None)])
    turned = replace(strict, payload=T._parse_datatype_string("t timestamp, v string, k bigint"))
    assert turned.retry_due(spark, at(2100)) == 1
    assert [(r.status, r.attempts) for r in turned.quarantined(spark).collect()] == [("waiting", 1)]
    mended = replace(turned, table=replace(strict.table, columns=columns("k", "v", "t")))
    assert mended.retry_due(spark, at(2101)) == 1
    assert [(r.status, r.attempts) for r in mended.quarantined(spark).collect()] == [("done", 2)]
    assert {(r.k, r.v, r.us) for r in mended.change_table(spark).current(spark).withColumn("us", F.unix_micros("t") % 1_000_000).collect()} == {(1, "x", 123456), (2, "7", 123456)}
    # The same change once more is a rejection of its own.
    sent(spark, strict, [("insert", 1, (1, "x", when), None)])
    assert sorted(r.status for r in strict.quarantined(spark).collect()) == ["done", "waiting"]


def test_equal_rejects_are_sent_as_often_as_they_came(spark, tmp_path):
    strict = run_of(tmp_path, TableConfig("db", "a", columns=(ColumnMapping("k"), ColumnMapping("v", type="int32"))))
    sent(spark, strict, [("insert", 1, (1, "x"), None)] * 3)
    mended = replace(strict, table=replace(strict.table, columns=columns("k", "v")))
    assert mended.retry_due(spark, at(2100)) == 1
    assert [(r.k, r.v) for r in mended.change_table(spark).current(spark).collect()] == [(1, "x")] * 3


def test_a_retry_that_was_broken_off_keeps_its_name(spark, tmp_path):
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "v"), primary_key=("k",)))

    def refusing(rows, batch_id):
        raise OSError("connection refused")

    sent(spark, run, [("insert", 1, (1, "x"), None)], refusing)
    names = []

    def broken(rows, batch_id):
        names.append(batch_id)
        rows.count()
        raise RuntimeError("lost after writing")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            run.retry_due(spark, at(2100), sink=broken)
    assert run.retry_due(spark, at(2100), sink=lambda rows, batch_id: names.append(batch_id)) == 1 and names == ["retry-0"] * 3
    assert run.retry_due(spark, at(2101)) == 0 and [(r.status, r.attempts) for r in run.quarantined(spark).collect()] == [("done", 1)]


def test_faults_of_a_program_stop_the_query(spark, tmp_path):
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "v"), primary_key=("k",)))
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        sent(spark, run, [("insert", 1, (1, "x"), None)], lambda rows, batch_id: rows.select("misspelt").collect())
    assert run.quarantined(spark).count() == 0


def test_sizes(spark, tmp_path):
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "v"), primary_key=("k",), max_text_bytes=3))
    sent(spark, run, [("insert", 1, (1, "éé"), None), ("insert", 2, (2, "abc"), None), ("delete", 3, (3, "long text"), None)])
    assert [r.errors for r in run.quarantined(spark).collect()] == [["value too large: v"]]


def test_column_wise_merge_in_any_split(spark, tmp_path):
    schema = T._parse_datatype_string("k bigint, a string, b bigint, m map<string,bigint>")
    r = random.Random(4)
    rows = [(r.choice([1, 2, 3, None]), r.choice([None, f"a{i}"]), r.choice([None, i]), r.choice([None, {"x": i}]), i // 2 * 2 if i % 5 else i, r.choice(["insert", "update", "update", "delete"] if i % 9 == 0 else ["update"])) for i in range(120)]
    state, tie = {}, {}
    for k, a, b, m, seq, action in sorted(rows, key=lambda x: (x[4], x[5] == "delete")):
        if action == "delete":
            state.pop(k, None)
            continue
        own = state.setdefault(k, {})
        for c, v in (("a", a), ("b", b), ("m", m)):
            if v is not None and (own.get(c, (-1,))[0] < seq or str(v) > str(own[c][1]) if c != "b" else own.get(c, (-1, -1)) < (seq, v)):
                own[c] = (seq, v)
    want = {k: tuple(own.get(c, (0, None))[1] for c in "abm") for k, own in state.items()}
    frame = spark.createDataFrame(rows, "k bigint, a string, b bigint, m map<string,bigint>, seq bigint, action string")
    found = lambda df: {x.k: (x.a, x.b, x.m) for x in df.collect()}
    assert found(ch.merged_columns(frame, ["k"], ["seq"])) == want
    r.shuffle(rows)
    table = ChangeTable(str(tmp_path / "t"), schema, ("k",), policy="PARTIAL")
    for batch in range(4):
        table.append(batch, spark.createDataFrame(rows[batch::4], frame.schema))
        if batch == 2:
            table.compact(spark)
    table.append(1, spark.createDataFrame(rows[1::4], frame.schema))  # a batch that the base has
    assert found(table.current(spark)) == want and found(table.compact(spark).current(spark)) == want


def test_readers_keep_their_version(spark, tmp_path):
    table = ChangeTable(str(tmp_path / "t"), PAYLOAD, ("k",))
    rows = lambda *ks: spark.createDataFrame([(k, f"v{k}", k, "insert") for k in ks], "k long, v string, seq long, action string")
    table.append(0, rows(1, 2))
    seen = table.version(spark)
    before = table.current(spark, seen)
    table.append(0, rows(1, 2))  # a replay publishes a folder of its own
    table.append(1, rows(3))
    assert {r.k for r in before.collect()} == {1, 2} and {r.k for r in table.current(spark).collect()} == {1, 2, 3}
    assert table.version(spark).folders["main/0"] != seen.folders["main/0"]
    assert table.expired(spark, 3600) == []
    table.compact(spark)
    gone = table.expired(spark, 0.0)
    assert len(gone) == 3 and list(seen.folders.values())[0] in gone and {r.k for r in table.current(spark).collect()} == {1, 2, 3}


def test_two_writers_of_one_manifest(spark, tmp_path):
    one, other = (Manifest(spark, str(tmp_path / "m")) for _ in range(2))
    raced = []

    def change(now):
        if not raced:  # the other writer is faster
            raced.append(other.commit(lambda v: replace(v, folders=v.folders | {"b": "2"})))
        return replace(now, folders=now.folders | {"a": "1"})

    assert one.commit(change).folders == {"a": "1", "b": "2"} and one.current().number == 2
    (tmp_path / "m/versions/000000000003.json").write_text('{"fold')  # never ended
    assert other.current().number == 2 and other.commit(lambda v: replace(v, folders=v.folders | {"c": "3"})).number == 4


def test_rows_without_a_number_have_a_batch(spark):
    rows = spark.createDataFrame([(3,), (None,), (1,), (None,)], "n long")
    assert sorted((r.batch, -1 if r.n is None else r.n) for r in row_batches(rows, "n", 2).collect()) == [(0, 1), (0, 3), (1, -1), (1, -1)]


def plain_bucket(events, rate, burst, start=None):
    """events: (second, place, priority)."""
    second, level = (None, burst) if start is None else (start.second, start.tokens)
    kept, levels = [], {}
    for s, i, p in sorted(events):
        if s != second:
            level = burst if second is None else min(burst, level + (s - second) * rate)
            second, levels[s] = s, level
        if level > 0 or p != "low":
            kept.append(i)
        level = max(0, level - 1)
    return sorted(kept), levels, Level(second, level)


@pytest.mark.parametrize("rate,burst,width", [(2, 3, 2), (1, 7, 4), (0, 5, 3)])
def test_token_bucket(spark, rate, burst, width):
    r = random.Random(rate * 10 + burst)
    events = [(s, i, r.choice(["low", "low", "high", None])) for i, s in enumerate(r.choice([5, 5, 5, 6, 7, r.randrange(400)]) for _ in range(500))]
    first, second = [e for e in events if e[0] < 150], [e for e in events if e[0] >= 150]
    bucket, start = Bucket(rate, burst, width), None
    for part in (first, second):  # the last level is carried to the next batch
        frame = spark.createDataFrame([(i, s, p) for s, i, p in part] + [(9999, None, "low")], "i long, s long, priority string").withColumn("at", F.timestamp_seconds("s"))
        kept, levels, end = plain_bucket(part, rate, burst, start)
        assert sorted(x.i for x in limited(frame, "at", "i", bucket=bucket, start=start).collect()) == [*kept, 9999]
        found = bucket_levels(frame.where("s is not null").groupBy(F.col("s").alias("second")).agg(F.count("*").alias("n")), bucket, start)
        assert {x.second: x.level for x in found.collect()} == levels and last_level(found) == end
        start = end


def test_lattice_of_types():
    byte, int_, long, double, text, date = T.ByteType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
    assert wider(byte, long) == long and wider(int_, T.FloatType()) == double and wider(long, double) == text and wider(date, T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(long, T.DecimalType(5, 2)) == T.DecimalType(21, 2) and wider(T.DecimalType(38, 0), T.DecimalType(5, 2)) == text and wider(T.BinaryType(), text) is None
    assert wider(T.ArrayType(int_), T.ArrayType(long)) == T.ArrayType(long) and wider(T.ArrayType(int_), int_) is None and wider(T.NullType(), date) == date
    kinds = [byte, int_, long, double, text, date, T.BooleanType(), T.FloatType(), T.DecimalType(5, 2), T.TimestampNTZType()]
    for a in kinds:
        assert wider(a, a) == a
        for b in kinds:
            assert wider(a, b) == wider(b, a) and wider(wider(a, b), b) == wider(a, b)
            for c in kinds[:6]:  # an order of arrival gives the same type, as long as no number becomes a text on the way
                one, other = wider(wider(a, b), c), wider(a, wider(b, c))
                assert one == other or text in (one, other)


def test_a_stream_whose_table_changes(spark, tmp_path):
    narrow = T._parse_datatype_string("k int, s struct<x: int>")
    run = run_of(tmp_path, TableConfig("db", "a", columns=columns("k", "s"), primary_key=("k",)), narrow)
    sent(spark, run, [("insert", 1, (1, (1,)), None), ("insert", 2, (2, (2,)), None)])
    wide = replace(run, payload=T._parse_datatype_string("k bigint, s struct<x: bigint, y: string>, more string"), table=replace(run.table, columns=columns("k", "s", "more")), changes=f"{run.changes}-2", checkpoints=f"{run.checkpoints}-2")
    sent(spark, wide, [("update", 3, (2, (1 << 40, "y"), "m"), None), ("insert", 4, (1 << 40, None, None), None)])
    want = {(1, (1, None), None), (2, (1 << 40, "y"), "m"), (1 << 40, None, None)}
    for r in (run, wide):  # nothing is narrowed, whoever reads
        target = r.change_table(spark)
        assert {(x.k, x.s and tuple(x.s), x.more) for x in target.current(spark).collect()} == want
    odd = replace(wide, payload=T._parse_datatype_string("k bigint, s string"), table=run.table, changes=f"{run.changes}-3", checkpoints=f"{run.checkpoints}-3")
    sent(spark, odd, [("insert", 9, (9, "no struct"), None)])
    assert [(r.reason, r.status) for r in odd.quarantined(spark).where("status = 'waiting'").collect()] == [("schema", "waiting")]
    target = wide.change_table(spark)
    assert {(x.k, x.s and tuple(x.s), x.more) for x in target.compact(spark).current(spark).collect()} == want


def test_low_priority_waits_for_tokens(spark, tmp_path):
    """A bucket of 3 tokens, 2 a second: its level goes from batch to batch, and what finds no token isn't lost."""
    limits = {"columns": columns("k", "v"), "primary_key": ("k",), "rate_limit": 2, "burst": 3}

    def arrive(run, seconds):
        first = arrive.next
        arrive.next += len(seconds)
        rows = [("db", "a", "insert", first + i, None, (first + i, "v"), None) for i in range(len(seconds))]
        frame = spark.createDataFrame(rows, change_schema(run.payload)).withColumn("ts", F.timestamp_seconds(F.element_at(F.array(*map(F.lit, seconds)), (F.col("seq") - first + 1).cast("int"))))
        frame.coalesce(1).write.mode("append").parquet(run.changes)
        query = run.start(spark, available_now=True)
        query.awaitTermination(120)
        assert query.exception() is None

    arrive.next = 0
    run = run_of(tmp_path / "low", TableConfig("db", "a", priority="low", **limits))
    there = lambda: sorted(r.k for r in run.change_table(spark).current(spark).collect())
    arrive(run, [100] * 5)
    assert there() == [0, 1, 2]
    arrive(run, [101] * 4)  # two tokens since
    assert there() == [0, 1, 2, 5, 6]
    arrive(run, [90, 110])  # a late change gains nothing, a later one finds a full bucket
    assert there() == [0, 1, 2, 5, 6, 10]
    held = run.quarantined(spark).collect()
    assert len(held) == 5 and all(r.errors == ["rate limit"] and r.status == "waiting" for r in held)
    assert run.retry_due(spark, at(2100)) == 5 and there() == list(range(11))
    arrive.next = 0
    run = run_of(tmp_path / "normal", TableConfig("db", "a", **limits))
    arrive(run, [100] * 5)
    assert there() == list(range(5))
    assert TableConfig("db", "a", rate_limit=-1).problem()


def test_a_longer_log_makes_more_files_not_larger_ones(spark, small_dir, monkeypatch):
    """Files and batches hold no more rows however many changes there are; what a batch rejects keeps the text it came as."""
    from tidemark import stream_queries as q

    monkeypatch.setattr(q, "FILE_ROWS", 50)
    monkeypatch.setattr(q, "MOST_FILES", 7)
    runs = []
    streamed = q.streamed
    monkeypatch.setattr(q, "streamed", lambda *given: runs.append(streamed(*given)) or runs[-1])
    events = spark.read.parquet(f"{small_dir}/events.parquet").collect()
    rows = q.append_log(spark, small_dir).collect()
    kinds = {e.event_type for e in events} - {"error"}
    assert {(r.kind, r.n, r.ids) for r in rows} == {(k, sum(e.event_type == k for e in events), sum(e.event_id for e in events if e.event_type == k)) for k in kinds}
    sizes = [r["count"] for r in spark.read.parquet(runs[0].changes).groupBy(F.input_file_name()).count().collect()]
    batches = runs[0].statistics(spark).collect()
    assert sum(sizes) == len(events) > 8 * 50 and max(sizes) <= 50 and len(batches) == -(-len(sizes) // 7) and max(b.n_rows for b in batches) <= 350
    waits = runs[0].quarantined(spark).select("id", F.from_json("change", "seq bigint, action string").alias("c"), "change").select("id", "c.*", "change").collect()
    assert {w.seq for w in waits} == {e.event_id for e in events if e.event_type == "error"} and {w.action for w in waits} == {"delete"}
    assert len({w.id for w in waits}) == len(waits) and all('"data":{"event_id":' in w.change for w in waits)
