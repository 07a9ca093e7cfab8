"""A database sink, catalogue and queries, over the embedded database that Spark ships."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_streams import columns, run_of, sent
from tidemark.config import TableConfig
from tidemark.sinks.database import DatabaseTable, SinkRefused
from tidemark.sources.metadata import database_columns, declared_key, schema_columns, unique_keys
from tidemark.sources.tables import database_query


@pytest.fixture
def url():
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def run_sql(spark, url, *statements):
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    for sql in statements:
        connection.createStatement().executeUpdate(sql)
    connection.close()


def made(spark, url, keyed=True):
    run_sql(spark, url, f'CREATE TABLE "t" ("k" BIGINT{" NOT NULL PRIMARY KEY" if keyed else ""}, "v" VARCHAR(20), "n" INT CHECK ("n" < 100))')


def changes(spark, *rows):
    return spark.createDataFrame(rows, "k long, v string, n int, seq long, action string")


def held(spark, url):
    return sorted((r.k, r.v, r.n) for r in database_query(spark, url, 'SELECT "k", "v", "n" FROM "t"').collect())


def test_a_batch_counts_once(spark, url):
    made(spark, url)
    table = DatabaseTable(url, "t", ("k",))
    first = changes(spark, (1, "a", 1, 1, "insert"), (2, "b", 2, 2, "insert"), (2, "bb", 2, 3, "update"), (3, "c", 3, 4, "insert"))
    assert table.write(first, 0) and held(spark, url) == [(1, "a", 1), (2, "bb", 2), (3, "c", 3)]
    run_sql(spark, url, 'UPDATE "t" SET "v" = \'changed since\' WHERE "k" = 1')
    assert not table.write(first, 0) and held(spark, url)[0] == (1, "changed since", 1)
    bad = changes(spark, (4, "d", 4, 5, "insert"), (5, "e", 500, 6, "insert"), (3, None, None, 7, "delete"))
    with pytest.raises(SinkRefused):  # half of it could have been written
        table.write(bad, 1)
    assert held(spark, url) == [(1, "changed since", 1), (2, "bb", 2), (3, "c", 3)]
    good = bad.withColumn("n", F.least("n", F.lit(50)))
    assert table.write(good, 1) and held(spark, url) == [(1, "changed since", 1), (2, "bb", 2), (4, "d", 4), (5, "e", 50)]
    names = {r.table_name for r in database_columns(spark, url, "APP").collect()}
    assert names == {"t", "TIDEMARK_BATCHES"}  # nothing staged is left


def test_policies(spark, url):
    made(spark, url)
    rows = changes(spark, (1, "a", 1, 1, "insert"), (2, "b", 2, 2, "insert"))
    assert DatabaseTable(url, "t", ("k",), "IGNORE").write(rows, 0)
    assert DatabaseTable(url, "t", ("k",), "IGNORE").write(rows.withColumn("v", F.lit("new")).union(changes(spark, (3, "c", 3, 3, "insert"))), 1)
    assert held(spark, url) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    other = url.replace("memory:", "memory:b")
    made(spark, other, keyed=False)
    assert DatabaseTable(other, "t", (), "").write(rows, 0) and DatabaseTable(other, "t", (), "").write(rows, 1)
    assert held(spark, other) == [(1, "a", 1), (1, "a", 1), (2, "b", 2), (2, "b", 2)]
    with pytest.raises(ValueError):
        DatabaseTable(url, "t", (), "REPLACE")
    mysql = DatabaseTable("jdbc:mysql://x", "t", ("k",), "REPLACE", "mysql").statements("s", ["k", "v"])
    assert mysql[-1] == "INSERT INTO `t` (`k`, `v`) SELECT s.`k`, s.`v` FROM `s` s ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    assert DatabaseTable("jdbc:mysql://x", "t", ("k",), "IGNORE", "mysql").statements("s", ["k"])[-1].startswith("INSERT IGNORE INTO `t`")


def test_a_stream_into_a_database(spark, tmp_path, url):
    run_sql(spark, url, 'CREATE TABLE "t" ("k" BIGINT NOT NULL PRIMARY KEY, "v" VARCHAR(4))')
    run = replace(run_of(tmp_path, TableConfig("db", "a", target_table="t", columns=columns("k", "v"), primary_key=("k",)), kind="mysql2mysql"), database={"url": url})
    sent(spark, run, [("insert", 1, (1, "a"), None), ("insert", 2, (2, "b"), None), ("update", 3, (9, "z"), (2, "b"))])
    read = lambda: {r.k: r.v for r in database_query(spark, url, 'SELECT * FROM "t"').collect()}
    assert read() == {1: "a", 9: "z"}
    sent(spark, run, [("insert", 4, (3, "too long"), None), ("delete", 5, (1, None), None)])
    assert read() == {1: "a", 9: "z"} and run.quarantined(spark).count() == 2
    run_sql(spark, url, 'ALTER TABLE "t" ALTER COLUMN "v" SET DATA TYPE VARCHAR(40)')
    assert run.retry_due(spark, F.lit("2999-01-01").cast("timestamp")) == 2 and read() == {3: "too long", 9: "z"}
    assert database_query(spark, url, 'SELECT * FROM "t" WHERE "k" = 9').collect()[0].v == "z"  # a single row
    parts = database_query(spark, url, 'SELECT * FROM "t"', ("k", 0, 10, 3))
    assert parts.rdd.getNumPartitions() == 3 and parts.count() == 2


def test_catalogue(spark, url):
    run_sql(spark, url, 'CREATE TABLE "t" ("z" INT, "b" BIGINT NOT NULL, "a" VARCHAR(9) NOT NULL, PRIMARY KEY ("b", "a"))', 'CREATE TABLE "u" ("x" INT)')
    found = database_columns(spark, url, "APP")
    assert [(r.table_name, r.column_name, r.position, r.nullable, r.key_position) for r in found.collect()] == [("t", "z", 1, True, None), ("t", "b", 2, False, 1), ("t", "a", 3, False, 2), ("u", "x", 1, True, None)]
    assert declared_key(found, "t") == ["b", "a"] and declared_key(found, "u") == []


def test_keys_in_rows(spark):
    rows = spark.createDataFrame([(i, i % 30, i // 30, i % 7, None if i == 5 else "x", {"m": i}) for i in range(600)], "id long, a long, b long, c long, e string, m map<string,long>")
    assert unique_keys(rows) == [("id",), ("a", "b")]
    assert unique_keys(rows, ("a", "c", "e")) == [] and unique_keys(rows.unionAll(rows)) == []
    with_nulls = spark.createDataFrame([(None, 1), (1, 1), (1, None), (None, None)], "a long, b long")
    assert unique_keys(with_nulls) == [("a", "b")] and unique_keys(with_nulls.unionAll(with_nulls.limit(1))) == []
    assert [(r.column_name, r.position, r.key_position) for r in schema_columns(rows.select("id", "a"), "r", ["a"]).collect()] == [("id", 1, None), ("a", 2, 1)]


def test_batch_size_reaches_the_database(spark, url, tmp_path):
    """``BatchSize`` of a table is what its tasks send at a time; any size writes the same rows."""
    table = TableConfig("db", "t", columns=columns("k", "v"), primary_key=("k",), batch_size=7)
    assert replace(run_of(tmp_path, table), database={"url": url}).database_table().batch_size == 7
    made(spark, url)
    rows = [(k, f"v{k}", k, k, "insert") for k in range(20)]
    for size in (1, 7, 1000):
        assert DatabaseTable(url, "t", ("k",), batch_size=size).write(changes(spark, *rows), f"of-{size}")
        assert held(spark, url) == [(k, f"v{k}", k) for k in range(20)]
