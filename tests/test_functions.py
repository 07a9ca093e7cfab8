"""Conversions, conditions, transforms and labels on the edge values of the fixtures."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ColumnMapping, Label, TableConfig, config, load_config
from tidemark.functions.conditions import condition
from tidemark.functions.convert import convert
from tidemark.functions.labels import enum_label, set_label
from tidemark.functions.transform import TransformError, transform
from tidemark.plans.mapping import ERRORS, map_rows, rejected_rows, valid_rows

TEXTS = [None, "", " \t", "0", "-7", "9223372036854775807", "18446744073709551615", "1.5", " 12 ", "abc", "true", "Yes", "y", "2024-01-01", "2024-01-01 00:00:01", "2024-01-01 00:00:00.123456", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+08:00", "0000-00-00 00:00:00", "2024", "12:00:00", "1d"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, v string")


def both(frame, pair):
    rows = frame.select("i", pair[0].alias("value"), pair[1].isNotNull().alias("failed")).orderBy("i").collect()
    return {TEXTS[r.i]: "error" if r.failed else r.value for r in rows}


def test_integers(texts):
    got = both(texts, convert(F.col("v"), T.StringType(), "Int64"))
    assert {k: v for k, v in got.items() if v != "error"} == {None: None, "": 0, "0": 0, "-7": -7, "9223372036854775807": 2**63 - 1, "2024": 2024}
    got = both(texts, convert(F.col("v"), T.StringType(), "uint64"))
    assert {k: v for k, v in got.items() if v != "error"} == {None: None, "": 0, "0": 0, "9223372036854775807": 2**63 - 1, "18446744073709551615": 2**64 - 1, "2024": 2024}


def test_floats_times_and_booleans(texts):
    got = both(texts, convert(F.col("v"), T.StringType(), "float64"))
    assert got["1.5"] == 1.5 and got["1d"] == got[" 12 "] == got["abc"] == "error" and got[None] is None
    got = both(texts, convert(F.date_format(F.col("v"), "x") if False else F.col("v"), T.StringType(), "datetime"))
    seconds = {k: v if v in ("error", None) else v.strftime("%Y-%m-%d %H:%M:%S.%f") for k, v in got.items()}
    assert seconds["2024-01-01 00:00:00.123456"].endswith(".123456") and seconds["2024"] == seconds["12:00:00"] == seconds["0000-00-00 00:00:00"] == "error"
    assert None not in (seconds["2024-01-01"], seconds["2024-01-01 00:00:01"], seconds["2024-01-01T00:00:00Z"]) and seconds[""] is None
    table, document = (both(texts, convert(F.col("v"), T.StringType(), "bool", sink)) for sink in ("table", "document"))
    assert table["true"] and table["Yes"] and not table["y"] and document["y"] and table[None] is None and table["abc"] is False


def test_conditions(texts):
    got = both(texts, condition("{{value}} >= 0", F.col("v")))
    assert got["0"] is True and got["-7"] is False and got[None] is False and got["abc"] == "error"
    assert both(texts, condition("{{value}} == abc ", F.col("v")))["abc"] is True
    assert both(texts, condition("{{value}}", F.col("v"))) | {"abc": True, "": False, None: False} == both(texts, condition("{{value}}", F.col("v")))
    assert both(texts, condition("{{value}} >= 0", F.col("v"), "compat"))["0"] == "error"


@pytest.mark.parametrize(
    ("text", "value", "want"),
    [
        ("toUpperCase", "ab", "AB"), ("toLowerCase({{value}})", "AB", "ab"), ("trim", "  a b\t", "a b"), ("concat({{value}}, ' - ', x)", "a(b", "a(b-x"), ("substring({{value}}, -2)", "größe", "ße"),
        ("substring({{value}}, 1, 2)", "größe", "rö"), ("substring({{value}}, 9)", "abc", ""), ("substring({{value}}, x)", "abc", "abc"), ("replace({{value}}, a, b)", "aXa", "bXb"), ("if({{value}} > 3, big, small)", "4", "big"),
        ("if({{value}}, on, off)", "true", "on"), ("default({{value}}, none)", "", "none"), ("jsonStringify", 'a"b', '"a\\"b"'), ("toUpperCase(trim({{value}}))", " a,b ", "A,B"), ("toUnixTimestamp", "1970-01-02", "86400"), ("toBoolean", "Y", "true"), ("just text", "a", "just text"),
    ],
)
def test_transforms(spark, text, value, want):
    out, _ = transform(text, F.col("v"), T.StringType())
    assert spark.createDataFrame([(value,)], "v string").select(out.cast("string")).first()[0] == want


def test_unreadable_transforms(spark):
    for text in ("noSuch({{value}})", "trim({{value}}", "if({{value}}, a)", "trim({{value}}, a, b)"):
        with pytest.raises(TransformError):
            transform(text, F.lit("a"), T.StringType())
    assert spark.range(1).select(transform("toUpperCase", F.lit("a"), T.StringType(), "compat")[0]).first()[0] == "toUpperCase"


def test_labels(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (8,), (None,)], "v long")
    labels = (Label("a", 1), Label("b", 2), Label("none", -1))
    assert [r[0] for r in rows.select(set_label(F.col("v"), labels)).collect()] == ["", "a", "a,b", "none", None]
    assert [r[0] for r in rows.select(enum_label(F.col("v"), labels)[0]).collect()] == ["none", "a", "none", "none", None]
    assert [r[0] for r in rows.select(enum_label(F.col("v"), labels[:2])[1].isNotNull()).collect()] == [True, False, True, True, False]


def test_rejected_rows_keep_their_source(spark):
    table = TableConfig("db", "t", columns=(ColumnMapping("id", required=True), ColumnMapping("n", "number", type="int32", default="7"), ColumnMapping("gone", "x", default="d"), ColumnMapping("n", "id2", ignore=True)))
    rows = spark.createDataFrame([("1", "5"), ("", "5"), ("2", "x"), ("3", None)], "id string, n string")
    assert sorted(map(tuple, valid_rows(map_rows(rows, table)).collect())) == [("1", 5, "d"), ("3", 7, "d")]
    bad = rejected_rows(rows, table)
    assert bad.columns == ["id", "n", ERRORS] and sorted((r.id, r.n, len(r[ERRORS])) for r in bad.collect()) == [("", "5", 1), ("2", "x", 1)]
    plan = map_rows(rows, table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan


def test_configuration(tmp_path):
    data = {
        "DataSources": [{"Name": "a", "Type": "mysql", "Host": "h"}, {"Name": "b", "Type": "meilisearch"}],
        "SyncTasks": [
            {"Name": "t", "Type": "mysql2MeiliSearch", "Source": "a", "Target": "b", "Tables": [{"SourceDatabase": "d", "SourceTable": "t", "PrimaryKey": ["id"], "Columns": [{"Source": "x", "Target": "y", "Default": "1", "EnumMapping": [{"Const": "c", "Index": 1}]}]}]},
            {"Name": "off", "Type": "mysql2kafka", "Source": "a", "Target": "b", "Enabled": False}, {"Name": "odd", "Type": "other", "Source": "a", "Target": "b"}, {"Name": "lost", "Type": "mysql2kafka", "Source": "a", "Target": "zzz"},
        ],
    }
    (tmp_path / "c.json").write_text(json.dumps(data))
    got = load_config(str(tmp_path / "c.json"))
    assert got == config(data) and [t.name for t in got.active_tasks()] == ["t"] and got.tasks[0].kind == "document"
    column = got.tasks[0].tables[0].columns[0]
    assert (column.default, column.enum, got.tasks[0].tables[0].target_of("x"), got.source("a").options["host"]) == ("1", (Label("c", 1),), "y", "h")
