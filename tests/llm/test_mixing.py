"""Targets, duals and copies against a plain dense solver, through the query op1_mix_sources and the operator."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import op1_mix_sources

LONG = "the quick brown fox jumps over the lazy dog. " * 3000


def plain_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0):
    """Of sizes in order; what is above a cap is shared again."""
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        unit = rest / sum(weights[i % 3] for i in free)
        above = {i for i in free if weights[i % 3] * unit > cap * sizes[i]}
        for i in above or free:
            out[i] = cap * sizes[i] if above else weights[i % 3] * unit
        rest -= sum(out[i] for i in above)
        free = free - above if above else set()
    return out


def plain_rates(sizes, target, cap=2.0):
    """min(cap, exp(t * size)) of one source's documents, with t by bisection."""
    if sum(sizes) * cap <= target * (1 + 1e-12):
        return [1.0 if s == 0 else cap for s in sizes]
    low, high = -5.0, 5.0
    for _ in range(200):
        t = (low + high) / 2
        if sum(s * min(cap, math.exp(min(40, t * s))) for s in sizes) > target:
            high = t
        else:
            low = t
    return [min(cap, math.exp(min(40, t * s))) for s in sizes]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    out = [(0, None, "s1", 9), (1, "", "s1", 9), (2, " \t\n", None, 9), (None, "no id", "s2", 9), (None, None, None, 9), (3, "tie tie", "s0", 9), (3, "tie tie", "s0", 9), (4, "tie tie", "s0", 9), (5, LONG, "big", 9), (6, "only one", "ä", 9)]
    # One source holds a third of all rows; the long text is most of its own.
    for k in range(900):
        out.append((100 + k, "w " * r.randrange(1, 90), "hot" if k % 3 == 0 else f"s{r.randrange(4)}", 9))
    out += [(2000 + k, "word " * 40, "big", 9) for k in range(60)]
    return out


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mix"))
    # ``size`` and ``copies`` clash with results.
    spark.createDataFrame(rows, "doc_id long, text string, source string, size int").withColumn("copies", F.lit("x")).write.parquet(f"{path}/documents.parquet")
    return path


def test_query_against_plain_solver(spark, rows, folder):
    got = op1_mix_sources(spark, folder).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s, _ in rows}, key=lambda s: (s is None, s))
    sizes = {s: [words(t) for _, t, own, _ in rows if own == s] for s in names}
    targets = dict(zip(names, plain_targets([sum(sizes[s]) for s in names]), strict=True))
    ids = {i: s for i, _, s, _ in rows if i is not None}
    for s in names:
        own = [r for r in got if r.doc_id is not None and ids[r.doc_id] == s or r.doc_id is None and {None: None, 2: "s2"}[r["size"] or None] == s]
        assert sorted(r["size"] for r in own) == sorted(sizes[s]) and all(r.source_size == sum(sizes[s]) and abs(r.target - targets[s]) <= 1e-9 * targets[s] for r in own)
        rates = dict(zip(sizes[s], plain_rates(sizes[s], targets[s]), strict=True))
        assert all(abs(r.rate - rates[r["size"]]) < 1e-5 for r in own if r["size"])
        taken = sum(r.taken for r in own)
        if s == "big":  # one text has 27,000 of 29,400 words: once, and all others twice, is as near as copies get
            assert taken == 27_000 + 2 * 2_400
        else:
            assert abs(taken - targets[s]) <= max(40, 0.002 * targets[s])
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) and r.taken == r["size"] * r.copies <= 2 * r["size"] for r in got)
    assert len({r.copies for r in got if r.doc_id == 3}) == 1


def test_reruns_and_partitions_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = sorted(map(str, mixing.mix_sizes(docs).collect()))
    assert plain == sorted(map(str, mixing.mix_sizes(docs.repartition(7, "size")).collect()))
    # Sources beyond the bound are joined instead of sent.
    assert plain == sorted(map(str, mixing.mix_sizes(docs, mixing.MixRecipe(broadcast_sources=0)).collect()))


def test_mix_itself(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == mixing.mix_sizes(docs).agg(F.sum("copies")).first()[0]
    assert mixing.mixed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [[], [0], [5], [1, 0, 1000], [7, 7, 7, 7], [1000, 1, 1, 1, 900, 3], [10, 20, 30, 40, 50, 60, 70]])
def test_targets(spark, sizes):
    histogram = spark.createDataFrame([(f"s{i:02}", s, 1) for i, s in enumerate(sizes)], "source string, size long, n long")
    got = {r.source: r.target for r in mixing.source_targets(histogram).collect()}
    assert [got[f"s{i:02}"] for i in range(len(sizes))] == pytest.approx(plain_targets(sizes))
