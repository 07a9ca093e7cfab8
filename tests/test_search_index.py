"""Ranked search over an index against a full scan, and what a search reads."""

from __future__ import annotations

import math
import random
import re

import pytest

from tidemark.operators.search_index import IndexSpec, build_index, ranked


def plain(docs, must, should, barred, k, spec):
    split = {i: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w] for i, t in docs}
    n, average = len(docs), sum(map(len, split.values())) / len(docs)
    out = []
    for i, w in split.items():
        wanted = [t for t in dict.fromkeys((*must, *should)) if t in w]
        if all(t in w for t in must) and wanted and not any(t in w for t in barred):
            score = 0
            for t in wanted:
                df, tf = sum(t in x for x in split.values()), w.count(t)
                score += round(math.log(1 + (n - df + 0.5) / (df + 0.5)) * (tf * (spec.k1 + 1) / (tf + spec.k1 * (1 - spec.b + spec.b * len(w) / average))) * 1e9)
            out.append((-score, i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    r = random.Random(3)
    words = [f"w{int(r.expovariate(0.08))}" for _ in range(4000)]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 40)))) for i in range(700)] + [(701, None), (702, ""), (703, "W1, w1; Ünï W2"), (704, "w1 w1 ünï w2")]
    path = str(tmp_path_factory.mktemp("index"))
    spec = IndexSpec(partitions=8, block=20)
    return docs, build_index(spark.createDataFrame(docs, "id long, t string"), "id", "t", path, spec)


@pytest.mark.parametrize("must,should,barred,k", [(("w1",), ("w2",), (), 5), ((), ("w30", "w2", "w1"), ("w0",), 12), (("w3", "w4"), (), (), 3), (("w1",), (), ("w2", "w3"), 700), (("ünï",), (), (), 9), (("nowhere",), ("w1",), (), 5), ((), ("nowhere",), (), 5)])
def test_ranks(spark, indexed, must, should, barred, k):
    docs, index = indexed
    got = [(r.key, r.score) for r in ranked(spark, index, must, should, barred, k).collect()]
    want = plain(docs, must, should, barred, k, index.spec)
    assert [i for i, _ in got] == [i for i, _ in want] and all(abs(a - b) <= 4 for (_, a), (_, b) in zip(got, want, strict=True))


def test_empty_searches(spark, indexed):
    _, index = indexed
    for given in ({}, {"must": ("w1",), "must_not": ("w1",)}, {"should": ("w1",), "k": 0}):
        assert ranked(spark, index, **given).collect() == []


def test_a_search_reads_the_partitions_of_its_terms(spark, indexed):
    _, index = indexed
    plan = ranked(spark, index, should=("w1",))._jdf.queryExecution().executedPlan().toString()
    import re as patterns

    scans = patterns.findall(r"PartitionFilters: \[([^\]]*)\], PushedFilters: \[([^\]]*)\]", plan)
    assert scans and all("part#" in parts and "EqualTo(term,w1)" in pushed for parts, pushed in scans if parts or "term" in pushed)


def test_an_index_of_nothing(spark, tmp_path):
    index = build_index(spark.createDataFrame([], "id long, t string"), "id", "t", str(tmp_path / "x"))
    assert index.n_docs == 0 and ranked(spark, index, should=("a",)).collect() == []


def test_postings_are_shuffled_once_as_whole_lists(spark, tmp_path):
    """No (term, document) row is shuffled, nor a table of counts written; a block holds its term's documents in one row."""
    docs = spark.range(0, 600, 1, 3).selectExpr("id", "concat('common ', repeat(concat('w', id % 7, ' '), 3), id) as t")
    index = build_index(docs, "id", "t", str(tmp_path / "x"), IndexSpec(partitions=4, block=50))
    rows = spark.read.parquet(f"{tmp_path}/x/postings")
    common = rows.where("term = 'common'").collect()
    assert len(common) == 12 and all(r.n == len(r.postings) == 50 for r in common) and len({p.doc for r in common for p in r.postings}) == 600
    assert rows.groupBy("term", "block").count().where("count > 1").count() == 0
    assert not (tmp_path / "x" / "counts").exists()
    twice = build_index(docs.unionAll(docs).withColumn("id", docs["id"].cast("string")), "id", "t", str(tmp_path / "y"))
    assert [r.key for r in ranked(spark, twice, must=("599",), k=5).collect()] == ["599", "599"]
