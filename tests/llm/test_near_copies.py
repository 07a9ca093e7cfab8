"""The stage near_dedup against a brute-force comparison of all pairs."""

from __future__ import annotations

import random
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, neardup, simhash


def plain_groups(texts):
    """Of each text the least index in its group: five-word shingles, Jaccard of 0.8 or more."""
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def planted():
    r = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    notice = " ".join(r.choices(words, k=12))
    texts = [None, "", " \n", "one two", "One  TWO", "one two three four five six", "a b c d e f g h i j k l m n", "a b c d e f g h i j k l m x"]
    for _ in range(40):
        base = [*r.choices(words, k=r.randrange(20, 160)), *notice.split()]
        texts.append(" ".join(base))
        for _ in range(r.randrange(4)):
            copy = list(base)
            for _ in range(r.randrange(1, 5)):
                copy[r.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy))
    # A shingle each is shared by ever more texts, and texts of 13 shingles with 12 in common are 12/14 alike.
    texts += [f"{notice} {' '.join(r.choices(words, k=5))}" for _ in range(30)]
    return texts


def test_stage_finds_planted_near_copies(spark):
    texts = planted()
    groups = plain_groups(texts)
    assert len(set(groups)) < len(texts) - 30
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(groups))


@pytest.mark.parametrize("spec", [neardup.NearSpec(order_texts=1, rounds=0), neardup.NearSpec(order_shingles=7, pairs_per_member=0, rounds=2)])
def test_groups_do_not_depend_on_order_or_rounds(spark, spec):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.without_near_copies(docs, spec).collect()) == sorted(set(plain_groups(texts)))


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "A b c"), (None, "other words"), (None, None), (2, "")], "doc_id long, text string")
    assert sorted(map(str, neardup.without_near_copies(docs).collect())) == sorted(map(str, docs.where(F.expr("text = 'other words' or doc_id = 2")).collect() + docs.where("doc_id = 1").limit(1).collect()))
    assert neardup.without_near_copies(docs.limit(0)).count() == 0


def test_columns_of_any_name(spark):
    """Columns that are named as the operator's own are in no one's way."""
    from tidemark.llm.neardup import without_near_copies

    names = ["_id", "_key", "_row_key", "needed_id", "needed_row", "row_key", "key", "token", "row", "g", "once"]
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words, "more"]), "other words of another text entirely here", None]
    docs = spark.createDataFrame([(i, t, *("x" for _ in names)) for i, t in enumerate(texts)], ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_a_pair_meets_once_for_each_run_of_shared_tokens(spark):
    """Texts that share runs of first shingles are joined where a run begins, not at each of its tokens; no pair is lost."""
    spec = neardup.NearSpec()
    text = lambda i: " ".join(f"w{k}" if k % 60 or k == 0 else f"own{i}x{k}" for k in range(240))
    docs = spark.createDataFrame([(i, text(i)) for i in range(12)], "doc_id long, text string")
    rows = neardup.near_rows(docs, spec)
    sets = neardup._sets(rows)
    named = neardup._buckets(rows, sets).withColumn("root", F.col("key"))
    blind = named.withColumn("before", F.lit(None).cast("long"))
    joined, every = (neardup._all_pairs(d, spec) for d in (named, blind))
    pairs = lambda d: {(r.a, r.b) for r in neardup._pairs(d, spec).collect()}
    assert pairs(joined) == pairs(every) and len(pairs(joined)) == 66
    assert joined.count() * 3 < every.count()


@pytest.mark.parametrize("broadcast_links", [0, 250_000])
def test_components_take_few_tasks_and_leave_only_their_result(spark, monkeypatch, broadcast_links):
    r = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(50, 90), (50, 90), (60, 90), (60, 95), (7, 7)] + [tuple(sorted(r.sample(range(100, 160), 2))) for _ in range(45)]
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    names, partitions = [], 20
    keep = simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name: names.append(out := keep(df, name)) or out)
    frame = spark.createDataFrame(links, "a long, b long").repartition(1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup(f"components-{broadcast_links}", "")
    try:
        roots = simhash.components(frame, broadcast_links=broadcast_links)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((x.node, x.root) for x in roots.collect()) == sorted((n, m) for n, m in root.items() if n != 7 or m != 7)
    there = [df for df in names if all(Path(f.removeprefix("file://")).exists() for f in df.inputFiles())]
    assert len(names) > 3 and len(there) == 1
    if broadcast_links:
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(f"components-{broadcast_links}") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(x.numCompletedTasks for s in stages if (x := tracker.getStageInfo(s)))
        rounds = len(names) // 2
        assert tasks <= 5 * partitions * rounds


def loose_group(n):
    """Texts of which each is like about a sixth of the others: five edits among the first 150 of 400 words."""
    r = random.Random(3)
    texts = []
    for i in range(n):
        words = [f"w{k}" for k in range(400)]
        for k in r.sample(range(150), 5):
            words[k] = f"own{i}x{k}"
        texts.append(" ".join(words))
    return texts


def test_work_on_a_large_group_grows_with_its_members(spark, monkeypatch):
    """Four times the members take about four times the pairs to compare and the links, not sixteen times, and lose none."""
    taken = {}
    keep = neardup.components
    for n in (150, 600):
        counts = {"pairs": 0, "links": 0}

        def counted(links, *more, counts=counts):
            counts["links"] += links.count()
            return keep(links, *more)

        def stored(df, name, counts=counts):
            out = common.stored(df, name)
            counts["pairs"] += out.count() if name == "near-pairs" else 0
            return out

        for module in (neardup, simhash):
            monkeypatch.setattr(module, "components", counted)
        monkeypatch.setattr(neardup, "stored", stored)
        texts = loose_group(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert sorted(r.doc_id for r in neardup.without_near_copies(docs).collect()) == sorted(set(plain_groups(texts)))
        taken[n] = counts
    assert taken[600]["pairs"] < 8 * taken[150]["pairs"] and taken[600]["links"] < 8 * taken[150]["links"], taken


def test_links_are_added_between_groups(spark):
    """Links among nodes of known groups count once for each two groups; the result is that of all links together."""
    r = random.Random(8)
    links = [tuple(sorted(r.sample(range(120), 2))) for _ in range(50)]
    more = [tuple(sorted(r.sample(range(160), 2))) for _ in range(60)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    known = simhash.components(frame(links))
    every = sorted(map(tuple, simhash.components(frame(links + more)).collect()))
    for bound in (0, 250_000):
        assert sorted(map(tuple, simhash.regrouped(known, frame(more), bound).collect())) == every
    assert sorted(map(tuple, simhash.regrouped(known, frame(links)).collect())) == sorted(map(tuple, known.collect()))
    nothing = spark.createDataFrame([], "node long, root long")
    assert sorted(map(tuple, simhash.regrouped(nothing, frame(links + more)).collect())) == every
    assert simhash.regrouped(nothing, frame([])).count() == 0
