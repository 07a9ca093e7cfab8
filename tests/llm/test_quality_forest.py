"""The isolation forest against trees walked row by row, and thresholds on labels that are set aside."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality


def plain_path(forest, tree, row):
    """Edges from the root until no split is left, and the length that the leaf holds for the rest."""
    node = 0
    for _ in range(forest.depth):
        node = 2 * node + (1 if row[forest.feature[tree, node]] < forest.place[tree, node] else 2)
    return forest.path[tree, node]


def plain_tree(rows, inside, forest, tree, node, level):
    """Holds every split of a tree against the rows that reach it."""
    part = rows[inside]
    if node >= len(forest.place[tree]) or not np.isfinite(forest.place[tree, node]):
        wide = len(part) > 1 and (part.max(axis=0) > part.min(axis=0)).any()
        assert level == forest.depth or not wide
        n = len(part)
        harmonic = 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)
        assert all(plain_path(forest, tree, rows[i]) == pytest.approx(level + harmonic) for i in inside)
        return
    left = [i for i in inside if rows[i][forest.feature[tree, node]] < forest.place[tree, node]]
    right = [i for i in inside if i not in left]
    assert right
    plain_tree(rows, left, forest, tree, 2 * node + 1, level + 1)
    plain_tree(rows, right, forest, tree, 2 * node + 2, level + 1)


@pytest.mark.parametrize("n", [2, 3, 40])
def test_trees(n):
    rows = np.random.default_rng(n).normal(size=(n, 3))
    rows[:, 2] = 1.0  # never split
    forest = quality.IsolationForest.grown(rows, trees=6, sample=64, seed=3)
    assert not (forest.feature[np.isfinite(forest.place)] == 2).any()
    for t in range(6):
        plain_tree(rows, list(range(n)), forest, t, 0, 0)
    asked = np.concatenate([rows, rows + 5])
    want = [2.0 ** (-np.mean([plain_path(forest, t, r) for t in range(6)]) / forest.norm) for r in asked]
    assert np.allclose(forest.anomaly(asked), want)


def test_each_tree_has_rows_of_its_own():
    """With rows enough for all trees none is dealt twice: a pair of rows to each tree splits between the two."""
    rows = 100.0 * np.arange(10)[:, None]
    forest = quality.IsolationForest.grown(rows, trees=5, sample=2, seed=1)
    dealt = np.random.default_rng(1).permutation(10).reshape(5, 2)
    for t, (a, b) in enumerate(dealt):
        assert 100 * min(a, b) < forest.place[t, 0] <= 100 * max(a, b)


@pytest.fixture(scope="module")
def table(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    good = [(i, " ".join(words[(i * 5 + k * k) % 12] + str(k) for k in range(30)), 1) for i in range(200)]
    odd = [(1000 + i, " ".join(f"$$#{words[(i + k) % 12]}%%&&**{k}" for k in range(30)), 0) for i in range(60)]
    return spark.createDataFrame([*good, *odd], "doc_id long, text string, quality int")


def test_held_out_labels_set_nothing(table):
    """Turning every held-out label round changes neither forest nor threshold, only what the model says of itself."""
    spec = quality.QualitySpec()
    stats, labels = quality.statistics(table.drop("quality"), spec), table.select("doc_id", "quality")
    held = F.pmod(F.xxhash64(F.lit(spec.seed + 1), "doc_id"), F.lit(spec.check_part)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fitted(stats, labels, spec), quality.fitted(stats, turned, spec)
    assert a.threshold == b.threshold and a.columns == b.columns and np.array_equal(a.forest.place, b.forest.place)
    good, kept_good, bad, kept_bad = a.checked
    assert good + bad == labels.where(held).count() and kept_good >= 0.9 * good and kept_bad <= 0.1 * bad
    assert (b.checked[0], b.checked[2]) == (bad, good)


def test_equal_in_any_partitioning_and_with_repeats(spark, table):
    """Anomaly and verdict of a row don't depend on how rows are dealt; repeated rows, null ids and names that clash pass."""
    labels = table.select("doc_id", "quality")
    odd = spark.createDataFrame([(None, "a b"), (None, None), (3, None), (3, "x " * 20), (3, "x " * 20)], "doc_id long, text string")
    docs = table.drop("quality").unionByName(odd).withColumns({"place": F.lit("x"), "held": F.lit(1), "s": F.lit(2), "n_words": F.lit("clash")})
    rows = lambda d: sorted(map(str, quality.judged(d, labels).collect()))
    first = rows(docs)
    assert first == rows(docs.repartition(7)) and len(first) == 265


def test_every_label_counts(spark):
    """Beyond 20,000 labelled ids too: all that are held out are told of, and the threshold is that of all others, in one pass."""
    ids = spark.range(24_000).withColumnRenamed("id", "doc_id")
    odd = F.col("doc_id") % 10 == 0
    table = ids.select("doc_id", (100 + F.col("doc_id") % 7).alias("n_words"), (500 + F.col("doc_id") % 40).alias("word_chars"), F.when(odd, F.col("doc_id") % 50).otherwise(F.col("doc_id") % 3).alias("n_symbols"),
        F.lit(0).cast("long").alias("n_dup_lines"), F.lit(0).cast("long").alias("n_repeat_words"), F.xxhash64("doc_id").alias("text_key"), F.when(odd, 0).otherwise(1).alias("quality"))
    spec = quality.QualitySpec(trees=5)
    model = quality.fitted(table.drop("quality"), table.select("doc_id", "quality"), spec)
    rows = table.withColumn("held", F.pmod(F.xxhash64(F.lit(spec.seed + 1), "doc_id"), F.lit(spec.check_part)) == 0).toPandas()
    held, good, odds = rows["held"].to_numpy(), rows["quality"].to_numpy() > 0, model.anomaly(rows)
    assert model.checked == tuple(int((held & which).sum()) for which in (good, good & (odds <= model.threshold), ~good, ~good & (odds <= model.threshold)))
    used = odds[~held & good]
    lowest = np.quantile(used, spec.keep_good, method="higher")
    gain = lambda p: (~held & ~good & (odds > p)).sum() - (~held & good & (odds > p)).sum()
    places = np.unique(used[used >= lowest])
    assert model.threshold == places[np.argmax([gain(p) for p in places])]
