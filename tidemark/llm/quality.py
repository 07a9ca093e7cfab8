"""Quality rules: text statistics by rule, and an isolation forest over them.

Statistics of every whole text (null: none): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Two base
rules reject a text at once: fewer than ``min_words`` words, or more than ``repeat_percent`` percent of the words in
five-word windows that occur twice or more. For the rest, an isolation forest looks at ratios of the statistics:
each tree splits a small random sample at random places, and rows that a few splits isolate are odd. The anomaly is
``2 ** (-mean path length / expected path length)``. The threshold is calibrated on labelled rows: of all thresholds
that keep at least ``keep_good`` of the good rows, the one that rejects most bad ones beyond the good ones it loses;
rows are kept up to it. A forest is grown for every subset of the ratios, as some vary among good rows alone, and the
one that calibrates best is used (the largest subset of equal ones). Labels whose id's hash leaves 0 by
``check_part`` are not calibrated on; the model holds how many of them it gets right. Without labels of both kinds only
the base rules reject.

The threshold is set on every labelled id that is not held out: anomalies are whole ten-thousandths, so that counts by
anomaly, found by one aggregation for all forests, are few however many labels there are. The trees' rows are the
``trees * sample`` rows with the least seeded hashes of the whole table, in any order dealt to the trees; growing each tree
from a small random sample of its own is what the method is.
Duplicate lines are lines with a word, equal to an earlier one of the text.
Equal rows get equal results; rows with null doc_id are scored like others; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped, stored, text_bytes

SYMBOLS = b"#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualitySpec:
    min_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    trees: int = 100
    sample: int = 256
    #: One label in so many is held out.
    check_part: int = 5
    keep_good: float = 0.99
    seed: int = 7


#: Anomalies are told in so many steps from 0 to 1.
STEPS = 10_000

_continuation = re.compile(rb"[\x80-\xBF]+")


def text_statistics(text: bytes, window: int = 5) -> tuple[int, int, int, int, int]:
    """The statistics of one text in UTF-8."""
    words = text.split()  # of bytes: ASCII white space
    n = len(words)
    size = sum(map(len, words))
    if not text.isascii():
        size -= sum(map(len, _continuation.findall(text)))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = text.split(b"\n")
    repeated_lines = 0
    if len(set(lines)) < len(lines):
        repeated_lines = sum(k - 1 for line, k in Counter(lines).items() if k > 1 and line.strip())
    repeats = 0
    if n > window:
        windows = list(zip(*(words[k:] for k in range(window)), strict=False))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            often = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(n + 1, np.int64)
            covered[:-window][often] += 1
            covered[window:][often] -= 1
            repeats = int((np.cumsum(covered[:-1]) > 0).sum())
    return n, size, symbols, repeated_lines, repeats


def _features(table: pd.DataFrame) -> np.ndarray:
    """What the trees look at. Length itself is no sign of quality; short texts are drawn towards usual ratios."""
    n, chars, symbols, lines, repeats = (table[c].to_numpy(float) for c in STATISTICS)
    words = n + 20
    return np.stack([(chars + 100) / words, np.log1p(symbols), lines / words, repeats / words], axis=1)


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


@dataclass
class IsolationForest:
    """Complete trees as arrays: feature and place of each split; at leaves the path length."""

    feature: np.ndarray
    place: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    @staticmethod
    def grown(rows: np.ndarray, trees: int, sample: int, seed: int) -> IsolationForest:
        """Each tree from ``sample`` rows of its own, dealt without repeats; fewer rows are shared by all trees."""
        random = np.random.default_rng(seed)
        depth = max(1, math.ceil(math.log2(max(2, min(sample, len(rows))))))
        size = (1 << depth + 1) - 1
        feature, place, path = np.zeros((trees, size), np.int64), np.full((trees, size), np.inf), np.zeros((trees, size))
        dealt = random.permutation(len(rows)) if len(rows) >= trees * sample else None
        for t in range(trees):
            chosen = random.choice(len(rows), min(sample, len(rows)), replace=False) if dealt is None else dealt[t * sample : (t + 1) * sample]
            own = rows[chosen]
            todo = [(0, np.arange(len(own)), 0)]
            while todo:
                node, inside, level = todo.pop()
                part = own[inside]
                low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
                wide = np.flatnonzero(high > low)
                if level == depth or len(inside) < 2 or not len(wide):
                    # A leaf: all rows below it take the left child, which bears the same length.
                    length = level + _expected(len(inside))
                    while node < size:
                        path[t, node] = length
                        node = 2 * node + 1
                    continue
                f = int(random.choice(wide))
                at = random.uniform(low[f], high[f])
                feature[t, node], place[t, node] = f, at
                left = part[:, f] < at
                todo += [(2 * node + 1, inside[left], level + 1), (2 * node + 2, inside[~left], level + 1)]
        return IsolationForest(feature, place, path, depth, _expected(min(sample, len(rows))) or 1.0)

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[every, self.feature[t, node]] >= self.place[t, node])
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def _steps(forest: IsolationForest, rows: np.ndarray) -> np.ndarray:
    """Anomalies as whole numbers of steps."""
    return np.rint(forest.anomaly(rows) * STEPS)


@dataclass
class QualityModel:
    forest: IsolationForest | None
    threshold: float
    spec: QualitySpec
    #: Columns of the features that the trees use.
    columns: tuple[int, ...] = (0, 1, 2, 3)
    #: Held-out labels: good rows, good rows kept, bad rows, bad rows kept.
    checked: tuple[int, int, int, int] = (0, 0, 0, 0)

    def anomaly(self, table: pd.DataFrame) -> np.ndarray:
        return _steps(self.forest, _features(table)[:, self.columns]) / STEPS if self.forest else np.zeros(len(table))


def statistics(docs: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text) and the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_statistics(t, spec.window) for t in text_bytes(batch)], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *(pa.array(found[:, k]) for k in range(5))], names=["doc_id", "text_key", *STATISTICS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_key"), docs["text"])
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, " + ", ".join(f"{c} long" for c in STATISTICS))


def base_failed(spec: QualitySpec = QualitySpec()) -> Column:
    return (F.col("n_words") < spec.min_words) | (100 * F.col("n_repeat_words") > spec.repeat_percent * F.col("n_words"))


def _marks(rows: DataFrame, forests: list[tuple[tuple[int, ...], IsolationForest]]) -> pd.DataFrame:
    """forest, place (its anomaly in steps), quality, held, n: how many of the labelled ``rows``; a few rows for each place."""
    shared = rows.sparkSession.sparkContext.broadcast(forests)  # trees of bounded size

    @F.pandas_udf("array<int>")
    def places(*columns: pd.Series) -> pd.Series:
        shapes = _features(pd.DataFrame(dict(zip(STATISTICS, columns, strict=True))))
        return pd.Series(list(np.stack([_steps(forest, shapes[:, own]) for own, forest in shared.value], axis=1).astype(np.int32)))

    marked = rows.select((F.col("quality") > 0).alias("good"), "held", F.posexplode(places(*STATISTICS)).alias("forest", "place"))
    return marked.groupBy("forest", "place", "good", "held").agg(F.count("*").alias("n")).toPandas()  # forests times STEPS times four at most


def _calibrated(own: pd.DataFrame, keep_good: float) -> tuple[int, int]:
    """The bad rows that the best threshold of a forest rejects beyond the good ones it loses, and that threshold in steps."""
    good, bad = (np.bincount(own["place"][own["good"] == k], own["n"][own["good"] == k], STEPS + 1).astype(np.int64) for k in (True, False))
    # The least place up to which keep_good of the good rows lie, then all above it that good rows have.
    lowest = int(np.searchsorted(np.cumsum(good), math.ceil(keep_good * (good.sum() - 1)), "right"))
    above = lambda counts: counts.sum() - np.cumsum(counts)
    places = lowest + np.flatnonzero(good[lowest:])
    gains = (above(bad) - above(good))[places]
    return int(gains.max()), int(places[int(np.argmax(gains))])


def fitted(stats: DataFrame, labels: DataFrame, spec: QualitySpec = QualitySpec()) -> QualityModel:
    """Forest and threshold from statistics of all rows and labels (doc_id, quality 1: good, 0: bad)."""
    columns = list(STATISTICS)
    passed = stats.where(~base_failed(spec))
    hashed = F.xxhash64(F.lit(spec.seed), "doc_id", "text_key")
    sample = passed.select(hashed.alias("place"), *columns).orderBy("place", *columns).limit(spec.trees * spec.sample).select(columns).toPandas()
    if len(sample) < 2:
        return QualityModel(None, math.inf, spec)
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # One text of each labelled id, however often the id repeats.
    held = (F.pmod(F.xxhash64(F.lit(spec.seed + 1), "doc_id"), F.lit(spec.check_part)) == 0).alias("held")
    rows = passed.join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min_by(F.struct(*columns), "text_key").alias("s")).select("s.*", "quality", held)
    shapes = _features(sample)
    width = shapes.shape[1]
    subsets = [c for k in range(width, 0, -1) for c in combinations(range(width), k)]
    forests = [(c, IsolationForest.grown(shapes[:, c], spec.trees, spec.sample, spec.seed)) for c in subsets]
    marks = _marks(rows, forests)
    seen = marks[~marks["held"]]
    if not seen["good"].any() or seen["good"].all():
        return QualityModel(forests[0][1], math.inf, spec)
    found = [_calibrated(seen[seen["forest"] == k], spec.keep_good) for k in range(len(forests))]
    best = max(range(len(forests)), key=lambda k: found[k][0])  # the first of equal ones
    place = found[best][1]
    aside = marks[marks["held"] & (marks["forest"] == best)]
    count = lambda which: int(aside["n"][which].sum())
    fine, kept = aside["good"], aside["place"] <= place
    return QualityModel(forests[best][1], place / STEPS, spec, subsets[best], (count(fine), count(fine & kept), count(~fine), count(~fine & kept)))


def judged(docs: DataFrame, labels: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """doc_id, text_key, the statistics, base_failed, anomaly (0 to 1), kept of every row."""
    shipped(docs.sparkSession)
    stats = stored(statistics(docs, spec), "quality-statistics")
    model = fitted(stats, labels, spec)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # trees of bounded size

    @F.pandas_udf("double")
    def anomaly(*columns: pd.Series) -> pd.Series:
        return pd.Series(shared.value.anomaly(pd.DataFrame(dict(zip(STATISTICS, columns, strict=True)))))

    scored = stats.withColumn("base_failed", base_failed(spec)).withColumn("anomaly", anomaly(*STATISTICS))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= F.lit(model.threshold)))
