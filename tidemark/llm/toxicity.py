"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

Two strings are alike by the letter triples, in order but with gaps, that they share; each gap weakens a triple by
``decay``. Inserted characters and gaps inside an insult therefore leave most of its triples in place. The kernel is
normalised. A linear SVM (squared hinge) is trained on the kernel's Nyström features, the similarities to landmark
words times the inverse root of the landmarks' kernel matrix; as the kernel is a product of explicit triple vectors,
the trained machine is one weight per triple, and a word's score a sum over its triples over its norm. That is the
same function, without a comparison to each landmark.

Training takes a bounded sample of labelled rows: up to ``max_docs_per_class`` whole texts of each class, the first
ones by a hash. Sentences of toxic rows hold the insults among many harmless words, so the words that
stand out are found first: words, and beginnings of words, that are more frequent in toxic texts than chance allows
(a likelihood ratio, corrected for the number of tries). They are where the machine begins. Then it learns from the
labelled texts themselves, as bags of units of which at least one is an insult where the label is 1 and none where it is
0: in each of three rounds every toxic text gives the unit that scores highest as an example, unless a harmless text
has it, and the harmless units that score highest become examples of the other kind. Landmarks are drawn from all examples. The document's score comes from its
evidence, the values of its three highest-scoring units, how many different units score above 0 and how many units
there are, by a logistic curve fitted on the sampled texts: one doubtful word in a long text is no insult.

A unit is a word, lower-cased; runs of three or more single letters ("i d i o t") form one more unit. Words longer
than ``span`` characters are scored in overlapping windows. Whole texts are scored. Null and empty texts get the score
of a text without any unit that stands out. Without labelled rows of both classes every score is the share of toxic
rows (0 without labels). Null doc_ids count as id '' for the holdout. Repeated labels of an id count as toxic if one is.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text_crc, released, shipped, slices, stored, trimmed

CLASSES = 64


@dataclass(frozen=True)
class ToxicSpec:
    max_docs_per_class: int = 3000
    decay: float = 0.6
    reach: int = 5
    span: int = 24
    landmarks: int = 192
    examples: int = 6000
    cost: float = 10.0
    memo: int = 100_000
    batch_chars: int = 250_000


def _letter_class(c: str) -> int:
    """0: no letter, hence only a gap; 1 to 26: a to z; 63 is the word's edge; other letters share the rest."""
    if not c.isalnum():
        return 0
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 36


def windows(word: str, spec: ToxicSpec) -> list[str]:
    """A word, or if it is longer than ``span`` the overlapping windows of it that cover all its characters."""
    if len(word) <= spec.span:
        return [word]
    half = spec.span // 2
    return [word[s : s + spec.span] for s in range(0, max(1, len(word) - half), half)]


def _triples(words: list[str], spec: ToxicSpec) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the triples of each word (at most ``span`` characters) and their weights, 0 where there is none."""
    width = spec.span + 2
    table = np.zeros((len(words), width), np.int64)
    memo: dict[str, int] = {}
    for i, w in enumerate(words):
        for k, c in enumerate(w, 1):
            v = memo.get(c)
            if v is None:
                v = memo[c] = _letter_class(c)
            table[i, k] = v
        table[i, 0] = table[i, len(w) + 1] = CLASSES - 1
    wide = max(map(len, words), default=0) + 2
    table = table[:, :wide]
    codes, weights = [], []
    for b in range(1, spec.reach):
        for c in range(b + 1, spec.reach + 1):
            if c < wide:
                x, y, z = table[:, : wide - c], table[:, b : wide - c + b], table[:, c:]
                codes.append((x * CLASSES + y) * CLASSES + z)
                weights.append(np.where((x > 0) & (y > 0) & (z > 0), spec.decay ** (c - 2), 0.0))
    if not codes:
        return np.zeros((len(words), 1), np.int64), np.zeros((len(words), 1))
    return np.concatenate(codes, axis=1), np.concatenate(weights, axis=1)


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length of each word's triple vector; equal triples add up."""
    order = np.argsort(codes, axis=1, kind="stable")
    c, w = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    last = np.ones(c.shape, bool)
    last[:, :-1] = c[:, 1:] != c[:, :-1]
    total = np.cumsum(w, axis=1)
    ends = np.where(last, total, 0)
    before = np.maximum.accumulate(np.concatenate((np.zeros((len(c), 1)), ends[:, :-1]), axis=1), axis=1)
    return np.sqrt(np.where(last, (total - before) ** 2, 0).sum(axis=1))


@dataclass
class ToxicModel:
    weights: np.ndarray | None
    bias: float
    #: Of the logistic curve: a weight for each column of the evidence, and what is added.
    curve: tuple[float, ...]
    shift: float
    base_rate: float
    spec: ToxicSpec
    most: np.ndarray | None = None

    def score_words(self, words: list[str]) -> np.ndarray:
        """The machine's value for each word; long words by their highest window."""
        spec = self.spec
        if self.weights is None:
            return np.full(len(words), self.bias)
        out = np.full(len(words), -np.inf)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for a in range(0, len(order), 4096):
            part = order[a : a + 4096]
            pieces, owner = [], []
            for i in part:
                found = windows(words[i], spec)
                pieces += found
                owner += [i] * len(found)
            for b in range(0, len(pieces), 2048):
                codes, weights = _triples(pieces[b : b + 2048], spec)
                norm = _norms(codes, weights)
                value = (self.weights[codes] * weights).sum(axis=1) / np.where(norm > 0, norm, 1.0) + self.bias
                np.maximum.at(out, np.array(owner[b : b + 2048]), value)
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        """The curve's value; beyond the largest evidence it was fitted on it stays level."""
        held = evidence if self.most is None else np.minimum(evidence, self.most)
        return 1 / (1 + np.exp(-np.clip(held @ np.array(self.curve) + self.shift, -40, 40)))


def units_of(text: str) -> list[str]:
    """Lower-cased words, a full stop or comma after a word put aside, and joined runs of single letters."""
    words = text.lower().replace(". ", " ").replace(", ", " ").replace(".\n", " ").replace(",\n", " ").split()
    singles = [i for i, w in enumerate(words) if len(w) == 1]
    if len(singles) > 2:
        run: list[int] = []
        for i in [*singles, -1]:
            if run and i == run[-1] + 1:
                run.append(i)
                continue
            if len(run) > 2:
                words.append("".join(words[k] for k in run))
            run = [i]
    return words


#: Highest, second and third highest value of different units, logarithms of different units above 0 and of all units.
EVIDENCE = 5


class _Scorer:
    """The evidence of each text, with a bounded memo of words."""

    def __init__(self, model: ToxicModel) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.values = np.zeros(0)

    def evidence(self, texts: list[str]) -> np.ndarray:
        """One row of EVIDENCE numbers for each text; values are held between -1 and 3, and missing units have -1."""
        if len(self.numbers) > self.model.spec.memo:
            self.clear()
        units, stops = [], []
        for t in texts:
            units += units_of(t)
            stops.append(len(units))
        known = len(self.numbers)
        place = self.numbers.setdefault
        numbers = np.fromiter((place(u, len(self.numbers)) for u in units), np.int64, len(units))
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:]
            self.values = np.concatenate((self.values, np.clip(self.model.score_words(fresh), -1, 3)))
        out = np.full((len(texts), EVIDENCE), -1.0)
        warm = np.flatnonzero(self.values[numbers] > -1)
        # Each unit of a text once.
        pairs = np.unique(np.searchsorted(np.array(stops), warm, "right") * (len(self.numbers) + 1) + numbers[warm])
        owners, values = pairs // (len(self.numbers) + 1), self.values[pairs % (len(self.numbers) + 1)]
        order = np.lexsort((-values, owners))
        owners, values = owners[order], values[order]
        first = np.searchsorted(owners, np.arange(len(texts)))
        rank = np.arange(len(owners)) - first[owners]
        for k in range(3):
            out[owners[rank == k], k] = values[rank == k]
        out[:, 3] = np.log1p(np.bincount(owners[values > 0], minlength=len(texts)))
        out[:, 4] = np.log1p(np.diff(stops, prepend=0))
        return out


def held_out(doc_id: Column) -> Column:
    return F.pmod(id_text_crc(doc_id), F.lit(5)) == 0


def _unit_counts(rows: DataFrame, spec: ToxicSpec) -> DataFrame:
    """unit, toxic_docs, clean_docs: in how many of the texts each unit and each beginning of a unit ("abcde*") is.

    Of long units the windows count, all of them.
    """

    def merged(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        for toxic, found in ((1, counts[0]), (0, counts[1])):
            n = pa.array(list(found.values()), pa.int64())
            zero = pa.array(np.zeros(len(found), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), n if toxic else zero, zero if toxic else n], names=["unit", "toxic_docs", "clean_docs"])
            found.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = {w for u in units_of(text or "") if len(u) > 2 for w in windows(u, spec)}
                counts[1 - toxic].update(own | {u[:n] + "*" for u in own for n in (5, 6, 7) if len(u) > n})
                if len(counts[0]) + len(counts[1]) > spec.memo:
                    yield from merged(counts)
        yield from merged(counts)

    return rows.select("text", "toxic").mapInArrow(trimmed(run), "unit string, toxic_docs long, clean_docs long").groupBy("unit").agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("clean_docs").alias("clean_docs"))


def _machine(features: np.ndarray, signs: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Primal Newton steps for the squared hinge."""
    x = np.concatenate((features, np.ones((len(features), 1))), axis=1)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = signs * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + 2 * (xa * cost[active, None]).T @ xa, 2 * xa.T @ (cost[active] * signs[active]))
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], float(w[-1])


def _constant(base: float, spec: ToxicSpec) -> ToxicModel:
    """A model that gives every text the share of toxic rows."""
    return ToxicModel(None, -1.0, (0.0,) * EVIDENCE, math.log((base + 1e-3) / (1 - base + 1e-3)), base, spec)


def train(docs: DataFrame, labels: DataFrame, spec: ToxicSpec = ToxicSpec()) -> ToxicModel:
    """Learns from rows of ``labels`` (doc_id, toxic) that belong to ``docs``; the caller leaves out what is held out.

    Of an id that repeats in ``docs`` the text with the least hash counts, so that at most two times
    ``max_docs_per_class`` texts are read.
    """
    shipped(docs.sparkSession)
    clean = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in clean.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return _constant(base, spec)
    first = lambda t: clean.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.max_docs_per_class)
    sample = F.broadcast(first(1).unionByName(first(0)))  # two times max_docs_per_class rows at most
    own = docs.select(docs["doc_id"], docs["text"]).join(sample, "doc_id").where("text is not null")
    # One text of each labelled id, however often the id repeats.
    rows = stored(own.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "toxicity-rows")
    counts = stored(_unit_counts(rows, spec), "toxicity-units")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return _constant(base, spec)
    tries = counts.count()
    share = n[1] / (n[0] + n[1])
    t, c = F.col("toxic_docs").cast("double"), F.col("clean_docs").cast("double")
    rate = t / (t + c)
    ratio = t * F.log(rate / share) + F.when(c > 0, c * F.log(c / (t + c) / (1 - share))).otherwise(0.0)
    signs = counts.where((t > 0) & (rate > (1 + share) / 2)).withColumn("ratio", ratio).where(F.col("ratio") > math.log(tries + 1) + 2)
    strong = signs.orderBy(F.desc("ratio"), "unit").limit(spec.examples).collect()
    stems = {r["unit"][:-1]: r["ratio"] for r in strong if r["unit"].endswith("*")}
    whole = {r["unit"]: r["ratio"] for r in strong if not r["unit"].endswith("*")}
    if not strong:
        return _constant(base, spec)
    # Words of toxic texts that begin like a sign, and the signs themselves.
    by_stem = F.col("unit").isin(list(whole)) | F.substring("unit", 1, 5).isin(list(stems)) | F.substring("unit", 1, 6).isin(list(stems)) | F.substring("unit", 1, 7).isin(list(stems))
    marked = [r["unit"] for r in counts.where((t > 0) & (c == 0) & ~F.col("unit").endswith("*") & by_stem).orderBy(F.desc("toxic_docs"), "unit").limit(spec.examples).collect()]
    harmless = counts.where((c > 0) & ~F.col("unit").endswith("*"))
    usual = [r["unit"] for r in harmless.orderBy(F.desc("clean_docs"), "unit").limit(spec.examples // 4).collect()]
    chance = [r["unit"] for r in harmless.orderBy(F.xxhash64("unit"), "unit").limit(spec.examples).collect()]
    positive = sorted({*marked, *whole})
    negative = sorted({*usual, *chance} - set(positive))
    model = _fit(positive, negative, spec)
    insulting = rows.where("toxic = 1")
    for _ in range(3):
        # A labelled text is toxic if one of its units is: each toxic text gives the unit that the machine holds for the
        # worst, unless harmless texts have it too; all units of harmless texts are examples of the other kind.
        told = insulting.select(_witness(model, rows)(rows["text"]).alias("unit")).where("unit is not null").distinct()
        positive = sorted({*positive, *(r["unit"] for r in told.join(harmless, "unit", "left_anti").collect())})  # one a text at most
        scored = harmless.select("unit", _word_score(model, harmless)(harmless["unit"]).alias("value")).where("value > -1")
        worst = [r["unit"] for r in scored.orderBy(F.desc("value"), "unit").limit(spec.examples // 3).collect()]
        negative = sorted({*negative, *worst} - set(positive))
        model = _fit(positive, negative, spec)
    released()
    return _calibrated(model, rows, base)


def _word_score(model: ToxicModel, frame: DataFrame):
    """A function of a column of words: the machine's values."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(words: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in words:
            yield pa.array(shared.value.score_words(batch.to_pylist()))
        released()

    return score


def _witness(model: ToxicModel, frame: DataFrame):
    """A function of a column of texts: the unit, or the window of one, with the machine's highest value."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def worst(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spec, values = shared.value.spec, {}
        for batch in texts:
            rows, out = [t or "" for t in batch.to_pylist()], []
            for a, b in slices([len(t) for t in rows], spec.batch_chars):
                if len(values) > spec.memo:
                    values.clear()
                found = [{w for u in units_of(t) if len(u) > 2 for w in windows(u, spec)} for t in rows[a:b]]
                fresh = sorted(set().union(*found) - values.keys())
                values.update(zip(fresh, shared.value.score_words(fresh).tolist(), strict=True))
                out += [max(own, key=lambda w: (values[w], w), default=None) for own in found]
            yield pa.array(out, pa.string())
        values.clear()
        released()

    return worst


def _fit(positive: list[str], negative: list[str], spec: ToxicSpec) -> ToxicModel:
    spread = lambda words, k: [words[i] for i in np.linspace(0, len(words) - 1, min(k, len(words))).astype(int)] if words else []
    marks = [*spread(positive, spec.landmarks // 2), *spread(negative, spec.landmarks // 2)]

    def vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, weights = _triples(words, spec)
        norm = _norms(codes, weights)
        return codes, weights / np.where(norm > 0, norm, 1.0)[:, None]

    codes, weights = vectors(marks)
    # Only triples of landmarks count; all others share the last column, which is 0.
    triples, columns = np.unique(codes, return_inverse=True)
    place = np.full(CLASSES**3, len(triples))
    place[triples] = np.arange(len(triples))
    dense = np.zeros((len(marks), len(triples) + 1))
    np.add.at(dense, (np.arange(len(marks))[:, None], columns.reshape(codes.shape)), weights)
    root = np.linalg.eigh(dense @ dense.T)
    inverse = root[1] @ np.diag(1 / np.sqrt(np.maximum(root[0], 1e-6))) @ root[1].T
    words = [*positive, *negative]
    similar = []
    for a in range(0, len(words), 512):
        c, w = vectors(words[a : a + 512])
        c = place[c]
        similar.append(np.stack([(dense[j][c] * w).sum(axis=1) for j in range(len(marks))], axis=1))
    features = np.concatenate(similar) @ inverse
    signs = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    balance = np.where(signs > 0, len(words) / 2 / max(1, len(positive)), len(words) / 2 / max(1, len(negative)))
    w, bias = _machine(features, signs, spec.cost * balance)
    per_triple = np.zeros(CLASSES**3)
    per_triple[triples] = ((inverse @ w) @ dense)[:-1]
    return ToxicModel(per_triple, bias, (1.0, 0.0, 0.0, 0.0, 0.0), 0.0, 0.0, spec)


def _calibrated(model: ToxicModel, rows: DataFrame, base: float) -> ToxicModel:
    """A logistic curve from the evidence of the sampled texts, with the classes' shares among all labels."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def evidence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(shared.value)
        for batch in texts:
            yield pa.array(list(scorer.evidence([t or "" for t in batch.to_pylist()])), pa.list_(pa.float64()))
        scorer.clear()
        released()

    got = rows.select("toxic", evidence("text").alias("v")).toArrow()  # a few numbers for each sampled text
    y, v = np.array(got["toxic"].to_pylist(), float), np.array(got["v"].to_pylist(), float).reshape(-1, EVIDENCE)
    weight = np.where(y > 0, base / max(1, y.sum()), (1 - base) / max(1, (1 - y).sum()))
    x = np.concatenate((v, np.ones((len(v), 1))), axis=1)
    theta = np.zeros(EVIDENCE + 1)
    ridge = 1e-3 * np.diag([1.0] * EVIDENCE + [1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ theta)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    model.most = v.max(axis=0)
    model.curve, model.shift, model.base_rate = tuple(map(float, theta[:-1])), float(theta[-1]), base
    return model


def toxicity_of(model: ToxicModel, docs: DataFrame, text: str = "text") -> Column:
    """A column of scores from 0 to 1 for the texts of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each triple of letter classes

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(shared.value)
        for batch in texts:
            rows = [t or "" for t in batch.to_pylist()]
            parts = [scorer.evidence(rows[a:b]) for a, b in slices([len(t) for t in rows], shared.value.spec.batch_chars)]
            yield pa.array(shared.value.probability(np.concatenate(parts)) if parts else np.zeros(0))
        scorer.clear()
        released()

    return score(docs[text])


def without_toxic(model: ToxicModel, docs: DataFrame, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text scores below the threshold."""
    return docs.where(toxicity_of(model, docs, text) < threshold)
