"""Whitening of embeddings by a tall-skinny QR (TSQR), without a covariance matrix.

Vectors become whole numbers, ``floor(scale * entry)``. The fit list holds each distinct vector once: n vectors x with sums
S for each dimension, both exact. Rows are centred as ``(n * x - S) / n``, whose numerator is a whole number. Every task
takes the R factor of its rows, a block at a time; R factors are merged in a tree, a few to a task, until one is left.
With its singular values s and right vectors w, the covariance (divisor n) has the eigenvalues ``s ** 2 / n`` and the
eigenvectors w. The covariance of the whitened fit list is gathered in one more pass, by means and centred products that are
merged in the same tree. One task holds two factors of d * d numbers at most; the driver gets the last R alone.

Vectors are left out which are null, hold null or non-finite entries, entries whose whole number has more than 52 bits,
or that have another length than most (of equally frequent lengths the greatest counts). Repeated rows give repeated
rows. Components whose eigenvalue is zero to double precision, as where all vectors are equal, have a null ``whitened``;
without any variance ``explained`` is null too. ``identity_error`` is over the components with a value, null without any.
A ``deviation`` beyond 63 bits is null. An empty table, or vectors of no entries, give no rows. Null ids stay null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, stored, trimmed


@dataclass(frozen=True)
class WhitenSpec:
    scale: int = 256
    components: int = 4
    #: Rows that are decomposed at once, and factors that one task merges.
    block: int = 2048
    fan_in: int = 8


@dataclass(frozen=True)
class Whitening:
    """``sums``: of whole vectors; ``vectors``: components as columns; ``values``: their eigenvalues; ``trace``: of all."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers; as Python's own where 63 bits don't hold them."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            along = np.einsum("ij,jk->ik", (self.centred(x) / self.n).astype(float), self.vectors)
            return np.where(self.values > 0, along / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        own = self.centred(x)
        if own.dtype == object or own.shape[1] * int(np.abs(own).max(initial=0)) ** 2 >= 1 << 63:
            return [d if (d := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in own]
        return (own * own).sum(axis=1).tolist()


def whole_vectors(embeddings: DataFrame, spec: WhitenSpec = WhitenSpec()) -> DataFrame:
    """vec_id, x (whole numbers) of the rows that count."""
    shipped(embeddings.sparkSession)
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * spec.scale) < float(1 << 52))
    rows = embeddings.select(embeddings["vec_id"], embeddings["embedding"].cast("array<double>").alias("v")).where(F.col("v").isNotNull() & F.forall("v", usable))
    whole = stored(rows.select("vec_id", F.transform("v", lambda c: F.floor(c * spec.scale).cast("long")).alias("x")), "whiten-vectors")
    usual = whole.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return whole.where(F.size("x") == (usual["d"] if usual else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _tree(parts: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray], fan_in: int) -> np.ndarray:
    """One array of the arrays of many tasks (part, value), merged ``fan_in`` to a task in the order of ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        for batch in batches:
            for g, value in zip(batch.column("g").to_pylist(), batch.column("value"), strict=True):
                own = value.values.to_numpy()
                if g != group and held is not None:
                    yield _part(group, held)
                group, held = g, own if g != group else merge(held, own)
        if held is not None:
            yield _part(group, held)

    while True:
        last = parts.agg(F.max("part")).first()[0]
        if last == 0:
            return np.array(parts.first()["value"])
        grouped = parts.withColumn("g", F.floor(F.col("part") / fan_in).cast("int")).repartition("g").sortWithinPartitions("g", "part").select("g", "value")
        parts = stored(grouped.mapInArrow(trimmed(run), "part int, value array<double>"), "whiten-merged")


def _part(part: int, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([value.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "value"])


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The R factor, as a square; rows of zeros make up for what is missing."""
    d = rows.shape[1]
    return np.linalg.qr(np.vstack([rows, np.zeros((max(0, d - len(rows)), d))]), mode="r")


def _factors(fit: DataFrame, n: int, sums: tuple[int, ...], spec: WhitenSpec) -> DataFrame:
    """part, value: the R factor of each task's centred rows."""
    d, centre = len(sums), Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting = np.zeros((d, d)), np.zeros((0, d))
        for batch in batches:
            waiting = np.vstack([waiting, (centre.centred(_matrix(batch, d)) / n).astype(float)])
            while len(waiting) >= spec.block:
                r, waiting = _triangle(np.vstack([r, waiting[: spec.block]])), waiting[spec.block :]
        yield _part(TaskContext.get().partitionId(), _triangle(np.vstack([r, waiting])))

    return stored(fit.mapInArrow(trimmed(run), "part int, value array<double>"), "whiten-factors")


def fit_list(vectors: DataFrame) -> DataFrame:
    """x: each distinct vector once, sorted within files, so that reruns add up in one order."""
    return stored(vectors.select("x").distinct().sortWithinPartitions("x"), "whiten-fit")


def _exact_sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of rows and sums of each dimension, a row for each dimension."""
    own = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("i").collect()
    return (own[0]["n"], tuple(int(r["s"]) for r in own)) if own else (0, ())


def train(fit: DataFrame, spec: WhitenSpec = WhitenSpec()) -> Whitening | None:
    """The whitening of a fit list; None if it is empty."""
    n, sums = _exact_sums(fit)
    if not n:
        return None
    d = len(sums)
    r = _tree(_factors(fit, n, sums, spec), lambda x, y: _triangle(np.vstack([x.reshape(d, d), y.reshape(d, d)])).ravel(), spec.fan_in)
    _, s, right = np.linalg.svd(r.reshape(d, d))
    values = np.where(s > max(n, d) * np.finfo(float).eps * s.max(initial=0.0), s**2 / n, 0.0)
    k = min(spec.components, d)
    return Whitening(n, sums, right[:k].T, values[:k], float((s**2).sum() / n))


def identity_error(fit: DataFrame, model: Whitening, spec: WhitenSpec = WhitenSpec()) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity; None without components."""
    good = np.flatnonzero(model.values > 0)
    d, k = len(model.sums), len(good)
    if not k:
        return None

    def merge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of (count, means, centred products) of two sets of rows."""
        n, m = x[0], y[0]
        if not n or not m:
            return y if m else x
        gap = y[1 : k + 1] - x[1 : k + 1]
        return np.concatenate(([n + m], x[1 : k + 1] + gap * m / (n + m), x[k + 1 :] + y[k + 1 :] + np.outer(gap, gap).ravel() * n * m / (n + m)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 + k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_matrix(batch, d))[:, good]
                off = w - w.mean(axis=0)
                held = merge(held, np.concatenate(([len(w)], w.mean(axis=0), (off.T @ off).ravel())))
        yield _part(TaskContext.get().partitionId(), held)

    parts = stored(fit.mapInArrow(trimmed(run), "part int, value array<double>"), "whiten-products")
    products = _tree(parts, merge, spec.fan_in)
    return float(np.abs(products[k + 1 :].reshape(k, k) / products[0] - np.eye(k)).max())


def whitened(embeddings: DataFrame, spec: WhitenSpec = WhitenSpec()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row and component."""
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, spec)
    fit = fit_list(vectors)
    schema = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = train(fit, spec)
    if model is None:
        return spark.createDataFrame([], schema)
    error, d, k = identity_error(fit, model, spec), len(model.sums), len(model.values)
    explained = [v / model.trace if model.trace > 0 else None for v in model.values.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, rows = _matrix(batch, d), batch.num_rows
            w = model.whitened(x).ravel()
            take = pa.array(np.repeat(np.arange(rows), k))
            columns = [
                batch.column("vec_id").take(take), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(take),
                pa.array(w, mask=np.isnan(w)), pa.array(explained * rows, pa.float64()), pa.array([error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(trimmed(run), schema)
