"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits link when they differ in at most ``radius`` bits. Each bit gets a nonzero vector of
``radius + 1`` bits, and each of the ``2 ** (radius + 1) - 1`` nonzero vectors ``v`` a mask that keeps the bits whose
vector has an odd product with ``v``. The vectors of ``radius`` differing bits span at most ``radius`` dimensions, so
some ``v`` is orthogonal to all of them and its mask hides every difference: each pair within the radius collides in
at least one table, with no false negatives.

Equal fingerprints are merged before anything else. Tables are joined only on buckets of two or more fingerprints.
A bucket of more than ``dense`` fingerprints is not compared as it is: its members go through a covering family of the
bits that its mask hides, until buckets are small or at most ``direct_bits`` bits are hidden; distinct fingerprints that
agree outside b bits number 2 ** b at most. Each level hides at most 7 of 15 bits, so there are four levels (64, 30,
14, 7 bits) and at most 15 masks for each mask of the level above. Nothing is capped.
Within a bucket only a spanning forest of the links is emitted. Components are found by alternating
large-star and small-star steps over tables in the shared folder.

Nulls: a null text has no words, hence fingerprint zero. A null doc_id takes part, and its component_id is the
smallest doc_id it reaches, or null. Equal rows and repeated ids are allowed; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import dropped, free_name, labelled, row_key, shipped, slices, stored, text_bytes, trimmed


@dataclass(frozen=True)
class SimHashSpec:
    shingle: int = 3
    seed: int = 42
    radius: int = 3
    dense: int = 512
    #: Buckets that hide no more bits are compared directly: they hold 2 ** direct_bits fingerprints at most.
    direct_bits: int = 9
    max_rounds: int = 60


def fingerprint(text: bytes, spec: SimHashSpec) -> int:
    """Bits set in more than half of the shingles' hashes; repeats count. A text without words has 0."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= spec.shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), spec.seed)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[: -spec.shingle] + 1))
    digest, seed = xxhash.xxh64_intdigest, spec.seed
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begins.tolist(), ends[spec.shingle - 1 :].tolist(), strict=True)), np.uint64, len(begins))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        part = hashes[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """doc_id, row_key, fp (the fingerprint's bits as a signed long)."""
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch)
            for a, b in slices([len(t) for t in texts], 4_000_000):
                part = batch.slice(a, b - a)
                fps = np.array([fingerprint(t, spec) for t in texts[a:b]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_key"), pa.array(fps)], names=["doc_id", "row_key", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("row_key"), docs["text"])
    return rows.mapInArrow(trimmed(run), "doc_id long, row_key long, fp long")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bits: differences in ``radius`` of them are hidden by at least one.

    Unit vectors are given out first, so that from ``radius + 1`` bits on no mask is empty.
    """
    units = [1 << k for k in range(radius + 1)]
    order = units + [v for v in range(1, 1 << radius + 1) if v not in units]
    vectors = {bit: order[i % len(order)] for i, bit in enumerate(bits)}
    return [sum(1 << bit for bit, x in vectors.items() if (x & v).bit_count() % 2) for v in range(1, 1 << radius + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _spanning_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket (at most ``dense`` of them in each); out come links that join what is within the radius."""
    held: np.ndarray = np.zeros(0, np.int64)
    bucket = None

    def links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64))
        near = distance <= radius
        todo, a, b = np.ones(len(fps), bool), [], []
        while todo.any():
            edge = [int(todo.argmax())]
            todo[edge[0]] = False
            while edge:
                at = edge.pop()
                new = np.flatnonzero(near[at] & todo)
                todo[new] = False
                a += [fps[at]] * len(new)
                b += fps[new].tolist()
                edge += new.tolist()
        return np.array(a, np.int64), np.array(b, np.int64)

    def emit(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in ("path", "kept")], axis=1)
        fps = batch.column("fp").to_numpy()
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        parts = []
        for own, key in zip(np.split(fps, edges), keys[np.concatenate(([0], edges))] if len(fps) else [], strict=len(fps) > 0):
            if bucket is not None and (key == bucket).all():
                held = np.concatenate((held, own))
            else:
                if len(held) > 1:
                    parts.append(links(held))
                held, bucket = own, key
        yield emit(parts)
    if len(held) > 1:
        yield emit([links(held)])


def links_within(fps: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to join all that are within the radius of each other."""
    spark = fps.sparkSession
    shipped(spark)
    found: DataFrame | None = None
    members = fps.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("kept"), "fp")
    level = {0: list(range(64))}  # path -> bits that are still hidden; 15 ** 3 paths at most, see above
    while level:
        following: dict[int, list[int]] = {}
        choices = []
        for path, bits in level.items():
            for k, mask in enumerate(covering_masks(bits, spec.radius)):
                to = path * (1 << spec.radius + 1) + k + 1
                following[to] = [b for b in bits if not mask >> b & 1]
                visible = ((1 << 64) - 1) ^ sum(1 << b for b in following[to])
                choices.append((path, to, _signed(visible), len(following[to]) <= max(spec.direct_bits, spec.radius)))
        masks = F.broadcast(spark.createDataFrame(choices, "path long, to long, mask long, direct boolean"))  # 15 per path
        keyed = members.select("path", "fp").join(masks, "path").select(F.col("to").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("kept"), "fp", "direct")
        sizes = keyed.groupBy("path", "kept").agg(F.count("*").alias("n")).where("n > 1")
        crowded = stored(keyed.join(sizes, ["path", "kept"]).withColumn("direct", F.col("direct") | (F.col("n") <= spec.dense)), "simhash-buckets")
        near = crowded.where("direct").repartition("path", "kept").sortWithinPartitions("path", "kept", "fp").select("path", "kept", "fp")
        links = near.mapInArrow(trimmed(lambda it: _spanning_links(it, spec.radius)), "a long, b long")
        found = links if found is None else found.unionByName(links)
        dense = crowded.where("not direct")
        level = {r["path"]: following[r["path"]] for r in dense.select("path").distinct().collect()}  # at most the paths of this level
        members = dense.select("path", "kept", "fp")
    assert found is not None
    return stored(found.distinct(), "simhash-links")


def components(links: DataFrame, max_rounds: int = 60, broadcast_links: int = 250_000) -> DataFrame:
    """node, root (the least node of its component) for every node of the links a < b.

    Least neighbours of up to ``broadcast_links`` links are sent to every executor: a round then has three shuffles.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    n_edges, own = edges.count(), []
    for _ in range(max_rounds):
        few = n_edges <= broadcast_links
        sent = F.broadcast if few else lambda df: df
        # Large star: every larger neighbour of a node is linked to the node's least neighbour.
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        if not n_edges:
            return least.select(F.col("u").alias("node"), F.col("m").alias("root"))
        # Settled: links are of a least node and one that has no other.
        moved, met = Observation(), both.join(sent(least), "u")
        large = met.observe(moved, F.count_if(F.col("m") != F.least("u", "v")).alias("n")).where("v > u").select(F.col("m").alias("u"), "v")
        large = stored(large if few else large.distinct(), "components-large")
        if not moved.get["n"]:
            roots = stored(least.select(F.col("u").alias("node"), F.col("m").alias("root")), "components-roots")
            dropped(large, *own)
            return roots
        # Small star: a node's smaller neighbours and the node itself are linked to the least of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(sent(least), "v").select(F.explode(F.array(F.struct("m", F.col("u").alias("v")), F.struct("m", "v"))).alias("e"))
        seen = Observation()
        edges = stored(joined.select(F.col("e.m").alias("u"), "e.v").where("u <> v").distinct().observe(seen, F.count("*").alias("n")), "components")
        dropped(large, *own)
        n_edges, own = seen.get["n"], [edges]
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def regrouped(roots: DataFrame, links: DataFrame, broadcast_nodes: int = 250_000) -> DataFrame:
    """node, root as ``components`` gives them, after links (a, b) are added to what it gave before.

    Only groups are linked, two of them once, however many of their nodes are.
    """
    sent = F.broadcast if roots.count() <= broadcast_nodes else lambda df: df
    known = lambda key, group: sent(roots.select(F.col("node").alias(key), F.col("root").alias(group)))
    named = links.join(known("a", "u"), "a", "left").join(known("b", "v"), "b", "left").select(F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v"))
    between = stored(named.where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "components-links")
    moved = components(between)
    # A root that moved and a node that had no group are both nodes of the links; roots have rows of their own among nodes.
    old = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = stored(old.unionByName(moved.join(roots.select("node"), "node", "left_anti")), "components-regrouped")
    dropped(between, moved)
    return out


def near_duplicate_classes(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """doc_id, row_key, fp, component_id (smallest doc_id reachable) for every row."""
    rows = stored(fingerprints(docs, spec), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_rows")), "simhash-fingerprints")
    roots = components(links_within(distinct.select("fp"), spec), spec.max_rounds)
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    best = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    moved = linked.join(best, "root").select("fp", "component_id")
    label = stored(distinct.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id"), "n_rows"), "simhash-labels")
    return labelled(rows, label, "fp").select("doc_id", "row_key", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (null last), then the smallest hash of the row."""
    classes = near_duplicate_classes(docs, spec)
    # Groups whose ids are all null have no component_id; rows of one fingerprint then form a group.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp")).alias("g")
    return one_of_each(docs, classes.select(group, "doc_id", "row_key"))


def one_of_each(docs: DataFrame, classes: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The first row of each group g; ``classes`` has g, doc_id and row_key (see ``row_key``) of every row of ``docs``.

    Rows that go, or that occur several times, are sent to all others where there are no more than ``broadcast_rows``;
    beyond that both sides are shuffled.
    """
    row = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_key")
    counted = stored(classes.groupBy("g", row.alias("row")).agg(F.count("*").alias("m")), "row-groups")
    first = counted.groupBy("g").agg(F.min("row").alias("first"))
    ranked = counted.join(first, "g").withColumn("once", F.col("row") == F.col("first"))
    marked = stored(ranked.where("not once or m > 1").select(F.col("row.doc_id").alias("_id"), F.col("row.row_key").alias("_key"), "once"), "row-marks")
    few = marked.count() <= broadcast_rows
    key = free_name(docs, "_row_key")
    rows = docs.withColumn(key, row_key(docs))

    def met(marks: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(marks) if few else marks, (rows[key] == marks["_key"]) & rows["doc_id"].eqNullSafe(marks["_id"]), how)

    # Equal rows can't be told apart: one of them stays.
    return met(marked, "left_anti").unionByName(met(marked.where("once"), "left_semi").dropDuplicates(["doc_id", key])).drop(key)
