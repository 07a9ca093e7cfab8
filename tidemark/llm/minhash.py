"""Near-duplicates by HyperMinHash: compressed registers, banding, estimates, and a check over whole sets.

A text is the set of its shingles of ``shingle`` words (see ``neardup.shingle_set``). Each of ``bands * rows`` hash
functions gives a register: of the least hash of the set's shingles, the number of leading zeros and the
``mantissa_bits`` bits after the first one. Two sets agree in a register with a chance of their Jaccard likeness, or,
where their least hashes differ, by a collision, whose chance follows from their sizes.

Sets that agree in all registers of a band meet in a bucket. At a likeness of 0.8 a pair meets in none of 48 bands of 5
with a chance of 6e-9; that, and the margin of estimates below, is all that the method leaves to chance. Pairs of a bucket
whose sizes allow the likeness are estimated from all registers, less the collisions to be expected, and kept from
``margin`` standard deviations below the wanted likeness; what is kept is confirmed over the whole sets.

Equal sets are merged first. No bucket is expanded into all of its pairs: for ``rounds`` rounds every group of linked sets
sends one of its members in a bucket to one of the bucket's other groups, so that a group of copies becomes a star. Then
only pairs of different groups are left: members outside a bucket's largest group meet all others, and the join itself
lets none out but those whose registers' last bits differ in no more places than chance allows, and whose parities (1,024
bits, each of the shingles that fall on it) differ in no more places than sets that are alike can. Nothing is capped. Components are found as for SimHash.

A text without words, or null, is an empty set and linked with nothing: its component is its own doc_id. A null doc_id
takes part in links; its component is the smallest doc_id that it reaches, or null. Repeated rows, repeated ids and
further columns of any name are allowed; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, row_key, shipped, stored, text_bytes, trimmed
from .neardup import NearSpec, shingle_set, shingle_sets
from .simhash import regrouped


@dataclass(frozen=True)
class MinHashSpec:
    shingle: int = 2
    percent: int = 80
    seed: int = 42
    bands: int = 48
    rows: int = 5
    mantissa_bits: int = 10
    #: Standard deviations below the wanted likeness from which an estimate is worth a check.
    margin: float = 5.5
    rounds: int = 2
    #: Rows (of 16 bytes) that are sent to every executor rather than joined by a shuffle.
    broadcast_keys: int = 1_000_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def sets(self) -> NearSpec:
        return NearSpec(shingle=self.shingle, percent=self.percent, seed=self.seed)


@lru_cache
def _functions(spec: MinHashSpec) -> tuple[np.ndarray, np.ndarray]:
    """Two odd or free 32-bit constants for each hash function."""
    drawn = np.random.default_rng(spec.seed).integers(0, 1 << 32, (2, spec.registers), np.uint32)
    return drawn[0][:, None], (drawn[1] | np.uint32(1))[:, None]


def least_hashes(shingles: np.ndarray, spec: MinHashSpec = MinHashSpec()) -> np.ndarray:
    """The least 32-bit hash by each function, over blocks of shingles."""
    masks, factors = _functions(spec)
    least = np.full(spec.registers, (1 << 32) - 1, np.uint32)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for a in range(0, len(folded), 2048):
        mixed = (folded[a : a + 2048] ^ masks) * factors
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x846CA68B)
        mixed ^= mixed >> np.uint32(16)
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def registers(shingles: np.ndarray, spec: MinHashSpec = MinHashSpec()) -> np.ndarray:
    """16 bits for each function: leading zeros of the least hash (0 to 32), and the bits after its first one."""
    fraction, length = np.frexp(least_hashes(shingles, spec).astype(float))
    mantissa = np.where(length > 0, (fraction * 2 - 1) * (1 << spec.mantissa_bits), 0).astype(np.uint16)
    return ((32 - length).astype(np.uint16) << np.uint16(spec.mantissa_bits)) | mantissa


def bands(own: np.ndarray, spec: MinHashSpec = MinHashSpec()) -> np.ndarray:
    """A 64-bit key for each band of registers, other for each band's number."""
    rows = own.reshape(spec.bands, spec.rows).astype(np.uint64)
    out = np.arange(1, spec.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(spec.rows):
        out = (out ^ rows[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


#: The last bits of the first 256 registers.
BITS = ("b0", "b1", "b2", "b3")


def last_bits(own: np.ndarray) -> np.ndarray:
    padded = np.zeros(256, np.uint8)
    padded[: len(own)] = own[:256] & 1
    return np.packbits(padded).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """1,024 bits in 16 longs, each the parity of the shingles that fall on it: two sets differ in as many at least."""
    return np.packbits((np.bincount(shingles >> np.uint64(54), minlength=1024) & 1).astype(np.uint8)).view(np.int64)


@lru_cache(maxsize=65536)
def collision_chance(n: int, m: int, mantissa_bits: int = 10) -> float:
    """How likely registers of two disjoint sets of n and m shingles agree: the sum over cells of both their chances.

    A cell holds the hashes of one exponent and mantissa. Cells of an exponent are narrow, so that a middle value for
    each of 16 groups of them stands for the others.
    """
    exponents = np.arange(1, 33)[:, None]
    low = 2.0**-exponents * (1 + (np.arange(16)[None, :] + 0.5) / 16)
    width = 2.0**-exponents / (1 << mantissa_bits)
    density = lambda k: k * np.exp((k - 1) * np.log1p(-np.minimum(low, 1 - 1e-12)))
    return float((density(n) * density(m) * width**2).sum() * (1 << mantissa_bits) / 16)


def estimated_likeness(agree: np.ndarray, n: np.ndarray, m: np.ndarray, spec: MinHashSpec = MinHashSpec()) -> np.ndarray:
    """Jaccard estimates from the numbers of registers that agree, corrected for collisions. Sizes count by their powers of 2."""
    size = lambda x: 1 << max(0, int(x).bit_length() - 1)
    chance = np.array([collision_chance(size(x), size(y), spec.mantissa_bits) for x, y in zip(n, m, strict=True)])
    return (agree / spec.registers - chance) / (1 - chance)


def minhash_rows(docs: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """doc_id, row_key, key (a hash of the set), n (its size), regs (registers), their last bits, odd (parities), bands, for every row.

    Of rows with equal sets in a task, only the first has all but its key and size.
    """
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = {0}
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                keys, sizes, regs, last, odd, held = [], [], [], [], [], []
                for text in text_bytes(batch):
                    own = shingle_set(text, spec.sets)
                    key = xxhash.xxh64_intdigest(own.tobytes(), spec.seed) if len(own) else 0
                    keys.append(key)
                    sizes.append(len(own))
                    if key in seen:
                        regs.append(None)
                        last.append(np.zeros(4, np.int64))
                        odd.append(None)
                        held.append(None)
                    else:
                        seen.add(key)
                        drawn = registers(own, spec)
                        regs.append(drawn.astype("<u2").tobytes())
                        last.append(last_bits(drawn))
                        odd.append(parities(own).tolist())
                        held.append(bands(drawn, spec).tolist())
                columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary()), *map(pa.array, np.array(last, np.int64).reshape(-1, 4).T.copy()), pa.array(odd, pa.list_(pa.int64())), pa.array(held, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "key", "n", "regs", *BITS, "odd", "bands"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("row_key"), docs["text"])
    return stored(rows.mapInArrow(trimmed(run), "doc_id long, row_key long, key long, n long, regs binary, b0 long, b1 long, b2 long, b3 long, odd array<long>, bands array<long>"), "minhash-rows")


def _buckets(rows: DataFrame) -> DataFrame:
    """bucket, key, n of the distinct sets that share a band with another set."""
    found = rows.where("bands is not null").select(F.explode("bands").alias("bucket"), "key", "n").distinct()
    shared = found.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return stored(found.join(shared, "bucket").select("bucket", "key", "n"), "minhash-buckets")


def _likely(pairs: DataFrame, sets: DataFrame, spec: MinHashSpec) -> DataFrame:
    """The pairs (a, b) whose estimated likeness is not below the wanted one by more than chance allows."""
    wanted = spec.percent / 100
    least = wanted - spec.margin * (wanted * (1 - wanted) / spec.registers) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("u", "v")]
                near = estimated_likeness((both[0] == both[1]).sum(axis=1), batch.column("n").to_numpy(), batch.column("m").to_numpy(), spec) >= least
                yield batch.select(["a", "b"]).filter(pa.array(near))

    named = lambda key, size, regs: sets.select(F.col("key").alias(key), F.col("n").alias(size), F.col("regs").alias(regs))
    both = pairs.join(named("a", "n", "u"), "a").join(named("b", "m", "v"), "b")
    return both.select("a", "b", "n", "m", "u", "v").mapInArrow(trimmed(run), "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, sets: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """The pairs (a, b) of keys whose whole sets are alike; the sets are made anew of one text each."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    source = stored(sets.join(needed, "key", "left_semi").select(F.col("row_key").alias("needed_row")), "minhash-needed")
    few = source.count() <= spec.broadcast_keys
    own = docs.select(docs["text"], row_key(docs).alias("row_key"))
    texts = own.join(F.broadcast(source) if few else source, F.col("row_key") == F.col("needed_row"), "left_semi")
    whole = stored(shingle_sets(texts, spec.sets).groupBy("key").agg(F.first("shingles").alias("shingles")), "minhash-sets")
    named = lambda key, name: whole.select(F.col("key").alias(key), F.col("shingles").alias(name))
    both = pairs.join(named("a", "u"), "a").join(named("b", "v"), "b")
    shared = F.size(F.array_intersect("u", "v"))
    return stored(both.where((100 + spec.percent) * shared >= spec.percent * (F.size("u") + F.size("v"))).select("a", "b"), "minhash-links")


def _few_bits_differ(spec: MinHashSpec) -> Column:
    """Can x and y be alike by their last bits, half of which differ where registers do, and by their parities."""
    count, off = min(256, spec.registers), (1 - spec.percent / 100) / 2
    most = count * off + spec.margin * (count * off * (1 - off)) ** 0.5
    last = sum((F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in BITS), F.lit(0))
    odd = sum((F.bit_count(F.col("x.odd")[k].bitwiseXOR(F.col("y.odd")[k])) for k in range(16)), F.lit(0))
    return (last <= int(most)) & ((100 + spec.percent) * odd <= (100 - spec.percent) * (F.col("x.n") + F.col("y.n")))


def _ordered(pairs: DataFrame, spec: MinHashSpec) -> DataFrame:
    """Distinct a < b of pairs x, y of members (key, n) whose sizes allow the likeness."""
    sized = 100 * F.least("x.n", "y.n") >= spec.percent * F.greatest("x.n", "y.n")
    return pairs.where((F.col("x.key") != F.col("y.key")) & sized).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def near_components(docs: DataFrame, rows: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """node, root for every set (by its key) that is linked with others; rows as ``minhash_rows`` gives them."""
    sets = stored(rows.where("regs is not null").groupBy("key").agg(*(F.min(c).alias(c) for c in ("n", "row_key", *BITS)), *(F.first(c).alias(c) for c in ("regs", "odd"))), "minhash-distinct")
    buckets = _buckets(rows)
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    tried = None
    for k in range(spec.rounds + 1):
        named = buckets.join(roots.withColumnRenamed("node", "key"), "key", "left").select("bucket", F.struct("key", "n").alias("x"), F.coalesce("root", "key").alias("root"))
        groups = named.groupBy("bucket", "root").agg(F.count("*").alias("c"), F.min_by("x", F.xxhash64("x.key", F.lit(k))).alias("x"))
        groups = stored(groups, "minhash-groups")
        open_buckets = groups.groupBy("bucket").agg(F.count("*").alias("groups"), F.max_by(F.struct("root", "x"), F.struct("c", "root")).alias("top")).where("groups > 1").select("bucket", "top")
        open_buckets = stored(open_buckets, "minhash-open")
        if open_buckets.isEmpty():
            break
        if k < spec.rounds:
            # A member of every other group with one of the bucket's largest group.
            met = groups.join(open_buckets, "bucket").where("root <> top.root").select("x", F.col("top.x").alias("y"))
        else:
            left = named.join(open_buckets, "bucket").select("bucket", "root", F.col("x.key").alias("key"), F.col("top.root").alias("largest"))
            left = left.join(sets.select("key", "n", *BITS, "odd"), "key").select("bucket", "root", "largest", F.struct("key", "n", *BITS, "odd").alias("x"))
            outside = left.where("root <> largest").select("bucket", "x", "root")
            members = left.select("bucket", F.col("x").alias("y"), F.col("root").alias("other"))
            met = outside.join(members, "bucket").where((F.col("root") != F.col("other")) & _few_bits_differ(spec)).select("x", "y")
        pairs = _ordered(met, spec)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        likely = stored(_likely(pairs, sets, spec), "minhash-pairs")
        tried = likely if tried is None else tried.unionByName(likely)
        roots = regrouped(roots, confirmed(likely, docs, sets, spec))
    return roots


def minhash_classes(docs: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id (smallest doc_id reachable) for every row."""
    rows = minhash_rows(docs, spec)
    roots = near_components(docs, rows, spec)
    keys = stored(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_rows")), "minhash-ids")
    linked = keys.join(roots.withColumnRenamed("node", "key"), "key")
    best = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    moved = linked.join(best, "root").select("key", "component_id")
    labels = keys.join(moved, "key", "left").select("key", F.coalesce("component_id", "least_id").alias("component_id"), "n_rows")
    whole = labelled(rows.where("n > 0").select("doc_id", "row_key", F.col("n").alias("n_shingles"), "key"), stored(labels, "minhash-labels"), "key")
    empty = rows.where("n = 0").select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return whole.select("doc_id", "row_key", "n_shingles", "component_id").unionByName(empty)
