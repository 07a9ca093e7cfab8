"""One document of each group of near copies: SimHash first, and an exact join for what its radius can't reach.

A text is the set of its shingles of ``shingle`` words (runs of anything but ASCII white space, A-Z lowered; a shorter
text is one shingle). Two texts are near copies if their sets' Jaccard likeness is at least ``percent`` hundredths;
groups are the connected components.

Equal sets are merged. Covering masks over SimHash fingerprints of the sets (see ``simhash``) then give links within
its radius; each is confirmed over the whole sets before it counts. At a likeness of 0.8 about 15 % of a fingerprint's
bits differ, which no affordable covering family hides, so the rest is found by prefix filtering: sets are sorted by
one order for all texts, and a set that is like another shares at least ``percent`` hundredths of its shingles with it,
so that one of the first ``n - ceil(n * percent / 100) + 1`` is shared and is among the other's first ones too. Each
such pair meets in a bucket, with no false negatives. Any order gives the same groups. Shingles that are frequent in a
sample of texts come last, so that buckets stay small; only the effort depends on the sample.

In buckets whose members of different groups make many pairs each, neighbours are compared first, and then all that fall
into one small salted part, so that the members of a large group find each other by a bounded number of pairs each; in the
end all remaining pairs of a bucket are compared that sizes and places in both prefixes allow, each set meeting only those
of size classes within its reach. Nothing is capped. Links count between groups, each once.
Texts themselves are never shuffled but for those whose sets are compared.

Nulls: a null text has no words, hence an empty set, and empty sets are equal. Equal rows, repeated and null ids are
allowed; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, row_key, shipped, stored, text_bytes, trimmed
from .simhash import SimHashSpec, components, links_within, one_of_each, regrouped


@dataclass(frozen=True)
class NearSpec:
    shingle: int = 5
    percent: int = 80
    seed: int = 42
    #: Texts and shingles that the order of shingles is taken from; results don't depend on them.
    order_texts: int = 5_000
    order_shingles: int = 200_000
    #: Rounds before all remaining pairs are compared: in buckets with more than so many pairs left for each member, and,
    #: after the first two, while no more than this share of the pairs is left that the round before found; the most
    #: members of a bucket that are put in one order, and about how many meet in a salted part.
    rounds: int = 3
    pairs_per_member: int = 32
    worthwhile: float = 0.8
    part: int = 10_000
    meeting: int = 64
    #: Keys of sets to compare (24 bytes each) that are sent to every executor rather than joined by a shuffle.
    broadcast_keys: int = 1_000_000
    simhash: SimHashSpec = SimHashSpec(shingle=5)


def shingle_set(text: bytes, spec: NearSpec = NearSpec()) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    digest, seed = xxhash.xxh64_intdigest, spec.seed
    hashes = np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))
    size = min(spec.shingle, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


#: Columns of the sketch.
SKETCH = ("p0", "p1", "p2", "p3")


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """256 bits in four longs, each the parity of the shingles that fall on it: two sets differ in as many at least."""
    return np.packbits((np.bincount(shingles >> np.uint64(56), minlength=256) & 1).astype(np.uint8)).view(np.int64)


def _parities(shingles: np.ndarray) -> np.ndarray:
    """A sketch as long as the set asks for: one to two bits for each shingle, a power of two in all."""
    bits = 64 << max(0, (len(shingles) - 1) // 64).bit_length()
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _simhash(shingles: np.ndarray) -> int:
    """Bits set in more than half of the shingles, as a signed long."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(shingles), 1 << 15):
        part = shingles[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0])


def _arrays(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))


def _key(shingles: np.ndarray, spec: NearSpec) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), spec.seed)


def _longs(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def shingle_sets(docs: DataFrame, spec: NearSpec = NearSpec()) -> DataFrame:
    """key (a hash of the set), shingles: every set once for each task that meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                found: dict[int, np.ndarray] = {}
                for text in text_bytes(whole.slice(a, 1000)):
                    own = shingle_set(text, spec)
                    if (key := _key(own, spec)) not in seen:
                        seen.add(key)
                        found[key] = own.view(np.int64)
                yield pa.RecordBatch.from_arrays([_longs(list(found)), _arrays(list(found.values()))], names=["key", "shingles"])

    return docs.select(docs["text"]).mapInArrow(trimmed(run), "key long, shingles array<long>")


def _frequent(docs: DataFrame, spec: NearSpec) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of more than one sampled set, sorted, and their places in the order: the most frequent last."""
    every = max(1, -(-docs.count() // spec.order_texts))
    sample = docs.where(F.pmod(F.xxhash64(docs["text"]), F.lit(every)) == 0)
    counted = shingle_sets(sample, spec).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "s").limit(spec.order_shingles).toArrow()  # at most order_shingles rows
    shingles = found["s"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], len(shingles) - order


def near_rows(docs: DataFrame, spec: NearSpec = NearSpec()) -> DataFrame:
    """doc_id, row_key, key (a hash of the set), n (its size), fp (its SimHash), its sketches, tokens, for every row.

    tokens are the set's first shingles in the order; of rows with equal sets in a task only the first has them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, spec))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, places = shared.value
        seen: set[int] = set()

        def prefix(own: np.ndarray) -> np.ndarray:
            n = len(own)
            if len(frequent) and n:
                spot = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                own = own[np.lexsort((own, np.where(frequent[spot] == own, places[spot], 0)))]
            return own[: n + (-n * spec.percent) // 100 + 1 if n else 0].view(np.int64)

        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                keys, sizes, fps, sketches, long_sketches, tokens = [], [], [], [], [], []
                for text in text_bytes(batch):
                    own = shingle_set(text, spec)
                    keys.append(key := _key(own, spec))
                    sizes.append(len(own))
                    fps.append(_simhash(own))
                    sketches.append(_sketch(own))
                    long_sketches.append(_parities(own))
                    tokens.append(np.zeros(0, np.int64) if key in seen else prefix(own))
                    seen.add(key)
                drawn = np.array(sketches, np.int64).reshape(-1, len(SKETCH)).T.copy()
                columns = [batch.column("doc_id"), batch.column("row_key"), _longs(keys), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), *map(pa.array, drawn), _arrays(long_sketches), _arrays(tokens)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "key", "n", "fp", *SKETCH, "sketch", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"], row_key(docs).alias("row_key"), docs["text"])
    return stored(rows.mapInArrow(trimmed(run), f"doc_id {kind}, row_key long, key long, n int, fp long, p0 long, p1 long, p2 long, p3 long, sketch array<long>, tokens array<long>"), "near-rows")


def _sets(rows: DataFrame) -> DataFrame:
    """key, n, fp, sketches of every distinct set."""
    columns = ["n", "fp", *SKETCH]
    return stored(rows.groupBy("key").agg(*(F.min(c).alias(c) for c in columns), F.first("sketch").alias("sketch")), "near-keys")


def _buckets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """token, key, n, at (the token's place in the set), before (the token at the place before), sketch: tokens of every distinct set that others have too."""
    found = rows.select("key", "tokens", F.posexplode("tokens").alias("at", "token")).select("key", "at", "token", F.get("tokens", F.col("at") - 1).alias("before"))
    common = found.groupBy("token").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("token")
    shared = found.join(common, "token").select("token", "key", "at", "before").distinct()
    return stored(shared.join(sets.drop("fp", "sketch"), "key"), "near-buckets")


def _alike(a: str, b: str, spec: NearSpec) -> Column:
    """Can two members of a bucket be alike: by their sizes, the tokens that follow the shared one in both, and sketches.

    No pair that is alike fails: sketches differ in no more bits than the sets do in shingles.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.at"), m - F.col(f"{b}.at"))
    differ = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in SKETCH), F.lit(0))
    return (100 * F.least(n, m) >= spec.percent * F.greatest(n, m)) & ((100 + spec.percent) * rest >= spec.percent * (n + m)) & ((100 + spec.percent) * differ <= (100 - spec.percent) * (n + m))


def _pairs(joined: DataFrame, spec: NearSpec) -> DataFrame:
    """Distinct a < b of rows with two members x and y of different groups."""
    met = (F.col("x.root") != F.col("y.root")) & _alike("x", "y", spec)
    return joined.where(met).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def _all_pairs(named: DataFrame, spec: NearSpec) -> DataFrame:
    """Members x, y of a bucket, n of x no more than that of y, that meet by the sizes which places in prefixes leave.

    With at ids before the shared token, a set of n shingles can only be like one of up to
    ``(100 + percent) * (n - at) / percent - n``. The smaller of two must reach its own size; the larger asks for the
    size classes from ``percent`` hundredths of its size up to what it can reach. Two that share the token before too meet
    there, where places leave more: all that they pass here they pass in that bucket, which is open as their groups differ.
    """
    n, at = F.col("n"), F.col("at")
    reach = F.floor((100 + spec.percent) * (n - at) / spec.percent - n + 1e-9)
    size_class = lambda size: F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 12).cast("int")  # noqa: E731  # 6 % each
    member = F.struct("key", "n", "at", "before", *SKETCH, "root")
    small = named.where(reach >= n).select("token", size_class(n).alias("c"), member.alias("x"))
    low, high = F.ceil(n * spec.percent / 100), F.least(n, reach)
    large = named.where(high >= low).select("token", F.explode(F.sequence(size_class(low), size_class(high))).alias("c"), member.alias("y"))
    return small.join(large, ["token", "c"]).where("(x.n < y.n or x.n = y.n and x.key <> y.key) and coalesce(x.before <> y.before, true)")


def _part_pairs(named: DataFrame, salt: int, spec: NearSpec) -> DataFrame:
    """Members x, y that fall into one of a bucket's parts of about ``meeting`` members; parts go by a hash of the key."""
    part = F.pmod(F.xxhash64("key", F.lit(salt)), F.ceil(F.col("c") / spec.meeting))
    member = F.struct("key", "n", "at", *SKETCH, "root")
    dealt = named.select("token", part.alias("part"), member.alias("x"))
    return dealt.join(dealt.withColumnRenamed("x", "y"), ["token", "part"]).where("x.key < y.key")


def _sketched(pairs: DataFrame, sets: DataFrame, spec: NearSpec) -> DataFrame:
    """The pairs (a, b) whose long sketches differ in no more bits than sets that are alike can."""
    named = lambda key, k: sets.select(F.col("key").alias(key), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}"))
    both = pairs.join(named("a", 1), "a").join(named("b", 2), "b")
    less, more = F.when(F.size("s1") <= F.size("s2"), F.col("s1")).otherwise(F.col("s2")), F.when(F.size("s1") <= F.size("s2"), F.col("s2")).otherwise(F.col("s1"))
    half = F.size("more") / 2
    folded = F.when(F.size("more") > F.size("less"), F.zip_with(F.slice("more", F.lit(1), half.cast("int")), F.slice("more", half.cast("int") + 1, half.cast("int")), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col("more"))
    differ = F.aggregate(F.zip_with("less", folded, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    # Sizes of sets that can be alike lie less than two powers of two apart.
    return both.withColumns({"less": less, "more": more}).where((100 + spec.percent) * differ <= (100 - spec.percent) * (F.col("n1") + F.col("n2"))).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, rows: DataFrame, sets: DataFrame, spec: NearSpec) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike. The sets are made anew of one text each."""
    pairs = stored(_sketched(pairs, sets, spec), "near-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    source = rows.join(needed, "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc_id", "row_key")).alias("row")).select(F.col("row.doc_id").alias("needed_id"), F.col("row.row_key").alias("needed_row"))
    source = found = stored(source, "near-needed")
    if source.count() <= spec.broadcast_keys:
        source = F.broadcast(source)
    own = docs.select(docs["doc_id"], docs["text"], row_key(docs).alias("row_key"))
    whole = own.join(source, (F.col("row_key") == F.col("needed_row")) & F.col("doc_id").eqNullSafe(F.col("needed_id")), "left_semi")
    whole_sets = stored(shingle_sets(whole, spec).groupBy("key").agg(F.first("shingles").alias("shingles")), "near-sets")
    both = pairs.join(whole_sets.select(F.col("key").alias("a"), F.col("shingles").alias("u")), "a").join(whole_sets.select(F.col("key").alias("b"), F.col("shingles").alias("v")), "b")
    shared = F.size(F.array_intersect("u", "v"))
    links = stored(both.where((100 + spec.percent) * shared >= spec.percent * (F.size("u") + F.size("v"))).select("a", "b"), "near-links")
    dropped(pairs, found, whole_sets)
    return links


def _simhash_pairs(sets: DataFrame, spec: NearSpec) -> DataFrame:
    """Candidates a < b: sets of one fingerprint, and of fingerprints that covering masks link."""
    least = stored(sets.groupBy("fp").agg(F.min("key").alias("key")), "near-fingerprints")
    links = links_within(least.select("fp"), spec.simhash)
    across = links.join(least.select(F.col("fp").alias("a"), F.col("key").alias("u")), "a").join(least.select(F.col("fp").alias("b"), F.col("key").alias("v")), "b")
    same = sets.join(least.withColumnRenamed("key", "u"), "fp").where("key <> u").select("u", F.col("key").alias("v"))
    return across.select("u", "v").unionByName(same).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def _grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets with their groups; a set that ``roots`` lacks is its own."""
    return members.join(roots.withColumnRenamed("node", "key"), "key", "left").select("token", "key", "n", "at", "before", *SKETCH, F.coalesce("root", "key").alias("root"))


def _open(named: DataFrame) -> DataFrame:
    """token, c (its members), each (pairs of different groups for each member) of buckets with more than one group."""
    own = named.groupBy("token", "root").agg(F.count("*").cast("double").alias("m"))
    sizes = own.groupBy("token").agg(F.sum("m").alias("c"), F.sum(F.col("m") * F.col("m")).alias("s")).where("c * c > s")
    return sizes.select("token", "c", ((F.col("c") - F.col("s") / F.col("c")) / 2).alias("each"))


def near_links(docs: DataFrame, rows: DataFrame, spec: NearSpec = NearSpec()) -> DataFrame:
    """node, root for every set (by its key) that is in a group with others; rows as ``near_rows`` gives them."""
    sets = _sets(rows)
    links = _confirmed(_simhash_pairs(sets, spec), docs, rows, sets, spec)
    # Enough to begin with: sets with one least neighbour are in one group.
    first = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    buckets = _buckets(rows, sets)
    # Crowded buckets alone; groups only grow, so that none is crowded later that wasn't before.
    roots, members, before = None, buckets, 0.0
    for k in range(spec.rounds):
        named = _grouped(members, first if roots is None else roots)
        crowded = stored(_open(named).where(F.col("each") > spec.pairs_per_member), "near-crowded")
        left = crowded.agg(F.count("*").alias("tokens"), F.sum(F.col("c") * F.col("each")).alias("pairs")).first()
        # A later round that left most of the pairs is not worth another.
        if not left["tokens"] or k > 1 and left["pairs"] > spec.worthwhile * before:
            break
        before = left["pairs"]
        held = stored(named.join(F.broadcast(crowded) if left["tokens"] <= spec.broadcast_keys else crowded, "token"), "near-crowd")
        if k:
            pairs = _part_pairs(held, k, spec)
            dropped(members)
        else:
            # Neighbours by size, in parts of a bucket.
            part = F.pmod(F.xxhash64("key", F.lit(-1)), F.ceil(F.col("c") / spec.part))
            order = Window.partitionBy("token", part).orderBy("n", "key")
            member = F.struct("key", "n", "at", *SKETCH, "root")
            pairs = held.select(member.alias("x"), F.lag(member).over(order).alias("y"))
        found = _confirmed(_pairs(pairs, spec), docs, rows, sets, spec)
        roots = components(links.unionByName(found)) if roots is None else regrouped(roots, found)
        members = held.drop("root", "c", "each")
    # All that is left: every member of buckets of more than one group.
    named = _grouped(buckets, first if roots is None else roots)
    held = stored(named.join(_open(named).select("token"), "token"), "near-members")
    found = _confirmed(_pairs(_all_pairs(held, spec), spec), docs, rows, sets, spec)
    out = components(links.unionByName(found)) if roots is None else regrouped(roots, found)
    dropped(held, *([members] if roots is not None else []))
    return out


def without_near_copies(docs: DataFrame, spec: NearSpec = NearSpec()) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (null last), then the smallest hash of the row."""
    shipped(docs.sparkSession)
    rows = near_rows(docs, spec)
    roots = near_links(docs, rows, spec)
    classes = rows.select("doc_id", "row_key", "key").join(roots.withColumnRenamed("node", "key"), "key", "left")
    return one_of_each(docs, classes.select(F.coalesce("root", "key").alias("g"), "doc_id", "row_key"), spec.broadcast_keys)
