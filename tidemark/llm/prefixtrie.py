"""The prefix trie of conversations, rolled up by pointer jumping.

A node is a distinct sequence of first turns (role, text); the root is the empty one. Its key is its depth and two sums,
modulo the prime ``PRIME``, of digests of each turn together with its place: sums can be carried over from one partition
to the next, so that a conversation may span any number of tasks. Sums of different sequences agree with a chance of
about 2 ** -122.

Totals over subtrees take one round for each power of two below the greatest depth: each node first sends its totals to
its parent, then what it has gathered to its parent's parent, to the ancestor four turns up, and so on. Sums are merged
in each task before they are shuffled, so that a node with a third of all children costs a row for each task.

Turns are put in order by a range sort, not by a window over a conversation; equal rows, which may stand in any order, are
dealt out by a random number. The digest of the members that end at a node is taken by the task that holds them all;
where they span tasks, each gives pieces of text of bounded size, which one reader hashes in order, a piece at a time.

Null role or text counts as empty. Turns with equal numbers stand in the order of role and text, null numbers first.
Rows without a conv_id belong to no conversation. Repeated rows are turns of their own. Without conversations there is
no node, not even the root. Further columns are passed over, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped, stored, trimmed

PRIME = (1 << 61) - 1
NODE = "struct<depth: bigint, a: bigint, b: bigint>"


@dataclass(frozen=True)
class TrieSpec:
    #: Characters of a piece of the ids that end at a node and span tasks.
    piece: int = 1_000_000
    max_rounds: int = 62


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (place of the turn from 1), digest (of role and text), bytes (UTF-8 bytes of the text)."""
    shipped(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids, places, digests, sizes = batch.column("conv_id").to_pylist(), [], [], []
            roles, texts = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text"))
            for own, role, text in zip(ids, roles, texts, strict=True):
                conv, at = own, at + 1 if own == conv else 1
                places.append(at)
                digests.append(hashlib.blake2b(len(role).to_bytes(8) + role + text, digest_size=16).digest())
                sizes.append(len(text))
            columns = [pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "digest", "bytes"])

    role, text = (F.coalesce(conversations[c], F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.where(conversations["conv_id"].isNotNull()).select(conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"], role, text)
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    sort = turns.withColumn("_any", F.rand(7)).repartitionByRange(*order, F.col("_any")).sortWithinPartitions(*order).drop("turn", "_any")
    found = stored(sort.mapInArrow(trimmed(run), "conv_id long, part int, at long, digest binary, bytes long"), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each conversation and task; those that begin in an earlier task are one a task at most.
    carried = found.groupBy("conv_id", "part").agg(F.max("at").alias("n")).withColumn("carry", F.sum("n").over(before)).where("carry is not null").select("conv_id", "part", "carry")
    return found.join(F.broadcast(carried), ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("carry", F.lit(0))).alias("idx"), "digest", "bytes")


def borrowed(conv_id: Column) -> Column:
    """How many first turns a conversation takes over from the first of its five."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, pos, digest, bytes, last) with borrowed beginnings.

    ``turns`` as ``numbered_turns`` gives them. Conversation c begins with the first h turns of c - c % 5 and goes on
    with its own turns after its first h; a beginning serves nine conversations and has eight turns at most.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("idx").alias("n")).withColumns({"h": borrowed(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 5})
    sizes = stored(sizes, "trie-sizes")
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = sizes.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = stored(plan.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-plan")
    heads = turns.where((F.col("conv_id") % 5 == 0) & (F.col("idx") <= 8)).withColumnRenamed("conv_id", "base").join(plan, "base").where("idx <= m")
    own = turns.where(F.col("idx") > borrowed(F.col("conv_id"))).join(plan, "conv_id").withColumn("idx", F.col("idx") - F.col("h") + F.col("m"))
    columns = ["conv_id", F.col("idx").alias("pos"), "digest", "bytes", (F.col("idx") == F.col("length")).alias("last")]
    return plan.select("conv_id", "length"), heads.select(*columns).unionByName(own.select(*columns))


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, node, parent, bytes, last for every turn: the nodes on each conversation's path, but for the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, a, b = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            ids, sums = batch.column("conv_id").to_pylist(), []
            for own, pos, digest in zip(ids, batch.column("pos").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                if own != conv:
                    conv, a, b = own, 0, 0
                both = hashlib.blake2b(digest + pos.to_bytes(8), digest_size=16).digest()
                was = (a, b)
                a, b = (a + int.from_bytes(both[:8])) % PRIME, (b + int.from_bytes(both[8:])) % PRIME
                sums.append((*was, a, b))
            drawn = list(zip(*sums, strict=True)) or [()] * 4
            columns = [batch.column("conv_id"), batch.column("pos"), pa.array([part] * len(ids), pa.int32()), *(pa.array(x, pa.int64()) for x in drawn), batch.column("bytes"), batch.column("last")]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "pos", "part", "pa", "pb", "a", "b", "bytes", "last"])

    sort = turns.repartitionByRange("conv_id", "pos").sortWithinPartitions("conv_id", "pos")
    local = stored(sort.mapInArrow(trimmed(run), "conv_id long, pos long, part int, pa long, pb long, a long, b long, bytes long, last boolean"), "trie-sums")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: (F.sum(F.col(f"end.{c}").cast("decimal(38,0)")).over(before) % F.lit(PRIME).cast("decimal(38,0)")).cast("long")
    ends = local.groupBy("conv_id", "part").agg(F.max_by(F.struct("a", "b"), "pos").alias("end"))
    carried = ends.select("conv_id", "part", total("a").alias("ca"), total("b").alias("cb")).where("ca is not null")  # one a task at most
    sums = local.join(F.broadcast(carried), ["conv_id", "part"], "left")
    whole = lambda c, carry: ((F.col(c) + F.coalesce(carry, F.lit(0))) % PRIME).alias(c[-1])
    key = lambda depth, x, y: F.struct(depth.alias("depth"), whole(x, "ca"), whole(y, "cb"))
    return sums.select("conv_id", key(F.col("pos"), "a", "b").alias("node"), key(F.col("pos") - 1, "pa", "pb").alias("parent"), "bytes", "last")


def _ends(members: DataFrame, spec: TrieSpec) -> DataFrame:
    """node, ends_sha256: of the ids (node, conv_id) that end at a node, ascending, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, node, texts, size, no, first = TaskContext.get().partitionId(), None, [], 0, 0, True
        out: list[tuple] = []

        def taken(done: bool) -> None:
            nonlocal texts, size, no
            if not texts:  # a piece ended just here
                return
            text = ",".join(texts)
            alone = done and no == 0 and not first
            out.append((*node, part, no, None if alone else text, hashlib.sha256(text.encode()).hexdigest() if alone else None))
            texts, size, no = [], 0, no + 1

        def flushed() -> pa.RecordBatch:
            drawn = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(drawn, kinds, strict=True)], names=["depth", "a", "b", "part", "no", "text", "sha"])

        for batch in batches:
            for *own, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "conv_id")), strict=True):
                if own != node:
                    if node is not None:
                        taken(True)
                        first = False
                    node, no = own, 0
                texts.append(str(conv))
                size += len(texts[-1]) + 1
                if size >= spec.piece:
                    taken(False)
            yield flushed()
        if node is not None:
            first = True  # the last node may go on in the next task
            taken(False)
            yield flushed()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *own, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "text")), strict=True):
                if own != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            drawn = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(drawn, [pa.int64()] * 3 + [pa.string()], strict=True)], names=["depth", "a", "b", "sha"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in node), pa.array([digest.hexdigest()])], names=["depth", "a", "b", "sha"])

    order = ["depth", "a", "b", "conv_id"]
    sort = members.select("node.*", "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(sort.mapInArrow(trimmed(pieces), "depth long, a long, b long, part int, no int, text string, sha string"), "trie-ends")
    spread = found.where("sha is null").repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "part", "no").select("depth", "a", "b", "text")
    whole = spread.mapInArrow(trimmed(hashed), "depth long, a long, b long, sha string")
    return found.where("sha is not null").select("depth", "a", "b", "sha").unionByName(whole).select(F.struct("depth", "a", "b").alias("node"), F.col("sha").alias("ends_sha256"))


def _rolled_up(nodes: DataFrame, spec: TrieSpec) -> DataFrame:
    """node, n_leaves, saved over each subtree; ``nodes`` has node, parent (null: the root), leaf and saved of each."""
    state = nodes.select("node", F.col("parent").alias("up"), F.col("leaf").alias("n_leaves"), "saved")
    deepest = nodes.agg(F.max("node.depth").alias("d")).first()["d"] or 0
    for k in range(min(deepest.bit_length(), spec.max_rounds)):
        # up is the ancestor 2 ** k turns above; the totals cover all that lies less than that below.
        sent = state.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        added = state.join(sent, "node", "left").select("node", "up", (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        far = F.col("node.depth") >= 1 << k + 1
        jump = state.where(far).select(F.col("node").alias("down"), F.col("up").alias("at")).join(state.select(F.col("node").alias("at"), F.col("up").alias("next")), "at")
        moved = added.where(far).join(jump.select(F.col("down").alias("node"), "next"), "node").select("node", F.col("next").alias("up"), "n_leaves", "saved")
        state = stored(moved.unionByName(added.where(~far).withColumn("up", F.lit(None).cast(NODE))), "trie-totals")
    return state.select("node", "n_leaves", "saved")


def prefix_trie(conversations: DataFrame, turns: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """A row for every node of the trie of ``turns`` (conv_id, pos, digest, bytes, last) of ``conversations`` (conv_id, length).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths = _prefixes(turns)
    root = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    top = conversations.select("conv_id", root.alias("node"), F.lit(None).cast(NODE).alias("parent"), F.lit(0).cast("long").alias("bytes"), (F.col("length") == 0).alias("last"))
    paths = stored(paths.unionByName(top), "trie-paths")
    members = paths.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"))
    members = stored(members, "trie-members")
    children = members.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = members.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = stored(nodes, "trie-nodes")
    totals = _rolled_up(nodes, spec)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = _ends(paths.where("last").select("node", "conv_id"), spec)
    found = nodes.join(totals.withColumnRenamed("saved", "saved_tokens"), "node").join(ends, "node", "left").join(parents, "parent", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
