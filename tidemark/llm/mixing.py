"""Mixing sources to target weights by entropy balancing.

Rates ``w`` over documents minimise the relative entropy to one copy each, subject to every source's words meeting
its target and ``0 <= w <= cap``. The solution tilts exponentially in a document's size,
``w = min(cap, exp(dual[source] * size / scale[source]))``, and the convex dual is solved by safeguarded Newton steps.
Spark evaluates each step's gradient and curvature over a (source, size) histogram, so that a hot source costs no more
than its distinct sizes; duals, brackets and targets are a table with a row per source, of any number.

Rates become whole copies by thresholds: a document's place is a hash of its id and text less its rate's fraction, cut
into ``bins``, and it gets its extra copy if its bin is below the threshold of its source and size class. Thresholds
are set from the largest class to the smallest, each making up for what the classes above it missed. So copies depend
on a document and a row of its source alone: ``mixed`` moves no texts, and a source's total misses its target by a
small document or about a ``bins``-th part of its smallest classes. Sums are exact decimals, so that reruns agree.

Nulls: a null text has size 0; a null source is a source of its own and comes last; a null doc_id is allowed.
Equal rows get the same number of copies. Empty tables give empty results. Other columns pass through ``mixed``; input
columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, shipped, stored, word_count


@dataclass(frozen=True)
class MixRecipe:
    """weights repeat over the sources in code point order (null last); ``share`` of all words is asked for."""

    weights: Sequence[float] = (3.0, 1.0, 2.0)
    share: float = 1.5
    cap: float = 2.0
    bins: int = 1024
    tolerance: float = 1e-7
    max_steps: int = 60
    #: Tables of up to so many sources (some hundred bytes each) are sent to every executor, larger ones joined.
    broadcast_sources: int = 20_000


def _exact(value: Column) -> Column:
    """For sums that don't depend on the order of their terms."""
    return value.cast("decimal(38,9)")


def _ranked(sources: DataFrame) -> DataFrame:
    """With ``at``: the place of each row by source, null last. Ranges are numbered apart and then put behind each other."""
    dealt = stored(sources.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source")).withColumn("_id", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("_id", 33)
    counts = sorted((r["p"], r["n"]) for r in dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # a row per partition
    offsets, before = [], 0
    for p, n in counts:
        offsets += [F.lit(p), F.lit(before)]
        before += n
    offset = F.element_at(F.create_map(*offsets), part) if offsets else F.lit(0)
    return dealt.withColumn("at", offset + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id")


def source_targets(histogram: DataFrame, recipe: MixRecipe = MixRecipe()) -> DataFrame:
    """source, at (its place), words, scale, target for each source of a histogram (source, size, n).

    Sources share ``share`` of all words by weight; what a cap cuts off is shared again by weight.
    """
    n, size = F.col("n"), F.col("size")
    sums = histogram.groupBy("source").agg(F.sum(n * size).alias("words"), F.sum(n.cast("decimal(19,0)") * size.cast("decimal(12,0)") * size.cast("decimal(12,0)")).cast("double").alias("squares"))
    weights = F.array(*(F.lit(float(w)) for w in recipe.weights))
    table = stored(_ranked(sums).withColumn("weight", F.element_at(weights, (F.col("at") % len(recipe.weights) + 1).cast("int"))), "mix-sources")
    most = recipe.cap * F.col("words")
    total = int(table.agg(F.sum("words")).first()[0] or 0)
    unit, free = 0.0, None
    while True:
        # Each step caps at least one more source, as the unit rises.
        above = F.col("weight") * unit > most
        now = table.agg(F.sum(F.when(above, most)).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("weight"), F.count_if(~above).alias("free")).first()
        if not now["weight"] or now["free"] == free:
            break
        free, unit = now["free"], max(0.0, recipe.share * total - (now["capped"] or 0.0)) / now["weight"]
    target = F.when(F.col("weight") * unit > most, most).otherwise(F.col("weight") * unit) if now["weight"] else most
    scale = F.when(F.col("words") > 0, F.col("squares") / F.col("words")).otherwise(1.0)
    return table.select("source", "at", "words", scale.alias("scale"), target.alias("target"))


def _met(a: DataFrame, b: DataFrame, recipe: MixRecipe, few: bool) -> DataFrame:
    """Rows of ``a`` with those of the table ``b`` of sources, null equal to null."""
    named = b.withColumnRenamed("source", "_source")
    return a.join(F.broadcast(named) if few else named, a["source"].eqNullSafe(named["_source"])).drop("_source")


def solved(histogram: DataFrame, sources: DataFrame, recipe: MixRecipe = MixRecipe()) -> DataFrame:
    """``sources`` with the dual of each; null where the rate is the cap (or the source has no words)."""
    few = sources.count() <= recipe.broadcast_sources
    log_cap = math.log(recipe.cap)
    words, target, dual = F.col("words"), F.col("target"), F.col("dual")
    inside = (words > 0) & (target < recipe.cap * words * (1 - 1e-12))
    state = sources.withColumn("dual", F.when(inside, F.log(F.greatest(target, 1e-9 * words) / words)))
    state = stored(state.select("*", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), inside.alias("active")), "mix-duals")
    for _ in range(recipe.max_steps):
        now = state.where("active")
        if now.isEmpty():
            break
        scaled = F.col("size") / F.col("scale")
        taken = F.col("n") * F.col("size") * F.exp(F.least(dual * scaled, F.lit(log_cap)))
        slope = F.when(dual * scaled < log_cap, taken * scaled).otherwise(0.0)
        placed = _met(histogram, now.select("source", "at", "scale", "dual"), recipe, few)
        sums = placed.groupBy("at").agg(F.sum(_exact(taken)).cast("double").alias("taken"), F.sum(_exact(slope)).cast("double").alias("slope"))
        joined = state.join(F.broadcast(sums) if few else sums, "at", "left")
        miss = F.col("taken") - target
        done = ~F.col("active") | (F.abs(miss) <= recipe.tolerance * target)
        low, high = F.when(miss > 0, F.col("low")).otherwise(dual), F.when(miss > 0, dual).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, dual - miss / F.col("slope"))
        good = step.isNotNull() & (low.isNull() | (step > low)) & (high.isNull() | (step < high))
        halved = F.coalesce((low + high) / 2, dual - F.signum(miss) * F.greatest(F.lit(1.0), F.abs(dual)))
        following = F.when(done, dual).when(good, step).otherwise(halved)
        state = stored(joined.select(*sources.columns, following.alias("dual"), F.when(done, F.col("low")).otherwise(low).alias("low"), F.when(done, F.col("high")).otherwise(high).alias("high"), (~done & (following != dual)).alias("active")), "mix-duals")
    return state.select(*sources.columns, "dual")


def _rate(recipe: MixRecipe) -> Column:
    tilt = F.least(F.col("dual") * F.col("size") / F.col("scale"), F.lit(math.log(recipe.cap)))
    return F.when(F.col("size") == 0, 1.0).when(F.col("dual").isNull(), F.lit(float(recipe.cap))).otherwise(F.exp(tilt))


def _sized(docs: DataFrame) -> list[Column]:
    """Size, and a hash of id and text in [0, 1), of each row."""
    return [word_count(docs["text"]).alias("size"), (F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(1 << 30)) / float(1 << 30)).alias("u")]


def _fraction() -> Column:
    return F.col("rate") - F.floor("rate")


def _size_class() -> Column:
    return F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")


def _bin(recipe: MixRecipe) -> Column:
    return F.floor((F.col("u") - _fraction() + 1) * (recipe.bins / 2)).cast("int")


def _thresholds(bins: int):
    """For one source: (size_class, bin, words, wanted) to the first bin of each class that gets no extra copy."""

    def run(table: pa.Table) -> pa.Table:
        carry, out = 0.0, []
        rows = sorted((-r["size_class"], r["bin"], float(r["words"]), float(r["wanted"])) for r in table.to_pylist())
        for size_class, group in groupby(rows, key=lambda r: r[0]):
            own = list(group)
            need = carry + math.fsum(r[3] for r in own)
            reached = list(accumulate((r[2] for r in own), initial=0.0))
            best = min(range(len(reached)), key=lambda k: (abs(need - reached[k]), k))
            out.append({"at": table["at"][0].as_py(), "size_class": -size_class, "threshold": own[best][1] if best < len(own) else bins})
            carry = need - reached[best]
        return pa.Table.from_pylist(out, pa.schema([("at", pa.int64()), ("size_class", pa.int32()), ("threshold", pa.int32())]))

    return run


def mix_plan(rows: DataFrame, recipe: MixRecipe = MixRecipe()) -> DataFrame:
    """A row per source with what the copies of its documents follow from; ``rows`` has source, size and u.

    source, source_size, scale, target, dual, thresholds (a map from size classes).
    """
    histogram = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    sources = solved(histogram, source_targets(histogram, recipe), recipe)
    few = sources.count() <= recipe.broadcast_sources
    open_rows = _met(rows.where("size > 0"), sources, recipe, few).withColumn("rate", _rate(recipe)).where(_fraction() > 0)
    binned = open_rows.groupBy("at", _size_class().alias("size_class"), _bin(recipe).alias("bin")).agg(F.sum("size").alias("words"), F.sum(_exact(F.col("size") * _fraction())).alias("wanted"))
    # Size classes times bins rows of a source at most.
    cut = binned.groupBy("at").applyInArrow(_thresholds(recipe.bins), "at long, size_class int, threshold int")
    by_source = cut.groupBy("at").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("size_class", "threshold")))).alias("thresholds"))
    plan = sources.join(F.broadcast(by_source) if few else by_source, "at", "left").select("source", F.col("words").alias("source_size"), "scale", "target", "dual", "thresholds")
    return stored(plan, "mix-plan")


def _with_copies(rows: DataFrame, plan: DataFrame, recipe: MixRecipe) -> DataFrame:
    few = plan.count() <= recipe.broadcast_sources
    extra = (_fraction() > 0) & (_bin(recipe) < F.coalesce(F.try_element_at("thresholds", _size_class()), F.lit(0)))
    return _met(rows, plan, recipe, few).withColumn("rate", _rate(recipe)).withColumn("copies", F.floor("rate") + extra.cast("long"))


def mix_sizes(docs: DataFrame, recipe: MixRecipe = MixRecipe()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, rate, copies."""
    shipped(docs.sparkSession)
    rows = stored(docs.select("doc_id", docs["source"].cast("string").alias("source"), *_sized(docs)), "mix-sizes")
    return _with_copies(rows, mix_plan(rows, recipe), recipe).select("doc_id", "source", "size", "source_size", "target", "rate", "copies")


def mixed(docs: DataFrame, recipe: MixRecipe = MixRecipe()) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as it has copies."""
    shipped(docs.sparkSession)
    rows = stored(docs.select(docs["source"].cast("string").alias("source"), *_sized(docs)), "mix-sizes")
    row = free_name(docs, "_row")
    chosen = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias(row), docs["source"].cast("string").alias("source"), *_sized(docs))
    copied = _with_copies(chosen, mix_plan(rows, recipe), recipe)
    return copied.select(row, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(f"{row}.*")
