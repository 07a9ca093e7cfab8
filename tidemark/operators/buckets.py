"""Token buckets over event streams: who is let through when arrivals come faster than tokens.

A bucket holds ``burst`` tokens at most and gains ``rate`` a second. Each event takes one if there is one; an event of low
priority that finds none is shed, all others pass all the same. Tokens come in whole seconds.

What a second does to the level is a capped addition: level -> clamp(level + a, low, high). Such maps compose to one of
the same form, also over the seconds between, in which the bucket only fills. So the levels follow from a prefix scan
that has a row for each second with events: seconds are composed in groups, groups in groups of groups, until one is left;
then the levels go back down. No task ever holds more than ``width`` seconds in one array.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A composed stretch of time: its first and last second, and level -> least(high, greatest(low, level + a)).
STRETCH = "struct<first: bigint, last: bigint, a: bigint, low: bigint, high: bigint>"


@dataclass(frozen=True)
class Bucket:
    rate: int = 1000
    burst: int = 2000
    width: int = 128


@dataclass(frozen=True)
class Level:
    """Where an earlier batch left the bucket: the tokens after the events of a second."""

    second: int
    tokens: int


def _clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(high, F.greatest(low, value))


def _stretch(first: Column, last: Column, a: Column, low: Column, high: Column) -> Column:
    fields = zip((first, last, a, low, high), ("first", "last", "a", "low", "high"), strict=True)
    return F.struct(*(c.cast("long").alias(n) for c, n in fields))


def _then(x: Column, y: Column) -> Column:
    """First x, then y."""
    low, high = (_clamp(x[c] + y["a"], y["low"], y["high"]) for c in ("low", "high"))
    return _stretch(x["first"], y["last"], x["a"] + y["a"], low, high)


def _filled(x: Column, until: Column, bucket: Bucket) -> Column:
    """x, and then the tokens that come until a later second."""
    gain, zero, full = (until - x["last"]) * bucket.rate, F.lit(0), F.lit(bucket.burst)
    return _then(x, _stretch(x["last"], until, gain, zero, full))


def _composed(x: Column, y: Column, bucket: Bucket) -> Column:
    return F.when(x.isNull(), y).otherwise(_then(_filled(x, y["first"], bucket), y))


def _groups(stretches: DataFrame, size: int) -> DataFrame:
    """Stretches (first, s) by ranges of ``size`` seconds: g, and the ordered array of a range's stretches."""
    return stretches.groupBy(F.floor(F.col("first") / size).cast("long").alias("g")).agg(F.array_sort(F.collect_list("s")).alias("all"))


def _levels(stretches: DataFrame, bucket: Bucket, start: Level | None, size: int) -> DataFrame:
    """first, level: the tokens at the beginning of every stretch; ranges of ``size`` seconds hold ``width`` stretches at most."""
    groups = _groups(stretches, size)
    one = F.aggregate("all", F.lit(None).cast(STRETCH), lambda x, y: _composed(x, y, bucket))
    whole = groups.select(one.alias("s")).select("s.first", "s")
    # What is known of the ranges' beginnings: by the same way, of ranges of ranges; or of the start alone.
    if whole.limit(2).count() < 2:
        begun = whole.select("first", _from_start(F.col("first"), bucket, start).alias("level"))
    else:
        begun = _levels(whole, bucket, start, size * bucket.width)
    # Down again: each stretch's level from the one before it in its range.
    state = "struct<last: bigint, level: bigint, out: array<struct<first: bigint, level: bigint>>>"

    def step(x: Column, y: Column) -> Column:
        level = F.when(x["last"].isNull(), x["level"]).otherwise(F.least(F.lit(bucket.burst), x["level"] + (y["first"] - x["last"]) * bucket.rate))
        after = _clamp(level + y["a"], y["low"], y["high"])
        return F.struct(y["last"].alias("last"), after.cast("long").alias("level"), F.concat(x["out"], F.array(F.struct(y["first"].alias("first"), level.cast("long").alias("level")))).alias("out")).cast(state)

    joined = groups.withColumn("first", F.col("all")[0]["first"]).join(begun, "first")
    zero = F.struct(F.lit(None).cast("long").alias("last"), F.col("level"), F.array().cast("array<struct<first: bigint, level: bigint>>").alias("out")).cast(state)
    return joined.select(F.explode(F.aggregate("all", zero, step)["out"]).alias("o")).select("o.*")


def _from_start(first: Column, bucket: Bucket, start: Level | None) -> Column:
    if start is None:
        return F.lit(bucket.burst).cast("long")
    return F.least(F.lit(bucket.burst), F.lit(start.tokens) + (first - start.second) * bucket.rate).cast("long")


def bucket_levels(arrivals: DataFrame, bucket: Bucket = Bucket(), start: Level | None = None) -> DataFrame:
    """second, level (tokens when it begins), after (tokens when its events are done) of arrivals (second, n), one row a second.

    A bucket is full at first unless ``start`` says where it was left; seconds up to that of ``start`` gain nothing.
    """
    # A second with n events leaves max(0, level - n), which is at most what a full bucket would leave.
    high = F.greatest(F.lit(0), F.lit(bucket.burst) - F.col("n"))
    one = _stretch(F.col("second"), F.col("second"), -F.col("n"), F.lit(0), high)
    stretches = arrivals.select(F.col("second").alias("first"), one.alias("s"))
    levels = _levels(stretches, bucket, start, bucket.width)
    return arrivals.join(levels.withColumnRenamed("first", "second"), "second").select("second", "n", "level", F.greatest(F.lit(0), F.col("level") - F.col("n")).cast("long").alias("after"))


def last_level(levels: DataFrame, start: Level | None = None) -> Level | None:
    """What the next batch begins with; ``start`` without events. Late events don't turn the clock back."""
    row = levels.orderBy(F.desc("second")).select("second", "after").first()
    if row is None:
        return start
    return Level(max(row["second"], start.second) if start else row["second"], row["after"])


def arrivals_of(events: DataFrame, time: str) -> DataFrame:
    """second, n: how many events each second has; those without a time aren't counted."""
    return events.where(F.col(time).isNotNull()).groupBy(F.unix_seconds(F.col(time).cast("timestamp")).alias("second")).agg(F.count("*").alias("n"))


def marked(events: DataFrame, time: str, tie: str, mark: str, low: Column, bucket: Bucket = Bucket(), start: Level | None = None) -> DataFrame:
    """``events`` with a boolean column ``mark``: whether they pass; those that are not ``low`` always do.

    Within a second events come by time, then ``tie``, which tells events of one time apart. Of each second only the
    first ``burst`` events are ranked, task by task before they meet; the place of the last token is then compared with
    all events, which stay where they are in a second's join. Events without a time pass.
    """
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    place = F.struct(F.col(time).alias("t"), F.col(tie).alias("i"))
    timed = events.where(F.col(time).isNotNull()).select(second.alias("second"), place.alias("place"))
    levels = bucket_levels(arrivals_of(events, time), bucket, start).where("level < n")
    ranked = timed.withColumn("rank", F.row_number().over(Window.partitionBy("second").orderBy("place"))).where(F.col("rank") <= bucket.burst)
    cut = ranked.join(levels, "second").where("rank <= level").groupBy("second").agg(F.max("place").alias("cut"))
    short = levels.join(cut, "second", "left").select(F.col("second").alias("_second"), F.lit(True).alias("_short"), F.col("cut").alias("_cut"))
    met = events.join(short, second == F.col("_second"), "left")
    # Without a cut the second began with no token at all.
    passes = ~F.coalesce(low, F.lit(False)) | F.col("_short").isNull() | F.coalesce(place <= F.col("_cut"), F.lit(False))
    return met.select(*(events[c] for c in events.columns), passes.alias(mark))


def limited(events: DataFrame, time: str, tie: str, priority: str = "priority", bucket: Bucket = Bucket(), start: Level | None = None) -> DataFrame:
    """``events`` without those of low priority that find no token (see ``marked``)."""
    return marked(events, time, tie, "_passes", F.col(priority) == "low", bucket, start).where("_passes").drop("_passes")
