"""Change logs: rows with an action (insert, update, delete), a sequence and a payload, and what they amount to.

The last change of a key is found by aggregation, not by a window: each task first merges its own changes of a key,
so that a key with a third of all changes costs one row per task. Ties of the sequence go to the greatest payload, or,
where the payload holds maps, which have no order, to the greatest JSON text of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "action"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores added until it is none of ``taken``, whatever the case of letters."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def _best(changes: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    rest = [c for c in changes.columns if c not in keys and c not in order]
    payload = F.struct(*(F.col(c) for c in (*order, *rest)))
    unordered = any("map<" in changes.schema[c].dataType.simpleString() for c in rest)
    place = F.struct(*(F.col(c) for c in order), F.to_json(payload).alias("_text")) if unordered else payload
    best = (F.max_by if last else F.min_by)(payload, place).alias("_best")
    return changes.groupBy(*keys).agg(best).select(*(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in changes.columns))


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of every key."""
    return _best(changes, keys, order, last=True)


def first_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first change of every key."""
    return _best(changes, keys, order, last=False)


def state_of(changes: DataFrame, keys: Sequence[str], order: Sequence[str], action: str = ACTION) -> DataFrame:
    """The rows that a change log leaves: the last change of each key, unless it is a delete."""
    return latest_changes(changes, keys, order).where(F.col(action) != DELETE).drop(action)


def delete_keys(table: DataFrame, gone: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``table`` without the rows whose key is in ``gone``, null equal to null; without keys, all shared columns count."""
    keys = list(keys) or [c for c in table.columns if c in gone.columns]
    if not keys:
        raise ValueError("nothing to delete by: no key and no shared column")
    named = gone.select(*(F.col(k).alias(f"_gone_{i}") for i, k in enumerate(keys))).distinct()
    met = F.lit(True)
    for i, k in enumerate(keys):
        met = met & table[k].eqNullSafe(named[f"_gone_{i}"])
    return table.join(named, met, "left_anti")


def delete_all(table: DataFrame) -> DataFrame:
    """``table`` without its rows."""
    return table.where(F.lit(False))


def key_errors(keys: Sequence[str], action: str = ACTION) -> Column:
    """An error text for deletes that name no key: without key columns, or with none that has a value."""
    named = F.coalesce(*(F.col(k).cast("string") for k in keys)).isNotNull() if keys else F.lit(False)
    return F.when((F.col(action) == DELETE) & ~named, F.lit("delete needs a key"))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], policy: str = "REPLACE") -> DataFrame:
    """``rows`` written into ``table``: REPLACE overwrites a key, IGNORE keeps what is there, "" appends.

    ``rows`` must hold each key once (see ``latest_changes``). Columns that one side lacks are null.
    """
    if policy == "REPLACE":
        return delete_keys(table, rows, keys).unionByName(rows, allowMissingColumns=True)
    if policy == "IGNORE":
        return table.unionByName(delete_keys(rows, table, keys), allowMissingColumns=True)
    if policy == "":
        return table.unionByName(rows, allowMissingColumns=True)
    raise ValueError(f"no such conflict policy: {policy}")


def apply_changes(table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], policy: str = "REPLACE", action: str = ACTION) -> DataFrame:
    """``table`` after a change log. With IGNORE, changes of a key that is there are dropped unless they delete it."""
    last = latest_changes(changes, keys, order)
    kept = delete_keys(table, last.where(F.col(action) == DELETE), keys)
    rows = last.where(F.col(action) != DELETE).drop(action, *order)
    return upsert(kept, rows, keys, policy or "REPLACE")


def merged_columns(changes: DataFrame, keys: Sequence[str], order: Sequence[str], action: str = ACTION) -> DataFrame:
    """The rows that a log of partial writes leaves: for each column the last write that set it; null sets nothing.

    Deletes are barriers: what was set before a key's last delete is gone, and so is a key without a later write. It takes
    one aggregation with partial merging, as the last write of a column stands exactly if it is later than the last
    delete. Writes of one sequence set a column to its greatest value; at the sequence of a delete the delete stands. Any
    split and order of batches gives the same rows.
    """
    columns = [c for c in changes.columns if c not in (*keys, *order, action)]
    place, gone = F.struct(*(F.col(o) for o in order)), F.col(action) == DELETE
    told = lambda c: F.to_json(F.struct(c)) if "map<" in changes.schema[c].dataType.simpleString() else F.col(c)
    last = lambda c: F.max_by(F.struct(place.alias("at"), F.col(c).alias("v")), F.when(F.col(c).isNotNull() & ~gone, F.struct(place, told(c))))
    every = changes.groupBy(*keys).agg(F.max(F.when(gone, place)).alias("_gone"), F.max(F.when(~gone, place)).alias("_last"), *(last(c).alias(f"_set_{i}") for i, c in enumerate(columns)))
    later = lambda at: F.col("_gone").isNull() | (at > F.col("_gone"))
    return every.where(later(F.col("_last"))).select(*keys, *(F.when(later(F.col(f"_set_{i}.at")), F.col(f"_set_{i}.v")).alias(c) for i, c in enumerate(columns)))


def partial_update(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the same key overwrite the columns they have a value for; new keys are added. ``rows`` hold a key once."""
    new = rows.select(*(F.col(c).alias(f"_new_{c}") for c in rows.columns))
    met = F.lit(True)
    for k in keys:
        met = met & table[k].eqNullSafe(new[f"_new_{k}"])
    joined = table.join(new, met, "full")
    columns = [*table.columns, *(c for c in rows.columns if c not in table.columns)]
    return joined.select(*(F.coalesce(*([F.col(f"_new_{c}")] if c in rows.columns else []), *([table[c]] if c in table.columns else [])).alias(c) for c in columns))


def with_before(changes: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], width: int = 100_000) -> DataFrame:
    """Each change with the images of ``columns`` before it (``before_<name>``); equal orders come in no set order.

    A key's changes are cut into ranges of ``width`` of the first order column, a number or a time (in seconds), so that
    a hot key is spread over tasks. What a range leaves is found by aggregation and enters the next one as its first row.
    """
    image = F.struct(*(F.col(c).alias(f"i{i}") for i, c in enumerate(columns)))
    key, place = [f"k{i}" for i in range(len(keys))], [f"o{i}" for i in range(len(order))]
    named = [*(F.col(c).alias(k) for c, k in zip(keys, key, strict=True)), *(F.col(c).alias(o) for c, o in zip(order, place, strict=True))]
    cut = changes.select(F.struct(*changes.columns).alias("row"), *named, F.floor(F.col(order[0]).cast("double") / width).alias("range"), image.alias("image"))
    left = cut.groupBy(*key, "range").agg(F.max_by("image", F.struct(*place)).alias("image"))
    entering = left.withColumn("image", F.lag("image").over(Window.partitionBy(*key).orderBy("range"))).where("image is not null")
    both = cut.withColumn("own", F.lit(1)).unionByName(entering.withColumn("own", F.lit(0)), allowMissingColumns=True)
    seen = both.withColumn("was", F.lag("image").over(Window.partitionBy(*key, "range").orderBy("own", *place))).where("own = 1")
    return seen.select("row.*", *(F.col(f"was.i{i}").alias(f"before_{c}") for i, c in enumerate(columns)))


def routed_changes(changes: DataFrame, keys: Sequence[str], where: str = "", carried: Sequence[str] = (), before: str = "before", after: str = "data", action: str = ACTION) -> tuple[DataFrame, str]:
    """Events with before and after images as plain changes, by a filter on rows; and the name of their envelope.

    The result has the image's columns and one struct (``_change``, with underscores added where the image has that name)
    of action, part and the columns named in ``carried``, so that no name of a row clashes with the envelope's.

    A filter makes of the log the log of a view. A row that enters it is inserted, one that stays is updated, one that
    leaves it is deleted; what is outside before and after is passed over. Where the image before is not known, a row that
    is outside after counts as leaving. Deletes pass, as their image may hold the key alone. An update that changes its
    key is a delete of the old key (part 0) and an upsert of the new one (part 1). Without a key nothing can leave.
    """
    names = changes.select(f"{after}.*").columns
    envelope = free_name(names, "_change")
    event, inside, was = (free_name(names, n) for n in ("_event", "_inside", "_was"))
    packed = changes.select(F.struct(*changes.columns).alias(event))
    old, new = F.col(f"{event}.`{before}`"), F.col(f"{event}.`{after}`")
    does = F.col(f"{event}.`{action}`")
    if where:
        passes = F.coalesce(F.expr(where), F.lit(False))
        packed = packed.select(event, f"{event}.`{after}`.*").select(event, passes.alias(inside))
        packed = packed.select(event, inside, f"{event}.`{before}`.*").select(event, inside, passes.alias(was))
    else:
        packed = packed.withColumns({inside: F.lit(True), was: F.lit(True)})
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~old.getField(k).eqNullSafe(new.getField(k))
    moved = moved & old.isNotNull()
    part = lambda what, n, image: F.struct(what.alias("a"), F.lit(n).alias("p"), image.alias("r"))
    nothing = F.array().cast(packed.select(F.array(part(does, 1, new))).schema[0].dataType)
    gone = lambda image: F.array(part(F.lit(DELETE), 1, image)) if keys else nothing
    stays = F.array(part(F.when(F.col(was), does).otherwise(F.lit(INSERT)), 1, new))
    leaves = F.when(F.col(was) | old.isNull(), gone(F.coalesce(old, new))).otherwise(nothing)
    left = F.when(F.col(was), F.array(part(F.lit(DELETE), 0, old))).otherwise(nothing)
    parts = (
        F.when(does == DELETE, F.array(part(does, 1, F.coalesce(old, new))))
        .when(does == INSERT, F.when(F.col(inside), F.array(part(does, 1, new))).otherwise(nothing))
        .when(moved, F.concat(left, F.when(F.col(inside), F.array(part(does, 1, new))).otherwise(nothing)))
        .when(F.col(inside), F.when(old.isNull(), F.array(part(does, 1, new))).otherwise(stays))
        .otherwise(leaves)
    )
    spread = packed.select(event, F.explode(parts).alias(inside))
    own = F.struct(F.col(f"{inside}.a").alias(ACTION), F.col(f"{inside}.p").alias("part"), *(F.col(f"{event}.`{c}`").alias(c) for c in carried))
    return spread.select(*(F.col(f"{inside}.r.`{n}`").alias(n) for n in names), own.alias(envelope)), envelope


def normalised(changes: DataFrame, keys: Sequence[str], before: str = "before", after: str = "data", action: str = ACTION) -> DataFrame:
    """Events with before and after images (structs) as plain changes: action, part, and the image's columns.

    An update that changes its key becomes a delete of the old key (part 0) and an upsert of the new one (part 1).
    """
    names = changes.select(f"{after}.*").columns
    rest = [c for c in changes.columns if c not in (before, after, action)]
    moved = F.lit(False)
    for k in keys:
        moved = moved | (F.col(before).isNotNull() & ~F.col(f"{before}.{k}").eqNullSafe(F.col(f"{after}.{k}")))
    image = F.when(F.col(action) == DELETE, F.coalesce(F.col(before), F.col(after))).otherwise(F.col(after))
    own = F.struct(F.col(action).alias("a"), F.lit(1).alias("p"), image.alias("r"))
    old = F.struct(F.lit(DELETE).alias("a"), F.lit(0).alias("p"), F.col(before).alias("r"))
    parts = F.when((F.col(action) == UPDATE) & moved, F.array(old, own)).otherwise(F.array(own))
    spread = changes.select(*rest, F.explode(parts).alias("_part"))
    return spread.select(*rest, F.col("_part.a").alias(action), F.col("_part.p").alias("part"), *(F.col(f"_part.r.{n}").alias(n) for n in names))
