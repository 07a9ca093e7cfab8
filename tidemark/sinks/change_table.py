"""A keyed table on plain files: batches of changes, merged when they are read, published version by version.

Each micro-batch is written to a folder of its own and then named in the table's manifest (see ``manifest``); a batch that
is sent again publishes a new folder in the place of the old one, so that replays change nothing and a reader sees all
rows of one version while they run. ``compact`` publishes a base in the place of what it read. Where the cluster has a
table format with MERGE, use that; these files need nothing but Spark and a shared store.

A row and its envelope (sequence and action) are stored as two structs, so that rows may have columns of any name. A
version knows the schema of each folder: where it differs from the table's, columns are added or widened when they are
read, never narrowed (see ``widening``); a batch that fits no common schema is refused.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.widening import widened, widened_schema
from ..operators.changes import ACTION, DELETE, merged_columns
from .manifest import Manifest, Version

ROW, CHANGE, BASE = "row", "change", "base"


@dataclass(frozen=True)
class ChangeTable:
    """``schema``: the row's columns. ``order``: fields of the changes that give their sequence."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[tuple[str, str], ...] = (("seq", "bigint"),)
    policy: str = "REPLACE"

    def __post_init__(self):
        if self.policy and not self.keys:
            raise ValueError(f"{self.policy} needs a primary key")

    @property
    def _envelope(self) -> T.StructType:
        return T.StructType([*(T.StructField(n, T._parse_datatype_string(k)) for n, k in self.order), T.StructField(ACTION, T.StringType())])

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([T.StructField(ROW, self.schema), T.StructField(CHANGE, self._envelope)])

    def append(self, batch_id: int | str, changes: DataFrame, writer: str = "main", envelope: str = "") -> None:
        """Writes a batch's changes; columns that it lacks are null. Writers (queries) number their batches apart.

        Sequence and action are columns, or fields of the struct named ``envelope``.
        """
        taken = lambda fields, name: F.struct(*(name(f.name).cast(f.dataType).alias(f.name) for f in fields))
        of_row = lambda n: F.col(f"`{n}`") if n in changes.columns else F.lit(None)
        of_change = (lambda n: F.col(f"`{envelope}`.`{n}`")) if envelope else of_row
        rows = changes.select(taken(self.schema, of_row).alias(ROW), taken(self._envelope, of_change).alias(CHANGE))
        if self.policy == "REPLACE":  # one row for each key and batch is enough where the last one wins
            rows = self._best(rows, last=True)
        name, kind = f"{writer}/{batch_id}", self._kind()
        manifest = Manifest(changes.sparkSession, self.path)
        self._whole(manifest.current())  # refuses what doesn't fit, before anything is written
        folder = f"{kind}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{folder}")
        manifest.commit(lambda v: None if name in v.done else replace(v, folders=v.folders | {name: folder}, kinds=v.kinds | {kind: self.schema.json()}))

    def _kind(self) -> str:
        return hashlib.sha256(self.schema.json().encode()).hexdigest()[:16]

    def _whole(self, version: Version) -> ChangeTable:
        """This table with the schema that holds its own rows and all that are stored."""
        schema = self.schema
        for kind in version.kinds.values():
            schema = widened_schema(schema, T.StructType.fromJson(json.loads(kind)))
        return replace(self, schema=schema)

    def _place(self) -> Column:
        """The place of a change: by its sequence, then by its row and action, or their text where maps have no order."""
        text = F.to_json(F.struct(ROW, f"{CHANGE}.{ACTION}"))
        own = [text] if "map<" in self.schema.simpleString() else [F.col(ROW), F.col(f"{CHANGE}.{ACTION}")]
        return F.struct(*(F.col(f"{CHANGE}.`{n}`") for n, _ in self.order), *own)

    def _keys(self) -> list[Column]:
        return [F.col(f"{ROW}.`{k}`").alias(f"_key_{i}") for i, k in enumerate(self.keys)]

    def _best(self, rows: DataFrame, last: bool) -> DataFrame:
        best = (F.max_by if last else F.min_by)(F.struct(ROW, CHANGE), self._place()).alias("best")
        return rows.groupBy(*self._keys()).agg(best).select("best.*")

    def _alive(self, rows: DataFrame) -> DataFrame:
        """Rows that were written after their key's last delete."""
        if not self.keys:
            return rows.where(F.col(f"{CHANGE}.{ACTION}") != DELETE)
        order = F.struct(*(F.col(f"{CHANGE}.`{n}`") for n, _ in self.order))
        gone = rows.where(F.col(f"{CHANGE}.{ACTION}") == DELETE).groupBy(*self._keys()).agg(F.max(order).alias("_gone"))
        named = gone.select("_gone", *(F.col(f"_key_{i}").alias(f"_g{i}") for i in range(len(self.keys))))
        met = F.lit(True)
        for i, k in enumerate(self.keys):
            met = met & F.col(f"{ROW}.`{k}`").eqNullSafe(F.col(f"_g{i}"))
        return rows.where(F.col(f"{CHANGE}.{ACTION}") != DELETE).join(named, met, "left").where(F.col("_gone").isNull() | (order > F.col("_gone"))).select(ROW, CHANGE)

    def _read(self, spark: SparkSession, version: Version) -> DataFrame:
        """All changes of a version, in this table's schema."""
        rows = spark.createDataFrame([], self._stored)
        for kind, text in version.kinds.items():
            own = replace(self, schema=T.StructType.fromJson(json.loads(text)))
            if paths := [f"{self.path}/data/{f}" for f in version.folders.values() if f.startswith(f"{kind}-")]:
                found = spark.read.schema(own._stored).parquet(*paths)
                rows = rows.unionAll(found.select(widened(F.col(ROW), own.schema, self.schema).alias(ROW), CHANGE))
        return rows

    def version(self, spark: SparkSession) -> Version:
        return Manifest(spark, self.path).current()

    def current(self, spark: SparkSession, version: Version | None = None) -> DataFrame:
        """The rows as they are now, or as a version had them while its folders are kept."""
        version = version or self.version(spark)
        return self._whole(version)._current(spark, version)

    def _current(self, spark: SparkSession, version: Version) -> DataFrame:
        rows = self._read(spark, version)
        if self.policy == "PARTIAL":
            order = [n for n, _ in self.order]
            # Envelope and keys get names that no column has.
            flat = rows.select(*(F.col(f"{ROW}.`{n}`").alias(f"c{i}") for i, n in enumerate(self.schema.names)), *(F.col(f"{CHANGE}.`{n}`").alias(f"o_{n}") for n in order), F.col(f"{CHANGE}.{ACTION}").alias("does"))
            place = {n: f"c{i}" for i, n in enumerate(self.schema.names)}
            merged = merged_columns(flat, [place[k] for k in self.keys], [f"o_{n}" for n in order], "does")
            return merged.select(*(F.col(place[n]).alias(n) for n in self.schema.names))
        if self.policy == "REPLACE":
            rows = self._best(rows, last=True).where(F.col(f"{CHANGE}.{ACTION}") != DELETE)
        else:
            rows = self._alive(rows)
            rows = self._best(rows, last=False) if self.policy == "IGNORE" else rows
        return rows.select(f"{ROW}.*")

    def _base(self, rows: DataFrame) -> DataFrame:
        """What a base has to hold: with sequences and deletes, so that late changes still lose against newer ones."""
        gone = self._best(rows.where(F.col(f"{CHANGE}.{ACTION}") == DELETE), last=True) if self.keys else rows.limit(0)
        if self.policy == "REPLACE":
            return self._best(rows, last=True)
        if self.policy == "IGNORE":
            return self._best(self._alive(rows), last=False).unionByName(gone)
        if self.policy == "PARTIAL":
            # For each key and column the row that set it last, with that column alone; a row of no columns keeps the key.
            rest = [n for n in self.schema.names if n not in self.keys]
            alive = self._alive(rows)
            only = lambda c: F.struct(*(F.col(f"{ROW}.`{n}`").alias(n) if n in (*self.keys, c) else F.lit(None).cast(self.schema[n].dataType).alias(n) for n in self.schema.names))
            parts = [self._best(alive.where(F.col(f"{ROW}.`{c}`").isNotNull()).select(only(c).alias(ROW), CHANGE), last=True) for c in rest]
            parts.append(self._best(alive.select(only(None).alias(ROW), CHANGE), last=True))
            for p in parts:
                gone = gone.unionByName(p)
            return gone
        return self._alive(rows).unionByName(gone)

    def compact(self, spark: SparkSession, target: str = "") -> ChangeTable:
        """Publishes a base in the place of the batches there are now; with ``target`` as a new table in that folder.

        Batches that arrive meanwhile stay beside it. Where one that it read was sent again meanwhile, nothing is published.
        """
        was = self.version(spark)
        whole = self._whole(was)
        there = replace(whole, path=target or self.path)
        kind = whole._kind()
        folder = f"{kind}-{uuid.uuid4().hex}"
        whole._base(whole._read(spark, was)).write.parquet(f"{there.path}/data/{folder}")
        done = tuple(sorted({*was.done, *(n for n in was.folders if n != BASE)}))

        def published(now: Version) -> Version | None:
            if target:
                return replace(now, folders={BASE: folder}, done=done, kinds={kind: whole.schema.json()})
            if any(now.folders.get(n) != f for n, f in was.folders.items()):
                return None
            folders = {BASE: folder} | {n: f for n, f in now.folders.items() if n not in was.folders}
            used = {f.split("-")[0] for f in folders.values()}
            return replace(now, folders=folders, done=done, kinds={k: v for k, v in (now.kinds | {kind: whole.schema.json()}).items() if k in used})

        Manifest(spark, there.path).commit(published)
        return there

    def expired(self, spark: SparkSession, seconds: float = 86400.0) -> list[str]:
        """Removes folders that no version of the last ``seconds`` names."""
        return Manifest(spark, self.path).expired(seconds)
