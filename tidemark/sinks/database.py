"""Rows into a database's table, each batch exactly once.

Tasks write a batch into staging tables of its own, which have the target's types: its rows, and the keys to delete. One transaction then moves it into the target by single statements and
notes the batch in ``tidemark_batches``; a batch that is noted is not moved again. A batch that fails on the way leaves
target and notes as they were, and is refused. So a batch that is sent twice, or again after a failure, counts once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import ACTION, DELETE, free_name, latest_changes

NOTES = "tidemark_batches"
GONE = "_gone"
PLACE = "place_"


class SinkRefused(Exception):
    """A sink did not take a batch, and none of its rows."""


@dataclass(frozen=True)
class DatabaseTable:
    """``dialect``: "standard" (MERGE) or "mysql" (INSERT ... ON DUPLICATE KEY). ``policy`` as of tables: REPLACE, IGNORE, ""."""

    url: str
    table: str
    keys: tuple[str, ...] = ()
    policy: str = "REPLACE"
    dialect: str = "standard"
    options: dict[str, str] = field(default_factory=dict)
    #: Rows that a task sends at a time.
    batch_size: int = 1000

    def __post_init__(self):
        if self.policy not in ("REPLACE", "IGNORE", ""):
            raise ValueError(f"no such conflict policy for a database: {self.policy}")
        if self.policy and not self.keys:
            raise ValueError(f"{self.policy} needs a primary key")

    def _quoted(self, name: str) -> str:
        mark = "`" if self.dialect == "mysql" else '"'
        return mark + name.replace(mark, mark * 2) + mark

    def statements(self, staging: str, columns: list[str]) -> list[str]:
        """What moves a staged batch: rows whose key is deleted go, then the others are merged, added or kept out."""
        q, keys = self._quoted, self.keys
        target, source = q(self.table), q(staging)
        same = " AND ".join(f"(t.{q(k)} = s.{q(k)} OR t.{q(k)} IS NULL AND s.{q(k)} IS NULL)" for k in keys)
        names, values = ", ".join(map(q, columns)), ", ".join(f"s.{q(c)}" for c in columns)
        out = []
        if keys:
            out.append(f"DELETE FROM {target} {'AS ' if self.dialect != 'mysql' else ''}t WHERE EXISTS (SELECT 1 FROM {q(staging + GONE)} s WHERE {same})")
        rest = [c for c in columns if c not in keys]
        if self.policy == "REPLACE" and self.dialect == "mysql":
            sets = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in rest or keys)
            out.append(f"INSERT INTO {target} ({names}) SELECT {values} FROM {source} s ON DUPLICATE KEY UPDATE {sets}")
        elif self.policy == "REPLACE":
            update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{q(c)} = s.{q(c)}' for c in rest)} " if rest else ""
            out.append(f"MERGE INTO {target} AS t USING {source} AS s ON {same} {update}WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
        elif self.policy == "IGNORE" and self.dialect == "mysql":
            out.append(f"INSERT IGNORE INTO {target} ({names}) SELECT {values} FROM {source} s")
        elif self.policy == "IGNORE":
            out.append(f"MERGE INTO {target} AS t USING {source} AS s ON {same} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
        else:
            out.append(f"INSERT INTO {target} ({names}) SELECT {values} FROM {source} s")
        return out

    def connection(self, spark: SparkSession):
        properties = spark._jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, str(v))
        return spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def write(self, changes: DataFrame, batch_id: int | str, writer: str = "main", order: tuple[str, ...] = ("seq",), envelope: str = "") -> bool:
        """Writes a batch of changes with action and order, as columns or in ``envelope``; False if the database has it.

        Of changes of one key the last counts, for IGNORE and a database's own order the batch's last as well.
        """
        spark = changes.sparkSession
        columns = [c for c in changes.columns if c not in ((envelope,) if envelope else (ACTION, *order))]
        of = lambda n: F.col(f"`{envelope}`.`{n}`" if envelope else f"`{n}`")
        place, does = free_name(columns, PLACE), free_name(columns, ACTION)
        rows = changes.select(*(F.col(f"`{c}`") for c in columns), of(ACTION).alias(does), F.struct(*map(of, order)).alias(place))
        rows = (latest_changes(rows, list(self.keys), [place]) if self.keys else rows).drop(place)
        name = f"{writer}/{batch_id}"
        staging = f"staging_{hashlib.sha256(f'{self.table} {name}'.encode()).hexdigest()[:20]}"
        parts = {staging: (columns, rows.where(F.col(does) != DELETE).drop(does))}
        if self.keys:
            parts[staging + GONE] = (list(self.keys), rows.where(F.col(does) == DELETE).select(*(F.col(f"`{k}`") for k in self.keys)))
        try:
            if self._noted(spark, name, {k: c for k, (c, _) in parts.items()}):
                return False
            for part, (_, own) in parts.items():
                own.write.format("jdbc").options(**{"url": self.url, "dbtable": self._quoted(part), "batchsize": self.batch_size, **self.options}).mode("append").save()
            return self._moved(spark, staging, columns, name)
        except Py4JJavaError as e:
            if not any(isinstance_of(spark, x, "java.sql.SQLException") for x in causes(e)):
                raise
            raise SinkRefused(str(e.java_exception)[:1000]) from e

    def _run(self, connection, sql: str, *values: str) -> None:
        statement = connection.prepareStatement(sql)
        try:
            for i, v in enumerate(values):
                statement.setString(i + 1, v)
            statement.executeUpdate()
        finally:
            statement.close()

    def _noted(self, spark: SparkSession, name: str, parts: dict[str, list[str]]) -> bool:
        """Has the database this batch? If not, its staging tables are made anew."""
        connection = self.connection(spark)
        try:
            tables, there = connection.getMetaData().getTables(None, None, None, None), set()
            while tables.next():
                there.add(tables.getString("TABLE_NAME").lower())
            tables.close()
            if NOTES not in there:
                self._run(connection, f"CREATE TABLE {NOTES} (target VARCHAR(200) NOT NULL, batch VARCHAR(500) NOT NULL, PRIMARY KEY (target, batch))")
            statement = connection.prepareStatement(f"SELECT 1 FROM {NOTES} WHERE target = ? AND batch = ?")
            statement.setString(1, self.table)
            statement.setString(2, name)
            found = statement.executeQuery().next()
            statement.close()
            if not found:
                empty = "WHERE 1 = 0" if self.dialect == "mysql" else "WITH NO DATA"
                for part, columns in parts.items():
                    if part.lower() in there:
                        self._run(connection, f"DROP TABLE {self._quoted(part)}")
                    self._run(connection, f"CREATE TABLE {self._quoted(part)} AS SELECT {', '.join(map(self._quoted, columns))} FROM {self._quoted(self.table)} {empty}")
            return found
        finally:
            connection.close()

    def _moved(self, spark: SparkSession, staging: str, columns: list[str], name: str) -> bool:
        connection = self.connection(spark)
        try:
            connection.setAutoCommit(False)
            try:
                # The note comes first: a second writer of the batch waits for it, and then fails on the key.
                self._run(connection, f"INSERT INTO {NOTES} (target, batch) VALUES (?, ?)", self.table, name)
                for sql in self.statements(staging, columns):
                    self._run(connection, sql)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
            for part in (staging, *([staging + GONE] if self.keys else [])):
                self._run(connection, f"DROP TABLE {self._quoted(part)}")
            connection.commit()
            return True
        finally:
            connection.close()


def causes(error: Py4JJavaError) -> list:
    out, at = [], error.java_exception
    while at is not None and len(out) < 20:
        out.append(at)
        at = at.getCause()
    return out


def isinstance_of(spark: SparkSession, thing, name: str) -> bool:
    return bool(spark._jvm.java.lang.Class.forName(name).isInstance(thing))
