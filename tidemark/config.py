"""Task configuration: data sources, tasks, tables, columns; from dictionaries, JSON or (where installed) YAML.

Keys are matched without regard to case; ``Default`` stands for ``DefaultValue`` and ``Mode`` for ``Type`` of a source,
as documents and programs in the field spell them differently.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

#: Task types, by their lower-case names, and the kind of sink that each writes.
TASK_TYPES = {"mysql2clickhouse": "table", "mysql2elasticsearch": "document", "mysql2meilisearch": "document", "mysql2kafka": "message", "mysql2mysql": "table"}


@dataclass(frozen=True)
class Label:
    """One entry of an enum (index) or of a set (bit); index or bit -1 marks the default."""

    const: str
    index: int


@dataclass(frozen=True)
class ColumnMapping:
    source: str
    target: str = ""
    type: str = ""
    ignore: bool = False
    required: bool = False
    default: Any = None
    condition: str = ""
    transform: str = ""
    enum: tuple[Label, ...] = ()
    set: tuple[Label, ...] = ()
    #: What a row gets whose condition isn't met: "null" or "default".
    on_unmet: str = "null"


@dataclass(frozen=True)
class TableConfig:
    source_database: str
    source_table: str
    target_database: str = ""
    target_table: str = ""
    columns: tuple[ColumnMapping, ...] = ()
    primary_key: tuple[str, ...] = ()
    where: str = ""
    #: "REPLACE": the last write of a key wins; "IGNORE": the first one stays; "PARTIAL": the last write of each column
    #: wins, null writes nothing; "": rows are appended. None: REPLACE with a key, else appended.
    on_conflict: str | None = None
    priority: str = "normal"
    batch_size: int = 1000
    batch_timeout: float = 1.0
    #: Changes a second of a low-priority table that go on at once; beyond them and ``burst`` (0: twice the rate) changes
    #: wait in the quarantine. 0: no limit.
    rate_limit: int = 0
    burst: int = 0
    #: Texts and binary values of more bytes are errors; 0: any size.
    max_text_bytes: int = 1_000_000
    max_binary_bytes: int = 5_000_000

    @property
    def policy(self) -> str:
        """What happens to a row whose key is there."""
        return ("REPLACE" if self.primary_key else "") if self.on_conflict is None else self.on_conflict.upper()

    def problem(self) -> str | None:
        """Why the table can't be written as it is configured; None if it can."""
        if self.policy not in ("REPLACE", "IGNORE", "PARTIAL", ""):
            return f"{self.source_name}: no such conflict policy: {self.on_conflict}"
        if self.policy and not self.primary_key:
            return f"{self.source_name}: {self.policy} needs a primary key"
        if self.batch_size < 1 or self.batch_timeout < 0:
            return f"{self.source_name}: batches need a positive size and a time that isn't negative"
        if self.rate_limit < 0 or self.burst < 0:
            return f"{self.source_name}: rates and bursts aren't negative"
        return None

    @property
    def source_name(self) -> str:
        return f"{self.source_database}.{self.source_table}"

    @property
    def target_name(self) -> str:
        """Database and table of the target; the source's table where none is named."""
        table = self.target_table or self.source_table
        return f"{self.target_database}.{table}" if self.target_database else table

    def target_of(self, source: str) -> str:
        """The target name of a source column; ignored and unmapped ones keep theirs."""
        return next((c.target or c.source for c in reversed(self.columns) if c.source == source and not c.ignore), source)


@dataclass(frozen=True)
class SyncTask:
    name: str
    type: str
    source: str
    target: str
    tables: tuple[TableConfig, ...] = ()
    enabled: bool = True

    @property
    def kind(self) -> str:
        return TASK_TYPES[self.type.lower()]

    def tables_into(self, target: str) -> list[TableConfig]:
        """The tables that are written to a target, by its full name or its table's name."""
        return [t for t in self.tables if target in (t.target_name, t.target_table)]


@dataclass(frozen=True)
class DataSource:
    name: str
    type: str
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    sources: tuple[DataSource, ...]
    tasks: tuple[SyncTask, ...]

    def problem(self, task: SyncTask) -> str | None:
        """Why a task can't run: its type, its source or target, their types, or a table's settings; None if it can."""
        kinds = {s.name: s.type.lower() for s in self.sources}
        if task.type.lower() not in TASK_TYPES:
            return f"unknown task type: {task.type}"
        for name, wanted in zip((task.source, task.target), task.type.lower().split("2"), strict=True):
            if name not in kinds:
                return f"no data source named {name!r}"
            if kinds[name] != wanted:
                return f"{name} is of type {kinds[name]}, not {wanted}"
        return next((p for t in task.tables if (p := t.problem())), None)

    def active_tasks(self) -> list[SyncTask]:
        """Enabled tasks that can run."""
        return [t for t in self.tasks if t.enabled and self.problem(t) is None]

    def task(self, name: str) -> SyncTask:
        found = next((t for t in self.tasks if t.name == name), None)
        if found is None:
            raise KeyError(f"no task named {name!r}")
        return found

    def tasks_of(self, kind: str) -> list[SyncTask]:
        """Tasks of a type."""
        return [t for t in self.tasks if t.type.lower() == kind.lower()]

    def task_types(self) -> list[str]:
        """The types of the configured tasks."""
        return sorted({t.type.lower() for t in self.tasks})

    def source(self, name: str) -> DataSource:
        found = next((s for s in self.sources if s.name == name), None)
        if found is None:
            raise KeyError(f"no data source named {name!r}")
        return found


_ALIASES = {
    "defaultvalue": "default", "mode": "type", "columnmappings": "columns", "columns": "columns", "whereclause": "where",
    "enummapping": "enum", "setmapping": "set", "bit": "index", "mysqlsource": "source", "clickhousetarget": "target",
    "elasticsearchtarget": "target", "meilisearchtarget": "target", "kafkatarget": "target", "batchtimeoutseconds": "batch_timeout",
}


def _taken(kind: type, data: dict[str, Any]) -> dict[str, Any]:
    known = {f.name.replace("_", ""): f.name for f in fields(kind)}
    out = {}
    for key, value in data.items():
        plain = str(key).lower().replace("_", "").replace("-", "")
        plain = _ALIASES.get(plain, plain).replace("_", "")
        if plain in known:
            out[known[plain]] = value
    return out


def _labels(data: Any) -> tuple[Label, ...]:
    return tuple(Label(str(x["const"]), int(x["index"])) for x in (_taken(Label, d) for d in data or ()))


def column_mapping(data: dict[str, Any]) -> ColumnMapping:
    taken = _taken(ColumnMapping, data)
    return ColumnMapping(**taken | {"enum": _labels(taken.get("enum")), "set": _labels(taken.get("set"))})


def table_config(data: dict[str, Any]) -> TableConfig:
    taken = _taken(TableConfig, data)
    return TableConfig(**taken | {"columns": tuple(map(column_mapping, taken.get("columns") or ())), "primary_key": tuple(taken.get("primary_key") or ())})


def config(data: dict[str, Any]) -> Config:
    plain = {str(k).lower().replace("_", ""): v for k, v in data.items()}
    tasks = []
    for t in plain.get("synctasks") or plain.get("tasks") or ():
        taken = _taken(SyncTask, t)
        tasks.append(SyncTask(**{"source": "", "target": "", "type": ""} | taken | {"tables": tuple(map(table_config, taken.get("tables") or ()))}))
    sources = [DataSource(s["name"], s.get("type", ""), {k: v for k, v in s.items() if k not in ("name", "type")}) for s in ({str(k).lower(): v for k, v in d.items()} for d in plain.get("datasources") or plain.get("sources") or ())]
    return Config(tuple(sources), tuple(tasks))


def load_config(path: str) -> Config:
    """Reads a JSON file, or a YAML file where a YAML library is installed."""
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ModuleNotFoundError as e:
            raise RuntimeError("reading YAML needs the package pyyaml; use JSON instead") from e
        return config(yaml.safe_load(text))
    return config(json.loads(text))
