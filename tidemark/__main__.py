"""``python -m tidemark -f tasks.json -p payloads.json -c checkpoints``: runs the tasks of a configuration until stopped.

payloads.json: source table names to DDL schemas of their rows. ``--list`` shows task types and what keeps tasks from
running; ``--once`` ends when everything that is there is done; ``-v`` shows the version.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from . import __version__
from .config import load_config


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("-f", "--file", help="configuration, JSON or YAML")
    parser.add_argument("-p", "--payloads", help="JSON: source table to DDL schema")
    parser.add_argument("-c", "--checkpoints", help="folder of the queries' positions, shared by the cluster")
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--retry", type=float, default=5.0, help="seconds between looks at the quarantine")
    parser.add_argument("--list", action="store_true")
    parser.add_argument("-v", "--version", action="store_true")
    given = parser.parse_args(arguments)
    if given.version:
        print(__version__)
        return 0
    if not given.file:
        parser.error("-f is needed")
    config = load_config(given.file)
    if given.list:
        print("task types:", ", ".join(config.task_types()))
        for task in config.tasks:
            print(f"{task.name}: {config.problem(task) or ('ready' if task.enabled else 'disabled')}")
        return 0
    if not given.payloads or not given.checkpoints:
        parser.error("-p and -c are needed")
    from pyspark.sql import SparkSession
    from pyspark.sql import types as T

    from .streaming.runner import retried, runs_of

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    payloads = {name: T._parse_datatype_string(ddl) for name, ddl in json.loads(Path(given.payloads).read_text()).items()}
    runs = runs_of(config, payloads, given.checkpoints)
    queries = [run.start(spark, given.once) for run in runs]
    retried(spark, runs, queries, given.retry)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
