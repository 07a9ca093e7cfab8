"""The driver's entry module, in a process without a session."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path


def test_queries_are_listed_without_a_session():
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), *q)"], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=120)
    assert told.returncode == 0, told.stderr
    assert "where_stream" in told.stdout and "revenue_by_status" in told.stdout
