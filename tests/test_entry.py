"""The driver's contract, in a process without a session."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 60; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
