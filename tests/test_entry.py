"""The entry works without the operators for training data, and without a library that only these need."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'invalidate_impute' in q, any(n.startswith('op1_') for n in q), set(e.oracle_sql()) <= set(q))"


def told(before: str) -> list[str]:
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", f"{before}\n{COUNT}"], cwd=ROOT, capture_output=True, text=True, check=True)
    return done.stdout.split()


def test_a_missing_library_leaves_the_other_queries():
    n, there, llm, known = told("import sys; sys.modules['ahocorasick'] = None")
    assert int(n) >= 48 and (there, llm, known) == ("True", "False", "True")


def test_missing_folders_leave_the_other_queries():
    n, there, llm, known = told("import sys; sys.modules['tabwright.llm'] = None; sys.modules['corpus_pipeline'] = None")
    assert int(n) >= 48 and (there, llm, known) == ("True", "False", "True")
