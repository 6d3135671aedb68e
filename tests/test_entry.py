"""The entry module, and that the library stands without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['lodestone.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
