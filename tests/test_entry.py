import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(entry.__file__)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_imports_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(f"{ROOT}/payx", copy / "payx", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and set(e.oracle_sql()) == set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    assert int(out.stdout) > 100
