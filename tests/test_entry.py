import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_without_the_training_data_folders(tmp_path):
    for x in ("holdwright", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / x).is_dir() else shutil.copy)(ROOT / x, tmp_path / x)
    shutil.rmtree(tmp_path / "holdwright" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
