"""The library without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as driver
names = set(driver.queries())
assert set(driver.oracle_sql()) <= names, "an oracle without a query"
assert not any(name.startswith("op") and name[2].isdigit() or name == "pipeline" for name in names), names
print(len(names))
"""


@pytest.mark.parametrize("leftover", [[], ["corpus_pipeline.py"], ["tillroll/llm/__pycache__"]])
def test_entry_without_the_subpackage(tmp_path, leftover):
    shutil.copytree(
        ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__", ".*")
    )
    for name in leftover:
        if name.endswith(".py"):
            (tmp_path / "copy" / name).write_text("from tillroll.llm import quality\n")
        else:
            os.makedirs(tmp_path / "copy" / name)
    environment = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path / "copy", env=environment, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 40
