"""The entry module works with and without the optional parts."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

HIDDEN = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
from lavra.catalog import entries
names = set(entry.queries())
assert names == set(entries()), names ^ set(entries())
assert set(entry.oracle_sql()) <= names
print(len(names))
"""


def without(*hidden):
    run = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return int(run.stdout)


def test_entry_without_the_training_data_operators():
    assert without("lavra.llm", "corpus_pipeline") >= 76
    assert without("lavra.llm") == without("lavra.llm", "corpus_pipeline")


def test_entry_without_tokenizers():
    assert without("public_tokenizers") >= 76


def test_other_missing_modules_are_errors():
    run = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=("lavra.catalog",))], cwd=ROOT, capture_output=True, text=True)
    assert "ModuleNotFoundError" in run.stderr
