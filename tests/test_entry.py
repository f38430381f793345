"""The entry points with and without the training-data part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("statlake.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
from statlake.bindings import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
"""


def test_without_the_training_data_part():
    subprocess.run([sys.executable, "-c", HIDE], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_it():
    for path in (ROOT / "statlake").rglob("*.py"):
        if "llm" not in path.parts:
            assert "statlake.llm" not in path.read_text(), path
