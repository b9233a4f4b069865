"""The entry loads where no session runs, with and without the optional parts."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).parents[2]
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "lawtrace.llm") or name.startswith("lawtrace.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
"""
LOAD = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def loaded(code):
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, rest = done.stdout.strip().splitlines()[-1].split(" ", 1)
    assert rest == "[]"
    return int(count)


def test_entry_loads_without_a_session():
    core = loaded(BLOCK + LOAD)
    assert core > 150 and loaded(LOAD) >= core
