"""The driver's entry with and without the optional training-text part."""

import json
import os
import shutil
import subprocess
import sys

from registry.catalog import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def registered(folder, *broken):
    """Keys of an entry in ``folder``, in a process of its own; modules in ``broken`` cannot be imported there."""
    blocked = "".join(f"import sys; sys.modules[{m!r}] = None; " for m in broken)
    made = subprocess.run([sys.executable, "-c", blocked + ASK], cwd=folder, capture_output=True, text=True, check=True)
    return [set(x) for x in json.loads(made.stdout.splitlines()[-1])]


def copy_without_llm(tmp_path, *also):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *also)
    return shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)


def test_entry_loads_without_the_optional_part(tmp_path):
    folder = copy_without_llm(tmp_path)
    assert (folder / "corpus_pipeline.py").exists() and not (folder / "featuremill" / "llm").exists()
    assert registered(folder) == [set(QUERIES), set(ORACLES)]


def test_entry_loads_without_the_pipeline_too(tmp_path):
    assert registered(copy_without_llm(tmp_path, "corpus_pipeline.py")) == [set(QUERIES), set(ORACLES)]


def test_entry_loads_without_a_library_of_the_optional_part():
    assert registered(ROOT, "xxhash", "tokenizers") == [set(QUERIES), set(ORACLES)] or not os.path.isdir(f"{ROOT}/featuremill/llm")
